"""Quality measurements against a plain count, and the ledger's policies."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adstrata.llm import queries, quality
from workload import check

TEXTS = [
    None,
    "",
    " \n\t ",
    "a b c a b c a b c",
    "a b c\na b c\n\na b c\n \nx",
    "x " * 70,
    "one two three four five six seven one two three",
    "a a a a a",
    "ab",
    "word # * $ % & | < > !!!" * 20,
    "Ünï cödé 123 " * 30,
    "\n".join(f"line {i % 7} of many" for i in range(60)),
    " ".join(f"w{i}" for i in range(60)),
    " ".join(f"w{i % 997}" for i in range(20_000)),
    "\x0b\x0ca\x1cb\x85c d",
]


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_digits": len(re.findall("[0-9]", text)),
        "n_bangs": text.count("!"),
    }


def test_measurements(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_WORDS string")
    found = quality.ledger(df).collect()
    assert len(found) == len(rows)
    for row in found:
        expected = plain(row.text)
        assert {m: row[m] for m in quality.MEASURES} == expected, row.text
        assert bool(row.failures & 1) == (expected["n_words"] < 50)
        assert bool(row.failures & 2) == (100 * expected["n_repeat_words"] > 50 * expected["n_words"])


def test_filter_does_not_repeat_measurements(spark):
    df = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    kept = quality.ledger(df).filter(quality.passes(quality.CURRENT))
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("concat_ws") == 1
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("policy", quality.POLICIES)
def test_policies(spark, policy):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    ledger = quality.ledger(df)
    expected = {r.doc_id for r in ledger.collect() if not any(r.failures >> quality.RULES[n].bit & 1 for n in policy.rules)}
    assert {r.doc_id for r in ledger.filter(quality.passes(policy)).collect()} == expected


def test_few_repeated_lines_are_kept(spark):
    """A line repeated in a short text is no reason to reject it under the last policy; many are."""
    line = lambda i: " ".join(f"word{'abcdefgh'[i]}{chr(97 + k)}" for k in range(25))
    short = "\n".join(["Hello there", "Hello there", line(0), line(1), "Bye", "Bye"])
    three = "\n".join(["A heading", "A heading", line(3) + " " + line(4)])
    junk = "\n".join(line(i) for i in range(5)) + "\nhome\nnext" * 4
    df = spark.createDataFrame([(1, short), (2, three), (3, junk)], "doc_id long, text string")
    assert {r.doc_id for r in quality.ledger(df).filter(quality.passes(quality.POLICIES[-1])).collect()} == {1, 2}


def test_last_policy_keeps_documents_labelled_good(spark):
    """No document labelled good is lost to repeated lines alone, and none labelled bad comes in for it."""
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    lines = 1 << quality.RULES["duplicate_lines"].bit | 1 << quality.RULES["repeated_lines"].bit
    alone = quality.ledger(docs).filter(f"failures & {lines} != 0 and failures & ~{lines} = 0").join(labels, "doc_id")
    assert [(r.quality, r.kept) for r in alone.select("quality", quality.passes(quality.POLICIES[-1]).alias("kept")).distinct().collect()] == [(1, True)]


def test_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (260,)], "failures long")
    found = {(r.policy, r.version, r.rule): r for r in quality.ablations(rows).collect()}
    assert len(found) == sum(len(p.rules) for p in quality.POLICIES)
    base = found["base", 1, "few_words"]
    assert (base.n_docs, base.n_rejected, base.n_failed, base.n_only_this, base.fails_any, base.fails_all) == (6, 3, 3, 2, 3, 1)
    assert found["web", 2, "exclamations"].n_only_this == 0
    assert found["web", 2, "symbols"].n_failed == 2
    empty = quality.ablations(rows.filter("failures < 0")).collect()
    assert len(empty) == len(found) and all(r.n_docs == 0 for r in empty)


def test_bits_are_stable():
    assert [(r.bit, r.name) for r in quality.RULES.values()][:3] == [(0, "few_words"), (1, "repeated_windows"), (2, "symbols")]
    assert len({r.bit for r in quality.RULES.values()}) == len(quality.RULES)


def test_query_against_sql(spark, folder):
    result = queries.op4_quality(spark, folder)
    assert check.differences(result, check.connect(folder), queries.CHECKS["op4_quality"]) == []
    assert result.filter(F.col("kept") & F.col("base_failed")).count() == 0


def test_labelled_documents(spark):
    """Good documents that are long enough are kept, and bad ones are not, on held-out labels."""
    folder = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.op4_quality(spark, folder).join(labels, "doc_id").filter("not base_failed").collect()
    good = [r.kept for r in rows if r.quality == 1]
    bad = [r.kept for r in rows if r.quality == 0]
    assert sum(good) / len(good) > 0.99
    assert sum(bad) / len(bad) < 0.1
