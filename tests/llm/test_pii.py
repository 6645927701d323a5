"""Personal data against plain patterns; revealing words in a small corpus."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from adstrata.llm import pii, queries

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(p) <= 255 for p in match.split("."))
    if kind == "card":
        return 13 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    return [
        (kind, m.start(), m.end()) for kind, p in PATTERNS.items() for m in re.finditer(p, text or "") if valid(kind, m.group())
    ]


def texts():
    rnd = random.Random(3)
    parts = ["a@b.co", "x.y+z@d-e.f.g", "@", ".", "a", " ", "-", "_", "4111 1111 1111 1111", "4111-1111-1111-1112", "378282246310005",
             "1.2.3.4", "255.255.255.255", "256.1.1.1", "0001.002.3.4.5.6.7.8", "+1 (415) 555-2671", "+", "+49 30", "12", "é", "😀", "\n", "a@b.c@d.e"]
    made = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 12))) for _ in range(400)]
    many = " ".join(f"u{i}@h{i}.org" for i in range(300))
    return [None, "", "a" * 100_000, "1" * 5_000, "a@b.c " + "é" * 50 + " 10.0.0.1", "1." * 2_000, many, *made]


def test_base_spans(spark):
    given = texts()
    rows = [(i, t, "x", "y") for i, t in enumerate(given)] + [(1, "", "x", "y"), (None, None, "x", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, SPANS string, _spans string").repartition(3)
    found = pii.find(df).collect()
    assert len(found) == len(rows)
    for row in found:
        got = [(s.kind, s.start, s.end) for s in row.spans if s.kind != pii.TERM]
        assert got == plain(row.text), row.text


def corpus():
    """A name beside an address in four texts, a common word beside it, and copies of one text."""
    fill = "some plain words that stand about here"
    rows = [f"Report {w} {fill} Zaphodius please write zb@example.org today {fill}" for w in ("alpha", "bravo", "gamma", "delta")]
    rows += [f"{fill} number {i} please today" for i in range(60)]
    rows += ["Trillianne writes to tm@example.org often"] * 5
    return rows


def test_revealing_words(spark):
    rows = [(i, t) for i, t in enumerate(corpus())] + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in pii.find(df).collect()}
    words = lambda i: {(df_text[i][s.start : s.end], s.action) for s in found[i].spans if s.kind == pii.TERM}
    df_text = dict(rows)
    for i in range(4):
        assert words(i) == {("Zaphodius", "remove"), ("write", "remove")}
    assert all(not found[i].spans for i in range(4, 64))
    # Copies of one text support nothing.
    assert [s.kind for s in found[64].spans] == ["email"]
    clean = {r.doc_id: r.text for r in pii.sanitise(pii.find(df)).collect()}
    assert clean[0] == df_text[0].replace("Zaphodius", "").replace("write", "").replace("zb@example.org", "<email>")
    assert clean[10] == df_text[10] and clean[None] is None


def test_rare_entities_have_revealing_words(spark):
    """Entities of one and of two texts, and copies of one text, among enough others."""
    rows = ["Trillianne writes please tm@example.org today", "Marvinius please ma@example.org", "today please ma@example.org Marvinius"]
    rows += ["Fordprefect today fp@example.org please"] * 40 + [f"some words please today {i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.find(df).collect()
    words = lambda r: {(r.text[s.start : s.end], s.action) for s in r.spans if s.kind == pii.TERM}
    assert words(found[0]) == {("Trillianne", "remove"), ("writes", "remove")}
    assert words(found[1]) == words(found[2]) == {("Marvinius", "remove")}
    assert all(words(r) == {("Fordprefect", "remove")} for r in found[3:43])
    assert not any(r.spans for r in found[43:])


def test_short_names_numbers_and_far_words(spark):
    """Words of any length, with digits, and behind stretches without words reveal as well."""
    gap = lambda n: " " + "-=" * n + " "
    rows = [f"Kim X7{gap(150)}today please ab@example.org{gap(9_000)}some Zoë4 words" for _ in range(2)]
    rows += [f"some words please today {i}" for i in range(300)]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    found = pii.find(df).collect()
    words = lambda r: {r.text[s.start : s.end] for s in r.spans if s.kind == pii.TERM}
    assert all(words(r) == {"Kim", "X7", "Zoë4"} for r in found[:2])
    assert not any(r.spans for r in found[2:])


def test_contexts_are_whole_words(spark):
    """The five words on each side, against plain splitting of the whole text."""
    rnd = random.Random(7)
    parts = ["a", "Bo", "x" * 190, "y" * 5_000, "12", "...", " " * 195, "-" * 20_000, "é", "word"]
    rows = [("".join(rnd.choice(parts) + " " for _ in range(rnd.randint(0, 12))) + "a@b.co" + "".join(" " + rnd.choice(parts) for _ in range(rnd.randint(0, 12))),) for _ in range(200)]
    df = pii.base_spans(spark.createDataFrame(rows, "text string"), "text").filter("size(spans) = 1")
    df = df.select("text", F.col("spans")[0].alias("s"))
    for row in df.select("text", "s", pii._contexts(F.col("text"), F.col("s"), 5).alias("near")).collect():
        split = lambda t: re.findall(r"[^\W_]+", t.lower())
        assert set(row.near) == {*split(row.text[: row.s.start])[-5:], *split(row.text[row.s.end :])[:5]}


@pytest.mark.parametrize("rows", [0, 100_000])
def test_both_sizes_give_the_same(spark, rows):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(corpus())], "doc_id long, text string")
    found = pii.find(df, settings=pii.Disclosure(broadcast_rows=rows)).collect()
    assert sum(s.kind == pii.TERM for r in found for s in r.spans) == 8


def test_overlapping_spans_are_replaced_once(spark):
    df = spark.createDataFrame([(1, "x a@1.2.3.4 y +49 10.0.0.1 22 z 4111 1111 1111 1111")], "doc_id long, text string")
    assert pii.sanitise(pii.find(df)).first().text == "x <email> y <phone> z <card>"
    assert pii.sanitise(pii.find(df.filter("doc_id > 1"))).collect() == []


def test_query(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    result = queries.op8_pii(spark, folder)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    for row in result.collect():
        spans = plain(docs[row.doc_id])
        written = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert row.base_sha256 == hashlib.sha256(written.encode()).hexdigest()
        assert row.spans.startswith(written)
        assert [row[f"n_{k}"] for k in pii.KINDS] == [sum(s[0] == k for s in spans) for k in pii.KINDS]


def test_a_text_with_thousands_of_entities(spark):
    """A long mailing list: memory and time follow its length, not its square."""
    long = "\n".join(f"name{i} <user{i}@host{i % 50}.example>" for i in range(6_000))
    docs = spark.createDataFrame([(1, long), (2, "nothing here"), (3, None)], "doc_id long, text string")
    found = pii.find(docs)
    assert {r["doc_id"]: sum(s["kind"] == "email" for s in r["spans"]) for r in found.collect()} == {1: 6_000, 2: 0, 3: 0}
    clean = {r["doc_id"]: r["text"] for r in pii.sanitise(found).collect()}
    assert clean[1].count("<email>") == 6_000 and "@" not in clean[1]
