import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from adstrata.llm import langid, queries


def line(text):
    """Letters of a text with single spaces, as the models see it."""
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split()
    return " ".join(words) + " " if words else ""


def kneser_ney(texts):
    """Interpolated Kneser-Ney over windows of four characters, by its definition."""
    counts = {4: Counter(("   " + line(t))[i : i + 4] for t in texts for i in range(len(line(t))))}
    for order in (3, 2, 1):
        counts[order] = Counter(g[1:] for g in counts[order + 1])
    discount, totals, kinds = {}, {}, {}
    for order, own in counts.items():
        ones, twos = (sum(n == k for n in own.values()) for k in (1, 2))
        discount[order] = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5
        totals[order], kinds[order] = Counter(), Counter()
        for g, n in own.items():
            totals[order][g[:-1]] += n
            kinds[order][g[:-1]] += 1

    def p(gram):
        order = len(gram)
        below = p(gram[1:]) if order > 1 else 1 / (len(counts[1]) + 1)
        total = totals[order][gram[:-1]]
        if not total:
            return below
        d = discount[order]
        return max(counts[order][gram] - d, 0) / total + d * kinds[order][gram[:-1]] / total * below

    return p


@pytest.fixture(scope="module")
def learned(spark):
    rnd = random.Random(11)
    syllables = {"aa": ["ba", "na", "to", "re", "li"], "bb": ["sch", "ung", "ein", "ät", "to"], "zz": ["中", "文", "国", "人", "😀"]}
    rows = []
    for i in range(240):
        lang = rnd.choice(list(syllables))
        words = ["".join(rnd.choices(syllables[lang], k=rnd.randint(1, 3))) for _ in range(rnd.randint(3, 40))]
        rows.append((i, lang, " ".join(words).capitalize() + ", 12."))
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(langid, "LEAST_TEXTS", 2)  # there are about four a language
        return rows, docs, langid.train(docs)


def test_probabilities(spark, learned):
    rows, docs, model = learned
    apart = {r[0] for r in docs.filter(F.pmod(F.xxhash64("doc_id"), F.lit(langid.CALIBRATION)) == 0).select("doc_id").collect()}
    assert apart
    texts = defaultdict(list)
    for doc_id, lang, text in rows:
        if doc_id not in apart:
            texts[lang].append(text)
    tried = [text for _, _, text in rows[:40]] + ["completely other words", "x", "ÄTUNG 中国 na!"]
    found = langid.predict(spark.createDataFrame([(t,) for t in tried], "text string"), model).collect()
    models = {lang: kneser_ney(own) for lang, own in texts.items()}
    for row in found:
        symbols = line(row["text"])
        padded = "   " + symbols
        entropy = {
            lang: -sum(math.log(p(padded[i : i + 4])) for i in range(len(symbols))) / len(symbols) for lang, p in models.items()
        }
        best = sorted((e, lang) for lang, e in entropy.items())
        assert row["n_symbols"] == len(symbols)
        assert row["cross_entropy"] == pytest.approx(best[0][0], abs=1e-4)
        assert row["margin"] == pytest.approx(best[1][0] - best[0][0], abs=1e-4)
        assert row["lang_pred"] == best[0][1] or best[1][0] - best[0][0] < 1e-4


def test_probabilities_sum_to_one(learned):
    for arrays in learned[2].blocks[0]:
        # All symbols of the unigram table, plus the share of those that were never seen.
        known, values = arrays.tables[1, "gram"]
        assert np.exp(values).sum() + math.exp(arrays.nothing) == pytest.approx(1, abs=1e-3)


def test_blocks_of_languages_change_nothing(spark, learned, monkeypatch):
    _, docs, model = learned
    one = langid.predict(docs, model).collect()
    split = langid.Model([[a] for block in model.blocks for a in block], model.slope, model.offset, model.limits)
    assert len(split.blocks) == 3
    for a, b in zip(one, langid.predict(docs, split).collect()):
        assert a["lang_pred"] == b["lang_pred"]
        assert (a["cross_entropy"], a["margin"]) == pytest.approx((b["cross_entropy"], b["margin"]))


def test_small_buffers_change_nothing(spark, learned, monkeypatch):
    rows, docs, _ = learned
    whole = Counter()
    for _, lang, text in rows:
        padded = "   " + line(text)
        whole.update((lang, padded[i : i + 4]) for i in range(len(padded) - 3))
    monkeypatch.setattr(langid, "BLOCK", 16)
    found = langid.count_grams(docs.repartition(3)).collect()
    assert sorted(r["n"] for r in found) == sorted(whole.values())


def test_edges(spark, learned, nasty, nothing):
    found = langid.predict(nasty.withColumn("score", F.lit("x")).withColumn("Lang_Pred", F.lit("x")), learned[2])
    by_text = {r["text"]: r for r in found.collect()}
    assert found.count() == nasty.count()
    for text, row in by_text.items():
        assert (row["lang_pred"] is None) == (not line(text))
        assert 0 <= row["score"] <= 1
        assert row["lang_pred"] is not None or (row["score"] == 0 and not row["accepted"])
    assert langid.predict(nothing, learned[2]).collect() == []
    empty = langid.train(nothing.withColumn("lang", F.lit("x")))
    assert [r["lang_pred"] for r in langid.predict(nasty, empty).collect()] == [None] * nasty.count()


def test_unlike_texts_are_rejected(spark, learned):
    strange = " ".join("qxzjvkw"[i % 7 :] for i in range(200))
    usual = " ".join(["batona", "reli", "nato"] * 20)
    found = langid.predict(spark.createDataFrame([(usual,), (strange,)], "text string"), learned[2])
    usual, strange = sorted(found.collect(), key=lambda r: r["cross_entropy"])
    assert usual["accepted"] and usual["lang_pred"] == "aa" and usual["score"] > 0.5
    assert not strange["accepted"] and strange["score"] <= 0.5


def test_query(spark, folder):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    found = queries.op13_languages(spark, folder).collect()
    assert sorted(r["doc_id"] for r in found) == sorted(docs)
    for r in found:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert (r["lang_pred"] == "und") == (not line(docs[r["doc_id"]]["text"]))
    for held in (True, False):
        own = [r["lang_pred"] == docs[r["doc_id"]]["lang"] for r in found if r["held_out"] == held]
        assert sum(own) >= 0.98 * len(own)
