import random
import re
from collections import Counter
from fractions import Fraction
from math import floor

import pytest

from adstrata.llm import divergence, queries
from workload import check


def plain(docs, min_docs=10, top=10):
    """The audit by its definition, over (lang, source, text)."""
    docs = [tuple(x or "" for x in d) for d in docs]
    lower = str.maketrans(divergence.UPPER, divergence.LOWER)
    terms = [re.findall(divergence.TERM, t.translate(lower)) for _, _, t in docs]
    out = set()
    for lang in {d[0] for d in docs}:
        own = [(d[1], t) for d, t in zip(docs, terms) if d[0] == lang]
        held = Counter(w for _, t in own for w in set(t))
        kept = {w for w, n in held.items() if n >= min_docs}

        def shares(rows):
            n = Counter(w for t in rows for w in t if w in kept)
            size = sum(n.values()) + 2 * len(kept)
            return n, {w: 1 + floor(Fraction(10**9 * (n[w] + 2), size)) for w in kept}

        _, q = shares([t for _, t in own])
        groups = {s: shares([t for o, t in own if o == s]) for s in {s for s, _ in own}}
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s, (n, p) in groups.items():
            pairs = [(o, sum(far(p[w], groups[o][1][w]) for w in kept)) for o in groups if o != s]
            apart = [(w, far(p[w], q[w])) for w in kept if n[w] > 0 and p[w] > q[w]]
            for part, items, most in (("pair", pairs, len(pairs)), ("term", apart, top)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, value, i + 1) for i, (item, value) in enumerate(items[:most])}
    return out


@pytest.fixture(scope="module")
def corpus():
    """Terms split over many chunks, so that bounds leave their documents open; odd texts; a busy source."""
    rnd = random.Random(3)
    words = ["alpha", "Beta", "ÉTÉ", "été", "中文", "x", "naïve", "gamma", "delta", "eps"]
    marks = ["", ",", ".", "!", ";", "(", "-", "1", "?", ":"]
    docs = [
        (
            rnd.choice(["en", "en", "fr", None, ""]),
            rnd.choice(["big", "big", "s1", "s2", None]),
            " ".join(rnd.choice(words) + rnd.choice(marks) + rnd.choice(marks + words) for _ in range(rnd.randint(0, 12))),
        )
        for _ in range(150)
    ]
    docs += [("de", "only", "12 34"), ("it", "a", None), ("it", "b", ""), ("en", "s9", "alpha " * 30_000 + "y" * 200_000)]
    return docs + [docs[0]] * 12


def as_set(df):
    return {tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect()}


def test_against_the_definition(spark, corpus):
    docs = spark.createDataFrame(corpus, "lang string, source string, text string").repartition(5)
    assert as_set(divergence.audit(docs)) == plain(corpus)
    assert as_set(divergence.audit(docs, min_docs=25, top=2)) == plain(corpus, 25, 2)


def test_small_buffers_and_tiles_change_nothing(spark, corpus, monkeypatch):
    monkeypatch.setattr(divergence, "MOST_PAIRS", 40)
    monkeypatch.setattr(divergence, "MOST_SUMS", 60)
    monkeypatch.setattr(divergence, "FILTER_BITS", divergence.FILTER_WORD)
    monkeypatch.setattr(divergence, "TILE", 2)
    monkeypatch.setattr(divergence, "MOST_TILES", 1)
    docs = spark.createDataFrame(corpus, "lang string, source string, text string").repartition(3)
    assert as_set(divergence.audit(docs)) == plain(corpus)


def test_the_filter_hashes_alike(spark):
    """A chunk that is wanted passes the filter; most others don't."""
    wanted = spark.createDataFrame([("en", "häuser,"), ("", "x" * 100), ("fr", "中文中文中")], "lang string, chunk string")
    docs = [("en", "häuser, häuser"), ("", "x" * 100), ("fr", "a 中文中文中"), ("de", "häuser,"), ("en", " ".join(map(str, range(500))))]
    found = divergence._look_up(spark.createDataFrame(docs, "lang string, text string"), wanted, 10).collect()
    assert {(r["lang"], r["chunk"]) for r in found} >= {("en", "häuser,"), ("", "x" * 100), ("fr", "中文中文中")}
    assert len(found) <= 5


def test_documents_of_open_terms_are_counted(spark):
    # Twelve documents hold "word" in chunks of their own, two of them twice; "rare" is in nine.
    docs = [("en", f"s{i % 3}", f"word{'!' * i} word{'?' * (i % 2)}x rare{i if i < 9 else ''}" if i < 9 else f"word{'!' * i}") for i in range(12)]
    found = divergence.frequent_terms(spark.createDataFrame(docs, "lang string, source string, text string"), 10)
    assert {r["term"] for r in found.collect()} == {"word"}


def test_clashing_names_and_empty(spark, nasty, nothing):
    audit = divergence.audit(nasty.selectExpr("*", "cast(null as string) as lang", "if(doc_id % 2 = 0, 's', 't') as source"), min_docs=2)
    assert {r["lang"] for r in audit.collect()} == {""}
    assert divergence.audit(nothing.selectExpr("*", "'' as lang", "'' as source")).collect() == []


def test_query(spark, folder):
    found = queries.op11_divergence(spark, folder)
    assert check.differences(found, check.connect(folder), queries.OP11_SQL) == []


def test_shuffles_are_let_go_between_steps(spark, monkeypatch):
    steps, stored = [], divergence.stored
    monkeypatch.setattr(divergence, "stored", lambda df, name, *more: (steps.append(name), stored(df, name, *more))[1])
    monkeypatch.setattr(divergence, "release_shuffles", lambda session: steps.append("released"), raising=False)
    rows = [("en", "a", f"one two{i}") for i in range(12)]
    kept = divergence.frequent_terms(spark.createDataFrame(rows, "lang string, source string, text string"), 10)
    assert [(r.term, r.n) for r in kept.orderBy("term").collect()] == [("one", 12), ("two", 12)]
    assert [steps[i - 1] for i, s in enumerate(steps) if s == "released"] == ["divergence-cut", "divergence-possible"]
