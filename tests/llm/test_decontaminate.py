"""Leaks by greedy string tiling: reordered, edited and short items, against a plain tiling."""

import random
import re

import numpy as np

from adstrata.llm import decontaminate, queries


def plain_tiles(doc, item, least):
    """Greedy string tiling word by word."""
    used_doc, used_item, found = set(), set(), []
    while True:
        best = []
        for p in range(len(doc)):
            for q in range(len(item)):
                n = 0
                while p + n < len(doc) and q + n < len(item) and doc[p + n] == item[q + n] and p + n not in used_doc and q + n not in used_item:
                    n += 1
                if n >= least:
                    best.append((-n, p, q))
        if not best:
            return found
        longest = min(best)[0]
        for n, p, q in sorted(b for b in best if b[0] == longest):
            if not any(p + k in used_doc or q + k in used_item for k in range(-n)):
                used_doc |= set(range(p, p - n))
                used_item |= set(range(q, q - n))
                found.append((p, q, -n))


def test_tiles_against_plain_tiling():
    rnd = random.Random(8)
    for _ in range(150):
        item = [rnd.randrange(4) for _ in range(rnd.randint(2, 14))]
        doc = [rnd.randrange(4) for _ in range(rnd.randint(0, 40))]
        for least in (2, 3):
            seeds = [(p, q) for p in range(len(doc) - least + 1) for q in range(len(item) - least + 1) if doc[p : p + least] == item[q : q + least]]
            assert decontaminate.tiles(np.array(doc), np.array(item), seeds, least) == plain_tiles(doc, item, least)


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").lower())


def plain_leaks(text, items):
    doc, found = words(text), []
    for id_, item in items:
        item = words(item)
        covered = sum(n for _, _, n in plain_tiles(doc, item, min(decontaminate.LEAST, len(item)))) if item else 0
        if covered and covered >= 0.5 * len(item):
            found.append((id_, covered, len(item)))
    return sorted(found, key=str)


def test_leaks(spark, monkeypatch):
    rnd = random.Random(9)
    vocabulary = ["ein", "zwei", "Drei", "élan", "five", "six", "seven", "eight", "nine", "ten", "eleven"]
    say = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    items = [(i, ". ".join(say(7) for _ in range(3))) for i in range(6)] + [(6, None), (None, say(9)), (8, "rare words"), (9, ""), (9, say(6))]
    items.append(items[0])
    docs = [None, "", say(30), items[0][1], items[0][1].upper(), "x " * 50 + "Rare, WORDS!"]
    for _, item in items[:6]:
        parts = item.split(". ")
        docs.append(f"{say(5)} {parts[2]} and {parts[0]} or {parts[1]} {say(4)}")  # reordered
        docs.append(f"{say(5)} {parts[1]} {say(9)}")  # a third of it
        docs.append(" ".join(w if k % 6 else "changed" for k, w in enumerate(item.split())))
    docs.append("seven " * 3_000)
    rows = [(i, t, "x") for i, t in enumerate(docs)] + [(1, "", "x"), (None, items[1][1], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, LEAKS string").repartition(2)
    bench = spark.createDataFrame([(*r, "x") for r in items], "item_id long, text string, id string")
    for block in (decontaminate.BLOCK_BYTES, 150):
        monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
        found = decontaminate.find_leaks(df, bench).collect()
        assert len(found) == len(rows)
        for row in found:
            got = sorted(((x.item_id, x.n_covered, x.n_words) for x in row.leaks), key=str)
            assert got == plain_leaks(row.text, items), row.text
            assert all(sum(t.n_words for t in x.tiles) == x.n_covered for x in row.leaks)


def test_empty_tables(spark, nothing):
    bench = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "one two three four five six")], "doc_id long, text string")
    assert decontaminate.find_leaks(docs, bench).first().leaks == []
    assert decontaminate.find_leaks(nothing, docs.select("doc_id", "text").toDF("item_id", "text")).collect() == []


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    docs = {r.doc_id: set(zip(*(words(r.text)[k:] for k in range(5)), strict=False)) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    bench = {r.item_id: words(r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()}
    expected = set()
    for id_, item in bench.items():
        seeds = list(zip(*(item[k:] for k in range(5)), strict=False))
        for doc, held in docs.items():
            covered = {k + j for k, s in enumerate(seeds) if s in held for j in range(5)}
            if len(covered) >= 0.5 * len(item):
                expected.add((doc, id_))
    assert {(r.doc_id, r.item_id) for r in queries.op3_decontaminate(spark, folder).collect()} == expected
    assert expected
