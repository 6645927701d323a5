"""Benchmark decontamination by greedy string tiling.

A rolling Karp-Rabin hash over the words of a document finds the seeds it shares with benchmark items.
For an item with enough seeds, the longest match that no tile covers yet is marked on both sides,
again and again, until no match of the least length is left. A document leaks an item when its
tiles cover enough of the item's words, in whatever order they stand.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.llm.frames import append_columns, column_name, raw_texts, without

LEAST = 5  # words of a seed, and of a tile; an item with fewer is one seed
COVERAGE = 0.5
# Benchmark text that is broadcast at a time; a larger benchmark is worked off in several passes.
BLOCK_BYTES = 32 << 20

BASE = np.uint64(0x9E3779B97F4A7C15)
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())
SPLITTING = bytes.maketrans(SEPARATORS, b" " * len(SEPARATORS))

TILE = T.StructType([T.StructField(n, T.IntegerType(), False) for n in ("doc_word", "item_word", "n_words")])
LEAK = T.StructType(
    [
        T.StructField("item_id", T.LongType()),
        T.StructField("n_covered", T.IntegerType(), False),
        T.StructField("n_words", T.IntegerType(), False),
        T.StructField("coverage", T.DoubleType(), False),
        T.StructField("tiles", T.ArrayType(TILE, False), False),
    ]
)


def words_of(raw: bytes | None) -> list[bytes]:
    """Lower-case words, at anything in ASCII but letters and digits."""
    raw = raw or b""
    lower = raw.lower() if raw.isascii() else raw.decode("utf-8", "replace").lower().encode()
    return lower.translate(SPLITTING).split()


class Numbers(dict):
    """Numbers of the benchmark's words; others have none."""

    def __missing__(self, word: bytes) -> int:
        return -1


def rolling(numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and hashes of the windows of known words."""
    n = len(numbers) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    known = np.append(0, np.cumsum(numbers < 0))
    at = np.flatnonzero(known[length:] == known[:-length])
    value = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(length):
            value = value * BASE + (numbers[at + j] + 1).astype(np.uint64)
    return at, value


def tiles(doc: np.ndarray, item: np.ndarray, seeds: list[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Greedy tiles as (place in the document, place in the item, words).

    ``seeds`` are the places of equal windows of ``least`` words. Of equally long matches the first
    in the document, then in the item, comes first.
    """
    doc_open, item_open = np.ones(len(doc) + 1, bool), np.ones(len(item) + 1, bool)
    doc_open[-1] = item_open[-1] = False
    found = []
    while seeds:
        seeds = [(p, q) for p, q in seeds if item_open[q : q + least].all() and doc_open[p : p + least].all()]
        there = set(seeds)
        matches = []
        for p, q in seeds:
            if (p - 1, q - 1) in there:
                continue  # part of a longer match
            size = least
            while (p + size - least + 1, q + size - least + 1) in there:
                size += 1
            matches.append((-size, p, q))
        matches.sort()
        longest = matches[0][0] if matches else 0
        for size, p, q in matches:
            if size != longest:
                break
            if doc_open[p : p - size].all() and item_open[q : q - size].all():
                doc_open[p : p - size] = item_open[q : q - size] = False
                found.append((p, q, -size))
    return found


class Finder:
    """Finds leaks of a block of items in documents."""

    def __init__(self, items: list[tuple[int | None, bytes]], coverage: float):
        self.coverage = coverage
        self.numbers = Numbers()
        self.ids, self.items = [], []
        seeds = defaultdict(lambda: defaultdict(list))
        for id_, raw in items:
            words = words_of(raw)
            if not words:
                continue
            for word in words:
                if word not in self.numbers:
                    self.numbers[word] = len(self.numbers)
            item = np.array([self.numbers[w] for w in words], np.int64)
            least = min(LEAST, len(item))
            for q, value in zip(*(a.tolist() for a in rolling(item, least)), strict=True):
                seeds[least][value].append((len(self.items), q))
            self.ids.append(id_)
            self.items.append(item)
        self.seeds = {n: (dict(of), np.array(sorted(of), np.uint64)) for n, of in seeds.items()}

    def leaks(self, raw: bytes | None) -> list[dict]:
        words = words_of(raw)
        doc = np.fromiter(map(self.numbers.__getitem__, words), np.int64, len(words))
        found = []
        for least, (owners, known) in self.seeds.items():
            at, value = rolling(doc, least)
            near = np.minimum(np.searchsorted(known, value), len(known) - 1)
            hit = known[near] == value
            shared = defaultdict(list)
            for p, v in zip(at[hit].tolist(), value[hit].tolist(), strict=True):
                for k, q in owners[v]:
                    shared[k].append((p, q))
            for k, pairs in shared.items():
                item = self.items[k]
                possible = np.zeros(len(item), bool)
                for q in {q for _, q in pairs}:
                    possible[q : q + least] = True
                if possible.sum() < self.coverage * len(item):
                    continue
                pairs = [(p, q) for p, q in pairs if (doc[p : p + least] == item[q : q + least]).all()]
                laid = tiles(doc, item, pairs, least)
                covered = sum(size for _, _, size in laid)
                if covered and covered >= self.coverage * len(item):
                    found.append(
                        {
                            "item_id": self.ids[k],
                            "n_covered": covered,
                            "n_words": len(item),
                            "coverage": covered / len(item),
                            "tiles": [dict(zip(("doc_word", "item_word", "n_words"), t, strict=True)) for t in laid],
                        }
                    )
        return sorted(found, key=lambda leak: (leak["item_id"] is None, leak["item_id"] or 0))


def find_leaks(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    coverage: float = COVERAGE,
    leaks: str = "leaks",
) -> DataFrame:
    """Add ``leaks``: the items of which a document's tiles cover at least ``coverage``, with the tiles.

    Words are compared in lower case and without punctuation. A null or empty text leaks nothing, an
    item without words is never leaked, and repeated items are found each. Rows stay as they are; a
    column of the new one's name is replaced. The benchmark goes to the workers in blocks of bounded
    size, one pass over the documents for each; an empty one gives no leaks.
    """
    items = benchmark.select(
        F.col(column_name(benchmark, item_id)).cast("long").alias("id"),
        F.coalesce(F.col(column_name(benchmark, item_text)), F.lit("")).cast("binary").alias("raw"),
    )
    size = items.agg(F.coalesce(F.sum(F.octet_length("raw")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-size // BLOCK_BYTES))
    arrow_leak = pa.struct(
        [
            ("item_id", pa.int64()),
            ("n_covered", pa.int32()),
            ("n_words", pa.int32()),
            ("coverage", pa.float64()),
            ("tiles", pa.list_(pa.struct([(n, pa.int32()) for n in TILE.names]))),
        ]
    )
    kept = without(df, [leaks])
    made = []
    for block in range(n_blocks):
        in_block = items.filter(F.pmod(F.xxhash64("id", "raw"), F.lit(n_blocks)) == block)
        rows = sorted(((r.id, bytes(r.raw)) for r in in_block.collect()), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
        shared = df.sparkSession.sparkContext.broadcast(rows)

        def start(shared=shared):
            finder = Finder(shared.value, coverage)

            def work(column: pa.Array) -> list[pa.Array]:
                return [pa.array([finder.leaks(raw) for raw in raw_texts(column)], pa.list_(arrow_leak))]

            return work

        made.append(f"_leaks_{block}")
        df = append_columns(df, [text], [T.StructField(made[-1], T.ArrayType(LEAK, False), False)], start)
    return df.select(*kept, F.concat(*made).alias(leaks))
