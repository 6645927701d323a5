"""Source divergence audit: how far the words of each source are from those of its language.

Chunk factorization: tasks count the whitespace chunks of their documents, every distinct chunk of the
whole corpus is cut into terms once, and its terms are joined back to the counts. Occurrences of a term
are sums over its chunks. Its documents are not, because one document may hold it in several chunks:
sums and maxima over chunks bound their number, and only where the bounds leave it open are distinct
documents counted, from the row numbers that rare chunks carry along.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from adstrata.llm.frames import column_name, give_back, release_shuffles, sliced, stored

# Letters of ASCII and whatever is not ASCII; only A to Z have a lower case here.
TERM = r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCALE = 1_000_000_000
# A task hands its counts on when it holds so many chunks, bytes of them, or pairs of chunk and group;
# so many pairs of chunk and document are summed up at a time.
MOST_CHUNKS, MOST_BYTES, MOST_SUMS, MOST_PAIRS = 400_000, 32_000_000, 1_200_000, 800_000
# Bits of the filter for chunks that have to be looked up; it bounds what is broadcast, not what is found.
FILTER_BITS, FILTER_WORD = 1 << 27, 1 << 15
BATCH_ROWS = 20_000
# Sources are compared in tiles of so many by so many.
TILE = 256
MOST_TILES = 64

CHUNKS = "lang string, source string, chunk string, n long, n_docs long"
SUMS = "lang string, a long, b long, total long, n_terms long"


class Numbers(dict):
    """Numbers for keys in the order they are first met."""

    def __missing__(self, key: object) -> int:
        number = self[key] = len(self)
        return number


class ChunkCounts:
    """Occurrences and documents of chunks by group of documents."""

    def __init__(self) -> None:
        self.clear()

    def clear(self) -> None:
        self.chunks, self.groups = Numbers(), Numbers()
        self.bytes = self.pairs = self.n_sums = 0
        self.sums: tuple[np.ndarray, ...] = ()
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.owners: list[tuple[int, int]] = []

    def add(self, lang: str, source: str, text: bytes) -> None:
        found = Counter(text.split())  # of bytes: ASCII white space only
        if not found:
            return
        known = len(self.chunks)
        ids = np.fromiter(map(self.chunks.__getitem__, found), np.int64, len(found))
        if len(self.chunks) > known:
            self.bytes += sum(map(len, found))
        self.ids.append(ids)
        self.counts.append(np.fromiter(found.values(), np.int64, len(found)))
        self.owners.append((self.groups[lang, source], len(found)))
        self.pairs += len(found)
        if self.pairs >= MOST_PAIRS:
            self.sum_up()

    def full(self) -> bool:
        return len(self.chunks) >= MOST_CHUNKS or self.bytes >= MOST_BYTES or self.n_sums >= MOST_SUMS

    def sum_up(self) -> None:
        """Merge the pairs with documents into the sums by group, ordered by chunk and group."""
        if not self.pairs:
            return
        group, size = (np.array(x, np.int64) for x in zip(*self.owners))
        key = (np.concatenate(self.ids) << 32) | np.repeat(group, size)
        n, n_docs = np.concatenate(self.counts), np.ones(len(key), np.int64)
        if self.sums:
            key, n, n_docs = (np.concatenate(x) for x in zip(self.sums, (key, n, n_docs)))
        order = np.argsort(key, kind="stable")
        key = key[order]
        begin = np.flatnonzero(np.diff(key, prepend=-1))
        self.sums = key[begin], np.add.reduceat(n[order], begin), np.add.reduceat(n_docs[order], begin)
        self.ids, self.counts, self.owners, self.pairs = [], [], [], 0
        self.n_sums = len(begin)

    def batches(self) -> Iterator[pa.RecordBatch]:
        self.sum_up()
        if not self.sums:
            return
        key, n, n_docs = self.sums
        chunk, group = key >> 32, key & 0xFFFFFFFF
        strings = pa.array(list(self.chunks), pa.binary()).cast(pa.string())
        langs, sources = (pa.array(x, pa.string()) for x in zip(*self.groups))
        for a in range(0, len(key), BATCH_ROWS):
            b = min(a + BATCH_ROWS, len(key))
            columns = [langs.take(pa.array(group[a:b])), sources.take(pa.array(group[a:b]))]
            columns += [strings.take(pa.array(chunk[a:b])), pa.array(n[a:b]), pa.array(n_docs[a:b])]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "chunk", "n", "n_docs"])


def count_chunks(docs: DataFrame) -> DataFrame:
    """Partial counts of the chunks of ``lang``, ``source``, ``text`` (no nulls), as the tasks see them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = ChunkCounts()
        for batch in sliced(batches):
            lang, source, text = batch.columns
            for one in zip(lang.to_pylist(), source.to_pylist(), text.cast(pa.binary()).to_pylist()):
                counts.add(*one)
                if counts.full():
                    yield from counts.batches()
                    counts.clear()
                    give_back()
        yield from counts.batches()
        counts.clear()
        give_back()

    return docs.select("lang", "source", "text").mapInArrow(run, CHUNKS)


def _filter_of(rows: DataFrame) -> np.ndarray:
    """Bits of the hashes of ``lang`` and ``chunk``: FILTER_BITS of them, however many rows there are."""
    at = F.pmod(F.xxhash64("lang", "chunk"), F.lit(FILTER_BITS))
    words = rows.select(at.alias("at")).selectExpr(f"at div {FILTER_WORD} as word", f"at % {FILTER_WORD} as bit")
    found = words.groupBy("word").agg(F.bitmap_construct_agg("bit").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS // 8, np.uint8)
    size = FILTER_WORD // 8
    for word, part in zip(found.column("word").to_pylist(), found.column("bits").to_pylist()):
        bits[word * size : (word + 1) * size] = np.frombuffer(part, np.uint8)
    return bits


def _look_up(docs: DataFrame, wanted: DataFrame, min_docs: int) -> DataFrame:
    """``lang``, ``chunk`` and ``row`` for the documents of wanted chunks, and of a few others.

    A wanted chunk is in fewer than ``min_docs`` documents of its language.
    """
    numbered = docs.select("lang", "text", F.monotonically_increasing_id().alias("row"))
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(wanted))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in sliced(batches):
            langs, rows = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            held = [set(text.split()) for text in batch.column(1).cast(pa.binary()).to_pylist()]
            out = []
            for lang in set(langs):
                own = [k for k, other in enumerate(langs) if other == lang]
                n_docs = Counter(chain.from_iterable(held[k] for k in own))
                # What so many documents of a slice hold is not in doubt.
                rare = [chunk for chunk, n in n_docs.items() if n < min_docs]
                seed = xxhash.xxh64_intdigest(lang.encode(), 42)
                at = np.fromiter((xxhash.xxh64_intdigest(c, seed) for c in rare), np.uint64, len(rare))
                at = (at % np.uint64(FILTER_BITS)).astype(np.int64)
                hits = {rare[i] for i in np.flatnonzero(bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).tolist()}
                out += [(lang, chunk, rows[k]) for k in own for chunk in hits & held[k]]
            langs, chunks, rows = zip(*out) if out else ((), (), ())
            columns = [pa.array(langs, pa.string()), pa.array(chunks, pa.binary()).cast(pa.string()), pa.array(rows, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "chunk", "row"])

    return numbered.mapInArrow(run, "lang string, chunk string, row long")


def cut_chunks(chunks: DataFrame) -> DataFrame:
    """``chunk``, ``term`` and ``times`` for every distinct chunk, each cut once."""
    lowered = F.translate("chunk", UPPER, LOWER)
    return (
        chunks.select("chunk")
        .distinct()
        .select("chunk", F.explode(F.regexp_extract_all(lowered, F.lit(TERM), F.lit(0))).alias("term"))
        .groupBy("chunk", "term")
        .agg(F.count("*").alias("times"))
    )


def frequent_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n`` and ``n_lang`` (occurrences in the group and in the language).

    Only terms that at least ``min_docs`` documents of the language hold. ``docs`` has ``lang``,
    ``source`` and ``text`` without nulls. Intermediate tables go to the shared folder.
    """
    chunks = stored(count_chunks(docs), "divergence-chunks", "zstd")
    cut = stored(cut_chunks(chunks), "divergence-cut")
    release_shuffles(docs.sparkSession)  # of the distinct chunks, before the counts are moved
    whole = chunks.repartition("chunk").groupBy("lang", "source", "chunk").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))
    # Every chunk is one key of the table of terms, so none of its partitions is large.
    by_source = (
        whole.join(cut.hint("shuffle_hash"), "chunk")
        .groupBy("lang", "source", "term")
        .agg(F.sum(F.col("n") * F.col("times")).alias("n"), F.max("n_docs").alias("least"), F.sum("n_docs").alias("most"))
    )
    in_lang = Window.partitionBy("lang", "term")  # a row for each source
    possible = stored(
        by_source.select(
            "lang", "source", "term", "n", F.sum("n").over(in_lang).alias("n_lang"),
            (F.sum("least").over(in_lang) >= min_docs).alias("sure"), F.sum("most").over(in_lang).alias("most"),
        ).filter(F.col("most") >= min_docs).drop("most"),
        "divergence-possible",
    )
    release_shuffles(docs.sparkSession)  # of the counts of all chunks
    open_ = possible.filter("not sure").select("lang", "term").distinct()
    wanted = stored(open_.join(cut.select("chunk", "term"), "term"), "divergence-open")
    held = (
        _look_up(docs, wanted, min_docs)
        .join(wanted, ["lang", "chunk"])
        .select("lang", "term", "row")
        .distinct()
        .groupBy("lang", "term")
        .agg(F.count("*").alias("n_docs"))
        .filter(F.col("n_docs") >= min_docs)
    )
    kept = possible.filter("sure").union(possible.filter("not sure").join(held.select("lang", "term"), ["lang", "term"], "left_semi").select(possible.columns))
    return stored(kept.drop("sure"), "divergence-kept")


def _share(count: Column, total: Column, n_terms: Column) -> Column:
    """A smoothed share in units of 1 / SCALE, exact: 1 + floor(SCALE * (count + 2) / (total + 2 * terms))."""
    whole = F.lit(SCALE).cast("decimal(10,0)") * (count.cast("decimal(20,0)") + F.lit(2).cast("decimal(1,0)"))
    return F.call_function("div", whole, total.cast("decimal(20,0)") + n_terms.cast("decimal(18,0)") * 2) + 1


def _distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _tile_sums(tiles: DataFrame) -> DataFrame:
    """Distances of the sources of two blocks, summed over the terms that a task sees."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, list] = {}

        def batch_of() -> Iterator[pa.RecordBatch]:
            for (lang, i, j), (total, n_terms) in sums.items():
                a, b = np.meshgrid(*(np.arange(s, dtype=np.int64) for s in total.shape), indexing="ij")
                a, b = a + i * TILE, b + j * TILE
                upper = a < b
                size = int(upper.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * size, pa.string()), pa.array(a[upper]), pa.array(b[upper]),
                     pa.array(total[upper]), pa.array(np.full(size, n_terms))],
                    names=["lang", "a", "b", "total", "n_terms"],
                )
            sums.clear()

        for batch in sliced(batches):
            langs, i_s, j_s = (c.to_pylist() for c in batch.columns[:3])
            parts, bases = batch.column(3), batch.columns[4:]
            part_at, entries = parts.offsets.to_numpy(), parts.values.field("entries")
            blocks, entry_at = parts.values.field("block").to_numpy(), entries.offsets.to_numpy()
            at, shares = (entries.values.field(c).to_numpy() for c in ("at", "p"))
            base_at, base_of = zip(*((c.offsets.to_numpy(), c.values.to_numpy()) for c in bases))
            for row, (lang, i, j) in enumerate(zip(langs, i_s, j_s)):
                p, q = (of[o[row] : o[row + 1]].copy() for o, of in zip(base_at, base_of))
                for part in range(part_at[row], part_at[row + 1]):
                    held = slice(entry_at[part], entry_at[part + 1])
                    if blocks[part] == i:
                        p[at[held]] = shares[held]
                    if blocks[part] == j:
                        q[at[held]] = shares[held]
                distance = p[:, None] - q[None, :]
                distance *= distance
                distance //= p[:, None] + q[None, :]
                if (lang, i, j) in sums:
                    held = sums[lang, i, j]
                    held[0] += distance
                    held[1] += 1
                else:
                    if len(sums) >= MOST_TILES:
                        yield from batch_of()
                    sums[lang, i, j] = [distance, 1]
        yield from batch_of()

    return tiles.mapInArrow(run, SUMS)


def _pairs(terms: DataFrame, groups: DataFrame) -> DataFrame:
    """``lang``, ``source``, ``item`` (another source) and ``value`` for all sources of a language."""
    by_source = Window.partitionBy("lang").orderBy("source")
    base = _share(F.lit(0), F.col("total"), F.col("n_terms"))
    groups = stored(
        groups.withColumn("number", (F.row_number().over(by_source) - 1).cast("long"))
        .withColumn("block", F.expr(f"number div {TILE}"))
        .withColumn("base", F.when(F.col("n_terms") > 0, base)),
        "divergence-groups",
    )
    blocks = groups.groupBy("lang", "block").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("number", "base"))), lambda s: s["base"]).alias("bases")
    )
    n_blocks = groups.groupBy("lang").agg((F.max("block") + 1).alias("n_blocks"))
    share = _share(F.col("n"), F.col("total"), F.col("n_terms"))
    entry = F.struct((F.col("number") % TILE).cast("int").alias("at"), share.alias("p"))
    vectors = (
        terms.join(groups, ["lang", "source"])
        .groupBy("lang", "term", "block")
        .agg(F.collect_list(entry).alias("entries"))  # at most TILE
        .join(n_blocks, "lang")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_blocks") - 1)))
    )
    tiles = (
        vectors.groupBy("lang", "term", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"))
        .agg(F.collect_list(F.struct("block", "entries")).alias("parts"))  # one or two
        .join(blocks.select("lang", F.col("block").alias("i"), F.col("bases").alias("base_i")), ["lang", "i"])
        .join(blocks.select("lang", F.col("block").alias("j"), F.col("bases").alias("base_j")), ["lang", "j"])
        .select("lang", "i", "j", "parts", "base_i", "base_j")
    )
    sums = _tile_sums(tiles).groupBy("lang", "a", "b").agg(F.sum("total").alias("seen"), F.sum("n_terms").alias("n_seen"))
    # A row for every two sources is what the audit reports; no terms are multiplied here.
    one = groups.select("lang", "source", "n_terms", F.col("number").alias("x"), F.col("base").alias("p"))
    two = groups.select("lang", F.col("source").alias("item"), F.col("number").alias("y"), F.col("base").alias("q"))
    unseen = (F.col("n_terms") - F.coalesce("n_seen", F.lit(0))) * _distance(F.col("p"), F.col("q"))
    return (
        one.join(two, "lang")
        .filter("x <> y")
        .withColumns({"a": F.least("x", "y"), "b": F.greatest("x", "y")})
        .join(sums, ["lang", "a", "b"], "left")
        .select("lang", "source", "item", (F.coalesce("seen", F.lit(0)) + F.coalesce(unseen, F.lit(0))).alias("value"))
    )


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, lang: str = "lang", source: str = "source", text: str = "text") -> DataFrame:
    """How far sources of a language are from each other, and which terms set them apart.

    Terms are runs of ASCII letters and non-ASCII characters, A to Z lower-cased. A language keeps the
    terms of at least ``min_docs`` of its documents. A group (language and source) gives every kept term
    the share ``1 + floor(10^9 * (n + 2) / (N + 2 * V))``, its language likewise; the distance of two
    shares is ``floor((p - q)^2 / (p + q))``. Returns ``lang``, ``source``, ``part``, ``item``, ``value``
    and ``rank``: ``pair`` rows hold the summed distance to every other source of the language, ``term``
    rows the ``top`` terms that the source has more of than its language. Ranks follow the value
    downwards, then the item's UTF-8 bytes.

    All arithmetic is on whole numbers. Null language, source and text count as empty; repeated rows are
    documents of their own; other columns of ``docs`` are ignored whatever their names. A group without
    terms has pair rows, of value 0 where its language keeps no term, and no term rows. An empty table
    gives no rows.
    """
    names = {"lang": lang, "source": source, "text": text}
    docs = docs.select(*[F.coalesce(F.col(column_name(docs, c)), F.lit("")).alias(name) for name, c in names.items()])
    terms = frequent_terms(docs, min_docs)
    in_lang = (
        terms.groupBy("lang", "term").agg(F.first("n_lang").alias("n")).groupBy("lang")
        .agg(F.count("*").alias("n_terms"), F.sum("n").alias("total_lang"))
    )
    in_group = terms.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        docs.select("lang", "source").distinct().join(in_group, ["lang", "source"], "left").join(in_lang, "lang", "left")
        .fillna(0, ["total", "n_terms", "total_lang"]),
        "divergence-sources",
    )

    p = _share(F.col("n"), F.col("total"), F.col("n_terms"))
    q = _share(F.col("n_lang"), F.col("total_lang"), F.col("n_terms"))
    shares = terms.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), p.alias("p"), q.alias("q"))
    apart = shares.filter("p > q").select("lang", "source", "item", _distance(F.col("p"), F.col("q")).alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    out = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", "rank")
    best = apart.withColumn("rank", rank).filter(F.col("rank") <= top)
    return out(_pairs(terms, groups).withColumn("rank", rank), "pair").union(out(best, "term"))
