"""Token ids on disk: every document compressed on its own with a shared zstandard dictionary.

The store is a folder of Parquet tables, so that it lives wherever Spark can write:

- ``dictionary``: one row with the dictionary, its SHA-256, and the width of an id in bytes;
- ``blocks``: documents in ascending order of id. A block holds the frames of some documents one
  after another in ``payload`` and an index: ids, offsets, numbers of tokens, and where the document
  starts in its shard. Each block names the dictionary's hash;
- ``shards``: how many ids lie before each shard.

A short document is read by its block's key range, its offset, and one small frame.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tokenizers import Tokenizer

from adstrata.llm import bpe, vocab
from adstrata.llm.frames import column_name, raw_texts, sliced

# The dictionary is trained on this many documents, chosen by a digest of their ids, and on at most
# this many bytes of each; its own size in bytes is bounded too.
SAMPLE_DOCUMENTS = 1024
SAMPLE_BYTES = 1 << 15
DICTIONARY_BYTES = 1 << 16
LEVEL = 3
# A block is closed at this size; a larger document has a block of its own.
BLOCK_BYTES = 1 << 20
BLOCK_DOCUMENTS = 4096
# Steps of a normaliser that leave ASCII as it is, where white space is dropped afterwards, and
# a splitter into bytes that cuts no further.
ASCII_NEUTRAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}]
# What lets a pattern see beside its match.
BESIDES = regex.compile(r"\(\?|\$|(?<!\[)\^|\\[bBAzZGKRX]")
BYTES_ALONE = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}

BLOCK = T.StructType(
    [
        T.StructField("shard", T.IntegerType()),
        T.StructField("dictionary_sha256", T.StringType()),
        T.StructField("first_id", T.LongType()),
        T.StructField("last_id", T.LongType()),
        T.StructField("ids", T.ArrayType(T.LongType())),
        T.StructField("starts", T.ArrayType(T.LongType())),
        T.StructField("n_tokens", T.ArrayType(T.LongType())),
        T.StructField("offsets", T.ArrayType(T.LongType())),
        T.StructField("payload", T.BinaryType()),
    ]
)


def library_encoder(spec: str) -> bpe.Encoder:
    """Encoder whose new chunks go through the tokenizers library.

    Chunks are cut into words before, where the file's normaliser does no more than compose, drop white
    space and lower-case; the library then encodes each distinct word once. ASCII is cut here, other
    chunks by the library's own normaliser and splitter. Chunks with a special string stay whole.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    parsed = json.loads(spec)
    special = [t["content"].lower() for t in parsed["added_tokens"]]
    whole, words, find, front = _library(spec), None, None, None
    split, *rest = (parsed["pre_tokenizer"] or {}).get("pretokenizers", [{}])
    steps = (parsed["normalizer"] or {}).get("normalizers", [])
    normal = [n for n in steps if n not in ASCII_NEUTRAL]
    kept = (split.get("type"), split.get("behavior"), split.get("invert")) == ("Split", "Removed", True)
    if kept and "Regex" in split["pattern"] and rest == [BYTES_ALONE] and normal == [{"type": "Lowercase"}]:
        words = _table(parsed, spec)
        find = regex.compile(split["pattern"]["Regex"]).findall
        if not BESIDES.search(split["pattern"]["Regex"]):
            # Without the step for white space, which these chunks do not have, lines stay apart.
            lines = [n for n in steps if n["type"] != "Replace"]
            changes = {"normalizer": {"type": "Sequence", "normalizers": lines}, "pre_tokenizer": split, "added_tokens": []}
            front = _library(json.dumps(parsed | changes))

    def of_fresh(fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        texts = b"\n".join(fresh).decode("utf-8", "replace").split("\n")  # chunks have no white space of ASCII
        cut = {}
        if words:
            plain = [k for k, text in enumerate(texts) if text.isascii()]
            for k, low in _without(special, plain, "\n".join([texts[k] for k in plain]).lower().split("\n")):
                cut[k] = find(low)
        if front and len(cut) < len(texts):
            other = [k for k, text in enumerate(texts) if not text.isascii() and text.split() == [text]]
            other = [k for k, _ in _without(special, other, [texts[k].lower() for k in other])]
            lows = front.normalizer.normalize_str("\n".join([texts[k] for k in other])).split("\n") if other else []
            other = list(_without(special, other, lows))
            cut |= zip([k for k, _ in other], _words_of([low for _, low in other], front))
        of_whole = [k for k in range(len(texts)) if k not in cut]
        flat, part = _encoded(whole, [texts[k] for k in of_whole])
        sizes = np.zeros(len(fresh), np.int64)
        sizes[of_whole] = part
        if cut:
            of_words = list(cut)
            ids, counts = words.gather(words.numbers("\n".join(chain.from_iterable(cut.values())).encode().split(b"\n")))
            ends = np.append(0, np.cumsum(counts))[np.cumsum([len(cut[k]) for k in of_words])]
            sizes[of_words] = np.diff(ends, prepend=0)
            flat, of_whole = np.append(flat, ids), of_whole + of_words
        # From the order in which they were encoded to the one they came in.
        begin = np.empty(len(fresh), np.int64)
        begin[of_whole] = np.cumsum(sizes[of_whole]) - sizes[of_whole]
        shift = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes)
        return flat[np.arange(len(flat)) + shift], sizes

    return bpe.Encoder({"special": {}, "pattern": "", "normal": [], "front": spec}, of_fresh)


def _without(special: list[str], numbers: list[int], lows: list[str]) -> Iterator[tuple[int, str]]:
    """Numbers and lower-case texts of those that hold no special string."""
    joined = "\n".join(lows)
    found = [s for s in special if s in joined]
    pairs = zip(numbers, lows, strict=False)
    return (p for p in pairs if not any(map(p[1].__contains__, found))) if found else pairs


def _words_of(lows: list[str], front: Tokenizer) -> Iterator[list[str]]:
    """Words of normalised chunks, cut by the library many chunks at a time."""
    for a in range(0, len(lows), 100):
        some = lows[a : a + 100]
        found = front.pre_tokenizer.pre_tokenize_str("\n".join(some))
        words = [w for w, _ in found]
        ends = np.cumsum([len(low) + 1 for low in some])
        of = np.searchsorted(np.fromiter((at[0] for _, at in found), np.int64, len(found)), ends).tolist()
        for begin, end in zip([0, *of], of):
            yield words[begin:end]


def _library(spec: str) -> Tokenizer:
    tokenizer = Tokenizer.from_str(spec)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def _encoded(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of texts as the library gives them, flat, and the number of each text."""
    sizes, parts = np.zeros(len(texts), np.int64), [np.empty(0, np.int64)]
    for a in range(0, len(texts), 20_000):
        found = [e.ids for e in tokenizer.encode_batch_fast(texts[a : a + 20_000], add_special_tokens=False)]
        sizes[a : a + len(found)] = list(map(len, found))
        parts.append(np.fromiter(chain.from_iterable(found), np.int64))
    return np.concatenate(parts), sizes


def _table(parsed: dict, spec: str) -> bpe.Encoder:
    """A table of known words, new ones encoded by the library, many in one text where their ends can be told."""
    alone = {"normalizer": None, "pre_tokenizer": BYTES_ALONE, "added_tokens": []}
    single = _library(json.dumps(parsed | alone))
    line = {"type": "Split", "pattern": {"String": "\n"}, "behavior": "Removed", "invert": False}
    many = _library(json.dumps(parsed | alone | {"pre_tokenizer": {"type": "Sequence", "pretokenizers": [line, BYTES_ALONE]}}))
    suffix, vocabulary = parsed["model"].get("end_of_word_suffix"), many.get_vocab()
    last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
    last[[i for t, i in vocabulary.items() if suffix and t.endswith(suffix)]] = True
    # The library skips what is not in the vocabulary, so an end may be missing.
    ended = bool(suffix) and all(c + suffix in vocabulary for c in vocab.byte_characters())

    def of_fresh(fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words = [w.decode() for w in fresh]
        if ended:
            flat, _ = _encoded(many, ["\n".join(words[a : a + 1000]) for a in range(0, len(words), 1000)])
            at = np.flatnonzero(last[flat])
            if len(at) == len(words):  # each has one end at least, so none has another inside
                return flat, np.diff(at, prepend=-1)
        return _encoded(single, words)

    return bpe.Encoder({"special": {}, "pattern": "", "normal": [], "front": spec}, of_fresh)


def _worker_encoder(shared: dict) -> bpe.Encoder:
    if "encoder" not in shared:
        shared["encoder"] = library_encoder(shared["spec"])
    return shared["encoder"]


def _dictionary(content: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(content) if content else None


def _serialised(encoder: bpe.Encoder, texts: list[bytes | None], end_id: int, width: int):
    """The ids of each text with the end id, as bytes."""
    flat, totals = encoder.encode(texts)
    ends = np.append(0, np.cumsum(totals))
    for k in range(len(texts)):
        yield np.append(flat[ends[k] : ends[k + 1]], end_id).astype(f"<u{width}").tobytes()


def train_dictionary(docs: DataFrame, shared, end_id: int, width: int) -> bytes:
    """Dictionary from a bounded sample; empty where there is too little to train on."""
    order = F.xxhash64("id", F.lit(17))
    chosen = [r[0] for r in docs.select("id").distinct().orderBy(order, "id").limit(SAMPLE_DOCUMENTS).collect()]
    sample = docs.filter(F.col("id").isin([c for c in chosen if c is not None]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(shared.value)
        for batch in sliced(batches):
            texts = raw_texts(batch.column(1))
            made = [s[:SAMPLE_BYTES] for s in _serialised(encoder, texts, end_id, width)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.binary())], ["id", "part"])

    parts = sample.mapInArrow(run, "id long, part binary").groupBy("id").agg(F.min("part").alias("part"))
    samples = [bytes(r.part) for r in parts.orderBy("id").collect()]
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 8)
    if size < 1024 or len(samples) < 16:
        return b""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except zstandard.ZstdError:  # too uniform to train on
        return b""


def write_store(df: DataFrame, out: str, path: str, id: str = "doc_id", text: str = "text", end_id: int = 2) -> None:
    """Encode ``text`` with the tokenizer file at ``path``, append ``end_id``, and write a store.

    The file must drop white space between words. A null or empty text is a document of ``end_id``
    alone. Null ids come first; repeated ids are kept, in the order of their frames. An empty table
    gives a store without blocks. Other columns are not read, whatever their names.
    """
    spark = df.sparkSession
    with open(path, encoding="utf-8") as file:
        spec = file.read()
    tables = vocab.load(path)
    width = 2 if max(len(tables["tokens"]), end_id + 1) <= 1 << 16 else 4
    shared = spark.sparkContext.broadcast({"spec": spec})
    docs = df.select(
        F.col(column_name(df, id)).cast("long").alias("id"), F.col(column_name(df, text)).alias("text")
    )
    n_shards = max(1, df.rdd.getNumPartitions())
    cuts = docs.select(
        F.percentile_approx("id", [i / n_shards for i in range(1, n_shards)] or [0.5], 10_000)
    ).first()[0]
    cuts = np.array(sorted(set(cuts or [])), np.int64)
    content = train_dictionary(docs, shared, end_id, width)
    digest = hashlib.sha256(content).hexdigest()
    spark.createDataFrame(
        [(digest, bytearray(content), width)], "sha256 string, content binary, width int"
    ).coalesce(1).write.parquet(f"{out}/dictionary")
    held = spark.sparkContext.broadcast(content)

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _worker_encoder(shared.value)
        trained = _dictionary(held.value)
        if trained:
            trained.precompute_compress(level=LEVEL)
        pack = zstandard.ZstdCompressor(level=LEVEL, dict_data=trained, write_dict_id=False).compress
        for batch in sliced(batches):
            ids = batch.column(0)
            plain = list(_serialised(encoder, raw_texts(batch.column(1)), end_id, width))
            shard = np.searchsorted(cuts, np.asarray(ids.fill_null(-(1 << 63))), side="right")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.minimum(shard, n_shards - 1).astype(np.int32)),
                    ids,
                    pa.array([len(p) // width for p in plain], pa.int64()),
                    pa.array([pack(p) for p in plain], pa.binary()),
                ],
                ["shard", "id", "n_tokens", "frame"],
            )

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, start, rows, used = None, 0, [], 0

        def closed():
            ids = [r[0] for r in rows]
            sizes = [len(r[2]) for r in rows]
            offsets = [0, *np.cumsum(sizes).tolist()]
            known = [i for i in ids if i is not None]
            found = {
                "shard": shard,
                "dictionary_sha256": digest,
                "first_id": min(known, default=None),
                "last_id": max(known, default=None),
                "ids": ids,
                "starts": [r[3] for r in rows],
                "n_tokens": [r[1] for r in rows],
                "offsets": offsets,
                "payload": b"".join(r[2] for r in rows),
            }
            return pa.RecordBatch.from_pylist([found], schema=arrow_block)

        for batch in batches:
            for number, id_, n, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if rows and (used + len(frame) > BLOCK_BYTES or len(rows) >= BLOCK_DOCUMENTS or number != shard):
                    yield closed()
                    rows, used = [], 0
                if number != shard:
                    shard, start = number, 0
                rows.append((id_, n, frame, start))
                start += n
                used += len(frame)
        if rows:
            yield closed()

    arrow_block = pa.schema(
        [
            ("shard", pa.int32()),
            ("dictionary_sha256", pa.string()),
            ("first_id", pa.int64()),
            ("last_id", pa.int64()),
            *((c, pa.list_(pa.int64())) for c in ("ids", "starts", "n_tokens", "offsets")),
            ("payload", pa.binary()),
        ]
    )
    frames = docs.mapInArrow(compress, "shard int, id long, n_tokens long, frame binary")
    ordered = frames.repartitionById(n_shards, "shard").sortWithinPartitions("id", "n_tokens", "frame")
    ordered.mapInArrow(blocks, BLOCK).write.parquet(f"{out}/blocks")

    sizes = spark.read.parquet(f"{out}/blocks").select("shard", F.explode("n_tokens").alias("n"))
    totals = sizes.groupBy("shard").agg(F.sum("n").alias("n_ids"))
    before = F.sum("n_ids").over(Window.orderBy("shard")) - F.col("n_ids")  # a row for each shard
    totals.withColumn("base", before).coalesce(1).write.parquet(f"{out}/shards")


def read_store(spark: SparkSession, out: str, ids: list[int] | None = None) -> DataFrame:
    """Documents of a store: ``id``, ``start`` (ids of all documents before), ``n_tokens``, ``packed``.

    ``packed`` has the ids, end id included, as little-endian unsigned 32-bit integers. With ``ids``,
    only blocks whose key range may hold one of them are read, and only their frames decompressed.
    """
    entry = spark.read.parquet(f"{out}/dictionary").first()
    width = entry["width"]
    held = spark.sparkContext.broadcast((entry["sha256"], bytes(entry["content"])))
    blocks = spark.read.schema(BLOCK).parquet(f"{out}/blocks")
    if ids is not None:
        hits = F.lit(False)
        for i in ids:
            hits |= (F.col("first_id") <= i) & (F.col("last_id") >= i)
        blocks = blocks.filter(hits)
    wanted = None if ids is None else set(ids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest, content = held.value
        unpack = zstandard.ZstdDecompressor(dict_data=_dictionary(content)).decompress
        for batch in batches:
            for b in range(batch.num_rows):
                row = {c: batch.column(c)[b] for c in batch.schema.names}
                if row["dictionary_sha256"].as_py() != digest:
                    raise ValueError("a block was written with another dictionary")
                names, starts, counts, offsets = (row[c].as_py() for c in ("ids", "starts", "n_tokens", "offsets"))
                payload = memoryview(row["payload"].as_buffer())
                some = [k for k in range(len(names)) if wanted is None or names[k] in wanted]
                for a in range(0, len(some), 256):
                    part = some[a : a + 256]
                    plain = [np.frombuffer(unpack(payload[offsets[k] : offsets[k + 1]]), f"<u{width}") for k in part]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([row["shard"].as_py()] * len(part), pa.int32()),
                            pa.array([names[k] for k in part], pa.int64()),
                            pa.array([starts[k] for k in part], pa.int64()),
                            pa.array([counts[k] for k in part], pa.int64()),
                            pa.array([p.astype("<u4").tobytes() for p in plain], pa.binary()),
                        ],
                        ["shard", "id", "start", "n_tokens", "packed"],
                    )

    found = blocks.mapInArrow(run, "shard int, id long, start long, n_tokens long, packed binary")
    bases = spark.read.schema("shard int, n_ids long, base long").parquet(f"{out}/shards")
    return found.join(bases, "shard").select(
        "id", (F.col("start") + F.col("base")).alias("start"), "n_tokens", "packed"
    )
