"""BPE encoding and decoding: merge rounds over the symbols of many words at once.

Documents are cut at white space; each distinct chunk is encoded once a worker. The words of all new
chunks lie in one flat array of symbols. A round looks up every adjacent pair by binary search
among the sorted pair keys, takes the lowest rank of each word, and merges that pair wherever it
stands in the word, from the left. Words without a pair to merge leave the array.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from adstrata.llm import vocab
from adstrata.llm.frames import append_columns, raw_texts, slices

NO_RANK = np.int64(1) << 60
# Chunks that are merged together, and bytes of text encoded at a time: merge rounds hold some twelve numbers
# a symbol, and ids and strings of a slice are held several times over.
FRESH_TOGETHER = 10_000
SLICE_BYTES = 1_000_000


def merge_rounds(symbols: np.ndarray, lengths: np.ndarray, tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Merge the words that lie one after another in ``symbols``; all ``lengths`` are positive."""
    keys, ranks, made = tables["pair_keys"], tables["pair_ranks"], tables["pair_made"]
    symbols = symbols.copy()
    there = np.ones(len(symbols), bool)
    first = np.cumsum(lengths) - lengths
    at, word = np.arange(len(symbols)), np.repeat(np.arange(len(lengths)), lengths)
    rank = place = None
    stale = np.ones(len(symbols), bool)
    while len(at):
        now = symbols[at]
        inner = np.append(word[1:] == word[:-1], False)
        look = np.flatnonzero(stale & inner)
        if rank is None:
            rank, place = np.full(len(at), NO_RANK), np.zeros(len(at), np.int64)
        rank[stale] = NO_RANK
        wanted = now[look] << 32 | now[look + 1]
        found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[found] == wanted
        rank[look[hit]], place[look[hit]] = ranks[found[hit]], found[hit]
        starts = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
        sizes = np.diff(np.append(starts, len(at)))
        lowest = np.repeat(np.minimum.reduceat(rank, starts), sizes)
        merge = (rank == lowest) & (lowest < NO_RANK)
        # In a run of one symbol, every second of the overlapping pairs is merged.
        index = np.arange(len(at))
        opens = merge & ~np.append(False, merge[:-1])
        merge &= (index - np.maximum.accumulate(np.where(opens, index, 0))) % 2 == 0
        i = np.flatnonzero(merge)
        symbols[at[i]] = made[place[i]]
        there[at[i + 1]] = False
        stale = np.zeros(len(at), bool)
        stale[i] = True
        stale[np.maximum(i - 1, 0)] = True
        stay = lowest < NO_RANK
        stay[i + 1] = False
        at, word, rank, place, stale = at[stay], word[stay], rank[stay], place[stay], stale[stay]
    return symbols[there], np.add.reduceat(there, first) if len(first) else lengths


def encode_words(words: list[bytes], fixed: dict[int, int], tables: dict) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of many words, flat, and how many each has. ``fixed``: words that are one token."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    codes = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum(lengths) - 1
    symbols = tables["first"][codes]
    symbols[ends] = tables["last"][codes[ends]]
    for i, token in fixed.items():
        symbols[ends[i]] = token
    return merge_rounds(symbols, lengths, tables)


class Encoder:
    """Encodes texts with a worker's table of known chunks. Fits files that drop white space."""

    def __init__(self, tables: dict, of_fresh: Callable | None = None):
        self.tables = tables
        self.cutter = vocab.Cutter(tables)
        special = sorted(tables["special"], key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.of_fresh = of_fresh or self.encode_fresh
        self.clear()

    def clear(self) -> None:
        self.known = vocab.Known()
        self.ids, self.used = np.empty(1 << 16, np.int32), 0
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)

    def encode_fresh(self, fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        blocks = [self.encode_block(fresh[a : a + FRESH_TOGETHER]) for a in range(0, len(fresh), FRESH_TOGETHER)]
        return tuple(map(np.concatenate, zip(*blocks)))

    def encode_block(self, fresh: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        words: list[bytes] = []
        fixed: dict[int, int] = {}
        n_words = np.zeros(len(fresh), np.int64)
        special = self.tables["special"]
        for k, chunk in enumerate(fresh):
            text = chunk.decode("utf-8", "replace")
            before = len(words)
            parts = self.special.split(text) if self.special else [text]
            for part in parts:
                if part in special:
                    fixed[len(words)] = special[part]
                    words.append(b" ")
                elif part:
                    words += self.cutter.words(part)
            n_words[k] = len(words) - before
        ids, counts = encode_words(words, fixed, self.tables)
        ends = np.append(0, np.cumsum(counts))[np.append(0, np.cumsum(n_words))]
        return ids, np.diff(ends)

    def numbers(self, chunks: list[bytes]) -> np.ndarray:
        """Numbers of chunks in the table, all of them encoded."""
        if len(self.known) > vocab.KNOWN_WORDS:
            self.clear()
        found = np.fromiter(map(self.known.__getitem__, chunks), np.int64, len(chunks))
        fresh, self.known.fresh = self.known.fresh, []
        if fresh:
            ids, sizes = self.of_fresh(fresh)
            while self.used + len(ids) > len(self.ids):
                self.ids = np.append(self.ids, np.empty_like(self.ids))
            self.ids[self.used : self.used + len(ids)] = ids
            begin = self.used + np.cumsum(sizes) - sizes
            self.begin, self.size = np.append(self.begin, begin), np.append(self.size, sizes)
            self.used += len(ids)
        return found

    def gather(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known chunks one after another, and how many each has."""
        sizes = self.size[found]
        ends = np.cumsum(sizes)
        shift = np.repeat(self.begin[found] - (ends - sizes), sizes)
        return self.ids[np.arange(len(shift)) + shift], sizes

    def encode(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, flat, and the number of each text; a null text has none."""
        flat, totals = [], np.zeros(len(texts), np.int64)
        for a, b in slices([len(t or b"") for t in texts]):
            parts, counts = [], []
            for k in range(a, b):
                for piece in vocab.chunks(texts[k] or b""):
                    if parts and len(parts) + len(piece) > 2_000_000:
                        flat.append(self._add(parts, counts, totals))
                        parts, counts = [], []
                    parts += piece
                    counts.append((k, len(piece)))
            if parts:
                flat.append(self._add(parts, counts, totals))
        return np.concatenate(flat) if flat else np.empty(0, np.int32), totals

    def _add(self, parts: list[bytes], counts: list[tuple[int, int]], totals: np.ndarray) -> np.ndarray:
        ids, sizes = self.gather(self.numbers(parts))
        ends = np.append(0, np.cumsum(sizes))[np.append(0, np.cumsum([n for _, n in counts]))]
        np.add.at(totals, [k for k, _ in counts], np.diff(ends))
        return ids


def offsets(counts: np.ndarray) -> np.ndarray:
    return np.append(0, np.cumsum(counts)).astype(np.int32)


def worker_encoder(shared: dict, of_fresh: Callable | None = None) -> Encoder:
    """The encoder of this worker, kept with the broadcast tables from task to task."""
    if "encoder" not in shared:
        shared["encoder"] = Encoder(shared, of_fresh)
    return shared["encoder"]


class Decoder:
    """Turns ids back into text."""

    def __init__(self, tokens: list[str | None], byte_decoder: bool):
        self.tokens = np.array([*tokens, None], object)
        self.as_bytes = {c: b for b, c in enumerate(vocab.byte_characters())} if byte_decoder else None

    def text(self, ids: np.ndarray) -> str:
        known = (ids >= 0) & (ids < len(self.tokens) - 1)
        parts = self.tokens[ids if known.all() else ids[known]].tolist()
        if None in parts:
            parts = [p for p in parts if p is not None]
        if self.as_bytes is None:
            return " ".join(parts)
        return bytes(self.as_bytes[c] for c in "".join(parts)).decode("utf-8", "replace")


def _tables(path: str) -> dict:
    tables = vocab.load(path)
    if "Replace" not in tables["normal"]:
        raise ValueError(f"{path} keeps white space; its words cannot be cut there")
    return tables


def _columns(flat: np.ndarray, totals: np.ndarray, packed: bool) -> list[pa.Array]:
    """Ids as lists, and packed if asked for."""
    ends, flat = offsets(totals), flat.astype("<i4")
    made = [pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))]
    if packed:
        buffers = [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(flat)]
        made.append(pa.Array.from_buffers(pa.binary(), len(totals), buffers))
    return made


def _fields(ids: str, packed: str | None) -> list[T.StructField]:
    fields = [T.StructField(ids, T.ArrayType(T.IntegerType(), False), False)]
    return fields + ([T.StructField(packed, T.BinaryType(), False)] if packed else [])


def encode(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", packed: str | None = None
) -> DataFrame:
    """Add ``ids``, the token ids of ``text`` under the tokenizer file at ``path``.

    ``packed`` names one more column with the same ids as little-endian unsigned 32-bit integers.
    The file must drop white space between words, as ``word_bpe_49k.json`` does; strings of its
    special tokens inside a text become these tokens. A null or empty text has no ids. Rows stay as
    they are, repeated ones too; columns named like the new ones are replaced. The tables of the
    file are broadcast; their size is that of the vocabulary.
    """
    shared = df.sparkSession.sparkContext.broadcast(_tables(path))

    def start():
        encoder = worker_encoder(shared.value)
        return lambda column: _columns(*encoder.encode(raw_texts(column)), bool(packed))

    return append_columns(df, [text], _fields(ids, packed), start, SLICE_BYTES)


def decode(df: DataFrame, path: str, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """Add ``text``, what the tokenizer file makes of ``ids``, special tokens included.

    Without a decoder in the file, tokens are joined by blanks; a byte-level one gives the bytes back.
    Null ids give an empty text, and ids that the file does not have are skipped. Columns named like
    the new one are replaced.
    """
    tables = vocab.load(path)
    shared = df.sparkSession.sparkContext.broadcast((tables["tokens"], tables["byte_decoder"]))

    def start():
        decoder = Decoder(*shared.value)

        def work(column: pa.Array) -> list[pa.Array]:
            lists = [column[row].values for row in range(len(column))]
            none = np.empty(0, np.int64)
            return [pa.array([decoder.text(none if x is None else np.asarray(x.drop_null())) for x in lists], pa.string())]

        return work

    return append_columns(df, [ids], [T.StructField(text, T.StringType(), False)], start)


def round_trip(
    df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded", packed: str | None = None
) -> DataFrame:
    """``encode`` and ``decode`` in one pass, by one worker instead of two for each task."""
    shared = df.sparkSession.sparkContext.broadcast(_tables(path))

    def start():
        encoder = worker_encoder(shared.value)
        decoder = Decoder(shared.value["tokens"], shared.value["byte_decoder"])

        def work(column: pa.Array) -> list[pa.Array]:
            flat, totals = encoder.encode(raw_texts(column))
            ends = offsets(totals)
            texts = [decoder.text(flat[a:b]) for a, b in zip(ends, ends[1:], strict=False)]
            return [*_columns(flat, totals, bool(packed)), pa.array(texts, pa.string())]

        return work

    fields = [*_fields(ids, packed), T.StructField(decoded, T.StringType(), False)]
    return append_columns(df, [text], fields, start, SLICE_BYTES)
