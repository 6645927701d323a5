"""Encoding, counting and storing tokens against the tokenizers library."""

import hashlib
import json
import zlib

import numpy as np
import pytest
from paths import BYTES, WORDS
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from adstrata.llm import bpe, queries, token_counts, token_store, vocab


@pytest.fixture(scope="module")
def words():
    return Tokenizer.from_file(WORDS)


def ids_of(tokenizer, text):
    return tokenizer.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


def test_round_trip(nasty, words):
    found = bpe.decode(bpe.encode(nasty, WORDS, packed="packed"), WORDS)
    rows = found.collect()
    assert len(rows) == nasty.count()
    assert {"_text", "key", "Shard"} <= set(found.columns) and "IDS" not in found.columns
    for row in rows:
        expected = ids_of(words, row.text)
        assert row.ids == expected
        assert bytes(row.packed) == packed(expected)
        assert row.decoded == words.decode(expected, skip_special_tokens=False)
    in_one = bpe.round_trip(nasty, WORDS, packed="packed")
    assert in_one.columns == [*[c for c in found.columns if c not in ("ids", "packed", "decoded")], "ids", "packed", "decoded"]
    by_all = lambda df: sorted(map(str, df.select(*in_one.columns).collect()))
    assert by_all(in_one) == by_all(found)


def test_every_code_point_is_cut_as_the_library_does(words):
    encoder = bpe.Encoder(vocab.load(WORDS))
    texts = [f"a{chr(c)}b {chr(c)}" for c in range(1, 0x20000, 3) if not 0xD800 <= c < 0xE000]
    flat, totals = encoder.encode([t.encode() for t in texts])
    expected = [e.ids for e in words.encode_batch(texts, add_special_tokens=False)]
    assert totals.tolist() == list(map(len, expected))
    assert flat.tolist() == [i for ids in expected for i in ids]


def test_full_word_table_starts_anew(words, monkeypatch):
    monkeypatch.setattr(vocab, "KNOWN_WORDS", 3)
    encoder = bpe.Encoder(vocab.load(WORDS))
    for text in ["one two three four five", "six seven one", "two two"]:
        assert encoder.encode([text.encode()])[0].tolist() == ids_of(words, text)


def test_decode_handles_nulls_and_unknown_ids(spark, words):
    rows = spark.createDataFrame([(0, None), (1, []), (2, [320, 99_999_999, 320])], "doc_id int, ids array<int>")
    found = {r.doc_id: r.decoded for r in bpe.decode(rows, WORDS).collect()}
    assert found == {0: "", 1: "", 2: words.decode([320, 320])}
    bytes_ids = Tokenizer.from_file(BYTES).encode("Naïve – 中文").ids
    rows = spark.createDataFrame([(0, bytes_ids)], "doc_id int, ids array<int>")
    assert bpe.decode(rows, BYTES).first().decoded == "Naïve – 中文"


def test_empty_tables(nothing, spark):
    assert bpe.decode(bpe.encode(nothing, WORDS), WORDS).collect() == []
    assert token_counts.count_tokens(nothing, BYTES).collect() == []


def test_file_that_keeps_white_space_is_refused(nothing):
    with pytest.raises(ValueError):
        bpe.encode(nothing, BYTES)
    with pytest.raises(ValueError):
        token_counts.count_tokens(nothing, WORDS)


def test_counts(nasty):
    tokenizer = Tokenizer.from_file(BYTES)
    rows = token_counts.count_tokens(nasty, BYTES).collect()
    assert len(rows) == nasty.count()
    for row in rows:
        assert row.n_tokens == len(ids_of(tokenizer, row.text)), row.text


def test_chunks_compose_wherever_they_are_cut(monkeypatch):
    tables = vocab.load(BYTES) | {"classes": token_counts.character_classes(BYTES)}
    tables["following"], tables["marks"] = token_counts.splitter()
    tokenizer = Tokenizer.from_file(BYTES)
    texts = ["It's  we'll\n\n 'reply' ''s x'r  é  12ab", "'" * 9, " " * 40 + "a", "'l'll'", "they've  ", ""]
    expected = [len(ids_of(tokenizer, t)) for t in texts]
    for chunk in range(1, 12):
        monkeypatch.setattr(token_counts, "CHUNK", chunk)
        assert token_counts.Counter(tables).count(texts).tolist() == expected


@pytest.fixture(scope="module")
def byte_tables():
    tables = vocab.load(BYTES) | {"classes": token_counts.character_classes(BYTES)}
    tables["following"], tables["marks"] = token_counts.splitter()
    return tables


def test_every_code_point_is_counted_as_the_library_does(byte_tables):
    texts = [f"a{chr(c)}b {chr(c)}1{chr(c)}{chr(c)}" for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    expected = [len(e.ids) for e in Tokenizer.from_file(BYTES).encode_batch(texts, add_special_tokens=False)]
    assert token_counts.Counter(byte_tables).count(texts).tolist() == expected


def test_transitions_hold_counts_and_merges_run_only_for_new_ones(byte_tables, monkeypatch):
    counter = token_counts.Counter(byte_tables)
    texts = ["unbelievable unbelief, unbelievably", "unbelievable", "x" * 5_000 + " y"]
    expected = [len(ids_of(Tokenizer.from_file(BYTES), t)) for t in texts]
    assert counter.count(texts).tolist() == expected
    states, merged = counter.compiled.n, []
    real = counter.merged
    monkeypatch.setattr(counter, "merged", lambda text, b, e: merged.extend((e - b).tolist()) or real(text, b, e))
    assert counter.count(texts).tolist() == expected
    assert counter.compiled.n == states and merged == [5_000]  # only the piece that has no states


@pytest.mark.parametrize("longest", [1, 2, 5, 40])
def test_table_is_emptied_and_long_pieces_are_left_out(byte_tables, nasty_texts, monkeypatch, longest):
    monkeypatch.setattr(token_counts, "LONGEST", longest)
    monkeypatch.setattr(token_counts, "STATES", 50)
    monkeypatch.setattr(token_counts, "CHUNK", 7)
    counter, tokenizer = token_counts.Counter(byte_tables), Tokenizer.from_file(BYTES)
    texts = [t and t[:20_000] for t in nasty_texts]
    for _ in range(2):
        assert counter.count(texts).tolist() == [len(ids_of(tokenizer, t)) for t in texts]


def test_transitions_of_a_growing_table_stay():
    rnd = np.random.default_rng(3)
    table, known = token_counts.Transitions(), {}
    for _ in range(40):
        state, codes = rnd.integers(0, 3_000, 9_000).astype(np.int32), rnd.integers(0, 90, 9_000).astype(np.uint32)
        for key, found in zip(zip(state, codes, strict=True), table.follow(state, codes), strict=True):
            assert known.setdefault(key, found) == found
    assert table.n == len(known) + 1 == len(set(known.values())) + 1 and table.slots > 1 << 17


def test_store_round_trip(spark, nasty, words, tmp_path):
    out = str(tmp_path / "store")
    token_store.write_store(nasty, out, WORDS)
    rows = token_store.read_store(spark, out).orderBy("start").collect()
    given = nasty.select("doc_id", "text").collect()
    expected = sorted(
        ((r.doc_id, packed([*ids_of(words, r.text), 2])) for r in given), key=lambda r: (r[0] is not None, r[0] or 0, len(r[1]))
    )
    assert [(r.id, bytes(r.packed)) for r in rows] == expected
    ends = np.cumsum([len(p) // 4 for _, p in expected])
    assert [r.start for r in rows] == [0, *ends[:-1].tolist()]
    some = token_store.read_store(spark, out, ids=[4, 9]).collect()
    assert sorted(r.id for r in some) == [4, 9]
    assert {r.id: bytes(r.packed) for r in some} == {i: dict(expected)[i] for i in (4, 9)}


def test_store_gives_the_library_each_word_once(words, monkeypatch):
    inputs = []

    class Watched:
        def __init__(self, spec):
            self.own = Tokenizer.from_str(spec)

        def __getattr__(self, name):
            return getattr(self.own, name)

        def encode_batch_fast(self, texts, **how):
            inputs.extend(texts)
            return self.own.encode_batch_fast(texts, **how)

        from_str = classmethod(lambda cls, spec: cls(spec))

    monkeypatch.setattr(token_store, "Tokenizer", Watched)
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_store.library_encoder(file.read())
    names = ["Alpha", "beta", "DON'T", "x1", "\x1c"]
    plain = " ".join(a + mark + b for a in names for b in names for mark in ",.;:!?()")
    odd = "<|ENDOFTEXT|> a<|endoftext|>b \u0130\u00c4 \ufb01 \u2003z\u0085 \x1f <|startofTEXT|>\x00"
    texts = [plain, odd, "", plain.lower(), "(" + odd]
    flat, totals = encoder.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(flat, np.cumsum(totals)[:-1])] == [ids_of(words, t) for t in texts]
    assert len(inputs) < 60  # 200 chunks


def test_store_cuts_other_chunks_into_words_too(words, monkeypatch):
    given = []
    made = token_store._encoded
    monkeypatch.setattr(token_store, "_encoded", lambda tokenizer, texts: (given.extend(texts), made(tokenizer, texts))[1])
    with open(WORDS, encoding="utf-8") as file:
        encoder = token_store.library_encoder(file.read())
    names = ["\u00c8onai", "stra\u00dfe", "\u0130z", "e\u0301t\u00e9", "\u65e5\u672c\u8a9e", "\u212aelvin", "na\u00efve's", "\u0665\u06f3", "\u03a3\u03a3"]
    plain = " ".join(a + mark + b for a in names for b in names for mark in ".,;:!?()")
    odd = "\u00e9<|endoftext|>\u00e9 \u00e9<|EndOfText|> a\u00a0\u00e9 \u2003 \u00e9\u0085 \u00e9\x1f\u00e9 \u0301 \u0301\u00e9 \ufeff \U0001f600\u200d\u00e9 <\u0338|endoftext|>"
    texts = [plain, odd, "", plain.upper(), odd + plain + " \u00e9" * 300]
    flat, totals = encoder.encode([t.encode() for t in texts])
    assert [x.tolist() for x in np.split(flat, np.cumsum(totals)[:-1])] == [ids_of(words, t) for t in texts]
    assert sum(map(len, given)) < 1000  # plain holds 648 chunks of 4,800 letters, twice


def test_store_tells_ends_of_words_from_what_looks_like_one(words):
    with open(WORDS, encoding="utf-8") as file:
        spec = file.read()
    table = token_store._table(json.loads(spec), spec)
    some = ["a</w>b", "</w>", "w", "x</w>", "\u00e9"] + [f"w{i}" for i in range(2500)]
    ids, sizes = table.gather(table.numbers([w.encode() for w in some]))
    changes = {"normalizer": None, "pre_tokenizer": token_store.BYTES_ALONE, "added_tokens": []}
    alone = Tokenizer.from_str(json.dumps(json.loads(spec) | changes))
    assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [alone.encode(w, add_special_tokens=False).ids for w in some]


def test_store_of_nothing(spark, nothing, tmp_path):
    out = str(tmp_path / "store")
    token_store.write_store(nothing, out, WORDS)
    assert token_store.read_store(spark, out).collect() == []


def test_store_uses_its_dictionary(spark, folder, tmp_path):
    out = str(tmp_path / "store")
    token_store.write_store(spark.read.parquet(f"{folder}/documents.parquet"), out, WORDS)
    entry = spark.read.parquet(f"{out}/dictionary").first()
    assert len(entry.content) > 1000 and hashlib.sha256(entry.content).hexdigest() == entry.sha256
    hashes = spark.read.parquet(f"{out}/blocks").select("dictionary_sha256").distinct().collect()
    assert [r[0] for r in hashes] == [entry.sha256]


def test_queries(spark, folder, words):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    digest = lambda b: hashlib.sha256(b).hexdigest()
    for row in queries.op1_bpe_round_trip(spark, folder).collect():
        ids = ids_of(words, docs[row.doc_id])
        text = words.decode(ids, skip_special_tokens=False)
        assert row[1:] == (len(ids), digest(packed(ids)), digest(text.encode()))
    start = 0
    for row in queries.op7_token_store(spark, folder).orderBy("doc_id").collect():
        ids = [*ids_of(words, docs[row.doc_id]), 2]
        assert row[1:] == (start, len(ids), zlib.crc32(packed(ids)))
        start += len(ids)
    counts = queries.op10_token_counts(spark, folder)
    tokenizer = Tokenizer.from_file(BYTES)
    for row in counts.collect():
        n = len(ids_of(tokenizer, docs[row.doc_id]))
        assert row[1:] == (len(docs[row.doc_id].encode()), n, n > 1024)
    assert counts.filter(F.col("n_tokens") > 0).count() > 0


def test_new_chunks_are_merged_in_blocks(monkeypatch):
    """Merge rounds hold some numbers for every symbol of a block, so blocks bound a worker's memory."""
    together, plain = [], bpe.encode_words
    monkeypatch.setattr(bpe, "encode_words", lambda words, *more: (together.append(len(words)), plain(words, *more))[1])
    monkeypatch.setattr(bpe, "FRESH_TOGETHER", 100, raising=False)
    texts = [" ".join(f"wort{i}" for i in range(a, a + 700)).encode() for a in (0, 500)]
    ids, totals = bpe.Encoder(vocab.load(WORDS)).encode(texts)
    expected = [Tokenizer.from_file(WORDS).encode(t.decode(), add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == expected[0] + expected[1] and totals.tolist() == [len(e) for e in expected]
    assert sum(together) >= 1200 and max(together) <= 500  # a chunk here has at most five words
