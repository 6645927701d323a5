import hashlib
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from adstrata.llm import merkle, queries
from workload import check


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(row):
    return "".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row)


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([digest("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def siblings(tree, rank):
    out = []
    for level in tree[:-1]:
        run, at = level[rank // 3 * 3 : rank // 3 * 3 + 3], rank % 3
        out.append((at, run[:at] + run[at + 1 :]))
        rank //= 3
    return out


def plain(rows):
    """Rows (doc_id, source, lang, n_chars, text) to what the query returns."""
    sources = sorted({r[1] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r[0] is not None, r[0] or 0, digest(encoded(r)), r) for r in rows if r[1] == s) for s in sources}
    trees = {s: levels([x[2] for x in own[s]]) for s in sources}
    top = levels([trees[s][-1][0] for s in sources])
    out = []
    for i, s in enumerate(sources):
        for rank, (_, _, leaf, row) in enumerate(own[s]):
            proof = siblings(trees[s], rank) + siblings(top, i)
            folded = leaf
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[4] is not None:
                folded = digest(encoded((*row[:4], row[4].replace("\n", ""))))
            for at, others in proof:
                folded = digest("".join(others[:at]) + folded + "".join(others[at:]))
            all_others = digest("".join(x for _, others in proof for x in others))
            out.append((row[0], leaf, trees[s][-1][0], top[-1][0], all_others, folded, folded == top[-1][0]))
    return Counter(out)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def written(spark, tmp_path, rows, more=()):
    spark.createDataFrame(rows, SCHEMA).selectExpr("*", *more).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


@pytest.mark.parametrize("sizes", [[1], [3], [4], [1, 2, 81, 82, 250], [1] * 10])
def test_sizes(spark, tmp_path, sizes):
    rows = [(i * 1000 + k, f"s{i}", "en", k, f"text {k}\n\nend") for i, n in enumerate(sizes) for k in range(n)]
    found = queries.op12_merkle(spark, written(spark, tmp_path, rows))
    assert Counter(map(tuple, found.collect())) == plain(rows)


def test_odd_rows(spark, tmp_path):
    rows = [
        (5, None, None, None, None), (None, "s", "en", 1, "a\nb"), (None, "s", "en", 1, "a\nb"), (7, "", "", 0, ""),
        (8, "é", "fr", 3, "é\n中"), (8, "é", "fr", 4, "other\n"), (8, "é", "fr", 4, "other\n"), (9, "z", "en", 2, "x\n" * 100_000),
        *[(100 + i, "hot", "en", i, f"{i}\n") for i in range(300)],
    ]
    more = ["'x' as part", "'x' as RANK", "1 as digest", "'x' as _order", "'x' as n", "'x' as later"]
    found = queries.op12_merkle(spark, written(spark, tmp_path, rows, more))
    assert Counter(map(tuple, found.collect())) == plain(rows)


def test_single_requests_and_store(spark):
    rows = [(k, f"s{k % 2}", "en", k, f"text {k}") for k in range(40)]
    manifest = merkle.build(spark.createDataFrame(rows, SCHEMA), queries.FIELDS, carried={"doc_id": F.col("doc_id")})
    asked = manifest.leaves.filter("doc_id in (3, 38)").select("part", "rank", "digest")
    proofs = merkle.verify(manifest.prove(asked.withColumnRenamed("digest", "leaf")), F.col("leaf"))
    assert [r["verified"] for r in proofs.collect()] == [True, True]
    # Every stored record is what its digest says.
    for step in [*manifest.within.steps, *manifest.over.steps]:
        for row in step.collect():
            assert all(digest("".join(c)) == top for top, c in row["children"].items())


def test_empty(spark, tmp_path):
    assert queries.op12_merkle(spark, written(spark, tmp_path, [])).collect() == []


def test_query(spark, folder):
    found = queries.op12_merkle(spark, folder)
    assert check.differences(found, check.connect(folder), queries.OP12_SQL) == []
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text")
    assert Counter(map(tuple, found.collect())) == plain([tuple(r) for r in docs.collect()])
