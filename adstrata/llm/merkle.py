"""Merkle manifest of a dataset: a content-addressed tree of digests, and proofs by descent from its root.

Leaves are digests of rows. Runs of three make a node, level by level, first inside every source and
then over the sources. The store holds each inner node as a digest with its children, grouped into
segments of some levels under the digest of the segment's top, so that a lookup fetches several levels.
A request for a leaf starts at the root: the digits of its rank to base three choose the child at every
level, and the children that are not chosen are the proof. Requests that share a path descend it
together; segments are read downwards and turned round at the end, so a proof reads from the leaf up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.llm.frames import column_name, stored, without

FAN = 3
# Levels of a segment; it has FAN ** LEVELS places at its bottom.
LEVELS = 4
SPAN = FAN**LEVELS

PROOF = T.ArrayType(
    T.StructType([T.StructField("at", T.IntegerType()), T.StructField("others", T.ArrayType(T.StringType()))])
)
SEGMENT = "part string, block long, digest string, children map<string, array<string>>"


def row_digest(columns: list[Column]) -> Column:
    """Digest of a row: `-` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = [c.cast("string") for c in columns]
    pieces = [F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text]
    return F.sha2(F.concat(*pieces), 256)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and a proof, read from the leaf up, lead to."""

    def up(digest: Column, step: Column) -> Column:
        left = F.slice(step["others"], F.lit(1), step["at"])
        right = F.slice(step["others"], step["at"] + 1, F.lit(FAN))
        return F.sha2(F.concat(F.array_join(left, ""), digest, F.array_join(right, "")), 256)

    return F.aggregate(proof, leaf, up)


def proof_digest(proof: Column) -> Column:
    """Digest of all siblings of a proof, from the leaf up and from left to right."""
    return F.sha2(F.array_join(F.flatten(F.transform(proof, lambda step: step["others"])), ""), 256)


def number_in_order(rows: DataFrame, part: str, order: list[str], name: str) -> DataFrame:
    """Add ``rank`` (from 0 within ``part``, in ``order``) and ``n``, the rows of the part.

    Rows are range-partitioned by part and order, so that a large part is spread over many tasks; a row
    for each part and task tells how many rows come before. ``part`` has no nulls.
    """
    keys = [part, *order]
    ordered = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    place = F.monotonically_increasing_id()
    ordered = stored(ordered.withColumn("_place", place).withColumn("_task", F.spark_partition_id()), name)
    held = ordered.groupBy(part, "_task").agg(F.min("_place").alias("_first"), F.count("*").alias("_held"))
    by_task = Window.partitionBy(part).orderBy("_task")
    before = F.sum("_held").over(by_task) - F.col("_held")
    total = F.sum("_held").over(Window.partitionBy(part))
    held = held.select(part, "_task", (before - F.col("_first")).alias("_shift"), total.alias("n"))
    return (
        ordered.join(held, [part, "_task"])
        .withColumn("rank", F.col("_place") + F.col("_shift"))
        .drop("_place", "_task", "_shift")
    )


def climb(digests: list[str], levels: int) -> tuple[str, dict[str, list[str]]]:
    """The top of so many levels over a run of digests, and all nodes on the way with their children."""
    children = {}
    for _ in range(levels):
        above = []
        for i in range(0, len(digests), FAN):
            run = digests[i : i + FAN]
            above.append(hashlib.sha256("".join(run).encode()).hexdigest())
            children[above[-1]] = run
        digests = above
    return digests[0], children


def _segments(nodes: DataFrame) -> DataFrame:
    """One row for each run of SPAN nodes: its top and the nodes below, for as many levels as are left."""
    levels = sum((F.col("n") > FAN**i).cast("int") for i in range(LEVELS))
    runs = nodes.groupBy("part", F.expr(f"rank div {SPAN}").alias("block")).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "digest"))), lambda s: s["digest"]).alias("digests"),
        F.first(levels).alias("levels"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.list_(pa.string()))
        for batch in batches:
            tops, below = [], []
            for digests, levels in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                top, children = climb(digests, levels)
                tops.append(top)
                below.append(list(children.items()))
            columns = [batch.column(0), batch.column(1), pa.array(tops, pa.string()), pa.array(below, kind)]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "block", "digest", "children"])

    return runs.mapInArrow(run, SEGMENT)


@dataclass
class Tree:
    """A tree for each part. ``steps`` holds tables of segments from the leaves up, ``roots`` a row a part."""

    steps: list[DataFrame]
    roots: DataFrame  # part, digest, top (number of its last step)

    @staticmethod
    def build(nodes: DataFrame, name: str) -> Tree:
        """From ``part``, ``rank``, ``digest`` and ``n``; parts have no nulls and ranks no gaps."""
        nodes, steps, roots = nodes.select("part", "rank", "digest", "n"), [], []
        sizes = nodes.select("part", "n").distinct()
        most = sizes.agg(F.max("n")).head()[0] or 0
        while most:
            # Sizes shrink alike in all parts; parts that are down to one node have their root.
            step = stored(_segments(nodes), f"{name}-{len(steps)}")
            sizes = sizes.withColumn("n", F.expr(f"(n + {SPAN - 1}) div {SPAN}"))
            tops = step.select("part", F.col("block").alias("rank"), "digest").join(sizes, "part")
            roots.append(tops.filter("n = 1").select("part", "digest", F.lit(len(steps)).alias("top")))
            nodes, sizes = tops.filter("n > 1"), sizes.filter("n > 1")
            steps.append(step)
            most = -(-most // SPAN) if most > SPAN else 0
        empty = nodes.sparkSession.createDataFrame([], "part string, digest string, top int")
        for rows in roots:
            empty = empty.union(rows)
        return Tree(steps, stored(empty, f"{name}-roots"))

    def descend(self, starts: DataFrame, requests: DataFrame, name: str) -> DataFrame:
        """Add ``path``, the way down to each requested leaf, to ``requests`` (``part``, ``rank`` and more).

        ``starts`` has ``part`` and ``path``, the way down to the part's root.
        """
        starts = self.roots.join(starts, "part")
        frontier = None
        for number in reversed(range(len(self.steps))):
            step = self.steps[number]
            here = starts.filter(F.col("top") == number).select("part", F.lit(0).cast("long").alias("block"), "digest", "path")
            frontier = here if frontier is None else here.union(frontier)
            # Content-addressed: what lies below a digest does not depend on where it stands.
            store = step.groupBy("digest").agg(F.first("children").alias("children"))
            if number == 0:
                wanted = requests
            else:
                wanted = self.steps[number - 1].select("part", F.col("block").alias("rank"))
            fields = [c for c in wanted.columns if c not in ("part", "rank")]
            asked = wanted.groupBy("part", F.expr(f"rank div {SPAN}").alias("block")).agg(
                F.collect_list(F.struct("rank", *fields)).alias("asked")  # at most SPAN: ranks are distinct
            )
            found = _walk(asked.join(frontier, ["part", "block"]).join(store, "digest"), wanted.schema, fields)
            if number == 0:
                return found.drop("digest")
            frontier = stored(found, f"{name}-{number}").select("part", F.col("rank").alias("block"), "digest", "path")
        return requests.withColumn("path", F.array().cast(PROOF)).limit(0)


def _walk(rows: DataFrame, schema: T.StructType, fields: list[str]) -> DataFrame:
    """Descend a segment for each request of a block: the path grows by what was not chosen."""
    kinds = {f.name: f.dataType for f in schema.fields}
    out = T.StructType(
        [T.StructField("part", T.StringType()), T.StructField("rank", T.LongType())]
        + [T.StructField(c, kinds[c]) for c in fields]
        + [T.StructField("digest", T.StringType()), T.StructField("path", PROOF)]
    )
    rows = rows.select("part", "digest", "path", "children", "asked")
    path_type = pa.list_(pa.struct([("at", pa.int32()), ("others", pa.list_(pa.string()))]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                part, top, before, items, asked = (c[i].as_py() for c in batch.columns)
                children, before = dict(items), before or []
                levels, digest = 0, top
                while digest in children and levels < LEVELS:
                    levels, digest = levels + 1, children[digest][0]
                digests, paths = [], []
                for request in asked:
                    digest, path = top, list(before)
                    for level in reversed(range(levels)):
                        at, run = request["rank"] // FAN**level % FAN, children[digest]
                        path.append({"at": at, "others": run[:at] + run[at + 1 :]})
                        digest = run[at]
                    digests.append(digest)
                    paths.append(path)
                held = batch.column(4).slice(i, 1).flatten()
                columns = [pa.array([part] * len(asked), pa.string()), *held.flatten()]
                columns += [pa.array(digests, pa.string()), pa.array(paths, path_type)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in out.fields])

    return rows.mapInArrow(run, out)


@dataclass
class Manifest:
    """Trees of the sources and the tree over them; ``leaves`` has ``part``, ``rank``, ``digest`` and what was kept."""

    leaves: DataFrame
    parts: DataFrame  # part, rank, digest (its subroot)
    within: Tree
    over: Tree

    def root(self) -> DataFrame:
        """``root``: the digest of the whole dataset; no row for an empty one."""
        return self.over.roots.select(F.col("digest").alias("root"))

    def prove(self, requests: DataFrame) -> DataFrame:
        """``requests`` (``part``, ``rank``, and columns that are carried along) with ``subroot``, ``root``, ``proof``.

        The proof lists, from the leaf up to the root, the place in the run and the others in it.
        """
        # One row a part: the way from the root to its subroot.
        top = self.over.roots.select("part", F.array().cast(PROOF).alias("path"))
        ways = self.over.descend(top, self.parts.select(F.lit("").alias("part"), "rank", F.col("part").alias("of")), "merkle-top")
        ways = stored(ways.select(F.col("of").alias("part"), "path"), "merkle-ways")
        proofs = self.within.descend(ways, requests, "merkle-down")
        return (
            proofs.join(self.parts.select("part", F.col("digest").alias("subroot")), "part")
            .crossJoin(F.broadcast(self.root()))  # one row
            .withColumn("proof", F.reverse("path"))
            .drop("path")
        )


def part_of(source: Column) -> Column:
    """A source as a part: without nulls, in the same order."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def build(
    docs: DataFrame, fields: list[str], source: str = "source", order: str = "doc_id", carried: dict[str, Column] | None = None
) -> Manifest:
    """The manifest of ``docs``: leaves are digests of ``fields``, ascending by ``order`` within ``source``.

    ``carried`` names further columns to be kept with each leaf, not with the content. Null sources are a
    source of their own, before all others, and null ids come first within a source. Rows of one id are
    ordered by digest, so equal rows are interchangeable. Fields may be null, empty or long. A source of
    one row has that leaf as its subroot. Other columns of ``docs`` are ignored whatever their names. An
    empty table has no root.
    """
    columns = [F.col(column_name(docs, c)) for c in fields]
    leaves = docs.select(
        part_of(F.col(column_name(docs, source))).alias("part"),
        F.col(column_name(docs, order)).alias("_order"),
        row_digest(columns).alias("digest"),
        *[c.alias(name) for name, c in (carried or {}).items()],
    )
    leaves = number_in_order(leaves, "part", ["_order", "digest"], "merkle-leaves").drop("_order")
    leaves = stored(leaves, "merkle-ranked")
    within = Tree.build(leaves, "merkle-within")
    parts = within.roots.select(F.lit("").alias("all"), F.col("part").alias("of"), "digest")
    parts = number_in_order(parts, "all", ["of"], "merkle-parts").select(F.col("all").alias("part"), "of", "rank", "digest", "n")
    parts = stored(parts, "merkle-subroots")
    over = Tree.build(parts, "merkle-over")
    return Manifest(leaves, parts.select(F.col("of").alias("part"), "rank", "digest"), within, over)


def verify(proofs: DataFrame, leaf: Column) -> DataFrame:
    """Add ``folded_root`` and ``verified``: whether ``leaf`` is what the manifest's root vouches for."""
    kept = without(proofs, ["folded_root", "verified"])
    folded = proofs.select(*kept, fold(leaf, F.col("proof")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))
