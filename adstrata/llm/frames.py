"""Helpers shared by the operators: columns made in Arrow batches, shared tables, safe names."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adstrata.session import shared_folder
from adstrata.sources.scratch import release_shuffles  # noqa: F401

# Texts are worked on in slices of about this size, so that memory follows the slice and not the batch.
SLICE_BYTES = 4_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(folder).rstrip('/')}/{name}.parquet")


def column_name(df: DataFrame, name: str) -> str:
    """The column of ``df`` that ``name`` means, whatever its case."""
    exact = [c for c in df.columns if c == name]
    found = exact or [c for c in df.columns if c.lower() == name.lower()]
    if not found:
        raise ValueError(f"no column {name!r} among {df.columns}")
    return found[0]


def without(df: DataFrame, names: list[str]) -> list[str]:
    """Columns of ``df`` that none of ``names`` replaces; Spark compares names without case."""
    replaced = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in replaced]


def computed_once(df: DataFrame, kept: list[str], columns: dict[str, Column]) -> DataFrame:
    """``kept`` and the new columns, made by a generator of one row.

    No filter is pushed below a generator, so costly expressions are not repeated in one.
    """
    return df.select(*kept, F.stack(F.lit(1), *columns.values()).alias(*columns))


def append_columns(
    df: DataFrame,
    inputs: list[str],
    fields: list[T.StructField],
    start: Callable[[], Callable[..., list[pa.Array]]],
    slice_bytes: int | None = None,
) -> DataFrame:
    """Add columns computed from Arrow batches; columns of the same name are replaced.

    ``start`` runs once a task and returns a function from the input arrays of a batch to the new
    arrays, row by row. Batches are cut into slices of about ``slice_bytes``, or ``SLICE_BYTES``.
    """
    inputs = [column_name(df, c) for c in inputs]
    kept = without(df, [f.name for f in fields])
    schema = T.StructType([df.schema[c] for c in kept] + fields)
    needed = df.select(*kept, *[c for c in inputs if c not in kept])
    at = [needed.columns.index(c) for c in inputs]
    n_kept, names = len(kept), [f.name for f in schema.fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in sliced(batches, slice_bytes):
            made = work(*[batch.column(i) for i in at])
            yield pa.RecordBatch.from_arrays(
                [batch.column(i) for i in range(n_kept)] + list(made), names=names
            )
        give_back()

    return needed.mapInArrow(run, schema)


def sliced(batches: Iterator[pa.RecordBatch], slice_bytes: int | None = None) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``slice_bytes``, or ``SLICE_BYTES``; an empty one stays."""
    for batch in batches:
        rows = batch.num_rows
        step = max(1, rows * (slice_bytes or SLICE_BYTES) // max(1, batch.nbytes))
        for a in range(0, max(rows, 1), step):
            yield batch.slice(a, step)


def give_back() -> None:
    """Return free memory to the system: a worker that waits for its next task should hold little."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def raw_texts(column: pa.Array) -> list[bytes | None]:
    """UTF-8 bytes of a string column."""
    return column.cast(pa.binary()).to_pylist()


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``SLICE_BYTES`` each; a longer row stands alone."""
    begin = total = 0
    for i, size in enumerate(sizes):
        if i > begin and total + size > SLICE_BYTES:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


@contextmanager
def short_batches(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Arrow batches of at most so many rows in queries that run here: for rows of some KB each, held by JVM and worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows if int(before) <= 0 else min(rows, int(before))))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that all executors share."""
    return f"{shared_folder(spark)}/adstrata-llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """``df`` written to the shared folder and read back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", codec).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
