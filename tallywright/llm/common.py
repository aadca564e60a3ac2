"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywright.session import work_folder

ARROW_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_ROWS = "500"
#: With it, shuffle files go when the query that made them ends, not when the driver next collects garbage.
FILE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows of one number that are sent to the executors whole.
BROADCAST_ROWS = 1_000_000
#: White space that ends a word: the space and the control characters 9 to 13.
SPACE = r"[\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared work folder: lineage ends, rows are fixed.

    Rows go to Python in batches of ``ARROW_ROWS`` meanwhile, as whole texts are large.  The
    table's own shuffle files go once it is written.
    """
    spark = df.sparkSession
    path = f"{work_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    meanwhile = {ARROW_BATCH: ARROW_ROWS, FILE_CLEANUP: "true"}
    usual = {key: spark.conf.get(key, None) for key in meanwhile}
    for key, value in meanwhile.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in usual.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)
    for made in _watching:
        made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def few(rows: DataFrame) -> DataFrame:
    """Marked for broadcasting where its counted rows are few; else Spark shuffles it."""
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


_watching: list[list[str]] = []


@contextlib.contextmanager
def working_tables() -> Iterator[list[str]]:
    """The paths of the tables that ``written`` makes inside."""
    made: list[str] = []
    _watching.append(made)
    try:
        yield made
    finally:
        _watching.remove(made)


def drop_tables(spark: SparkSession, paths: list[str]) -> None:
    """Delete working tables that nothing reads any more."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(conf).delete(target, True)
    paths.clear()


def words_of(text: Column) -> Column:
    """The words of a text (null: none) as an array of strings."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def held_out(doc_id: Column) -> Column:
    """The quarter of the documents that no model may learn from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in parts of at most ``rows`` rows, so that a task holds few at a time."""
    for batch in batches:
        for low in range(0, batch.num_rows, rows):
            yield batch.slice(low, rows)
    pa.default_memory_pool().release_unused()  # the worker may idle beside other stages' tasks


def lots(batches: Iterator[pa.RecordBatch], column: str, most_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in parts whose texts hold about ``most_bytes``, one row at least."""
    for batch in batches:
        ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
        low = 0
        while low < batch.num_rows:
            before = int(ends[low - 1]) if low else 0
            high = max(int(np.searchsorted(ends, before + most_bytes, "right")), low + 1)
            yield batch.slice(low, high - low)
            low = high
    pa.default_memory_pool().release_unused()


def unclashed(taken: tuple[str, ...], name: str) -> str:
    """``name``, with underscores before it until it is none of ``taken``."""
    while name.lower() in {t.lower() for t in taken}:
        name = "_" + name
    return name
