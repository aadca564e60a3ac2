"""CSV files whose columns are found by the names in their headers.

Spark applies a given schema by place.  Here the header of every file is read first (one
small read a file on the driver), files that share a header are scanned together, and the
columns asked for are picked by name, in any order.  Columns that a file lacks are NULL.

A quoted cell may hold line breaks.  Such files cannot be split, so only those that have one
are read whole: a line with an odd number of quotes gives them away, in one scan of the text
that counts and keeps nothing.  All others stay splittable.  A line break within a cell
comes out as a single line feed.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.sources.storage import data_files, open_text

QUOTE = '"'
#: A quote inside a quoted cell is written twice.
DIALECT = {"header": True, "quote": QUOTE, "escape": QUOTE}
#: Headers read at a time.
READERS = 16


@dataclass(frozen=True)
class CsvGroup:
    """Files with one header, read alike."""

    files: tuple[str, ...]
    columns: tuple[str, ...]
    multi_line: bool = False

    def place(self, column: str) -> int | None:
        """Where a column is; the first of those that share the name."""
        return self.columns.index(column) if column in self.columns else None

    def scan(self, spark: SparkSession, kinds: dict[str, T.DataType], more: Iterable[T.StructField] = (), **options) -> DataFrame:
        """All columns under the names _0, _1, ... in the file's order, as text unless ``kinds`` types them."""
        fields = [
            T.StructField(f"_{n}", kinds.get(name, T.StringType()) if self.place(name) == n else T.StringType())
            for n, name in enumerate(self.columns)
        ]
        reader = spark.read.schema(T.StructType([*fields, *more])).options(**DIALECT, **options)
        return reader.option("multiLine", self.multi_line).csv(list(self.files))

    def column(self, name: str, kind: T.DataType) -> Column:
        at = self.place(name)
        return (F.lit(None).cast(kind) if at is None else F.col(f"_{at}")).alias(name)


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """Names in the first record of a file; none where the file is empty."""
    with open_text(spark, path) as lines:
        record = lines.readLine()
        while record is not None and record.count(QUOTE) % 2:
            more = lines.readLine()
            if more is None:
                break
            record += "\n" + more
    if record is None:
        return ()
    return tuple(name.strip() for name in next(csv.reader([record.removeprefix("\ufeff")]), []))


def _with_quoted_breaks(spark: SparkSession, files: list[str]) -> set[str]:
    quotes = F.length("value") - F.length(F.replace("value", F.lit(QUOTE), F.lit("")))
    found = (
        spark.read.text(files).where(quotes % 2 == 1)
        .select(F.col("_metadata.file_path").alias("file")).distinct().collect()
    )
    jvm = spark._jvm
    return {jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(r.file)).toString() for r in found}


def csv_groups(
    spark: SparkSession, path: str | list[str], quoted_breaks: bool | None = None
) -> list[CsvGroup]:
    """The files below ``path`` (file, folder, pattern or several), grouped by header.

    ``quoted_breaks`` says whether quoted cells may hold line breaks; None looks.  Empty files
    belong to no group.
    """
    files = data_files(spark, path)
    with ThreadPoolExecutor(READERS) as pool:
        headers = dict(zip(files, pool.map(lambda f: _header(spark, f), files)))
    files = [f for f in files if headers[f]]
    if quoted_breaks is None:
        broken = _with_quoted_breaks(spark, files) if files else set()
    else:
        broken = set(files) if quoted_breaks else set()
    groups: dict[tuple, CsvGroup] = {}
    for file in files:
        key = headers[file], file in broken
        group = groups.get(key, CsvGroup((), *key))
        groups[key] = replace(group, files=(*group.files, file))
    return list(groups.values())


def column_findings(groups: Iterable[CsvGroup], table: str, columns: Iterable[str]) -> list[tuple[str, str, str, int]]:
    """(table, check, column, files): columns asked for that files lack, have twice, or have beside them."""
    columns, counts = list(columns), {}
    for group in groups:
        found = [("missing_column", c) for c in columns if c not in group.columns]
        found += [("extra_column", c) for c in dict.fromkeys(group.columns) if c not in columns]
        found += [("repeated_column", c) for c in columns if group.columns.count(c) > 1]
        for key in found:
            counts[key] = counts.get(key, 0) + len(group.files)
    return [(table, check, column, n) for (check, column), n in counts.items()]
