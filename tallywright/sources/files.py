"""Reading and writing the finance model and its results."""

from __future__ import annotations

import uuid
from collections.abc import Collection, Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.functions.dates import month_label
from tallywright.model import SOURCE_ORDER, TABLES, UNREADABLE, Tables
from tallywright.operators.quality import FINDING, require_sound
from tallywright.operators.star import FACT_DATES
from tallywright.sources.csv_files import DIALECT, CsvGroup, column_findings, csv_groups
from tallywright.sources.storage import create_empty, delete, names_in

CORRUPT = "_corrupt_record"
YES_NO = {"true": "1", "false": "0"}
#: Where a loaded model keeps its versions, and the marks that publish them.
VERSIONS, PUBLISHED = "versions", "_published"


def _all_groups(spark: SparkSession, parts: Iterable[DataFrame], empty: T.StructType) -> DataFrame:
    parts = list(parts)
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)


def scan_csv(
    spark: SparkSession, path: str | list[str], schema: T.StructType, quoted_breaks: bool | None = None
) -> DataFrame:
    """CSV with declared types, columns by header name; unreadable records keep their text in one column."""
    kinds = {f.name: f.dataType for f in schema.fields}
    corrupt = T.StructField(CORRUPT, T.StringType())

    def scanned(group: CsvGroup) -> DataFrame:
        rows = group.scan(spark, kinds, [corrupt], mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT)
        return rows.select(*[group.column(c, kind) for c, kind in kinds.items()], CORRUPT)

    parts = map(scanned, csv_groups(spark, path, quoted_breaks))
    return _all_groups(spark, parts, T.StructType([*schema.fields, corrupt]))


def _typed_text(lines: DataFrame, group: CsvGroup, schema: T.StructType) -> DataFrame:
    place = F.struct(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("row"),
    )
    typed, unreadable = [], []
    for field in schema.fields:
        cell = group.column(field.name, T.StringType())
        if isinstance(field.dataType, T.StringType):
            typed.append(cell)
            continue
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            cell = F.coalesce(*[F.when(F.lower(cell) == word, digit) for word, digit in YES_NO.items()], cell)
        value = cell.try_cast(field.dataType)
        typed.append(value.alias(field.name))
        unreadable.append(F.when(cell.isNotNull() & value.isNull(), F.lit(field.name)))
    return lines.select(
        *typed, F.array_compact(F.array(*unreadable)).alias(UNREADABLE), place.alias(SOURCE_ORDER)
    )


def scan_raw_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    quoted_breaks: bool | None = None,
    groups: list[CsvGroup] | None = None,
) -> DataFrame:
    """CSV with columns by header name, read as text and typed after, so that no cell is lost unseen.

    Cells that do not fit their type become NULL and are named in ``UNREADABLE``; flags may be
    written true/false.  ``SOURCE_ORDER`` is a row's place: file, block and row in the block.
    """
    groups = csv_groups(spark, path, quoted_breaks) if groups is None else groups
    place = T.StructType().add("file", T.StringType(), False).add("block", T.LongType(), False).add("row", T.LongType(), False)
    empty = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.ArrayType(T.StringType())), T.StructField(SOURCE_ORDER, place)])
    return _all_groups(spark, (_typed_text(g.scan(spark, {}), g, schema) for g in groups), empty)


class RawTables(dict[str, DataFrame]):
    """Raw tables by name; ``column_findings`` counts the files that lack a column or have others."""

    column_findings: DataFrame


def read_raw_tables(spark: SparkSession, folder: str, quoted_breaks: bool | None = None) -> RawTables:
    """The nine CSV files (or folders of them) of a raw extract."""
    tables, found = RawTables(), []
    for name, spec in TABLES.items():
        path, schema = f"{folder}/{name}.csv", spec.schema
        groups = csv_groups(spark, path, quoted_breaks)
        tables[name] = scan_raw_csv(spark, path, schema, groups=groups)
        found += column_findings(groups, name, schema.names)
    tables.column_findings = spark.createDataFrame(found, FINDING)
    return tables


def scan_table(
    spark: SparkSession, path: str, columns: Iterable[str], where: Column | None = None
) -> DataFrame:
    df = spark.read.parquet(path)
    return (df if where is None else df.where(where)).select(*columns)


def read_model(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The version of the model that was published last; a folder without versions holds the tables itself."""
    version = published_version(spark, folder)
    root = folder if version is None else f"{folder}/{VERSIONS}/{version}"
    return {name: spark.read.parquet(f"{root}/{name}") for name in TABLES}


def published_version(spark: SparkSession, folder: str) -> str | None:
    marks = names_in(spark, f"{folder}/{PUBLISHED}")
    return max(marks).split("-", 1)[1] if marks else None


def _publish(spark: SparkSession, folder: str, version: str, keep: int) -> None:
    """Make a version the current one by a mark of its own, and drop all but the last ``keep``.

    A mark is an empty file whose name sorts after those before it, so the switch is a single
    create, which stores do whole or not at all.
    """
    marks = sorted(names_in(spark, f"{folder}/{PUBLISHED}"))
    number = int(marks[-1].split("-", 1)[0]) + 1 if marks else 1
    create_empty(spark, f"{folder}/{PUBLISHED}/{number:012d}-{version}")
    for mark in marks[: max(0, len(marks) + 1 - keep)]:
        delete(spark, f"{folder}/{PUBLISHED}/{mark}")
        delete(spark, f"{folder}/{VERSIONS}/{mark.split('-', 1)[1]}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").options(**DIALECT).csv(path)


def write_result(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def write_json_summary(summary: DataFrame, path: str) -> None:
    """One JSON object; absent figures are written as null."""
    summary.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def load_model(
    tables: Tables, folder: str, *, strict: bool = True, keep: int = 2
) -> dict[str, DataFrame]:
    """Write the tables parents first as a new version, check the constraints there, then publish it.

    Known columns take their declared type (identifiers keep theirs).  With ``strict`` a broken
    constraint raises; the new version goes, and readers keep the one before.  The last ``keep``
    versions stay, for readers that have not ended.
    """
    version = uuid.uuid4().hex
    root = f"{folder}/{VERSIONS}/{version}"
    written, spark = {}, None
    try:
        for name, spec in TABLES.items():
            df = tables[name]
            spark = df.sparkSession
            declared = {f.name: f.dataType for f in spec.schema.fields}
            typed = df.select(*[
                F.col(c).cast(declared[c])
                if c in declared and not isinstance(declared[c], T.StringType) else F.col(c)
                for c in df.columns
            ])
            path = f"{root}/{name}"
            typed.write.parquet(path)
            written[name] = spark.read.schema(typed.schema).parquet(path)
        if strict:
            require_sound(written)
    except Exception:
        if spark is not None:
            delete(spark, root)
        raise
    _publish(spark, folder, version, keep)
    return written


def export_star(
    frames: Mapping[str, DataFrame], folder: str, months: Collection[str] | None = None
) -> None:
    """Dimensions plain, facts in one folder per month.

    With ``months`` (labels like 2026-03) only these months of the facts are replaced, and
    emptied where there are no rows any more; all others stay as they are.  So a run can be
    repeated, and a month be exported again, without touching the rest.

    Rebalancing by month lets adaptive execution split a heavy month over several
    tasks and gather light ones, so file sizes follow the advisory partition size.
    """
    for name, df in frames.items():
        path = f"{folder}/{name}"
        if name not in FACT_DATES:
            write_result(df, path)
            continue
        dated = df.withColumn("year_month", month_label(F.col(FACT_DATES[name])))
        if months is None:
            _by_month(dated).mode("overwrite").parquet(path)
            continue
        asked = sorted(set(months))
        rows = Observation()
        dated = dated.where(F.col("year_month").isin(*asked)).observe(
            rows, F.count(F.lit(1)).alias("all"),
            *[F.count_if(F.col("year_month") == month).alias(month) for month in asked],
        )
        # only partitions that get rows are overwritten; the others asked for go by name
        _by_month(dated).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(path)
        for month in asked:
            if not rows.get.get(month):
                delete(df.sparkSession, f"{path}/year_month={month}")


def _by_month(dated: DataFrame) -> DataFrameWriter:
    return dated.hint("rebalance", F.col("year_month")).write.partitionBy("year_month")
