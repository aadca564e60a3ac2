"""Relational building blocks whose work is not tied to the size of one key group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallywright.session import ensure_checkpoint_dir


def keep_first(df: DataFrame, key: str, order_by: Sequence[str]) -> DataFrame:
    """One row per key, the smallest by ``order_by`` then by all other columns.

    A minimum over whole rows, so copies of a hot key collapse in the map-side
    combine.  ``_copies`` carries how many rows each survivor stands for.
    """
    rest = [c for c in df.columns if c != key and c not in order_by]
    row = F.struct(*[c for c in order_by if c != key], *rest)
    survivors = df.groupBy(key).agg(F.min(row).alias("_row"), F.count(F.lit(1)).alias("_copies"))
    return survivors.select(key, "_row.*", "_copies").select(*df.columns, "_copies")


def label_spine(df: DataFrame, column: str, labels: Sequence[str]) -> DataFrame:
    """A frame of constant labels in order, ready for a left join."""
    pairs = [(position, label) for position, label in enumerate(labels)]
    return df.sparkSession.createDataFrame(pairs, f"label_order int, {column} string")


def overall(value: Column) -> Column:
    """Grand total beside each row; only for frames bounded by a list of labels."""
    return F.sum(value).over(Window.partitionBy())


def number_rows(df: DataFrame, name: str, order: Sequence[Column]) -> DataFrame:
    """Consecutive numbers from 1 in a total order, without a single sorting task.

    Rows are range-partitioned and sorted by the order; ids that grow within each
    partition give a row's place there, and the checkpoint freezes them.  A row's number is then the
    size of all earlier partitions (one small row each) plus its place in its own: one
    shuffle and one sort in all.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    placed = (
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()).checkpoint()
    )
    sliced = placed.withColumns({
        "_slice": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND((1 << 33) - 1),
    })
    earlier = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        sliced.groupBy("_slice")
        .agg(F.count(F.lit(1)).alias("_size"))
        .select("_slice", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"))
    )
    return (
        # a row per partition, whatever the number of rows
        sliced.join(F.broadcast(offsets), "_slice")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_at", "_slice", "_place", "_offset")
    )


def salted_lookup(facts: DataFrame, dimension: DataFrame, key: str, spread: str, salts: int = 32) -> DataFrame:
    """Inner join of facts with a small dimension; a key's facts are dealt over ``salts`` tasks.

    Each fact takes its salt from the column ``spread``; dimension rows are repeated per salt.
    Spark takes the repeated rows to be as few as the dimension's own and would broadcast them
    all through the driver, so both sides are asked to meet in a shuffle.
    """
    salt = F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int")
    copies = dimension.withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
    ).hint("merge")
    return facts.withColumn("_salt", salt).join(copies, [key, "_salt"]).drop("_salt")


def as_of_value(
    facts: DataFrame,
    history: DataFrame,
    *,
    key: str,
    fact_date: str,
    history_date: str,
    values: Sequence[str],
) -> DataFrame:
    """Attach the values in force on each fact's date (latest start <= date).

    The as-of step runs on the distinct (key, date) pairs of both sides, so a
    window holds at most one row per calendar day and side however many facts
    share a key.  The facts then meet the result in a plain equi-join.
    Facts with no earlier start get NULLs; equal starts resolve to the
    smallest value tuple.
    """
    starts = history.groupBy(
        F.col(key).alias(key), F.col(history_date).alias("_day")
    ).agg(F.min(F.struct(*values)).alias("_value"))
    days = facts.where(F.col(key).isNotNull() & F.col(fact_date).isNotNull()).select(
        F.col(key), F.col(fact_date).alias("_day")
    ).distinct()
    # history sorts before a fact of the same day
    timeline = starts.withColumn("_side", F.lit(0)).unionByName(
        days.withColumn("_side", F.lit(1)), allowMissingColumns=True
    )
    so_far = (
        Window.partitionBy(key)
        .orderBy("_day", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    resolved = (
        timeline.withColumn("_value", F.last("_value", ignorenulls=True).over(so_far))
        .where((F.col("_side") == 1) & F.col("_value").isNotNull())
        .select(key, F.col("_day").alias(fact_date), "_value.*")
    )
    return facts.join(resolved, [key, fact_date], "left")
