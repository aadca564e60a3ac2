"""Line deduplication by site-relative frequency.

A line is boilerplate of a host if the share of the host's pages that hold it exceeds
``max_ratio`` and at least ``min_pages`` do: two, as a line on one page alone repeats nothing.  Counts are summed per host and line before
they are shuffled.  A host has at most (distinct lines per page) / max_ratio such lines, so
its list of line hashes is short; it is joined to the host's pages, salted by row, and each page
is filtered in place.  Texts are not regrouped.

Defined results: lines end at \\n and are compared without outer white space, by 64-bit
hash; blank lines neither count nor go.  A null text stays null, a text that loses all its
lines becomes empty.  Null hosts form one host.  Repeated rows count as pages of their own.
Other columns pass through; ``n_lines`` and ``n_dropped`` are added and take underscores
where the input already has such names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import free_name, written

SALTS = 16
BLANK = " \t\n\x0b\x0c\r"


def _key(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANK)))


def _filled(text: Column) -> Column:
    """The lines of a text that are not blank."""
    lines = F.split(F.coalesce(text, F.lit("")), "\n")
    return F.filter(lines, lambda line: F.btrim(line, F.lit(BLANK)) != "")


def boilerplate(pages: DataFrame, host: str, text: str, max_ratio: float, min_pages: int) -> DataFrame:
    """(_host, _known, _lines): per host the hashes of its boilerplate lines."""
    rows = pages.select(
        F.col(host).cast("string").alias("_host"), F.col(text).alias("_text")
    ).select(
        F.coalesce("_host", F.lit("")).alias("_host"), F.col("_host").isNotNull().alias("_known"), "_text"
    )
    totals = rows.groupBy("_host", "_known").agg(F.count(F.lit(1)).alias("_pages"))
    counts = (
        rows.select(
            "_host", "_known",
            F.explode(F.array_distinct(F.transform(_filled(F.col("_text")), _key))).alias("_line"),
        )
        .groupBy("_host", "_known", "_line").agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") >= min_pages)
    )
    often = counts.join(totals, ["_host", "_known"]).where(F.col("_n") > max_ratio * F.col("_pages"))
    return often.groupBy("_host", "_known").agg(F.array_sort(F.collect_list("_line")).alias("_lines"))


def line_dedup(
    pages: DataFrame,
    *,
    host: str = "source",
    text: str = "text",
    max_ratio: float = 0.1,
    min_pages: int = 2,
) -> DataFrame:
    """``pages`` with boilerplate lines taken out of ``text``, plus n_lines and n_dropped."""
    lists = written(boilerplate(pages, host, text, max_ratio, min_pages), "boilerplate")
    salted = lists.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    n_lines, n_dropped = free_name(pages, "n_lines"), free_name(pages, "n_dropped")
    # the caller's columns travel in a struct, so that their names cannot clash
    rows = pages.select(
        F.struct(*pages.columns).alias("_page"),
        F.coalesce(F.col(host).cast("string"), F.lit("")).alias("_host"),
        F.col(host).isNotNull().alias("_known"),
        F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int").alias("_salt"),
    )
    joined = rows.join(salted, ["_host", "_known", "_salt"], "left")
    body = F.col("_page")[text]
    often = lambda line: F.array_contains(F.col("_lines"), _key(line)) & (
        F.btrim(line, F.lit(BLANK)) != ""
    )
    kept = F.when(F.col("_lines").isNull(), body).otherwise(
        F.array_join(F.filter(F.split(body, "\n"), lambda line: ~often(line)), "\n")
    )
    dropped = F.when(F.col("_lines").isNull(), F.lit(0)).otherwise(
        F.size(F.filter(F.split(F.coalesce(body, F.lit("")), "\n"), often))
    )
    return joined.select(
        *[(kept if c == text else F.col("_page")[c]).alias(c) for c in pages.columns],
        F.size(_filled(body)).cast("long").alias(n_lines),
        dropped.cast("long").alias(n_dropped),
    )
