"""Fill-in-the-middle transformation by repeated-capture matching.

One ``fullmatch`` of ``(unit)*`` with the regex library keeps every repetition of the group,
so ``match.ends(1)`` lists the end of each unit: its length is the number of units, and the
two cuts are looked up in it.  Nothing iterates over the units in Python.

Draws come from the hex SHA-256 of ``seed:doc_id``: four 8-digit groups h1 to h4.  With n
units the prefix ends after the smaller of h1 % (n + 1) and h2 % (n + 1), the middle after
the larger.  A text is left plain if it is empty, holds a sentinel, or h3 % 100 is at least
``rate``; the others take suffix-prefix-middle order where h4 % 100 < ``spm_rate``, else
prefix-suffix-middle.

Defined results: null text counts as empty; a null doc_id draws with an empty id; repeated
rows draw alike and come out once each.  Texts of any length are cut whole (the match keeps
16 bytes a unit meanwhile).  A text that ``unit`` cannot tile is left plain, with n null.
Of other columns only those named in ``carry`` come along, and a result whose name one of
them has gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import lots, unclashed

#: Sentinels before prefix, suffix and middle.
SENTINELS = ("<P>", "<S>", "<M>")
CODE_POINT = r"(?s:.)"
RESULT = T.StructType([
    T.StructField("n", T.LongType()), T.StructField("form", T.StringType()),
    T.StructField("prefix_units", T.LongType()), T.StructField("middle_units", T.LongType()),
    T.StructField("output", T.StringType()),
])


def _draw(doc_id: Column, seed: int) -> Column:
    """Four unsigned 32-bit numbers that follow from seed and id."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return F.array(*[F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(4)])


def _transformed(unit: str, rate: int, spm_rate: int, sentinels: tuple[str, str, str]):
    units = regex.compile(f"({unit})*")
    p, s, m = sentinels

    def one(text: str, h: list[int]) -> tuple:
        match = units.fullmatch(text)
        if match is None:
            return None, "plain", None, None, text
        ends = match.ends(1)
        n = len(ends)
        if not n or h[2] % 100 >= rate or any(mark in text for mark in sentinels):
            return n, "plain", None, None, text
        first, second = sorted((h[0] % (n + 1), h[1] % (n + 1)))
        a, b = (ends[k - 1] if k else 0 for k in (first, second))
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h[3] % 100 < spm_rate:
            return n, "spm", first, second - first, f"{s}{suffix}{p}{prefix}{m}{middle}"
        return n, "psm", first, second - first, f"{p}{prefix}{s}{suffix}{m}{middle}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches, "_text"):
            rows = [
                one(text or "", h)
                for text, h in zip(batch.column("_text").to_pylist(), batch.column("_draw").to_pylist())
            ]
            columns = list(zip(*rows))
            kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_carried"), *[pa.array(c, k) for c, k in zip(columns, kinds)]],
                names=["_carried", *RESULT.names],
            )

    return run


def fill_in_middle(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    seed: int = 1,
    rate: int = 90,
    spm_rate: int = 20,
    unit: str = CODE_POINT,
    sentinels: tuple[str, str, str] = SENTINELS,
) -> DataFrame:
    """One row per input row: the columns ``carry``, then doc_id, n (units), form (plain, psm
    or spm), prefix_units and middle_units (null if plain) and output, the text to learn from.

    ``rate`` and ``spm_rate`` are shares in percent; ``unit`` is a pattern without groups.
    """
    source = docs.select(
        F.struct(
            F.col(doc_id).alias("_id"), F.struct(F.lit(0).alias("_none"), *[F.col(c) for c in carry]).alias("_more")
        ).alias("_carried"),
        F.col(text).alias("_text"), _draw(F.col(doc_id), seed).alias("_draw"),
    )
    schema = T.StructType([source.schema["_carried"], *RESULT.fields])
    done = source.mapInArrow(_transformed(unit, rate, spm_rate, sentinels), schema)
    return done.select(
        *[F.col("_carried._more")[c].alias(c) for c in carry],
        F.col("_carried._id").alias(unclashed(carry, "doc_id")),
        *[F.col(c).alias(unclashed(carry, c)) for c in RESULT.names],
    )


def restored(output: Column, form: Column, sentinels: tuple[str, str, str] = SENTINELS) -> Column:
    """The text that ``output`` was made from.  A text that holds a sentinel is never cut, so
    each sentinel stands once in the other forms."""
    p, s, m = (F.lit(mark) for mark in sentinels)

    def before(whole: Column, mark: Column) -> Column:
        return F.split_part(whole, mark, F.lit(1))

    def after(whole: Column, mark: Column) -> Column:
        return F.split_part(whole, mark, F.lit(2))

    middle = after(output, m)
    return (
        F.when(form == "psm", F.concat(before(after(output, p), s), middle, before(after(output, s), m)))
        .when(form == "spm", F.concat(before(after(output, p), m), middle, before(after(output, s), p)))
        .otherwise(output)
    )
