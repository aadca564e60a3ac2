"""Exact deduplication by Grace hashing.

1. Each task streams its rows through an open-addressing table and writes every row
   once, with the text only where the task meets it first (a head).  A text that a
   third of all rows share leaves a task as one head, so no later step is hot.
2. Heads are dealt into buckets by their hash.  Buckets whose distinct bytes exceed
   ``bucket_bytes`` are dealt again by another hash into the next level's spill
   table, until every bucket fits or holds one text.  Spill tables lie in the shared
   work folder.
3. Buckets stream through one open-addressing table at a time, which compares
   complete contents; each head learns the first head of its text.
4. Groups are summed per head, then per text, and joined back on the head, of which a
   task's rows are the only users.

Defined results: null text counts as empty, and so equals it.  One result row per
input row, repeated rows too.  The largest doc_id of a group stays (null below all);
among rows that repeat it the one read first.  Columns beside id and text are only
carried where ``carry`` names them, so clashing names cannot occur.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import written

RESULT = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


class ContentTable:
    """Open addressing with linear probing; equal hashes are settled by complete contents."""

    def __init__(self, most_bytes: int | None = None):
        self.most_bytes = most_bytes
        self.clear()

    def clear(self) -> None:
        self.slots = np.full(1024, -1, dtype=np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.keys: list[int] = []
        self.bytes = 0

    def first(self, hashed: int, content: bytes, key: int) -> int:
        """Key of the first record with this content; the record is added if it is new."""
        if self.most_bytes is not None and self.bytes > self.most_bytes:
            self.clear()
        if 10 * len(self.keys) > 6 * len(self.slots):
            self._grow()
        mask = len(self.slots) - 1
        at = hashed & mask
        while (entry := self.slots[at]) >= 0:
            if self.hashes[entry] == hashed and self.contents[entry] == content:
                return self.keys[entry]
            at = (at + 1) & mask
        self.slots[at] = len(self.keys)
        self.hashes.append(hashed)
        self.contents.append(content)
        self.keys.append(key)
        self.bytes += len(content) + 200
        return key

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, dtype=np.int64)
        mask = len(self.slots) - 1
        for entry, hashed in enumerate(self.hashes):
            at = hashed & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def _heads_of_task(table_bytes: int):
    """Row id, head and digest of each row; the text where the row is its head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = ContentTable(table_bytes)
        row = TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column("_text").cast(pa.binary()).to_pylist()
            rows, heads, hashes, digests, kept = [], [], [], [], []
            for content in texts:
                hashed = xxhash.xxh3_64_intdigest(content)
                head = table.first(hashed, content, row)
                rows.append(row)
                heads.append(head)
                hashes.append(hashed - (1 << 63))
                digests.append(hashlib.sha256(content).hexdigest())
                kept.append(content if head == row else None)
                row += 1
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_carried"), pa.array(rows, pa.int64()), pa.array(heads, pa.int64()),
                    pa.array(hashes, pa.int64()), pa.array(digests, pa.string()),
                    pa.array(kept, pa.binary()),
                ],
                names=["_carried", "_row", "_head", "_hash", "text_sha256", "_content"],
            )

    return run


def _match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """First head of each head's text.  Rows come sorted by bucket; a table holds one bucket."""
    table, bucket = ContentTable(), None
    for batch in batches:
        keys = batch.column("_row").to_pylist()
        firsts = []
        for key, at, hashed, content in zip(
            keys, batch.column("_bucket").to_pylist(), batch.column("_hash").to_pylist(),
            batch.column("_content").to_pylist(), strict=True,
        ):
            if at != bucket:
                table.clear()
                bucket = at
            firsts.append(table.first(hashed + (1 << 63), content, key))
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(firsts, pa.int64())], names=["_head", "_first"]
        )


def _bucketed(heads: DataFrame, bucket_bytes: int, fan_out: int) -> tuple[DataFrame, int]:
    """Heads with the bucket they end in, and the number of first buckets, which follows the data.

    Oversize buckets go on to the next level's spill table.
    """
    sizes = heads.select("_hash", F.length("_content").alias("n"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    parts = max(1, -(-2 * total // bucket_bytes))
    level, done = 0, None
    rest = heads.withColumn("_bucket", F.array(F.pmod("_hash", F.lit(parts))))
    while True:
        distinct = rest.groupBy("_bucket", "_hash").agg(F.max(F.length("_content")).alias("n"))
        large = (
            distinct.groupBy("_bucket").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"))
            .where((F.col("n") > bucket_bytes) & (F.col("k") > 1)).select("_bucket")
        )
        if large.isEmpty():
            return (rest if done is None else done.unionByName(rest)), parts
        large = written(large, f"grace-large-{level}")
        fits = rest.join(large, "_bucket", "left_anti")
        done = fits if done is None else done.unionByName(fits)
        level += 1
        again = F.pmod(F.xxhash64(F.lit(level), "_hash"), F.lit(fan_out))
        rest = written(
            rest.join(large, "_bucket", "left_semi").withColumn(
                "_bucket", F.concat("_bucket", F.array(again))
            ),
            f"grace-spill-{level}",
        )


def exact_dedup(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    bucket_bytes: int = 64 << 20,
    fan_out: int = 16,
) -> DataFrame:
    """One row per input row: the columns ``carry``, then doc_id, keep_id, group_size, kept,
    text_sha256.  A bucket's distinct texts take at most ``bucket_bytes`` of a task's memory.
    """
    source = docs.select(
        F.struct(F.col(doc_id).alias("_id"), F.struct(F.lit(0).alias("_none"), *carry).alias("_more")).alias("_carried"),
        F.coalesce(F.col(text), F.lit("")).alias("_text"),
    )
    schema = T.StructType([
        source.schema["_carried"], T.StructField("_row", T.LongType()), T.StructField("_head", T.LongType()),
        T.StructField("_hash", T.LongType()), T.StructField("text_sha256", T.StringType()),
        T.StructField("_content", T.BinaryType()),
    ])
    rows = written(source.mapInArrow(_heads_of_task(bucket_bytes), schema), "grace-rows")
    heads = rows.where(F.col("_content").isNotNull()).select("_row", "_hash", "_content")
    bucketed, parts = _bucketed(heads, bucket_bytes, fan_out)
    tasks = max(parts, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    firsts = (
        bucketed.repartition(tasks, "_bucket").sortWithinPartitions("_bucket")
        .mapInArrow(_match, "_head long, _first long")
    )
    light = rows.select("_carried", "_row", "_head", "text_sha256")
    best = F.max(F.struct(F.col("_carried._id").alias("id"), (-F.col("_row")).alias("row")))
    per_head = light.groupBy("_head").agg(best.alias("best"), F.count(F.lit(1)).alias("n"))
    per_head = written(per_head.join(firsts, "_head"), "grace-heads")
    groups = per_head.groupBy("_first").agg(F.max("best").alias("_best"), F.sum("n").alias("group_size"))
    answer = per_head.select("_head", "_first").join(groups, "_first").drop("_first")
    return light.join(answer, "_head").select(
        *[F.col("_carried._more")[c].alias(c) for c in carry],
        F.col("_carried._id").alias("doc_id"),
        F.col("_best.id").alias("keep_id"),
        "group_size",
        (F.col("_row") == -F.col("_best.row")).alias("kept"),
        "text_sha256",
    )
