"""Jaccard self-join of word n-gram sets by PartEnum signatures.

Sets are put into size bands; two similar sets lie in one band or in neighbouring ones, and
differ in at most k elements, k following from the band's largest size.  Elements are dealt
by hash into parts of three sub-parts each, more than k / 2 parts: some part differs in at
most one element, so all but one of its sub-parts agree, and each choice of these is a
signature.

A choice may hold no element of a set, which tells nothing and would be shared by strangers.
Bands have e more parts than they need, so that similar sets share signatures in e + 1
parts.  A set in which no more than e parts have such an empty choice leaves the empty ones
out, and still has a signature in common with each similar set; only sets with more of them
use theirs, and meet each other there.

The sets that share signatures with the same least set are a bucket.  Buckets are compared
with hubs in place of pairs (``circulant_minhash``, steps 1 to 4), so that a
group of near copies costs its size.  No link is lost: all follows from the definition, with
no cap and no chance but equal 64-bit hashes.

Equal sets collapse before: within a task while reading, across tasks by a fingerprint.

Defined results: null or wordless text has an empty set and is alone, with ``kept`` true.
With fewer than n words the whole sequence is the one shingle.  Repeated rows have one
class; the row of the smallest doc_id, then the first read, is the one ``kept``.  Texts of
any length count whole.  Of other columns only those named in ``carry`` come along, and a
result whose name one of them has gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.circulant_minhash import WordHashes, shingle_sets, sketch
from tallywright.llm.circulant_minhash import _links as links_in_buckets
from tallywright.llm.common import drop_tables, few, lots, unclashed, working_tables, written

#: Set fingerprints that a task remembers; it forgets them all beyond.
CACHED = 100_000
#: Elements, counted once for each of a set's two bands, above which signatures are dealt in several passes
#: by size, so that those of one pass are on disk at a time, and how many passes at most: each reads all texts.
PASS_ELEMENTS, MOST_PASSES = 20_000_000, 6


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, size: int) -> np.ndarray:
    """Sorted distinct hashes of the word n-grams, ASCII letters lower-cased."""
    return shingle_sets([text], size, WordHashes())[0]


@lru_cache
def bands(num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest size of each band and the most elements by which similar sets in it differ."""
    tops, low = [], 1
    while low < 1 << 40:
        tops.append(low * den // num)
        low = tops[-1] + 1
    return np.array(tops), np.array([2 * top * (den - num) // (den + num) for top in tops])


@lru_cache
def parts_of(top: int, k: int, sub: int) -> tuple[int, int]:
    """Parts of a band, and how many of them may have an empty choice."""
    needed, spare = (k + 2) // 2, 0
    for _ in range(20):
        parts = needed + spare
        # choices of one part that a set near the band's top leaves empty
        empty = parts * sub * np.exp(-top * (sub - 1) / (parts * sub))
        asked = int(empty + 2 * np.sqrt(empty)) if empty >= 0.1 else 0
        if asked <= spare:
            break
        spare = min(asked, needed)
    return needed + spare, spare


def signatures(
    elements: np.ndarray, num: int, den: int, sub: int = 3, first_band: int = 0, last_band: int = 1 << 30
) -> np.ndarray:
    """PartEnum signatures of a set for its own size band and the next one, as far as these are asked for.

    48 bits each: chance agreements only make buckets, whose links are verified.
    """
    tops, most = bands(num, den)
    own = int(np.searchsorted(tops, len(elements)))
    spread = mix(elements + np.uint64(0x5851F42D4C957F2D))
    content = mix(elements ^ np.uint64(0xA0761D6478BD642F))
    found = []
    for band in (own, own + 1):
        if not first_band <= band <= last_band:
            continue
        k = int(most[band])
        if k == 0:
            parts = content.sum(dtype=np.uint64).reshape(1, 1)
            told = np.ones(1, dtype=bool)
        else:
            first, spare = parts_of(int(tops[band]), k, sub)
            cells = np.zeros(first * sub, dtype=np.uint64)
            at = ((spread % np.uint64(first)) * np.uint64(sub) + (spread >> np.uint64(40)) % np.uint64(sub)).astype(np.int64)
            np.add.at(cells, at, content)
            cells = cells.reshape(first, sub)
            parts = cells.sum(axis=1, keepdims=True, dtype=np.uint64) - cells
            counts = np.bincount(at, minlength=first * sub).reshape(first, sub)
            filled = counts.sum(axis=1, keepdims=True) > counts
            told = filled.reshape(-1)
            if first - int(filled.all(axis=1).sum()) > spare:
                told = np.ones(first * sub, dtype=bool)
        label = mix(np.arange(parts.size, dtype=np.uint64) + np.uint64(band << 40))
        found.append(mix(parts.reshape(-1) + label)[told])
    if not found:
        return np.empty(0, dtype=np.int64)
    return (np.concatenate(found) >> np.uint64(16)).view(np.int64)


def band_ranges(elements: dict[int, int], num: int, den: int) -> list[tuple[int, int]]:
    """First and last band of each pass over the signatures; ``elements`` has how many there are by set size.

    Passes hold about equally many elements of whole bands, a set's counting in its own band and in the next.
    """
    sizes = np.array(sorted(elements), dtype=np.int64)
    own = np.searchsorted(bands(num, den)[0], sizes)
    held = np.zeros(int(own.max(initial=0)) + 2, dtype=np.int64)
    for step in (0, 1):
        np.add.at(held, own + step, [elements[n] for n in sizes.tolist()])
    passes = min(MOST_PASSES, 1 + int(held.sum()) // PASS_ELEMENTS)
    # the pass of each band by the middle of its elements
    dealt = ((np.cumsum(held) - held / 2) * passes / max(int(held.sum()), 1)).astype(np.int64).clip(0, passes - 1)
    filled = np.flatnonzero(held)
    return [
        (int(at.min()), int(at.max()))
        for number in range(passes) if len(at := filled[dealt[filled] == number])
    ]


def _signed(size: int, num: int, den: int, sub: int, first_band: int, last_band: int):
    """Row and signatures for the bands asked for of each head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in lots(batches, "_text"):
            sets = shingle_sets(batch.column("_text").cast(pa.binary()).to_pylist(), size, known)
            found = [signatures(s, num, den, sub, first_band, last_band) for s in sets]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), pa.array(found, pa.list_(pa.int64()))], names=["_row", "_signatures"]
            )

    return run


def _named(size: int):
    """Row number, set size, fingerprint, whether the task meets the set first (a head), and heads' sketches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, seen, known = TaskContext.get().partitionId() << 33, set(), WordHashes()
        for batch in lots(batches, "_text"):
            sets = shingle_sets(batch.column("_text").cast(pa.binary()).to_pylist(), size, known)
            nodes, heads = [], []
            for elements in sets:
                node = xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None
                new = node is not None and node not in seen
                if new:
                    if len(seen) > CACHED:
                        seen.clear()
                    seen.add(node)
                nodes.append(node)
                heads.append(new)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_carried"), batch.column("_text"),
                    pa.array(np.arange(row, row + len(sets)), pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                    pa.array(heads, pa.bool_()),
                    pa.array([sketch(s) if head else None for s, head in zip(sets, heads)], pa.binary()),
                ],
                names=["_carried", "_text", "_row", "n_shingles", "_node", "_head", "_sketch"],
            )
            row += len(sets)

    return run


def _components(named: DataFrame, classes: DataFrame, size: int, num: int, den: int, sub: int) -> DataFrame:
    """(node, component) of the classes that have a link."""
    same = Window.partitionBy("_signature")
    heads = named.where("_head")
    twins = written(  # heads of one class in several tasks
        heads.select("_row", "_node").join(classes.select("_node", "_class"), "_node")
        .where("_row <> _class").select("_row", "_class"),
        "twins",
    )
    # at most as many sizes as the root of twice all elements
    elements = {n: n * sets for n, sets in heads.groupBy("n_shingles").count().collect()}
    tops, shared = bands(num, den)[0], None
    for first, last in band_ranges(elements, num, den):
        smallest = int(tops[first - 2]) + 1 if first > 1 else 1
        found = written(
            # signatures are many times the rows: they go straight into the shuffle, never to a table
            heads.where(F.col("n_shingles").between(smallest, int(tops[last]))).select("_row", "_text")
            .mapInArrow(_signed(size, num, den, sub, first, last), "_row long, _signatures array<long>")
            .select("_row", F.explode("_signatures").alias("_signature"))
            .withColumns({"_bucket": F.min("_row").over(same), "_sets": F.count(F.lit(1)).over(same)})
            .where("_sets > 1").select("_bucket", "_row").distinct(),
            "shared-in-pass",
        )
        shared = found if shared is None else shared.unionByName(found)
    if shared is None:
        shared = heads.select(F.col("_row").alias("_bucket"), "_row").limit(0)
    for name in ("_row", "_bucket"):
        twin = twins.select(F.col("_row").alias(name), F.col("_class").alias("_to"))
        shared = shared.join(twin, name, "left").withColumn(name, F.coalesce("_to", name)).drop("_to")
    return links_in_buckets(written(shared.distinct(), "shared-signatures"), named, size, num, den)


def ngram_jaccard_join(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    size: int = 5,
    threshold: tuple[int, int] = (8, 10),
    sub_parts: int = 3,
) -> DataFrame:
    """One row per input row: the columns ``carry``, then doc_id, n_shingles, component_id, kept.

    Documents link when intersection / union of their sets of ``size``-word shingles is at
    least ``threshold`` (a fraction); component_id is the smallest doc_id reachable.  Fewer
    ``sub_parts`` make fewer, less telling signatures; results are the same.
    """
    num, den = threshold
    more = [F.col(c) for c in carry if c != text]
    source = docs.select(
        F.struct(F.col(doc_id).alias("_id"), F.struct(F.lit(0).alias("_none"), *more).alias("_more")).alias("_carried"),
        F.col(text).alias("_text"),
    )
    schema = T.StructType([
        *source.schema.fields, T.StructField("_row", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("_node", T.BinaryType()), T.StructField("_head", T.BooleanType()),
        T.StructField("_sketch", T.BinaryType()),
    ])
    named = written(source.mapInArrow(_named(size), schema), "named-sets")
    classes = written(
        named.where(F.col("_node").isNotNull()).groupBy("_node").agg(
            # a class is named by the first row that is a head in its task
            F.min(F.when(F.col("_head"), F.col("_row"))).alias("_class"),
            F.count(F.lit(1)).alias("_rows"), F.min("_carried._id").alias("_least_id"),
            F.min(F.struct(F.col("_carried._id").alias("id"), F.col("_row").alias("row"))).alias("_first"),
        ),
        "classes",
    )
    with working_tables() as made:
        linked = _components(named, classes, size, num, den, sub_parts)
    linked = written(linked, "components")
    drop_tables(docs.sparkSession, made)
    joined = classes.join(linked.withColumnRenamed("node", "_class"), "_class", "left").withColumn(
        "component", F.coalesce("component", "_class")
    )
    groups = joined.groupBy("component").agg(
        F.min("_least_id").alias("component_id"), F.min("_first").alias("_first"), F.sum("_rows").alias("_rows")
    ).where("_rows > 1")
    answer = joined.select("_node", "component").join(groups, "component").select("_node", "component_id", "_first")
    answers = written(
        named.select("_row", "_node").join(answer, "_node")
        .select("_row", "component_id", (F.col("_row") == F.col("_first.row")).alias("_kept")),
        "answers",
    )
    # rows alone in their component, or without a set, are no part of the answers: whole rows stay where they are
    rows = named.select("_carried", *(["_text"] if text in carry else []), "_row", "n_shingles")
    told = rows.join(few(answers), "_row", "left")
    results = {
        "doc_id": F.col("_carried._id"), "n_shingles": F.col("n_shingles"),
        "component_id": F.when(F.col("_kept").isNull(), F.col("_carried._id")).otherwise(F.col("component_id")),
        "kept": F.coalesce("_kept", F.lit(True)),
    }
    return told.select(
        *[(F.col("_text") if n == text else F.col("_carried._more")[n]).alias(n) for n in carry],
        *[value.alias(unclashed(carry, name)) for name, value in results.items()],
    )
