"""Near-duplicate groups by circulant MinHash, banding and exact Jaccard verification.

A document's set holds its distinct n-word shingles.  Two permutations of the numbers below
2^32 make the whole signature: s scatters the elements, and coordinate k is the least value
of p(s(x) + k mod 2^32), the second permutation shifted circularly by k.  ``rows``
coordinates make a band, and sets that agree in a band share its bucket: with 24 bands of
five, two sets of similarity 0.85 share none with a chance of 8 in 10 million.

Sets that share a bucket are compared without listing a bucket's pairs.  Each comparison is
of two sketches first, counts of a set's elements by hash: the counts of two sets differ by no
more than the sets do, so most strangers part for good at a few hundred bytes, and texts are
fetched only for pairs that may be linked, to be compared on full sets:

1. Each bucket is compared with one of its sets, its hub: as many comparisons as members.
   Those near the hub are linked to it.
2. The Jaccard distance is a metric, so two sets can only be linked if their distances to
   the hub differ by no more than a link is long.  A linked member that is nearer to the hub
   than the nearest unlinked one by more than that leaves its bucket, the hub leaves too,
   and a bucket whose sets are in one component is done.
3. Buckets that are left get a hub of their smallest component, and so on while they have
   more pairs of different components than there were entries or four times the rows, and a
   round halves these.
4. If the pairs that are left are no more than that, they are compared.  Otherwise strangers
   share buckets by a common passage.  Their sets go on to buckets of their rarest elements,
   of which linked ones share one, through the same rounds; of pairs that are left then,
   those are compared that can be linked by the places of what they share.

Equal sets are one set before this: within a task while reading, across tasks by a 128-bit
fingerprint.  Shingles are compared by 64-bit hashes.

Defined results: null or wordless text has an empty set, links with nothing and is its own
component.  With fewer than n words the whole sequence is the one shingle.  Repeated rows
have one component and come out once each.  component_id is the least doc_id of a component,
null ids aside; kept says that doc_id equals it (null equals null).  Texts of any length
count whole.  Of other columns only those named in ``carry`` come along, and a result whose
name one of them has gets underscores before it.

Limit: sets of one bucket that are close to a link but not linked, like a family whose
members are three quarters alike, are compared as far as they share rare elements.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import BROADCAST_ROWS, drop_tables, few, lots, unclashed, working_tables, written
from tallywright.llm.components import connected_components

BANDS, ROWS = 24, 5
#: Shingles whose shifted values are computed together.
BLOCK = 1 << 13
#: Bytes of words, and sets, that a task remembers; it forgets them all beyond.
CACHED_BYTES = 16 << 20
CACHED_SETS = 100_000
#: Counts in a sketch, a byte each.
CELLS = 256
#: Bytes of compressed texts whose sets a task compares together.
PACKED_BYTES = 1 << 20
#: Members of a hub for which what they are compared with gets another copy.
MEMBERS_PER_COPY = 500
#: Pairs above which texts are compared in several passes, and how many passes at most.
PASS_PAIRS, MOST_PASSES = 20_000, 6
#: Pairs that may be listed at the end, by rows.
LISTED_PER_ROW = 4
#: Of sets in open buckets one in so many, and no fewer sets than that, tell which elements are common.
TOLD_BY, LEAST_TOLD = 8, 4000
#: Elements that are known as common; others count as rare, which costs time but no link.
COMMON = 100_000

_U64 = np.uint64


class WordHashes(dict):
    """64-bit hashes of words, remembered up to ``CACHED_BYTES``."""

    held = 0

    def __missing__(self, word: bytes) -> int:
        if self.held > CACHED_BYTES:
            self.clear()
            self.held = 0
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        self.held += len(word) + 150
        return value


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> _U64(32))) * _U64(0xD6E8FEB86659FD93)
    return x ^ (x >> _U64(32))


def shingle_sets(texts: list[bytes | None], size: int, known: WordHashes) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, ASCII letters lower-cased."""
    lists = [(text or b"").lower().split() for text in texts]
    counts = np.array([len(words) for words in lists], dtype=np.int64)
    hashes = np.fromiter((known[w] for words in lists for w in words), _U64, int(counts.sum()))
    ends = np.cumsum(counts)
    total = np.zeros(len(hashes), dtype=_U64)
    for j in range(min(size, len(hashes))):
        # an odd factor by place keeps the order of the words; windows over an edge are not used
        total[: len(hashes) - j] += _spread(hashes[j:] + _U64(j + 1)) * _U64(2 * j + 0x9E3779B97F4A7C15)
    full = _spread(total)
    sets = []
    for end, n in zip(ends, counts):
        if n >= size or n == 0:
            sets.append(np.unique(full[end - n : end - size + 1] if n else full[:0]))
        else:
            short = hashes[end - n : end]
            value = sum(
                (_spread(short[j : j + 1] + _U64(j + 1)) * _U64(2 * j + 0x9E3779B97F4A7C15) for j in range(n)),
                np.full(1, n, dtype=_U64),
            )
            sets.append(_spread(value))
    return sets


def scatter(elements: np.ndarray) -> np.ndarray:
    """The first permutation: elements as numbers below 2^32, in no order of their own."""
    x = (elements ^ (elements >> _U64(32))).astype(np.uint32)
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x85EBCA6B)
    x = (x ^ (x >> np.uint32(13))) * np.uint32(0xC2B2AE35)
    return x ^ (x >> np.uint32(16))


def permute(x: np.ndarray) -> np.ndarray:
    """The second permutation of the numbers below 2^32, in place."""
    for shift, factor in ((17, 0xED5AD4BB), (11, 0xAC4C1B51), (15, 0x31848BAB)):
        x ^= x >> np.uint32(shift)
        x *= np.uint32(factor)
    x ^= x >> np.uint32(14)
    return x


def signatures(sets: list[np.ndarray], length: int) -> np.ndarray:
    """Circulant MinHash signatures of non-empty sets, a row of ``length`` coordinates each."""
    out = np.empty((len(sets), length), dtype=np.uint32)
    low = 0
    while low < len(sets):
        high, held = low + 1, len(sets[low])
        while high < len(sets) and held + len(sets[high]) <= BLOCK:
            held += len(sets[high])
            high += 1
        group = sets[low:high]
        at = np.cumsum([0] + [len(s) for s in group[:-1]])
        scattered = scatter(np.concatenate(group))
        for k in range(length):
            out[low:high, k] = np.minimum.reduceat(permute(scattered + np.uint32(k)), at)
        low = high
    return out


def band_keys(signed: np.ndarray, bands: int) -> np.ndarray:
    """A 64-bit number for each band of each signature."""
    rows = signed.shape[1] // bands
    parts = signed.reshape(len(signed), bands, rows).astype(_U64)
    keys = np.broadcast_to(np.arange(bands, dtype=_U64), parts.shape[:2]).copy()
    for r in range(rows):
        keys = _spread(keys * _U64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return keys.view(np.int64)


def sketch(elements: np.ndarray) -> bytes:
    """How many elements have each hash below ``CELLS``, 255 at most.

    Two sketches differ, cell by cell, by no more than the symmetric difference of the sets.
    """
    return np.minimum(np.bincount(elements & _U64(CELLS - 1), minlength=CELLS), 255).astype(np.uint8).tobytes()


def _named(size: int, bands: int, rows: int):
    """Row number, set size, fingerprint and, where the task meets the set first, its sketch and bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row, seen, known = TaskContext.get().partitionId() << 33, set(), WordHashes()
        for batch in lots(batches, "_text"):
            sets = shingle_sets(batch.column("_text").cast(pa.binary()).to_pylist(), size, known)
            nodes, new = [], []
            for at, elements in enumerate(sets):
                node = xxhash.xxh3_128_digest(elements.tobytes()) if len(elements) else None
                nodes.append(node)
                if node is not None and node not in seen:
                    if len(seen) > CACHED_SETS:
                        seen.clear()
                    seen.add(node)
                    new.append(at)
            found: list[np.ndarray | None] = [None] * len(sets)
            sketches: list[bytes | None] = [None] * len(sets)
            if new:
                keys = band_keys(signatures([sets[at] for at in new], bands * rows), bands)
                for at, own in zip(new, keys):
                    found[at], sketches[at] = own, sketch(sets[at])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_carried"), batch.column("_text"),
                    pa.array(np.arange(row, row + len(sets)), pa.int64()),
                    pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.binary()),
                    pa.array(sketches, pa.binary()), pa.array(found, pa.list_(pa.int64())),
                ],
                names=["_carried", "_text", "_row", "n_shingles", "_node", "_sketch", "_bands"],
            )
            row += len(sets)

    return run


def _differences(size: int):
    """Sizes of each member's set and its hub's, added up, and by how many elements they differ."""

    def sets_of(texts: pa.Array, known: WordHashes) -> list[np.ndarray]:
        # one text at a time: packed ones do not tell how long they are
        return [shingle_sets([zlib.decompress(text)], size, known)[0] for text in texts.to_pylist()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hubs, known = {}, WordHashes()
        for batch in lots(lots(batches, "_hub_text", PACKED_BYTES), "_text", PACKED_BYTES):
            names = batch.column("_hub").to_pylist()
            if len(hubs) > 200:
                hubs.clear()
            firsts = {hub: at for at, hub in enumerate(names) if hub not in hubs}
            hubs.update(zip(firsts, sets_of(batch.column("_hub_text").take(pa.array(firsts.values(), pa.int64())), known)))
            own = sets_of(batch.column("_text"), known)
            both = [len(hubs[hub]) + len(s) for hub, s in zip(names, own)]
            apart = [len(np.setxor1d(hubs[hub], s, assume_unique=True)) for hub, s in zip(names, own)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_hub"), batch.column("_row"), pa.array(both, pa.int64()), pa.array(apart, pa.int64())],
                names=["_hub", "_row", "_both", "_apart"],
            )

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with their texts compressed one by one, as shuffles hardly compress them."""
    for batch in lots(batches, "_text"):
        texts = batch.column("_text").cast(pa.binary()).to_pylist()
        packed = pa.array([zlib.compress(text, 1) for text in texts], pa.binary())
        yield pa.RecordBatch.from_arrays([batch.column("_row"), packed], names=["_row", "_text"])


def _elements(size: int):
    """All elements of each set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in lots(batches, "_text"):
            sets = shingle_sets(batch.column("_text").cast(pa.binary()).to_pylist(), size, known)
            found = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([found], names=["_elements"])

    return run


def _rarest(size: int, num: int, den: int, common: np.ndarray, times: np.ndarray):
    """The first elements of each set, rare ones before common ones: linked sets have their first common one there.

    ``common`` are sorted elements, ``times`` how often each was seen.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordHashes()
        for batch in lots(batches, "_text"):
            found = []
            for own in shingle_sets(batch.column("_text").cast(pa.binary()).to_pylist(), size, known):
                seen = np.zeros(len(own), dtype=np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, own), len(common) - 1)
                    seen[common[at] == own] = times[at[common[at] == own]]
                # elements are sorted: a stable sort orders equally frequent ones by number
                first = np.argsort(seen, kind="stable")[: len(own) * (den - num) // den + 1]
                found.append(own[first].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_row"), batch.column("_component"), batch.column("_n"), pa.array(found, pa.list_(pa.int64()))],
                names=["_row", "_component", "_n", "_elements"],
            )

    return run


def _bounds(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """By how many elements two sets differ at least, from their sketches."""

    def counts(batch: pa.RecordBatch, name: str) -> np.ndarray:
        return np.frombuffer(b"".join(batch.column(name).to_pylist()), np.uint8).reshape(-1, CELLS).astype(np.int64)

    for batch in batches:
        least = np.abs(counts(batch, "_sketch") - counts(batch, "_hub_sketch")).sum(axis=1)
        yield pa.RecordBatch.from_arrays(
            [batch.column("_hub"), batch.column("_row"), pc.add(batch.column("_n"), batch.column("_hub_n")), pa.array(least, pa.int64())],
            names=["_hub", "_row", "_both", "_apart"],
        )


def _with_hubs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Distinct (_hub, _row, ...) with the columns of ``sets`` for both, a hub's named ``_hub...``;
    these are dealt over several copies by the number of a hub's members."""
    own = [c for c in sets.columns if c != "_row"]
    copies = pairs.groupBy("_hub").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_COPY).alias("_copies"))
    members = pairs.join(copies, "_hub").withColumn("_copy", F.pmod(F.xxhash64("_row"), "_copies")).drop("_copies")
    if pairs.count() <= BROADCAST_ROWS:  # the sets then go through one shuffle, to their hubs, and not to the pairs first
        members, copies = F.broadcast(members), F.broadcast(copies)
    hubs = sets.withColumnsRenamed({"_row": "_hub"} | {c: "_hub" + c for c in own}).join(copies, "_hub").withColumn(
        "_copy", F.explode(F.sequence(F.lit(0), F.col("_copies") - 1))
    ).drop("_copies")
    return sets.join(members, "_row").join(hubs, ["_hub", "_copy"]).drop("_copy")


def _asked(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``sets`` that are in a pair."""
    rows = pairs.select("_hub").union(pairs.select("_row")).toDF("_row")
    if pairs.count() <= BROADCAST_ROWS:
        return sets.join(F.broadcast(rows), "_row", "left_semi")
    return sets.join(few(written(rows.distinct(), "asked-rows")), "_row")


def _met(pairs: DataFrame, sets: DataFrame, columns: tuple[str, ...], run, per_pass: int, name: str) -> DataFrame:
    """Distinct (_hub, _row) with both sizes added up and by how many elements the sets differ by ``run``, as a table.

    Many pairs are dealt by hub over several passes, so that what one pass compares is in a shuffle at a time.
    """
    passes, met = min(MOST_PASSES, 1 + pairs.count() // per_pass), None
    for number in range(passes):
        own = pairs.where(F.pmod(F.xxhash64("_hub"), F.lit(passes)) == number)
        found = written(
            _with_hubs(own, sets).select("_hub", "_row", *columns)
            .mapInArrow(run, "_hub long, _row long, _both long, _apart long"),
            name,
        )
        met = found if met is None else met.unionByName(found)
    return met


def _compare(pairs: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """As ``_met``, on full sets; ``texts`` are packed."""
    return _met(pairs, texts, ("_text", "_hub_text"), _differences(size), PASS_PAIRS, "compared")


def _judged(pairs: DataFrame, named: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Distinct (_hub, _row) with both sizes added up, by how many elements the sets differ and
    whether they are linked (``_near``); those whose sketches rule that out may differ by more."""
    near = (den + num) * F.col("_apart") <= (den - num) * F.col("_both")
    sketches = named.where(F.col("_sketch").isNotNull()).select("_row", "n_shingles", "_sketch")
    sketches = sketches.withColumnRenamed("n_shingles", "_n")
    bounds = _met(pairs, sketches, ("_sketch", "_hub_sketch", "_n", "_hub_n"), _bounds, max(BROADCAST_ROWS, 1), "bounds")
    maybe = bounds.where(near).select("_hub", "_row")
    texts = _asked(named.select("_row", "_text"), maybe).mapInArrow(_packed, "_row long, _text binary")
    exact = _compare(maybe, written(texts, "asked-texts"), size)
    return bounds.where(~near).unionByName(exact).withColumn("_near", near)


def _pairs_by_differences(left: DataFrame, named: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Entries (_bucket, _row, _at, _n) of buckets that hold each pair of ``left`` that can be linked.

    With all elements in one order, let e be the first that the linked x and y share.  Those of
    x before it are not in y, and x has no more than (den - num) |x| / den of them: e is
    among the first of both sets.  Rare elements come first, so that strangers with a
    passage in common share none of these.  Elements of the same sets make one bucket, in
    which ``_at`` is the first one's place; any order is right, so frequencies may be estimated.
    """
    rows = written(left.select("_row", "_component").distinct(), "open-rows")
    many = rows.count()
    texts = named.select("_row", "_text", F.col("n_shingles").alias("_n"))
    open_texts = texts.join(F.broadcast(rows) if many <= BROADCAST_ROWS else rows, "_row")
    one_in = max(1, min(TOLD_BY, many // LEAST_TOLD))
    told = written(
        open_texts.where(F.pmod(F.xxhash64("_row"), F.lit(one_in)) == 0).select("_text")
        .mapInArrow(_elements(size), "_elements array<long>")
        .select(F.explode("_elements").alias("element")).groupBy("element").agg(F.count(F.lit(1)).alias("times"))
        .where("times > 1").withColumn("level", F.floor(F.log2("times"))),
        "told-elements",
    )
    held, least = 0, None
    for level in sorted(told.groupBy("level").count().collect(), reverse=True):
        held += level["count"]
        if held > COMMON:
            break
        least = level["level"]
    often = told.where(F.col("level") >= F.lit(least)).select("element", "times").toPandas()
    common = often["element"].to_numpy(np.int64).view(_U64)
    by_number = np.argsort(common)
    times = often["times"].to_numpy(np.int64)[by_number]
    group = Window.partitionBy("_element")
    return written(
        open_texts.select("_row", "_component", "_n", "_text").mapInArrow(
            _rarest(size, num, den, common[by_number], times),
            "_row long, _component long, _n long, _elements array<long>",
        )
        .select("_row", "_component", "_n", F.posexplode("_elements").alias("_at", "_element"))
        .withColumns({
            "_least": F.min("_row").over(group), "_rows": F.count(F.lit(1)).over(group),
            "_mixed": F.min("_component").over(group) < F.max("_component").over(group),
            "_all": F.bit_xor(F.xxhash64("_row")).over(group),
        })
        .where("_mixed")
        .groupBy(F.xxhash64("_least", "_rows", "_all").alias("_bucket"), "_row")
        .agg(F.min("_at").cast("long").alias("_at"), F.first("_n").alias("_n")),
        "rarest-elements",
    )


def _placed_pairs(left: DataFrame, rare: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of one bucket of ``rare`` and of different components that can be linked by their places there.

    x and y share num (|x| + |y|) / (num + den) elements or more, so that no more than
    (den |x| - num |y|) / (num + den) of x come before the first that they share.
    """
    placed = written(left.join(rare, ["_bucket", "_row"]).select("_bucket", "_row", "_component", "_at", "_n"), "placed")
    x, y, c = placed.alias("x"), placed.alias("y"), F.col
    within = lambda a, b: (num + den) * c(f"{a}._at") <= den * c(f"{a}._n") - num * c(f"{b}._n")
    return x.join(
        y,
        (c("x._bucket") == c("y._bucket")) & (c("x._row") < c("y._row")) & (c("x._component") != c("y._component"))
        & within("x", "y") & within("y", "x"),
    ).select(c("x._row").alias("_hub"), c("y._row").alias("_row")).distinct()


def _listed_pairs(left: DataFrame) -> DataFrame:
    """Pairs of one bucket and of different components."""
    x, y, c = left.alias("x"), left.alias("y"), F.col
    return x.join(
        y, (c("x._bucket") == c("y._bucket")) & (c("x._row") < c("y._row")) & (c("x._component") != c("y._component"))
    ).select(c("x._row").alias("_hub"), c("y._row").alias("_row")).distinct()


def _least_hubs(entries: DataFrame) -> tuple[DataFrame, int]:
    """Each bucket's least row as its hub, and how many pairs the buckets hold."""
    hubs = written(entries.groupBy("_bucket").agg(F.min("_row").alias("_hub"), F.count(F.lit(1)).alias("_n")), "least-hubs")
    pairs = hubs.agg(F.sum(F.col("_n") * (F.col("_n") - 1) / 2)).first()[0]
    return hubs.select("_bucket", "_hub"), pairs or 0


def _links(entries: DataFrame, named: DataFrame, size: int, num: int, den: int) -> DataFrame:
    """Components (node, component) of the rows of buckets; entries are (_bucket, _row).

    ``named`` has ``_row``, ``_text``, ``n_shingles`` and ``_sketch`` of all these rows.
    """
    reach = (den - num) / den + 1e-9
    ends = F.col("_hub").alias("a"), F.col("_row").alias("b")
    allowed, rare, edges = max(entries.count(), LISTED_PER_ROW * named.count()), None, None
    hubs, last = _least_hubs(entries)
    while True:
        placed = entries.join(few(hubs), "_bucket").where("_row <> _hub")
        seen = _judged(written(placed.select("_hub", "_row").distinct(), "hub-pairs"), named, size, num, den)
        found = seen.where("_near").select(*ends)
        edges = written(found if edges is None else edges.unionByName(found), "links")
        components = connected_components(edges)
        # who may still have a link in the bucket
        distances = seen.select(
            # the distance, or less for sets that are not linked
            "_hub", "_row", (2 * F.col("_apart") / (F.col("_both") + F.col("_apart"))).alias("_far"), "_near"
        )
        far = placed.select("_bucket", "_hub", "_row").join(few(distances), ["_hub", "_row"])
        gap = far.where("not _near").groupBy("_bucket").agg(F.min("_far").alias("_gap"))
        left = written(
            far.join(F.broadcast(gap) if hubs.count() <= BROADCAST_ROWS else gap, "_bucket")
            .where(~F.col("_near") | (F.col("_far") >= F.col("_gap") - reach))
            .join(few(components.select(F.col("node").alias("_row"), "component")), "_row", "left")
            .select("_bucket", "_hub", "_row", "_far", F.coalesce("component", "_row").alias("_component")),
            "left-entries",
        )
        parts = left.groupBy("_bucket", "_component").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
        hubs = written(
            parts.groupBy("_bucket").agg(
                F.min_by("_first", F.struct("_n", "_first")).alias("_hub"),
                F.sum("_n").alias("_all"), F.sum(F.col("_n") * F.col("_n")).alias("_squares"),
            ).where("_squares < _all * _all"),
            "open-hubs",
        )
        pairs = hubs.agg(F.sum((F.col("_all") * F.col("_all") - F.col("_squares")) / 2)).first()[0]
        if not pairs:
            return components
        left = left.join(few(hubs.select("_bucket")), "_bucket")
        if rare is None and pairs <= allowed:
            rest = _listed_pairs(left)
            break
        if pairs <= allowed or 2 * pairs > last:
            if rare is not None:
                rest = _placed_pairs(left, rare, num, den)
                break
            rare = _pairs_by_differences(left, named, size, num, den)
            entries = rare.select("_bucket", "_row")
            hubs, last = _least_hubs(entries)
            if not last:
                return components
            continue
        entries, hubs, last = left.select("_bucket", "_row"), hubs.select("_bucket", "_hub"), pairs
    seen = _judged(written(rest, "rest"), named, size, num, den)
    return connected_components(edges.unionByName(seen.where("_near").select(*ends)))


def circulant_minhash(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    size: int = 5,
    threshold: tuple[int, int] = (85, 100),
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """One row per input row: the columns ``carry``, then doc_id, n_shingles, component_id, kept.

    Documents whose sets share a band link when intersection / union is at least
    ``threshold`` (a fraction).  Lower thresholds ask for more ``bands`` or fewer ``rows``.
    """
    num, den = threshold
    more = [F.col(c) for c in carry if c != text]
    source = docs.select(
        F.struct(F.col(doc_id).alias("_id"), F.struct(F.lit(0).alias("_none"), *more).alias("_more")).alias("_carried"),
        F.col(text).alias("_text"),
    )
    schema = T.StructType([
        *source.schema.fields, T.StructField("_row", T.LongType()), T.StructField("n_shingles", T.LongType()),
        T.StructField("_node", T.BinaryType()), T.StructField("_sketch", T.BinaryType()),
        T.StructField("_bands", T.ArrayType(T.LongType())),
    ])
    named = written(source.mapInArrow(_named(size, bands, rows), schema), "minhash-named")
    classes = written(
        named.where(F.col("_node").isNotNull()).groupBy("_node").agg(
            # a class is named by the first row that is a head in its task
            F.min(F.when(F.col("_bands").isNotNull(), F.col("_row"))).alias("_class"),
            F.min("_carried._id").alias("_least"),
        ),
        "minhash-classes",
    )
    heads = named.where(F.col("_bands").isNotNull()).select("_row", "_node", "_bands")
    twins = written(  # heads of one class in several tasks
        heads.select("_row", "_node").join(classes.select("_node", "_class"), "_node").where("_row <> _class").select("_row"),
        "minhash-twins",
    )
    bucketed = heads.join(few(twins), "_row", "left_anti").select(F.explode("_bands").alias("_bucket"), "_row")
    shared = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("_bucket")
    with working_tables() as made:
        entries = written(bucketed.join(shared, "_bucket"), "bucket-entries")
        linked = _links(entries, named, size, num, den)
    components = written(linked, "minhash-components")
    drop_tables(docs.sparkSession, made)
    placed = classes.join(
        components.select(F.col("node").alias("_class"), "component"), "_class", "left"
    ).withColumn("component", F.coalesce("component", "_class"))
    least = placed.groupBy("component").agg(F.min("_least").alias("component_id"))
    # copies of a set meet their answer by its fingerprint; rows without one are answered alone
    answer = placed.join(least, "component").select("_node", "component_id")
    held = named.drop("_bands", "_sketch", *([] if text in carry else ["_text"]))
    told = held.where(F.col("_node").isNotNull()).join(answer, "_node").unionByName(
        held.where(F.col("_node").isNull()).withColumn("component_id", F.col("_carried._id"))
    )

    def own(column: str) -> Column:
        return (F.col("_text") if column == text else F.col("_carried._more")[column]).alias(column)

    results = {
        "doc_id": F.col("_carried._id"), "n_shingles": F.col("n_shingles"), "component_id": F.col("component_id"),
        "kept": F.col("_carried._id").eqNullSafe(F.col("component_id")),
    }
    return told.select(*map(own, carry), *[value.alias(unclashed(carry, name)) for name, value in results.items()])
