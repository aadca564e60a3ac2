"""Packing of documents into sequences: shortest pack first over the histogram of lengths.

Tokens are counted and cut in one pass over the texts; a row per piece remains.  The
histogram has at most ``max_tokens`` bars, so placing works on it alone: lengths longest
first, each into the packs that are shortest so far, in groups of equal packs
(a pattern and its count).  Pieces then find their place by their rank among the pieces
of equal length.

Bounds: a length splits at most one group and opens at most two, so there are at most
3 * max_tokens patterns; distinct lengths in one pack sum to at most max_tokens, so a
pattern has at most sqrt(2 * max_tokens) runs.  That is all the driver and the tasks hold.

Defined results: null text counts as empty; an empty document is the end id alone.  Each
input row is a document of its own, also where rows repeat.  Ranks follow doc_id, start
and the order of reading, so results do not depend on where tasks run.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import lots, written

#: Bytes of words and of their parts that a generation of a task's memory holds.
WORD_BYTES, PART_BYTES = 96 << 20, 64 << 20
_encoders: dict[str, WordEncoder] = {}


class Recent:
    """A memory of codes in two generations: a full one ages, and forgets what was aged.

    What is asked for again moves to the young one, so frequent words stay and rare ones go,
    whatever their number; the bound is in bytes, as words may be long.
    """

    def __init__(self, most_bytes: int):
        self.most, self.held = most_bytes, 0
        self.young: dict = {}
        self.aged: dict = {}

    def turn(self) -> None:
        if self.held > self.most:
            self.aged, self.young, self.held = self.young, {}, 0

    def add(self, codes: dict) -> None:
        self.young.update(codes)
        self.held += 2 * sum(map(len, codes)) + sum(map(len, codes.values())) + 180 * len(codes)

    def unknown(self, keys: set) -> list:
        """Those of the keys that are in neither generation; aged ones are young again."""
        again = {key: self.aged[key] for key in keys if key in self.aged}
        self.add(again)
        return list(keys.difference(again))


class WordEncoder:
    """Ids of a text as little-endian 32-bit numbers, word by word.

    The tokenizer never joins across ASCII white space, so a text's ids are those of its
    words one after another, and a word is encoded once while it is remembered.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.words, self.cores = Recent(WORD_BYTES), Recent(PART_BYTES)

    @staticmethod
    def _parts(word: bytes) -> tuple[str, ...]:
        """A word's pieces that are encoded apart: letters and a stop behind them."""
        if not word:
            return ()
        if b"<|" in word:  # may be a special token, whose letter case counts
            return (word.decode(),)
        text = word.lower().decode()
        if text[-1] in ".,":
            core = text[:-1]
            if core.isalpha() and (core.isascii() or max(core) < "ɐ"):
                return core, text[-1]
        return (text,)

    def learn(self, missing: list[bytes]) -> None:
        self.cores.turn()
        parts = [self._parts(word) for word in missing]
        young = self.cores.young
        fresh = self.cores.unknown(set(chain.from_iterable(parts)).difference(young))
        coded = self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)
        self.cores.add({p: array("I", code.ids).tobytes() for p, code in zip(fresh, coded, strict=True)})
        self.words.add({
            word: young[each[0]] if len(each) == 1 else b"".join(map(young.__getitem__, each))
            for word, each in zip(missing, parts, strict=True)
        })

    def _codes(self, words: list[bytes]) -> list[bytes]:
        """The ids of distinct words; those that are not remembered are learned."""
        self.words.turn()
        known = self.words.young
        missing = [word for word in words if word not in known]
        self.learn(self.words.unknown(set(missing)))
        return list(map(known.__getitem__, words))

    def encode(self, texts: pa.Array) -> list[np.ndarray]:
        """Ids of each text: a lot's distinct words are looked up once, then gathered."""
        split = pc.ascii_split_whitespace(texts)
        words = split.values.cast(pa.binary()).dictionary_encode()
        codes = self._codes(words.dictionary.to_pylist())
        sizes = np.fromiter(map(len, codes), dtype=np.int64, count=len(codes)) // 4
        flat = np.frombuffer(b"".join(codes), dtype="<u4")
        at = words.indices.to_numpy(zero_copy_only=False)
        each = sizes[at]
        ends = np.concatenate([[0], np.cumsum(each)])
        # a token's place in ``flat``: its word's first one there, and its place in the word
        shift = (np.cumsum(sizes) - sizes)[at] - ends[:-1]
        ids = flat[np.arange(ends[-1]) + np.repeat(shift, each)]
        borders = ends[split.offsets.to_numpy(zero_copy_only=False)]
        return [ids[low:high] for low, high in zip(borders[:-1].tolist(), borders[1:].tolist(), strict=True)]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _pieces(tokenizer: str, end_id: int, max_tokens: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, end = encoder(tokenizer), np.array([end_id], dtype="<u4").tobytes()
        row = TaskContext.get().partitionId() << 33
        width = 4 * max_tokens
        for batch in lots(batches, "_text", 8 << 20):
            source, out = [], []
            for at, found in enumerate(code.encode(batch.column("_text"))):
                ids = found.tobytes() + end
                tokens = len(ids) // 4
                for start in range(0, len(ids), width):
                    piece = ids[start : start + width]
                    source.append(at)
                    out.append((
                        row, start // 4, len(piece) // 4, zlib.crc32(piece), tokens,
                        piece if with_ids else None,
                    ))
                row += 1
            columns = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id").take(pa.array(source, pa.int64()))]
                + [pa.array(c, pa.int64()) for c in columns[:5]]
                + [pa.array(columns[5], pa.binary())],
                names=["doc_id", "_row", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )

    return run


def tokenized(
    docs: DataFrame, *, doc_id: str, text: str, tokenizer: str, end_id: int, max_tokens: int,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: whole multiples of ``max_tokens``, then what is left."""
    source = docs.select(
        F.col(doc_id).alias("_id"), F.coalesce(F.col(text), F.lit("")).alias("_text")
    )
    longs = [T.StructField(n, T.LongType()) for n in ("_row", "start", "length", "ids_crc32", "doc_tokens")]
    schema = T.StructType([
        T.StructField("doc_id", source.schema["_id"].dataType), *longs, T.StructField("ids", T.BinaryType())
    ])
    pieces = source.mapInArrow(_pieces(tokenizer, end_id, max_tokens, with_ids), schema)
    return pieces if with_ids else pieces.drop("ids")


def place(histogram: dict[int, int], max_tokens: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns as (count, runs of (length, times)) that hold exactly the histogram's pieces."""
    groups: dict[int, list[tuple[int, tuple]]] = {}  # by free space
    spaces: list[int] = []  # sorted, those with groups

    def add(space: int, count: int, pattern: tuple) -> None:
        if count:
            if space not in groups:
                groups[space] = []
                spaces.insert(int(np.searchsorted(spaces, space)), space)
            groups[space].append((count, pattern))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not spaces or spaces[-1] < length:  # nothing has room: open packs, filled with this length
                each = max_tokens // length
                add(max_tokens - each * length, left // each, ((length, each), None))
                rest = left % each
                if rest:
                    add(max_tokens - rest * length, 1, ((length, rest), None))
                break
            space = spaces[-1]
            count, pattern = groups[space].pop()
            if not groups[space]:
                del groups[space]
                spaces.pop()
            # as many of this length as bring the shortest packs level with the next ones
            each = max(1, min(space // length, (space - (spaces[-1] if spaces else 0)) // length))
            each = min(each, max(1, left // count))
            taken = min(count, left // each)
            add(space, count - taken, pattern)
            add(space - each * length, taken, ((length, each), pattern))
            left -= taken * each
    out = []
    for found in groups.values():
        for count, pattern in found:
            runs = []
            while pattern is not None:
                runs.append(pattern[0])
                pattern = pattern[1]
            out.append((count, runs[::-1]))
    return out


def slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, offset, times), sorted by length and rank."""
    ranks: dict[int, int] = {}
    sequence, rows = 0, []
    for count, runs in patterns:
        offset = 0
        for length, times in runs:
            first = ranks.get(length, 0)
            rows.append((length, first, sequence, offset, times))
            ranks[length] = first + count * times
            offset += length * times
        sequence += count
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def _placed(table: np.ndarray):
    keys = table[:, 0] * (1 << 50) + table[:, 1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length = batch.column("length").to_numpy(zero_copy_only=False)
            rank = batch.column("_rank").to_numpy(zero_copy_only=False)
            row = table[np.searchsorted(keys, length * (1 << 50) + rank, side="right") - 1]
            nth = rank - row[:, 1]
            sequence, offset = row[:, 2] + nth // row[:, 4], row[:, 3] + nth % row[:, 4] * length
            names = [n for n in batch.schema.names if n != "_rank"]
            yield pa.RecordBatch.from_arrays(
                [batch.column(n) for n in names] + [pa.array(sequence), pa.array(offset)],
                names=[*names, "sequence_id", "offset"],
            )

    return run


def ranked(pieces: DataFrame, rows_per_bucket: int = 50_000) -> DataFrame:
    """``_rank`` from 0 among pieces of equal length.

    A length may hold a third of all pieces, so each is dealt into buckets: a piece's rank
    is the size of its length's earlier buckets plus its place in its own.
    """
    buckets = max(16, -(-pieces.count() // rows_per_bucket))
    dealt = pieces.withColumn("_bucket", F.pmod(F.xxhash64("_row", "start"), F.lit(buckets)))
    earlier = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (
        dealt.groupBy("length", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0))).drop("_n")
    )
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "start", "_row")
    return (
        dealt.withColumn("_place", F.row_number().over(own) - 1)
        .join(before, ["length", "_bucket"])
        .withColumn("_rank", (F.col("_before") + F.col("_place")).cast("long"))
        .drop("_bucket", "_before", "_place")
    )


def pack(
    docs: DataFrame,
    *,
    tokenizer: str,
    doc_id: str = "doc_id",
    text: str = "text",
    end_id: int = 1,
    max_tokens: int = 2048,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece with its sequence and place there.

    ``with_ids`` adds the piece's ids as little-endian 32-bit numbers.
    """
    pieces = written(
        tokenized(
            docs, doc_id=doc_id, text=text, tokenizer=tokenizer, end_id=end_id,
            max_tokens=max_tokens, with_ids=with_ids,
        ),
        "pieces",
    )
    histogram = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    table = slots(place(histogram, max_tokens))
    schema = T.StructType([
        *pieces.drop("_row").schema.fields,
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])
    return ranked(pieces).select(*pieces.drop("_row").columns, "_rank").mapInArrow(_placed(table), schema)
