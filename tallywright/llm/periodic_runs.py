"""Periodic runs of words by recompression, and texts with their repeats cut out.

A run is a stretch of consecutive words with smallest period q (words q apart are
identical) that is at least ``exponent`` periods and ``least`` words long and that no
neighbouring word extends.

A task lays a lot of documents behind one another, a separator of its own around each, and
recompresses the whole sequence to a run-length grammar: in turns it replaces each block of
one symbol (a, k) and, with the alphabet split in two, each pair of a left and a right
symbol.  Equal stretches get equal symbols but for their fringes, so the longest common
extension of two places takes a few steps up and down the levels of the parse, a block at
a time: all queries of a lot advance together.

A run of q that spans ``exponent`` periods holds some i with i and i + q both inside at
every (``exponent`` - 1) q places, so the candidates for q are that grid, n / q of them and
n log n over all q.  Those whose two words agree are extended both ways on the grammar;
what is long enough is a run, and of equal stretches the least q names it.

Defined results: null, empty and wordless text have no words and no runs.  Repeated rows
come out once each, with equal results.  Texts of any length are taken whole; one of n
words needs some 100 n bytes.  Of other columns only those named in ``carry`` come along,
and a result whose name one of them has gets underscores before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import lots, unclashed

PARTS = ("start", "length", "period")
RUN = pa.struct([(name, pa.int64()) for name in PARTS])
RESULT = T.StructType([
    T.StructField("n_words", T.LongType()),
    T.StructField("runs", T.ArrayType(T.StructType([T.StructField(name, T.LongType()) for name in PARTS]))),
    T.StructField("collapsed", T.StringType()),
])
#: Words that a grammar takes in, about; a longer document has one to itself.
LOT_WORDS = 1 << 16
#: Candidates looked at together.
LOT_CANDIDATES = 1 << 20


def _numbered(*parts: np.ndarray) -> np.ndarray:
    """Equal numbers for places where all parts are equal."""
    names = parts[0]
    for part in parts[1:]:
        names = np.unique(names * (int(part.max(initial=0)) + 1) + part, return_inverse=True)[1]
    return names


def _sides(symbols: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Left (0) or right (1) for each symbol: the best of a few random splits."""
    tries = (rng.integers(0, 2, int(symbols.max()) + 1, dtype=np.int8) for _ in range(4))
    return max(tries, key=lambda side: int((side[symbols[:-1]] < side[symbols[1:]]).sum()))


class Grammar:
    """A sequence and its levels of recompression, all nodes numbered through.

    ``symbol`` of a node is comparable within its level.  ``above`` is the node of the next
    level that it begins (ends), else -1; ``below`` the first (last) node under it;
    ``equals`` how many equal nodes follow (precede) it, itself included.
    """

    def __init__(self, sequence: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.size = len(sequence)
        symbols, offset = np.unique(sequence, return_inverse=True)[1], 0
        below = (np.full(self.size, -1), np.full(self.size, -1))
        levels = []
        while True:
            n = len(symbols)
            heads = np.concatenate([[0], np.flatnonzero(symbols[1:] != symbols[:-1]) + 1])
            ends = np.append(heads[1:], n)
            powers = ends - heads
            place = np.arange(n)
            above = np.full(n, -1), np.full(n, -1)
            levels.append((
                symbols, *above, *below,
                np.repeat(ends, powers) - place, place - np.repeat(heads, powers) + 1,
            ))
            blocks = _numbered(symbols[heads], powers)
            if len(blocks) < 2:
                break
            side = _sides(blocks, rng)
            opens = side[blocks[:-1]] < side[blocks[1:]]
            if not opens.any() and len(blocks) == n:
                break
            first = np.flatnonzero(~np.insert(opens, 0, False))
            paired = np.append(opens, False)[first]
            last = first + paired
            symbols = _numbered(blocks[first], np.where(paired, blocks[last] + 1, 0))
            node = offset + n + np.arange(len(first))
            above[0][heads[first]] = node
            above[1][ends[last] - 1] = node
            below = offset + heads[first], offset + ends[last] - 1
            offset += n
        columns = [np.concatenate(c) for c in zip(*levels)]
        self.symbol, self.equals = columns[0], (columns[5], columns[6])
        self.above, self.below = (columns[1], columns[2]), (columns[3], columns[4])

    def extension(self, i: np.ndarray, j: np.ndarray, back: bool = False) -> np.ndarray:
        """Lengths of the longest equal stretches that begin (end) at places i and j, i < j.

        The first and the last word of the sequence must occur only once.
        """
        above, below, equals = self.above[back], self.below[back], self.equals[back]
        symbol, step = self.symbol, -1 if back else 1
        p, q, reached, todo = i.copy(), j.copy(), i.copy(), np.arange(len(i))
        while len(todo):
            same = symbol[p] == symbol[q]
            over_p, over_q = above[p], above[q]
            climb = same & (over_p >= 0) & (over_q >= 0) & (symbol[over_p] == symbol[over_q])
            hop = np.where(same & ~climb, step * np.minimum(equals[p], equals[q]), 0)
            p = np.where(climb, over_p, np.where(same, p + hop, below[p]))
            q = np.where(climb, over_q, np.where(same, q + hop, below[q]))
            going = p >= 0  # nothing is below the sequence itself
            if not going.all():
                todo, p, q = todo[going], p[going], q[going]
            settled = p < self.size
            reached[todo[settled]] = p[settled]
        return np.abs(reached - i)


def _candidates(words: np.ndarray, owner: np.ndarray, longest: int, exponent: int):
    """Places i and periods q of the grids, where word i equals word i + q of its document."""
    total, most = len(words), longest // exponent
    q = 1
    while q <= most:
        high = q  # as many periods as make a lot
        room = LOT_CANDIDATES
        while high <= most and room > 0:
            room -= (total - high) // ((exponent - 1) * high) + 1
            high += 1
        periods = np.arange(q, high)
        counts = (total - periods - 1) // ((exponent - 1) * periods) + 1
        each = np.repeat(periods, counts)
        nth = np.arange(len(each)) - np.repeat(np.cumsum(counts) - counts, counts)
        i = nth * (exponent - 1) * each
        hit = (words[i] == words[i + each]) & (owner[i] == owner[i + each])
        yield i[hit], each[hit]
        q = high


def runs_of(words: np.ndarray, owner: np.ndarray, exponent: int = 4, least: int = 6) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start then period.

    ``words`` numbers the words of several documents (``owner``, ascending), with a
    separator that occurs once before, between and after them.
    """
    longest = int(np.bincount(owner).max(initial=0))
    found, grammar = [np.zeros((0, 3), dtype=np.int64)], None
    for i, q in _candidates(words, owner, longest, exponent):
        if not len(i):
            continue
        if grammar is None:
            grammar = Grammar(words)
        end = i + q + grammar.extension(i, i + q)
        start = i - grammar.extension(i - 1, i + q - 1, back=True)
        long = end - start >= np.maximum(least, exponent * q)
        found.append(np.unique(np.column_stack([start, end, q])[long], axis=0))
    rows = np.concatenate(found)
    rows = rows[np.lexsort((rows[:, 2], rows[:, 1], rows[:, 0]))]
    # one stretch is met under its period and the multiples of it
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
    rows = rows[new]
    return rows[np.lexsort((rows[:, 2], rows[:, 0]))]


def collapsed_lot(
    texts: list[list[bytes]], exponent: int, least: int
) -> list[tuple[list[tuple[int, int, int]], bytes]]:
    """Runs of each text as (start, length, period), and its words without their repeats."""
    numbers: dict[bytes, int] = {}
    sizes = np.array([len(words) for words in texts])
    starts = np.cumsum(sizes + 1) - sizes  # a separator before each document
    words = np.empty(int((sizes + 1).sum()) + 1, dtype=np.int64)
    edges = np.append(starts - 1, len(words) - 1)
    for own, start, size in zip(texts, starts, sizes):
        words[start : start + size] = [numbers.setdefault(w, len(numbers)) for w in own]
    words[edges] = len(numbers) + np.arange(len(edges))
    owner = np.repeat(np.arange(len(edges)), np.append(sizes + 1, 1))
    rows = runs_of(words, owner, exponent, least)
    # words after the first period of some run
    turns = np.bincount(rows[:, 0] + rows[:, 2], minlength=len(words) + 1) - np.bincount(rows[:, 1], minlength=len(words) + 1)
    covered = np.cumsum(turns) > 0
    cuts = np.searchsorted(rows[:, 0], np.append(starts, len(words)))
    settled = []
    for k, own in enumerate(texts):
        part = rows[cuts[k] : cuts[k + 1]]
        spans = [(int(s - starts[k]), int(e - s), int(q)) for s, e, q in part]
        if spans:
            dropped = covered[starts[k] : starts[k] + sizes[k]]
            own = [w for w, gone in zip(own, dropped) if not gone]
        settled.append((spans, b" ".join(own)))
    return settled


def _searched(exponent: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in lots(batches, "_text"):
            texts = [(t or b"").split() for t in batch.column("_text").cast(pa.binary()).to_pylist()]
            done, low = [], 0
            while low < len(texts):
                high, held = low + 1, len(texts[low])
                while high < len(texts) and held + len(texts[high]) <= LOT_WORDS:
                    held += len(texts[high])
                    high += 1
                done += collapsed_lot(texts[low:high], exponent, least)
                low = high
            spans = [[dict(zip(PARTS, s)) for s in part] for part, _ in done]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_carried"), pa.array([len(words) for words in texts], pa.int64()),
                    pa.array(spans, pa.list_(RUN)), pa.array([c for _, c in done], pa.binary()).cast(pa.string()),
                ],
                names=["_carried", *RESULT.names],
            )

    return run


def periodic_runs(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    carry: tuple[str, ...] = (),
    exponent: int = 4,
    least: int = 6,
) -> DataFrame:
    """One row per input row: the columns ``carry``, then doc_id, n_words, runs (start, length
    and period in words, by start then period) and collapsed, the words that no run holds
    after its first period, joined by one space."""
    source = docs.select(
        F.struct(
            F.col(doc_id).alias("_id"), F.struct(F.lit(0).alias("_none"), *[F.col(c) for c in carry]).alias("_more")
        ).alias("_carried"),
        F.col(text).alias("_text"),
    )
    done = source.mapInArrow(
        _searched(exponent, least), T.StructType([source.schema["_carried"], *RESULT.fields])
    )
    return done.select(
        *[F.col("_carried._more")[c].alias(c) for c in carry],
        F.col("_carried._id").alias(unclashed(carry, "doc_id")),
        *[F.col(c).alias(unclashed(carry, c)) for c in RESULT.names],
    )
