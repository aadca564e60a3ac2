"""Language identification by a bidirectional gated recurrent network over bytes.

The network is trained in numpy by backpropagation through time, on the driver, on windows of
a bounded sample of labelled rows.  Its few parameters go to the tasks, which label every
byte of every whole text: texts are cut into windows, thousands of which run side by side, and a document's
probabilities are the mean over its bytes.

Defined results: ``und`` with score 0 if the text is null or has no letter, or if there is
nothing to learn from.  Rows are judged one by one, so repeated rows get equal results;
columns beside id, text and (for learning) language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallywright.llm.common import held_out, sliced

GATES = ("z", "r", "n")


def _lettered(text: str) -> bool:
    """Whether the text has a letter; numbers like ½ and Ⅷ are none."""
    return any(map(str.isalpha, text))


def _lanes(rng: np.random.Generator, hidden: int) -> dict[str, np.ndarray]:
    """One direction: per gate a row of inputs for each byte, and the recurrent weights."""
    lane = {}
    for g in GATES:
        lane[f"G{g}"] = rng.normal(0, 0.3, (256, hidden)).astype(np.float32)
        lane[f"U{g}"] = rng.normal(0, hidden**-0.5, (hidden, hidden)).astype(np.float32)
    return lane


def _sigmoid(x: np.ndarray) -> np.ndarray:
    x *= 0.5
    np.tanh(x, out=x)
    x *= 0.5
    x += 0.5
    return x


def _run(lane: dict[str, np.ndarray], codes: np.ndarray, trace: list | None = None) -> np.ndarray:
    """States (time, window, hidden) for byte codes (time, window); ``trace`` gets the gates."""
    steps, wide = codes.shape
    h = np.zeros((wide, lane["Uz"].shape[0]), dtype=np.float32)
    states = np.empty((steps, *h.shape), dtype=np.float32)
    for t in range(steps):
        x = codes[t]
        z = _sigmoid(lane["Gz"].take(x, axis=0) + h @ lane["Uz"])
        r = _sigmoid(lane["Gr"].take(x, axis=0) + h @ lane["Ur"])
        u = h @ lane["Un"]
        n = u * r
        n += lane["Gn"].take(x, axis=0)
        np.tanh(n, out=n)
        if trace is not None:
            trace.append((h, z, r, u, n))
        out = states[t]
        np.subtract(h, n, out=out)
        out *= z
        out += n
        h = out
    return states


def _back(lane: dict, codes: np.ndarray, trace: list, outer: np.ndarray) -> dict[str, np.ndarray]:
    """Gradients of one direction from the states' gradients, through time."""
    grads = {k: np.zeros_like(v) for k, v in lane.items()}
    inputs = {g: np.empty_like(outer) for g in GATES}
    dh = np.zeros_like(outer[0])
    for t in range(len(trace) - 1, -1, -1):
        h, z, r, u, n = trace[t]
        dh = dh + outer[t]
        dn = dh * (1 - z) * (1 - n * n)
        dz = dh * (h - n) * z * (1 - z)
        dr = dn * u * r * (1 - r)
        du = dn * r
        for g, d in (("z", dz), ("r", dr), ("n", dn)):
            inputs[g][t] = d
        grads["Uz"] += h.T @ dz
        grads["Ur"] += h.T @ dr
        grads["Un"] += h.T @ du
        dh = dh * z + dz @ lane["Uz"].T + dr @ lane["Ur"].T + du @ lane["Un"].T
    flat = codes.reshape(-1)
    for g in GATES:
        each = inputs[g].reshape(len(flat), -1)
        for k in range(each.shape[1]):
            grads[f"G{g}"][:, k] = np.bincount(flat, weights=each[:, k], minlength=256)
    return grads


class ByteTagger:
    """Two directions and a softmax over languages at every byte."""

    def __init__(self, languages: list[str], hidden: int, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages = languages
        self.forward, self.backward = _lanes(rng, hidden), _lanes(rng, hidden)
        self.top = {
            "V": rng.normal(0, 0.3, (2 * hidden, len(languages))).astype(np.float32),
            "c": np.zeros(len(languages), dtype=np.float32),
        }

    def probabilities(self, codes: np.ndarray) -> np.ndarray:
        """(time, window, language)"""
        hidden = self.forward["Uz"].shape[0]
        states = _run(self.forward, codes) @ self.top["V"][:hidden]
        states += _run(self.backward, codes[::-1])[::-1] @ self.top["V"][hidden:]
        states += self.top["c"]
        states -= states.max(axis=2, keepdims=True)
        np.exp(states, out=states)
        states /= states.sum(axis=2, keepdims=True)
        return states

    def train(self, texts: list[bytes], labels: np.ndarray, *, steps: int, window: int, batch: int, seed: int = 11) -> None:
        """Adam on windows drawn evenly over the languages; each byte of a window is a case."""
        rng = np.random.default_rng(seed)
        by_language = [np.flatnonzero(labels == k) for k in range(len(self.languages))]
        weights = {("f", k): v for k, v in self.forward.items()}
        weights |= {("b", k): v for k, v in self.backward.items()} | {("t", k): v for k, v in self.top.items()}
        first = {k: np.zeros_like(v) for k, v in weights.items()}
        second = {k: np.zeros_like(v) for k, v in weights.items()}
        hidden = self.forward["Uz"].shape[0]
        for step in range(1, steps + 1):
            target = rng.integers(len(self.languages), size=batch)
            codes = np.full((batch, window), 32, dtype=np.uint8)
            real = np.zeros((batch, window), dtype=np.float32)
            for i, k in enumerate(target):
                text = texts[rng.choice(by_language[k])]
                start = rng.integers(max(1, len(text) - window + 1))
                piece = np.frombuffer(text[start : start + window], dtype=np.uint8)
                codes[i, : len(piece)], real[i, : len(piece)] = piece, 1
            codes, real = np.ascontiguousarray(codes.T), real.T
            front, rear = [], []
            states = np.concatenate(
                [_run(self.forward, codes, front), _run(self.backward, codes[::-1], rear)[::-1]], axis=2
            )
            scores = states @ self.top["V"] + self.top["c"]
            scores = np.exp(scores - scores.max(axis=2, keepdims=True))
            scores /= scores.sum(axis=2, keepdims=True)
            scores[:, np.arange(batch), target] -= 1
            scores *= (real / max(1.0, real.sum()))[:, :, None]
            down = scores @ self.top["V"].T
            grads = {("t", "V"): np.einsum("tbh,tbl->hl", states, scores, optimize=True), ("t", "c"): scores.sum((0, 1))}
            ahead = _back(self.forward, codes, front, np.ascontiguousarray(down[:, :, :hidden]))
            behind = _back(self.backward, codes[::-1], rear, np.ascontiguousarray(down[::-1, :, hidden:]))
            grads |= {("f", k): v for k, v in ahead.items()} | {("b", k): v for k, v in behind.items()}
            rate = 0.02 * min(1.0, 3 * (1 - step / (steps + 1)))
            for k, w in weights.items():
                g = np.clip(grads[k], -1, 1)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                w -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-6)).astype(np.float32)

    def documents(self, texts: list[bytes], window: int = 128, wide: int = 4096) -> np.ndarray:
        """Mean probabilities over all bytes of each text (document, language)."""
        sums = np.zeros((len(texts), len(self.languages)))
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        padded = -(-sizes // window)
        owner = np.repeat(np.arange(len(texts)), padded)
        place = np.arange(len(owner)) - np.repeat(np.cumsum(padded) - padded, padded)
        filled = np.minimum(window, sizes[owner] - place * window)
        for low in range(0, len(owner), wide):
            own, at, full = owner[low : low + wide], place[low : low + wide], filled[low : low + wide]
            codes = np.full((len(own), window), 32, dtype=np.uint8)
            for i, (d, w) in enumerate(zip(own.tolist(), at.tolist(), strict=True)):
                piece = texts[d][w * window : (w + 1) * window]
                codes[i, : len(piece)] = np.frombuffer(piece, dtype=np.uint8)
            found = self.probabilities(np.ascontiguousarray(codes.T))
            found *= (np.arange(window)[:, None] < full)[:, :, None]
            np.add.at(sums, own, found.sum(axis=0))
        return sums / np.maximum(sizes, 1)[:, None]


def _label(model: ByteTagger | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("_text").to_pylist()
            lettered = [i for i, t in enumerate(texts) if model and t and _lettered(t)]
            names, scores = ["und"] * len(texts), [0.0] * len(texts)
            for low in range(0, len(lettered), 2000):
                some = lettered[low : low + 2000]
                found = model.documents([texts[i].encode() for i in some])
                for i, best, top in zip(some, found.argmax(axis=1), found.max(axis=1), strict=True):
                    names[i], scores[i] = model.languages[best], float(min(1.0, top))
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_held"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def learn(
    docs: DataFrame, *, doc_id: str, text: str, lang: str, sample: int, chars: int, hidden: int, steps: int
) -> ByteTagger | None:
    """A tagger from about ``sample`` labelled rows that are not held out, ``chars`` of each.

    Every language gives an equal part of the sample, or all its rows where it has fewer.  Rows
    are drawn by a hash of id and text; of repeated rows one counts.
    """
    known = docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & ~held_out(F.col(doc_id))).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text"),
        F.xxhash64(F.col(doc_id), F.col(text)).alias("key"),
    )
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return None
    each = -(-sample // len(sizes))
    shares = F.create_map(*[F.lit(v) for name, n in sorted(sizes.items()) for v in (name, min(1.0, each / n))])
    drawn = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) < F.element_at(shares, F.col("lang")) * (1 << 30)
    start = F.pmod(F.xxhash64("key", F.lit(1)), F.greatest(F.length("text") - chars, F.lit(1))) + 1
    rows = known.where(drawn).select(
        "lang", "key", F.substring(F.col("text"), start.cast("int"), F.lit(chars)).alias("text")
    ).distinct().collect()
    rows = sorted((r for r in rows if _lettered(r["text"])), key=lambda r: (r["key"], r["lang"], r["text"]))
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    model = ByteTagger(languages, hidden)
    model.train(
        [r["text"].encode() for r in rows], np.array([languages.index(r["lang"]) for r in rows]),
        steps=steps, window=48, batch=128,
    )
    return model


def identify_language(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample: int = 4000,
    chars: int = 2000,
    hidden: int = 8,
    steps: int = 250,
) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row.  ``sample`` bounds the rows that are
    learned from, in equal parts by language, and ``chars`` the part of each; every text is judged as a whole."""
    model = learn(docs, doc_id=doc_id, text=text, lang=lang, sample=sample, chars=chars, hidden=hidden, steps=steps)
    source = docs.select(
        F.col(doc_id).alias("_id"), held_out(F.col(doc_id)).alias("_held"), F.col(text).alias("_text")
    )
    schema = T.StructType([
        T.StructField("doc_id", source.schema["_id"].dataType), T.StructField("held_out", T.BooleanType()),
        T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()),
    ])
    return source.mapInArrow(_label(model), schema)
