"""Quality classifier as a sparse ensemble of rules.

Small trees are grown on text statistics of a bounded sample of labelled rows, each next one
on what the others leave unexplained.  Every path from a root to a node is a conjunctive rule; a logistic
regression with an L1 penalty keeps few of them.  The kept rules are compiled into one
Spark column expression, so all documents are scored without Python.

Defined results: null and wordless texts have all-zero statistics and get the score those
rules give.  A document with several labels counts with the smallest; null labels do not
count.  With no label to learn from, or one kind only, the score is the share of ones (0.5
if there is none).  Repeated rows get equal scores; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.common import held_out, written
from tallywright.llm.quality_rules import CLASSES, base_counts

#: A rule holds where low < value <= high for each (feature, low, high).
Rule = tuple[tuple[int, float, float], ...]
FEATURES = (
    "words", "word_length", "symbols", "dup_lines", "repeats", "common", "kinds", "line_words",
    *CLASSES,
)


def statistics(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, held_out and the statistics of each row's whole text."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text"))
    lines = F.size(F.split(F.coalesce(F.col("_text"), F.lit("")), "\n"))
    counted = base_counts(rows.withColumn("_n_lines", lines), "_text")
    q = F.col("_q")
    per = lambda n, total: F.coalesce(n / F.nullif(total, F.lit(0)), F.lit(0.0)).cast("double")
    common = F.aggregate(q["counts"], F.lit(0).cast("long"), lambda a, n: a + n)
    values = [
        F.log1p(q["n_words"].cast("double")), per(q["word_chars"], q["n_words"]),
        per(q["n_symbols"], q["word_chars"]), per(q["n_dup_lines"], F.col("_n_lines").cast("long")),
        per(q["n_repeat_words"], q["n_words"]), per(common, q["n_words"]),
        per(F.size(q["kinds"]).cast("long"), q["n_words"]), per(q["n_words"], F.col("_n_lines").cast("long")),
        *[per(q["classes"][i + 1], q["word_chars"]) for i in range(len(CLASSES))],
    ]
    return counted.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"),
        *[v.alias(f"f_{n}") for n, v in zip(FEATURES, values, strict=True)],
    )


def _tree_rules(x: np.ndarray, target: np.ndarray, cuts: list[np.ndarray], depth: int, least: int) -> list[tuple[Rule, float, bool]]:
    """Every node of a regression tree but the root: its rule, mean target, whether it is a leaf."""
    nodes: list[tuple[Rule, float, bool]] = []

    def note(rows: np.ndarray, bounds: dict[int, tuple[float, float]], leaf: bool) -> None:
        if bounds:
            rule = tuple(sorted((g, *b) for g, b in bounds.items()))
            nodes.append((rule, float(target[rows].mean()), leaf))

    def grow(rows: np.ndarray, bounds: dict[int, tuple[float, float]], level: int) -> None:
        if level == depth or len(rows) < 2 * least:
            note(rows, bounds, True)
            return
        best = (1e-9, None, None)
        total, y = target[rows].sum(), target[rows]
        for f, edges in enumerate(cuts):
            if not len(edges):
                continue
            at = np.searchsorted(edges, x[rows, f])  # value <= edges[at]
            n = np.cumsum(np.bincount(at, minlength=len(edges) + 1))[:-1]
            s = np.cumsum(np.bincount(at, weights=y, minlength=len(edges) + 1))[:-1]
            m = len(rows) - n
            ok = (n >= least) & (m >= least)
            if not ok.any():
                continue
            gain = np.where(ok, s**2 / np.maximum(n, 1) + (total - s) ** 2 / np.maximum(m, 1), -np.inf) - total**2 / len(rows)
            k = int(gain.argmax())
            if gain[k] > best[0]:
                best = (gain[k], f, edges[k])
        _, f, cut = best
        note(rows, bounds, f is None)
        if f is None:
            return
        low, high = bounds.get(f, (-np.inf, np.inf))
        left = x[rows, f] <= cut
        for part, span in ((rows[left], (low, min(high, cut))), (rows[~left], (max(low, cut), high))):
            inside = bounds | {f: (float(span[0]), float(span[1]))}
            grow(part, inside, level + 1)

    grow(np.arange(len(target)), {}, 0)
    return nodes


def holds(rules: Sequence[Rule], x: np.ndarray) -> np.ndarray:
    """Which rules hold for which rows, as 0 and 1."""
    out = np.ones((len(x), len(rules)), dtype=np.float64)
    for k, rule in enumerate(rules):
        for f, low, high in rule:
            out[:, k] *= (x[:, f] > low) & (x[:, f] <= high)
    return out


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, steps: int = 300) -> tuple[float, np.ndarray]:
    """Intercept and weights by accelerated proximal gradient; columns are scaled inside."""
    scale = np.maximum(z.std(axis=0), 0.02)
    a = z / scale
    lead = np.ones(a.shape[1])
    for _ in range(20):  # the largest eigenvalue bounds the step
        lead = a.T @ (a @ lead)
        size = np.linalg.norm(lead) or 1.0
        lead /= size
    step = 3.0 / (size / len(a) + 1.0)
    w, b = np.zeros(a.shape[1]), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3))
    v, c, t = w, b, 1.0
    for _ in range(steps):
        error = 1 / (1 + np.exp(-(a @ v + c))) - y
        new = v - step * (a.T @ error) / len(a)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        new_b = c - step * error.mean()
        after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        v, c = new + (t - 1) / after * (new - w), new_b + (t - 1) / after * (new_b - b)
        w, b, t = new, new_b, after
    return float(b), w / scale


@dataclass
class RuleEnsemble:
    intercept: float
    rules: list[Rule]
    weights: list[float]

    def predict(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.intercept + holds(self.rules, x) @ np.array(self.weights))))

    def column(self, names: Sequence[str]) -> Column:
        """The score as an expression over feature columns."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            condition = F.lit(True)
            for f, low, high in rule:
                if low > -np.inf:
                    condition = condition & (F.col(names[f]) > low)
                if high < np.inf:
                    condition = condition & (F.col(names[f]) <= high)
            total = total + F.when(condition, F.lit(weight)).otherwise(F.lit(0.0))
        return 1 / (1 + F.exp(-total))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 40, depth: int = 3, bins: int = 32, seed: int = 5) -> RuleEnsemble:
    """Trees on half the rows each, then the penalty that a held-back quarter likes best."""
    if len(y) == 0 or y.min() == y.max():
        share = float(np.clip(y.mean() if len(y) else 0.5, 1e-3, 1 - 1e-3))
        return RuleEnsemble(float(np.log(share / (1 - share))), [], [])
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(y))
    back, own = order[: len(y) // 4], order[len(y) // 4 :]
    cuts = [np.unique(np.quantile(x[own, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    found: dict[Rule, None] = {}
    margin = np.full(len(own), np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    for _ in range(trees):
        some = rng.random(len(own)) < 0.5
        some = some if some.sum() > 1 else np.ones(len(own), dtype=bool)
        left = y[own] - 1 / (1 + np.exp(-margin))
        nodes = _tree_rules(x[own][some], left[some], cuts, depth, least=max(1, int(some.sum()) // 200))
        found.update(dict.fromkeys(rule for rule, _, _ in nodes))
        leaves = [(rule, mean) for rule, mean, leaf in nodes if leaf]
        if not leaves:
            break
        # a step along the residuals' leaf means
        margin += 2 * holds([rule for rule, _ in leaves], x[own]) @ np.array([mean for _, mean in leaves])
    rules = list(found)
    if not rules:
        return RuleEnsemble(float(margin[0]), [], [])
    z, zb = holds(rules, x[own]), holds(rules, x[back])
    best = None
    for penalty in (0.03, 0.01, 0.003, 0.001):
        b, w = lasso_logistic(z, y[own], penalty)
        p = np.clip(1 / (1 + np.exp(-(b + zb @ w))), 1e-6, 1 - 1e-6)
        loss = -np.mean(y[back] * np.log(p) + (1 - y[back]) * np.log(1 - p)) if len(back) else penalty
        if best is None or loss < best[0] - 1e-3:
            best = (loss, b, w)
    _, b, w = best
    kept = np.flatnonzero(np.abs(w) > 1e-4)
    return RuleEnsemble(b, [rules[k] for k in kept], [float(w[k]) for k in kept])


def classify_quality(
    docs: DataFrame,
    labels: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    sample: int = 8_000,
    cut: float = 0.7,
) -> DataFrame:
    """doc_id, held_out, score and predicted of each row; ``sample`` bounds the labelled rows
    that are learned from (about, by hash of doc_id and statistics; of rows alike in both one counts)."""
    stats = written(statistics(docs, doc_id, text), "statistics")
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).groupBy(
        F.col(doc_id).alias("doc_id")
    ).agg(F.min(label).alias("_label")).where(~held_out(F.col("doc_id")))
    names = [f"f_{n}" for n in FEATURES]
    rated = stats.join(known, "doc_id").select("doc_id", "_label", *names)
    share = sample / max(1, rated.count())
    drawn = F.pmod(F.xxhash64("doc_id", *names), F.lit(1 << 30)) < share * (1 << 30)
    rows = rated.where(drawn).distinct().collect()
    rows = sorted((r[1:] for r in rows), key=lambda r: r[1:] + r[:1])
    x = np.array([r[1:] for r in rows], dtype=np.float64).reshape(len(rows), len(names))
    model = fit(x, np.array([float(r[0]) for r in rows]))
    return stats.select("doc_id", "held_out", model.column(names).alias("score")).withColumn(
        "predicted", F.when(F.col("score") >= cut, 1).otherwise(0)
    )
