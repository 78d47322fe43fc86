"""Quality scores by a sparse ensemble of rules over text statistics.

Boosted small trees on a bounded labelled sample give paths; each path is a conjunction
of comparisons of statistics.  A lasso fits logistic weights to the rules and leaves few,
which are compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidelake.llm.labelled import excess, remainder, sample
from tidelake.llm.shared import give_back

THRESHOLD = 0.5
STATISTICS = (
    "words", "word_bytes", "longest", "upper", "digit", "space", "point", "symbol", "mark", "other",
    "line_words", "line_repeats", "word_kinds", "word_share", "pair_kinds", "ended", "stopped", "single",
)
_UPPER, _DIGIT, _SPACE = string.ascii_uppercase.encode(), string.digits.encode(), b" \t\n\r\x0b\x0c"
_POINT, _MARK = b".,;:'\"()-?", b"!|"
_SYMBOL = bytes(c for c in string.punctuation.encode() if c not in _POINT + _MARK)
_LETTER = string.ascii_letters.encode()


def statistics(text: str | None) -> tuple[float, ...]:
    """The STATISTICS of a whole text; all zero without words."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return (0.0,) * len(STATISTICS)
    n, w = len(raw), len(words)
    part = lambda kind: (n - len(raw.translate(None, kind))) / n
    lines = [x for x in raw.split(b"\n") if x.strip()]
    counts: dict[bytes, int] = {}
    for x in words:
        counts[x] = counts.get(x, 0) + 1
    return (
        float(np.log1p(w)), (n - raw.count(b" ")) / w, float(max(map(len, words))), part(_UPPER), part(_DIGIT), part(_SPACE), part(_POINT), part(_SYMBOL), part(_MARK),
        len(raw.translate(None, bytes(range(128)))) / n, w / len(lines), 1 - len(set(lines)) / len(lines), len(counts) / w, max(counts.values()) / w,
        len(set(zip(words, words[1:]))) / max(1, w - 1), sum(x[-1:] not in _LETTER for x in words) / w, raw.count(b".") / w, sum(len(x) == 1 for x in words) / w,
    )


@dataclass(frozen=True)
class Rule:
    """A conjunction of (statistic, above, cut): value > cut if above, else value <= cut."""

    terms: tuple[tuple[int, bool, float], ...]
    weight: float = 0.0

    def holds(self, x: np.ndarray) -> np.ndarray:
        out = np.ones(len(x), bool)
        for i, above, cut in self.terms:
            out &= (x[:, i] > cut) == above
        return out

    def column(self, stats: Column) -> Column:
        tests = [stats[STATISTICS[i]] > cut if above else stats[STATISTICS[i]] <= cut for i, above, cut in self.terms]
        whole = tests[0]
        for t in tests[1:]:
            whole = whole & t
        return whole


def _tree(x: np.ndarray, g: np.ndarray, h: np.ndarray, depth: int, terms: tuple, cuts: list[np.ndarray], few: int, features: np.ndarray, out: list, at: np.ndarray) -> None:
    """Grows one tree of Newton steps on x[at]; appends the paths to its nodes."""
    if terms:
        out.append(Rule(terms))
    best = (1e-6, 0, 0.0)
    if depth and len(at) >= 2 * few:
        base = g[at].sum() ** 2 / (h[at].sum() + 1)
        for i in features:
            left = np.searchsorted(cuts[i], x[at, i])
            gs, hs, ns = (np.cumsum(np.bincount(left, v, len(cuts[i]) + 1))[:-1] for v in (g[at], h[at], np.ones(len(at))))
            gain = np.where((ns >= few) & (len(at) - ns >= few), gs**2 / (hs + 1) + (g[at].sum() - gs) ** 2 / (h[at].sum() - hs + 1) - base, 0)
            if len(gain) and gain.max() > best[0]:
                best = (gain.max(), i, float(cuts[i][gain.argmax()]))
    if best[0] <= 1e-6:
        return
    _, i, cut = best
    above = x[at, i] > cut
    for side in (False, True):
        _tree(x, g, h, depth - 1, (*terms, (int(i), side, cut)), cuts, few, features, out, at[above == side])


def grow(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.3, seed: int = 3) -> list[Rule]:
    """Different paths of boosted trees, each on half of the rows and two thirds of the statistics."""
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(c, np.linspace(0.01, 0.99, 64))) for c in x.T]
    f = np.zeros(len(x))
    found: dict[tuple, Rule] = {}
    for _ in range(trees):
        p = 1 / (1 + np.exp(-f))
        at = rng.permutation(len(x))[: max(1, len(x) // 2)]
        features = rng.permutation(x.shape[1])[: max(1, 2 * x.shape[1] // 3)]
        rules: list[Rule] = []
        _tree(x, p - y, p * (1 - p) + 1e-6, depth, (), cuts, max(5, len(x) // 500), features, rules, at)
        for r in rules:
            found.setdefault(r.terms, r)
        leaves = [r for r in rules if not any(o.terms[: len(r.terms)] == r.terms and o is not r for o in rules)]
        for r in leaves:
            on = r.holds(x)
            f[on] += rate * np.clip((y[on] - p[on]).sum() / ((p[on] * (1 - p[on])).sum() + 1), -4, 4)
    return list(found.values())


def lasso(a: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights of the columns of a under an L1 penalty, and the free intercept (FISTA)."""
    n = len(y)
    base = a.mean(axis=0)
    c = a - base
    size = 0.25 * max(1e-9, np.linalg.norm(c.T @ c / n, 2) + 1)
    w, b = np.zeros(a.shape[1]), 0.0
    v, vb, t = w.copy(), b, 1.0
    for _ in range(rounds):
        e = 1 / (1 + np.exp(-np.clip(c @ v + vb, -35, 35))) - y
        new = v - c.T @ e / n / size
        new = np.sign(new) * np.maximum(np.abs(new) - penalty / size, 0)
        newb = vb - e.mean() / size
        t2 = (1 + (1 + 4 * t * t) ** 0.5) / 2
        v, vb = new + (t - 1) / t2 * (new - w), newb + (t - 1) / t2 * (newb - b)
        w, b, t = new, newb, t2
    return w, float(b - base @ w)


def fit_rules(x: np.ndarray, y: np.ndarray, penalty: float = 0.0015) -> tuple[list[Rule], float]:
    """Weighted rules and intercept; rows of one class only give no rules."""
    if not 0 < y.sum() < len(y):
        return [], 4.0 if len(y) and y.sum() else -4.0
    rules = grow(x, y)
    if not rules:
        return [], float(np.log(y.mean() / (1 - y.mean())))
    w, b = lasso(np.column_stack([r.holds(x) for r in rules]).astype(np.float64), y.astype(np.float64), penalty)
    return [Rule(r.terms, float(v)) for r, v in zip(rules, w) if v], b


def statistics_column(text: Column) -> Column:
    """A struct of the STATISTICS of a text."""

    @F.pandas_udf(", ".join(f"{s} double" for s in STATISTICS))
    def stats(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([statistics(t) for t in texts], columns=list(STATISTICS))
        give_back()

    return stats(text)


def score_column(stats: Column, rules: list[Rule], intercept: float) -> Column:
    """The probability of label 1 as one expression over the statistics."""
    total = F.lit(intercept)
    for r in rules:
        total = total + F.when(r.column(stats), F.lit(r.weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(docs: DataFrame, labels: DataFrame, learn: Column, target: str = "quality", most: int = 5000, id_col: str = "doc_id", text_col: str = "text") -> tuple[list[Rule], float]:
    """Rules from the statistics of at most ``most`` documents of each class, and the intercept for all of them."""
    chosen = sample(docs, labels, target, learn, most, id_col, text_col)
    rows = chosen.select(F.col("__id").cast("string").alias("id"), statistics_column(F.col("text")).alias("s"), "label").select("id", "s.*", "label").toPandas()
    rows = rows.sort_values(["id", *STATISTICS])
    rules, intercept = fit_rules(rows[list(STATISTICS)].to_numpy(float), rows["label"].to_numpy(int))
    return rules, intercept - (excess(labels, target, learn, most, id_col) if rows["label"].nunique() > 1 else 0.0)


def quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted for every row of docs.

    Null and empty texts have zero statistics and score as the rules say for those; long
    texts are read whole and other columns of docs not at all.  Repeated rows are each scored, equal texts alike.  An empty table gives no rows; without
    labels of both classes the score is constant.
    """
    rules, intercept = fit(docs, labels, remainder(F.col(id_col), folds) != held, id_col=id_col, text_col=text_col)
    rows = docs.select(F.col(id_col).alias("doc_id"), (remainder(F.col(id_col), folds) == held).alias("held_out"), statistics_column(F.col(text_col)).alias("s"))
    scored = rows.select("doc_id", "held_out", score_column(F.col("s"), rules, intercept).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
