"""A quality classifier of conjunctive rules, taken from trees and weighed by a lasso."""

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spoolway.llm.common import sampled
from spoolway.llm.textstats import ratios

#: Labelled rows that the fit looks at, at most, chosen by a hash of the id.
FIT_ROWS = 20_000
TREES, DEPTH, QUANTILES = 40, 3, 24
LASSO, STEPS = 0.001, 400
LEAST_SHARE = 0.002

#: A condition is (feature, above, threshold); a rule is a conjunction of them.
Condition = tuple[str, bool, float]


@dataclass
class Ensemble:
    """An intercept and weighed rules."""

    intercept: float
    rules: list[tuple[tuple[Condition, ...], float]] = field(default_factory=list)

    def score(self, features: dict[str, Column]) -> Column:
        """The probability of label 1 as a Spark expression over feature columns."""

        def holds(rule):
            parts = [features[f] > t if above else features[f] <= t for f, above, t in rule]
            return reduce(Column.__and__, parts)

        # one array of weights, added up, keeps the expression flat
        terms = [F.when(holds(rule), F.lit(w)).otherwise(F.lit(0.0)) for rule, w in self.rules]
        total = F.lit(self.intercept)
        if terms:
            total = total + F.aggregate(F.array(*terms), F.lit(0.0), lambda a, x: a + x)
        return 1 / (1 + F.exp(-total))


def _matrix(rules, columns):
    import numpy as np

    rows = len(next(iter(columns.values())))
    out = np.ones((rows, len(rules)), np.float32)
    for j, rule in enumerate(rules):
        for f, above, t in rule:
            out[:, j] *= columns[f] > t if above else columns[f] <= t
    return out


def _tree_rules(columns, y, rng) -> set[tuple[Condition, ...]]:
    """The paths of one tree, grown on a resample and a random half of the features."""
    import numpy as np

    names = sorted(columns)
    chosen = sorted(rng.choice(len(names), max(1, (len(names) + 1) // 2), replace=False).tolist())
    rows = rng.integers(0, len(y), len(y) // 2 + 1)
    cuts = [(names[f], float(t)) for f in chosen for t in np.unique(np.quantile(columns[names[f]][rows], np.linspace(0.01, 0.99, QUANTILES)))]
    above = np.stack([columns[f][rows] > t for f, t in cuts], axis=1).astype(np.float32)
    label, out = y[rows].astype(np.float32), set()

    def grow(at, path, depth):
        if path:
            out.add(tuple(sorted(path)))
        n, ones = len(at), label[at].sum()
        if depth == 0 or n < 20 or ones in (0, n):
            return
        right, right_ones = above[at].sum(axis=0), label[at] @ above[at]
        left, left_ones = n - right, ones - right_ones
        with np.errstate(divide="ignore", invalid="ignore"):
            gini = right_ones * (right - right_ones) / right + left_ones * (left - left_ones) / left
        gini[(right < 5) | (left < 5)] = np.inf
        k = int(gini.argmin())
        if not np.isfinite(gini[k]):
            return
        f, t = cuts[k]
        hit = above[at, k] > 0
        grow(at[hit], [*path, (f, True, t)], depth - 1)
        grow(at[~hit], [*path, (f, False, t)], depth - 1)

    grow(np.arange(len(rows)), [], DEPTH)
    return out


def _lasso(x, y):
    """Sparse logistic weights by accelerated proximal steps; the intercept is free."""
    import numpy as np

    rows = len(y)
    z = np.concatenate([np.ones((rows, 1), np.float32), x], axis=1)
    norm = float(np.linalg.norm(z, 2)) ** 2 / (4 * rows)
    w, before, t = np.zeros(z.shape[1]), np.zeros(z.shape[1]), 1.0
    for _ in range(STEPS):
        after_t = (1 + (1 + 4 * t * t) ** 0.5) / 2
        ahead = w + (t - 1) / after_t * (w - before)
        p = 1 / (1 + np.exp(-(z @ ahead.astype(np.float32))))
        move = ahead - (z.T @ (p - y).astype(np.float32)) / rows / norm
        shrunk = np.sign(move) * np.maximum(np.abs(move) - LASSO / norm, 0)
        shrunk[0] = move[0]
        before, w, t = w, shrunk, after_t
    return float(w[0]), w[1:]


def train(columns, y, seed: int = 7) -> Ensemble:
    """Rules and weights from feature arrays and labels 0 or 1.

    Without rows every text scores 0.5; with one label only, the smoothed share of 1.
    """
    import numpy as np

    y = np.asarray(y, np.float64)
    share = (y.sum() + 1) / (len(y) + 2)
    flat = Ensemble(float(np.log(share / (1 - share))))
    if len(y) < 40 or y.min() == y.max():
        return flat
    rng = np.random.default_rng(seed)
    rules = sorted(set().union(*(_tree_rules(columns, y, rng) for _ in range(TREES))))
    x = _matrix(rules, columns) if rules else np.zeros((len(y), 0), np.float32)
    # rules that hold for the same rows count once
    _, first = np.unique(np.packbits(x.T.astype(bool), axis=1), axis=0, return_index=True) if rules else (None, [])
    support = x.mean(axis=0)
    keep = [j for j in sorted(first) if LEAST_SHARE <= support[j] <= 1 - LEAST_SHARE]
    if not keep:
        return flat
    intercept, weights = _lasso(x[:, keep], y)
    return Ensemble(intercept, [(rules[j], float(w)) for j, w in zip(keep, weights) if abs(w) > 1e-6])


def fit(stats: DataFrame, labels: DataFrame, id_column: str = "doc_id", label: str = "quality", rows: int = FIT_ROWS) -> Ensemble:
    """Train on at most ``rows`` labelled rows of ``stats`` (id, ``stats``), chosen by a hash of the id.

    Rows without a label, or with a label other than 0 and 1, are left out.
    """
    import numpy as np

    usable = labels.where(F.col(label).isin(0, 1) & F.col(id_column).isNotNull())
    some = sampled(usable.select(F.col(id_column).alias("of"), F.col(label).cast("int").alias("y")), rows, ["of", "y"])
    features = ratios()
    met = stats.join(F.broadcast(some), F.col(id_column) == F.col("of"))
    # more rows than labels only if ids repeat
    found = sampled(met.select("of", "y", *[c.alias(n) for n, c in features.items()]), rows, ["of", "y", *features]).toArrow()
    columns = {n: found.column(n).to_numpy() for n in features}
    return train(columns, found.column("y").to_numpy())
