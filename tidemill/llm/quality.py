"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Every whole text gives a vector of statistics (log counts, shares, repetition), computed in Arrow batches. Class means
and covariances come from sums and cross products over all labelled training rows, added up by Spark: no sample. Each
covariance is shrunk towards the pooled diagonal; its Cholesky factor is computed once and cached in the model, which
scores by the difference of Mahalanobis log densities plus the log prior ratio, as a logistic score in 0..1.

Defined cases: null texts count as empty and are scored like any text. Labels without a document or class are ignored;
rows that repeat count as often as they occur. With no labelled row of either class the score is the share of label 1
(0.5 without any label). Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import held_out

SHRINKAGE = 0.1
FLOOR = 1e-4
KEEP_AT = 0.3

_SPLIT = re.compile(r"[.\n]+")
_KIND = np.full(129, 6, np.uint8)  # 0 lower, 1 upper, 2 digit, 3 blank, 4 sentence marks, 5 symbols, 6 beyond ASCII
for _c in range(128):
    _ch = chr(_c)
    _KIND[_c] = 0 if _ch.islower() else 1 if _ch.isupper() else 2 if _ch.isdigit() else 3 if _ch.isspace() else 4 if _ch in ".,;:'\"?-()" else 5
_KIND[128] = 6
N_STATS = 18


def _logit(share: float) -> float:
    return float(np.log((share + 0.002) / (1.002 - share)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of a whole text."""
    text = text or ""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kinds = np.bincount(_KIND[np.minimum(points, 128)], minlength=7) / max(1, len(points))
    words = text.split()
    n = len(words)
    lengths = np.fromiter(map(len, words), np.float64, n)
    tally = Counter(words)
    top = max(tally.values(), default=0)
    parts = [p for p in map(str.strip, _SPLIT.split(text)) if p]
    letters = kinds[0] + kinds[1] + kinds[6]
    once = sum(1 for c in tally.values() if c == 1)
    return [
        float(np.log1p(len(text))),
        float(np.log1p(n)),
        float(np.log1p(lengths.mean() if n else 0.0)),
        float(np.log1p(lengths.std() if n else 0.0)),
        float(np.log1p(lengths.max(initial=0.0))),
        _logit(letters),
        _logit(kinds[1] / letters if letters else 0.0),
        _logit(kinds[2]),
        _logit(kinds[3]),
        _logit(kinds[4]),
        _logit(kinds[5]),
        _logit(len(tally) / n if n else 0.0),
        float(np.log1p(len(tally)) / np.log1p(n)) if n else 0.0,
        _logit(top / n if n else 0.0),
        _logit(once / n if n else 0.0),
        _logit(1 - len(set(parts)) / len(parts) if parts else 0.0),
        float(np.log1p(n / len(parts))) if parts else 0.0,
        _logit(float((lengths <= 2).mean()) if n else 0.0),
    ]


def text_statistics(text: Column | str) -> Column:
    """Statistics column of a text column."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(statistics)

    return run.asNondeterministic()(text)  # keeps the optimiser from computing it twice in one plan


@dataclass
class Discriminant:
    """Class means, cached inverse Cholesky factors, half log determinants and log prior ratio; or a constant score."""

    constant: float | None
    means: np.ndarray | None = None
    factors: np.ndarray | None = None
    halves: np.ndarray | None = None
    log_prior: float = 0.0

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        density = [-0.5 * (((x - m) @ f.T) ** 2).sum(1) - h for m, f, h in zip(self.means, self.factors, self.halves, strict=True)]
        return 1 / (1 + np.exp(-np.clip(density[1] - density[0] + self.log_prior, -500, 500)))


def fit(rows: DataFrame, shrinkage: float = SHRINKAGE) -> Discriminant:
    """A discriminant from rows (stats array, label 0/1): sums and cross products of all rows, by Spark."""
    rows = rows.filter("label in (0, 1)").select("label", F.concat(F.array(F.lit(1.0)), "stats").alias("x"))
    cells = rows.select("label", F.posexplode("x").alias("i", "xi"), "x").select("label", "i", F.posexplode("x").alias("j", "xj"), "xi").filter("j >= i")
    sums = cells.groupBy("label", "i", "j").agg(F.sum(F.col("xi") * F.col("xj")).alias("s")).collect()  # classes times statistics squared
    d = N_STATS + 1
    gram = np.zeros((2, d, d))
    for label, i, j, s in sums:
        gram[label, i, j] = gram[label, j, i] = s
    n = gram[:, 0, 0]
    if n.min() < 2:
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    means = gram[:, 0, 1:] / n[:, None]
    covs = gram[:, 1:, 1:] / n[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = np.maximum(np.einsum("c,cii->i", n / n.sum(), covs), FLOOR)
    factors, halves = [], []
    for c, count in enumerate(n):
        lam = min(1.0, shrinkage + N_STATS / count)
        low = np.linalg.cholesky((1 - lam) * covs[c] + np.diag(lam * pooled))
        factors.append(np.linalg.inv(low))
        halves.append(np.log(np.diag(low)).sum())
    return Discriminant(None, means, np.array(factors), np.array(halves), float(np.log(n[1] / n[0])))


def score(model: Discriminant, stats: Column) -> Column:
    """Score column of a statistics column."""

    @F.pandas_udf("double")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.array(s.tolist(), np.float64).reshape(len(s), N_STATS)), dtype=float)

    return run(stats)


def teach(docs_stats: DataFrame, labels: DataFrame, label_col: str = "quality", id_col: str = "doc_id") -> Discriminant:
    """Fit on the labelled rows outside the held-out fold; `docs_stats` has the id and `stats`."""
    known = labels.select(F.col(id_col).alias("__tm_id"), F.col(label_col).cast("int").alias("label"))
    train = docs_stats.filter(~held_out(id_col)).select(F.col(id_col).alias("__tm_doc"), "stats")
    return fit(train.join(known, F.col("__tm_doc") == F.col("__tm_id")).select("stats", "label"))


def drop_rejected(docs: DataFrame, model: Discriminant, threshold: float = KEEP_AT, text_col: str = "text", stats_col: str | None = None) -> DataFrame:
    """The rows whose text scores at least `threshold`; with `stats_col`, by statistics that are there already, which are dropped."""
    if stats_col:
        return docs.filter(score(model, F.col(stats_col)) >= threshold).drop(stats_col)

    @F.pandas_udf("boolean")
    def good(texts: pd.Series) -> pd.Series:
        x = np.array([statistics(t) for t in texts], np.float64).reshape(len(texts), N_STATS)
        return pd.Series(model.scores(x) >= threshold)

    return docs.filter(good.asNondeterministic()(F.col(text_col)))
