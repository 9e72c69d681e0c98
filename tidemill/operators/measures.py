"""Aggregates: ratios of sums, intervals of confidence, digests, roll-ups."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def exact_sum(value: Column) -> Column:
    """A sum that doesn't depend on the order of rows: in decimals."""
    return F.sum(value.cast("decimal(38,9)")).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio of sums with a denominator of at least 1."""
    return F.sum(numerator) / F.greatest(F.sum(denominator), F.lit(1))


def wilson(hits: Column, n: Column, z: float = 1.96) -> tuple[Column, Column]:
    """Wilson interval of a share; 0 to 1 without rows."""
    p, zz = hits / n, z * z
    mid, half = (p + zz / (2 * n)) / (1 + zz / n), z * F.sqrt(p * (1 - p) / n + zz / (4 * n * n)) / (1 + zz / n)
    return F.when(n == 0, 0.0).otherwise(F.greatest(mid - half, F.lit(0.0))), F.when(n == 0, 1.0).otherwise(F.least(mid + half, F.lit(1.0)))


def bootstrap(df: DataFrame, group: list[str], delta: str, weight: str, rounds: int = 200, seed: int = 7) -> DataFrame:
    """Paired difference sum(delta) / max(sum(weight), 1) with a 95 % interval by Poisson resampling.

    Every row draws its own counts for all rounds from its position-free hash, so that partial sums per round can be
    added up by Spark: no group is gathered."""
    types = dict(df.dtypes)

    def partial(batches):
        for pdf in batches:
            for key, part in pdf.groupby(group, dropna=False, sort=False):
                draws = np.array([np.random.default_rng([seed, h & 0x7FFFFFFF]).poisson(1.0, rounds) for h in part["__h"]])
                key = [None if k != k else k for k in key]  # a null group, which pandas gives as NaN
                out = pd.DataFrame([(*key, (draws * part[[delta]].to_numpy()).sum(0).tolist(), (draws * part[[weight]].to_numpy()).sum(0).tolist())], columns=[*group, "d", "w"])
                yield out.astype(dict.fromkeys(group, object))

    sums = df.withColumn("__h", F.xxhash64(*df.columns)).mapInPandas(partial, ", ".join(f"{g} {types[g]}" for g in group) + ", d array<double>, w array<double>")
    cells = sums.select(*group, F.posexplode(F.arrays_zip("d", "w")).alias("i", "x")).groupBy(*group, "i").agg((F.sum("x.d") / F.greatest(F.sum("x.w"), F.lit(1.0))).alias("r"))
    ends = cells.groupBy(*group).agg(F.sort_array(F.collect_list("r")).alias("r")).select(*group, F.expr(f"r[{int(0.025 * rounds)}]").alias("low"), F.expr(f"r[{int(0.975 * rounds)}]").alias("high"))
    points = df.groupBy(*group).agg(ratio(F.col(delta), F.col(weight)).alias("point"))
    same = [points[g].eqNullSafe(ends[g]) for g in group]
    return points.join(ends, same).select(*[points[g] for g in group], "point", "low", "high")


def multiset_digest(row_text: Column) -> list[Column]:
    """Eight sums of 32-bit words of sha256: equal for equal multisets of rows, whatever their order."""
    h = F.sha2(row_text, 256)
    return [F.sum(F.conv(F.substring(h, 8 * i + 1, 8), 16, 10).cast("decimal(38,0)")).alias(f"w{i}") for i in range(8)]


def combine_digest(sums: list[int]) -> str:
    """The digest modulo 2**256 from the eight sums."""
    return f"{sum(int(s or 0) << (32 * (7 - i)) for i, s in enumerate(sums)) % (1 << 256):064x}"


def rolled_up(df: DataFrame, path: Column, values: dict[str, Column]) -> DataFrame:
    """Values added up at a path and all its ancestors: one explode, one shuffle."""
    from tidemill.functions.text import ancestors

    return df.select(F.explode(ancestors(path)).alias("path"), *[v.alias(k) for k, v in values.items()]).groupBy("path").agg(F.count("*").alias("n"), *[F.sum(k).alias(k) for k in values])


def top_and_other(df: DataFrame, name: str, value: str, n: int) -> DataFrame:
    """The n largest rows of a small table and the rest as `other`."""
    ranked = df.withColumn("__r", F.row_number().over(Window.orderBy(F.desc(value), name)))
    return ranked.groupBy(F.when(F.col("__r") <= n, F.col(name)).otherwise("other").alias(name)).agg(F.sum(value).alias(value))
