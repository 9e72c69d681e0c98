"""Catalog queries: lineage, live versions, zones and growth of paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import ancestors


def roots(edges: DataFrame, max_depth: int = 20) -> DataFrame:
    """node, root, depth from (node, parent) rows, by doubling: each round follows twice as many steps.

    Nodes on a cycle get a null root."""
    nodes = edges.select("node", F.coalesce("parent", "node").alias("up")).unionByName(edges.filter("parent is not null").select(F.col("parent").alias("node"), F.col("parent").alias("up")).join(edges.select("node"), "node", "left_anti").distinct())
    hops = nodes.withColumn("depth", (F.col("node") != F.col("up")).cast("long"))
    for _ in range(max(1, (max_depth - 1).bit_length())):
        over = hops.select(F.col("node").alias("up"), F.col("up").alias("up2"), F.col("depth").alias("d2"))
        hops = hops.join(over, "up").select("node", F.col("up2").alias("up"), (F.col("depth") + F.col("d2")).alias("depth"))
    ends = nodes.filter("node = up").select(F.col("node").alias("up"), F.lit(True).alias("end"))
    return hops.join(ends, "up", "left").select("node", F.when(F.col("end"), F.col("up")).alias("root"), F.when(F.col("end"), F.col("depth")).alias("depth"))


def live(versions: DataFrame, key: str = "dataset_id") -> DataFrame:
    """Versions that no other supersedes (`superseded_by` of their own row is null)."""
    return versions.filter("superseded_by is null")


def dangling(versions: DataFrame, key: str = "version_key") -> DataFrame:
    """Versions superseded by one that isn't registered."""
    return versions.filter("superseded_by is not null").join(versions.select(F.col(key).alias("superseded_by")), "superseded_by", "left_anti")


def classified(paths: DataFrame, zones: DataFrame, path: str = "path") -> DataFrame:
    """Each path with the longest zone that is it or an ancestor (null: none): an equi-join on exploded ancestors."""
    up = paths.select(path, F.explode(ancestors(F.col(path))).alias("zone"))
    best = up.join(zones, "zone").groupBy(path).agg(F.max_by("zone", F.length("zone")).alias("zone"))
    return paths.select(path).distinct().join(best, path, "left")


def outermost(paths: DataFrame, path: str = "path") -> DataFrame:
    """Paths that lie in no other path of the table."""
    above = paths.select(path, F.explode(F.slice(ancestors(F.col(path)), 1, F.size(ancestors(F.col(path))) - 1)).alias("up"))
    inner = above.join(paths.select(F.col(path).alias("up")).distinct(), "up").select(path).distinct()
    return paths.select(path).distinct().join(inner, path, "left_anti")


def growth(old: DataFrame, new: DataFrame, least: int, path: str = "path", size: str = "n_bytes", children: int = 3, share: float = 0.1) -> DataFrame:
    """path, growth, children: the deepest paths that grew by at least so much (none of their children did), each with at most
    `children` of its children, as path=growth, that made at least a share of its growth, the largest first."""
    every = new.join(old.select(path, F.col(size).alias("was")), path, "left").select(path, (F.col(size) - F.coalesce("was", F.lit(0))).alias("growth"))
    both, parent = every.filter(F.col("growth") >= least), F.regexp_extract(path, r"^(.*)/[^/]*$", 1)
    deepest = both.join(both.select(parent.alias(path)).distinct(), path, "left_anti")
    below = every.select(parent.alias(path), F.col(path).alias("child"), F.col("growth").alias("grown")).join(deepest, path).filter(F.col("grown") >= F.col("growth") * share)
    rank = F.row_number().over(Window.partitionBy(path).orderBy(F.desc("grown"), "child"))
    named = below.withColumn("r", rank).filter(F.col("r") <= children).groupBy(path).agg(F.array_sort(F.collect_list(F.struct("r", F.concat("child", F.lit("="), F.col("grown").cast("string")).alias("c")))).alias("c"))
    return deepest.join(named.select(path, F.array_join("c.c", ",").alias("children")), path, "left").select(path, "growth", F.coalesce("children", F.lit("")).alias("children"))


def allowed_moves(states: DataFrame, moves: set[tuple[str, str]], order: Column) -> DataFrame:
    """State changes that the transition table doesn't allow: key, from, to."""
    rows = states.withColumn("before", F.lag("state").over(Window.partitionBy("key").orderBy(order))).filter("before is not null")
    bad = ~F.concat_ws(">", "before", "state").isin(*[f"{a}>{b}" for a, b in moves])
    return rows.filter(bad).select("key", F.col("before").alias("from"), F.col("state").alias("to"))
