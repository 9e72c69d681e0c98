"""Exact top-k search by inner product: a KD-tree in every shard, best-first traversal with box bounds.

Vectors are cut to integers, floor(scale * x). Candidates are dealt at random into shards of bounded size, each of
which becomes one packed row: the tree's leaves (median splits on the widest side) and the tight bounding box of
every node. Queries are packed into blocks with a box of their own. Each block first searches one shard; the kth score
found there is propagated as the starting bound of the search in every other shard, so that subtrees whose box cannot
reach it are skipped. Which blocks meet which shards is settled before any vectors move: the pairs of numbers are dealt
from the shards' side, and those whose boxes cannot score what the block's least kth score asks for are dropped. A pair's
vectors come together as a group of one row, so that a task holds one shard and one block at a time. Only what
beats the bound leaves a shard, and the shards' lists are merged by rank.

The number of shards and of blocks is what their bounds SHARD_ROWS and BLOCK_ROWS ask for, and on a small input about the root of
twice the cores each, with LEAST_SHARD and LEAST_BLOCK rows at least: pairs come to a few times the cores until the bounds hold, and the
vectors that move are all pairs' shards and blocks.

Defined cases: vectors that are null, or hold null or non-finite components, take no part. Vectors are compared only
with vectors of the same length. Ties go to the smaller id. Rows that repeat an id are candidates each; a query's own
id is never its candidate. Queries given twice (same id and vector) are answered once, and an id with several query
vectors gets one list, the best of all of them. An empty table gives no rows. Ids are longs.
Cut components and scores beyond 64 bits are clamped.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import order_hash, written

SHARD_ROWS = 65_536
BLOCK_ROWS = 16_384
LEAF_ROWS = 256
LEAST_SHARD = 512
LEAST_BLOCK = 64
_PACKED = "dim int, part long, ids binary, cells binary, leaves binary, boxes binary, box array<double>"
_FOUND = "query_id long, vec_id long, score long"


def quantise(vector: Column, scale: int = 64) -> Column:
    """floor(scale * x) of every component as doubles holding whole numbers; null for vectors that take no part."""
    cells = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("double"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(vector.isNotNull() & ~bad, F.when(F.size(vector) >= 0, cells))


def _tree(x: np.ndarray, leaf_rows: int) -> tuple[np.ndarray, list[tuple[int, int, int, int]], np.ndarray]:
    """Row order, nodes (start, stop, left, right; -1: leaf) and boxes (lows, then highs) of a KD-tree."""
    order, nodes, boxes = np.arange(len(x)), [], []

    def grow(lo: int, hi: int) -> int:
        part = x[order[lo:hi]]
        low, high = (part.min(axis=0), part.max(axis=0)) if part.shape[1] else (np.empty(0), np.empty(0))
        at = len(nodes)
        nodes.append((lo, hi, -1, -1))
        boxes.append(np.concatenate([low, high]))
        if hi - lo > leaf_rows and part.shape[1] and (wide := int(np.argmax(high - low))) >= 0 and high[wide] > low[wide]:
            mid = (hi - lo) // 2
            order[lo:hi] = order[lo:hi][np.argpartition(part[:, wide], mid, kind="introselect")]
            left = grow(lo, lo + mid)
            nodes[at] = (lo, hi, left, grow(lo + mid, hi))
        return at

    grow(0, len(x))
    return order, nodes, np.array(boxes)


def _pack(key: tuple, pdf: pd.DataFrame, leaf_rows: int) -> pd.DataFrame:
    """One packed row of a group; without leaf_rows it has no tree."""
    pdf = pdf.sort_values(["vec_id"], kind="stable")
    dim, ids = int(key[0]), pdf["vec_id"].to_numpy(np.int64)
    x = np.array(pdf["cells"].tolist(), np.float64).reshape(len(pdf), dim)
    order, nodes, boxes = _tree(x, leaf_rows) if leaf_rows else (np.arange(len(x)), [], np.empty(0))
    box = np.concatenate([x.min(axis=0), x.max(axis=0)]) if dim else np.empty(0)
    return pd.DataFrame({"dim": [dim], "part": [key[1]], "ids": [ids[order].tobytes()], "cells": [_small(x[order])], "leaves": [np.array(nodes, np.int64).tobytes()], "boxes": [boxes.tobytes()], "box": [box]})


def _small(x: np.ndarray) -> bytes:
    """Cells as two-byte integers where all fit, else as doubles."""
    return x.astype(np.int16 if np.abs(x).max(initial=0) < 2**15 else np.float64).tobytes()


def _cells(packed: bytes, rows: int, dim: int) -> np.ndarray:
    return np.frombuffer(packed, np.int16 if len(packed) < 8 * rows * dim else np.float64).reshape(rows, dim).astype(np.float64)


def _times(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products a @ b.T: in doubles where no sum can reach 2**53, else in Python's integers, clamped."""
    most = (np.abs(a).max(initial=0) or 0) * (np.abs(b).max(initial=0) or 0) * max(1, a.shape[-1])
    if most < 2**53:
        return (a @ b.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in a], object).reshape(a.shape) @ np.array([[int(v) for v in r] for r in b], object).reshape(b.shape).T
    return np.clip(whole, -(2**63), 2**63 - 1).astype(np.int64)


def _search(q_ids: np.ndarray, q: np.ndarray, start: np.ndarray, ids: np.ndarray, x: np.ndarray, nodes: np.ndarray, boxes: np.ndarray, k: int) -> Iterator[tuple[int, int, int]]:
    """For each query the best k rows of the shard among those that reach the query's starting bound."""
    dim = q.shape[1]
    # The most that any point in a node's box can score; rounding can only be where sums pass 2**53, hence the slack.
    tops = np.maximum(q, 0) @ boxes[:, dim:].T + np.minimum(q, 0) @ boxes[:, :dim].T
    tops = tops + np.abs(tops) * 1e-9
    for i, own in enumerate(q_ids):
        kth, best, heap = start[i], [], [(-tops[i, 0], 0)]
        while heap and -heap[0][0] >= kth:
            lo, hi, left, right = nodes[heapq.heappop(heap)[1]]
            if left >= 0:
                for child in (left, right):
                    if tops[i, child] >= kth:
                        heapq.heappush(heap, (-tops[i, child], child))
                continue
            scores = _times(q[i : i + 1], x[lo:hi])[0]
            for j in np.flatnonzero(scores >= kth):
                if ids[lo + j] != own:
                    best.append((-int(scores[j]), int(ids[lo + j])))
            if len(best) >= k:
                best = heapq.nsmallest(k, best)
                kth = max(kth, -best[-1][0])
        for score, vec in sorted(best)[:k]:
            yield int(own), vec, -score


def _searched(pdf: pd.DataFrame, k: int) -> pd.DataFrame:
    """What one block finds in one shard."""
    found: list[tuple[int, int, int]] = []
    for r in pdf.itertuples():
        q_ids, ids, nodes = np.frombuffer(r.q_ids, np.int64), np.frombuffer(r.ids, np.int64), np.frombuffer(r.leaves, np.int64).reshape(-1, 4)
        q, x = _cells(r.q_cells, len(q_ids), r.dim), _cells(r.cells, len(ids), r.dim)
        start = np.frombuffer(r.bounds) if r.bounds else np.full(len(q_ids), -np.inf)
        found += _search(q_ids, q, start, ids, x, nodes, np.frombuffer(r.boxes).reshape(len(nodes), 2 * r.dim), k)
    return pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def _box_reach(a: str, b: str, dim: str) -> Column:
    """The most that a vector in box a can score with one in box b (each: lows, then highs), with slack for rounding."""
    ends = lambda box: f"transform(sequence(0, {dim} - 1), i -> named_struct('lo', {box}[i], 'hi', {box}[i + {dim}]))"
    most = f"aggregate(zip_with({ends(a)}, {ends(b)}, (x, y) -> greatest(x.lo * y.lo, x.lo * y.hi, x.hi * y.lo, x.hi * y.hi)), 0D, (s, v) -> s + v)"
    return F.expr(f"if({dim} = 0, 0D, transform(array({most}), m -> m + abs(m) * 1e-9)[0])")


def n_parts(rows: int, most: int, least: int, cores: int) -> int:
    """How many shards or blocks that many rows are dealt into."""
    return max(1, -(-rows // most), min(-(-rows // least), math.isqrt(2 * cores - 1) + 1))


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 64, shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS, leaf_rows: int = LEAF_ROWS, cores: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: the k candidates of highest integer inner product for every query."""
    cores = cores or candidates.sparkSession.sparkContext.defaultParallelism

    def parts(df: DataFrame, most: int, seed: str) -> DataFrame:
        df = df.select(F.col(id_col).cast("long").alias("vec_id"), quantise(F.col(vector_col), scale).alias("cells")).filter("cells is not null and vec_id is not null")
        n = n_parts(df.count(), most, min(most, LEAST_SHARD if seed == "shard" else LEAST_BLOCK), cores)
        # Rows that repeat an id are dealt apart.
        deal = F.pmod(order_hash("vec_id", F.monotonically_increasing_id(), seed=seed), F.lit(n))
        return df.select(F.size("cells").alias("dim"), deal.alias("part"), "vec_id", "cells")

    shards = parts(candidates, shard_rows, "shard").groupBy("dim", "part").applyInPandas(lambda key, pdf: _pack(key, pdf, leaf_rows), _PACKED)
    blocks = parts(queries.select(id_col, vector_col).dropDuplicates(), block_rows, "block").groupBy("dim", "part").applyInPandas(lambda key, pdf: _pack(key, pdf, 0), _PACKED)
    shards, blocks = written(shards, "shards"), written(blocks, "blocks")

    def numbered(packed: DataFrame, name: str) -> DataFrame:
        # Parts are numbered from 0 within each dimension, for pairs to be dealt by number; boxes join afterwards.
        number = F.row_number().over(Window.partitionBy("dim").orderBy("part")) - 1
        return written(packed.select("dim", "part").withColumn(name, number).join(packed.select("dim", "part", "box"), ["dim", "part"]), f"{name}-numbers")

    shard_no = numbered(shards, "shard")
    block_no = numbered(blocks, "block").select("dim", F.col("part").alias("q_part"), F.col("box").alias("q_box"), "block")
    n_shards = shard_no.groupBy("dim").agg(F.count("*").alias("n_shards"))
    n_blocks = block_no.groupBy("dim").agg(F.count("*").alias("n_blocks"))
    homes = block_no.join(n_shards, "dim").withColumn("shard", (F.col("block") % F.col("n_shards")).cast("int")).join(shard_no.select("dim", "shard", "part"), ["dim", "shard"]).select("dim", "q_part", "part")
    payload = blocks.select("dim", F.col("part").alias("q_part"), F.col("ids").alias("q_ids"), F.col("cells").alias("q_cells"))

    def search(pairs: DataFrame) -> DataFrame:
        # The pair is a group of its own: one shard and one block in memory at a time.
        work = pairs.join(payload, ["dim", "q_part"]).join(shards.drop("box"), ["dim", "part"])
        return work.groupBy("dim", "part", "q_part").applyInPandas(lambda pdf: _searched(pdf, k), _FOUND)

    # First round: each block in its home shard. The kth score found is a bound for all other shards.
    first = written(search(homes.withColumn("bounds", F.lit(None).cast("binary"))), "first")
    kth = first.groupBy("query_id").agg(F.expr(f"get(sort_array(collect_list(score), false), {k - 1})").alias("kth"))
    q_rows = payload.select("dim", "q_part", F.posexplode(_longs("q_ids")).alias("i", "query_id"))
    bounds = q_rows.join(kth, "query_id", "left").groupBy("dim", "q_part").agg(F.transform(F.sort_array(F.collect_list(F.struct("i", "kth"))), lambda s: s["kth"].cast("double")).alias("b"))
    least = F.when(F.exists("b", lambda v: v.isNull()), F.lit(float("-inf"))).otherwise(F.array_min("b")).alias("least")
    bounds = written(bounds.select("dim", "q_part", _doubles("b").alias("bounds"), least), "bounds")
    asked = block_no.join(bounds.select("dim", "q_part", "least"), ["dim", "q_part"])
    # The stated queries against all rows, in blocks: pairs of numbers, without vectors, and only where the boxes reach.
    pairs = shard_no.join(n_blocks, "dim").withColumn("block", F.explode(F.expr("sequence(0, cast(n_blocks - 1 as int))"))).join(asked, ["dim", "block"])
    pairs = pairs.filter(_box_reach("q_box", "box", "dim") >= F.col("least")).select("dim", "part", "q_part").join(homes, ["dim", "part", "q_part"], "left_anti")
    found = first.unionByName(search(pairs.join(bounds.drop("least"), ["dim", "q_part"])))
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.select("query_id", best.alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def _longs(name: str) -> Column:
    @F.pandas_udf("array<long>")
    def unpack(s: pd.Series) -> pd.Series:
        return s.map(lambda b: np.frombuffer(b, np.int64))

    return unpack(name)


def _doubles(name: str) -> Column:
    @F.pandas_udf("binary")
    def packed(s: pd.Series) -> pd.Series:
        return s.map(lambda a: np.array([-np.inf if v is None or v != v else v for v in a], np.float64).tobytes())

    return packed(name)
