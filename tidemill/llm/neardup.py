"""Near-duplicates by SetSketch registers, banding, likelihood estimates and exact verification.

A document's set: its distinct 2-word shingles (words: runs without blanks, A-Z lower-cased; fewer words: the whole
sequence). Documents with equal sets form a node. Each node has M registers, floor(1 - log_b x) of the least of
exponentially spread hashes, kept within 0..q+1: registers of a union are the registers' maxima. Bands of R registers
are hashed; nodes that share a band are candidates.

A bucket never gives all its pairs as rows: it links its members to one pivot (a star), the member that meets most
others, and each of these pairs passes a joint maximum-likelihood estimate from its registers' order (MARGIN below the
threshold, about six standard errors) before the full sets are compared. Links are contracted to components by
alternating stars. Members that met under the same pivot but are in different components are then compared with each
other in bounded blocks: first registers with registers, which names the members that have a likely partner in another
component, then the full sets of those alone; only links between components come out. A pair within one component
needs no link of its own. So every pair of texts that shares a band is compared, excluded by its registers, or already
connected. Buckets and pivots that very many nodes meet in are dealt over all partitions.

A pair of similarity 0.8 shares none of 40 bands of 5 registers with probability (1 - 0.8**5)**40, about 1e-7.

Defined cases: ids are longs. Null, empty or blank texts have an empty set and are linked with nothing. Rows with a null id are
grouped like others but can't name a component: theirs is named by the least known id, and they are kept only when no
id is known. Rows that share an id are one document to `kept`. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import blank_words, gram_hashes, hot_keys, mix, spread_join, word_hashes, written

SHINGLE_WORDS = 2
BANDS, ROWS = 40, 5
M = BANDS * ROWS
BASE, RATE, TOP = 1.001, 20.0, (1 << 16) - 2
MARGIN = 0.17
BLOCK_SHINGLES = 1_500_000
BLOCK_NODES = 4096
_MULTIPLY = mix(np.arange(1, M + 1, dtype=np.uint64)) | np.uint64(1)
_ADD = mix(np.arange(1001, M + 1001, dtype=np.uint64))


def shingle_set(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles."""
    h = word_hashes(blank_words(text))
    return np.unique(gram_hashes(h, min(words, len(h)))) if len(h) else np.empty(0, np.uint64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    most = np.zeros(M, np.uint64)
    for at in range(0, len(hashes), 1024):
        spread = _MULTIPLY[:, None] * hashes[None, at : at + 1024] + _ADD[:, None]
        np.maximum(most, spread.max(axis=1), out=most)
    # The largest of uniform hashes u is the least of the exponentials -ln(u) / RATE.
    gap = (np.uint64(0xFFFFFFFFFFFFFFFF) - most).astype(np.float64) + 1.0
    least = -np.log1p(-np.minimum(gap / 2.0**64, 1 - 2.0**-53)) / RATE
    return np.clip(np.floor(1 - np.log(least) / np.log(BASE)), 0, TOP + 1).astype(np.uint16)


def merge_registers(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def estimate_similarity(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Joint maximum-likelihood similarity of pairs (rows) from how many registers are equal, greater or less."""
    more, less = (a > b).sum(1)[:, None], (a < b).sum(1)[:, None]
    same = a.shape[1] - more - less
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u
    grid = np.linspace(0, 1, 201)[None, :] * np.minimum(u / v, v / u)
    p = lambda x: -np.log1p(-np.maximum(x, 0) * (BASE - 1) / BASE) / np.log(BASE)
    p_more, p_less = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    score = more * np.log(p_more + tiny) + less * np.log(p_less + tiny) + same * np.log(np.maximum(1 - p_more - p_less, 0) + tiny)
    return grid[np.arange(len(grid)), score.argmax(1)]


def _sketch(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, node (digest of the set; null: empty), regs."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            sizes, nodes, regs = [], [], []
            for text in pdf["text"]:
                s = shingle_set(text)
                sizes.append(len(s))
                nodes.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
                regs.append(registers(s).tobytes() if len(s) else None)
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "th": pdf["th"], "n_shingles": sizes, "node": nodes, "regs": regs})

    # Ids pass Python as text: a batch with nulls would turn longs into doubles.
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInPandas(run, "doc_id string, th long, n_shingles long, node binary, regs binary").withColumn("doc_id", F.col("doc_id").cast("long"))


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One hash per band for each row of registers."""
    table = regs.reshape(len(regs), BANDS, ROWS).astype(np.uint64)
    keys = np.broadcast_to(mix(np.arange(BANDS, dtype=np.uint64) + np.uint64(77)), table.shape[:2]).copy()
    for j in range(ROWS):
        keys = mix(keys * np.uint64(31) + table[:, :, j])
    return keys.view(np.int64)


def _band_keys(regs: str) -> Column:
    @F.pandas_udf("array<long>")
    def run(s: pd.Series) -> pd.Series:
        return pd.Series(list(band_keys(np.frombuffer(b"".join(s), np.uint16).reshape(len(s), M))), dtype=object)

    return run(regs)


def _estimated(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """Pairs (a, b) of node numbers whose sizes and estimate allow the threshold."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                a, b = (np.frombuffer(b"".join(pdf[c]), np.uint16).reshape(len(pdf), M) for c in ("ra", "rb"))
                pdf = pdf[estimate_similarity(a, b, pdf["na"].to_numpy(float), pdf["nb"].to_numpy(float)) >= threshold - MARGIN]
            yield pdf[["a", "b"]]

    side = lambda x: nodes.select(F.col("nid").alias(x), F.col("n").alias(f"n{x}"), F.col("regs").alias(f"r{x}"))
    sized = pairs.join(nodes.select(F.col("nid").alias("a"), F.col("n").alias("na")), "a").join(nodes.select(F.col("nid").alias("b"), F.col("n").alias("nb")), "b")
    fits = sized.filter(F.least("na", "nb") >= F.greatest("na", "nb") * (threshold - 1e-9)).select("a", "b")
    return fits.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


def _texts(wanted: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(nid, node, text): one document's text for each wanted node number."""
    wanted = wanted.join(nodes.select("nid", "node", "rep.*"), "nid")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("th"), F.col(text_col).cast("string").alias("text"))
    match = [wanted["doc_id"].eqNullSafe(texts["doc_id"]), wanted["th"] == texts["th"]]
    return wanted.join(texts, match).select("nid", "node", "text").dropDuplicates(["nid"])


def _checked_set(text: str, node: bytes) -> np.ndarray:
    found = shingle_set(text)
    if xxhash.xxh3_128_digest(found.tobytes()) != node:
        raise ValueError("a document's text changed while it was read")
    return found


def _verified(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """The pairs whose full sets have 100 * intersection >= percent * union."""
    own = _texts(pairs.select(F.explode(F.array("a", "b")).alias("nid")).distinct(), nodes, docs, id_col, text_col)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last: dict[int, np.ndarray] = {}

        def get(nid: int, node: bytes, text: str) -> np.ndarray:
            if nid not in last:
                if len(last) > 64:
                    last.clear()
                last[nid] = _checked_set(text, node)
            return last[nid]

        for pdf in batches:
            keep = []
            for r in pdf.itertuples():
                a, b = get(r.a, r.node_a, r.text_a), get(r.b, r.node_b, r.text_b)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield pdf.loc[keep, ["a", "b"]]

    side = lambda x: own.select(F.col("nid").alias(x), F.col("node").alias(f"node_{x}"), F.col("text").alias(f"text_{x}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").mapInPandas(run, "a long, b long")


def block_links(sets: list[np.ndarray], nids: list[int], comps: list[int], left: list[bool], right: list[bool], percent: int) -> list[tuple[int, int]]:
    """Links between left and right members of different components, one for each two components they join."""
    root = {c: c for c in comps}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    sizes = np.array([len(s) for s in sets])
    flat, back = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.cumsum(sizes) - sizes
    ys = np.flatnonzero(right)
    ids = np.concatenate([back[starts[y] : starts[y] + sizes[y]] for y in ys])
    at = np.cumsum(sizes[ys]) - sizes[ys]
    mark, out = np.zeros(len(flat), np.int32), []
    for x in np.flatnonzero(left):
        own = back[starts[x] : starts[x] + sizes[x]]
        mark[own] = 1
        both = np.add.reduceat(mark[ids], at)
        mark[own] = 0
        for y in ys[100 * both >= percent * (sizes[x] + sizes[ys] - both)]:
            a, b = find(comps[x]), find(comps[y])
            if a != b:
                root[max(a, b)] = min(a, b)
                out.append((min(nids[x], nids[y]), max(nids[x], nids[y])))
    return out


def likely_partners(regs: np.ndarray, sizes: np.ndarray, comps: np.ndarray, left: np.ndarray, right: np.ndarray, threshold: float) -> np.ndarray:
    """Which members have one on the other side, in another component, whose size and registers allow the threshold."""
    found = np.zeros(len(sizes), bool)
    ys = np.flatnonzero(right)
    for x in np.flatnonzero(left):
        near = ys[(comps[ys] != comps[x]) & (np.minimum(sizes[ys], sizes[x]) >= np.maximum(sizes[ys], sizes[x]) * (threshold - 1e-9))]
        near = near[(regs[near] == regs[x]).sum(1) >= (threshold - MARGIN) * M]
        found[near] = True
        found[x] |= len(near) > 0
    return found


def _dealt(group: DataFrame, size: Column, per_block: int, least: int) -> DataFrame:
    """pivot, i, j, own, nid, comp: the members of each pivot's group, dealt into blocks of about per_block, once for every
    pair (i, j) of blocks that has to meet. The group's main component lies in blocks apart, and no two of these meet."""
    parts = group.groupBy("pivot", "comp").agg(F.count("*").alias("c"), F.sum(size).alias("n"))
    mains = parts.groupBy("pivot").agg(F.max(F.struct("c", "comp", "n")).alias("main"), F.count("*").alias("k"), F.sum("c").alias("m"), F.sum("n").alias("n")).filter(f"k > 1 and m >= {least}")
    blocks = lambda n: F.ceil(n / per_block).cast("int")
    mains = mains.select("pivot", "m", F.col("main.comp").alias("main"), blocks(F.col("main.n")).alias("bm"), blocks(F.col("n") - F.col("main.n")).alias("br"))
    mains = written(mains, "mains")
    rows = spread_join(group, mains.drop("m"), "pivot", hot_keys(mains, "pivot", "m"), "inner").withColumn("is_main", F.col("comp") == F.col("main"))
    rows = rows.withColumn("own", F.when(F.col("is_main"), F.pmod(F.xxhash64("nid"), "bm")).otherwise(F.pmod(F.xxhash64("nid"), "br") + F.col("bm")).cast("int"))
    rest = "transform(sequence(bm, bm + br - 1), r -> named_struct('i', least(own, r), 'j', greatest(own, r)))"
    main = "transform(sequence(0, bm - 1), b -> named_struct('i', b, 'j', own))"
    rows = rows.withColumn("ij", F.explode(F.expr(f"if(is_main, {rest}, concat({main}, {rest}))")))
    return rows.select("pivot", "ij.i", "ij.j", "own", "nid", "comp")


def _crossing(members: DataFrame, labels: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, percent: int, block_shingles: int, block_nodes: int) -> DataFrame:
    """Links across components among nodes that met in buckets of the same pivot.

    Pairs are compared within tasks of two blocks and never made as rows: registers first, from which only the members that
    have a likely partner come, then full sets, from which at most one link for each two components comes."""
    group = written(members.select("pivot", "nid").distinct().join(labels, "nid", "left").withColumn("comp", F.coalesce("comp", "nid")).join(nodes.select("nid", "n"), "nid"), "groups")

    def likely(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        regs = np.frombuffer(b"".join(pdf["regs"]), np.uint16).reshape(len(pdf), M)
        own = pdf["own"].to_numpy()
        found = likely_partners(regs, pdf["n"].to_numpy(), pdf["comp"].to_numpy(), own == key[1], own == key[2], percent / 100)
        return pd.DataFrame({"pivot": pdf.loc[found, "pivot"], "nid": pdf.loc[found, "nid"]})

    rows = _dealt(group, F.lit(1), block_nodes, 3)  # of two members one is the pivot: they were compared
    marked = rows.join(nodes.select("nid", "n", "regs"), "nid").groupBy("pivot", "i", "j").applyInPandas(likely, "pivot long, nid long")
    group = written(group.join(marked.distinct(), ["pivot", "nid"]), "likely-groups")

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        sets = [_checked_set(t, n) for t, n in zip(pdf["text"], pdf["node"], strict=True)]
        left, right = pdf["own"] == key[1], pdf["own"] == key[2]
        found = block_links(sets, pdf["nid"].tolist(), pdf["comp"].tolist(), left.tolist(), right.tolist(), percent) if left.any() and right.any() else []
        return pd.DataFrame(found, columns=["a", "b"]).astype("int64")

    rows = _dealt(group, F.col("n"), block_shingles, 2)
    texts = _texts(rows.select("nid").distinct(), nodes, docs, id_col, text_col)
    return rows.join(texts, "nid").groupBy("pivot", "i", "j").applyInPandas(run, "a long, b long")


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(nid, comp) for every linked node: comp is the least node of its component, by alternating stars.

    Each round is written to the shared folder; it ends when the links no longer change. Large stars are joins on a
    node whose links may be split by a skew join; nothing is gathered per node but a minimum."""
    spark = links.sparkSession
    edges = written(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "links")
    mark = None
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        small = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(small, "u").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        edges = written(moved.filter("u <> v").distinct(), "links")
        now = edges.agg(F.count("*"), F.coalesce(F.bit_xor(F.xxhash64("u", "v")), F.lit(0)), F.count_distinct("u")).first()
        if tuple(now) == mark and now[0] == now[2]:
            break
        mark = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    roots = edges.select(F.col("v").alias("nid"), F.col("v").alias("comp")).distinct()
    return spark.createDataFrame([], "nid long, comp long") if not now[0] else edges.select(F.col("u").alias("nid"), F.col("v").alias("comp")).unionByName(roots)


def _grouped(docs: DataFrame, percent: int, id_col: str, text_col: str, block_shingles: int = BLOCK_SHINGLES, block_nodes: int = BLOCK_NODES) -> DataFrame:
    """doc_id, th (hash of the text), n_shingles, component_id, kept for every row."""
    threshold = percent / 100
    rows = written(_sketch(docs, id_col, text_col), "sketches")
    nodes = rows.filter("node is not null").groupBy("node").agg(F.min(F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "th")).alias("rep"), F.first("n_shingles").alias("n"), F.first("regs").alias("regs"))
    nodes = written(nodes.withColumn("nid", F.monotonically_increasing_id()), "nodes")
    bands = nodes.select("nid", F.explode(_band_keys("regs")).alias("key"))
    # The pivot of a bucket is the member that meets the most others over all its buckets: the text that copies were
    # made from is nearer to each of them than they are to each other.
    crowd = written(bands.groupBy("key").agg(F.count("*").alias("c")).filter("c > 1"), "crowd")
    hot = hot_keys(crowd, "key", "c")
    met = written(spread_join(bands, crowd, "key", hot, "inner"), "met")
    degree = met.groupBy("nid").agg(F.sum("c").alias("degree"))
    ranked = met.join(degree, "nid").groupBy("key").agg(F.max(F.struct("degree", (-F.col("nid")).alias("low"))).alias("top"))
    members = written(spread_join(met.select("key", "nid"), ranked.select("key", (-F.col("top.low")).alias("pivot")), "key", hot, "inner"), "members")
    stars = members.filter("nid <> pivot").select(F.least("pivot", "nid").alias("a"), F.greatest("pivot", "nid").alias("b")).distinct()
    likely = written(_estimated(stars, nodes, threshold), "likely")
    links = written(_verified(likely, nodes, docs, id_col, text_col, percent), "verified")
    labels = written(components(links), "labels")
    more = written(_crossing(members, labels, nodes, docs, id_col, text_col, percent, block_shingles, block_nodes), "crossing")
    if more.limit(1).count():
        labels = written(components(links.unionByName(more)), "labels")
    comps = nodes.select("nid", "node", "rep.doc_id").join(labels, "nid", "left").withColumn("comp", F.coalesce("comp", "nid"))
    named = comps.groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    ids = comps.join(named, "comp").select("node", "component_id")
    out = rows.select("doc_id", "th", "n_shingles", "node").join(ids, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "th", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", **blocks) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row. `blocks`: block_shingles and block_nodes bound a task's work."""
    return _grouped(docs, percent, id_col, text_col, **blocks).drop("th")


def drop_near_duplicates(docs: DataFrame, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that near_duplicates keeps; rows of one id go or stay each by its own text."""
    gone = _grouped(docs, percent, id_col, text_col).filter("not kept").select(F.col("doc_id").alias("__tm_gone"), F.col("th").alias("__tm_th")).distinct()
    return docs.join(gone, docs[id_col].eqNullSafe(F.col("__tm_gone")) & (F.xxhash64(docs[text_col]) == F.col("__tm_th")), "left_anti")
