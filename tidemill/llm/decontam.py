"""Benchmark decontamination by winnowing.

Words are [0-9a-z and all beyond ASCII]+ after lower-casing A-Z. From every text the smallest K-gram hash of each
run of W = window - K + 1 K-grams is kept (the last one on ties), so that any two texts that share `window` words in
a row share at least one kept fingerprint at the same place of that span. Training and test fingerprints are joined on
their hash, hits are confirmed word by word and extended to both sides as far as a window that holds the fingerprint
can reach; a run of `window` equal words or more is a hit, and so are all of its words. Items of fewer words than a
window are one window: their whole-item hash is looked up at every place of a text.

Before the join, training fingerprints pass a bitmap of fixed size (BITMAP_BITS, 2 MB) of the test fingerprints'
hashes: that is the only thing broadcast, and the join after it is exact, whatever the size of the benchmark.
Equal items are matched once, as a class, and named one by one at the end.

Defined cases: ids are longs. Null or empty text and text without words: zero words, no hit. Items without words never occur. Items
with a null id count for hit words, not among the items. Rows that repeat a document (id and text) get a row each.
An empty benchmark hits nothing; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import alnum_words, gram_hashes, hot_keys, spread_join, word_hashes, written

WINDOW = 10
K = 5
BITMAP_BITS = 24
CHUNK = 256
_FP = "pos int, gram int, hash long, before string, core string, after string"


def _flat(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """All words of some texts in one list, each text's word count, and for each word the end of its text."""
    split = [alnum_words(t) for t in texts]
    counts = np.array([len(w) for w in split], np.int64)
    return [w for ws in split for w in ws], counts, np.repeat(np.cumsum(counts), counts)


def _winnow(hashes: np.ndarray, ends: np.ndarray, window: int, k: int) -> np.ndarray:
    """Places of the K-grams that are the last smallest of some run of window - k + 1 K-grams within one text."""
    grams = gram_hashes(hashes, k)
    n = len(hashes) - window + 1
    if n <= 0:
        return np.empty(0, np.int64)
    least, at = grams[:n].copy(), np.arange(n)
    for j in range(1, window - k + 1):
        here = grams[j : j + n]
        lower = here <= least
        least[lower], at[lower] = here[lower], np.flatnonzero(lower) + j
    return np.unique(at[np.arange(n) + window <= ends[:n]])


def fingerprints(texts: list[str | None], window: int, k: int, short: tuple[int, ...], whole_short: bool, bitmap: np.ndarray | None) -> Iterator[tuple[int, list[tuple]]]:
    """For each text its word count and fingerprints (place, gram length, hash, words before, core, words after).

    With `whole_short`, a text below the window is one gram of its own length; otherwise grams of the lengths
    `short` are taken at every place. With a bitmap only fingerprints that it may hold are given."""
    words, counts, ends = _flat(texts)
    h = word_hashes(words)
    starts = np.cumsum(counts) - counts
    found: list[tuple[int, int, int]] = []

    def take(places: np.ndarray, grams: np.ndarray, size: int) -> None:
        values = grams[places]
        if bitmap is not None:
            low = (values & np.uint64((1 << BITMAP_BITS) - 1)).astype(np.int64)
            ok = (bitmap[low >> 3] >> (low & 7).astype(np.uint8)) & 1 == 1
            places, values = places[ok], values[ok]
        found.extend((int(p), size, int(v)) for p, v in zip(places, values.view(np.int64), strict=True))

    take(_winnow(h, ends, window, k), gram_hashes(h, k), k)
    if whole_short:
        for i in np.flatnonzero((counts > 0) & (counts < window)):
            own = h[starts[i] : starts[i] + counts[i]]
            found.append((int(starts[i]), -int(counts[i]), int(gram_hashes(own, len(own)).view(np.int64)[0])))
    for size in short:
        grams = gram_hashes(h, size)
        take(np.flatnonzero(np.arange(len(grams)) + size <= ends[: len(grams)]), grams, size) if size != k else None
    if k in short:
        grams = gram_hashes(h, k)
        take(np.flatnonzero(np.arange(len(grams)) + k <= ends[: len(grams)]), grams, -k)
    found.sort()
    side, at = window - k, 0
    for i, (lo, n) in enumerate(zip(starts, counts, strict=True)):
        rows = []
        while at < len(found) and found[at][0] < lo + n:
            p, size, value = found[at]
            # Short grams have negative lengths: they stand for themselves and aren't extended.
            kind = size if size == k else -abs(size)
            a, b = (max(lo, p - side), min(lo + n, p + k + side)) if kind > 0 else (p, p + abs(size))
            text = lambda x, y: b" ".join(words[x:y]).decode("utf-8", "replace")
            rows.append((p - int(lo), kind, value, text(a, p), text(p, p + abs(size)), text(p + abs(size), b)))
            at += 1
        yield int(n), rows


def _index(items: DataFrame, window: int, k: int) -> DataFrame:
    """Fingerprints of the distinct item texts: cls (of equal texts), gram, hash, before, core, after."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = list(fingerprints(pdf["norm"].tolist(), window, k, (), True, None))
            rows = [(cls, *fp[1:]) for cls, (_, fps) in zip(pdf["cls"], found, strict=True) for fp in fps]
            yield pd.DataFrame(rows, columns=["cls", "gram", "hash", "before", "core", "after"])

    return items.select("cls", "norm").dropDuplicates().mapInPandas(run, "cls string, gram int, hash long, before string, core string, after string").dropDuplicates()


def _normalised(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    low = F.translate(F.col(text_col), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    norm = F.array_join(F.filter(F.split(low, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != ""), " ")
    return benchmark.select(F.col(id_col).cast("string").alias("item_id"), norm.alias("norm")).filter("norm <> ''").withColumn("cls", F.md5("norm"))


def _common(a: str, b: str) -> str:
    """SQL: how many leading entries two word arrays share."""
    return f"if(least(size({a}), size({b})) < 1, 0, aggregate(sequence(1, least(size({a}), size({b}))), 0, (n, i) -> if(n = i - 1 and {a}[i - 1] = {b}[i - 1], i, n)))"


def row_key(id_col: str, text_col: str) -> Column:
    """Names a row by its id and whole text; rows that share it have the same verdict."""
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("null")), F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary")))


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, k: int = K, id_col: str = "doc_id", text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, uid (row_key), n_words, n_hit, items (sorted ids of items with occurring windows), spans (merged hit word ranges) per row."""
    spark = docs.sparkSession
    items = _normalised(benchmark, item_id_col, item_text_col)
    index = written(_index(items, window, k), "items")
    low = F.col("hash").bitwiseAND(F.lit((1 << BITMAP_BITS) - 1))
    cells = index.select(F.shiftright(low, 3).alias("cell"), F.expr(f"shiftleft(1, int((hash & {(1 << BITMAP_BITS) - 1}) & 7))").alias("bit")).groupBy("cell").agg(F.bit_or("bit").alias("bits"))
    bitmap = np.zeros(1 << (BITMAP_BITS - 3), np.uint8)
    for cell, bits in cells.toLocalIterator():  # at most 2**21 cells, whatever the benchmark's size
        bitmap[cell] = bits
    short = tuple(sorted(-r[0] for r in index.filter("gram < 0").select("gram").distinct().collect()))
    shared = spark.sparkContext.broadcast(bitmap)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bits = shared.value
        names = [x.split()[0] for x in _FP.split(", ")]
        for pdf in batches:
            for at in range(0, len(pdf), CHUNK):
                part = pdf.iloc[at : at + CHUNK]
                texts = part["text"].tolist()
                found = list(fingerprints(texts, window, k, short, False, bits))
                yield pd.DataFrame({"doc_id": part["doc_id"], "uid": part["uid"], "n_words": [n for n, _ in found], "fps": [[dict(zip(names, r, strict=True)) for r in rows] for _, rows in found]})

    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), row_key(id_col, text_col).alias("uid"), F.col(text_col).cast("string").alias("text"))
    marked = written(rows.mapInPandas(run, f"doc_id string, uid string, n_words long, fps array<struct<{_FP.replace(' ', ':').replace(',:', ',')}>>"), "marked")
    hits = marked.filter("size(fps) > 0").select("uid", F.explode("fps").alias("f")).select("uid", "f.*")
    theirs = index.select("cls", "gram", "hash", "core", F.col("before").alias("i_before"), F.col("after").alias("i_after"))
    hot = hot_keys(hits.groupBy("hash").count(), "hash", "count")  # a passage that very many texts share
    runs = spread_join(hits, theirs, "hash", hot, "inner", ("gram", "core")).selectExpr(
        "uid", "cls", "pos", "gram", "reverse(split(before, ' ')) a1", "reverse(split(i_before, ' ')) a2", "split(after, ' ') b1", "split(i_after, ' ') b2",
        "before", "after", "i_before", "i_after",
    )
    reach = runs.selectExpr("uid", "cls", "pos", "gram", f"if(before = '' or i_before = '', 0, {_common('a1', 'a2')}) l", f"if(after = '' or i_after = '', 0, {_common('b1', 'b2')}) r")
    spans = reach.filter(f"gram < 0 or l + gram + r >= {window}").selectExpr("uid", "cls", "pos - l lo", "pos + abs(gram) + r hi")
    merged = spans.groupBy("uid").agg(F.sort_array(F.collect_set(F.struct("lo", "hi"))).alias("s"), F.collect_set("cls").alias("classes"))
    # Ranges in order: one that begins within what is covered so far extends it, else a new range begins.
    fold = "aggregate(s, cast(array() as array<struct<lo:int,hi:int>>), (a, x) -> if(size(a) > 0 and x.lo <= element_at(a, -1).hi, concat(slice(a, 1, size(a) - 1), array(named_struct('lo', element_at(a, -1).lo, 'hi', greatest(element_at(a, -1).hi, x.hi)))), concat(a, array(named_struct('lo', x.lo, 'hi', x.hi)))))"
    merged = merged.select("uid", F.expr(fold).alias("spans"), "classes")
    members = items.filter("item_id is not null").groupBy("cls").agg(F.collect_set("item_id").alias("ids"))
    named = merged.select("uid", F.explode("classes").alias("cls")).join(members, "cls").groupBy("uid").agg(F.sort_array(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("items"))
    hot = hot_keys(marked.filter("size(fps) > 0").groupBy("uid").count(), "uid", "count")  # a row that is repeated very often
    found = merged.drop("classes").join(named, "uid", "left")
    out = spread_join(marked.select("doc_id", "uid", "n_words"), found, "uid", hot)
    n_hit = F.expr("aggregate(coalesce(spans, array()), 0L, (n, x) -> n + (x.hi - x.lo))")
    return out.select(F.col("doc_id").cast("long").alias("doc_id"), "uid", "n_words", n_hit.alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.coalesce("spans", F.array().cast("array<struct<lo:int,hi:int>>")).alias("spans"))


def digest_columns(found: DataFrame) -> DataFrame:
    """The compact form: counts, a digest of the item ids, and the verdict."""
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of documents without any hit, each judged by its own id and text."""
    key = row_key(options.get("id_col", "doc_id"), options.get("text_col", "text"))
    bad = contamination(docs, benchmark, **options).filter("n_hit > 0").select(F.col("uid").alias("__tm_uid")).distinct()
    return docs.withColumn("__tm_uid", key).join(bad, "__tm_uid", "left_anti").select(*docs.columns)
