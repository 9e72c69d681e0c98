"""Mixing sources to target weights: hash-random order, distributed prefix sums, an exact cut for each source.

A document's size is its number of words. The sources, in code-point order, get weights by turns; a budget of `share`
times all sizes is dealt to them in proportion to weight, no source beyond `most` times its own size, and what one can't
take goes to the others. A source's documents stand in the order of a hash; whole epochs are taken while the
target holds all of them, and the rest is the words before a cut in that order, so that a source's words
are its target, rounded down, exactly. The document at the cut gives its first words.

Hash keys are spread evenly, so equal ranges of keys are the sorted ranges of a source: each range is summed and scanned by itself, and the
ranges' totals give where each begins. Equal rows are counted before they move. Only sizes and keys are shuffled; texts are read once.

Defined cases: a null or blank text has size 0. A null source is a source of its own, the last one. Ids may be null or repeat: order is by
hash of id and text, then id and size; rows that are equal in all of them stand beside one another and each takes its own share.
Without any word all targets are 0. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import written

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
#: Rows of one range of keys; copies of one row that are written out by one task.
RANGE_ROWS = 20_000
COPY_ROWS = 100_000
_BLANK = r"[ \t-\r]"
_WORD = r"[^ \t-\r]"
_BITS = 60


def words(text: Column) -> Column:
    """Number of runs without blank, tab, newline, vertical tab, form feed or return; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(f"{_WORD}+")), F.lit(0)).cast("long")


def first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its nth word."""
    return F.array_join(F.slice(F.regexp_extract_all(text, F.lit(f"{_BLANK}*{_WORD}+"), F.lit(0)), F.lit(1), n.cast("int")), "")


def _source_key(source: Column) -> Column:
    """A key that is never null: code-point order, null last."""
    return F.coalesce(F.concat(F.lit("0"), source.cast("string")), F.lit("1"))


def _order_key(doc_id: Column, text: Column, seed: str) -> Column:
    """60 bits of a hash of id and text."""
    seen = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))))
    return F.conv(F.substring(seen, 1, _BITS // 4), 16, 10).cast("long")


def running_sums(df: DataFrame, order: list[str], sums: dict[str, str], name: str) -> DataFrame:
    """df with new columns: each the sum of a column over all rows before, in that order. `sums`: new name -> column.

    Ranges of rows are summed side by side; one row a range meets in one task."""
    part = "__tm_part"
    dealt = written(df.repartitionByRange(*order).withColumn(part, F.spark_partition_id()), name)
    parts = dealt.groupBy(part).agg(*[F.sum(c).alias(f"{n}__tm") for n, c in sums.items()])
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(part, *[F.coalesce(F.sum(f"{n}__tm").over(before), F.lit(0)).alias(f"{n}__tm") for n in sums])
    inside = Window.partitionBy(part).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = dealt.join(parts, part)
    return out.select(*df.columns, *[(F.col(f"{n}__tm") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(n) for n, c in sums.items()])


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source_key, source_size, target) from rows (source_key, source_size): shares by weight, none above its bound.

    A source is full where the even share that is left, once those of smaller bound a weight are full, passes its bound."""
    total = sizes.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("s")).first()["s"]
    budget = min(share, most) * total
    ranked = running_sums(sizes.withColumn("one", F.lit(1)), ["source_key"], {"place": "one"}, "sources")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = ranked.select("source_key", "source_size", weight.alias("w"), (most * F.col("source_size")).alias("bound"))
    ranked = ranked.withColumn("fill", F.col("bound") / F.col("w"))
    ranked = written(running_sums(ranked, ["fill", "source_key"], {"full": "bound", "full_w": "w"}, "filled"), "shares")
    all_w = ranked.agg(F.coalesce(F.sum("w"), F.lit(1)).alias("w")).first()["w"]
    left, left_w = F.lit(budget) - F.col("full"), F.lit(all_w) - F.col("full_w")
    open_ = ranked.filter(left / left_w < F.col("fill")).agg(F.min_by(F.struct(left.alias("left"), left_w.alias("w")), F.struct("fill", "source_key")).alias("x")).first()["x"]
    even = F.col("w") * F.lit(open_["left"]) / F.lit(open_["w"]) if open_ else F.col("bound").cast("double")
    return ranked.select("source_key", "source_size", F.least(even, F.col("bound").cast("double")).alias("target"))


def placed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each group of equal rows: source_key, key, doc_id, size, copies, source_size, target, epochs (that take
    all its words), start (the words before it in its source) and cut (the words of the last, partial epoch)."""
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(_source_key(F.col(source_col)).alias("source_key"), _order_key(F.col(id_col), text, seed).alias("key"), F.col(id_col).alias("doc_id"), words(text).alias("size"))
    rows = written(rows.groupBy("source_key", "key", "doc_id", "size").agg(F.count("*").alias("copies")), "sizes")
    sizes = written(rows.groupBy("source_key").agg(F.sum(F.col("size") * F.col("copies")).alias("source_size")), "source-sizes")
    ranges = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // RANGE_ROWS))
    width = -(-(1 << _BITS) // ranges)
    rows = rows.withColumn("range", F.expr(f"key div {width}L"))
    order = Window.partitionBy("source_key", "range").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    begins = rows.groupBy("source_key", "range").agg(F.sum(F.col("size") * F.col("copies")).alias("n"))
    before = Window.partitionBy("source_key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    begins = begins.select("source_key", "range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("begin"))
    goal = targets(sizes, weights, share, most)
    whole = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as long) div source_size")).otherwise(F.lit(0)).cast("long")
    begins = written(begins.join(goal.withColumn("epochs", epochs).withColumn("cut", whole - epochs * F.col("source_size")), "source_key"), "ranges")
    inside = F.coalesce(F.sum(F.col("size") * F.col("copies")).over(order), F.lit(0))
    rows = rows.withColumn("inside", inside).join(begins, ["source_key", "range"])
    return rows.select("source_key", "key", "doc_id", "size", "copies", "source_size", "target", "epochs", (F.col("begin") + F.col("inside")).alias("start"), "cut")


def _copies(groups: DataFrame, name: str) -> DataFrame:
    """A row for each copy, with `start` moved on; the copies of a large group are dealt over tasks."""
    groups = written(groups, name)
    most = groups.agg(F.max("copies").alias("n")).first()["n"] or 0
    rows = groups.withColumn("lot", F.explode(F.sequence(F.lit(0), F.expr(f"(copies - 1) div {COPY_ROWS}"))))
    if most > COPY_ROWS:
        rows = rows.repartition(int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    last = F.least(F.col("copies") - 1, F.col("lot") * COPY_ROWS + COPY_ROWS - 1)
    rows = rows.withColumn("copy", F.explode(F.sequence(F.col("lot") * COPY_ROWS, last)))
    return rows.withColumn("start", F.col("start") + F.col("copy") * F.col("size")).drop("lot", "copies")


def _cut_words() -> Column:
    return F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("cut") - F.col("start")))


def mix(docs: DataFrame, **options) -> DataFrame:
    """doc_id, size, source_size, target and taken (the words that the mix takes of it, repeats counted), for every row."""
    rows = _copies(placed(docs, **options), "placed")
    return rows.select("doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + _cut_words()).alias("taken"))


def mixed_texts(docs: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix itself: doc_id, source, epoch (from 0), n_words, text; one row for each document and epoch that takes words of it."""
    rows = _copies(placed(docs, seed=seed, id_col=id_col, text_col=text_col, source_col=source_col, **options), "placed")
    rows = rows.withColumn("epoch", F.explode(F.expr("sequence(0L, epochs)")))
    rows = rows.withColumn("n_words", F.when(F.col("epoch") < F.col("epochs"), F.col("size")).otherwise(_cut_words())).filter("n_words > 0")
    text = F.col(text_col).cast("string")
    texts = docs.select(_source_key(F.col(source_col)).alias("source_key"), _order_key(F.col(id_col), text, seed).alias("key"), F.col(source_col).alias("source"), text.alias("text"))
    texts = texts.groupBy("source_key", "key").agg(F.first("source").alias("source"), F.first("text").alias("text"))
    out = rows.join(texts, ["source_key", "key"])
    return out.select("doc_id", "source", "epoch", "n_words", F.when(F.col("n_words") < F.col("size"), first_words(F.col("text"), F.col("n_words"))).otherwise(F.col("text")).alias("text"))
