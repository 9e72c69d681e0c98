"""Fill-in-middle: cut every text at two line boundaries drawn from a hash and reorder prefix, middle and suffix.

A boundary lies between two adjacent characters of which the first is a newline; the units between boundaries are the
text's lines. A text of at most CHUNK characters is one chunk. A longer one is cut into chunks that overlap the next by what
a predicate looks at beyond its own characters; chunks are rows of their own, dealt over tasks, and each counts its
boundaries and looks for marks. The prefix sums of a text's counts say which chunks own the two drawn boundaries; those
alone are scanned again for the place. The text itself is then cut where its row is, as it has to be hashed or written whole.

Forms: psm is <P>prefix<S>suffix<M>middle, spm is <S>suffix<P>prefix<M>middle. Plain texts stay as they are: empty ones, those
that hold a mark themselves, and the share that a rate below 100 leaves out.

Defined cases: a null text is empty. A null id draws as the empty id. Rows that repeat an id draw alike, rows that repeat id and text give equal rows. An
empty table gives no rows. Places count code points. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import written

CHUNK = 65_536
#: The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
_OVERLAP = max(map(len, MARKS)) - 1
_NEWLINE = "\n"


def draws(doc_id: Column, seed: int, n: int = 4) -> list[Column]:
    """The first n groups of 8 hex digits of sha256("seed:id") as unsigned integers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("long") for i in range(n)]


def _marked(text: Column) -> Column:
    found = F.contains(text, F.lit(MARKS[0]))
    for mark in MARKS[1:]:
        found = found | F.contains(text, F.lit(mark))
    return found


def _boundaries(own: Column, last: Column) -> Column:
    """How many of a chunk's own characters are newlines with a character behind them; `last`: nothing follows the chunk."""
    newlines = F.length(own) - F.length(F.replace(own, F.lit(_NEWLINE), F.lit("")))
    return (newlines - F.when(last & F.endswith(own, F.lit(_NEWLINE)), 1).otherwise(0)).cast("long")


def _place(chunk: Column, k: Column) -> Column:
    """Characters up to and with the kth newline."""
    return (F.length(F.call_function("substring_index", chunk, F.lit(_NEWLINE), k.cast("int"))) + 1).cast("long")


def _ranks(doc_id: Column, n: Column, seed: int) -> tuple[Column, Column]:
    h1, h2 = draws(doc_id, seed, 2)
    return F.least(h1 % (n + 1), h2 % (n + 1)), F.greatest(h1 % (n + 1), h2 % (n + 1))


def _short(docs: DataFrame, seed: int) -> DataFrame:
    """Texts of one chunk: count, draw and place in the same row."""
    rows = docs.withColumn("n", F.when(F.length("text") > 0, _boundaries(F.col("text"), F.lit(True)) + 1).otherwise(F.lit(0)).cast("long"))
    low, high = _ranks(F.col("doc_id"), F.col("n"), seed)
    rows = rows.withColumn("low", low).withColumn("high", high)

    def at(rank: str) -> Column:
        return F.when(F.col(rank) == 0, F.lit(0)).when(F.col(rank) == F.col("n"), F.length("text")).otherwise(_place(F.col("text"), F.col(rank))).cast("long")

    return rows.select("doc_id", "text", "n", at("low").alias("a"), at("high").alias("b"), _marked(F.col("text")).alias("marked"))


def chunk_rows(long: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(key, doc_id, no, part, last): the overlapping chunks of texts, one row each, from rows (key, doc_id, text)."""
    parts = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{chunk}}}"), F.lit(0))
    rows = long.withColumn("parts", parts)
    rows = rows.select("key", "doc_id", F.posexplode(F.transform("parts", lambda p, i: F.struct(p.alias("own"), F.substring(F.coalesce(F.get("parts", i + 1), F.lit("")), 1, _OVERLAP).alias("next")))).alias("no", "x"))
    return rows.select("key", "doc_id", "no", F.concat("x.own", "x.next").alias("part"), F.length("x.own").alias("own"), (F.length("x.next") == 0).alias("last"))


def _long(docs: DataFrame, seed: int, chunk: int) -> DataFrame:
    """Texts of several chunks: counts side by side, prefix sums, and another look at the owners alone."""
    docs = docs.withColumn("key", F.sha2(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("text")).cast("binary"), 256))
    # Dealt by turns, not by key: copies of one text shall not meet.
    chunks = chunk_rows(docs, chunk).repartition(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    own = F.expr("substring(part, 1, own)")
    chunks = written(chunks.withColumn("found", _boundaries(own, F.col("last"))).withColumn("marked", _marked(F.col("part"))), "chunks")
    # Rows that repeat id and text have equal chunks: one of each is enough.
    counts = chunks.groupBy("key", "no").agg(F.first("doc_id").alias("doc_id"), F.first("own").alias("own"), F.first("found").alias("found"), F.max("marked").alias("marked"))
    text, before = Window.partitionBy("key"), Window.partitionBy("key").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    sums = counts.select("key", "doc_id", "no", "found", F.coalesce(F.sum("found").over(before), F.lit(0)).alias("before"), F.coalesce(F.sum("own").over(before), F.lit(0)).alias("begin"), (F.sum("found").over(text) + 1).alias("n"), F.sum("own").over(text).alias("length"), F.max("marked").over(text).alias("marked"))
    low, high = _ranks(F.col("doc_id"), F.col("n"), seed)
    ranks = F.explode(F.array(F.struct(F.lit("a").alias("which"), low.alias("rank")), F.struct(F.lit("b").alias("which"), high.alias("rank"))))
    sums = sums.select("*", ranks.alias("r")).select("*", "r.which", "r.rank")
    # The ends of the text belong to its first chunk: rank 0 is place 0, rank n is the length.
    ends = ((F.col("rank") == 0) | (F.col("rank") == F.col("n"))) & (F.col("no") == 0)
    inside = (F.col("rank") > F.col("before")) & (F.col("rank") <= F.col("before") + F.col("found")) & (F.col("rank") < F.col("n"))
    owners = written(sums.filter(ends | inside).withColumn("k", F.when(inside, F.col("rank") - F.col("before"))).select("key", "no", "which", "rank", "n", "length", "marked", "begin", "k"), "owners")
    scanned = owners.filter("k is not null").join(chunks.select("key", "no", "part"), ["key", "no"])
    places = scanned.select("key", "which", "n", "marked", (F.col("begin") + _place(F.col("part"), F.col("k"))).alias("at"))
    places = places.unionByName(owners.filter("k is null").select("key", "which", "n", "marked", F.when(F.col("rank") == 0, F.lit(0)).otherwise(F.col("length")).cast("long").alias("at")))
    cuts = places.groupBy("key").agg(F.first("n").alias("n"), F.max("marked").alias("marked"), F.max(F.when(F.col("which") == "a", F.col("at"))).alias("a"), F.max(F.when(F.col("which") == "b", F.col("at"))).alias("b"))
    return docs.join(written(cuts, "cuts"), "key").select("doc_id", "text", "n", "a", "b", "marked")


def fill_in_middle(docs: DataFrame, seed: int = 7, rate: int = 100, spm_rate: int = 50, chunk: int = CHUNK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars, output for every row."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    cut = _short(rows.filter(F.length("text") <= chunk), seed).unionByName(_long(rows.filter(F.length("text") > chunk), seed, chunk))
    h3, h4 = draws(F.col("doc_id"), seed)[2:]
    plain = (F.col("text") == "") | F.col("marked") | (h3 % 100 >= rate)
    cut = cut.withColumn("form", F.when(plain, "plain").when(h4 % 100 < spm_rate, "spm").otherwise("psm"))
    prefix, middle, suffix = F.expr("left(text, cast(a as int))"), F.expr("substring(text, cast(a + 1 as int), cast(b - a as int))"), F.expr("substring(text, cast(b + 1 as int))")
    p, s, m = map(F.lit, MARKS)
    output = F.when(F.col("form") == "psm", F.concat(p, prefix, s, suffix, m, middle)).when(F.col("form") == "spm", F.concat(s, suffix, p, prefix, m, middle)).otherwise(F.col("text"))
    formed = F.col("form") != "plain"
    return cut.select("doc_id", "n", "form", F.when(formed, F.col("a")).alias("prefix_chars"), F.when(formed, F.col("b") - F.col("a")).alias("middle_chars"), output.alias("output"))


def restore(output: Column, form: Column) -> Column:
    """The text that an output of that form was made from."""
    parts = F.split(output, "<[PSM]>", -1)
    part = lambda i: F.get(parts, F.lit(i))
    return F.when(form == "psm", F.concat(part(1), part(3), part(2))).when(form == "spm", F.concat(part(2), part(3), part(1))).otherwise(output)


def digest_columns(rows: DataFrame) -> DataFrame:
    """The outputs replaced by their digests and those of the texts rebuilt from them."""
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restore(F.col("output"), F.col("form"))).alias("restored_sha256"))
