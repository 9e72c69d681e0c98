"""Picks in a stated order: caps, samples, winners, pairs and dealing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.session import kept


def capped(df: DataFrame, group: list[str], order: list, cap: int) -> DataFrame:
    """At most `cap` rows of each group, first in order."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(*group).orderBy(*order))).filter(F.col("__rank") <= cap).drop("__rank")


def firsts(df: DataFrame, key: list[str], order: list) -> DataFrame:
    """The first row of every key."""
    return capped(df, key, order, 1)


def winners(df: DataFrame, key: list[str], ok: Column, seq: str, columns: list[str]) -> DataFrame:
    """The last row that went well per key, else the last row: one aggregate, no window."""
    return df.groupBy(*key).agg(F.max_by(F.struct(*columns), F.struct(ok.cast("int"), F.col(seq))).alias("__row")).select(*key, *[f"__row.{c}" for c in columns])


def hash_place(df: DataFrame, group: list[str], key: Column, name: str = "place") -> DataFrame:
    """The place of each row in its group by a hexadecimal hash, from 1, and the group's size as `name`_of.

    Rows are ranked within groups of one prefix of the hash (four digits), to which the counts of the prefixes before are added:
    no task sorts a whole group, however large it is."""
    rows = df.withColumn("__key", key).withColumn("__prefix", F.substring("__key", 1, 4))
    counts = rows.groupBy(*group, "__prefix").agg(F.count("*").alias("n"))
    w = Window.partitionBy(*group)
    before = counts.select(*group, "__prefix", (F.sum("n").over(w.orderBy("__prefix")) - F.col("n")).alias("__before"), F.sum("n").over(w).alias(f"{name}_of"))
    own = F.row_number().over(Window.partitionBy(*group, "__prefix").orderBy("__key"))
    return rows.withColumn("__own", own).join(before, [*group, "__prefix"]).withColumn(name, F.col("__before") + F.col("__own")).drop("__key", "__prefix", "__own", "__before")


def dealt(df: DataFrame, group: list[str], key: Column, size: int) -> DataFrame:
    """Rows dealt round robin in the order of a hash into as many hands of about `size` as fit (one at least): `hand` from 0."""
    rows = hash_place(df, group, key, "__at")
    hands = F.greatest(F.lit(1), F.rint(F.col("__at_of") / size).cast("int"))
    return rows.withColumn("hand", ((F.col("__at") - 1) % hands).cast("int")).drop("__at", "__at_of")


def paired(df: DataFrame, group: list[str], key: Column, id_col: str) -> DataFrame:
    """Neighbours in the order of a hash as pairs: first with second, third with fourth; an odd last row stays alone."""
    rows = hash_place(df, group, key, "__r").groupBy(*group, F.ceil(F.col("__r") / 2).alias("pair"))
    return rows.agg(F.min_by(id_col, "__r").alias("first"), F.max_by(id_col, "__r").alias("second"), F.count("*").alias("n")).filter("n = 2").drop("n")


def matched(df: DataFrame, group: list[str], kind: str, order: list) -> DataFrame:
    """As many rows of every kind per group as the rarest kind has (none if a kind is missing)."""
    kinds = df.select(kind).distinct().count()
    quota = df.groupBy(*group, kind).count().groupBy(*group).agg(F.min("count").alias("__n"), F.count("*").alias("__k")).filter(F.col("__k") == kinds)
    rank = F.row_number().over(Window.partitionBy(*group, kind).orderBy(*order))
    return df.withColumn("__r", rank).join(quota, group).filter("__r <= __n").drop("__r", "__n", "__k")


def quotas(cells: DataFrame, amount: int, weight: str, cell: str) -> DataFrame:
    """An amount shared over cells in proportion, by largest remainder (ties by cell). For tables of cells, not of rows."""
    total = cells.agg(F.sum(weight)).first()[0] or 0
    shares = cells.select(cell, (F.col(weight) * F.lit(amount) / F.lit(total or 1)).alias("share")).withColumn("base", F.floor("share"))
    rest = amount - (shares.agg(F.sum("base")).first()[0] or 0)
    rank = F.row_number().over(Window.orderBy(F.desc(F.round(F.col("share") - F.col("base"), 9)), cell))
    return shares.select(cell, (F.col("base") + F.when(rank <= rest, 1).otherwise(0)).alias("quota"))


def shard_of(files: DataFrame, seed: int, epoch: int, shards: int, name: str = "file") -> DataFrame:
    """Files in the order of an epoch and the shard that reads each: every file in exactly one."""
    key = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.lit(str(epoch)), F.col(name)), 256)
    return hash_place(files, [], key, "__at").withColumn("shard", ((F.col("__at") - 1) % shards).cast("int")).drop("__at", "__at_of")


def capped_in_order(rows: DataFrame, keys: str, order: str, cap: int, n: int | None = None) -> DataFrame:
    """id columns and `status` (chosen, capped or over) of rows that are let in one after the other in order: a row is chosen unless one of its
    keys was in `cap` chosen rows already, and the first n chosen count. `order` is different for every row.

    Rounds of reservations stand for the scan. A row that is among the first of each of its keys, as many as the key still has
    room for, is chosen whatever becomes of those before it; rows with a key that is full are capped; the others wait. The
    first row that waits is always settled. Within a round a key needs only its first rows: parts of a hot key are cut down before they meet.
    Rows without a key are chosen. A key given twice in a row counts once."""
    waiting = rows.select(F.col(order).alias("__o"), F.array_distinct(F.filter(F.coalesce(F.col(keys), F.array()), lambda k: k.isNotNull())).alias("__k"))
    free = waiting.filter(F.size("__k") == 0).select("__o", F.lit("chosen").alias("status"))
    waiting, settled, used = kept(waiting.filter(F.size("__k") > 0), "waiting"), [free], None
    while not waiting.isEmpty():
        pairs = waiting.select("__o", F.size("__k").alias("of"), F.explode("__k").alias("k"))
        pairs = pairs.withColumn("room", F.lit(cap)) if used is None else pairs.join(used, "k", "left").withColumn("room", cap - F.coalesce("used", F.lit(0))).drop("used")
        first = pairs.withColumn("part", F.pmod(F.xxhash64("__o"), F.lit(64)))
        for keyed in (["k", "part"], ["k"]):
            first = first.withColumn("r", F.row_number().over(Window.partitionBy(*keyed).orderBy("__o"))).filter(F.col("r") <= F.col("room"))
        sure = first.groupBy("__o", "of").agg(F.count("*").alias("met")).filter("met = of").select("__o", F.lit(True).alias("sure"))
        marked = kept(waiting.join(sure, "__o", "left"), "marked")
        settled.append(marked.filter("sure").select("__o", F.lit("chosen").alias("status")))
        new = marked.filter("sure").select(F.explode("__k").alias("k")).groupBy("k").agg(F.count("*").alias("used"))
        new = new if cap else pairs.select("k").distinct().withColumn("used", F.lit(0).cast("long"))
        used = kept(new if used is None else used.unionByName(new).groupBy("k").agg(F.sum("used").alias("used")), "used")
        rest = marked.filter("sure is null").drop("sure")
        full = rest.select("__o", F.explode("__k").alias("k")).join(used.filter(F.col("used") >= cap), "k", "left_semi").select("__o", F.lit(True).alias("full")).distinct()
        marked = kept(rest.join(full, "__o", "left"), "waiting")
        settled.append(marked.filter("full").select("__o", F.lit("capped").alias("status")))
        waiting = marked.filter("full is null").drop("full")
    found = settled[0]
    for s in settled[1:]:
        found = found.unionByName(s)
    if n is not None:
        # The nth chosen row's place: rows behind it are over, whatever their keys.
        first = found.filter("status = 'chosen'").withColumn("part", F.pmod(F.xxhash64("__o"), F.lit(64)))
        first = first.withColumn("r", F.row_number().over(Window.partitionBy("part").orderBy("__o"))).filter(F.col("r") <= n).orderBy("__o").limit(n)
        end = first.agg(F.count("*").alias("c"), F.max("__o").alias("end")).first()
        if end["c"] == n:
            found = found.withColumn("status", F.when(F.col("__o") > F.lit(end["end"]), "over").otherwise(F.col("status")))
    return rows.join(found.withColumnRenamed("__o", order), order)


def smallest(df: DataFrame, group: list[str], key: str, tie: str, n: int, salts: int = 64) -> DataFrame:
    """The n rows of each group with the least key. A hot group is first cut down within `salts` parts of it, so no task holds it whole."""
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(key, tie), F.lit(salts)))
    return capped(capped(salted, [*group, "__salt"], [key, tie], n), group, [key, tie], n).drop("__salt")


def index_runs(df: DataFrame, group: list[str], index: str) -> DataFrame:
    """Runs of consecutive indices per group: group, first index, number of rows."""
    run = F.col(index) - F.row_number().over(Window.partitionBy(*group).orderBy(index))
    return df.select(*group, index, run.alias("__run")).groupBy(*group, "__run").agg(F.min(index).alias("first"), F.count("*").alias("n")).drop("__run")


def ranked_kinds(df: DataFrame, kind: str, order: list[str], size: str) -> DataFrame:
    """Place of each row by the rank of its kind, then by size. For tables of findings, not of rows."""
    at = F.array_position(F.array(*map(F.lit, order)), F.col(kind))
    rank = F.when(at > 0, at).otherwise(len(order) + 1)
    return df.withColumn("place", F.row_number().over(Window.orderBy(rank, F.desc(size), kind)))
