"""Joins with the checks that a data contract asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def located(facts: DataFrame, places: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Facts with their place, and the facts whose place is missing (to be empty, or an error of the caller)."""
    return facts.join(places, key), facts.join(places, key, "left_anti")


def merged(parent: DataFrame, patches: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Parent rows with the patches' values where a patch has the key; deleted rows stay, but not retained."""
    new = patches.select(key, "status", *[F.col(c).alias(f"__new_{c}") for c in columns])
    out = parent.join(new, key, "left")
    for c in columns:
        out = out.withColumn(c, F.coalesce(f"__new_{c}", c))
    return out.withColumn("retained", F.coalesce(F.col("status") != "delete", F.lit(True))).drop("status", *[f"__new_{c}" for c in columns])


def leftovers(patches: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Patches whose row isn't visible in the parent."""
    return patches.join(parent.select(key), key, "left_anti")


def differences(left: DataFrame, right: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows by which two tables differ: key and added, removed or changed."""
    digest = lambda df, name: df.select(key, F.xxhash64(*columns).alias(name), F.sha2(F.to_json(F.struct(*columns)), 256).alias(f"{name}2"))
    both = digest(left, "l").join(digest(right, "r"), key, "full_outer")
    kind = F.when(F.col("l2").isNull(), "added").when(F.col("r2").isNull(), "removed").when(F.col("l2") != F.col("r2"), "changed")
    return both.select(key, kind.alias("kind")).filter("kind is not null")


def cascade(rows: DataFrame, steps: list[tuple[str, str, DataFrame]]) -> DataFrame:
    """Rows with the first step that excludes them: each step is (reason, key column, table of excluded keys).

    Keys are made distinct before they are joined; Spark broadcasts a step only if its size is below the threshold."""
    for i, (_, key, table) in enumerate(steps):
        held = table.select(F.col(key).alias(key)).distinct().withColumn(f"__hit{i}", F.lit(True))
        rows = rows.join(held, key, "left")
    reason = F
    for i, (name, _, _) in enumerate(steps):
        reason = reason.when(F.col(f"__hit{i}").isNotNull(), name)
    return rows.withColumn("reason", reason).drop(*[f"__hit{i}" for i in range(len(steps))])


def key_overlap(rows: DataFrame, held: DataFrame, id_col: str, keys: Column, key_col: str) -> DataFrame:
    """Records whose keys meet held-out keys: id and number of distinct keys hit."""
    return rows.select(id_col, F.explode(keys).alias(key_col)).join(held.select(key_col).distinct(), key_col).groupBy(id_col).agg(F.count_distinct(key_col).alias("n_keys"))


def near_words(words: DataFrame, limit: int, top: int) -> DataFrame:
    """For each distinct word its `top` nearest other words within an edit distance.

    A word is cut into limit + 1 pieces: any word within the distance holds one of them, shifted by at most the limit. So
    candidates are an equi-join on (length, piece, text); only words shorter than their number of pieces meet all of a length."""
    distinct = words.select("word").distinct()
    edge = lambda length, i: f"int(({length}) * ({i}) div {limit + 1})"
    pieces = f"transform(sequence(0, {limit}), i -> named_struct('len', length(word), 'i', i, 'text', substring(word, {edge('length(word)', 'i')} + 1, {edge('length(word)', 'i + 1')} - {edge('length(word)', 'i')})))"
    index = distinct.select("word", F.explode(F.expr(pieces)).alias("p")).select("word", "p.*")
    at, size = edge("l", "i"), f"({edge('l', 'i + 1')} - {edge('l', 'i')})"
    probes = f"""flatten(flatten(transform(sequence(greatest(0, length(word) - {limit}), length(word) + {limit}), l -> transform(sequence(0, {limit}), i -> filter(transform(sequence(-{limit}, {limit}),
      s -> if({at} + s >= 0 and {at} + s + {size} <= length(word), named_struct('len', l, 'i', i, 'text', substring(word, {at} + s + 1, {size})), null)), x -> x is not null)))))"""
    queries = distinct.select(F.col("word").alias("query"), F.explode(F.array_distinct(F.expr(probes))).alias("p")).select("query", "p.*")
    pairs = queries.join(index, ["len", "i", "text"]).filter("query <> word").select("query", "word").distinct()
    near = pairs.withColumn("distance", F.levenshtein("query", "word", limit)).filter("distance >= 0")
    rank = F.row_number().over(Window.partitionBy("query").orderBy("distance", "word"))
    return near.select("query", "word", "distance", rank.alias("rank")).filter(F.col("rank") <= top)


def misaligned(left: DataFrame, right: DataFrame, key: str, column: str) -> DataFrame:
    """Keys at which two tables don't fit one to one: key and missing, stray, repeated or different (the first that holds)."""
    side = lambda df, n, v: df.groupBy(key).agg(F.count("*").alias(n), F.min(F.struct(column)).alias(v))
    both = side(left, "n_left", "left").join(side(right, "n_right", "right"), key, "full")
    problem = F.when(F.col("n_right").isNull(), "missing").when(F.col("n_left").isNull(), "stray").when((F.col("n_left") > 1) | (F.col("n_right") > 1), "repeated").when(~F.col("left").eqNullSafe(F.col("right")), "different")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def covering(terms: DataFrame, texts: DataFrame, id_col: str, words) -> DataFrame:
    """Terms (one word each) with the number of texts that hold them, and the first: an equi-join on words, 0 where none does."""
    held = texts.select(id_col, F.explode(F.array_distinct(words)).alias("term")).groupBy("term").agg(F.count("*").alias("n"), F.min(id_col).alias("first"))
    return terms.select("term").distinct().join(held, "term", "left").select("term", F.coalesce("n", F.lit(0)).alias("n"), "first")


def shared_openings(rows: DataFrame, id_cols: list[str], opening, who: str) -> DataFrame:
    """Rows with the number of others that open alike but come from someone else: two counts, no pairs."""
    keyed = rows.select(*id_cols, F.col(who).alias("who"), opening.alias("opening")).filter("opening is not null")
    own = keyed.groupBy("opening", "who").agg(F.count("*").alias("own"))
    total = own.groupBy("opening").agg(F.sum("own").alias("total"))
    counts = own.join(total, "opening").filter("total > own").select("opening", "who", (F.col("total") - F.col("own")).alias("n_others"))
    return keyed.join(counts, ["opening", "who"]).select(*id_cols, "n_others")


def attached(parents: DataFrame, labels: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Labelled parents, and one row of counts: labels, keys given twice, keys without a parent, fields that parents have already.

    Of a key given twice the row that is least in its columns is attached."""
    one = labels.groupBy(key).agg(F.count("*").alias("__n"), F.min(F.struct(*columns)).alias("__row"))
    found = parents.withColumn("__parent", F.lit(True)).join(one, key, "right").withColumn("__there", F.coalesce("__parent", F.lit(False)))
    clash = len(set(columns) & set(parents.columns))
    problems = found.agg(F.sum("__n").alias("n_labels"), F.count_if(F.col("__n") > 1).alias("n_twice"), F.count_if(~F.col("__there")).alias("n_without_parent")).withColumn("n_clashes", F.lit(clash))
    kept = found.filter("__there").drop(*columns, "__parent", "__there", "__n")
    return kept.select("*", "__row.*").drop("__row"), problems


#: Slots of a filter of keys: 16 for each key, between these bounds (one byte a slot).
LEAST_SLOTS, MOST_SLOTS = 1 << 16, 1 << 22


def key_filter(keys: DataFrame, key: str) -> Callable[[Column], Column]:
    """A function of a hashed key: whether one of some keys (longs) falls into the same slot of a bitmap of bounded size. It
    lets through all keys and few others; where keys pass the bound, more others."""
    slots = min(MOST_SLOTS, max(LEAST_SLOTS, 1 << (16 * keys.count()).bit_length()))
    held = bytearray(slots)
    for r in keys.select(F.pmod(F.col(key), F.lit(slots)).cast("int")).distinct().toLocalIterator():  # at most one int a slot
        held[r[0]] = 1
    table = F.lit(bytes(held))
    return lambda h: F.substring(table, F.pmod(h, F.lit(slots)).cast("int") + 1, F.lit(1)) == F.lit(b"\x01")


def needle_keys(needles: DataFrame, id_col: str, needle: str, gram: int = 3) -> DataFrame:
    """Needles (id, needle) with `__h`: the hash of the words that a text has to hold whole. A needle may begin or end within a
    word: neither its first word nor its last one is in the key, if it has others."""
    words = F.split(needle, " ")
    key = F.when(F.size(words) > 2, F.slice(words, F.lit(2), F.least(F.size(words) - 2, F.lit(gram)))).otherwise(words)
    return needles.select(id_col, needle, F.xxhash64(key).alias("__h"), F.size(key).alias("__n"))


def met_grams(texts: DataFrame, text_id: str, text: str, wanted: DataFrame, gram: int = 3) -> DataFrame:
    """(text_id, __h): the hashed runs of words of each text that pass the filter of the needles' keys, of the lengths they have. Runs are dropped
    where they are made; what is exploded grows with the hits, not with the texts."""
    lengths = sorted(r[0] for r in wanted.select("__n").distinct().collect() if r[0])  # at most `gram` numbers
    if not lengths:
        return texts.select(text_id, F.lit(0).cast("long").alias("__h")).limit(0)
    keep = key_filter(wanted, "__h")
    rows = texts.select(text_id, F.split(text, " ").alias("__t"))
    places = lambda n: F.when(F.size("__t") >= n, F.sequence(F.lit(1), F.size("__t") - (n - 1))).otherwise(F.array().cast("array<int>"))
    grams = F.flatten(F.array(*[F.transform(places(n), lambda i: F.xxhash64(F.slice("__t", i, F.lit(n)))) for n in lengths]))  # noqa: B023
    return rows.select(text_id, F.explode(F.array_distinct(F.filter(grams, keep))).alias("__h"))


def contained(needles: DataFrame, texts: DataFrame, id_col: str, needle: str, text_id: str, text: str, gram: int = 3) -> DataFrame:
    """id and in how many texts a needle stands as it is. Candidates share some of the needle's blank-separated words, by hash;
    only they are compared whole. Needles of one or two words count where they stand as whole words.

    Keys are met without texts first; only texts that hold one are read again. A needle of a common word meets every text that holds
    it: Spark splits such a key's part of the join."""
    words, spaced = F.split(needle, " "), lambda c: F.concat(F.lit(" "), c, F.lit(" "))
    wanted = needle_keys(needles, id_col, needle, gram)
    keys = met_grams(texts, text_id, text, wanted, gram).join(wanted.select(id_col, "__h"), "__h").select(text_id, id_col).distinct()
    held = F.when(F.size(words) > 2, F.contains(text, needle)).otherwise(F.contains(spaced(F.col(text)), spaced(F.col(needle))))
    counts = keys.join(texts.select(text_id, text), text_id).join(needles.select(id_col, needle), id_col).filter(held).groupBy(id_col).agg(F.count("*").alias("n_docs"))
    return needles.select(id_col).join(counts, id_col, "left").select(id_col, F.coalesce("n_docs", F.lit(0)).alias("n_docs"))
