"""Decisions on labelled texts: keep rules, consensus of readers, judges, presets, pools and their draws."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.operators.picks import hash_place
from tidemill.operators.retrieval import character_pairs, ranked_terms
from tidemill.session import kept


def error_share(a: Column, b: Column, by: Column | None = None) -> Column:
    """Edit distance of two texts over the length of the first (or a given length), of 1 at least."""
    return F.levenshtein(a, b) / F.greatest(by if by is not None else F.length(a), F.lit(1))


def keep_rule(label: Column, seconds: Column, errors: Column, length: Column, short: float = 2.0, percent: int = 30) -> tuple[Column, Column]:
    """(keep, reason): empty labels go, short ones stay unjudged, the others stay below a share of errors."""
    reason = F.when(F.coalesce(label, F.lit("")) == "", "label empty").when(seconds < short, "short, not judged").when(100 * errors < percent * length, "few errors").otherwise("many errors")
    return reason.isin("short, not judged", "few errors"), reason


def consensus(gold: Column, first: Column, second: Column, close: float = 0.2, far: float = 0.6, disagree: float = 0.6) -> tuple[Column, Column]:
    """(label, reason) by two readers of a text: text, empty or null. All three are normalised texts, '' where nothing was read."""
    apart = F.levenshtein(first, second) / F.greatest(F.length(first), F.length(second), F.lit(1))
    one, two = error_share(gold, first), error_share(gold, second)
    none = (first == "") | (second == "")
    reason = (
        F.when((first == "") & (second == ""), "both empty")
        .when((one <= close) & (two <= close), "both read it")
        .when((one >= far) & (two >= far), F.when(none, "one empty, other far").when(apart >= disagree, "both far and apart").otherwise("both far but agree"))
        .otherwise("partly read")
    )
    label = F.when(reason == "both read it", "text").when(reason.isin("both empty", "one empty, other far", "both far and apart"), "empty")
    return label, reason


def left_over(text: Column, presets: list[str]) -> Column:
    """What is left of a text when presets are taken out of it, the longest first; '' where it is made of presets alone."""
    return F.trim(reduce(lambda t, p: F.replace(t, F.lit(p), F.lit("")), sorted(presets, key=lambda p: (-len(p), p)), text))


def judged(rows: DataFrame, key: list[str], original: str, judge: str, answer: str, seq: str, least: int = 2) -> DataFrame:
    """One decision per key from the last answer of each judge: fewer than `least` judges, open; all keep the original,
    unchanged; all give the same other text, corrected; else quarantined, with the number of different answers."""
    last = rows.groupBy(*key, judge).agg(F.max_by(answer, seq).alias("a"), F.max_by(original, seq).alias("o"))
    cells = last.groupBy(*key).agg(F.count("*").alias("n_judges"), F.count_distinct("a").alias("n_answers"), F.min("a").alias("answer"), F.min("o").alias("original"))
    verdict = F.when(F.col("n_judges") < least, "open").when((F.col("n_answers") == 1) & (F.col("answer") == F.col("original")), "unchanged").when(F.col("n_answers") == 1, "corrected").otherwise("quarantined")
    return cells.select(*key, verdict.alias("verdict"), F.when(verdict == "corrected", F.col("answer")).alias("text"), "n_judges", "n_answers")


def pools(rows: DataFrame, conditions: dict[str, Column], name: str = "pool") -> DataFrame:
    """Every row once for each pool whose condition it meets: one pass, however many pools there are."""
    met = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), F.lit(n)) for n, c in conditions.items()]), lambda x: x.isNotNull())
    return rows.withColumn(name, F.explode(met))


def drawn(rows: DataFrame, pool: str, order: list[Column], text: str, cap: int, n: int) -> DataFrame:
    """The first n rows of each pool in order, after at most `cap` rows of one text have been let in, counted over all pools.

    The cap is a rank within a text; a hot pool is first cut down in parts, so that no task sorts it whole."""
    let_in = rows.withColumn("__key", F.struct(*order)).withColumn("__place", F.row_number().over(Window.partitionBy(text).orderBy("__key"))).filter(F.col("__place") <= cap)
    salted = let_in.withColumn("__part", F.pmod(F.xxhash64("__key"), F.lit(64)))
    short = salted.withColumn("__r", F.row_number().over(Window.partitionBy(pool, "__part").orderBy("__key"))).filter(F.col("__r") <= n)
    return short.withColumn("place", F.row_number().over(Window.partitionBy(pool).orderBy("__key"))).filter(F.col("place") <= n).drop("__key", "__place", "__part", "__r")


def nearest_choice(choices: DataFrame, targets: dict[str, float]) -> DataFrame:
    """The one row of a table of choices whose columns lie nearest to their targets, by the sum of relative distances; ties by all columns."""
    gap = reduce(lambda a, b: a + b, [F.abs(F.col(c) - t) / t for c, t in targets.items()])
    return choices.select("*", F.round(gap, 9).alias("gap")).agg(F.min_by(F.struct(*choices.columns, "gap"), F.struct("gap", *choices.columns)).alias("r")).select("r.*")


def covered_needs(needs: DataFrame, facts: DataFrame, need: str, item: str) -> DataFrame:
    """need, n_items, n_missing, covered: whether a sample holds every item that a need lists."""
    held = facts.select(item).distinct().withColumn("__held", F.lit(1))
    rows = needs.join(held, item, "left")
    return rows.groupBy(need).agg(F.count("*").alias("n_items"), F.count_if(F.col("__held").isNull()).alias("n_missing")).withColumn("covered", F.col("n_missing") == 0)


def retrieval_score(word: Column, query: Column) -> Column:
    """2 for a word that stands in the query, half of the share of its characters that the query has, and 0.3 of the Jaccard
    similarity of character bigrams. Both normalised, without blanks."""
    chars = F.filter(F.split(word, ""), lambda c: c != "")
    shared = F.size(F.filter(chars, lambda c: F.contains(query, c))) / F.greatest(F.size(chars), F.lit(1))
    union = F.size(F.array_union(character_pairs(word), character_pairs(query)))
    jaccard = F.when(union > 0, F.size(F.array_intersect(character_pairs(word), character_pairs(query))) / union).otherwise(0.0)
    return F.when((word != "") & F.contains(query, word), 2.0).otherwise(0.0) + 0.5 * shared + 0.3 * jaccard


def best_terms(queries: DataFrame, terms: DataFrame, pool: str, n: int) -> DataFrame:
    """query_id, rank, term, score: the n best terms of a query's own pool by retrieval_score, ties by sha256 of the term.

    queries (query_id, pool, query) meet the terms (pool, term) that share a character or bigram with them, through an index."""
    asked = queries.select("query_id", F.col(pool).alias("pool"), F.col("query").alias("form"))
    return ranked_terms(asked, terms.select(F.col(pool).alias("pool"), "term", F.col("term").alias("form")), n, units=False)


def next_prime(n: int) -> int:
    """The least prime from n on."""
    n = max(n, 2)
    while any(n % d == 0 for d in range(2, math.isqrt(n) + 1)):
        n += 1
    return n


def word_lists(rows: DataFrame, gold: str, pool: DataFrame, text: str, size: int, seed: int, near: DataFrame | None = None) -> DataFrame:
    """id, words: a list of `size` words for each row: its gold words, then words near to them (word, near), both in the order of
    sha256(seed:id:word), then words of the pool. A distractor never stands in the row's text.

    Words of the pool are numbered by hash and probed: row and seed give a start and a step, both below the next prime, so that the
    probes of a row reach every number once. Rows are joined with what they probe alone; those whose list isn't full
    go on with twice as many probes, until all numbers were seen."""
    words = kept(hash_place(pool.filter("word is not null").select("word").distinct(), [], F.sha2("word", 256), "no").select("word", F.col("no").cast("long").alias("no")), "vocabulary")
    prime = next_prime(words.count())
    gold_rows = rows.select("id", text, F.explode(gold).alias("word"))
    parts = [gold_rows.select("id", text, "word", F.lit(0).alias("kind"))]
    if near is not None:
        parts.append(gold_rows.join(near, "word").select("id", text, F.col("near").alias("word"), F.lit(1).alias("kind")))
    own = reduce(DataFrame.unionByName, parts).filter((F.col("kind") == 0) | ~F.contains(text, "word"))
    found = kept(own.groupBy("id", "word").agg(F.min("kind").alias("kind")).withColumn("k", F.lit(0).cast("long")), "words")
    draw = F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string")), 256)
    number = lambda at: F.conv(F.substring(draw, at, 8), 16, 10).cast("long")
    seekers = rows.select("id", text, (number(1) % prime).alias("begin"), (number(9) % (prime - 1) + 1 if prime > 2 else F.lit(1)).alias("step"))
    first, last = 0, 2 * size
    while first < prime:
        full = found.groupBy("id").count().filter(F.col("count") >= size)
        probes = seekers.join(full, "id", "left_anti").withColumn("k", F.explode(F.sequence(F.lit(first).cast("long"), F.lit(min(last, prime) - 1).cast("long"))))
        hits = probes.withColumn("no", (F.col("begin") + F.col("k") * F.col("step")) % prime + 1).join(words, "no").filter(~F.contains(text, "word"))
        new = kept(hits.select("id", "word", F.lit(2).alias("kind"), "k").join(found.select("id", "word"), ["id", "word"], "left_anti"), "words")
        if new.isEmpty() and seekers.join(full, "id", "left_anti").isEmpty():
            break
        found, first, last = found.unionByName(new), last, 3 * last
    key = F.when(F.col("kind") < 2, F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col("id").cast("string"), "word"), 256)).otherwise("")
    place = F.row_number().over(Window.partitionBy("id").orderBy("kind", "k", key, "word"))
    picked = found.withColumn("place", place).filter(F.col("place") <= size)
    return picked.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("place", "word"))).alias("w")).select("id", F.col("w.word").alias("words"))
