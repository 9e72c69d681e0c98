"""URL filters: host and path rules, else the ratio of two character language models. DataFrame functions alone.

Rules: a rule fits its host and all subdomains where the path starts with the rule's; the longest rule wins (of two of
equal length, the one with the longer host). URLs that no rule decides are judged by variable-order Markov models: one
of accepted and one of rejected URLs, each of character grams of 1 to ORDER characters with interpolated smoothing
(a gram's estimate leans on its suffix's with weight LAMBDA; unseen grams back off). The models count the grams of all
distinct labelled URLs but every fifth by hash; by default the classes are what the rules allow and block. Grams seen
once are dropped. The models are tables that grow with the input and are joined, not broadcast.

Because kept grams are closed under suffixes, the log ratio of a URL is a sum of one weight per gram: for a kept gram
the difference of its log ratio to its suffix's, for an unseen one the log ratio of its context's back-off weights.
These sums are made once for each distinct gram, from the shortest up, and joined to the URLs by the longest alone.
The sum divided by the URL's length is compared with a cut that is calibrated on the labelled URLs that were held back
(the point as many standard deviations from either class's mean).

Long URLs are cut into overlapping pieces before their characters become rows, and rows carry the URL's number, not its text: the
work grows in proportion to a URL's length.

Defined cases: null urls and urls without `://` have empty host and path and no characters: their score is 0. URLs with `://` and an
empty host are scored like all others. Without URLs of both classes every score and the cut are 0 (allow). Every row gives
a row; equal URLs are scored once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import order_hash, written

ORDER = 5
LAMBDA = 2.0
PIECE = 256
_PAD, _END = "\x02" * (ORDER - 1), "\x03"


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str
    verdict: str


RULES = (
    UrlRule("com", "/", "allow"),
    UrlRule("example.com", "/en/", "block"),
    UrlRule("www.example.com", "/en/", "allow"),
    UrlRule("net", "/es/", "block"),
    UrlRule("net", "/fr/", "block"),
)


def _lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return _lower(raw), path


def decide(host: Column, path: Column, rules: tuple[UrlRule, ...] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits; null if none does."""
    hits = [
        F.when(((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path)), F.struct(F.lit(len(r.host + r.path)).alias("n"), F.lit(len(r.host)).alias("h"), F.lit(r.host + r.path).alias("rule"), F.lit(r.verdict).alias("verdict")))
        for r in rules
    ]
    return F.greatest(*hits) if len(hits) > 1 else hits[0]


def _longest(urls: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each character of a URL (and its end mark): the ORDER characters that end there as t, and the kept columns."""
    text = F.concat(_lower(F.expr("substring(url, if(instr(url, '://') > 0, instr(url, '://') + 3, 1))")), F.lit(_END))
    # Every piece begins with the last characters of the one before it.
    pieces = urls.select(*keep, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0)).alias("p"))
    led = F.transform("p", lambda x, i: F.concat(F.when(i == 0, F.lit(_PAD)).otherwise(F.right(F.get("p", i - 1), F.lit(ORDER - 1))), x))
    rows = pieces.select(*keep, F.explode(led).alias("t")).select(*keep, "t", F.explode(F.sequence(F.lit(ORDER), F.length("t"))).alias("i"))
    return rows.select(*keep, F.expr(f"substring(t, i - {ORDER - 1}, {ORDER})").alias("t"))


def _grams(rows: DataFrame, keep: list[str]) -> DataFrame:
    """One row for each suffix of t: g, k, and the kept columns."""
    rows = rows.select(*keep, "t", F.explode(F.array(*map(F.lit, range(1, ORDER + 1)))).alias("k"))
    return rows.select(*keep, "k", F.expr(f"substring(t, {ORDER + 1} - k, k)").alias("g"))


def train(urls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Weights (g, w) of kept grams and (c, bow) of contexts, from rows (url, accepted 0/1)."""
    counts = _grams(_longest(urls, ["accepted"]), ["accepted"]).groupBy("g", "k").agg(F.sum("accepted").alias("a"), F.sum(1 - F.col("accepted")).alias("b"))
    # A suffix is seen as often as the grams that end in it at least, so what is kept is closed under suffixes.
    kept = written(counts.filter("k = 1 or a + b > 1"), "grams")
    contexts = kept.groupBy(F.expr("substring(g, 1, k - 1)").alias("c")).agg(F.sum("a").alias("na"), F.sum("b").alias("nb"))
    smoothed = None
    for k in range(1, ORDER + 1):
        level = kept.filter(F.col("k") == k).withColumn("c", F.expr("substring(g, 1, k - 1)")).join(contexts, "c")
        if smoothed is None:
            level = level.withColumn("qa", F.lit(1 / 128)).withColumn("qb", F.lit(1 / 128))
        else:
            level = level.withColumn("s", F.expr("substring(g, 2)")).join(smoothed.select(F.col("g").alias("s"), F.col("pa").alias("qa"), F.col("pb").alias("qb")), "s")
        level = level.select("g", *[((F.col(x) + LAMBDA * F.col(f"q{x}")) / (F.col(f"n{x}") + LAMBDA)).alias(f"p{x}") for x in "ab"], "qa", "qb")
        smoothed = written(level, "level")
        weights = smoothed if k == 1 else weights.unionByName(smoothed)
    ratio = lambda a, b: F.log(F.col(a)) - F.log(F.col(b))
    bow = F.log(F.col("nb") + LAMBDA) - F.log(F.col("na") + LAMBDA)
    return written(weights.select("g", (ratio("pa", "pb") - ratio("qa", "qb")).alias("w")), "weights"), written(contexts.select("c", bow.alias("bow")), "contexts")


def score(urls: DataFrame, weights: DataFrame, contexts: DataFrame) -> DataFrame:
    """(url, score): the length-normalised log-likelihood difference, accepted minus rejected, of distinct URLs."""
    urls = written(urls.select("url").distinct().withColumn("no", F.monotonically_increasing_id()), "urls")
    rows = _longest(urls, ["no"])
    grams = _grams(rows.select("t").distinct(), []).distinct().withColumn("c", F.expr("substring(g, 1, k - 1)"))
    own = written(grams.join(weights, "g", "left").join(contexts, "c", "left").select("k", "g", F.coalesce("w", "bow", F.lit(0.0)).alias("v")), "own")
    # A gram's sum is its own weight and its suffix's sum; no more grams share a suffix than there are characters.
    sums = own.filter("k = 1").select("g", "v")
    for k in range(2, ORDER + 1):
        level = own.filter(F.col("k") == k).withColumn("s", F.expr("substring(g, 2)"))
        sums = level.join(sums.select(F.col("g").alias("s"), F.col("v").alias("below")), "s").select("g", (F.col("v") + F.col("below")).alias("v"))
    return rows.join(written(sums.withColumnRenamed("g", "t"), "sums"), "t").groupBy("no").agg(F.avg("v").alias("score")).join(urls, "no").select("url", "score")


def _labelled(decided: DataFrame, held_back: bool) -> DataFrame:
    """The distinct URLs (url, accepted 0/1) of the part that trains, or of the fifth that is held back."""
    rows = decided.filter("verdict is not null and url is not null").select("url", (F.col("verdict") == "allow").cast("int").alias("accepted"))
    return rows.filter((F.pmod(order_hash("url", seed="part"), F.lit(5)) == 0) == F.lit(held_back)).distinct()


def judge(pages: DataFrame, rules: tuple[UrlRule, ...] = RULES, labelled: DataFrame | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, score (where no rule fits), verdict for every row.

    `labelled` may give (url, verdict) rows to learn from in place of what the rules decide."""
    host, path = split_url(F.col(url_col))
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("hit", decide(F.col("host"), F.col("path"), rules)).select("page_id", "url", "host", "path", "hit.rule", "hit.verdict")
    source = rows.select("url", "verdict") if labelled is None else labelled.select("url", "verdict")
    learn, tune = (written(_labelled(source, held_back), name) for name, held_back in (("learn", False), ("tune", True)))
    n = learn.agg(F.coalesce(F.min("accepted"), F.lit(1)).alias("lo"), F.coalesce(F.max("accepted"), F.lit(0)).alias("hi")).first()
    if n["lo"] == n["hi"] or n["lo"] > n["hi"]:
        return rows.select("page_id", "host", "path", "rule", F.when(F.col("rule").isNull(), F.lit(0.0)).alias("score"), F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    weights, contexts = train(learn)
    stats = score(tune, weights, contexts).join(tune, "url").groupBy("accepted").agg(F.avg("score").alias("m"), F.coalesce(F.stddev_pop("score"), F.lit(0.0)).alias("s"))
    known = {r["accepted"]: (r["m"], r["s"] + 1e-9) for r in stats.collect()}  # two rows
    cut = 0.0 if len(known) < 2 else (known[1][0] * known[0][1] + known[0][0] * known[1][1]) / (known[0][1] + known[1][1])
    open_urls = rows.filter("rule is null and instr(url, '://') > 0").select("url")
    scored = score(open_urls, weights, contexts)
    out = rows.join(scored, "url", "left")
    value = F.when(F.col("rule").isNull(), F.coalesce("score", F.lit(0.0)))
    return out.select("page_id", "host", "path", "rule", value.alias("score"), F.coalesce("verdict", F.when(value >= cut, "allow").otherwise("block")).alias("verdict"))
