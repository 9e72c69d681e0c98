"""Secret scans with a trigram inverted index, by DataFrame functions alone.

From every rule's regular expression a Boolean trigram query is derived: an alternative of literals gives an OR of
ANDs of their trigrams (lower-cased); a rule without mandatory literals has no query and scans every text. Texts are
indexed on the trigrams that occur in some query. Texts are named by a 64-bit hash and dealt by it into chunks of about
CHUNK_TEXTS; a posting list holds the sorted keys of one trigram in one chunk, so that a trigram that is in every text
makes no long list. The lists of each alternative are intersected and those of a rule united; texts are joined with the
rules that they are candidates of, and only there those rules' expressions run. Matches and code-point spans come from
splitting the text at the expression. Two texts with one hash can only be candidates of too much, never of too little.

Rows whose text is repeated very often are dealt over all partitions for that join, which Spark makes a broadcast where the
candidates are few. Spans are built in blocks of BLOCK_SPANS matches, so that a text's cost grows with its length.

Defined cases: null texts are empty and have no spans. Every input row gives one row. Empty tables give no rows.
A private key reaches from its first to its last line, or to the end of the text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import hot_keys, spread_join, written

CHUNK_TEXTS = 16_384
BLOCK_SPANS = 256

@dataclass(frozen=True)
class Rule:
    """kind; expression; group and least length of it that a match needs, or it is dropped; base rules are fixed."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


#: The base rules in their order, then this library's own. A least length that no shorter reading of the same
#: place could change is part of the expression.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12, True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?!-----END)[\s\S])*+(?:-----END [A-Z ]*PRIVATE KEY-----)?"),
    Rule("gitlab", r"glpat-[A-Za-z0-9_-]{20,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{24,}"),
    Rule("npm", r"npm_[A-Za-z0-9]{36}"),
    Rule("mail", r"SG\.[A-Za-z0-9_-]{22}\.[A-Za-z0-9_-]{43}"),
)


def literal_runs(pattern: str) -> list[list[str]]:
    """Alternatives of an expression, each as the literal runs that any match of it must hold.

    Handles what rules use: groups, alternatives, classes, quantifiers, escapes; whatever may be absent ends a run."""
    try:
        from re import _parser as parser  # Python's own reader of expressions
    except ImportError:  # pragma: no cover
        import sre_parse as parser

    def walk(tree) -> list[list[str]]:
        outs = [[""]]
        for op, arg in tree:
            name = str(op)
            if name == "LITERAL":
                parts = [[chr(arg)]]
                glue = True
            elif name == "SUBPATTERN":
                parts, glue = walk(arg[-1]), True
            elif name == "BRANCH":
                parts, glue = [a for sub in arg[1] for a in walk(sub)], True
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 5:
                parts, glue = [[chr(c)] for _, c in arg], True
            elif name == "MAX_REPEAT" and arg[0] == 0 and arg[1] == 1:
                parts, glue = [[""], *walk(arg[2])], True
            else:
                parts, glue = [["", ""]], False
            if len(outs) * len(parts) > 64:
                parts, glue = [["", ""]], False
            merged = []
            for left, right in product(outs, parts):
                merged.append([*left[:-1], left[-1] + right[0], *right[1:]] if glue else [*left, ""])
            outs = merged
        return outs

    return [[r for r in alt if r] for alt in walk(parser.parse(pattern))]


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """OR of ANDs of lower-cased trigrams that every match holds; None: no query, scan fully."""
    ors = [frozenset(run.lower()[i : i + 3] for run in alt for i in range(len(run) - 2)) for alt in literal_runs(pattern)]
    if not all(ors):
        return None
    return sorted((a for a in set(ors) if not any(b < a for b in ors)), key=sorted)


def _vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    return sorted({t for r in rules for alt in trigram_query(r.pattern) or [] for t in alt})


def _present(low: str, rules: tuple[Rule, ...]) -> Column:
    """The trigrams of the rules' queries that a lower-cased text column holds."""
    return F.array_remove(F.array(*[F.when(F.contains(F.col(low), F.lit(t)), F.lit(t)).otherwise("") for t in _vocabulary(rules)]), "")


def text_grams(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """(key, grams) for every row: its text's hash and the trigrams of the rules' queries that the text holds."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # The lower-cased text is a column of its own, so that it is made once and not for every trigram.
    return docs.select(F.xxhash64(text).alias("key"), F.lower(text).alias("low")).select("key", _present("low", rules).alias("grams"))


def postings(grams: DataFrame, chunk_texts: int = CHUNK_TEXTS) -> DataFrame:
    """The inverted index of (key, grams) rows: trigram, chunk, and the sorted keys of the chunk's texts that hold it."""
    held = grams.filter("size(grams) > 0")
    chunks = max(1, -(-held.count() // chunk_texts))
    entries = held.select("key", F.explode("grams").alias("trigram")).distinct()
    return entries.groupBy(F.pmod("key", F.lit(chunks)).alias("chunk"), "trigram").agg(F.sort_array(F.collect_list("key")).alias("keys"))


def candidates(index: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(key, rules): the texts that hold all trigrams of an alternative of some rule, and those rules as bits."""
    lists = index.groupBy("chunk").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("lists"))
    none = F.array().cast("array<bigint>")
    found = []
    for i, rule in enumerate(rules):
        met = []
        for alternative in trigram_query(rule.pattern) or []:
            held = [F.coalesce(F.element_at("lists", F.lit(t)), none) for t in sorted(alternative)]
            met.append(reduce(F.array_intersect, held))
        found.append(F.struct(F.lit(1 << i).alias("rule"), reduce(F.array_union, met, none).alias("keys")))
    rows = lists.select(F.explode(F.array(*found)).alias("c")).select("c.rule", F.explode("c.keys").alias("key"))
    return rows.groupBy("key").agg(F.bit_or("rule").alias("rules"))


def _spans(rule: Rule, rank: int, text: str) -> str:
    """SQL: array of (start, rank, kind, stop) of a rule's kept matches, in code points."""
    quoted = "'" + rule.pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"
    found = f"regexp_extract_all({text}, {quoted}, 0)"
    kept = f"regexp_extract_all({text}, {quoted}, {rule.group})" if rule.group else found
    gaps = f"split({text}, {quoted}, -1)"
    struct = lambda start, stop: f"named_struct('start', {start}, 'rank', {rank}, 'kind', '{rule.kind}', 'stop', {stop})"
    begin = "a.at + char_length(x.`0`)"
    end = f"{begin} + char_length(x.f)"
    # Running place within a block: each gap, then each match; a match is kept if its group is long enough.
    step = f"named_struct('at', {end}, 'out', if(char_length(x.`2`) >= {rule.least}, concat(a.out, array({struct(begin, end)})), a.out))"
    none = "cast(array() as array<struct<start:int,rank:int,kind:string,stop:int>>)"
    zipped = f"arrays_zip(slice({gaps}, 1, size(f)), f, {kept})"
    blocks = f"transform(sequence(0, cast((size(z) - 1) div {BLOCK_SPANS} as int)), b -> aggregate(slice(z, b * {BLOCK_SPANS} + 1, {BLOCK_SPANS}), named_struct('at', 0, 'out', {none}), (a, x) -> {step}))"
    # Each block's own place is the sum of the blocks before it.
    places = "slice(aggregate(p, array(0), (a, x) -> concat(a, array(element_at(a, -1) + x.at))), 1, size(p))"
    moved = f"flatten(zip_with(p, {places}, (x, at) -> transform(x.out, s -> {struct('s.start + at', 's.stop + at')})))"
    return f"transform(array({found}), f -> if(size(f) = 0, {none}, transform(array({zipped}), z -> transform(array({blocks}), p -> {moved})[0])[0]))[0]"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", out_col: str = "secrets", chunk_texts: int = CHUNK_TEXTS) -> DataFrame:
    """`docs` with an array of all spans (start, rank, kind, stop), ordered by start, then rule."""
    text, key = "__tm_text", "__tm_key"
    grams = written(text_grams(docs, rules, text_col), "grams")
    likely = written(candidates(postings(grams, chunk_texts), rules), "candidates").select(F.col("key").alias(key), F.col("rules").alias("__tm_rules"))
    hot = hot_keys(grams.groupBy("key").count(), "key", "count")
    rows = docs.withColumn(text, F.coalesce(F.col(text_col).cast("string"), F.lit(""))).withColumn(key, F.xxhash64(text))
    rows = spread_join(rows, likely, key, hot)
    none = F.expr("cast(array() as array<struct<start:int,rank:int,kind:string,stop:int>>)")
    found = []
    for i, r in enumerate(rules):
        if trigram_query(r.pattern) is None:
            runs = F.col(text).rlike(r.pattern)
        else:
            runs = F.coalesce(F.col("__tm_rules"), F.lit(0)).bitwiseAND(1 << i) != 0
        found.append(F.when(runs, F.expr(_spans(r, i, text))).otherwise(none))
    return rows.withColumn(out_col, F.array_sort(F.concat(*found))).select(*docs.columns, out_col)


def listed(spans: Column) -> Column:
    """kind:start:end joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")


def digest_columns(scanned: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id") -> DataFrame:
    """doc_id, counts per base kind, a digest of the base spans, and all spans."""
    base = [i for i, r in enumerate(rules) if r.base]
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    counts = [count(r.kind) for r in rules if r.base]
    only = F.filter("secrets", lambda s: s["rank"].isin(base))
    return scanned.select(F.col(id_col).alias("doc_id"), *counts, F.sha2(listed(only), 256).alias("base_sha256"), listed(F.col("secrets")).alias("spans"))


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text", mark: str = "[SECRET]", length_col: str | None = "n_chars") -> DataFrame:
    """`docs` with every secret replaced by a mark (spans that overlap count as one) and, if it is there, its length column renewed."""
    rows = scan(docs, rules, text_col, "__tm_spans")
    fold = f"""aggregate(__tm_spans, named_struct('at', 1, 'out', ''), (a, s) -> if(s.stop < a.at, a, named_struct(
      'at', s.stop + 1, 'out', if(s.start + 1 < a.at, a.out, concat(a.out, substring({text_col}, a.at, s.start + 1 - a.at), '{mark}')))),
      a -> concat(a.out, substring({text_col}, a.at)))"""
    rows = rows.withColumn(text_col, F.when(F.size("__tm_spans") > 0, F.expr(fold)).otherwise(F.col(text_col)))
    if length_col and length_col in docs.columns:
        rows = rows.withColumn(length_col, F.when(F.size("__tm_spans") > 0, F.char_length(text_col).cast(docs.schema[length_col].dataType)).otherwise(F.col(length_col)))
    return rows.select(*docs.columns)
