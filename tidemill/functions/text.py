"""Text rules as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F


#: Texts that a Python worker holds as Python strings at a time.
NFKC_ROWS = 64


def nfkc(text: Column) -> Column:
    """Unicode compatibility composition; Spark has no built-in, so an Arrow UDF. ASCII texts stay as they are and don't reach it, the
    others are composed a few at a time: a worker holds one Arrow batch, whose bytes Spark bounds."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for at in range(0, len(batch), NFKC_ROWS):
                yield pa.array([None if t is None else unicodedata.normalize("NFKC", t) for t in batch.slice(at, NFKC_ROWS).to_pylist()], pa.string())

    return F.coalesce(run(F.when(F.rlike(text, F.lit(r"[^\x00-\x7F]")), text)), text)


def plain(text: Column, unicode: bool = True) -> Column:
    """Compatibility form, lower case, punctuation and symbols as blanks, blanks squeezed."""
    text = nfkc(text) if unicode else text
    return F.trim(F.regexp_replace(F.regexp_replace(F.lower(text), r"[\p{P}\p{S}]", " "), r"\s+", " "))


def compact(text: Column) -> Column:
    """ASCII letters and digits only, lower-cased: the key under which texts count as equal.

    The runs that stay are extracted: that takes Spark an eighth of the time that replacing those between them does."""
    return F.lower(F.array_join(F.regexp_extract_all(text, F.lit("[a-zA-Z0-9]+"), F.lit(0)), ""))


def script_compact(text: Column, language: Column) -> Column:
    """The plain form of a text, for Chinese without blanks."""
    out = plain(text)
    return F.when(language == "zh", F.replace(out, F.lit(" "), F.lit(""))).otherwise(out)


def holds_word(text: Column, word: Column, spaced: bool = True) -> Column:
    """Whether a word stands in a text: as a whole word in spaced scripts, anywhere in others."""
    return F.contains(F.concat(F.lit(" "), text, F.lit(" ")), F.concat(F.lit(" "), word, F.lit(" "))) if spaced else F.contains(text, word)


def bigrams(text: Column) -> Column:
    """Distinct character bigrams."""
    return F.when(F.length(text) < 2, F.array().cast("array<string>")).otherwise(F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(text) - 1, F.lit(1))), lambda i: F.substring(text, i, F.lit(2)))))


def jaccard(a: Column, b: Column) -> Column:
    both = F.size(F.array_union(a, b))
    return F.when(both == 0, F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / both)


def loops(hypothesis: Column, reference: Column) -> Column:
    """Whether a text repeats a short piece eight times over, or is far longer than its reference."""
    return F.regexp_like(hypothesis, F.lit(r"(?s)(.{1,10}?)\1{7,}")) | (F.length(hypothesis) > 3 * F.length(reference) + 30)


def number_kinds(text: Column) -> Column:
    """Kinds of the digit runs: 11 digits phone, 17 or 18 id; other lengths none."""
    runs = F.regexp_extract_all(text, F.lit(r"([0-9]+)"), F.lit(1))
    kinds = F.transform(runs, lambda r: F.when(F.length(r) == 11, "phone").when(F.length(r).isin(17, 18), "id"))
    return F.array_sort(F.array_distinct(F.filter(kinds, lambda k: k.isNotNull())))


def ancestors(path: Column) -> Column:
    """All proper ancestors of a slash path and itself, shortest first."""
    parts = F.split(path, "/")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))


def parse_size(text: Column) -> Column:
    """Bytes of a size like 3K, 1.5M, 2G, 1T (binary units)."""
    number = F.regexp_extract(text, r"^\s*([0-9.]+)", 1).cast("double")
    unit = F.upper(F.regexp_extract(text, r"([KMGT])i?B?\s*$", 1))
    return (number * F.when(unit == "K", 2.0**10).when(unit == "M", 2.0**20).when(unit == "G", 2.0**30).when(unit == "T", 2.0**40).otherwise(1.0)).cast("long")


def first_reason(rules: list[tuple[str, Column]]) -> Column:
    """The name of the first rule that holds; null if none does."""
    out = F
    for name, rule in rules:
        out = out.when(F.coalesce(rule, F.lit(False)), name)
    return out


def without_accents(text: Column) -> Column:
    """Latin letters without their accents; the tilde of n stays."""
    return F.translate(text, "áàâäãéèêëíìîïóòôöõúùûüçÁÀÂÄÃÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÇ", "aaaaaeeeeiiiiooooouuuucAAAAAEEEEIIIIOOOOOUUUUC")


def reading_key(word: Column, rules: list[tuple[str, str]]) -> Column:
    """How a word is read: lower case without accents, rewritten by rules in order, repeats collapsed."""
    out = without_accents(F.lower(word))
    for pattern, new in rules:
        out = F.regexp_replace(out, pattern, new)
    return F.regexp_replace(out, r"(.)\1+", "$1")


def variant_key(word: Column) -> Column:
    """Spellings that differ only in case, hyphens, dots, apostrophes or blanks have one key."""
    return F.lower(F.regexp_replace(word, r"[-.'’\s]+", ""))


def foreign_spans(text: Column, longest: int = 3, least: int = 2, fillers: tuple[str, ...] = ()) -> Column:
    """Distinct runs of 1 to `longest` Latin words with `least` letters or more, without fillers at either end, lower-cased."""
    filler = F.array(*map(F.lit, fillers)) if fillers else F.array().cast("array<string>")
    words = F.transform(F.regexp_extract_all(text, F.lit(r"[A-Za-z]+(?: [A-Za-z]+)*"), F.lit(0)), lambda s: F.split(F.lower(s), " "))

    def trimmed(w: Column) -> Column:
        first = F.array_position(F.transform(w, lambda x: ~F.array_contains(filler, x)), True).cast("int")
        back = F.array_position(F.transform(F.reverse(w), lambda x: ~F.array_contains(filler, x)), True).cast("int")
        return F.when(first > 0, F.slice(w, F.greatest(first, F.lit(1)), F.greatest(F.size(w) - first - back + 2, F.lit(0)))).otherwise(F.array().cast("array<string>"))

    spans = F.transform(F.transform(words, trimmed), lambda w: F.when((F.size(w) > 0) & (F.size(w) <= longest), F.array_join(w, " ")).otherwise(""))
    return F.array_distinct(F.filter(spans, lambda s: F.length(F.replace(s, F.lit(" "), F.lit(""))) >= least))


def fields_at(document: Column, name: str) -> Column:
    """All texts that stand under a name, anywhere in a JSON document, in order of the text."""
    found = F.regexp_extract_all(document, F.lit(rf'"{name}"\s*:\s*("(?:[^"\\]|\\.)*")'), F.lit(1))
    return F.transform(found, lambda q: F.try_variant_get(F.try_parse_json(q), "$", "string"))


def rendered(variants: list[str], seed: int, key: Column, values: dict[str, Column]) -> Column:
    """One of some prompts, drawn by sha256(seed:key), with its {names} filled in; a name without a value is an error."""
    import re

    missing = {n for v in variants for n in re.findall(r"\{(\w+)\}", v)} - set(values)
    if missing:
        raise KeyError(sorted(missing)[0])
    draw = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256), 1, 8), 16, 10).cast("long")
    out = F.element_at(F.array(*map(F.lit, variants)), (draw % len(variants) + 1).cast("int"))
    for name, value in values.items():
        out = F.replace(out, F.lit(f"{{{name}}}"), F.coalesce(value.cast("string"), F.lit("")))
    return out


def message_refs(messages: Column, kind: str = "audio") -> Column:
    """The references of one kind in the order of messages (array of struct<parts: array<struct<kind, ref>>>)."""
    return F.flatten(F.transform(messages, lambda m: F.transform(F.filter(m["parts"], lambda p: p["kind"] == kind), lambda p: p["ref"])))


def portable_path(path: Column, roots: dict[str, str]) -> Column:
    """Struct (alias, relative) by the longest root that holds a path; null where none does."""
    hits = [F.when((path == root) | F.startswith(path, F.lit(root.rstrip("/") + "/")), F.struct(F.lit(len(root)).alias("n"), F.lit(alias).alias("alias"), F.ltrim(F.substring(path, F.lit(len(root) + 1), F.length(path)), F.lit("/")).alias("relative"))) for alias, root in roots.items()]
    best = F.greatest(*hits) if len(hits) > 1 else hits[0]
    return F.when(best.isNotNull(), F.struct(best["alias"].alias("alias"), best["relative"].alias("relative")))


def scrubbed(document: Column, names: tuple[str, ...]) -> tuple[Column, Column]:
    """A flat JSON object without the fields of some names, and how many were dropped."""
    fields = F.from_json(document, "map<string,string>")
    bad = F.map_filter(fields, lambda k, v: k.isin(*names))
    return F.to_json(F.map_filter(fields, lambda k, v: ~k.isin(*names))), F.size(bad)


def dot(a: Column, b: Column) -> Column:
    """Dot product of two vectors, in double."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors; null where one has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def value_at(document: Column, path: str) -> Column:
    """The value at a dotted path of a JSON document: texts as they are, other values as JSON, absent and null as null."""
    value = F.try_variant_get(F.try_parse_json(document), "$." + path, "variant")
    kind = F.schema_of_variant(value)
    return F.when(kind == "STRING", F.try_variant_get(value, "$", "string")).when(kind != "VOID", F.to_json(value))


def mixed_script_blanks(text: Column) -> Column:
    """How many single blanks stand between a Han character and a Latin letter, either way round."""
    return F.size(F.regexp_extract_all(text, F.lit(r"[\u4e00-\u9fff] [A-Za-z]|[A-Za-z] [\u4e00-\u9fff]"), F.lit(0)))


def without_framing(text: Column, openings: tuple[str, ...], quotes: str = "\"'“”「」") -> Column:
    """A model's reply without its opening phrase (up to a colon) and the quotation marks around it."""
    start = "|".join(openings)
    out = F.regexp_replace(F.trim(text), rf"^(?i:(?:{start})[^:：\n]*[:：])\s*", "")
    return F.regexp_replace(out, rf"^[{quotes}]+|[{quotes}]+$", "")
