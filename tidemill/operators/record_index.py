"""Record indexes: typed facts of records, slots located in their audio, checks of an index against its sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.records import frame_span, primary_slot
from tidemill.session import kept

#: The JSON types that a typed fact may have, by what it is to become.
_TYPES = {"double": ("BIGINT", "DOUBLE", "DECIMAL"), "long": ("BIGINT",), "boolean": ("BOOLEAN",), "string": ("STRING",)}


def typed(document: Column, path: str, kind: str, empty_to_null: bool = False) -> Column:
    """Struct (value, wrong) of a JSON field: absent and null give null; a value of another type gives null and wrong.

    Casts of variants coerce, so that the type is looked at first: true is no number, and "1" isn't either."""
    value = F.try_variant_get(F.try_parse_json(document), path, "variant")
    name = F.regexp_extract(F.schema_of_variant(value), "^[A-Z]+", 0)
    none = value.isNull() | (name == "VOID")
    fits = name.isin(*_TYPES[kind])
    cast = F.when(~none & fits, F.try_variant_get(value, "$", kind))
    if empty_to_null:
        cast = F.nullif(cast, F.lit(""))
    return F.struct(cast.alias("value"), F.coalesce(~none & ~fits, F.lit(False)).alias("wrong"))


def channel(document: Column) -> Column:
    """Struct (value, wrong) of a channel as JSON: an integer or null passes, a list of one is unwrapped, others are wrong."""
    value = F.try_parse_json(document)
    name = F.schema_of_variant(value)
    items = F.try_variant_get(value, "$", "array<variant>")
    one = F.when(F.startswith(name, F.lit("ARRAY")) & (F.size(items) == 1), items[0]).otherwise(value)
    kind = F.schema_of_variant(one)
    none = document.isNull() | (kind == "VOID")
    number = F.when(kind == "BIGINT", F.try_variant_get(one, "$", "int"))
    return F.struct(number.alias("value"), (~none & number.isNull()).alias("wrong"))


def record_index(records: DataFrame, cuts: DataFrame) -> DataFrame:
    """One row per record (id, slots: array of name, purpose, cut_id, start, duration): its slots with frames, its main
    slot's cut and frames, and the first problem (null: none).

    Slots are exploded, located in `cuts` (cut_id, rate, frames) by one equi-join and gathered again by record. Ids given twice
    are a problem of all their rows."""
    # Rows are named by their content, and written first: gathered slots may stand in another order at each reading of a plan.
    rows = kept(records.withColumn("__row", F.sha2(F.to_json(F.struct("id", "slots")), 256)), "records")
    slots = rows.select("__row", "slots").dropDuplicates(["__row"]).select("__row", F.posexplode_outer("slots").alias("pos", "s"))
    found = slots.select("__row", "pos", "s.*").join(cuts.select("cut_id", "rate", "frames"), "cut_id", "left")
    first, length = frame_span(F.col("start"), F.col("duration"), F.col("rate"), F.col("frames"))
    slot = F.struct("pos", "name", "purpose", "cut_id", first.alias("start_frame"), length.alias("num_frames"))
    lost = F.count_if(F.col("cut_id").isNotNull() & F.col("rate").isNull()).alias("lost")
    gathered = found.groupBy("__row").agg(F.array_sort(F.collect_list(F.when(F.col("pos").isNotNull(), slot))).alias("slots"), lost)
    twice = rows.groupBy("id").agg(F.count("*").alias("__n"))
    out = rows.drop("slots").join(gathered, "__row").join(twice, "id").withColumn("main", primary_slot(F.col("slots")))
    problem = F.when(F.col("__n") > 1, "id given twice").when(F.col("lost") > 0, "cut isn't indexed").when(F.col("main").isNull(), "no main slot")
    return out.select(*[c for c in records.columns if c != "slots"], "slots", F.col("main.cut_id").alias("cut_id"), F.col("main.start_frame").alias("start_frame"), F.col("main.num_frames").alias("num_frames"), problem.alias("problem"))


def index_table(index: DataFrame, split: str | None = None, predicate: str | None = None, columns: tuple[str, ...] = ("id",)) -> DataFrame:
    """Rows of a split that a SQL predicate holds for; both reach the scan."""
    out = index if split is None else index.filter(F.array_contains("splits", split))
    return (out.filter(F.expr(predicate)) if predicate else out).select(*columns)


def split_counts(index: DataFrame) -> DataFrame:
    """split and number of rows."""
    return index.select(F.explode("splits").alias("split")).groupBy("split").agg(F.count("*").alias("n"))


def index_differences(index: DataFrame, source: DataFrame, columns: list[str], key: str = "id", sample: int | None = None, seed: int = 1) -> DataFrame:
    """name, n: rows missing and stray, and for every column how many of the shared (or sampled) rows differ in it.

    A sample is the rows with the least sha256 of seed and key."""
    left, right = (df.select(key, F.struct(*columns).alias(side)) for df, side in ((index, "a"), (source, "b")))
    both = left.join(right, key, "full")
    if sample is not None:
        both = both.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(sample)
    shared = F.col("a").isNotNull() & F.col("b").isNotNull()
    counts = {"missing": F.col("a").isNull(), "stray": F.col("b").isNull()} | {c: shared & ~F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns}
    row = both.agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    return row.select(F.stack(F.lit(len(counts)), *[x for n in counts for x in (F.lit(n), F.col(n))]).alias("name", "n"))


def source_keys(document: Column, declarations: list[tuple[str, list[str], str | None]]) -> tuple[Column, Column]:
    """Sorted distinct keys `namespace:value` of a JSON record, and the namespaces of declarations that give it none.

    A declaration is (namespace, dotted fields, expression): every match of the expression in a field is a key, or, without
    one, the field's text."""
    parsed = F.try_parse_json(document)
    found, missing = [], []
    for name, fields, pattern in declarations:
        texts = F.array(*[F.try_variant_get(parsed, "$." + f, "string") for f in fields])
        texts = F.filter(texts, lambda t: t.isNotNull() & (t != ""))
        keys = F.flatten(F.transform(texts, lambda t: F.regexp_extract_all(t, F.lit(pattern), F.lit(0)))) if pattern else texts  # noqa: B023
        found.append(F.transform(keys, lambda k: F.concat(F.lit(f"{name}:"), k)))  # noqa: B023
        missing.append(F.when(F.size(keys) == 0, F.lit(name)))
    return F.array_sort(F.array_distinct(F.concat(*found))), F.filter(F.array(*missing), lambda m: m.isNotNull())


def holdout_keys(lines: DataFrame, pattern: str, text: str = "value") -> tuple[DataFrame, DataFrame]:
    """Distinct held-out keys of whitespace-separated tokens (the first match in each), and the tokens without one."""
    tokens = lines.select(F.explode(F.split(F.trim(text), r"\s+")).alias("token")).filter("token <> ''")
    key = F.regexp_extract("token", pattern, 0)
    return tokens.filter(key != "").select(key.alias("key")).distinct(), tokens.filter(key == "").distinct()
