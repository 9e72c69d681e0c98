"""Checks of a catalog of datasets, splits and views held as tables; each returns the rows that are wrong."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.functions.text import ancestors


def lookup(names: DataFrame) -> DataFrame:
    """name -> dataset_id from (dataset_id, alias): an id beats an alias; a name that stays ambiguous is left out."""
    ids = names.select(F.col("dataset_id").alias("name"), "dataset_id", F.lit(0).alias("rank")).distinct()
    aliases = names.filter("alias is not null").select(F.col("alias").alias("name"), "dataset_id", F.lit(1).alias("rank")).distinct()
    found = ids.unionByName(aliases).groupBy("name").agg(F.count_if(F.col("rank") == 0).alias("n_ids"), F.count_if(F.col("rank") == 1).alias("n_aliases"), F.min_by("dataset_id", F.struct("rank", "dataset_id")).alias("dataset_id"))
    return found.filter("n_ids = 1 or n_aliases = 1").select("name", "dataset_id")


def write_conflicts(transforms: DataFrame, key: list[str]) -> DataFrame:
    """Fields that a view writes again without overriding: rows (key, step, field, override), the very same field counts."""
    first = transforms.groupBy(*key, "field").agg(F.min("step").alias("first"))
    return transforms.join(first, [*key, "field"]).filter((F.col("step") > F.col("first")) & ~F.col("override")).select(*key, "step", "field")


def lineage_problems(views: DataFrame, datasets: DataFrame) -> DataFrame:
    """Views (name, source, result, lineage) whose ends aren't registered, or whose exact lineage the result doesn't state.

    Datasets are rows (ref, dataset_id, derived_from); within one dataset an exact result derives from nothing."""
    end = lambda side: datasets.select(F.col("ref").alias(side), F.col("dataset_id").alias(f"{side}_id"), F.col("derived_from").alias(f"{side}_from"))
    rows = views.join(end("source"), "source", "left").join(end("result"), "result", "left")
    same = F.col("source_id") == F.col("result_id")
    stated = F.when(same, F.col("result_from").isNull()).otherwise(F.coalesce(F.col("result_from") == F.col("source_id"), F.lit(False)))
    problem = F.when(F.col("source_id").isNull(), "no source").when(F.col("result_id").isNull(), "no result").when((F.col("lineage") == "exact") & ~stated, "lineage")
    return rows.select("name", problem.alias("problem")).filter("problem is not null")


def dependents(rows: DataFrame, prefixes: DataFrame, path: str = "path") -> DataFrame:
    """Number of rows at or under each prefix (0 too): an equi-join on the rows' ancestors."""
    up = rows.select(F.explode(ancestors(F.col(path))).alias("prefix")).groupBy("prefix").agg(F.count("*").alias("n"))
    return prefixes.select("prefix").distinct().join(up, "prefix", "left").select("prefix", F.coalesce("n", F.lit(0)).alias("n"))


def filled(rows: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Rows with their nulls filled from another table; what they have stays."""
    other = new.select(key, *[F.col(c).alias(f"__{c}") for c in columns])
    joined = rows.join(other, key, "left")
    return joined.select(*[F.coalesce(c, f"__{c}").alias(c) if c in columns else F.col(c) for c in rows.columns])


def gates(rows: DataFrame, split: str, value: str, empty, limits: DataFrame) -> DataFrame:
    """Splits that break their limits (split, gate, least, most) on n, min, max, mean, median or n_empty; a split without rows breaks all of its."""
    facts = rows.groupBy(split).agg(*[f.cast("double").alias(n) for n, f in {"n": F.count("*"), "min": F.min(value), "max": F.max(value), "mean": F.avg(value), "median": F.median(value), "n_empty": F.count_if(empty)}.items()])
    long = facts.unpivot([split], ["n", "min", "max", "mean", "median", "n_empty"], "gate", "value")
    return limits.join(long, [split, "gate"], "left").filter("value is null or value < least or value > most").select(split, "gate", "value")


def stretched(counts: DataFrame, amount: float, key: str, count: str) -> DataFrame:
    """Equal shares of an amount, capped by each row's count, with the rest passed on: the level that all but the capped reach.

    For tables of groups. The level follows from the counts in order, without iterating."""
    from pyspark.sql import Window

    w = Window.orderBy(count, key)
    below = F.coalesce(F.sum(count).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.count("*").over(Window.partitionBy()) - F.row_number().over(w) + 1
    levels = counts.select(key, count, ((F.lit(amount) - below) / left).alias("level"))
    # Levels rise up to the first row whose count passes its level and fall after it: that row's is the greatest there.
    level = F.max(F.when(F.col(count) >= F.col("level"), F.col("level"))).over(Window.partitionBy())
    return levels.select(key, F.least(F.col(count).cast("double"), F.coalesce(level, F.col(count).cast("double"))).alias("share"))


def resolved_views(requests: DataFrame, views: DataFrame) -> DataFrame:
    """name, version asked for (or null), version found and problem: without a version a name must have one version only."""
    known = views.groupBy("name").agg(F.count_distinct("version").alias("n"), F.min("version").alias("only"))
    exact = views.select("name", F.col("version").alias("found")).distinct()
    rows = requests.join(known, "name", "left").join(exact.withColumn("version", F.col("found")), ["name", "version"], "left")
    found = F.when(F.col("version").isNotNull(), F.col("found")).when(F.col("n") == 1, F.col("only"))
    problem = F.when(F.col("n").isNull(), "unknown view").when(F.col("version").isNull() & (F.col("n") > 1), "version required").when(F.col("version").isNotNull() & F.col("found").isNull(), "unknown version")
    return rows.select("name", "version", found.alias("found"), problem.alias("problem"))


def deepest_round(rounds: DataFrame, base: str, n: str) -> DataFrame:
    """base and the last of its rounds 1, 2, ... before the first gap; 0 where round 1 isn't there."""
    rows = rounds.select(base, n).distinct().withColumn("__r", F.row_number().over(Window.partitionBy(base).orderBy(n)))
    return rows.groupBy(base).agg(F.coalesce(F.max(F.when(F.col(n) == F.col("__r"), F.col(n))), F.lit(0)).alias("head"))


def exact_patched(rows: DataFrame, patches: DataFrame, key: str, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows with patches (key, from, to) applied where the value is the one that the patch names; and the patches that don't fit (key,
    problem), for which the caller should stop: keys that are patched twice, patches to null, missing rows, stale values."""
    new = patches.groupBy(key).agg(F.count("*").alias("__n"), F.first("from").alias("__from"), F.first("to").alias("__to"))
    met = rows.join(new, key, "left")
    good = (F.col("__n") == 1) & F.col("__to").isNotNull()
    fits = good & F.col("__from").eqNullSafe(F.col(column))
    fixed = met.withColumn(column, F.when(fits, F.col("__to")).otherwise(F.col(column))).select(*rows.columns)
    stale = met.filter(good & ~fits).select(key, F.lit("stale").alias("problem"))
    odd = new.filter(~good).select(key, F.when(F.col("__n") > 1, "patched twice").otherwise("to null").alias("problem"))
    return fixed, stale.unionByName(odd).unionByName(new.filter(good).join(rows.select(key), key, "left_anti").select(key, F.lit("missing").alias("problem")))


def protocol_problems(protocol: DataFrame, files: DataFrame, labels: DataFrame, key: str, label: str) -> DataFrame:
    """key and the first thing wrong between a protocol (key, label), the files and the labels (key, label)."""
    rows = protocol.select(key, F.col(label).alias("a"), F.lit(True).alias("p")).join(files.select(key, F.lit(True).alias("f")).distinct(), key, "full").join(labels.select(key, F.col(label).alias("b"), F.lit(True).alias("l")), key, "full")
    problem = F.when(F.col("p").isNull() & F.col("f").isNotNull(), "stray file").when(F.col("p").isNull(), "stray label").when(F.col("f").isNull(), "missing file").when(F.col("l").isNull(), "missing label").when(~F.col("a").eqNullSafe(F.col("b")), "labels disagree")
    return rows.select(key, problem.alias("problem")).filter("problem is not null")


def inventory(specs: DataFrame) -> DataFrame:
    """dataset_id, kind, family of the specs that no other supersedes (columns dataset_id, supersedes, planned, n_parts, family):
    planned, mixture (of several parts) or single; a family is named by its least dataset."""
    gone = specs.filter("supersedes is not null").select(F.col("supersedes").alias("dataset_id")).distinct()
    rows = specs.join(gone, "dataset_id", "left_anti")
    named = rows.groupBy("family").agg(F.min("dataset_id").alias("head"))
    kind = F.when(F.col("planned"), "planned").when(F.col("n_parts") > 1, "mixture").otherwise("single")
    return rows.join(named, "family").select("dataset_id", kind.alias("kind"), "head")


def storage_findings(paths: DataFrame, zones: DataFrame) -> DataFrame:
    """category, path, n_bytes: paths (path, n_bytes, zone or null) in no zone, zones (zone, budget) over their budget, and zones that hold nothing."""
    loose = paths.filter("zone is null").select(F.lit("unregistered").alias("category"), "path", "n_bytes")
    sums = zones.join(paths.groupBy("zone").agg(F.sum("n_bytes").alias("n_bytes")), "zone", "left")
    over = sums.filter("n_bytes > budget").select(F.lit("over_budget").alias("category"), F.col("zone").alias("path"), "n_bytes")
    none = sums.filter("n_bytes is null").select(F.lit("missing").alias("category"), F.col("zone").alias("path"), F.lit(0).cast("long").alias("n_bytes"))
    return loose.unionByName(over).unionByName(none)


def zone_findings(folders: DataFrame, zones: DataFrame, today, min_bytes: int) -> DataFrame:
    """category, path, n_bytes, zone of registered zones (path, budget, child_budget, stale_days, expires; each may be null) and the
    folders right below them (path, parent, n_bytes, age_days): zones over their budget or past their date, folders over what
    each may hold, and folders of some size that nothing was changed in for too long."""
    own = folders.select(F.col("path").alias("zone"), "n_bytes")
    at = zones.withColumnRenamed("path", "zone").join(own, "zone")
    below = folders.join(zones.withColumnRenamed("path", "parent"), "parent").withColumn("zone", F.col("parent"))

    def found(rows: DataFrame, category: str, wrong, path: str) -> DataFrame:
        return rows.filter(wrong).select(F.lit(category).alias("category"), F.col(path).alias("path"), "n_bytes", "zone")

    old = (F.col("age_days") > F.col("stale_days")) & (F.col("n_bytes") >= min_bytes)
    out = found(at, "over_budget", F.col("n_bytes") > F.col("budget"), "zone").unionByName(found(at, "expired", F.col("expires") < F.lit(today), "zone"))
    return out.unionByName(found(below, "over_budget", F.col("n_bytes") > F.col("child_budget"), "path")).unionByName(found(below, "stale", old, "path"))


def leans_on(alias: Column, path: Column, wanted: str, prefix: str) -> Column:
    """Whether a place (alias and path) is one that a dependency names: the same alias, and the path or one below it."""
    return (alias == wanted) & ((path == prefix) | F.startswith(path, F.lit(prefix.rstrip("/") + "/")))


def selected(artifacts: DataFrame, key: list[str], order: str, name: str, **wanted: str | None) -> DataFrame:
    """key, names: what each key's artifacts of the wanted mode, language, task or role are, in the order in which they were
    declared; a condition of None asks for nothing. The artifacts of one key are a short list."""
    rows = artifacts
    for column, value in wanted.items():
        if value is not None:
            rows = rows.filter(F.col(column) == value)
    return rows.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct(order, name))).alias("x")).select(*key, F.col(f"x.{name}").alias("names"))


def dead_references(versions: DataFrame, references: DataFrame) -> DataFrame:
    """Of live versions (ref, superseded_by null) the references (ref, to) that name none of them."""
    alive = versions.filter("superseded_by is null").select("ref")
    return references.join(alive, "ref", "left_semi").join(alive.select(F.col("ref").alias("to")), "to", "left_anti").select("ref", "to")


def role_totals(rows: DataFrame, key: str, roles: tuple[str, ...], value: str) -> DataFrame:
    """key, role, total: the sum of a value over the first role, in order of precedence, that a key has any row of."""
    sums = rows.groupBy(key).agg(*[F.sum(F.when(F.col("role") == r, F.col(value))).alias(r) for r in roles])
    role = F.coalesce(*[F.when(F.col(r).isNotNull(), F.lit(r)) for r in roles])
    return sums.select(key, role.alias("role"), F.coalesce(*roles).alias("total")).filter("role is not null")


def registration_problems(artifacts: DataFrame, aliases: DataFrame, files: DataFrame) -> DataFrame:
    """name and the first thing wrong with artifacts (name, alias, path, n_bytes): an alias that isn't known (aliases: alias), a file that
    isn't there (files: alias, path, size) or one of another size."""
    known = aliases.select("alias", F.lit(True).alias("__known")).distinct()
    rows = artifacts.join(known, "alias", "left").join(files.select("alias", "path", F.col("size").alias("__size")), ["alias", "path"], "left")
    problem = F.when(F.col("__known").isNull(), "unknown alias").when(F.col("__size").isNull(), "missing file").when(F.col("__size") != F.col("n_bytes"), "other size")
    return rows.select("name", problem.alias("problem")).filter("problem is not null")


def samples(rows: DataFrame, annotations: DataFrame | None, key: str, text: str) -> DataFrame:
    """Rows with a text: their own, or, with annotations (key, text, status), that of the annotation that went well alone."""
    if annotations is None:
        return rows.filter(F.col(text).isNotNull())
    good = annotations.filter("status = 'ok'").select(key, F.col(text).alias("__text"))
    return rows.join(good, key).withColumn(text, F.col("__text")).drop("__text").filter(F.col(text).isNotNull())


def shared_between(rows: DataFrame, split: str, kinds: dict[str, Column]) -> DataFrame:
    """kind, a, b, n: how many different keys of each kind two splits share. A key meets the list of its splits, which is as long
    as there are splits at most; no two rows are paired."""
    keyed = rows.select(F.col(split).alias("split"), F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), c.cast("string").alias("key")) for k, c in kinds.items()])).alias("x")).select("split", "x.*").filter("key is not null")
    held = keyed.groupBy("kind", "key").agg(F.array_sort(F.collect_set("split")).alias("s")).filter("size(s) > 1")
    pairs = F.flatten(F.transform("s", lambda a, i: F.transform(F.slice("s", i + 2, F.size("s")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return held.select("kind", F.explode(pairs).alias("p")).groupBy("kind", "p.a", "p.b").agg(F.count("*").alias("n"))
