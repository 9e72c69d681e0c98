"""Layers: sparse patches of records by dotted path, checked and replayed."""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.operators.measures import multiset_digest

#: The fields that a layer may write, and those of them that have fields below.
ROOTS = ("target", "language", "hotwords", "metadata", "labels", "$membership")
NESTED = ("metadata", "labels")


@dataclass(frozen=True)
class Step:
    """A layer's declaration: the paths that it writes and those of them that may override others."""

    name: str
    writes: tuple[str, ...]
    overrides: tuple[str, ...] = field(default=())


def upwards(path: str) -> set[str]:
    """A dotted path and all above it."""
    parts = path.split(".")
    return {".".join(parts[:n]) for n in range(1, len(parts) + 1)}


def check_step(step: Step, earlier: list[Step]) -> list[str]:
    """What is wrong with a step after the earlier ones; empty if nothing is. Two paths meet where one is among those above the other."""
    parts = {p: p.split(".") for p in step.writes}
    out = [f"{p}: not a field that layers write" for p, x in parts.items() if x[0] not in ROOTS or not all(x) or (len(x) > 1 and x[0] not in NESTED)]
    guarded = [p for p in step.writes if upwards(p).isdisjoint(step.overrides)]
    return out + [f"{p}: also written by {old.name}" for old in earlier for p in guarded if any(q in upwards(p) or p in upwards(q) for q in old.writes)]


def dotted(path: Column) -> Column:
    """A dotted path and all above it, shortest first."""
    parts = F.split(path, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "."))


def step_problems(writes: DataFrame) -> DataFrame:
    """chain, step, field, problem for a table of declared writes (chain, step, field, overrides): the rules of check_step
    over many chains of steps. Whether paths meet is an equi-join on the paths above them."""
    parts, root = F.split("field", r"\."), F.split_part("field", F.lit("."), F.lit(1))
    bad = ~root.isin(*ROOTS) | F.array_contains(parts, "") | ((F.size(parts) > 1) & ~root.isin(*NESTED))
    wrong = writes.filter(bad).select("chain", "step", "field", F.lit("not a field").alias("problem"))
    ups = writes.select("chain", "step", "field", "overrides", F.explode(dotted(F.col("field"))).alias("up"))
    above = ups.join(writes.groupBy("chain", F.col("field").alias("up")).agg(F.min("step").alias("first")), ["chain", "up"])
    below = writes.join(ups.groupBy("chain", F.col("up").alias("field")).agg(F.min("step").alias("first")), ["chain", "field"])
    cols = ["chain", "step", "field", "overrides", "first"]
    free = F.exists("overrides", lambda o: (F.col("field") == o) | F.startswith("field", F.concat(o, F.lit("."))))
    met = above.select(*cols).unionByName(below.select(*cols)).filter((F.col("first") < F.col("step")) & ~free)
    return wrong.unionByName(met.select("chain", "step", "field", F.lit("written before").alias("problem"))).distinct()


def canonical(value) -> str:
    """One spelling of a JSON value: sorted keys, no blanks."""
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False, allow_nan=False)


def change_problem(changes: Column, step: Step) -> Column:
    """The first rule that a patch breaks by its paths alone (null: none): paths of which one lies within another, then by path
    those that aren't declared and those with an empty name."""
    paths = F.array_sort(F.map_keys(changes))
    nested = F.exists(paths, lambda p: F.size(F.array_intersect(dotted(p), paths)) > 1)
    declared = F.array(*map(F.lit, sorted(set(step.writes) - {"$membership"}))) if set(step.writes) - {"$membership"} else F.array().cast("array<string>")
    wrong = lambda p: F.when(~F.arrays_overlap(dotted(p), declared), F.concat(p, F.lit(" isn't declared"))).when(F.array_contains(F.split(p, r"\."), ""), F.concat(p, F.lit(": an empty name")))
    return F.when(nested, "paths of one patch meet").otherwise(F.get(F.filter(F.transform(paths, wrong), lambda x: x.isNotNull()), F.lit(0)))


class _Set:
    """A new value in a tree of changes."""

    def __init__(self, path: str, value):
        self.path, self.value = path, value


def _tree(changes: dict[str, str]) -> dict:
    """Changes by dotted path as nested objects."""
    root: dict = {}
    for path, value in sorted(changes.items()):
        *names, leaf = path.split(".")
        reduce(lambda node, name: node.setdefault(name, {}), names, root)[leaf] = _Set(path, json.loads(value))
    return root


def _first(tree) -> str:
    return tree.path if isinstance(tree, _Set) else _first(next(iter(tree.values())))


def grafted(old, tree, overrides: frozenset[str], name: str = ""):
    """`old` with a tree of changes put in; objects that are missing are made. Nothing that is there is changed in place."""
    if isinstance(tree, _Set):
        if old is not _NOTHING and old != tree.value and upwards(tree.path).isdisjoint(overrides):
            raise ValueError(f"{tree.path}: would override a value")
        return tree.value
    if old is _NOTHING:
        old = {}
    if not isinstance(old, dict):
        raise ValueError(f"{_first(tree)}: {name} is no object")
    return old | {k: grafted(old.get(k, _NOTHING), sub, overrides, k) for k, sub in tree.items()}


_NOTHING = object()


def replay(records: DataFrame, layer: DataFrame, step: Step, key: str = "id", document: str = "record_json") -> DataFrame:
    """Records (key, document, retained) with a layer (id, changes map, status) applied: key, document, retained, error.

    Deleted rows stay with retained = false. An error leaves the document as it was and says why. Paths are checked as columns;
    only patched documents pass through Python, for Spark has no function that sets a value in JSON."""
    overrides = frozenset(step.overrides)

    @F.pandas_udf("document string, error string")
    def run(docs: pd.Series, changes: pd.Series) -> pd.DataFrame:
        out = []
        for doc, change in zip(docs, changes, strict=True):
            try:
                out.append((canonical(grafted(json.loads(doc), _tree(dict(change)), overrides)) if change is not None else doc, None))
            except ValueError as e:
                out.append((doc, str(e)))
        return pd.DataFrame(out, columns=["document", "error"])

    new = layer.select(F.col("id").alias(key), F.when(F.size("changes") > 0, F.col("changes")).alias("changes"), "status", change_problem(F.col("changes"), step).alias("__wrong"))
    rows = records.join(new, key, "left").withColumn("__r", run(F.col(document), F.when(F.col("__wrong").isNull(), F.col("changes"))))
    gone = F.col("status") == "delete"
    kept = F.col("retained") & F.coalesce(~gone | F.lit("$membership" not in step.writes), F.lit(True))
    hidden = F.when(F.col("status").isNotNull() & ~F.col("retained"), "patch of a deleted record")
    barred = F.when(gone & F.lit("$membership" not in step.writes), "delete isn't declared")
    return rows.select(key, F.col("__r.document").alias(document), kept.alias("retained"), F.coalesce(hidden, barred, F.col("__wrong"), F.col("__r.error")).alias("error"))


def layer_problems(layer: DataFrame, parent: DataFrame, key: str = "id") -> DataFrame:
    """id and problem: patches without an id or a known status, given twice, or without a visible parent."""
    found = [layer.groupBy("id").agg(F.count("*").alias("n")).filter("n > 1").select("id", F.lit("given twice").alias("problem"))]
    if "status" in layer.columns:
        found.append(layer.filter(~F.coalesce(F.col("status").isin("keep", "delete"), F.lit(False))).select("id", F.lit("no such status").alias("problem")))
    found.append(layer.filter(F.coalesce(F.col("id").cast("string") == "", F.lit(True))).select("id", F.lit("no id").alias("problem")))
    visible = parent.filter("retained").select(F.col(key).alias("id"))
    found.append(layer.join(visible, "id", "left_anti").select("id", F.lit("no visible parent").alias("problem")))
    return reduce(DataFrame.unionByName, found)


def layer_rows(layer: DataFrame, parent_version: int) -> DataFrame:
    """The rows that a layer is stored as: id, changes, status, parent_version, patch_hash, ordered by id within each file.

    The hash is the sha256 of the row's canonical JSON, made of columns; values of `changes` are JSON already."""
    quoted = lambda c: F.expr(f"substring(to_json(array({c})), 2, length(to_json(array({c}))) - 2)")
    pairs = F.transform(F.array_sort(F.map_entries("changes")), lambda e: F.concat(F.substring(F.to_json(F.array(e["key"])), F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(":"), e["value"]))
    text = F.concat(F.lit('{"changes":{'), F.array_join(pairs, ","), F.lit('},"id":'), quoted("cast(id as string)"), F.lit(f',"parent_version":{parent_version},"status":'), quoted("status"), F.lit("}"))
    return layer.select("id", "changes", "status", F.lit(parent_version).cast("long").alias("parent_version"), F.sha2(text, 256).alias("patch_hash")).sortWithinPartitions("id")


def layer_counts(rows: DataFrame, parent: DataFrame) -> DataFrame:
    """One row: patches, those that keep their record, the parent's visible rows, those of the result, and a digest of the
    stored rows that doesn't depend on their order (eight sums)."""
    own = rows.agg(F.count("*").alias("input_count"), F.count_if(F.col("status") == "keep").alias("output_count"), *multiset_digest(F.col("patch_hash")))
    seen = parent.filter("retained").agg(F.count("*").alias("parent_record_count"))
    both = own.join(seen)  # one row each
    return both.withColumn("result_record_count", F.col("parent_record_count") - F.col("input_count") + F.col("output_count"))


def written_layer(layer: DataFrame, parent: DataFrame, step: Step, parent_version: int, path: str, key: str = "id", document: str = "record_json") -> DataFrame:
    """Check a layer against its parent, write its rows to a new folder and give its counts. Nothing is written if a patch is wrong."""
    problems = layer_problems(layer, parent, key).limit(1).collect()
    broken = replay(parent, layer, step, key, document).filter("error is not null").limit(1).collect()
    if problems or broken or not layer.limit(1).count():
        raise ValueError(str((problems or broken or ["an empty layer"])[0]))
    layer_rows(layer, parent_version).write.mode("errorifexists").parquet(path)
    return layer_counts(layer.sparkSession.read.parquet(path), parent)
