"""Record predicates, projections and validation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class RecordQuery:
    """A conjunction of optional conditions. `ids=()` matches nothing; `ids=None` doesn't filter; null flags never match."""

    ids: tuple | None = None
    task: str | None = None
    language: str | None = None
    split: str | None = None
    clean_pass: bool | None = None

    def condition(self) -> Column:
        out = F.col("retained")
        if self.ids is not None:
            out = out & (F.col("id").isin(*self.ids) if self.ids else F.lit(False))
        for name in ("task", "language", "clean_pass"):
            if (value := getattr(self, name)) is not None:
                out = out & (F.col(name) == F.lit(value))
        if self.split is not None:
            out = out & F.array_contains("splits", self.split)
        return out

    def apply(self, df: DataFrame) -> DataFrame:
        return df.filter(self.condition())


def json_flag(document: Column, path: str) -> Column:
    """A JSON boolean at a path, null for anything else: the text "true" and 1 are no booleans."""
    value = F.try_variant_get(F.try_parse_json(document), path, "variant")
    return F.when(F.schema_of_variant(value) == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))


def primary_slot(slots: Column) -> Column:
    """The only slot, else the one of purpose or name primary, else the one mixture; null where that isn't unique."""
    named = lambda want: F.filter(slots, lambda s: (s["purpose"] == want) | (s["name"] == want))
    only = lambda a: F.when(F.size(a) == 1, a[0])
    return F.when(F.size(slots) == 1, slots[0]).otherwise(F.coalesce(only(named("primary")), only(named("mixture"))))


def frame_span(start: Column, duration: Column, rate: Column, frames: Column) -> tuple[Column, Column]:
    """First frame and number of frames; without a start the whole file. Halves round to even."""
    first = F.when(start.isNull(), F.lit(0)).otherwise(F.rint(start * rate)).cast("long")
    length = F.when(start.isNull(), frames).otherwise(F.rint(duration * rate)).cast("long")
    return first, length


def mapped(value: Column, vocabulary: dict[str, str]) -> Column:
    """A value by a fixed vocabulary, spelling and blanks aside; an unknown spelling is an error, null stays null."""
    table = F.create_map(*[F.lit(x) for kv in vocabulary.items() for x in kv])
    found = F.element_at(table, F.lower(F.trim(value)))
    return F.when(value.isNull(), F.lit(None)).when(found.isNull(), F.raise_error(F.concat(F.lit("unknown value: "), value))).otherwise(found)


def violations(rules: dict[str, Column]) -> Column:
    """The names of the rules that a row breaks (a rule that is null is broken)."""
    return F.filter(F.array(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules.items()]), lambda x: x.isNotNull())


def bin_of(value: Column, edges: list[float], closed: str = "right") -> Column:
    """Number of the bin a value is in: (lo, hi] or [lo, hi); -1 outside."""
    out = F
    for i, (lo, hi) in enumerate(zip(edges, edges[1:], strict=False)):
        out = out.when((value > lo) & (value <= hi) if closed == "right" else (value >= lo) & (value < hi), i)
    return out.otherwise(-1)
