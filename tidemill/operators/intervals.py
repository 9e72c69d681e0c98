"""Intervals on a key: overlap joins, unions, sweeps, sessions and packing."""

from __future__ import annotations

import json
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemill.session import ensure_checkpoints, kept

SLICE_ROWS = 20_000  # rows that one task of a sequential rule holds
TASK_ROWS = 200_000  # rows that one task of a chain of pointers holds, but for a key that has more


def overlap_join(left: DataFrame, right: DataFrame, keys: list[str], width: float) -> DataFrame:
    """Pairs whose [start, stop) overlap within a key. Both are dealt into bins of a width, which keeps hot keys apart;
    a pair is kept in the bin where the later of the two begins, so that it comes out once."""
    bins = lambda df: df.withColumn("__bin", F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.greatest("start", "stop") / width))))
    a = bins(left).select(*keys, "__bin", *[F.col(c).alias(f"l_{c}") for c in left.columns if c not in keys])
    b = bins(right).select(*keys, "__bin", *[F.col(c).alias(f"r_{c}") for c in right.columns if c not in keys])
    hit = (F.col("l_start") < F.col("r_stop")) & (F.col("r_start") < F.col("l_stop"))
    first = F.col("__bin") == F.floor(F.greatest("l_start", "r_start") / width)
    return a.join(b, [*keys, "__bin"]).filter(hit & first).drop("__bin")


def islands(df: DataFrame, keys: list[str], gap: float = 0.0, order: str = "id") -> DataFrame:
    """Number of the run of intervals that touch (or lie within a gap): `island` per key."""
    w = Window.partitionBy(*keys).orderBy("start", "stop", order)
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__new", F.when(reach.isNull() | (F.col("start") > reach + gap), 1).otherwise(0)).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def union_length(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """Length covered by the intervals of each key."""
    runs = islands(df, keys, 0.0, order).groupBy(*keys, "island").agg((F.max("stop") - F.min("start")).alias("n"))
    return runs.groupBy(*keys).agg(F.sum("n").alias("covered"))


def crowded_length(df: DataFrame, keys: list[str], least: int = 2) -> DataFrame:
    """Length during which at least so many intervals are active; at equal times ends come before starts."""
    events = df.select(*keys, F.explode(F.array(F.struct(F.col("start").alias("t"), F.lit(1).alias("d")), F.struct(F.col("stop").alias("t"), F.lit(-1).alias("d")))).alias("e")).select(*keys, "e.*")
    steps = events.groupBy(*keys, "t").agg(F.sum("d").alias("d"))
    w = Window.partitionBy(*keys).orderBy("t")
    steps = steps.withColumn("active", F.sum("d").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("next", F.lead("t").over(w))
    return steps.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col("active") >= least, F.col("next") - F.col("t"))), F.lit(0)).alias("crowded"))


def clean_cuts(df: DataFrame, keys: list[str], pause: float, order: str = "id") -> DataFrame:
    """Intervals after which everything has ended and the next begins only after a pause."""
    w = Window.partitionBy(*keys).orderBy("start", "stop", order)
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, 0))
    rows = df.withColumn("reach", reach).withColumn("__next", F.lead("start").over(w))
    return rows.filter(F.col("__next").isNull() | (F.col("__next") - F.col("reach") >= pause)).drop("__next")


def alone(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """Intervals that no other overlaps: by the reach before and the start after, without a self-join."""
    w = Window.partitionBy(*keys).orderBy("start", "stop", order)
    before = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn("__before", before).withColumn("__after", F.lead("start").over(w)).filter((F.col("__before").isNull() | (F.col("__before") <= F.col("start"))) & (F.col("__after").isNull() | (F.col("__after") >= F.col("stop")))).drop("__before", "__after")


def clipped(start: Column, stop: Column, lo: Column, hi: Column) -> tuple[Column, Column, Column]:
    """Start and stop relative to a window, and whether anything was cut off."""
    return F.greatest(start, lo) - lo, F.least(stop, hi) - lo, (start < lo) | (stop > hi)


def in_slices(df: DataFrame, keys: list[str], rule, order: str = "id", who: str | None = None, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """keys, order, start, stop (and who) with `label`: what a sequential rule says of the intervals of each key, in order of (start, stop, order).

    The rule takes the state left by the interval before (None at a key's begin) and lists of numbers, starts, stops and names; it returns
    a label (a long or None) for each interval and the state it leaves, a list of plain values. Rows without start or stop take no part.

    All rows are sorted at once and cut into slices of about `slice_rows`, wherever keys begin or end. Each slice is worked through
    as if nothing came before it, and then again while the slice before it hands on another state than it began with. A key's first
    slice is right at once, and each right slice makes the next one right. Rounds are few where a rule soon forgets; there are never more
    than the longest key has slices. A task holds one slice; a state is as long as what the rule keeps open."""
    names = [*keys, order, *([who] if who else [])]
    ok = F.nanvl(F.col("start").cast("double"), F.lit(None)).isNotNull() & F.nanvl(F.col("stop").cast("double"), F.lit(None)).isNotNull()
    rows = kept(df.filter(ok).select(*names, *[F.col(c).cast("double").alias(c) for c in ("start", "stop")]), "intervals")
    parts = max(1, -(-rows.count() // slice_rows))
    of = F.to_json(F.struct(*keys), {"timestampFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS", "ignoreNullFields": "false"})
    by = ["__key", "start", "stop", order]
    rows = rows.withColumn("__key", of).repartitionByRange(parts, *by).sortWithinPartitions(*by).withColumn("__no", F.monotonically_increasing_id())
    rows = kept(rows.withColumn("__slice", F.shiftright("__no", 33)), "slices")
    ends = "label long, came string, left string, first_key string, last_key string"
    schema = StructType([*rows.schema.fields, *StructType.fromDDL(ends).fields])

    def work(own: pa.Table, handed: pa.Table) -> pa.Table:
        own = own.sort_by("__no")
        of_key, numbers, starts, stops = (own.column(c).to_pylist() for c in ("__key", "__no", "start", "stop"))
        called = own.column(who).to_pylist() if who else [None] * len(numbers)
        came = handed.column("came")[0].as_py() if handed.num_rows else None
        labels, state, at = [], json.loads(came) if came else None, 0
        for to in [*(i for i in range(1, len(of_key)) if of_key[i] != of_key[i - 1]), len(of_key)]:
            state = state if at == 0 else None
            found, state = rule(state, numbers[at:to], starts[at:to], stops[at:to], called[at:to])
            labels, at = labels + found, to
        end = {"__slice": own.column("__slice")[0].as_py(), "came": came, "left": json.dumps(state) if state else None, "first_key": of_key[0], "last_key": of_key[-1]}
        strings = [pa.field(c, pa.string()) for c in ("came", "left", "first_key", "last_key")]
        out = own.append_column("label", pa.array(labels, pa.int64()))
        for f in strings:
            out = out.append_column(f, pa.nulls(len(labels), pa.string()))
        last = pa.Table.from_arrays([pa.array([end.get(f.name)], f.type) for f in out.schema], names=out.column_names)
        return pa.concat_tables([out, last])

    todo, states, done = None, None, []
    while todo is None or todo.limit(1).count():
        some = rows if todo is None else rows.join(todo.select("__slice"), "__slice", "left_semi")
        handed = rows.sparkSession.createDataFrame([], "__slice long, came string") if todo is None else todo
        out = kept(some.groupBy("__slice").cogroup(handed.groupBy("__slice")).applyInArrow(work, schema), "round")
        done.append(out)
        new = out.filter("__no is null").select("__slice", "came", "left", "first_key", "last_key", F.lit(len(done)).alias("round"))
        states = kept(new if states is None else states.join(new, "__slice", "left_anti").unionByName(new), "states")
        before = states.select((F.col("__slice") + 1).alias("__slice"), F.col("left").alias("gives"), F.col("last_key").alias("key"))
        hands = states.join(before, "__slice").select("__slice", F.col("came").alias("had"), F.when(F.col("key") == F.col("first_key"), F.col("gives")).alias("came"))
        todo = kept(hands.filter(~F.col("had").eqNullSafe(F.col("came"))).select("__slice", "came"), "todo")
    n = states.agg(F.count("*").alias("n"), F.max("__slice").alias("top")).first()
    if n["n"] and n["n"] != n["top"] + 1:
        raise ValueError("a slice without rows hides what stood before it")
    last = [out.withColumn("round", F.lit(i)) for i, out in enumerate(done, 1)]
    found = reduce(DataFrame.unionByName, last).filter("__no is not null").join(states.select("__slice", "round"), ["__slice", "round"], "left_semi") if len(last) > 1 else last[0].filter("__no is not null")
    return found.select(*names, "start", "stop", "label", "__no")


def greedy_windows(df: DataFrame, keys: list[str], limit: float, gap: float, order: str = "id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Packs of consecutive intervals (keys, head: the first one's order, first, last, n): a new one begins where the span would pass
    the limit or the gap is too wide; an interval longer than the limit is left out, and a new pack begins after it."""

    def rule(state, numbers, starts, stops, _):
        out = []
        for no, start, stop in zip(numbers, starts, stops):
            if state and (stop - start > limit or max(stop, state[2]) - state[1] > limit or start - state[2] > gap):
                state = None
            if stop - start <= limit:
                state = [state[0], state[1], max(stop, state[2])] if state else [no, start, stop]
            out.append(state and state[0])
        return out, state

    rows = in_slices(df, keys, rule, order, None, slice_rows).filter("label is not null")
    packs = rows.groupBy(*keys, "label").agg(F.min_by(order, "__no").alias("head"), F.min("start").alias("first"), F.max("stop").alias("last"), F.count("*").alias("n"))
    return packs.drop("label")


def sessions(df: DataFrame, keys: list[str], at: str, gap: float, order: str) -> DataFrame:
    """Number of the session of each row: a new one after a gap."""
    w = Window.partitionBy(*keys).orderBy(at, order)
    new = F.when(F.lag(at).over(w).isNull() | (F.col(at) - F.lag(at).over(w) > gap), 1).otherwise(0)
    return df.withColumn("__new", new).withColumn("session", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("__new")


def merged_turns(df: DataFrame, keys: list[str], who: str, gap: float, cap: float, order: str = "id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Turns (keys, who, first, last, n): consecutive intervals of one speaker, with pauses of at most a gap and a span of at most a cap.

    A turn ends as well where anyone else starts, which the order of starts shows. Nameless intervals are one speaker's."""

    def rule(state, numbers, starts, stops, names):
        out = []
        for no, start, stop, name in zip(numbers, starts, stops, names):
            if state and state[1] == name and start - state[3] <= gap and max(stop, state[3]) - state[2] <= cap:
                state = [*state[:3], max(stop, state[3])]
            else:
                state = [no, name, start, stop]
            out.append(state[0])
        return out, state

    rows = in_slices(df, keys, rule, order, who, slice_rows)
    turns = rows.groupBy(*keys, "label").agg(F.min_by(who, "__no").alias(who), F.min("start").alias("first"), F.max("stop").alias("last"), F.count("*").alias("n"))
    return turns.drop("label")


def disjoint_picks(df: DataFrame, keys: list[str], share: float, order: str = "id", slice_rows: int = SLICE_ROWS) -> DataFrame:
    """Windows (keys, order) taken greedily in order, each overlapping every taken one by at most a share of the shorter."""

    def rule(state, numbers, starts, stops, _):
        out, open_ = [], state or []
        for start, stop in zip(starts, stops):
            open_ = [t for t in open_ if t[1] > start]
            fits = all(min(stop, b) - max(start, a) <= share * min(stop - start, b - a) for a, b in open_)
            if fits:
                open_.append([start, stop])
            out.append(1 if fits else None)
        return out, open_

    return in_slices(df, keys, rule, order, None, slice_rows).filter("label = 1").select(*keys, order)


def closures(df: DataFrame, keys: list[str], order: str = "id") -> DataFrame:
    """Each interval with the smallest span that holds it and, whole, every interval that overlaps the span: its island's."""
    w = Window.partitionBy(*keys).orderBy("start", "stop", order)
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__new", F.when(reach.isNull() | (F.col("start") >= reach), 1).otherwise(0)).withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    spans = rows.groupBy(*keys, "__run").agg(F.min("start").alias("lo"), F.max("stop").alias("hi"))
    return rows.join(spans, [*keys, "__run"]).drop("__new", "__run")


def others_length(windows: DataFrame, df: DataFrame, keys: list[str], who: str, width: float) -> DataFrame:
    """Per window (id, keys, who, start, stop) the length during which others speak: clipped overlaps, then their union."""
    hits = overlap_join(windows, df, keys, width).filter(F.col(f"l_{who}") != F.col(f"r_{who}"))
    cut = hits.select(F.col("l_id").alias("window"), F.greatest("l_start", "r_start").alias("start"), F.least("l_stop", "r_stop").alias("stop"), F.col("r_id").alias("id"))
    found = union_length(cut, ["window"]).withColumnRenamed("window", "id")
    return windows.select("id").join(found, "id", "left").select("id", F.coalesce("covered", F.lit(0)).alias("others"))


def spoken_inside(windows: DataFrame, speech: DataFrame, keys: list[str], width: float) -> DataFrame:
    """id and length of speech within each window that holds any (windows and speech: keys, id, start, stop)."""
    hits = overlap_join(windows, speech, keys, width)
    return hits.groupBy(F.col("l_id").alias("id")).agg(F.sum(F.least("l_stop", "r_stop") - F.greatest("l_start", "r_start")).alias("spoken"))


def turn_windows(df: DataFrame, keys: list[str], seconds: float, width: float) -> DataFrame:
    """id, hi, n_turns, spoken, crossed: for each turn the window from its start to the end of the last turn that ends within
    some seconds, the whole turns inside, their length, and whether a turn crosses the window's end."""
    heads = df.select(*keys, "id", "start", (F.col("start") + seconds).alias("stop"))
    hits = overlap_join(heads, df.select(*keys, "id", "start", "stop"), keys, width)
    inside = (F.col("r_start") >= F.col("l_start")) & (F.col("r_stop") <= F.col("l_stop"))
    ends = hits.filter(inside).groupBy("l_id").agg(F.max("r_stop").alias("hi"), F.count("*").alias("n_turns"), F.sum(F.col("r_stop") - F.col("r_start")).alias("spoken"))
    over = hits.join(ends, "l_id").groupBy("l_id").agg(F.max((F.col("r_start") < F.col("hi")) & (F.col("r_stop") > F.col("hi"))).alias("crossed"))
    return ends.join(over, "l_id").select(F.col("l_id").alias("id"), "hi", "n_turns", "spoken", "crossed")


def timeline_findings(windows: DataFrame, speech: DataFrame, keys: list[str], who: str, width: float) -> DataFrame:
    """id and finding of windows (keys, id, start, stop, who, present): no_annotation, absent_target_speaks or present_target_silent; null: consistent."""
    hits = overlap_join(windows.select(*keys, "id", "start", "stop", who), speech.select(*keys, "id", "start", "stop", who), keys, width)
    found = hits.groupBy(F.col("l_id").alias("id")).agg(F.max(F.col(f"l_{who}") == F.col(f"r_{who}")).alias("speaks"))
    finding = F.when(F.col("speaks").isNull(), "no_annotation").when(F.col("speaks") & ~F.col("present"), "absent_target_speaks").when(~F.col("speaks") & F.col("present"), "present_target_silent")
    return windows.join(found, "id", "left").select("id", finding.alias("finding"))


def drawn_length(key: Column, seed: int, lo: float, hi: float) -> Column:
    """A length between two bounds, drawn by sha256(seed:key): the same on every run."""
    share = F.conv(F.substring(F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256), 1, 12), 16, 10).cast("double") / float(16**12)
    return F.lit(lo) + share * (hi - lo)


def _parts(df: DataFrame) -> int:
    """Into how many parts a table goes so that a task holds at most about TASK_ROWS of its rows, however many there are; small tables go into no more
    than shuffles have, and than slices. It is counted: keep it first."""
    n = df.count()
    few = min(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // SLICE_ROWS))
    return max(1, few, -(-n // TASK_ROWS))


def followed(hops: DataFrame, heads: DataFrame, rounds: int = 40) -> DataFrame:
    """The nodes (key, node) that are reached from each key's head by following `next`, by doubling: each round the nodes known
    so far are joined with twice the step before. Rounds are cut by checkpoints; their number grows with the logarithm of a key's length.
    Parts grow in number with the hops, so that tasks don't grow in size."""
    ensure_checkpoints(hops.sparkSession)
    step = hops.filter("next is not null").select("key", "node", "next").checkpoint()
    parts = _parts(step)
    dealt = lambda df, *by: df.repartition(parts, *by)
    seen, step = dealt(heads.select("key", "node"), "key", "node"), dealt(step, "key", "node")
    for _ in range(rounds):
        more = seen.join(step, ["key", "node"]).select("key", F.col("next").alias("node"))
        seen = dealt(seen.unionByName(more), "key", "node").distinct().checkpoint()
        then = step.select("key", F.col("node").alias("next"), F.col("next").alias("then"))
        step = dealt(dealt(step, "key", "next").join(then, ["key", "next"]).select("key", "node", F.col("then").alias("next")), "key", "node").checkpoint()
        if not step.limit(1).count():
            break
    return seen


def clean_windows(df: DataFrame, keys: list[str], pause: float, lo: float, hi: float, seed: int, order: str = "id") -> DataFrame:
    """Disjoint windows of whole intervals (key, first id, lo, hi, n): each begins after a clean cut and ends at the last clean cut
    within a length drawn for its first interval; where there is none, the next clean start is tried.

    Where a start leads depends on the start alone, so that the sequence is a chain of pointers: clean cuts and
    drawn ends are met by one sort, and the chain is followed by doubling. No task holds a key's rows."""
    w = Window.partitionBy(*keys).orderBy("start", "stop", order)
    up = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("reach", F.max("stop").over(up)).withColumn("at", F.row_number().over(w)).withColumn("__next", F.lead("start").over(w))
    rows = rows.withColumn("clean", F.col("__next").isNull() | (F.col("__next") - F.col("reach") >= pause))
    rows = rows.withColumn("opens", F.coalesce(F.lag("clean").over(w), F.lit(True)))
    starts = rows.filter("opens").select(*keys, "at", "start", F.col(order).alias("id"), (F.col("start") + drawn_length(F.col(order), seed, lo, hi)).alias("t"))
    cuts = rows.filter("clean").select(*keys, F.col("at").alias("cut"), F.col("reach").alias("t"))
    both = cuts.withColumn("q", F.lit(0)).unionByName(starts.select(*keys, "t", F.col("at").alias("own"), F.lit(1).alias("q")), allowMissingColumns=True)
    last = F.max(F.when(F.col("q") == 0, F.struct("cut", F.col("t").alias("hi")))).over(Window.partitionBy(*keys).orderBy("t", "q").rowsBetween(Window.unboundedPreceding, 0))
    ends = both.withColumn("end", last).filter("q = 1").select(*keys, F.col("own").alias("at"), "end")
    found = starts.join(ends, [*keys, "at"]).withColumn("fits", F.coalesce(F.col("end.cut") >= F.col("at"), F.lit(False)))
    after = F.lead("at").over(Window.partitionBy(*keys).orderBy("at"))
    found = found.withColumn("next", F.when(F.col("fits"), F.col("end.cut") + 1).otherwise(after)).withColumn("key", F.struct(*keys)).withColumn("node", F.col("at"))
    # A clean cut is followed by a clean start, so that every pointer leads to one or past the end.
    reached = followed(found.select("key", "node", F.col("next").cast("int").alias("next")), found.groupBy("key").agg(F.min("node").alias("node")))
    picked = found.filter("fits").join(reached, ["key", "node"], "left_semi")
    return picked.select(*keys, "id", F.col("start").alias("lo"), F.col("end.hi").alias("hi"), (F.col("end.cut") - F.col("at") + 1).cast("long").alias("n"))


def closed_windows(df: DataFrame, keys: list[str], lo: float, hi: float, longest: float, rest: float, seed: int, order: str = "id") -> DataFrame:
    """Windows over a key's intervals that don't overlap (keys, id, lo, hi): from an interval that begins at or after the cursor, of a
    drawn length, widened to whole intervals; one that is too long or reaches back is left out; the cursor moves `rest` past its end.

    What a window is widened to are islands: the one it begins in, and the last one that begins before its drawn end. So a window depends
    on its interval alone, and the windows are a chain of pointers from each to the first that begins at or after its cursor: sorted
    look-ups, followed by doubling. Parts grow in number with the rows; a key's rows are sorted in one task, which spills."""
    df = kept(df.select(*keys, F.col(order).alias("id"), *[F.col(c).cast("double").alias(c) for c in ("start", "stop")]), "intervals")
    parts = _parts(df)
    w = Window.partitionBy(*keys).orderBy("start", "stop", "id")
    reach = F.max("stop").over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.repartition(parts, *keys).withColumn("at", F.row_number().over(w)).withColumn("new", reach.isNull() | (F.col("start") >= reach))
    rows = rows.withColumn("lo", F.max(F.when(F.col("new"), F.col("start"))).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    rows = kept(rows.select(*keys, "at", "id", "lo", "stop", (F.col("start") + drawn_length(F.col("id"), seed, lo, hi)).alias("t")), "windows")
    # An island's intervals all stand at its begin: what has begun before a drawn end reaches as far as their greatest stop.
    begun = rows.select(*keys, F.col("lo").alias("t"), F.lit(1).alias("q"), F.col("stop").alias("hi"))
    asked = rows.select(*keys, "t", F.lit(0).alias("q"), F.lit(None).cast("double").alias("hi"), "at", "id", "lo")
    up = Window.partitionBy(*keys).orderBy("t", "q").rowsBetween(Window.unboundedPreceding, 0)
    ends = begun.unionByName(asked, allowMissingColumns=True).repartition(parts, *keys).withColumn("hi", F.max("hi").over(up)).filter("q = 0").withColumn("hi", F.greatest("t", "hi"))
    fit = kept(ends.filter(F.col("hi") - F.col("lo") <= longest).select(F.struct(*keys).alias("key"), *keys, "at", "id", "lo", "hi"), "fits")
    starts = fit.select("key", F.col("lo").alias("t"), F.lit(1).alias("q"), F.col("at").alias("to"), F.lit(None).cast("int").alias("at"))
    cursors = fit.select("key", (F.col("hi") + rest).alias("t"), F.lit(0).alias("q"), F.lit(None).cast("int").alias("to"), "at")
    down = Window.partitionBy("key").orderBy(F.desc("t"), F.desc("q")).rowsBetween(Window.unboundedPreceding, 0)
    hops = starts.unionByName(cursors).repartition(parts, "key").withColumn("next", F.min("to").over(down)).filter("q = 0").select("key", F.col("at").alias("node"), "next")
    reached = followed(hops, fit.groupBy("key").agg(F.min("at").alias("node"))).withColumnRenamed("node", "at")
    picked = fit.repartition(parts, "key", "at").join(reached.repartition(parts, "key", "at"), ["key", "at"], "left_semi")
    return picked.select(*keys, F.col("id").alias(order), "lo", "hi")


def _last_ends(rows: DataFrame, own: list[str], length: tuple[float, float], most: int = 256) -> DataFrame:
    """own, no, reach: the last end (`stop`) of the intervals that begin from each one's `start` on and before its `until`, a length within bounds away.

    Starts are dealt into bins narrower than the least length, so that each stretch is the rest of its first bin, whole bins, and the begin of its
    last: two sorts in bins, and ends of whole bins, met once for each interval. However dense intervals lie, none meets another. Bins are
    `most` to the greatest length at most; a shorter stretch may end in its first bin, and is joined with the intervals of that bin alone."""
    width = max(0.999 * length[0], length[1] / most, 1e-6)
    rows = rows.withColumns({"bin": F.floor(F.col("start") / width), "to": F.floor(F.col("until") / width)})
    rest = F.max("stop").over(Window.partitionBy(*own, "bin").orderBy(F.desc("start")).rangeBetween(Window.unboundedPreceding, Window.currentRow))
    rows = kept(rows.withColumn("rest", rest), "stretches")
    marks = rows.select(*own, "bin", F.col("start").alias("t"), F.lit(1).alias("q"), F.col("stop").alias("end"), F.lit(None).cast("int").alias("no"))
    marks = marks.unionByName(rows.filter("to > bin").select(*own, F.col("to").alias("bin"), F.col("until").alias("t"), F.lit(0).alias("q"), F.lit(None).cast("double").alias("end"), "no"))
    begun = F.max("end").over(Window.partitionBy(*own, "bin").orderBy("t", "q").rowsBetween(Window.unboundedPreceding, 0))
    begins = marks.withColumn("begun", begun).filter("q = 0").select(*own, "no", "begun")
    whole = rows.groupBy(*own, "bin").agg(F.max("stop").alias("end"))
    steps = F.explode(F.sequence(F.lit(1), F.lit(int(length[1] / width) + 2))).alias("n")
    ahead = whole.select(*own, (F.col("bin")).alias("at"), "end", steps).select(*own, (F.col("at") - F.col("n")).alias("bin"), "at", "end")
    ahead = ahead.join(whole.select(*own, "bin"), [*own, "bin"], "left_semi").groupBy(*own, "bin").agg(F.collect_list(F.struct("at", "end")).alias("ahead"))
    between = F.array_max(F.transform(F.filter("ahead", lambda x: x["at"] < F.col("to")), lambda x: x["end"]))
    far = rows.filter("to > bin").join(begins, [*own, "no"]).join(ahead, [*own, "bin"], "left")
    far = far.select(*own, "no", F.greatest("rest", "begun", between).alias("reach"))
    if length[0] * 0.999 >= width:
        return far
    near, other = rows.filter("to = bin").select(*own, "bin", "no", "start", "until"), rows.select(*own, "bin", F.col("start").alias("begin"), "stop")
    near = near.join(other, [*own, "bin"]).filter((F.col("begin") >= F.col("start")) & (F.col("begin") < F.col("until"))).groupBy(*own, "no").agg(F.max("stop").alias("reach"))
    return far.unionByName(near)


def target_windows(df: DataFrame, keys: list[str], who: str, lead: tuple[float, float], length: tuple[float, float], longest: float, rest: float, seed: int, ends: DataFrame | None = None, order: str = "id") -> DataFrame:
    """Windows around one speaker's intervals (keys, who, id, lo, hi); those of one speaker don't overlap.

    A window opens up to a drawn lead before an interval that begins at or after the cursor, but not before the end of the speaker's last interval
    that had ended, the cursor or 0. It runs a drawn length from the interval's start, and on to the end of the speaker's intervals that
    begin within that length. Longer ones than `longest`, and those that pass their key's end (`ends`: keys, end), are left out; after a window the
    cursor stands `rest` past its end.

    Where a window leads depends on it alone: to the first interval past its cursor that makes a window from any cursor or, within `longest` of
    the cursor, from this one. So windows are a chain of pointers, found by sorted look-ups and followed by doubling."""
    own = [*keys, who]
    draw = lambda what, bounds: drawn_length(F.concat_ws(":", F.lit(what), F.col("id").cast("string")), seed, *bounds)
    rows = df.select(*own, F.col(order).alias("id"), "start", "stop").withColumn("no", F.row_number().over(Window.partitionBy(*own).orderBy("start", "stop", "id")))
    rows = kept(rows.withColumn("drawn", F.col("start") + draw("length", length)).withColumn("open", F.col("start") - draw("lead", lead)), "turns")
    # The speaker's last end at or before each start: one sort of ends and starts.
    marks = rows.select(*own, F.col("stop").alias("t"), F.lit(0).alias("q"), F.col("stop").alias("end"), F.lit(None).cast("int").alias("no")).unionByName(rows.select(*own, F.col("start").alias("t"), F.lit(1).alias("q"), F.lit(None).cast("double").alias("end"), "no"))
    before = F.max("end").over(Window.partitionBy(*own).orderBy("t", "q").rowsBetween(Window.unboundedPreceding, 0))
    ended = marks.withColumn("before", before).filter("q = 1").select(*own, "no", "before")
    reach = _last_ends(rows.select(*own, "no", "start", "stop", F.col("drawn").alias("until")), own, length)
    rows = rows.join(ended, [*own, "no"]).join(reach, [*own, "no"], "left")
    rows = rows.select(*own, "id", "no", "start", F.greatest("open", F.coalesce("before", F.lit(0.0)), F.lit(0.0)).alias("lo"), F.greatest("drawn", F.coalesce("reach", "drawn")).alias("hi"))
    if ends is not None:
        rows = rows.join(ends, keys, "left").withColumn("fits", F.coalesce(F.col("hi") <= F.col("end"), F.lit(True))).drop("end")
    else:
        rows = rows.withColumn("fits", F.lit(True))
    rows = kept(rows.withColumn("cursor", F.col("hi") + rest).withColumn("any", F.col("fits") & (F.col("hi") - F.col("lo") <= longest)), "candidates")
    # From a cursor: the first interval at or after it that fits from any cursor, met by one sort ...
    starts = rows.filter("any").select(*own, F.col("start").alias("t"), F.lit(1).alias("q"), F.col("no").alias("to"), F.lit(None).cast("int").alias("no"))
    cursors = rows.filter("fits").select(*own, F.col("cursor").alias("t"), F.lit(0).alias("q"), F.lit(None).cast("int").alias("to"), "no")
    first = F.min("to").over(Window.partitionBy(*own).orderBy(F.desc("t"), F.desc("q")).rowsBetween(Window.unboundedPreceding, 0))
    later = starts.unionByName(cursors).withColumn("next", first).filter("q = 0").select(*own, "no", "next")
    # ... or one that fits from this cursor alone, which begins and ends within `longest` of it.
    near = rows.filter("fits").select(*own, F.col("no").alias("id"), F.col("cursor").alias("start"), (F.col("cursor") + longest).alias("stop"))
    some = rows.filter("fits and not any").select(*own, F.col("no").alias("id"), "start", "hi", F.greatest("hi", F.col("start") + 1e-9).alias("stop"))
    met = overlap_join(near, some, own, longest).filter((F.col("r_start") >= F.col("l_start")) & (F.col("r_stop") - F.col("l_start") <= longest))
    close = met.groupBy(*own, F.col("l_id").alias("no")).agg(F.min("r_id").alias("close"))
    hops = kept(later.join(close, [*own, "no"], "left").select(F.struct(*own).alias("key"), F.col("no").alias("node"), F.least("next", "close").alias("next")), "hops")
    # The first window has no cursor before it.
    head = rows.filter("any").select(F.struct(*own).alias("key"), "no").groupBy("key").agg(F.min("no").alias("node"))
    reached = kept(followed(hops, head), "reached")
    led = hops.join(reached, ["key", "node"], "left_semi").filter("next is not null").select("key", F.col("next").alias("no"), F.col("node").alias("from"))
    picked = rows.withColumn("key", F.struct(*own)).join(reached.withColumnRenamed("node", "no"), ["key", "no"], "left_semi").join(led, ["key", "no"], "left")
    cursor = rows.select(F.struct(*own).alias("key"), F.col("no").alias("from"), F.col("cursor").alias("since"))
    picked = picked.join(cursor, ["key", "from"], "left")
    return picked.select(*own, "id", F.greatest("lo", F.coalesce("since", "lo")).alias("lo"), "hi")


def window_turns(windows: DataFrame, df: DataFrame, keys: list[str], who: str, width: float) -> DataFrame:
    """window, id, start, stop, clipped: what stands in windows (keys, who, id, lo, hi): the target's intervals that lie inside, whole, and the others', clipped to the edges."""
    spans = windows.select(*keys, "id", who, F.col("lo").alias("start"), F.col("hi").alias("stop"))
    hits = overlap_join(spans, df.select(*keys, "id", who, "start", "stop"), keys, width)
    target = F.col(f"l_{who}") == F.col(f"r_{who}")
    whole = (F.col("r_start") >= F.col("l_start")) & (F.col("r_stop") <= F.col("l_stop"))
    hits = hits.filter(~target | whole)
    return hits.select(F.col("l_id").alias("window"), F.col("r_id").alias("id"), F.greatest("l_start", "r_start").alias("start"), F.least("l_stop", "r_stop").alias("stop"), (~whole).alias("clipped"))
