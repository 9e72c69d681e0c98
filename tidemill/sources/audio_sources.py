"""Audio sources of nested cuts and recordings, with tar and dd commands read as columns and never run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemill.session import kept

# Shell words: runs of plain characters, quoted parts and escaped characters.
_PIECE = r"""[^ \t\r\n'"\\]+|'[^']*'|"(?:\\(?s:.)|[^"\\])*"|\\(?s:.)"""


def shell_words(command: Column) -> tuple[Column, Column]:
    """The words of a command as a shell splits them, and whether all of it could be read (no open quote, no escape at the end)."""

    def bare(piece: Column) -> Column:
        inner = F.substring(piece, F.lit(2), F.length(piece) - 2)
        double = F.regexp_replace(inner, r'\\(["\\])', "$1")
        return F.when(piece.startswith("'"), inner).when(piece.startswith('"'), double).otherwise(F.regexp_replace(piece, r"\\((?s:.))", "$1"))

    words = F.regexp_extract_all(command, F.lit(f"((?:{_PIECE})+)"), F.lit(1))
    pieces = lambda word: F.regexp_extract_all(word, F.lit(f"({_PIECE})"), F.lit(1))
    rest = F.regexp_replace(command, f"(?:{_PIECE})+", "")
    return F.transform(words, lambda w: F.array_join(F.transform(pieces(w), bare), "")), ~rest.rlike(r"[^ \t\r\n]")


def rooted(path: Column, root: str) -> Column:
    """An absolute path without `.` and `..` (links are not followed); null for what is no file path: empty, or with `://`."""
    full = F.when(path.startswith("/"), path).otherwise(F.concat(F.lit(root + "/"), path))
    steps = F.filter(F.split(full, "/"), lambda x: ~x.isin("", "."))
    up = lambda done, x: F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))).otherwise(F.concat(done, F.array(x)))
    done = F.aggregate(steps, F.array().cast("array<string>"), up)
    return F.when((path != "") & ~path.contains("://"), F.concat(F.lit("/"), F.array_join(done, "/")))


def parsed_sources(df: DataFrame, root: str, commands: bool = True) -> DataFrame:
    """Audio sources (columns type and source) with kind (file, tar, dd), path, member (of a tar), skip and size (of a dd) and problem.

    Commands are `tar -xOf <archive> <member>` or `dd if=<file> iflag=skip_bytes,count_bytes skip=<n> count=<n> status=none`, after
    `timeout --signal=TERM --kill-after=<n>s <n>s` or without; anything else is a problem. A problem that a row has already stays."""
    # The words stand in columns of their own, so that the rules below don't repeat how they are split.
    kind, text = F.col("type"), F.col("source")
    found, whole = shell_words(text)
    df = df.withColumns({"__words": F.when(kind == "command", found), "__whole": whole})
    words, whole = F.col("__words"), F.col("__whole")
    at = lambda w, i: F.coalesce(F.get(w, F.lit(i)), F.lit(""))
    timed = at(words, 0) == "timeout"
    good_time = (F.size(words) >= 5) & (at(words, 1) == "--signal=TERM") & at(words, 2).rlike(r"\A--kill-after=[0-9]+s\z") & at(words, 3).rlike(r"\A[0-9]+s\z")
    df = df.withColumn("__timed", timed & ~good_time).withColumn("__w", F.when(timed & good_time, F.slice(words, 5, 100)).otherwise(words))
    w, mistimed = F.col("__w"), F.col("__timed")
    tar = (F.size(w) == 4) & (at(w, 0) == "tar") & (at(w, 1) == "-xOf")
    dd = (F.size(w) == 6) & (at(w, 0) == "dd") & at(w, 1).startswith("if=") & (at(w, 2) == "iflag=skip_bytes,count_bytes") & at(w, 3).rlike(r"\Askip=[0-9]+\z") & at(w, 4).rlike(r"\Acount=[0-9]+\z") & (at(w, 5) == "status=none")
    number = lambda word, n: F.substring(word, F.lit(n), F.length(word)).try_cast("long")
    skip, size = number(at(w, 3), 6), number(at(w, 4), 7)
    command = kind == "command"
    df = df.withColumn("__file", F.when(kind == "file", text).when(tar, at(w, 2)).otherwise(F.substring(at(w, 1), F.lit(4), F.length(at(w, 1)))))
    df = df.withColumn("__path", rooted(F.col("__file"), root))
    path = F.col("__path")
    problem = (
        F.when(F.col("problem").isNotNull(), F.col("problem"))
        .when(text.isNull() | kind.isNull() | ~kind.isin("file", *(["command"] if commands else [])), "unsupported source type")
        .when(command & ~whole, "open quote or escape")
        .when(command & mistimed, "unsupported timeout")
        .when(command & tar & (at(w, 2).startswith("-") | at(w, 3).startswith("-")), "option for a path")
        .when(command & ~tar & ~dd, "unsupported command")
        .when(command & dd & (skip.isNull() | size.isNull() | (size <= 0)), "unusable range")
        .when(path.isNull(), "unsupported path")
    )
    df = df.withColumn("problem", problem)
    ok = F.col("problem").isNull()
    name = F.when(kind == "file", "file").when(tar, "tar").otherwise("dd")
    is_tar, is_dd = ok & command & tar, ok & command & dd
    out = {"kind": F.when(ok, name), "path": F.when(ok, path), "member": F.when(is_tar, at(w, 3)), "skip": F.when(is_dd, skip), "size": F.when(is_dd, size)}
    return df.withColumns(out).drop("__words", "__whole", "__timed", "__w", "__file", "__path")


def expanded_sources(items: DataFrame, id: str, item: str, root: str, commands: bool = True, depth: int = 16) -> DataFrame:
    """id, place, kind, path, member, skip, size, problem: the audio sources of manifest items (a JSON text each), in order of `place`.

    Mixed cuts hold tracks of cuts, cuts a recording, recordings sources and impulse responses, which are recordings again; padding
    holds nothing. One level is opened in each round, for all items at once, until none is left. What can't be read gives a row with
    its problem: text that is no JSON, an unknown or empty item, one nested deeper than `depth`. Levels are rows, so
    that an item of very many tracks is spread like any others."""
    get = lambda v, path, kind: F.try_variant_get(v, path, kind)
    level = kept(items.select(F.col(id).alias("id"), F.array().cast("array<int>").alias("place"), F.try_parse_json(F.col(item)).alias("v")), "items")
    found = []
    for step in range(depth + 1):
        v = F.col("v")
        kind, tracks, recording = get(v, "$.type", "string"), get(v, "$.tracks", "array<variant>"), get(v, "$.recording", "variant")
        sources, transforms = get(v, "$.sources", "array<variant>"), F.coalesce(get(v, "$.transforms", "array<variant>"), F.array().cast("array<variant>"))
        cut, plain = kind.isin("MonoCut", "MultiCut"), kind.isNull() & sources.isNotNull() & get(v, "$.sampling_rate", "variant").isNotNull()
        problem = (
            F.when(v.isNull(), "not JSON")
            .when((kind == "MixedCut") & tracks.isNull(), "cut without tracks")
            .when(cut & recording.isNull(), "cut without recording")
            .when(plain & (F.size(sources) == 0), "recording without sources")
            .when(~F.coalesce(kind.isin("MixedCut", "PaddingCut", "MonoCut", "MultiCut"), F.lit(False)) & ~plain, "unsupported item")
        )
        rooms = F.filter(transforms, lambda t: (get(t, "$.name", "string") == "ReverbWithImpulseResponse") & get(t, "$.kwargs.rir", "variant").isNotNull() & ~F.is_variant_null(get(t, "$.kwargs.rir", "variant")))
        none = F.array().cast("array<variant>")
        inner = F.when(problem.isNotNull(), none).when(kind == "MixedCut", F.transform(tracks, lambda t: get(t, "$.cut", "variant"))).when(cut, F.array(recording)).when(plain, F.transform(rooms, lambda t: get(t, "$.kwargs.rir", "variant"))).otherwise(none)
        rows = level.select("id", "place", problem.alias("problem"), F.when(plain & problem.isNull(), sources).otherwise(none).alias("sources"), inner.alias("inner"))
        empty = [F.lit(None).cast("string").alias(c) for c in ("type", "source")]
        found.append(rows.filter("problem is not null").select("id", "place", *empty, "problem"))
        each = rows.select("id", "place", F.posexplode("sources").alias("i", "s"))
        # Sources stand before the rooms of their recording.
        found.append(each.select("id", F.concat("place", F.array(F.lit(0), F.col("i"))).alias("place"), get(F.col("s"), "$.type", "string").alias("type"), get(F.col("s"), "$.source", "string").alias("source"), F.lit(None).cast("string").alias("problem")))
        level = kept(rows.filter(F.size("inner") > 0).select("id", "place", F.posexplode("inner").alias("i", "v")).select("id", F.concat("place", F.array(F.lit(1), F.col("i"))).alias("place"), "v"), "items")
        if not level.limit(1).count():
            break
    else:
        found.append(level.select("id", "place", *empty, F.lit("nested too deeply").alias("problem")))
    sources = kept(reduce(DataFrame.unionByName, found), "sources")
    return parsed_sources(sources, root, commands).select("id", "place", "kind", "path", "member", "skip", "size", "problem")
