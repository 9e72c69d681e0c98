"""Sources of nested items and the words of commands against plain loops."""

from __future__ import annotations

import json
import random
import shlex

from pyspark.sql import functions as F

from tidemill.sources import audio_sources


def recording(*sources, rooms=()):
    return {"sources": list(sources), "sampling_rate": 16000, "transforms": [{"name": "Speed"}, *({"name": "ReverbWithImpulseResponse", "kwargs": {"rir": r}} for r in rooms)]}


def file(path):
    return {"type": "file", "source": path}


def command(text):
    return {"type": "command", "source": text}


def test_words_are_the_shells(spark):
    draw = random.Random(4)
    rows = [(i, "".join(draw.choices("ab'\"\\ \t\n#$", k=draw.randrange(0, 14)))) for i in range(3000)]
    words, whole = audio_sources.shell_words(F.col("c"))
    for r in spark.createDataFrame(rows, "i int, c string").select("c", words.alias("w"), whole.alias("ok")).collect():
        try:
            want = shlex.split(r.c)
        except ValueError:
            want = None
        assert (r.w if r.ok else None) == want, r.c


def test_sources_in_order(spark):
    dd = "dd if=/x/../a.bin iflag=skip_bytes,count_bytes skip={} count={} status=none"
    room = recording(file("/room.wav"))
    mono = {"type": "MonoCut", "recording": recording(file("a/./b.wav"), command("tar -xOf 'my tar.tar' x\\ y.wav"), rooms=[room, None])}
    items = {
        1: recording(file("/a.wav")),
        2: {"type": "MixedCut", "tracks": [{"cut": mono}, {"cut": {"type": "PaddingCut"}}, {"cut": {"type": "MixedCut", "tracks": [{"cut": {"type": "MultiCut", "recording": room}}]}}]},
        3: recording(command(dd.format(5, 9)), command("timeout --signal=TERM --kill-after=5s 60s " + dd.format(0, 1)), command(dd.format(5, 0)), command(dd.format(5, 10**20))),
        4: recording(command("timeout 60s tar -xOf a b"), command("tar -xOf -a b"), command("rm -rf /"), command("tar -xOf 'a b"), file("s3://a"), file(""), {"type": "url", "source": "x"}),
        5: {"type": "MonoCut"},
        6: recording(),
        7: {"type": "Other"},
        8: [],
        9: {"type": "MixedCut"},
        10: {"type": "PaddingCut"},
    }
    deep = recording(file("/deep.wav"))
    for _ in range(6):
        deep = {"type": "MixedCut", "tracks": [{"cut": deep}]}
    rows = [(i, json.dumps(v), "x") for i, v in items.items()] + [(11, "{", "x"), (12, None, "x"), (13, json.dumps(deep), "x")]
    df = spark.createDataFrame(rows, "k long, j string, place string")
    out = audio_sources.expanded_sources(df, "k", "j", "/root", depth=5).collect()
    got = {i: [tuple(r)[2:] for r in sorted((r for r in out if r.id == i), key=lambda r: r.place)] for i in range(1, 14)}
    good = lambda kind, path, member=None, skip=None, size=None: (kind, path, member, skip, size, None)
    bad = lambda what: (None, None, None, None, None, what)
    assert got[1] == [good("file", "/a.wav")]
    assert got[2] == [good("file", "/root/a/b.wav"), good("tar", "/root/my tar.tar", "x y.wav"), good("file", "/room.wav"), good("file", "/room.wav")]
    assert got[3] == [good("dd", "/a.bin", None, 5, 9), good("dd", "/a.bin", None, 0, 1), bad("unusable range"), bad("unusable range")]
    assert got[4] == [bad(x) for x in ("unsupported timeout", "option for a path", "unsupported command", "open quote or escape", "unsupported path", "unsupported path", "unsupported source type")]
    for i, what in ((5, "cut without recording"), (6, "recording without sources"), (7, "unsupported item"), (8, "unsupported item"), (9, "cut without tracks"), (11, "not JSON"), (12, "not JSON"), (13, "nested too deeply")):
        assert got[i] == [bad(what)], i
    assert got[10] == []
    assert audio_sources.expanded_sources(df.limit(0), "k", "j", "/root").count() == 0
