"""Decisions carried over to other spellings, against a plain map of places."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from tidemill.functions import transfer


def plain_map(source, target):
    keep = lambda t: [(i, c.lower()) for i, c in enumerate(t) if c.isalnum()]
    a, b = keep(source), keep(target)
    return {i: j for (i, _), (j, _) in zip(a, b, strict=True)} if [c for _, c in a] == [c for _, c in b] else None


def respelt(draw, text):
    out = []
    for c in text:
        if c.isalnum():
            out.append(draw.choice([c, c, c.upper() if len(c.upper()) == 1 and c.upper().lower() == c.lower() else c]))
        if draw.random() < 0.3:
            out.append(draw.choice(" ,.!，。 \n"))
    return "".join(out)


def test_places_and_spans_of_long_texts():
    draw = random.Random(4)
    for n in (0, 1, 50, 20_000):
        source = "".join(draw.choices("ab1é日 ,.", k=n))
        target = respelt(draw, source)
        to, want = transfer.Alignment(source, target), plain_map(source, target)
        assert to.fits and want is not None
        for _ in range(200):
            i = draw.randrange(n + 1)
            j = min(n, i + draw.randrange(30))
            assert to.place(i) == want.get(i)
            inside = [want[k] for k in range(i, j) if k in want]
            assert to.span(i, j) == ((inside[0], inside[-1] + 1) if inside else None)
    assert not transfer.Alignment("abc", "abd").fits and not transfer.Alignment("ab", "a b c").fits and transfer.Alignment("", " ,").fits


ROWS = [
    # source, target, decision, corrected, edits, quotes, reasons, then what is wanted
    ("the cat, sat", "The cat sat!", "corrected", "the bat, sit", [4, 10], ["cat, sat", "none"], ["r"], ("corrected", "The bat sit!", [4, 9], ["cat sat", "none"], ["r"])),
    ("the cat", "the dog", "corrected", "the bat", [4], ["cat"], ["r"], ("quarantine", None, [], ["cat"], ["transfer_text_differs"])),
    ("the cat", "the dog", "quarantine", None, [], [], ["r"], ("quarantine", None, [], [], ["r"])),
    ("the cat", "the dog", "not_hit", None, [], [], [], ("not_hit", None, [], [], [])),
    ("the cat", "the dog", "consistent", None, [], ["cat"], ["r"], ("unchanged", None, [], ["cat"], ["transfer_text_differs", "r"])),
    ("a, b", "a b", "corrected", "a; b", [1], [], [], ("quarantine", None, [], [], ["transfer_text_differs"])),
    ("一二，三", "一二三", "unchanged", None, [], ["二，三"], ["x"], ("unchanged", None, [], ["二三"], ["x"])),
    ("a b", "a b", "corrected", "x b", [0], ["x b"], [], ("corrected", "x b", [0], ["a b"], [])),
    (None, None, "not_hit", None, None, None, None, ("not_hit", None, [], [], [])),
]


def test_decisions_are_carried_over(spark):
    schema = "source string, target string, decision string, corrected string, edits array<int>, quotes array<string>, reasons array<string>, n int"
    df = spark.createDataFrame([(*r[:7], i) for i, r in enumerate(ROWS)], schema)
    cols = [F.col(c) for c in ("source", "target", "decision", "corrected", "edits", "quotes", "reasons")]
    got = {r.n: tuple(r.x) for r in df.select("n", transfer.transferred(*cols).alias("x")).collect()}
    assert got == {i: r[7] for i, r in enumerate(ROWS)}
    assert df.limit(0).select(transfer.transferred(*cols)).count() == 0
