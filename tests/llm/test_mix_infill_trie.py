"""Mixing, fill-in-middle and the prefix trie against plain versions, with nulls, empties, ties, repeats, long rows and hot groups."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tidemill.llm import infill, mixing, prefix_trie

DOCS = "doc_id long, text string, source string, size string, key int, target string"
BLANK = " \t\n\v\f\r"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return "".join(draw.choice("river stone Été 日本 🙂 lamp".split()) + draw.choice([" ", "  ", "\n", "\t", ". ", " "]) for _ in range(n))


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, s, "clash", 1, "clash") for d, t, s in rows], DOCS)


def plain_targets(sizes, weights, share, most):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    budget, full = share * sum(sizes.values()), set()
    while True:
        left, rest = budget - sum(most * sizes[s] for s in full), sum(w[s] for s in names if s not in full)
        out = {s: most * sizes[s] if s in full else w[s] * left / rest for s in names}
        over = {s for s in names if s not in full and out[s] > most * sizes[s]}
        if not over:
            return out
        full |= over


def plain_mix(rows, weights=(3, 1, 2), share=1.5, most=2):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    sizes = {}
    for _, t, s in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    goal, out = plain_targets(sizes, weights, share, most), []
    for source, target in goal.items():
        own = [(hashlib.md5(f"mix:{'' if d is None else d}:{t or ''}".encode()).hexdigest()[:15], d is not None, d or 0, size(t), d) for d, t, s in rows if s == source]
        at = 0
        for *_, n, d in sorted(own, key=lambda r: r[:4]):
            epochs, cut = divmod(int(target), sizes[source]) if sizes[source] else (0, 0)
            out.append((d, n, sizes[source], round(target, 6), epochs * n + max(0, min(n, cut - at))))
            at += n
    return sorted(out, key=str)


def mixed(df):
    return sorted(((r.doc_id, r["size"], r.source_size, round(r.target, 6), r.taken) for r in df.collect()), key=str)


MIX = [(i, prose(i, i % 37), f"s{i % 5}") for i in range(200)] + [(None, prose(7, 30), None), (None, prose(7, 30), None), (None, None, None), (3, "", "s1"), (3, prose(3, 3), "s1"), (5, BLANK, "é"), (6, "a\x1cb", ""), (9, prose(9, 4000), "Z")] + [(77, prose(1, 9), "s0")] * 150


def test_mixing(spark):
    got = mixing.mix(docs_of(spark, MIX))
    assert mixed(got) == plain_mix(MIX) and mixed(got) == mixed(mixing.mix(docs_of(spark, MIX[::-1]).repartition(3)))
    by_source = {}
    for d, n, source_size, target, taken in mixed(got):
        assert taken <= 2 * n
        by_source.setdefault((source_size, target), []).append(taken)
    assert all(sum(t) == int(target) for (_, target), t in by_source.items())
    assert mixing.mix(docs_of(spark, [])).count() == 0
    assert [r.taken for r in mixing.mix(docs_of(spark, [(1, None, "a"), (2, " ", None)])).collect()] == [0, 0]
    other = {"weights": (1, 5), "share": 0.4, "most": 3}
    assert mixed(mixing.mix(docs_of(spark, MIX), **other)) == plain_mix(MIX, **other)


def test_copies_are_dealt_over_tasks(spark, monkeypatch):
    monkeypatch.setattr(mixing, "COPY_ROWS", 10)
    assert mixed(mixing.mix(docs_of(spark, MIX))) == plain_mix(MIX)


def test_mixed_texts_hold_what_the_mix_takes(spark):
    texts = mixing.mixed_texts(docs_of(spark, MIX)).withColumn("n", mixing.words(F.col("text"))).collect()
    assert all(r.n == r.n_words and (r.text in [t for d, t, s in MIX if d == r.doc_id and s == r.source] or any((t or "").startswith(r.text) for d, t, _ in MIX if d == r.doc_id)) for r in texts)
    assert sum(r.n for r in texts) == sum(r[4] for r in plain_mix(MIX))


def test_many_sources_are_ranked_over_ranges(spark):
    rows = [(i, "w " * (i % 9), f"source {i % 700}") for i in range(3000)]
    assert mixed(mixing.mix(docs_of(spark, rows))) == plain_mix(rows)


def plain_infill(d, text, seed=7, rate=100, spm_rate=50):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    h = [int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return d, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    spm = h[3] % 100 < spm_rate
    return d, len(units), "spm" if spm else "psm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}"


FILL = [(i, prose(i, i % 60)) for i in range(300)] + [(None, prose(3, 20)), (None, None), (1, ""), (2, "\n"), (3, "\n\n\n"), (4, "no line"), (5, "x\n<P>"), (6, "<S"), (7, "a\r\nb c\x0bd\n"), (8, "é🙂" * 50 + "<M>" + "y" * 90), (9, "1234567<S>9\nb"), (10, "x" * 500), (10, "x" * 500), (11, "ab\n" * 400)]


@pytest.mark.parametrize("chunk", [infill.CHUNK, 40, 9, 7, 3])
def test_infill(spark, chunk):
    """However small the chunks: marks and boundaries across their ends are found, ranks meet their owners."""
    got = infill.fill_in_middle(docs_of(spark, [(d, t, "s") for d, t in FILL]), chunk=chunk)
    assert sorted(map(tuple, got.collect()), key=str) == sorted((plain_infill(d, t) for d, t in FILL), key=str)
    back = got.select("doc_id", infill.restore(F.col("output"), F.col("form")).alias("text"))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(((d, t or "") for d, t in FILL), key=str)


def test_infill_rates_and_very_long_texts(spark):
    rows = [(1, "line é\n" * 400_000), (2, "z" * 3_000_000), (3, prose(4, 200_000)), (3, prose(4, 200_000)), (4, "short\ntext")]
    got = infill.fill_in_middle(docs_of(spark, [(d, t, "s") for d, t in rows]), rate=70, spm_rate=20)
    digest = lambda r: (*r[:5], hashlib.sha256(r[5].encode()).hexdigest())
    assert sorted((tuple(r)[:6] for r in infill.digest_columns(got).collect()), key=str) == sorted((digest(plain_infill(d, t, rate=70, spm_rate=20)) for d, t in rows), key=str)
    assert infill.fill_in_middle(docs_of(spark, [])).count() == 0


def plain_trie(convs):
    """Nodes of conversations, a dict id -> list of (role, text)."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        kids = lambda q: sum(len(p) == len(q) + 1 and p[: len(q)] == q for p in members)
        ended = ",".join(str(c) for c in sorted(c for c in own if len(convs[c]) == len(path)))
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), kids(path), sum(not kids(p) for p in below), saved, hashlib.sha256(ended.encode()).hexdigest()))
    return sorted(out, key=str)


def conversations(seed=3):
    draw = random.Random(seed)
    words = ["hi", "Été", "", "日本語", "ok then", "hi "]
    rows = []
    for c in range(-3, 260):
        for turn in range(draw.choice([0, 1, 2, 3, 5, 8])):
            rows.append((c, turn, draw.choice(["user", "bot", None]) if turn else "user", "hello" if turn == 0 and c % 3 else draw.choice(words)))
    rows += [(300 + i, t, "user", f"same {t}") for i in range(60) for t in range(4)]
    rows += [(400, t, "user", f"long {min(t, 4)}") for t in range(300)] + [(401, t, "user", f"long {min(t, 3)}") for t in range(280)]
    rows += [(500, None, None, None), (500, None, "a", None), (500, 2, "a", "b"), (500, 2, "a", "b"), (None, 1, "user", "no conversation"), ((1 << 53) + 1, 0, "user", "hello")]
    return rows


SCHEMA = "conv_id long, turn long, role string, text string"


def trie_of(df, **options):
    steps = df if "step" in df.columns else prefix_trie.step_rows(df)
    nodes = prefix_trie.prefix_trie(steps, steps.select("conv_id").distinct(), **options)
    return nodes, sorted((tuple(r) for r in nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)


def as_dict(rows):
    key = lambda r: (r[1] is not None, r[1] or 0, hashlib.sha256(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).digest())
    out = {}
    for r in sorted((r for r in rows if r[0] is not None), key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


@pytest.mark.parametrize("options", [{}, {"bucket_rows": 60, "least_rows": 20}, {"bucket_rows": 1, "least_rows": 1}])
def test_trie(spark, options):
    """Whole subtries in buckets, hot first turns dealt again, and (with room for one row) every node taken off or in a chain."""
    rows = conversations() if options.get("bucket_rows") != 1 else [r for r in conversations() if r[0] is not None and r[0] < 20]
    nodes, got = trie_of(spark.createDataFrame(rows, SCHEMA).withColumn("step", F.lit("clash")).drop("step").withColumn("chars", F.lit("clash")), **options)
    assert got == plain_trie(as_dict(rows))
    if not options:
        texts = {(r.conv_id, r.depth): (r.role, r.text) for r in prefix_trie.node_texts(nodes, spark.createDataFrame(rows, SCHEMA)).collect()}
        want = as_dict(rows)
        assert all(v == (want[c][d - 1] if d else (None, None)) for (c, d), v in texts.items())


def test_trie_with_shared_heads(spark):
    rows = conversations(4)
    steps, convs = prefix_trie.with_shared_heads(prefix_trie.step_rows(spark.createDataFrame(rows, SCHEMA)))
    nodes = prefix_trie.prefix_trie(steps, convs, bucket_rows=100, least_rows=30)
    own, want = as_dict(rows), {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        want[c] = own.get(base, [])[:h] + turns[h:]
    got = sorted((tuple(r) for r in nodes.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256").collect()), key=str)
    assert got == plain_trie(want)


def test_trie_of_nothing(spark):
    assert trie_of(spark.createDataFrame([], SCHEMA))[1] == []
    assert trie_of(spark.createDataFrame([(None, 1, "a", "b")], SCHEMA))[1] == []


def test_long_lists_of_ends_are_hashed_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "one" if c % 5 else "two") for c in range(-40, 400)]
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    assert trie_of(spark.createDataFrame(rows, SCHEMA))[1] == plain_trie(as_dict(rows))
