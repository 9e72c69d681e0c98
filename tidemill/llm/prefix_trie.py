"""The trie of conversation prefixes: one node for each distinct sequence of first turns, with what its subtree holds.

Turns become digests before anything moves, and conversations of equal turns are counted as one sequence. Sequences are
dealt by the digest of their first turn into buckets; in each, applyInPandas builds a trie whose nodes point to their children by digest
and sums it up in postorder, without recursion. A first turn that more rows share than one bucket shall hold is taken off as a node of
its own and its sequences are dealt again by their next turn, and so on until every subtrie fits; the root is always
taken off in this way. Nodes that were taken off get their sums from their children's tops, from the
deepest level up. A sequence that is too long for a bucket and shares no further turn is a chain, summed by windows.

The conversations that end at a node are those of one sequence: their ids are sorted over ranges, joined to pieces side by side,
and hashed piece after piece as they stream by, so that no list of ids is ever held.

Defined cases: rows without a conversation id take no part. Null roles and texts are empty. Null turn numbers come first;
equal ones are ordered by the turn's digest, so that repeated rows are turns each. A conversation without turns belongs to the root
alone. Without conversations there is no node. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemill.llm.common import written

#: Rows of a subtrie that is built in one piece, at most; below LEAST_ROWS nothing is dealt again.
BUCKET_ROWS = 50_000
LEAST_ROWS = 256
PIECE_IDS = 4096
_NODE = "conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, n_leaves long, saved_tokens long, end_conv_id long"
_ROOT = b""


def _numbered(conversations: DataFrame, extra: dict[str, Column], conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    rows = conversations.filter(F.col(conv_col).isNotNull()).select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), F.substring(F.unhex(digest), 1, 16).alias("step"), *[c.alias(n) for n, c in extra.items()])
    return rows.select("conv_id", F.row_number().over(Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "step")).alias("pos"), "step", *extra)


def step_rows(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos from 1, step, chars): every turn as the digest of role and text, and the text's length."""
    chars = F.length(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).cast("long")
    return _numbered(conversations, {"chars": chars}, conv_col, turn_col, role_col, text_col)


def with_shared_heads(steps: DataFrame, block: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Steps and ids of conversations that begin like the first of their block: the first h turns of conversation
    c - c % block (all if fewer, none if absent), then c's own after its first h; h is crc32(c as text) % most."""
    base = F.col("conv_id") - F.col("conv_id") % block
    convs = steps.select("conv_id").distinct().withColumn("base", base).withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % most)
    heads = written(steps.filter((F.col("conv_id") % block == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base"), "heads")
    held = heads.groupBy("base").agg(F.max("pos").alias("held"))
    convs = written(convs.join(held, "base", "left").withColumn("head", F.least("h", F.coalesce("held", F.lit(0)))).select("conv_id", "base", "h", "head"), "conversations")
    own = steps.join(convs, "conv_id").filter("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("head")).cast("int").alias("pos"), "step", "chars")
    taken = convs.join(heads, "base").filter("pos <= head").select("conv_id", F.col("pos").cast("int").alias("pos"), "step", "chars")
    return own.unionByName(taken), convs.select("conv_id")


def _built(pdf: pd.DataFrame) -> pd.DataFrame:
    """The nodes of one bucket's subtries. Rows: rep, pos, key, parent_key, step, chars, n, len."""
    pdf = pdf.sort_values(["rep", "pos"], kind="stable")
    parent: list[int] = []
    kids: list[dict[bytes, int]] = []
    depth: list[int] = []
    chars: list[int] = []
    least: list[int] = []
    count: list[int] = []
    ends: list[int | None] = []
    tops: dict[bytes, int] = {}
    above: dict[int, bytes] = {}
    at, seen = -1, None
    for rep, pos, key, parent_key, step, size, n, length in zip(*(pdf[c].tolist() for c in ("rep", "pos", "key", "parent_key", "step", "chars", "n", "len")), strict=True):
        first = rep != seen
        level, name = (tops, key) if first else (kids[at], step)
        node = level.get(name)
        if node is None:
            node = level[name] = len(parent)
            parent.append(-1 if first else at)
            kids.append({})
            depth.append(pos)
            chars.append(size)
            least.append(rep)
            count.append(0)
            ends.append(None)
            if first:
                above[node] = parent_key
        if pos == length:
            ends[node], count[node] = rep, n
        least[node] = min(least[node], rep)
        at, seen = node, rep
    leaves, saved = [0] * len(parent), [0] * len(parent)
    stack = [(top, iter(kids[top].values())) for top in tops.values()]
    while stack:  # postorder: a node is summed up once its children are
        node, rest = stack[-1]
        child = next(rest, None)
        if child is not None:
            stack.append((child, iter(kids[child].values())))
            continue
        stack.pop()
        leaves[node] = leaves[node] or 1
        saved[node] += (count[node] - 1) * chars[node]
        if (up := parent[node]) >= 0:
            count[up] += count[node]
            leaves[up] += leaves[node]
            saved[up] += saved[node]
    out = pd.DataFrame({"conv_id": least, "depth": depth, "parent_conv_id": [least[p] if p >= 0 else None for p in parent], "parent_key": [above.get(i) for i in range(len(parent))], "n_convs": count, "n_children": [len(k) for k in kids], "n_leaves": leaves, "saved_tokens": saved, "end_conv_id": ends})
    return out.astype({c: "Int64" for c in out.columns if c != "parent_key"})


def _chains(rows: DataFrame, level: int) -> DataFrame:
    """Nodes of sequences that share no turn from here on."""
    below = Window.partitionBy("rep").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, 0)
    top = F.col("pos") == level
    return rows.select(F.col("rep").alias("conv_id"), F.col("pos").cast("long").alias("depth"), F.when(~top, F.col("rep")).alias("parent_conv_id"), F.when(top, F.col("parent_key")).alias("parent_key"), F.col("n").alias("n_convs"), (F.col("pos") < F.col("len")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), ((F.col("n") - 1) * F.sum("chars").over(below)).alias("saved_tokens"), F.when(F.col("pos") == F.col("len"), F.col("rep")).alias("end_conv_id"))


def _chain_key(key: Column, step: Column) -> Column:
    return F.unhex(F.md5(F.concat(key, step)))


def _sequences(steps: DataFrame, convs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Each conversation with the digest of its sequence (x, y, len), and the distinct sequences with smallest id and number."""
    digest = steps.groupBy("conv_id").agg(F.bit_xor(F.xxhash64(F.lit("x"), "pos", "step")).alias("x"), F.bit_xor(F.xxhash64(F.lit("y"), "step", "pos")).alias("y"), F.count("*").alias("len"))
    zero = F.lit(0).cast("long")
    members = written(convs.join(digest, "conv_id", "left").select("conv_id", *[F.coalesce(c, zero).alias(c) for c in ("x", "y", "len")]), "members")
    return members, written(members.groupBy("x", "y", "len").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n")), "sequences")


def _end_digests(members: DataFrame, sequences: DataFrame) -> DataFrame:
    """(end_conv_id, ends_sha256): the digest of each sequence's ids, ascending and comma-joined."""
    key = ["x", "y", "len"]

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows: list[tuple[int, int, int, int, list[str]]] = []
            for x, y, n, conv in zip(*(pdf[c].tolist() for c in (*key, "conv_id")), strict=True):
                if not rows or rows[-1][:3] != (x, y, n) or len(rows[-1][4]) == PIECE_IDS:
                    rows.append((x, y, n, conv, []))
                rows[-1][4].append(str(conv))
            yield pd.DataFrame([(*r[:4], ",".join(r[4])) for r in rows], columns=[*key, "first", "ids"])

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, state = None, None
        for pdf in batches:
            done = []
            for x, y, n, ids in zip(*(pdf[c].tolist() for c in (*key, "ids")), strict=True):
                if (x, y, n) != now:
                    if now is not None:
                        done.append((*now, state.hexdigest()))
                    now, state = (x, y, n), hashlib.sha256(ids.encode())
                else:
                    state.update(f",{ids}".encode())
            yield pd.DataFrame(done, columns=[*key, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, state.hexdigest())], columns=[*key, "ends_sha256"])

    cut = members.select(*key, "conv_id").repartitionByRange(*key, "conv_id").sortWithinPartitions(*key, "conv_id").mapInPandas(pieces, "x long, y long, len long, first long, ids string")
    digests = cut.repartition(*key).sortWithinPartitions(*key, "first").mapInPandas(hashed, "x long, y long, len long, ends_sha256 string")
    return sequences.join(digests, key).select(F.col("rep").alias("end_conv_id"), "ends_sha256")


def prefix_trie(steps: DataFrame, convs: DataFrame, bucket_rows: int = BUCKET_ROWS, least_rows: int = LEAST_ROWS) -> DataFrame:
    """conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, end_conv_id (smallest
    member that ends here), ends_sha256 of every node, from rows of `step_rows` and the ids of all conversations."""
    members, sequences = _sequences(steps, convs)
    partitions = int(steps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rest = steps.join(sequences.select("rep", "n", "len"), F.col("conv_id") == F.col("rep")).select("rep", "pos", "step", "chars", "n", "len", F.lit(_ROOT).alias("key"))
    rest = written(rest, "steps")
    total = rest.count()
    most = max(least_rows, min(bucket_rows, total // (2 * partitions)))
    root = sequences.filter("len = 0").select(F.lit(_ROOT).alias("key"), F.lit(None).cast("binary").alias("parent_key"), F.lit(0).cast("long").alias("chars"), F.col("rep").alias("end_conv_id"), F.col("n").alias("end_n"))
    taken_off, nodes, level = [root], [], 0
    while True:
        level += 1  # the depth of this round's tops
        heads = rest.filter(F.col("pos") == level).select("rep", F.col("key").alias("parent_key"), _chain_key(F.col("key"), F.col("step")).alias("key"))
        rows = written(rest.drop("key").join(heads, "rep"), "dealt")
        counts = rows.groupBy("key").agg(F.count("*").alias("n_rows"), F.count_if(F.col("pos") == level).alias("n_sequences")).filter(F.col("n_rows") > most)
        large = written(counts.select("key", (F.col("n_sequences") > 1).alias("split")), "large")
        rows = rows.join(large, "key", "left")
        buckets = max(4 * partitions, -(-total // bucket_rows))
        small = rows.filter("split is null").drop("split").withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets)))
        nodes.append(written(small.groupBy("bucket").applyInPandas(_built, _NODE), "nodes"))
        if large.isEmpty():
            break
        nodes.append(_chains(rows.filter("not split"), level))
        split = rows.filter("split")
        ended = (F.col("pos") == level) & (F.col("len") == level)
        off = split.filter(F.col("pos") == level).groupBy("key").agg(F.first("parent_key").alias("parent_key"), F.first("chars").alias("chars"), F.max(F.when(ended, F.col("rep"))).alias("end_conv_id"), F.max(F.when(ended, F.col("n"))).alias("end_n"))
        taken_off.append(written(off, "taken-off"))
        rest = written(split.filter(F.col("pos") > level).drop("split", "parent_key"), "rest")
    everything, owners = nodes[0], None
    for n in nodes[1:]:
        everything = everything.unionByName(n)
    for depth in range(len(taken_off) - 1, -1, -1):
        zero, one = F.lit(0).cast("long"), F.lit(1).cast("long")
        children = everything.filter(F.col("parent_key").isNotNull() & (F.col("depth") == depth + 1)).select(F.col("parent_key").alias("key"), "conv_id", "n_convs", one.alias("n_children"), "n_leaves", "saved_tokens")
        # The sequence that ends at the node counts beside its children.
        own = taken_off[depth].select("key", "parent_key", "chars", "end_conv_id", F.col("end_conv_id").alias("conv_id"), F.coalesce("end_n", zero).alias("n_convs"))
        both = children.unionByName(own, allowMissingColumns=True).groupBy("key")
        sums = both.agg(F.max("parent_key").alias("parent_key"), F.max("chars").alias("chars"), F.max("end_conv_id").alias("end_conv_id"), F.min("conv_id").alias("conv_id"), *[F.coalesce(F.sum(c), zero).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")])
        saved = F.col("saved_tokens") + (F.col("n_convs") - 1) * F.coalesce("chars", zero)
        top = written(sums.select("key", "parent_key", "conv_id", F.lit(depth).cast("long").alias("depth"), "n_convs", "n_children", F.greatest("n_leaves", one).alias("n_leaves"), saved.alias("saved_tokens"), "end_conv_id"), "summed")
        everything = everything.unionByName(top.drop("key"), allowMissingColumns=True)
        own = top.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("own"))
        owners = own if owners is None else owners.unionByName(own)
    # The tops of each round get their parent's conversation.
    tops = everything.filter("parent_key is not null").drop("parent_conv_id").join(owners, "parent_key", "left").withColumnRenamed("own", "parent_conv_id").drop("parent_key")
    everything = everything.filter("parent_key is null").drop("parent_key").unionByName(tops)
    ends = everything.filter("end_conv_id is not null").join(_end_digests(members, sequences), "end_conv_id")
    none = everything.filter("end_conv_id is null").withColumn("ends_sha256", F.sha2(F.lit(b""), 256))
    return ends.unionByName(none)


def node_texts(nodes: DataFrame, conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """Nodes of a trie over conversations as they are, with the role and text of their last turn (null at the root)."""
    extra = {c: F.coalesce(F.col(name).cast("string"), F.lit("")) for c, name in (("role", role_col), ("text", text_col))}
    rows = _numbered(conversations, extra, conv_col, turn_col, role_col, text_col)
    return nodes.join(rows.select("conv_id", F.col("pos").cast("long").alias("depth"), "role", "text"), ["conv_id", "depth"], "left")
