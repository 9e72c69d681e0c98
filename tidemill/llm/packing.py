"""Packing documents into token sequences: first-fit decreasing with a tournament tree, in randomised groups.

Every document is tokenised and closed by one end token. Documents longer than a sequence are cut into full
sequences and a remainder. Pieces are dealt by a hash of their row and place into groups of about GROUP_PIECES pieces,
so that neither equal rows nor one long document crowd a group; in each group, independently, first-fit decreasing puts every piece into the first sequence with room, found in a
tournament tree that holds the largest free room below each node. Only (id, start, length, checksum) reach the groups;
token ids stay where they were made. A sequence is padded to the capacity unless its length is a power of two.

Tokens: a text is cut before single blanks between visible characters. The tokenizer's own first split always begins a
new piece there, so that each segment's ids are independent of its neighbours and can be kept in a cache; texts
that hold one of the tokenizer's special strings are given to it whole. The cache is bounded by bytes and keeps no long segments.

Defined cases: ids are longs. Null and empty texts are one end token. Documents with equal or null ids are packed each for itself
(pieces carry the id as it is). Empty tables give no rows. Piece order within a sequence is by length, descending.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from pathlib import Path

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemill.llm.common import written

CAPACITY = 1024
GROUP_PIECES = 8192
#: What a task's cache of segments may hold before it is emptied, what an entry takes besides its characters and ids, and the
#: characters of the longest segment that is kept.
CACHE_BYTES = 160 << 20
ENTRY_BYTES = 200
CACHE_CHARS = 64
#: Characters of the documents that are encoded together.
BATCH_CHARS = 1 << 20
_PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, draw long"


#: Fixed value: the split of byte-level tokenizers.
_BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ODD = re.compile(r"\s | \s|\x00")
_TAIL = re.compile(r"( ?[^\W_]+)([.,;:!?]+)")


def ranked_encoder(tokenizer_file: str):
    """A faster encoder with the same ids, where the file is a byte-level tokenizer whose ids are in merge order; else None."""
    import tiktoken

    spec = json.loads(Path(tokenizer_file).read_text())
    model, split = spec["model"], spec.get("pre_tokenizer") or {}
    if model.get("type") != "BPE" or spec.get("normalizer") or split.get("type") != "ByteLevel" or split.get("add_prefix_space") or model.get("ignore_merges"):
        return None
    vocab = model["vocab"]
    merged = ["".join(m) if isinstance(m, list) else m.replace(" ", "", 1) for m in model["merges"]]
    if any(vocab.get(t) != 256 + i for i, t in enumerate(merged)):
        return None
    # Byte-level files write bytes as characters: visible ones as themselves, the others from U+0100 on.
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    special = {t["content"] for t in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    return tiktoken.Encoding("segments", pat_str=_BYTE_SPLIT, mergeable_ranks=ranks, special_tokens={})


class SegmentEncoder:
    """Token ids of texts as little-endian 32-bit bytes, with a bounded cache of segments."""

    def __init__(self, tokenizer_file: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_file)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cache: dict[str, bytes] = {}
        self.held = 0
        self.ranked = ranked_encoder(tokenizer_file)

    def _segment_ids(self, segments: list[str]) -> list[bytes]:
        if self.ranked is None:
            return self._encode(segments)
        return [array("I", self.ranked.encode_ordinary(s)).tobytes() for s in segments]

    def _encode(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    @staticmethod
    def segments(text: str) -> list[str]:
        if not _ODD.search(text) and not text.startswith(" "):
            return text.replace(" ", "\x00 ").split("\x00")
        words = text.split(" ")
        out = [words[0]]
        for w in words[1:]:
            # A cut needs a visible character on both sides of the blank.
            if w and not w[0].isspace() and out[-1] and not out[-1][-1].isspace():
                out.append(" " + w)
            else:
                out[-1] += " " + w
        return out

    def _learn(self, new: set[str]) -> None:
        """Put segments into the cache; a word with sentence marks behind it is the word's ids, then the marks'."""
        known = self.cache
        tails = {s: m.groups() for s in new if (m := _TAIL.fullmatch(s))}
        fresh = list({x for s in new for x in tails.get(s, (s,)) if x not in known})
        for at in range(0, len(fresh), 4096):
            part = fresh[at : at + 4096]
            ids = self._segment_ids(part)
            known.update(zip(part, ids, strict=True))
            self.held += ENTRY_BYTES * len(part) + 2 * sum(map(len, part)) + sum(map(len, ids))
        for s, (stem, marks) in tails.items():
            ids = known[s] = known[stem] + known[marks]
            self.held += ENTRY_BYTES + 2 * len(s) + len(ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        whole = [any(s in t for s in self.special) for t in texts]
        cut = [[] if w else self.segments(t) for t, w in zip(texts, whole, strict=True)]
        known = self.cache
        if self.held > CACHE_BYTES:
            known.clear()
            self.held = 0
        used = set().union(*cut)
        new = used.difference(known)
        long = [x for x in new if len(x) > CACHE_CHARS]
        new.difference_update(long)
        self._learn(new)
        known.update(zip(long, self._segment_ids(long), strict=True))
        out = [self._encode([t])[0] if w else b"".join(map(known.__getitem__, segs)) for t, w, segs in zip(texts, whole, cut, strict=True)]
        for x in long:
            del known[x]
        return out


@lru_cache(maxsize=1)
def encoder_of(tokenizer_file: str) -> SegmentEncoder:
    """One encoder per Python worker, kept from task to task."""
    return SegmentEncoder(tokenizer_file)


def lots(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
    """A batch in parts of at most 256 documents and BATCH_CHARS characters, or one document."""
    begin, chars = 0, 0
    for i, size in enumerate(pdf["text"].map(lambda t: len(t or ""))):
        if i > begin and (chars + size > BATCH_CHARS or i - begin == 256):
            yield pdf.iloc[begin:i]
            begin, chars = i, 0
        chars += size
    yield pdf.iloc[begin:]


def pieces(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every document cut into pieces of at most `capacity` tokens, with start, length and checksum (and ids)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder, end = encoder_of(tokenizer_file), np.array([end_id], "<u4").tobytes()
        for pdf in batches:
            for part in lots(pdf):
                rows = []
                for doc, row, ids in zip(part["doc_id"], part["row"], encoder.encode([t or "" for t in part["text"]]), strict=True):
                    ids += end
                    n = len(ids) // 4
                    for at in range(0, n, capacity):
                        cut = ids[4 * at : 4 * (at + capacity)]
                        draw = xxhash.xxh3_64_intdigest(f"{row} {at}") >> 1
                        rows.append((doc, at, len(cut) // 4, zlib.crc32(cut), n, draw, *([np.frombuffer(cut, "<u4").astype(np.int32)] if with_ids else [])))
                yield pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "draw", *(["ids"] if with_ids else [])])

    # Ids pass Python as text: a batch with nulls would turn longs into doubles.
    rows = docs.select(F.col(id_col).cast("string").alias("doc_id"), F.monotonically_increasing_id().alias("row"), F.col(text_col).cast("string").alias("text"))
    cut = rows.mapInPandas(run, _PIECES + (", ids array<int>" if with_ids else ""))
    return cut.withColumn("doc_id", F.col("doc_id").cast("long"))


def first_fit(lengths: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset of each length in the given order: first fit, by a tournament tree of free room."""
    size = 1
    while size < max(1, len(lengths)):
        size *= 2
    room = [capacity] * (2 * size)
    bins, offsets = [], []
    for n in lengths:
        at = 1
        while at < size:
            at *= 2
            if room[at] < n:
                at += 1
        bins.append(at - size)
        offsets.append(capacity - room[at])
        room[at] -= n
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
    return bins, offsets


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add sequence_id and offset to pieces (columns of `pieces`); give it a written table, as it is read twice."""
    groups = max(1, -(-cut.count() // group_pieces))

    def fill(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "draw"], ascending=[False, True], kind="stable")
        bins, offsets = first_fit(pdf["length"].tolist(), capacity)
        return pdf.drop(columns=["draw", "grp"]).assign(sequence_id=np.array(bins, np.int64) + (int(key[0]) << 32), offset=np.array(offsets, np.int64))

    keep = {f.name: f.dataType.simpleString() for f in cut.schema.fields if f.name != "draw"}
    schema = ", ".join(f"{n} {t}" for n, t in (keep | {"doc_id": "string", "sequence_id": "long", "offset": "long"}).items())
    dealt = cut.withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("grp", F.pmod(F.col("draw"), F.lit(groups)))
    return dealt.groupBy("grp").applyInPandas(fill, schema).withColumn("doc_id", F.col("doc_id").cast(keep["doc_id"]))


def pack_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, end_id: int = 0, group_pieces: int = GROUP_PIECES, **columns) -> DataFrame:
    """Pieces of all documents with the sequence and offset that they are packed at."""
    return pack(written(pieces(docs, tokenizer_file, capacity, end_id, **columns), "pieces"), capacity, group_pieces)


def padded_length(length: int, capacity: int = CAPACITY) -> int:
    """The length that a sequence takes: the capacity, unless it is a power of two already."""
    return length if length & (length - 1) == 0 else capacity
