"""Decisions on a text carried over to another spelling of it that differs in punctuation, blanks and case alone.

Both spellings are reduced to their letters and digits, with the place of each. Where the reductions are equal, the nth of one is the nth of
the other: a place is looked up by its rank, a span by the ranks of its ends, so that memory is two arrays of places. Texts
are aligned one by one within Arrow batches; nothing is compared across rows.

Defined cases: null texts are empty. A decision whose text no longer matches is quarantined if it was a correction or quarantined
before; one that nothing was found for stays as it is; any other keeps its text, and the reason is put before its own. A correction is carried over
by its substitutions (both texts have one length); if one falls on a character that the target lacks, it is quarantined. A quote that
isn't found stays as it is; found ones are read from the target, with the punctuation inside.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

DIFFERS = "transfer_text_differs"
_RESULT = "decision string, corrected string, places array<int>, quotes array<string>, reasons array<string>"


def places_of(text: str) -> tuple[np.ndarray, str]:
    """Places of letters and digits, and what they read in lower case."""
    at = np.fromiter((i for i, c in enumerate(text) if c.isalnum()), np.int64)
    return at, "\x00".join(text[i].lower() for i in at)


class Alignment:
    """Places of a text in another spelling of it; `fits` is false where they read differently."""

    def __init__(self, source: str, target: str):
        (self.source, a), (self.target, b) = places_of(source), places_of(target)
        self.fits = a == b

    def place(self, i: int) -> int | None:
        """Where a character of the source stands in the target; None for punctuation and blanks."""
        rank = int(np.searchsorted(self.source, i))
        return int(self.target[rank]) if rank < len(self.source) and self.source[rank] == i else None

    def span(self, start: int, stop: int) -> tuple[int, int] | None:
        """From the first to the last letter or digit of a span; None if it holds none."""
        lo, hi = np.searchsorted(self.source, [start, stop])
        return (int(self.target[lo]), int(self.target[hi - 1]) + 1) if lo < hi else None


def _corrected(source: str, corrected: str, target: str, to: Alignment) -> str | None:
    out = list(target)
    for i in range(min(len(source), len(corrected))):
        if source[i] != corrected[i]:
            at = to.place(i)
            if at is None or out[at].lower() != source[i].lower():
                return None
            out[at] = corrected[i]
    return "".join(out)


def _quoted(quote: str, texts: tuple[str, ...], target: str, to: Alignment) -> str:
    for text in texts:
        at = text.find(quote) if text else -1
        if at >= 0 and (span := to.span(at, at + len(quote))):
            return target[slice(*span)]
    return quote


def carried(source: str, target: str, decision: str, corrected: str | None, edits: list[int], quotes: list[str], reasons: list[str]) -> tuple:
    """(decision, corrected, places of edits, quotes, reasons) for the target."""
    to = Alignment(source, target)
    new = _corrected(source, corrected or "", target, to) if to.fits and decision == "corrected" else None
    if not to.fits or (decision == "corrected" and new is None):
        if decision == "corrected":
            return "quarantine", None, [], quotes, [DIFFERS]
        if decision in ("quarantine", "not_hit"):
            return decision, None, [], quotes, reasons
        return "unchanged", None, [], quotes, [DIFFERS, *reasons]
    places = [to.place(i) for i in edits] if decision == "corrected" else []
    return decision, new, places, [_quoted(q, (source, corrected or ""), target, to) for q in quotes], reasons


def transferred(source: Column, target: Column, decision: Column, corrected: Column, edits: Column, quotes: Column, reasons: Column) -> Column:
    """`carried` for columns: a struct of decision, corrected, places, quotes and reasons."""

    @F.pandas_udf(_RESULT)
    def run(source: pd.Series, target: pd.Series, decision: pd.Series, corrected: pd.Series, edits: pd.Series, quotes: pd.Series, reasons: pd.Series) -> pd.DataFrame:
        lists = lambda x: [] if x is None else list(x)
        rows = [carried(s or "", t or "", d, c, lists(e), lists(q), lists(r)) for s, t, d, c, e, q, r in zip(source, target, decision, corrected, edits, quotes, reasons, strict=True)]
        return pd.DataFrame(rows, columns=["decision", "corrected", "places", "quotes", "reasons"])

    return run(source, target, decision, corrected, edits, quotes, reasons)
