"""Distinct-chunk tables: segment each distinct chunk of text once and look the rest up.

A table lives in a Python worker and holds two generations of at most ``limit``
entries each: when the young one is full it becomes the old one, entries that are
used again move back.  Memory is bounded whatever the vocabulary; a forgotten
chunk is only segmented again.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable


class ChunkTable:
    """``segment`` gets a list of distinct chunks and gives their values in order."""

    def __init__(self, segment: Callable[[list[str]], Iterable], limit: int = 250_000, max_chars: int = 64):
        self.segment, self.limit, self.max_chars = segment, limit, max_chars
        self.young: dict = {}
        self.old: dict = {}

    def look_up(self, texts: list[list[str]]) -> list[list]:
        """Values by position for a batch of chunked texts; each distinct chunk is segmented once.

        Chunks over ``max_chars`` characters are segmented but not kept beyond
        the batch, so entries are bounded in size as well as in number.
        """
        young, old = self.young, self.old
        missing = set().union(*texts).difference(young)
        young.update({c: old[c] for c in missing if c in old})
        missing = [c for c in missing if c not in old]
        young.update(zip(missing, self.segment(missing)))
        out = [list(map(young.__getitem__, t)) for t in texts]
        for c in missing:
            if len(c) > self.max_chars:
                del young[c]
        if len(young) >= self.limit:
            self.old, self.young = young, {}
        return out


def split_before_blanks(text: str) -> list[str]:
    """Cut before each blank that a non-white character follows.

    A byte-level BPE with the usual pre-tokenizer always ends a pre-token
    there, so the chunks' ids concatenate to the text's ids.
    """
    parts = text.split(" ")
    first = parts[0]
    rest = parts[1:]
    if all(rest) and not any(map(str.isspace, [p[0] for p in rest])):
        return [first, *[" " + p for p in rest]] if first else [" " + p for p in rest]
    out = [first]
    for p in rest:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return [c for c in out if c]


def split_marked(text: str) -> list[str]:
    """Chunks of a text with blanks as U+2581 and one such mark in front: each a run of marks and what follows.

    Pieces of the model hold marks only in front, so none crosses a chunk's start.
    """
    marked = "▁" + text.replace(" ", "▁")
    parts = marked.split("▁")[1:]
    if all(parts):
        return ["▁" + p for p in parts]
    out, held = [], ""
    for p in parts:
        held += "▁"
        if p:
            out.append(held + p)
            held = ""
    return [*out, held] if held else out
