"""Token ids of whole texts from a cache of space-delimited chunks.

The pattern of the byte-level vocabularies never lets a match run from a
non-space character into a space, so a text cut before every single space
between two non-space characters tokenises chunk by chunk.  Most chunks (a
word with its leading space) recur, so each worker keeps their ids, as
little-endian 32-bit bytes, in a bounded dictionary.
"""

from __future__ import annotations

import gc
import re
from collections.abc import Callable, Iterable, Iterator
from itertools import filterfalse

# Python's white space holds every character that any of the tokenisers' white-space classes holds.
# A chunk that is one word of Latin letters, with or without a comma or full stop after it, or two such with a newline between.
_WORD = "[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+"
_PLAIN = re.compile(f"( ?{_WORD})([.,]?)(?:(\n)({_WORD})([.,]?))?").fullmatch
# A word of Latin letters and any ASCII marks behind it, to the end of the chunk: two pre-tokens, since no match goes from letters on to marks.
word_and_marks = re.compile(f"({_WORD})([!-/:-@\\[-`{{-~]*)").fullmatch
# Chunks of Latin words, ASCII digits, ASCII marks but the apostrophe (which may begin a contraction) and single newlines: the runs are the pre-tokens.
_PLAIN_RUNS = re.compile(" ?[{0}]++(?:\n[{0}]++)*+".format("!-&(-~" + _WORD[1:-2])).fullmatch
_RUNS = re.compile(f" ?(?:{_WORD}|[0-9]+|[!-&(-/:-@\\[-`{{-~]+)|\n").findall
_SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")


class ChunkCache:
    """``encode(list of chunks) -> list of bytes`` behind a dictionary of at
    most ``limit`` chunks, emptied when full (memory stays bounded whatever
    the corpus; only speed depends on it)."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]], limit: int = 800_000):
        self.encode, self.limit = encode, limit
        self.known: dict[str, bytes | None] = {}

    def _learn(self, chunks: set[str]) -> None:
        new = chunks - self.known.keys()
        if len(self.known) + len(new) > self.limit:
            self.known.clear()
            new = chunks
        clean = [" " + c for c in new if c and not c[0].isspace() and not c[-1].isspace()]
        if len(clean) < len(new):  # an empty chunk, or white space at an edge: a cut was not safe
            self.known.update((c, None) for c in new if not c or c[0].isspace() or c[-1].isspace())
        self.known.update(zip([c[1:] for c in clean], self.encode(clean)))

    def ids(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text as little-endian 32-bit bytes.  New chunks of
        all the texts are learned in one call."""
        parts = [t.split(" ") for t in texts]
        self._learn(set().union(*[p[1:] for p in parts]))
        heads = self.encode([p[0] for p in parts])
        out = []
        for text, p, head in zip(texts, parts, heads):
            try:
                if p[0][-1:].isspace() or not p[0] and len(p) > 1:
                    raise TypeError
                out.append(head + b"".join(map(self.known.__getitem__, p[1:])))
            except TypeError:  # a cut of this text was not safe
                out.append(self._slow(text))
        return out

    def _slow(self, text: str) -> bytes:
        """Cuts only where both neighbours are not white space; very long
        texts go through in groups of cuts."""
        parts = _SAFE_CUT.split(text)
        out = []
        for i in range(0, len(parts), 100_000):
            out += self.encode([(" " if i + k else "") + p for k, p in enumerate(parts[i:i + 100_000])])
        return b"".join(out)


def pre_token_cutter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a chunk.  Most chunks are plain words, seen by a cheaper
    match that gives what the pattern would."""
    import regex

    return word_cutter(regex.compile(pattern).findall)


def run_cutter(pattern: str) -> Callable[[str], list[str]]:
    """Pre-tokens of a chunk: runs of plain characters by a cheaper match that gives what the pattern would."""
    import regex

    otherwise = regex.compile(pattern).findall
    return lambda chunk: _RUNS(chunk) if _PLAIN_RUNS(chunk) else otherwise(chunk)


def word_cutter(otherwise: Callable[[str], list[str]]) -> Callable[[str], list[str]]:
    """Words, commas, full stops and newlines of a chunk made of these; ``otherwise`` of any other chunk."""
    def cut(chunk: str) -> list[str]:
        m = _PLAIN(chunk)
        return otherwise(chunk) if m is None else [part for part in m.groups() if part]
    return cut


def groups(texts: list[str], rows: int = 128, chars: int = 4_000_000):
    """Consecutive slices of the list, small in rows and in characters (a
    longer text stands alone)."""
    at = size = 0
    for k, t in enumerate(texts):
        if k > at and (k - at >= rows or size + len(t) > chars):
            yield texts[at:k]
            at, size = k, 0
        size += len(t)
    if at < len(texts):
        yield texts[at:]


class UnsafeCut(Exception):
    """A piece has white space at an edge: its text must be cut elsewhere."""


class PieceCache(dict):
    """What ``make`` gives for a chunk (a text between two single spaces), kept
    in two generations: a full young one becomes the old one, and what is used
    again moves back, so frequent chunks stay and memory is bounded by twice
    ``limit`` entries.  Only speed depends on the limit.  With ``cut`` the keys
    are cuts of a text, which must not have white space at an edge."""

    def __init__(self, make: Callable[[str], object], limit: int, cut: bool = True):
        super().__init__()
        self.make, self.limit, self.cut, self.old = make, limit, cut, {}

    def __missing__(self, chunk: str):
        value = self.old.get(chunk)
        if value is None:
            if self.cut and (not chunk or chunk.strip() != chunk):
                raise UnsafeCut
            value = self.make(chunk)
        if len(self) >= self.limit:
            self.turn()
        self[chunk] = value
        return value

    def put(self, chunk: str, value) -> None:
        if len(self) >= self.limit:
            self.turn()
        self[chunk] = value

    def turn(self) -> None:
        self.old = dict(self)
        self.clear()

    def unknown(self, chunks: set[str]) -> set[str]:
        return set(filterfalse(self.old.__contains__, filterfalse(self.__contains__, chunks)))


def safe_parts(text: str) -> list[str]:
    """The text cut at single spaces between two characters that are not white space (the space is left out)."""
    return _SAFE_CUT.split(text)


def without_gc(batches: Iterable) -> Iterator:
    """The batches, with Python's cycle collector off between them: the caches
    hold strings and bytes only, and walking them again and again takes a
    quarter of the time.  Reference counting still frees everything."""
    was = gc.isenabled()
    gc.disable()
    try:
        yield from batches
    finally:
        if was:
            gc.enable()
