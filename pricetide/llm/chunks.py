"""Texts as chunks whose tokens do not depend on their neighbours.

The pre-tokenizing pattern starts a new piece at every blank that a character other than white space follows, and
takes a line end between two such characters as a piece, so a text may be cut there and each different chunk encoded
once.
"""

from __future__ import annotations

import re
from itertools import islice

_CUT = re.compile(r" (?=\S)")
_OTHER = re.compile(r"[^\S \n]|\x00")


def chunks_of(text: str) -> list[str]:
    """Chunks that joined give the text; none is empty but that of an empty text."""
    if "  " in text or " \n" in text or "\n " in text or "\n\n" in text or text[-1:] in " \n" or _OTHER.search(text):
        parts = _CUT.split(text)
        parts = parts[:1] + [" " + p for p in parts[1:]]
    else:  # single blanks and line ends only: a line end is a piece of its own
        parts = text.replace("\n", "\0\n\0").replace(" ", "\0 ").split("\0")
    return parts if parts[0] or len(parts) == 1 else parts[1:]


MARKS = ".,;:!?#$%&*|\"()"


def word_and_marks(chunk: str) -> tuple[str, ...] | None:
    """The pieces of a chunk of a blank, Latin letters and marks behind them; None for all others."""
    word = chunk.rstrip(MARKS)
    if word[1:].isalpha() and word[0] == " " and (word.isascii() or max(word) < "\u0250"):
        return (word,) if len(word) == len(chunk) else (word, chunk[len(word):])
    return None


class _Numbers(dict):
    def __missing__(self, key):
        number = self[key] = len(self)
        return number


class ChunkCache:
    """Values of chunks, each encoded once in a call; the first ``most`` are kept for the next calls of the worker."""

    def __init__(self, encode, most: int = 500_000):
        self.encode, self.most = encode, most
        self.numbers, self.values = _Numbers(), []

    def get(self, chunk: str):
        number = self.numbers.get(chunk, len(self.values))
        return self.values[number] if number < len(self.values) else None

    def look_up(self, texts: list[list[str]]) -> tuple[list, list[list[int]]]:
        """(values, the numbers of every text's chunks among them); good until the next call."""
        for chunk in list(islice(self.numbers, self.most, None)):
            del self.numbers[chunk]
        del self.values[self.most:]
        number = self.numbers.__getitem__
        at = [list(map(number, chunks)) for chunks in texts]
        self.values += self.encode(list(islice(self.numbers, len(self.values), None)))
        return self.values, at


def slices(sizes, most: int):
    """Cut a list of sizes into runs (start, end) of about ``most`` in sum; one item is never cut."""
    start = held = 0
    for i, size in enumerate(sizes):
        held += size
        if held >= most:
            yield start, i + 1
            start, held = i + 1, 0
    if start < len(sizes):
        yield start, len(sizes)
