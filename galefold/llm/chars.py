"""Code points of many texts at once, as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np

#: Code points that one pass of the array operators takes at most, and that short texts are put together to.
BLOCK, GROUP = 1 << 20, 1 << 18


def points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def blocks(texts: list[str], block: int = BLOCK, group: int = GROUP) -> Iterator[tuple[list[int], list[str], list[bool]]]:
    """Whole texts in bounded passes: (indexes, pieces, whether each piece begins its text).

    Short texts go together up to ``group``; a text longer than ``block`` comes alone, piece after piece.
    """
    at, pieces, heads, total = [], [], [], 0
    for i, text in enumerate(texts):
        if at and total + len(text) > group:
            yield at, pieces, heads
            at, pieces, heads, total = [], [], [], 0
        if len(text) <= block:
            at.append(i)
            pieces.append(text)
            heads.append(True)
            total += len(text)
        else:
            for k in range(0, len(text), block):
                yield [i], [text[k : k + block]], [k == 0]
    if at:
        yield at, pieces, heads


@cache
def letters() -> np.ndarray:
    """For each code point its lower-case form if it is a letter, else 0."""
    return np.fromiter((ord(c.lower()[0]) if (c := chr(i)).isalpha() else 0 for i in range(0x110000)), np.uint32, 0x110000)


@cache
def folded() -> np.ndarray:
    """12-bit symbols: 1 white space, 2 digit, lower-cased code points below 2048, others in 2048 classes."""
    table = np.zeros(0x110000, np.uint16)
    for i in range(0x110000):
        c = chr(i)
        low = ord(c.lower()[0])
        table[i] = 1 if c.isspace() else 2 if c.isdecimal() else (max(3, low) if low < 2048 else 2048 + low * 2654435761 % 2**32 % 2048)
    return table


def sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the runs of ``values`` that begin at the ascending ``starts``; 0 for empty runs."""
    out = np.zeros(len(starts), values.dtype)
    ends = np.append(starts[1:], len(values))
    full = np.flatnonzero(ends > starts)
    if len(full):
        out[full] = np.add.reduceat(values, starts[full])
    return out
