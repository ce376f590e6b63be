"""Classes of code points, and the pieces that byte-level BPE merges within."""

from __future__ import annotations

import functools

import numpy as np
import regex
from tokenizers import Regex
from tokenizers.pre_tokenizers import Split

MARK, LETTER, NUMBER, WHITE = 0, 1, 2, 3

#: The public pattern of byte-level BPE vocabularies (fixed value):
#: 's|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+

@functools.cache
def code_point_classes() -> np.ndarray:
    """The class of every code point: letter, number, white space or mark.

    The tokenizers library says which is which, as Unicode versions differ.
    """
    classes = np.zeros(0x110000, np.uint8)
    patterns = ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (WHITE, r"\s+"))
    splits = [(kind, Split(Regex(p), "removed", invert=True)) for kind, p in patterns]
    for start in range(0, 0x110000, 0x400):  # in small parts, as the library takes 60 bytes a byte
        if 0xD800 <= start < 0xE000:
            continue
        part = "".join(map(chr, range(start, start + 0x400)))
        for kind, split in splits:
            for run, _ in split.pre_tokenize_str(part):
                classes[ord(run[0]) : ord(run[-1]) + 1] = kind
    classes[0xD800:0xE000] = MARK
    return classes


def _members(kind: int) -> str:
    """The code points of a class as the inside of a regular expression set."""
    member = (code_point_classes() == kind).astype(np.int8)
    edges = np.flatnonzero(np.diff(member, prepend=0, append=0)).reshape(-1, 2)
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in edges)


@functools.cache
def _pattern():
    """The pattern with the classes as they are in the table."""
    letter, number, white = (_members(kind) for kind in (LETTER, NUMBER, WHITE))
    return regex.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{white}{letter}{number}]+"
        f"|[{white}]+(?![^{white}])|[{white}]+"
    )


def class_runs(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The code points of a text, where each run of one class begins, and the classes."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    kinds = code_point_classes()[points]
    starts = np.append(0, np.flatnonzero(kinds[1:] != kinds[:-1]) + 1)
    return points, starts, kinds[starts]


def pieces(text: str) -> list[str]:
    """What the public pattern finds, in order.

    A run of one class is a piece; the last of the blanks before it joins it, or
    stands alone if it is no plain space. Texts with apostrophes, which may begin a
    contraction, go through the pattern itself.
    """
    if not text:
        return []
    if "'" in text:
        return _pattern().findall(text)
    points, starts, kinds = class_runs(text)
    ends = np.append(starts[1:], len(points))
    white = (kinds == WHITE) & (ends < len(points))
    last = ends - 1
    plain = white & (points[last] == 32)
    cut = np.zeros(len(points), bool)
    cut[starts[1:][~plain[:-1]]] = True
    cut[last[white]] = cut[0] = True
    cuts = np.flatnonzero(cut).tolist()
    return [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]


@functools.cache
def _lower_pattern():
    """As for the words, but digits stand alone and white space goes."""
    letter, number, white = (_members(kind) for kind in (LETTER, NUMBER, WHITE))
    return regex.compile(
        f"'s|'t|'re|'ve|'m|'ll|'d|[{letter}]+|[{number}]|[^{white}{letter}{number}]+"
    )


def word_pieces(text: str) -> list[str]:
    """Runs of letters, single digits and runs of marks, without white space.

    Texts with apostrophes go through the public pattern of such vocabularies.
    """
    if not text:
        return []
    if "'" in text:
        return _lower_pattern().findall(text)
    points, starts, kinds = class_runs(text)
    cuts = np.zeros(len(points), bool)
    cuts[starts] = True
    number = code_point_classes()[points] == NUMBER
    cuts |= number
    begin = np.flatnonzero(cuts)
    kept = code_point_classes()[points[begin]] != WHITE
    end = np.append(begin[1:], len(points))[kept].tolist()
    return [text[a:b] for a, b in zip(begin[kept].tolist(), end, strict=True)]
