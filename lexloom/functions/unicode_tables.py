"""Tables for `translate`, made from the Unicode database: Spark has no normalisation function."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

#: The five tone marks of Vietnamese.
TONE_MARKS = "̣̀́̃̉"


def _precomposed() -> list[str]:
    """Characters of the Latin blocks whose decomposition has combining marks."""
    return [c for c in map(chr, [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]) if unicodedata.normalize("NFD", c) != c]


def _bare(c: str) -> str:
    return unicodedata.normalize("NFC", "".join(x for x in unicodedata.normalize("NFD", c) if not 0x300 <= ord(x) <= 0x36F))


@lru_cache(maxsize=None)
def fold_table() -> tuple[str, str]:
    """Letters of any script with marks of U+0300 to U+036F to the same without them; đ and Đ to d and D."""
    pairs = {c: _bare(c) for c in map(chr, [*range(0xC0, 0xD800), *range(0xF900, 0x10000)]) if unicodedata.decomposition(c)[:1] not in ("", "<")}
    pairs = {c: x for c, x in pairs.items() if x != c and len(x) == 1}
    pairs |= {"đ": "d", "Đ": "D"}
    return "".join(pairs), "".join(pairs.values())


@lru_cache(maxsize=None)
def tone_table() -> tuple[str, str]:
    """Letters with a tone to the same letter without it; other marks stay."""
    pairs = {}
    for c in _precomposed():
        parts = unicodedata.normalize("NFD", c)
        bare = unicodedata.normalize("NFC", "".join(x for x in parts if x not in TONE_MARKS))
        if bare != c and len(bare) == 1:
            pairs[c] = bare
    return "".join(pairs), "".join(pairs.values())


@lru_cache(maxsize=None)
def tone_classes() -> tuple[tuple[str, str], ...]:
    """(tone as hex, a regex class of the letters that carry it) of each tone."""
    found: dict[str, list[str]] = {t: [t] for t in TONE_MARKS}
    for c in _precomposed():
        for x in unicodedata.normalize("NFD", c):
            if x in found:
                found[x].append(c)
    return tuple((f"{ord(t):x}", "[" + "".join(v) + "]") for t, v in found.items())


@lru_cache(maxsize=None)
def compositions() -> dict[str, str]:
    """A letter and a mark to the letter that they compose to, marks in any order."""
    bases = [*map(chr, range(65, 123)), *_precomposed(), *map(chr, range(0x391, 0x3CA)), *map(chr, range(0x410, 0x458))]
    pairs = ((c + chr(m), unicodedata.normalize("NFC", c + chr(m))) for c in bases for m in range(0x300, 0x330))
    return {pair: one for pair, one in pairs if len(one) == 1}
