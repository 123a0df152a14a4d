"""Porter's suffix-stripping stemmer (M. F. Porter, 1980) for one word.

Used once per distinct word, inside an Arrow batch.
"""

from __future__ import annotations

import re

# The suffix tables of the published algorithm.
STEP_2 = (
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
    ("abli", "able"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
    ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
    ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
)
STEP_3 = (
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
)
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
)

_VC = re.compile("v+c+")


def _shape(stem: str) -> str:
    """The word as a string of v and c; y is a vowel after a consonant."""
    kinds = ""
    for ch in stem:
        vowel = ch in "aeiou" or (ch == "y" and kinds.endswith("c"))
        kinds += "v" if vowel else "c"
    return kinds


def _measure(stem: str) -> int:
    return len(_VC.findall(_shape(stem)))


def _doubled(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _swap(word: str, table: tuple[tuple[str, str], ...]) -> str:
    """Replace the longest matching suffix if enough word is left of it."""
    for suffix, new in sorted(table, key=lambda row: -len(row[0])):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + new if _measure(stem) > 0 else word
    return word


def _plural(word: str) -> str:
    for suffix, new in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if word.endswith(suffix):
            return word[: len(word) - len(suffix)] + new
    return word


def _past(word: str) -> str:
    if word.endswith("eed"):
        return word[:-1] if _measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: -len(suffix)]
        if word.endswith(suffix) and "v" in _shape(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if _doubled(stem) and stem[-1] not in "lsz":
                return stem[:-1]
            return stem + "e" if _measure(stem) == 1 and _cvc(stem) else stem
    return word


def _residue(word: str) -> str:
    for suffix in sorted(STEP_4, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            allowed = suffix != "ion" or stem.endswith(("s", "t"))
            return stem if allowed and _measure(stem) > 1 else word
    return word


def _final(word: str) -> str:
    if word.endswith("e"):
        stem = word[:-1]
        if _measure(stem) > 1 or (_measure(stem) == 1 and not _cvc(stem)):
            word = stem
    return word[:-1] if word.endswith("ll") and _measure(word) > 1 else word


def porter(word: str) -> str:
    if len(word) <= 2:
        return word
    word = _past(_plural(word))
    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"
    return _final(_residue(_swap(_swap(word, STEP_2), STEP_3)))
