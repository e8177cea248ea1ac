"""Porter's suffix stripping (M. F. Porter, 1980, "An algorithm for suffix stripping").

A small per-word helper for the stemmed similarity scores; it runs inside Arrow batches.
"""

from __future__ import annotations

# Suffix tables of the published algorithm.
STEP_2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP_3 = {
    "icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": "",
}
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou",
    "ism", "ate", "iti", "ous", "ive", "ize",
]


def _shape(word: str) -> str:
    """One letter per character: ``c`` for consonants, ``v`` for vowels."""
    out = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and out[-1] == "c")
        out += "v" if vowel else "c"
    return out


def _measure(word: str) -> int:
    return _shape(word).count("vc")


def _double(word: str) -> bool:
    return len(word) > 1 and word[-1] == word[-2] and _shape(word)[-1] == "c"


def _cvc(word: str) -> bool:
    return _shape(word)[-3:] == "cvc" and word[-1] not in "wxy"


def _longest(word: str, suffixes) -> str | None:
    return max((s for s in suffixes if word.endswith(s)), key=len, default=None)


def stem(word: str) -> str:
    if len(word) <= 2:
        return word
    if word.endswith("sses") or word.endswith("ies"):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]

    if word.endswith("eed"):
        if _measure(word[:-3]) > 0:
            word = word[:-1]
    else:
        cut = next((s for s in ("ed", "ing") if word.endswith(s)), None)
        if cut and "v" in _shape(word[: -len(cut)]):
            word = word[: -len(cut)]
            if word.endswith(("at", "bl", "iz")):
                word += "e"
            elif _double(word) and word[-1] not in "lsz":
                word = word[:-1]
            elif _measure(word) == 1 and _cvc(word):
                word += "e"

    if word.endswith("y") and "v" in _shape(word[:-1]):
        word = word[:-1] + "i"

    for table in (STEP_2, STEP_3):
        suffix = _longest(word, table)
        if suffix and _measure(word[: -len(suffix)]) > 0:
            word = word[: -len(suffix)] + table[suffix]

    suffix = _longest(word, STEP_4)
    if suffix:
        rest = word[: -len(suffix)]
        if _measure(rest) > 1 and (suffix != "ion" or rest.endswith(("s", "t"))):
            word = rest

    if word.endswith("e"):
        rest = word[:-1]
        if _measure(rest) > 1 or (_measure(rest) == 1 and not _cvc(rest)):
            word = rest
    if word.endswith("ll") and _measure(word) > 1:
        word = word[:-1]
    return word
