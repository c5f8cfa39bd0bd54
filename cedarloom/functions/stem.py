"""An English suffix stripper after Porter's published algorithm (1980), for the text analyser."""

from __future__ import annotations

import re
from functools import lru_cache

_VOWEL = "[aeiouy]"
_STEP2 = {"ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
_STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
_STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic", "ou"]


def _form(w: str) -> str:
    return "".join("v" if c in "aeiou" or (c == "y" and i and w[i - 1] not in "aeiou") else "c" for i, c in enumerate(w))


def _measure(w: str) -> int:
    return len(re.findall("v+c+", _form(w)))


def _cvc(w: str) -> bool:
    return _form(w)[-3:] == "cvc" and w[-1] not in "wxy"


@lru_cache(100_000)
def stem(w: str) -> str:
    if len(w) <= 2:
        return w
    for a, b in (("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")):
        if w.endswith(a):
            w = w[: len(w) - len(a)] + b
            break
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) else w
    else:
        for end in ("ed", "ing"):
            if w.endswith(end) and "v" in _form(w[: -len(end)]):
                w = w[: -len(end)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif len(w) > 1 and w[-1] == w[-2] and w[-1] not in "aeioulsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _cvc(w):
                    w += "e"
                break
    if w.endswith("y") and "v" in _form(w[:-1]):
        w = w[:-1] + "i"
    for table in (_STEP2, _STEP3):
        for a in sorted(table, key=len, reverse=True):
            if w.endswith(a):
                w = w[: -len(a)] + table[a] if _measure(w[: -len(a)]) else w
                break
    for a in _STEP4:
        if w.endswith(a):
            w = w[: -len(a)] if _measure(w[: -len(a)]) > 1 else w
            break
    else:
        if w.endswith(("sion", "tion")) and _measure(w[:-3]) > 1:
            w = w[:-3]
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    return w[:-1] if w.endswith("ll") and _measure(w) > 1 else w
