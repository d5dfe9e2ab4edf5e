"""English stemming by the published algorithm of Porter (1980), over distinct words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The suffix pairs of steps 2 and 3 and the suffixes of step 4.
STEP2 = "ational ate tional tion enci ence anci ance izer ize abli able alli al entli ent eli e ousli ous ization ize ation ate ator ate alism al iveness ive fulness ful ousness ous aliti al iviti ive biliti ble".split()
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = "al ance ence er ic able ible ant ement ment ent ou ism ate iti ous ive ize".split()


def _shape(w: str) -> str:
    """c and v for every letter; y is a vowel after a consonant."""
    out = ""
    for i, ch in enumerate(w):
        out += "v" if ch in "aeiou" or (ch == "y" and i > 0 and out[-1] == "c") else "c"
    return out


def _m(w: str) -> int:
    return len(re.findall(r"v+c+", _shape(w)))


def _cvc(w: str) -> bool:
    return _shape(w)[-3:] == "cvc" and w[-1] not in "wxy"


def stem(word: str) -> str:
    """The stem of a lower-case English word; words of up to two letters stay."""
    w = word
    if len(w) <= 2:
        return w
    if w.endswith("sses") or w.endswith("ies"):
        w = w[:-2]
    elif w.endswith("s") and not w.endswith("ss"):
        w = w[:-1]
    more = False
    if w.endswith("eed"):
        w = w[:-1] if _m(w[:-3]) > 0 else w
    elif w.endswith("ed") and "v" in _shape(w[:-2]):
        w, more = w[:-2], True
    elif w.endswith("ing") and "v" in _shape(w[:-3]):
        w, more = w[:-3], True
    if more:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif len(w) > 1 and w[-1] == w[-2] and _shape(w)[-1] == "c" and w[-1] not in "lsz":
            w = w[:-1]
        elif _m(w) == 1 and _cvc(w):
            w += "e"
    if w.endswith("y") and "v" in _shape(w[:-1]):
        w = w[:-1] + "i"
    for a, b in sorted(zip(STEP2[::2], STEP2[1::2], strict=True), key=lambda p: -len(p[0])):
        if w.endswith(a):
            w = w[: -len(a)] + b if _m(w[: -len(a)]) > 0 else w
            break
    for a in sorted(STEP3, key=len, reverse=True):
        if w.endswith(a):
            w = w[: -len(a)] + STEP3[a] if _m(w[: -len(a)]) > 0 else w
            break
    for a in sorted([*STEP4, "ion"], key=len, reverse=True):
        if w.endswith(a):
            s = w[: -len(a)]
            if _m(s) > 1 and (a != "ion" or s.endswith(("s", "t"))):
                w = s
            break
    if w.endswith("e") and (_m(w[:-1]) > 1 or (_m(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    if w.endswith("ll") and _m(w) > 1:
        w = w[:-1]
    return w


def with_stems(words: DataFrame, col: str = "term") -> DataFrame:
    """Adds stem; every distinct word is stemmed once and joined back, so a frequent word costs one call."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"w": b["w"], "stem": [stem(x) for x in b["w"]]})

    d = words.select(F.col(col).alias("w")).where("w is not null").distinct().mapInPandas(run, "w string, stem string")
    return words.join(d, words[col] == d["w"], "left").drop("w")
