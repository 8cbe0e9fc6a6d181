"""The English stemmer in plain Python, one word at a time: what the expressions are held against."""

from nestrel.functions.porter2 import (
    DOUBLES,
    EXCEPTIONS,
    EXCEPTIONS_AFTER_1A,
    R1_PREFIXES,
    STEP2,
    STEP3,
    STEP4,
)

VOWELS, LI_ENDING = frozenset("aeiouy"), frozenset("cdeghkmnrt")


def _is_vowel(w: str, i: int) -> bool:
    return w[i] in VOWELS


def _region_after(w: str, start: int) -> int:
    for i in range(start + 1, len(w)):
        if not _is_vowel(w, i) and _is_vowel(w, i - 1):
            return i + 1
    return len(w)


def _regions(w: str) -> tuple[int, int]:
    r1 = None
    for p in R1_PREFIXES:
        if w.startswith(p):
            r1 = len(p)
            break
    if r1 is None:
        r1 = _region_after(w, 0)
    r2 = _region_after(w, r1)
    return r1, r2


def _short_syllable_end(w: str) -> bool:
    n = len(w)
    if n == 2:
        return _is_vowel(w, 0) and not _is_vowel(w, 1)
    if n >= 3:
        return (not _is_vowel(w, n - 3) and _is_vowel(w, n - 2) and not _is_vowel(w, n - 1)
                and w[n - 1] not in "wxY")
    return False


def _is_short(w: str, r1: int) -> bool:
    return r1 >= len(w) and _short_syllable_end(w)


def stem(word: str) -> str:
    if word is None:
        return None
    w = word.lower()
    if len(w) <= 2:
        return w
    if w in EXCEPTIONS:
        return EXCEPTIONS[w]
    if w.startswith("'"):
        w = w[1:]
    if w.startswith("y"):
        w = "Y" + w[1:]
    w = "".join("Y" if c == "y" and i > 0 and w[i - 1] in VOWELS else c for i, c in enumerate(w))
    r1, r2 = _regions(w)

    # step 0
    for suf in ("'s'", "'s", "'"):
        if w.endswith(suf):
            w = w[: -len(suf)]
            break
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ied") or w.endswith("ies"):
        w = w[:-2] if len(w) > 4 else w[:-1]
    elif w.endswith("us") or w.endswith("ss"):
        pass
    elif w.endswith("s"):
        if any(c in VOWELS for c in w[:-2]):
            w = w[:-1]
    if w in EXCEPTIONS_AFTER_1A:
        return w
    # step 1b
    for suf in ("eedly", "ingly", "edly", "eed", "ing", "ed"):
        if w.endswith(suf):
            if suf in ("eed", "eedly"):
                if len(w) - len(suf) >= r1:
                    w = w[: -len(suf)] + "ee"
            else:
                stem_part = w[: -len(suf)]
                if any(c in VOWELS for c in stem_part):
                    w = stem_part
                    if w.endswith(("at", "bl", "iz")):
                        w += "e"
                    elif w.endswith(DOUBLES):
                        w = w[:-1]
                    elif _is_short(w, r1):
                        w += "e"
            break
    # step 1c
    if len(w) > 2 and w[-1] in "yY" and w[-2] not in VOWELS:
        w = w[:-1] + "i"
    # step 2
    for suf, rep in STEP2:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ogi":
                    if w[-4:-3] == "l":
                        w = w[:-3] + rep
                elif suf == "li":
                    if len(w) >= 3 and w[-3] in LI_ENDING:
                        w = w[:-2]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 3
    for suf, rep in STEP3:
        if w.endswith(suf):
            if len(w) - len(suf) >= r1:
                if suf == "ative":
                    if len(w) - len(suf) >= r2:
                        w = w[:-5]
                else:
                    w = w[: -len(suf)] + rep
            break
    # step 4
    for suf in STEP4:
        if w.endswith(suf):
            if len(w) - len(suf) >= r2:
                if suf == "ion":
                    if len(w) >= 4 and w[-4] in "st":
                        w = w[:-3]
                else:
                    w = w[: -len(suf)]
            break
    # step 5
    if w.endswith("e"):
        if len(w) - 1 >= r2 or (len(w) - 1 >= r1 and not _short_syllable_end(w[:-1])):
            w = w[:-1]
    elif w.endswith("l"):
        if len(w) - 1 >= r2 and w.endswith("ll"):
            w = w[:-1]
    return w.replace("Y", "y")
