"""The published English stemmer ("Porter2") as built-in expressions over an array of tokens.

A step of the algorithm looks for the longest of its suffixes and, if the suffix lies in
a certain region of the word, replaces it. So a step is a table of suffixes and
replacements (a literal map), comparisons of the word's end, and a comparison of lengths.
Every step binds its word by a ``transform`` of its own, which keeps the expression
linear in size; nothing leaves the JVM and nothing is shuffled.

Most of the time would go into regular expressions, so none is tried that cannot match: a
word whose last letters begin no step is its own stem, a step looks for its suffixes only if one
of them ends like the word, and a region is found only once a suffix asks for it.

A word on its way is a struct: ``b``, the word in which the regions are found, and ``w``, the
word as it is now.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published algorithm.
VOWEL, LI_ENDING = "[aeiouy]", "[cdeghkmnrt]"
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas",
    "cosmos": "cosmos", "bias": "bias", "andes": "andes",
}
EXCEPTIONS_AFTER_1A = frozenset(
    ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"])
STEP1B = ("eedly", "ingly", "edly", "eed", "ing", "ed")
R1_PREFIXES = ("gener", "commun", "arsen")
STEP2 = [
    ("ization", "ize"), ("ational", "ate"), ("fulness", "ful"), ("ousness", "ous"),
    ("iveness", "ive"), ("tional", "tion"), ("biliti", "ble"), ("lessli", "less"),
    ("entli", "ent"), ("ation", "ate"), ("alism", "al"), ("aliti", "al"), ("ousli", "ous"),
    ("iviti", "ive"), ("fulli", "ful"), ("enci", "ence"), ("anci", "ance"), ("abli", "able"),
    ("izer", "ize"), ("ator", "ate"), ("alli", "al"), ("bli", "ble"), ("ogi", "og"), ("li", ""),
]
STEP3 = [
    ("ational", "ate"), ("tional", "tion"), ("alize", "al"), ("icate", "ic"), ("iciti", "ic"),
    ("ative", ""), ("ical", "ic"), ("ness", ""), ("ful", ""),
]
STEP4 = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate",
         "iti", "ous", "ive", "ize", "ion", "al", "er", "ic"]


# Last letters of the words that any step changes: three, two or one of them.
_ENDS3 = ("ing", "ion", "iti", "ism", "nci", "tor", "ogi", "ful", "ent", "ant")
_ENDS2 = ("ed", "al", "li", "er", "ic", "ll")
_ENDS1 = ("s", "y", "e")
_R1 = f"^(?>{'|'.join(R1_PREFIXES)}|.*?{VOWEL}[^aeiouy])"
_R2 = f"{_R1}.*?{VOWEL}[^aeiouy]"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is evaluated once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _cut(w: Column, n) -> Column:
    """w without its last n characters."""
    return w.substr(F.lit(1), F.length(w) - n)


def _end(w: Column, n: int) -> Column:
    """The last n characters of w, or all if it has fewer."""
    return w.substr(F.lit(-n), F.lit(n))


def _table(rules: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in rules.items() for x in pair])


def _may_end(w: Column, suffixes) -> Column:
    """False for most words that end with none of the suffixes, true for all that end with one."""
    two, three = {s for s in suffixes if len(s) == 2}, {s[-3:] for s in suffixes if len(s) > 2}
    return _end(w, 3).isin(*sorted(three)) | (_end(w, 2).isin(*sorted(two)) if two else F.lit(False))


def _suffix(w: Column, suffixes) -> Column:
    """The longest of the suffixes that w ends with, or the empty text."""
    found = F
    for s in sorted(suffixes, key=len, reverse=True):
        found = found.when(w.endswith(s), F.lit(s))
    return found.otherwise(F.lit(""))


def _region(b: Column, pattern: str) -> Column:
    """The start of a region (the number of characters before it); without one, the word's end."""
    found = F.length(F.regexp_extract(b, pattern, 0))
    return F.when(found > 0, found).otherwise(F.length(b))


def _r1(x: Column) -> Column:
    return _region(x["b"], _R1)


def _r2(x: Column) -> Column:
    return _region(x["b"], _R2)


def _short_end(w: Column) -> Column:
    """Ends in a short syllable: vowel and consonant at the start, or consonant, vowel and
    a consonant other than w, x and Y."""
    return w.rlike(f"(?:^{VOWEL}[^aeiouy]|[^aeiouy]{VOWEL}[^aeiouywxY])$")


def _next(x: Column, w: Column, **more: Column) -> Column:
    """The word as it goes on."""
    return F.struct(x["b"].alias("b"), w.alias("w"), *[c.alias(n) for n, c in more.items()])


def _swap(rules: dict[str, str], region, unless=None):
    """A step: the longest suffix is replaced if it lies in the region."""
    def swapped(x: Column) -> Column:
        w, s = x["w"], x["s"]
        ok = s != ""
        if unless is not None:
            ok = ok & ~unless(x, w, s)
        ok = ok & (F.length(w) - F.length(s) >= region(x))
        return _next(x, F.when(ok, F.concat(_cut(w, F.length(s)), F.try_element_at(_table(rules), s))).otherwise(w))

    return lambda x: F.when(_may_end(x["w"], rules), _let(_next(x, x["w"], s=_suffix(x["w"], rules)), swapped)).otherwise(x)


def _begin(low: Column) -> Column:
    """A leading apostrophe goes, y as a consonant is marked."""
    marked = F.regexp_replace(F.regexp_replace(F.regexp_replace(low, "^'", ""), "^y", "Y"), f"(?<={VOWEL})y", "Y")
    return F.when(low.contains("y") | low.startswith("'"), marked).otherwise(low)


def _step_0(b: Column) -> Column:
    return F.struct(b.alias("b"), F.when(b.contains("'"), F.regexp_replace(b, "(?:'s'|'s|')$", "")).otherwise(b).alias("w"))


def _step_1a(x: Column) -> Column:
    w = x["w"]
    y = F.when(F.length(w) > 4, F.lit(2)).otherwise(F.lit(1))
    n = (F.when(w.endswith("sses"), F.lit(2)).when(w.endswith("ies") | w.endswith("ied"), y)
         .when(w.endswith("us") | w.endswith("ss"), F.lit(0))
         .when(_cut(w, 2).rlike(VOWEL), F.lit(1)).otherwise(F.lit(0)))
    return F.when(w.endswith("s") | w.endswith("ied"), _next(x, _cut(w, n))).otherwise(x)


def _step_1b(x: Column) -> Column:
    """The suffix goes, and the rest is mended."""
    return F.when(_may_end(x["w"], STEP1B), _let(_let(_next(x, x["w"], s=_suffix(x["w"], STEP1B)), _without_1b), _mend)).otherwise(x)


def _without_1b(x: Column) -> Column:
    """``fix`` tells whether the rest is to be mended."""
    w, s, rest = x["w"], x["s"], _cut(x["w"], F.length(x["s"]))
    long, gone = s.startswith("eed"), (s != "") & rest.rlike(VOWEL)
    out = (F.when(s == "", w)
           .when(long, F.when(F.length(rest) >= _r1(x), F.concat(rest, F.lit("ee"))).otherwise(w))
           .when(gone, rest).otherwise(w))
    return _next(x, out, fix=~long & gone)


def _mend(x: Column) -> Column:
    w = x["w"]
    return _next(x, F.when(~x["fix"], w).when(_end(w, 2).isin("at", "bl", "iz"), F.concat(w, F.lit("e")))
                 .when(_end(w, 2).isin(*DOUBLES), _cut(w, 1))
                 .when(_short_end(w) & (_r1(x) >= F.length(w)), F.concat(w, F.lit("e"))).otherwise(w))


def _step_1c(x: Column) -> Column:
    w = x["w"]
    return F.when(w.endswith("y") | w.endswith("Y"), _next(x, F.regexp_replace(w, "(?<=.[^aeiouy])[yY]$", "i"))).otherwise(x)


def _not_2(x: Column, w: Column, s: Column) -> Column:
    return ((s == "ogi") & ~w.endswith("logi")) | ((s == "li") & ~w.rlike(f"{LI_ENDING}li$"))


def _not_3(x: Column, w: Column, s: Column) -> Column:
    return (s == "ative") & (F.length(w) - 5 < _r2(x))


def _not_4(x: Column, w: Column, s: Column) -> Column:
    return (s == "ion") & ~(w.endswith("sion") | w.endswith("tion"))


def _step_5(x: Column) -> Column:
    w = x["w"]
    n = F.length(w) - 1
    e = w.endswith("e") & ((n >= _r2(x)) | ((n >= _r1(x)) & ~_short_end(_cut(w, 1))))
    stem = F.when(e | (w.endswith("ll") & (n >= _r2(x))), _cut(w, 1)).otherwise(w)
    return F.translate(stem, "Y", "y")


STEPS = (_step_1b, _step_1c, _swap(dict(STEP2), _r1, _not_2), _swap(dict(STEP3), _r1, _not_3),
         _swap(dict.fromkeys(STEP4, ""), _r2, _not_4), _step_5)


def _after_1a(x: Column) -> Column:
    """All later steps, but for words that are done by then."""
    word = F.array(x)
    for step in STEPS:
        word = F.transform(word, step)
    return F.when(x["w"].isin(*sorted(EXCEPTIONS_AFTER_1A)), F.translate(x["w"], "Y", "y")).otherwise(F.element_at(word, 1))


def _stem(low: Column) -> Column:
    """Short words, exceptions and words no step changes are done at once."""
    word = _let(_let(_let(_begin(low), _step_0), _step_1a), _after_1a)
    changes = (_end(low, 1).isin(*_ENDS1) | _end(low, 2).isin(*_ENDS2) | _end(low, 3).isin(*_ENDS3) | low.contains("'"))
    return (F.when(F.length(low) <= 2, low).when(changes, F.when(low.isin(*sorted(EXCEPTIONS)), F.try_element_at(_table(EXCEPTIONS), low)).otherwise(word))
            .otherwise(low))


def stem_tokens(tokens: Column) -> Column:
    """The stem of every token of an array column."""
    return F.transform(F.transform(tokens, F.lower), _stem)


def stem_token(token: Column) -> Column:
    """The stem of a text column that holds one token."""
    return F.element_at(stem_tokens(F.array(token)), 1)
