"""Text -> lexeme normalisers for full-text search, as Column expressions.

Three normalisers share one interface, ``lexemes(text, kind)``:

``exact``   lowercase, split on every non letter/digit run, drop stop words.
``light``   ``exact`` then suffix rules (plural ``-sses/-ies/-s``; ``-eed``;
            ``-ed`` / ``-ing`` when the stem has a vowel, then ``at/bl/iz`` ->
            ``+e`` and undoubling of a final double consonant). Built-in
            expressions only, so an independent SQL engine reproduces it.
``porter2`` ``exact`` then the Snowball English stemmer, as built-in expressions too
            (``nestrel.functions.porter2``).

A query term goes through the same expression as the documents (Catalyst
folds the literal), so document and query normalisation cannot drift apart.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column
from pyspark.sql import functions as F

# The English stop-word list of the text-search configuration
# the workload used (the Snowball English list), in its published order.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves "
    "he him his himself she her hers herself it its itself they them their "
    "theirs themselves what which who whom this that these those am is are "
    "was were be been being have has had having do does did doing a an the "
    "and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in "
    "out on off over under again further then once here there when where why "
    "how all any both each few more most other some such no nor not only own "
    "same so than too very s t can will just don should now"
).split()

TOKEN_SPLIT = r"[^\p{L}\p{N}]+"

# Light-stemmer patterns.
VOWEL = "[aeiou]"
VOWEL_CONSONANT = "[aeiou][^aeiou]"
DOUBLE_END = "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx)$"
ADD_E_END = "(at|bl|iz)$"


def _cut(w: Column, n: int) -> Column:
    """w without its last n characters."""
    return w.substr(F.lit(1), F.length(w) - F.lit(n))


def _step_1a(w: Column) -> Column:
    return (F.when(w.rlike("sses$"), _cut(w, 2))
            .when(w.rlike("ies$"), _cut(w, 2))
            .when(w.rlike("ss$"), w)
            .when(w.rlike("s$") & (F.length(w) > 1), _cut(w, 1))
            .otherwise(w))


def _fixup(v: Column) -> Column:
    return (F.when(v.rlike(ADD_E_END), F.concat(v, F.lit("e")))
            .when(v.rlike(DOUBLE_END), _cut(v, 1))
            .otherwise(v))


def _step_1b(w: Column) -> Column:
    """Cut -eed/-ed/-ing; the result says whether the fix-up step applies."""
    def r(stem, fix):
        return F.struct(stem.alias("s"), F.lit(fix).alias("f"))
    return (F.when(w.rlike("eed$"),
                   F.when(_cut(w, 3).rlike(VOWEL_CONSONANT), r(_cut(w, 1), False)).otherwise(r(w, False)))
            .when(w.rlike("ed$") & _cut(w, 2).rlike(VOWEL), r(_cut(w, 2), True))
            .when(w.rlike("ing$") & _cut(w, 3).rlike(VOWEL), r(_cut(w, 3), True))
            .otherwise(r(w, False)))


def light_stems(toks: Column) -> Column:
    """Light stem of every token of an array. Each step is its own
    ``transform`` so every rule refers to one lambda variable (the expression
    stays linear in size instead of nesting whole steps into each other)."""
    s1 = F.transform(toks, _step_1a)
    s2 = F.transform(s1, _step_1b)
    return F.transform(s2, lambda x: F.when(x.getField("f"), _fixup(x.getField("s"))).otherwise(x.getField("s")))


def _stop_array(stop_words=ENGLISH_STOP_WORDS) -> Column:
    # one literal split into an array (constant-folded): "" plus the stop words
    return F.split(F.lit("|" + "|".join(stop_words)), r"\|")


def without_stop_words(toks: Column, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """Distinct tokens that are neither empty nor stop words (one hash-based
    ``array_except``)."""
    return F.array_except(toks, _stop_array(stop_words))


def lexemes(text: Column, kind: str = "exact") -> Column:
    """Distinct lexemes of a text (a set: positions are never used).

    ``array_except`` drops empty tokens and stop words and de-duplicates in
    one built-in expression, so stemming runs once per distinct token of a
    document, not once per occurrence.
    """
    distinct_tokens = without_stop_words(F.split(F.lower(text), TOKEN_SPLIT))
    if kind == "exact":
        return distinct_tokens
    if kind == "light":
        return F.array_distinct(light_stems(distinct_tokens))
    if kind == "porter2":
        from nestrel.functions.porter2 import stem_tokens
        return F.array_distinct(stem_tokens(distinct_tokens))
    raise ValueError(f"unknown normaliser {kind!r}")


def query_terms(query: str) -> list[str]:
    """Terms of an OR query ``'a | b'`` (the only operators the workload uses)."""
    return [t.strip() for t in query.split("|") if t.strip()]


def query_lexemes(query: str, kind: str = "exact") -> Column:
    """Lexemes of an OR query as an expression (every term normalised exactly
    like documents). Use ``query_lexeme_list`` to fold it to literals."""
    parts = [lexemes(F.lit(t), kind) for t in query_terms(query)]
    return F.array_distinct(F.flatten(F.array(*parts)))


def query_lexeme_list(query: str, kind: str = "exact") -> list[str]:
    """The query's lexemes, computed once by Spark with the very expression
    used for documents (a one-row evaluation). Catalyst does not fold
    higher-order functions, so without this the query would be re-normalised
    on every row. The result depends only on (query, kind), so it is memoised."""
    return list(_query_lexemes_cached(query, kind))


@functools.lru_cache(maxsize=1024)
def _query_lexemes_cached(query: str, kind: str) -> tuple[str, ...]:
    from pyspark.sql import SparkSession
    spark = SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()
    row = spark.range(1).select(query_lexemes(query, kind).alias("q")).first()
    return tuple(sorted(row["q"] or []))


def _literal_array(values: list[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def _prefix_filter(text: Column, lexes: list[str]) -> Column:
    """A necessary condition for a match, cheap enough to run first.

    For ``exact`` and ``light`` every lexeme minus its last character is a
    prefix of the token it came from (suffixes are only cut, then at most one
    ``e`` is appended or one doubled letter dropped), and the token is a
    substring of the lowercased text. So a text can only match if it contains
    one of those prefixes: a few ``instr`` calls, inside generated code.
    """
    low = F.lower(text)
    cond = F.lit(False)
    for p in sorted({w[:-1] if len(w) > 1 else w for w in lexes}):
        cond = cond | (F.instr(low, p) > 0)
    return cond


def matches(text: Column, query: str, kind: str = "exact") -> Column:
    """``to_tsquery(query) @@ to_tsvector(text)`` for OR and single-term queries.

    NULL text gives NULL (a filter drops it), as in the relational engine.
    The query is normalised once; for ``exact`` / ``light`` a substring
    pre-filter decides most rows before the lexeme set is built.
    """
    lexes = query_lexeme_list(query, kind)
    if not lexes:
        test = F.lit(False)
    else:
        full = F.arrays_overlap(lexemes(text, kind), _literal_array(lexes))
        test = F.when(_prefix_filter(text, lexes), full).otherwise(F.lit(False)) \
            if kind in ("exact", "light") else full
    return F.when(text.isNull(), F.lit(None).cast("boolean")).otherwise(test)
