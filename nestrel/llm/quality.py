"""Quality by weak supervision; DataFrame functions only.

Rules look at a document and vote good (2), bad (1) or abstain (0). How well each rule
tells good from bad is not given: expectation-maximisation over all documents estimates
the share of good documents and, for each rule, how often it votes what on good and on
bad ones. A document is kept if the posterior probability that it is good reaches
``threshold`` and it passes the base rules. All documents with the same votes have
the same posterior, so the estimation works on the counts of vote patterns, at most
3 ** (number of rules) whatever the size of the corpus.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestrel.llm.common import SPACE, materialize

_WORDLESS = r"[\x20\x09-\x0D]+"


def signals(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id and the counts that rules look at, from the whole text (null: no words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"),
                       F.filter(F.split(text, SPACE), lambda w: w != "").alias("words"))
    # 3-word windows by hash and place, sorted: equal ones become neighbours
    rows = rows.select("doc_id", "text", "words", F.expr("""
        CASE WHEN size(words) < 3 THEN array() ELSE sort_array(transform(
          sequence(0, size(words) - 3),
          i -> struct(xxhash64(words[i], words[i + 1], words[i + 2]) AS h, i AS p))) END""").alias("grams"))
    rows = rows.select("doc_id", "text", "words", F.expr("""
        sort_array(transform(
          filter(grams, (g, i) -> coalesce(g.h = get(grams, i - 1).h, false) OR coalesce(g.h = get(grams, i + 1).h, false)),
          g -> g.p))""").alias("again"),
        F.filter(F.split("text", "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("lines"))

    def chars(pattern: str) -> Column:               # characters that are left without ``pattern``
        return F.length(F.regexp_replace("text", pattern, ""))

    return rows.select(
        "doc_id", F.size("words").cast("long").alias("n_words"),
        chars(_WORDLESS).cast("long").alias("word_chars"),
        chars(r"[^#*$%&|<>]+").cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.expr("""aggregate(transform(again, (p, i) -> least(3, coalesce(get(again, i + 1), p + 3) - p)),
                  0L, (a, x) -> a + x)""").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        chars(r"[^!]+").alias("n_exclaim"), chars(r"[^\p{Lu}]+").alias("n_upper"), chars(r"[^\p{L}]+").alias("n_letters"),
        F.size(F.filter("lines", lambda x: x.rlike(r"[.!?\"”»:;…]\s*$"))).alias("n_ended"))


def votes() -> dict[str, Column]:
    """Rule -> 2 (good), 1 (bad) or 0 (abstains). Thresholds are percentages."""
    c = F.col

    def rule(bad: Column, good: Column) -> Column:
        return F.when(c("n_words") == 0, 0).when(bad, 1).when(good, 2).otherwise(0)

    w = c("n_words")
    return {
        "symbols": rule(c("n_symbols") * 100 > 10 * w, c("n_symbols") * 100 <= w),
        "exclaims": rule(c("n_exclaim") * 100 > 20 * w, c("n_exclaim") * 100 <= 2 * w),
        "capitals": rule(c("n_upper") * 100 > 40 * c("n_letters"), c("n_upper") * 100 <= 15 * c("n_letters")),
        "repeats": rule(c("n_repeat_words") * 100 > 30 * w, c("n_repeat_words") * 100 <= 10 * w),
        "same_lines": rule(c("n_dup_lines") * 100 > 30 * c("n_lines"), c("n_dup_lines") == 0),
        "word_length": rule((c("word_chars") < 3 * w) | (c("word_chars") > 12 * w),
                            (c("word_chars") >= 4 * w) & (c("word_chars") <= 9 * w)),
        "letters": rule(c("n_letters") * 100 < 60 * c("word_chars"), c("n_letters") * 100 >= 85 * c("word_chars")),
        "ended": rule(c("n_ended") * 100 < 20 * c("n_lines"), c("n_ended") * 100 >= 80 * c("n_lines")),
    }


def posteriors(patterns: list[tuple[str, int]], rounds: int = 100) -> dict[str, float]:
    """Expectation-maximisation over vote patterns (a digit per rule) and their counts:
    pattern -> probability that such documents are good.

    It starts from the balance of votes. Every rate carries one document's worth of prior
    that rules are rather right than wrong, which also keeps good and bad from changing
    places and gives a result for few documents or votes that never occur."""
    if not patterns:
        return {}
    k = len(patterns[0][0])
    good = {p: 1 / (1 + math.exp(-3 * (p.count("2") - 2 * p.count("1")) / max(1, k - p.count("0")))) for p, _ in patterns}
    prior = {1: {"0": 0.4, "1": 0.1, "2": 0.5}, 0: {"0": 0.4, "1": 0.4, "2": 0.2}}
    total = sum(n for _, n in patterns)
    for _ in range(rounds):
        mass = {1: sum(n * good[p] for p, n in patterns)}
        mass[0] = total - mass[1]
        rate = [{y: dict(prior[y]) for y in (0, 1)} for _ in range(k)]
        for p, n in patterns:
            for r, v in zip(rate, p):
                r[1][v] += n * good[p]
                r[0][v] += n * (1 - good[p])
        share = (mass[1] + 1) / (total + 2)
        new = {}
        for p, _ in patterns:
            odds = math.log(share) - math.log(1 - share)
            for r, v in zip(rate, p):
                odds += math.log(r[1][v] / (mass[1] + 1)) - math.log(r[0][v] / (mass[0] + 1))
            new[p] = 1 / (1 + math.exp(-max(-500.0, min(500.0, odds))))
        moved = max(abs(new[p] - good[p]) for p, _ in patterns)
        good = new
        if moved < 1e-9:
            break
    return good


def score_quality(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, posterior (that it is good).

    Null, empty and blank texts have no words: every rule abstains and the base rules
    fail. Repeated rows count as often as they come and are scored alike. Null ids come
    back null. Other columns are ignored; no rows give no rows.
    """
    table = materialize(signals(docs, id_col, text_col)
                        .withColumn("pattern", F.concat(*[v.cast("string") for v in votes().values()])), "signals")
    counts = [(r["pattern"], r["n"]) for r in                       # 3 ** rules rows at most
              table.groupBy("pattern").agg(F.count(F.lit(1)).alias("n")).orderBy("pattern").collect()]
    good = posteriors(counts)
    spark = docs.sparkSession
    known = spark.createDataFrame(list(good.items()) or [("", 0.0)], "pattern string, posterior double")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return (table.join(F.broadcast(known), "pattern")
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                    failed.alias("base_failed"), (~failed & (F.col("posterior") >= threshold)).alias("kept"), "posterior"))
