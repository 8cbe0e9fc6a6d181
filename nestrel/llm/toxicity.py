"""Toxicity: a Levenshtein automaton over a lexicon trie, and the words around its hits.

The lexicon is learned: words of labelled toxic texts whose association with the label
passes a likelihood-ratio test held to the number of words tested. Its trie is
intersected with the automata of all strings within one edit of each longer term
(distance 0 for short ones); the subset construction gives one deterministic table
(state, character) -> state. Tasks run it over all words of a batch at once, and over
words masked by inner punctuation, with it as a letter and without it. Around
each hit a window of words is scored: quotation marks and words of reporting speak
for quotation, words of address for abuse. A logistic regression on a text's hits and
window scores gives the score.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from nestrel.llm.common import fold, materialize
from nestrel.llm.langid import parts

# Words near a hit, in lower case, that speak for quotation or for address.
REPORTING = set("said says wrote writes quote quoted quotes word words term terms called calls meaning means "
                "dijo escribió cita citó palabra término dit écrit cite mot terme sagte schrieb zitat wort begriff".split())
ADDRESS = set("you your yours yourself u ur tu tú te usted ustedes vosotros toi vous votre du dich dein dir ihr euch "
              "sie".split())
QUOTES = set("\"'`“”„‘’«»‹›")
WINDOW = 4
N_FEATURES = 7


class Automaton:
    """Deterministic automaton of all strings within ``limit(term)`` edits of a term.
    State 0 is dead, 1 the start; ``accept``: 0 no, 1 within the limit, 2 a term itself;
    ``near``: 1 within one edit of a term of any length."""

    def __init__(self, terms: list[str], short: int = 5):
        children: list[dict[str, int]] = [{}]
        limit: dict[int, int] = {}
        for term in terms:
            node = 0
            for c in term:
                if c not in children[node]:
                    children.append({})
                    children[node][c] = len(children) - 1
                node = children[node][c]
            limit[node] = 1 if len(term) >= short else 0
        self.alphabet = {c: i + 1 for i, c in enumerate(sorted({c for t in terms for c in t}))}   # 0: any other

        def closed(states: dict[int, int]) -> frozenset:
            todo = list(states)
            while todo:                              # a term's letter left out of the text
                node = todo.pop()
                if states[node] < 1:
                    for child in children[node].values():
                        if states.get(child, 2) > states[node] + 1:
                            states[child] = states[node] + 1
                            todo.append(child)
            return frozenset(states.items())

        start = closed({0: 0})
        number = {frozenset(): 0, start: 1}
        table, order = [[0] * (len(self.alphabet) + 1)], [start]
        for state in order:
            row = []
            for c in (None, *self.alphabet):
                to: dict[int, int] = {}
                for node, e in state:
                    if c in children[node]:
                        to[children[node][c]] = min(e, to.get(children[node][c], 2))
                    if e < 1:                        # another letter, or one too many
                        for child in (*children[node].values(), node):
                            to[child] = min(e + 1, to.get(child, 2))
                nxt = closed(to)
                if nxt not in number:
                    number[nxt] = len(number)
                    order.append(nxt)
                row.append(number[nxt])
            table.append(row)
        self.table = np.array(table, dtype=np.int32)
        self.accept = np.zeros(len(table), dtype=np.int8)
        for state in order:
            best = max((2 if e == 0 else 1 for node, e in state if e <= limit.get(node, -1)), default=0)
            self.accept[number[state]] = best
        self.near = np.zeros(len(table), dtype=np.int8)
        for state in order:
            self.near[number[state]] = any(node in limit for node, _ in state)

    def symbols(self) -> np.ndarray:
        """Code point -> column of the table, -1 outside words, -2 for white space."""
        out = np.where(np.frombuffer(bytes(chr(i).isalnum() for i in range(0x110000)), dtype=bool), 0, -1).astype(np.int16)
        for c, i in self.alphabet.items():
            out[ord(c)] = i
        out[[i for i in range(0x110000) if chr(i).isspace()]] = -2
        return out

    def match(self, symbol: np.ndarray, starts: np.ndarray, ends: np.ndarray,
              accept: np.ndarray | None = None) -> np.ndarray:
        """For each word [start, end) of a symbol array: 0, 1 or 2."""
        accept = self.accept if accept is None else accept
        out = np.zeros(len(starts), dtype=np.int8)
        word = np.arange(len(starts))
        state, at, end = np.ones(len(starts), dtype=np.int32), starts.copy(), ends
        while len(word):
            state = self.table[state, symbol[at]]
            at = at + 1
            done = at == end
            out[word[done]] = accept[state[done]]
            live = ~done & (state > 0)
            word, state, at, end = word[live], state[live], at[live], end[live]
        return out


def unmasked(automaton: Automaton, symbol: np.ndarray, starts: np.ndarray, ends: np.ndarray, hit: np.ndarray):
    """Words and hits, where pieces with only punctuation between them are one word if none
    of them is a hit and they are one together: with one mark that stands for a letter or
    between two (the one edit of a term of any length), or without all marks."""
    blank = np.cumsum(symbol == -2)
    first = np.concatenate(([0], np.flatnonzero(blank[starts[1:]] > blank[ends[:-1] - 1]) + 1))
    after = np.concatenate((first[1:], [len(starts)]))
    some = np.flatnonzero((after - first > 1) & (np.maximum.reduceat(hit, first) == 0))
    a, b = starts[first[some]], ends[after[some] - 1]
    place = np.cumsum(symbol >= 0)
    found = (automaton.match(np.maximum(symbol, 0), a, b, automaton.near)
             | automaton.match(symbol[symbol >= 0], place[a] - 1, place[b - 1])) > 0
    if not found.any():
        return starts, ends, hit
    ends, hit, keep = ends.copy(), hit.copy(), np.ones(len(starts), dtype=bool)
    for i in some[found]:
        ends[first[i]], hit[first[i]] = ends[after[i] - 1], 1
        keep[first[i] + 1:after[i]] = False
    return starts[keep], ends[keep], hit[keep]


def features(texts: list[str | None], automaton: Automaton, symbol_of: np.ndarray) -> np.ndarray:
    """Per text: has a term, log terms, has a misspelling, log misspellings, share of hits in
    quotation, share with address, log of hits per hundred words."""
    lowered = [(t or "").lower() for t in texts]
    code = np.frombuffer(("\n".join(lowered) + "\n").encode("utf-32-le", "replace"), dtype=np.uint32)
    symbol = symbol_of[code]
    inside = symbol >= 0
    edge = np.flatnonzero(np.diff(np.concatenate(([0], inside.view(np.int8), [0]))))
    starts, ends = edge[::2], edge[1::2]
    out = np.zeros((len(texts), N_FEATURES))
    if not len(starts):
        return out
    starts, ends, hit = unmasked(automaton, symbol, starts, ends, automaton.match(symbol, starts, ends))
    owner = np.searchsorted(np.cumsum([len(t) + 1 for t in lowered]), starts, side="right")
    n_words = np.bincount(owner, minlength=len(texts))
    exact = np.bincount(owner[hit == 2], minlength=len(texts))
    near = np.bincount(owner[hit == 1], minlength=len(texts))
    quoted, address = np.zeros(len(texts)), np.zeros(len(texts))
    word = lambda i: code[starts[i]:ends[i]].tobytes().decode("utf-32-le")
    for i in np.flatnonzero(hit):
        d = owner[i]
        lo, hi = max(0, i - WINDOW), min(len(starts), i + WINDOW + 1)
        around = {word(j) for j in range(lo, hi) if j != i and owner[j] == d}
        next_to = {chr(c) for c in (*code[max(0, starts[i] - 1):starts[i]], *code[ends[i]:ends[i] + 1])}
        quoted[d] += bool(next_to & QUOTES) or bool(around & REPORTING)
        address[d] += bool(around & ADDRESS)
    hits = np.maximum(1, exact + near)
    out[:, 0], out[:, 1], out[:, 2], out[:, 3] = exact > 0, np.log1p(exact), near > 0, np.log1p(near)
    out[:, 4], out[:, 5] = quoted / hits, address / hits
    out[:, 6] = np.log1p(100 * (exact + near) / np.maximum(1, n_words))
    return out


def learn_lexicon(sample: DataFrame) -> list[str]:
    """All words that stand in toxic texts more often than chance allows, most frequent first.
    Their number follows from the labelled sample, which is bounded."""
    size = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = size.get(1, 0), size.get(0, 0)
    if not n1:
        return []
    words = F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(r"[\p{L}\p{N}]+"), 0))
    by_word = (sample.select("toxic", F.explode(words).alias("w")).groupBy("w")
               .agg(F.sum("toxic").alias("k1"), F.sum(1 - F.col("toxic")).alias("k0"))
               .where("k1 >= 2"))
    by_word = materialize(by_word, "words")
    tested = max(2, by_word.count())
    base = n1 / max(1, n1 + n0)
    n = F.col("k1") + F.col("k0")
    term = lambda k, p: F.when(k > 0, k * F.log(k / (n * p))).otherwise(0.0)
    ratio = 2 * (term(F.col("k1"), base) + (term(F.col("k0"), 1 - base) if n0 else F.lit(0.0)))
    got = (by_word.where((ratio >= 2 * math.log(tested) + 2) & (F.col("k1") > 9 * F.col("k0") * (n1 / max(1, n0))))
           .orderBy(F.desc("k1"), "w").select("w").collect())
    return [r["w"] for r in got]


def fit(x: np.ndarray, y: np.ndarray, penalty: float = 0.1, rounds: int = 30) -> np.ndarray:
    """Logistic regression by Newton's method; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    keep = np.full(len(w), penalty)
    keep[-1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + np.diag(keep)
        step = np.linalg.solve(h, x.T @ (y - p) - keep * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _feature_rows(rows: DataFrame, automaton: Automaton, weights: np.ndarray | None) -> DataFrame:
    """key column as it is, and the features, or the score where there are weights."""
    shared = rows.sparkSession.sparkContext.broadcast((automaton, weights))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto, w = shared.value
        symbol_of = auto.symbols()
        for batch in batches:
            for ids, texts in parts(batch.column(0), batch.column(1)):
                x = features(texts, auto, symbol_of)
                if w is None:
                    yield pa.RecordBatch.from_arrays([ids, pa.array(list(x))], names=["key", "x"])
                else:
                    z = np.column_stack([x, np.ones(len(x))]) @ w
                    yield pa.RecordBatch.from_arrays([ids, pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))],
                                                     names=["key", "score"])

    return rows.mapInArrow(task, "key long, " + ("x array<double>" if weights is None else "score double"))


def train(docs: DataFrame, labels: DataFrame, toxic_rows: int = 10_000, clean_rows: int = 20_000,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[Automaton, np.ndarray]:
    """Automaton and weights, from at most about ``toxic_rows`` and ``clean_rows`` labelled
    documents outside the held-out fold (those whose hashed id is smallest)."""
    known = (labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~fold("doc_id", 4, 2))
             .groupBy(F.col("doc_id").cast("long").alias("key")).agg(F.max("toxic").cast("int").alias("toxic")))
    size = {r[0]: r[1] for r in known.groupBy("toxic").count().collect()}
    spot = F.pmod(F.xxhash64("key", F.lit("toxic")), F.lit(1_000_003)) / 1_000_003.0
    share = F.when(F.col("toxic") == 1, toxic_rows / max(1, size.get(1, 0))).otherwise(clean_rows / max(1, size.get(0, 0)))
    some = known.where(spot < share)                # about toxic_rows + clean_rows ids: safe to broadcast
    sample = materialize(
        docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
        .join(F.broadcast(some), "key"), "sample")
    automaton = Automaton(learn_lexicon(sample))
    got = (_feature_rows(sample.select("key", "text"), automaton, None)
           .join(F.broadcast(some), "key").select("x", "toxic").toPandas())
    if len(got) == 0:
        return automaton, np.zeros(N_FEATURES + 1)
    x, y = np.stack(got["x"]), got["toxic"].to_numpy(dtype=float)
    # weights undo the sampling: every class counts as often as it is labelled
    rare = {t: max(1, size.get(t, 0)) / max(1, (y == t).sum()) for t in (0, 1)}
    w = fit(x, y)
    w[-1] += math.log(rare[1] / rare[0])
    return automaton, w


def score_toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
                   text_col: str = "text", **bounds) -> DataFrame:
    """doc_id, held_out, score, predicted for every row, from the whole text alone.

    Null and empty texts have no hits and the score of such texts. Rows with null ids are
    scored, never trained on and not held out. Of several labels of one id the larger counts;
    other labels than 0 and 1 are not used. Without labels every score is 0.5. Repeated
    rows score alike; other columns are ignored; no rows give no rows.
    """
    model = train(docs, labels, id_col=id_col, text_col=text_col, **bounds)
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    out = _feature_rows(rows, *model)
    return out.select(F.col("key").alias("doc_id"), fold("key", 4, 2).alias("held_out"), "score",
                      (F.col("score") >= threshold).cast("int").alias("predicted"))
