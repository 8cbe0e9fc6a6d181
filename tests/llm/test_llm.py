"""The corpus operators on small hand-made tables: nulls, empty and long texts, ties,
repeated rows, empty tables, extra columns, and brute force where it is cheap."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from nestrel.llm import (
    decontaminate,
    langid,
    linededup,
    minhash,
    packing,
    quality,
    sharding,
    toxicity,
    warc,
)

SCHEMA = "doc_id long, text string, lang string, n_shingles string, size string"
BASE = " ".join(f"w{i}" for i in range(60))
NEAR = BASE.replace("w30", "other")
LONG = " ".join(f"x{i % 977}" for i in range(20000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(5, BASE), (2, BASE.upper()), (9, NEAR), (7, None), (8, ""), (11, " \n\t "), (12, "one two"),
            (13, "one  two"), (5, BASE), (None, BASE), (None, "alone here"), (20, LONG), (21, "¡Ünïcödé! " * 3)]
    return spark.createDataFrame([(i, t, "en", "clash", "clash") for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def words(t):
    return (t or "").encode().lower().split()


def shingles(t, k=5):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def test_near_duplicates(docs, empty):
    got = {}
    for r in minhash.near_duplicates(docs).collect():
        got.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in got[5]] == [2, 2] and not any(r.kept for r in got[5])
    assert got[2][0].kept and got[9][0].component_id == 2 and got[9][0].n_links == 1
    assert all(got[i][0].n_shingles == 0 and got[i][0].kept and got[i][0].component_id == i for i in (7, 8, 11))
    assert got[13][0].component_id == 12 and got[12][0].n_shingles == 1
    assert sorted((r.component_id, r.kept) for r in got[None] if r.component_id) == [(2, False)]
    assert got[20][0].n_shingles == len(shingles(LONG))
    assert minhash.near_duplicates(empty).count() == 0


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(50, 51)], "a long, b long")
    nodes = spark.range(60).select(F.col("id").alias("node"))
    got = {r.node: r.component for r in minhash.components(nodes, links).collect()}
    assert all(got[i] == 0 for i in range(31)) and got[51] == 50 and got[59] == 59


def test_packing(docs, empty):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack(docs).collect()
    assert sum(r.length for r in rows if r.doc_id == 7) == 1
    by_doc, by_seq = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for doc, text in ((2, BASE.upper()), (20, LONG), (21, "¡Ünïcödé! " * 3), (11, " \n\t ")):
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for pieces in by_seq.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 1024 and at & (at - 1) == 0
    assert packing.pack(empty).count() == 0


def test_level_choice_is_least_sum_of_squares():
    rng = np.random.default_rng(3)
    p = packing.Packer(16, 0)
    for _ in range(300):
        p.counts = rng.integers(0, 4, 17) * (rng.random(17) < 0.6)
        p.counts[0] = p.counts[16] = 0
        size = int(rng.integers(1, 16))

        def squares(h):
            c = p.counts.copy()
            if h:
                c[h] -= 1
            if h + size < 16:
                c[h + size] += 1
            return int((c ** 2).sum())

        able = [0, *(h for h in range(1, 17 - size) if p.counts[h])]
        assert squares(p.level_for(size)) == min(map(squares, able))


def test_sharding(docs, empty):
    rows = sharding.shard_bytes(docs, k=3).collect()
    assert len(rows) == 13 and {r.law for r in rows} == {"bytes"}
    for s in {r.shard for r in rows}:
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    assert len({r.shard for r in rows if r.doc_id == 5}) == 1
    assert [(r.size, r.text_crc32) for r in rows if r.doc_id == 7] == [(16, 0)]
    assert sharding.shard_bytes(empty).count() == 0


def test_minimax_cuts(spark):
    rng = np.random.default_rng(5)
    sizes = rng.choice([1, 5, 17, 200, 4000], 1500)
    ends = np.cumsum(sizes)

    def cuts(capacity):
        out, at, total = [], 0, 0
        for s in map(int, sizes):
            if total + s - at > capacity:
                out.append(total)
                at = total
            total += s
        return [*out, total]

    best = next(c for c in range(int(sizes.max()), int(ends[-1])) if len(cuts(c)) <= 40)
    df = spark.createDataFrame([(int(e),) for e in ends], "total_end long")
    assert sharding.minimax_cuts(df, int(ends[-1]), 40, blocks=64) == cuts(best)


def test_line_runs(spark, empty):
    a, b, c = (" ".join(f"{x}{i}" for i in range(6)) for x in "abc")
    rows = [(1, f"{a}\n{b}\nmine"), (2, f"top\n{a}\n\n{b}\nend"), (3, f"{a}\nsingle\n{b}"), (4, None), (5, ""),
            (6, "\n".join([a + " " + b] * 4)), (7, f"{c}\nshort"), (8, f"{c}\nshort"), (None, "x")]
    df = spark.createDataFrame([(i, t, "en", "c", "c") for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in linededup.delete_repeated_runs(df, counts=("n", "g")).collect()}
    assert got[1].text == f"{a}\n{b}\nmine" and got[2].text == "top\n\nend" and got[2].g == 2
    assert got[3].text == f"{a}\nsingle\n{b}" and got[4].text is None and got[5].text == ""
    assert got[6].text == a + " " + b and got[6].g == 3
    assert got[8].text == f"{c}\nshort"             # seven words: below ten
    assert linededup.delete_repeated_runs(empty).count() == 0


def test_warc(spark, scratch):
    big = "é WARC/1.1\r\n\r\nWARC/1.1\r\nx" * 6000
    rows = [(1, "u", big), (2, None, big), (3, "u v\r\nX: y", None), (4, "u", "small"), (5, "u", "small"),
            (6, "u", "q" * 1000), (6, "u", "q" * 1000), (None, "u", "q" * 1000), (9, "u", "z" * 70000), (9, "u", "z" * 70000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, chunk_no int")
    got = sorted(((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in
                  warc.archive(df, scratch + "/warc", chunk_bytes=1 << 14).collect()), key=str)
    n = len(big.encode())
    assert got == sorted([(1, n, "revisit", 2), (2, n, "response", None), (3, 0, "response", None),
                          (4, 5, "response", None), (5, 5, "response", None), (6, 1000, "response", None),
                          (6, 1000, "response", None), (None, 1000, "revisit", 6), (9, 70000, "response", None),
                          (9, 70000, "response", None)], key=str)
    assert b"".join(warc.cut(big.encode(), 1000)) == big.encode()
    assert warc.archive(df.limit(0), scratch + "/none").count() == 0


def test_language(spark, docs, empty):
    en, de = "the house is by the water and the trees", "das haus ist an dem wasser und den bäumen"
    rows = [(i, (en if i % 2 else de) + f" {i}", "en" if i % 2 else "de") for i in range(200)] + [(500, None, "en"), (501, "12 !", "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in langid.identify(df).collect()}
    assert all(got[i].lang_pred == ("en" if i % 2 else "de") and got[i].score > 0.9 for i in range(200))
    assert got[0].held_out == (zlib.crc32(b"0") % 3 == 1)
    assert {got[500].lang_pred, got[501].lang_pred} == {"und"} and got[500].score == 0
    assert langid.identify(docs).count() == 13
    assert langid.identify(empty).count() == 0


def test_decontamination(spark, empty):
    item = "A train with 12 cars leaves the old station for Berlin and Berlin is 300 km away from that station today"
    other = item.replace("12", "40").replace("Berlin", "Madrid").replace("300", "700")
    torn = item.replace("for Berlin", "for Madrid")
    bench = spark.createDataFrame([(1, item), (2, None), (3, "")], "item_id long, text string")
    rows = [(1, f"so. {item} and on"), (2, other), (3, torn), (4, None), (5, "A train left"), (None, item)]
    df = spark.createDataFrame([(i, t, "en", "c", "c") for i, t in rows], SCHEMA)
    got = {r.doc_id: r for r in decontaminate.decontaminate(df, bench).collect()}
    assert got[1].contaminated and got[1].item_id == 1
    assert got[2].contaminated and got[2].match == "reparameterised"
    assert not any(got[i].contaminated for i in (3, 4, 5, None))
    assert decontaminate.decontaminate(empty, bench).count() == 0
    assert not decontaminate.decontaminate(df, bench.limit(0)).where("contaminated").count()


def test_quality_counts(spark, empty):
    text = "a b c a b c x\n#one two\n#one two\n\n"
    df = spark.createDataFrame([(1, text, "", "", ""), (2, None, "", "", ""), (3, BASE, "", "", ""), (None, "", "", "", "")], SCHEMA)
    got = {r.doc_id: r for r in quality.score_quality(df).collect()}
    r = got[1]
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (11, 21, 2, 1, 6)
    assert got[2].n_words == 0 and got[2].base_failed and not got[2].kept and got[3].n_words == 60
    assert quality.score_quality(empty).count() == 0


def test_posteriors_find_the_better_rules():
    counts = [("222", 700), ("221", 60), ("111", 150), ("112", 40), ("000", 50)]
    good = quality.posteriors(counts)
    assert good["222"] > 0.95 and good["111"] < 0.05 and good["221"] > good["112"]
    assert quality.posteriors([]) == {}


def within_one(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    if len(a) > len(b):
        a, b = b, a
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def test_automaton_against_edit_distance():
    import random
    rng, terms = random.Random(2), ["idiot", "moron", "scum", "loserly"]
    auto = toxicity.Automaton(terms)
    table = auto.symbols()
    for _ in range(3000):
        w = list(rng.choice(terms))
        for _ in range(rng.randrange(3)):
            i = rng.randrange(len(w))
            w[i:i + 1] = rng.choice(([], ["q"], [w[i], "o"], ["r"]))
            if not w:
                break
        w = "".join(w) or "q"
        code = table[np.array([ord(c) for c in w])]
        got = auto.match(code, np.array([0]), np.array([len(w)]))[0]
        want = 2 if w in terms else 1 if any(len(t) >= 5 and within_one(w, t) for t in terms) else 0
        assert got == want, w


def test_toxicity(spark, docs, empty):
    rows = [(i, f"plain words number {i} here" + (" utter scumbag fool" if i % 5 == 0 else "")) for i in range(400)]
    df = spark.createDataFrame([*rows, (900, "a scumbqg"), (901, None), (902, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(400)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in toxicity.score_toxicity(df, labels).collect()}
    assert all(got[i].predicted == (i % 5 == 0) for i in range(400))
    assert got[901].score == got[902].score < 0.3 and got[900].score > got[901].score
    assert toxicity.score_toxicity(docs, labels.limit(0)).count() == 13
    assert toxicity.score_toxicity(empty, labels).count() == 0
