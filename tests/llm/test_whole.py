"""Rows that earlier versions of the corpus operators did not look at in full."""

import random
import zlib

import numpy as np

from nestrel.llm import decontaminate, packing, toxicity


def test_packing_of_added_tokens_and_long_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x" + " " * 1_000_000 + "y", "\n" * 1_000_000, "a <|endoftex b"]
    rows = packing.pack(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    for i, text in enumerate(texts):
        ids = np.array([*tok.encode(text, add_special_tokens=False).ids, 0], dtype="<u4")
        at = 0
        for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)


LONG_ITEM = ("A wagon with 14 barrels leaves the old harbour near Lisbon before dawn and the road from Lisbon to the "
             "market is 90 km long so how many barrels arrive when every second barrel is lost")


def found(spark, items, texts, **options):
    """Numbers of the texts that leak one of the items."""
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id for r in decontaminate.leaks(docs, bench, **options).collect()}


def test_leaks_count_the_other_windows_of_torn_alignments(spark):
    other = LONG_ITEM.replace("14", "33").replace("Lisbon", "Porto").replace("90", "75")
    texts = [LONG_ITEM.replace("near Lisbon", "near Porto"),            # one of two equal names changed
             "so we say " + other.replace("near Porto", "near Faro"),   # other values, one of them torn
             " ".join(LONG_ITEM.split()[::-1])]
    assert found(spark, [LONG_ITEM], texts) == {0, 1}


def test_leaks_of_windows_with_few_words(spark):
    items = ["Compute 12 + 30 - 7.", "3 km 4 kg 5 ml 6 mm 7 cm of", "17"]
    texts = ["They asked: compute 12 + 30 - 7. Nothing else", "compute 12 + 30 - 8",
             "then 3 km 4 kg 5 ml 6 mm 7 cm of rope", "then 3 km 4 kg 5 ml 6 mm 7 cm and 2 mm of rope", "about 17", "about 18"]
    got = found(spark, items, texts)
    # the first item has one word only, and is found with other numbers, too
    assert {0, 1, 2, 4} <= got and 5 not in got


def test_reparameterised_questions_are_found_by_templates_alone(spark):
    rng = random.Random(4)
    names, things = "Anna Boris Clara David Elena Felix Greta Hugo".split(), "apples books coins pears stamps shells tickets marbles".split()
    shapes = ["{0} has {3} {2} and gives {4} of them to {1} before the market closes, how many {2} does {0} keep",
              "A train from {0}town travels {3} km in {4} hours. How long does it take for {5} km at the same speed",
              "Compute {3} + {4} - {5}.", "The farmer {1} sells {3} {2} at {4} euros each and buys {5} {2} back from {0} later that day"]

    def question(shape, rng):
        a, b = rng.sample(names, 2)
        return shape.format(a, b, rng.choice(things), *(rng.randrange(2, 900) for _ in range(3)))

    items = [question(s, random.Random(i)) for i, s in enumerate(shapes)]
    thing = {i: next((t for t in things if t in x), "") for i, x in enumerate(items)}
    leaks = []
    for k in range(80):
        i = k % len(shapes)
        text = question(shapes[i], rng)
        for t in things:                               # things are words, not slots: they stay
            text = text.replace(t, thing[i]) if thing[i] else text
        leaks.append(f"so we wonder whether it rains today\n{text}\nand then nothing else was said at all")
    clean = [" ".join(rng.choice(["river", "market", "says", "long", "3", "Anna", "km", "the", "before", "17"]) for _ in range(60))
             for _ in range(80)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(leaks + clean)), "doc_id long, text string")
    rows = decontaminate.decontaminate(docs, bench).collect()
    hit = [r for r in rows if r.contaminated]
    assert not [r for r in hit if r.doc_id >= 80]
    assert len(hit) >= 72 and all(r.item_id == r.doc_id % 4 for r in hit)
    assert sum(r.match == "reparameterised" for r in hit) >= 0.9 * len(hit) and all(r.by_template > 0 for r in hit)


def test_leaks_whatever_begins_a_sentence_or_line(spark):
    item = "Alice has 3 apples. Bob has 5 pears. Carol has 9 plums."
    road = "The slow train to Vienna passes Salzburg and then Linz before it stops in Graz for the night"
    texts = [item.replace("Alice", "Dora").replace("Bob", "Emil").replace("Carol", "Fritz").replace("3", "4"),
             item.lower(), item.replace(" ", "\n"), road.lower(),
             "So many say: " + road.replace(" Salzburg", "\nParis").replace("Vienna", "Rome").replace("Linz", "Nice"),
             "Alice had 3 apples. Bob had 5 pears. Carol had 9 plums."]
    assert found(spark, [item, road], texts) == {0, 1, 2, 3, 4}


def test_leaks_of_a_verbatim_run_below_the_share(spark):
    words = [f"word{'abcdefghij'[i // 10]}{'abcdefghij'[i % 10]}" for i in range(60)]
    texts = [" ".join(["before", *words[20:33], "after"]), " ".join(["before", *words[20:32], "after"]),
             " ".join([*words[20:31], "gap", *words[31:42]])]
    assert found(spark, [" ".join(words)], texts) == {0}
    assert found(spark, [" ".join(words)], texts, run=12) == {0, 1}


def test_toxicity_of_masked_words():
    auto = toxicity.Automaton(["idiot", "moron", "scum"])
    texts = ["a mor*n here", "an i.d.i.o.t here", "you s*um", "sc-um", "s.c.u.m you", "a m.o.r*n", "plain and/or well-known",
             "(moron)", "idiot/moron", "s**m or ****", "scam sc am", "a s*\num"]
    x = toxicity.features(texts, auto, auto.symbols())
    assert (x[:, 2] > 0).tolist() == [True] * 6 + [False] * 6
    assert (x[:, 0] > 0).tolist() == [False] * 7 + [True] * 2 + [False] * 3
    assert x[2, 5] == x[4, 5] == 1 and x[1, 5] == 0             # 'you' is an address, a piece of the word is not


def test_toxicity_keeps_rare_terms(spark):
    word = lambda i: "vile" + "abcdefghij"[i // 100] + "abcdefghij"[i // 10 % 10] + "abcdefghij"[i % 10]
    rows = [(i, f"plain words here {word(i // 12)} {word(i // 12)}" if i < 6000 else "plain words here", int(i < 6000))
            for i in range(18000)]
    df = spark.createDataFrame(rows, "key long, text string, toxic int")
    assert toxicity.learn_lexicon(df) == sorted(word(i) for i in range(500))


def test_language_stage_without_labels(spark):
    import corpus_pipeline

    df = spark.createDataFrame([(1, "some words", None), (2, None, None), (3, "12", None)], "doc_id long, text string, lang string")
    assert {r.doc_id for r in corpus_pipeline.language(spark, df, "").collect()} == {1, 2, 3}
