"""The pipeline and the licence scan against plain Python versions of what they compute."""

import math
import os
import random
import sys
import zlib
from collections import Counter
from itertools import groupby

import numpy as np
import regex
from pyspark.ml.feature import HashingTF

from nestrel.llm import licenses
from nestrel.llm.decontaminate import NAME, NUM, UNIT, UNITS
from nestrel.llm.queries import op3_licenses
from tests.conftest import SF_SMALL

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

WORD = regex.compile(r"[^\x20\x09-\x0D]+")
EN = ("river stone window garden letter morning silver winter bridge market teacher engine forest candle harbour "
      "mountain little kitchen yellow thunder journey captain village shoulder whisper feather the and with from").split()
DE = ("straße brücke garten fenster lehrer winter dorf kerze wolke schlüssel zeitung schatten mädchen bäume "
      "küche gewitter reise hauptmann flüstern feder und mit von der die das über schnee zwischen möglich").split()
ITEM = ("A wagon with 14 barrels leaves the old harbour near Lisbon before dawn and the road from Lisbon to the "
        "market is 90 km long so how many barrels arrive when every second barrel is lost")


def prose(rng, words, n):
    return " ".join(rng.choice(words) + (str(rng.randrange(100)) if rng.random() < 0.2 else "") for _ in range(n))


def documents():
    rng = random.Random(11)
    rows = [(i, prose(rng, EN if i % 2 else DE, 60), "en" if i % 2 else "de") for i in range(100, 160)]
    base = prose(rng, EN, 60).split()
    for i, at in enumerate((None, 10, 30, 50)):             # near copies of one text
        rows.append((30 - i, " ".join(w if j != at else "changed" for j, w in enumerate(base)), "en"))
    run = prose(rng, EN, 7) + "\n" + prose(rng, EN, 8)
    rows += [(201, f"{prose(rng, EN, 20)}\n{run}\n{prose(rng, EN, 20)}", "en"),
             (202, f"{prose(rng, EN, 30)}\n{run}", "en"),   # loses the run
             (203, run, "en"),                              # nothing is left of it
             (204, run.replace("\n", " "), "en"),           # another line: stays
             (205, rows[0][1], "de"),                       # an exact copy
             (206, None, "en"), (207, "", None), (208, "12 34 !", None), (209, " \n ", "en"),
             (210, prose(rng, DE, 3000), None), (None, prose(rng, EN, 40), "en"), (None, rows[1][1], "en"),
             (211, f"{prose(rng, EN, 10)}. {ITEM}. {prose(rng, EN, 10)}", "en"),
             (212, ITEM.replace("14", "33").replace("Lisbon", "Porto").replace("90", "75"), "en"),
             (213, ITEM.replace("near Lisbon", "near Porto"), "en"),
             (214, " ".join(ITEM.split()[:14]) + " " + prose(rng, EN, 30), "en"),
             (215, rows[2][1], "de"), (215, rows[2][1], "de")]
    rng.shuffle(rows)
    return rows


def grams(text):
    s = " " + " ".join(regex.sub(r"[^\p{L}]", " ", text.lower()).split()) + " "
    return [s[i:i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i:i + n] != " "]


def by_language(rows):
    """Naive Bayes over the n-grams themselves; learned outside the held-out fold."""
    seen = {}
    for i, text, lang in rows:
        if lang and i is not None and zlib.crc32(str(i).encode()) % 3 != 1:
            seen.setdefault(lang, Counter()).update(grams(text or ""))
    size = len(set().union(*seen.values()))

    def kept(text):
        if not text or not any(map(str.isalpha, text)):
            return False
        of = [sum(math.log((c[g] + 1) / (c.total() + size)) for g in grams(text)) for c in seen.values()]
        return 1 / sum(math.exp(max(x - max(of), -700)) for x in of) >= 0.5

    return [r for r in rows if kept(r[1])]


def without_runs(rows, least=10):
    """Blocks of lines with ten words or more that stand earlier: their lines go."""
    distinct = sorted({(r[0], r[1]) for r in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    seen, gone = set(), {}
    for doc in distinct:
        lines = doc[1].split("\n")
        full = [(n, line) for n, line in enumerate(lines) if WORD.search(line)]
        out = gone.setdefault(doc, set())
        for e in range(1, len(full) + 1):
            for s in range(e):
                block = tuple(line for _, line in full[s:e])
                if sum(len(WORD.findall(x)) for x in block) >= least:
                    if block in seen:
                        out.update(n for n, _ in full[s:e])
                    seen.add(block)
    left = [(i, "\n".join(x for n, x in enumerate(t.split("\n")) if n not in gone[i, t]), lang, bool(gone[i, t]))
            for i, t, lang in rows]
    return [r[:3] for r in left if not r[3] or WORD.search(r[1])]


def without_near(rows):
    sets = {}
    for i, text, _ in rows:
        w = WORD.findall(text.translate({c: c + 32 for c in range(65, 91)}))
        sets[i] = {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    label = {i: i for i in sets if i is not None}
    changed = True
    while changed:
        changed = False
        for a in label:
            for b in label:
                x, y = sets[a], sets[b]
                if label[a] < label[b] and x and 100 * len(x & y) >= 75 * len(x | y):
                    label[b], changed = label[a], True
    out, done = [], set()
    for r in rows:
        if r[0] is None or (label[r[0]] == r[0] and r[0] not in done):
            out.append(r)
            done.add(r[0])
    return out


def tokens_of(text):
    """(value, type, type if every capitalised word is a name) of each token."""
    out, begins = [], True
    for word in WORD.finditer(text):
        raw = word.group()
        begins = begins or "\n" in text[word.start() - 1:word.start()]
        body = "".join(c for c in raw if ord(c) > 126 or c.isalnum())
        if not body:
            begins = begins or raw[-1] in ".!?:"
            continue
        kind = NUM if any(c in "0123456789" for c in body) else UNIT if body.lower() in UNITS else 0
        upper = "A" <= body[0] <= "Z"
        out.append((body.lower(), kind or (NAME if upper and not begins else 0), kind or (NAME if upper else 0)))
        begins = raw[-1] in ".!?:"
    return out


def leaked(text, item, n=8, literals=4, percent=50, run=13):
    """The rules of a leak, window by window."""
    doc, item = tokens_of(text), tokens_of(item)

    def windows(tokens, look):
        kinds = [t[look] if look else 0 for t in tokens]
        shape = [k or t[0] for k, t in zip(kinds, tokens)]
        return {i: (tuple(shape[i:i + n]), tuple(t[0] for k, t in zip(kinds[i:i + n], tokens[i:]) if k))
                for i in range(len(tokens) - n + 1) if not look or kinds[i:i + n].count(0) >= literals}

    typed, good, runs = set(windows(item, 1)), set(), {}
    for look in (0, 1, 2):
        theirs, met = windows(item, look), {}
        for i, (shape, mine) in windows(doc, look).items():
            for j, (other, slots) in theirs.items():
                if shape == other:
                    met.setdefault(i - j, []).append((j, list(zip(slots, mine))))
                    if not look:
                        runs.setdefault(i - j, set()).add(j)
        for some in met.values():
            votes = Counter(p for _, pairs in some for p in pairs)
            stands = {}
            for (value, here), count in votes.items():
                stands.setdefault(value, []).append((count, value == here, here))
            good.update(j for j, pairs in some if all(a == b for a, b in pairs)
                        or all(len(stands[a]) == 1 or max(stands[a])[2] == b for a, b in pairs))
    longest = max((sum(1 for _ in g) + n - 1 for js in runs.values()
                   for _, g in groupby(enumerate(sorted(js)), lambda x: x[1] - x[0])), default=0)
    every = len(item) - n + 1
    return len(good) * 100 >= every * percent or len(good & typed) * 100 >= len(typed) * percent and bool(typed) \
        or longest >= run


def test_pipeline_against_plain_python(spark, scratch):
    import corpus_pipeline
    import public_tokenizers
    from tokenizers import Tokenizer

    rows = documents()
    spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t, lang in rows],
                          "doc_id long, text string, lang string, source string, n_chars long") \
        .repartition(5).write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")

    one = by_language(rows)
    two = without_runs(one)
    three = without_near(two)
    four = [r for r in three if r[0] is None or not leaked(r[1], ITEM)]
    # every stage has something to do, and leaves the rest alone
    assert len(rows) > len(one) > len(two) > len(three) > len(four) > 60
    assert {r[0] for r in three} - {r[0] for r in four} == {211, 212, 213, 214}

    got = corpus_pipeline.run(spark, scratch).collect()
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {}
    for i, text, _ in four:
        want.setdefault(i, []).append([*tok.encode(text, add_special_tokens=False).ids, 0])
    assert {r.doc_id for r in got} == set(want)
    for i, lists in want.items():
        mine = [r for r in got if r.doc_id == i]
        assert sum(r.length for r in mine) == sum(map(len, lists)), i
        for r in mine:
            assert any(r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(
                np.array(ids[r.start:r.start + r.length], dtype="<u4").tobytes()) for ids in lists), i


def test_pipeline_of_no_documents(spark, scratch):
    import corpus_pipeline

    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(f"{scratch}/documents.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{scratch}/benchmark.parquet")
    assert corpus_pipeline.run(spark, scratch).count() == 0


def test_licenses_against_plain_python(spark, monkeypatch):
    kept = []
    train = licenses.train

    def recorded(*args):
        kept.append(train(*args))
        return kept[0]

    monkeypatch.setattr(licenses, "train", recorded)
    got = {r.doc_id: r for r in op3_licenses(spark, SF_SMALL).collect()}
    model, labels, temperature, least = kept[0]
    weights, bias = model.coefficientMatrix.toArray(), model.interceptVector.toArray()
    hasher = HashingTF(inputCol="grams", outputCol="f", numFeatures=licenses.FEATURES)
    token = regex.compile(r"[\p{L}\p{N}]+(?:\.[\p{L}\p{N}]+)*")

    def line_grams(line):
        w = token.findall(line.lower())
        return {*w, *map(" ".join, zip(w, w[1:]))}

    def blocks(text):
        """(first line, body) of the windows of wrapped lines."""
        lines = text.split("\n")
        for i in range(0, len(lines), 4):
            some = [x if len(x) <= 120 and WORD.search(x) else "" for x in lines[i:i + 8]]
            for body in regex.split(r"\n\n+", "\n".join(some)):
                if "\n" in body.strip("\n") and regex.search(rf"\b(?:{licenses.LICENSING})\b", body.lower()):
                    yield i, body

    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()
    every = sorted({g for d in docs for body in [*(d.text or "").split("\n"), *(b for _, b in blocks(d.text or ""))]
                    for g in line_grams(body)})
    hashed = hasher.transform(spark.createDataFrame([([g],) for g in every], "grams array<string>")).select("grams", "f")
    index = {r.grams[0]: int(r.f.indices[0]) for r in hashed.collect()}

    def family(line):
        w = set(token.findall(line.lower()))
        at = sorted({index[g] for g in line_grams(line)})
        z = weights[:, at].sum(axis=1) + bias
        best = int(z.argmax())
        if best == 0:
            return None
        p = 1 / np.exp((z - z.max()) / temperature).sum()
        near = max((len(set(token.findall(t.lower())) & w) / len(set(token.findall(t.lower())))
                    for t in licenses.TEMPLATES.get(labels[best], [])), default=0)
        if p >= least and near >= licenses.CONFIRMS:
            return labels[best], p
        return ("unknown", p) if p >= licenses.STRICT else None

    named = 0
    for d in docs:
        lines = [(i, x) for i, x in enumerate((d.text or "").split("\n")) if WORD.search(x)]
        over = [(i, *f) for i, f in ((i, family(b)) for i, b in blocks(d.text or "")) if f and f[0] != "unknown"]
        alone = [(i, *f) for i, f in ((i, family(x)) for i, x in lines) if f]
        alone = [h for h in alone if h[1] != "unknown" or not any(i <= h[0] < i + 8 for i, *_ in over)]
        r = got[d.doc_id]
        assert (r.n_paragraphs, r.n_licensed, r.n_wrapped) == (len(lines), len(alone), len({h[0] for h in over})), d.doc_id
        assert r.licenses == (",".join(sorted({h[1] for h in alone + over})) or None)
        assert r.confidence is None or abs(r.confidence - max(h[2] for h in alone + over)) < 1e-9
        named += bool(alone)
    assert len(got) == len(docs) and named


NOTICES = {
    "gpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "gpl-2.0": """This program is free software; you can redistribute it and/or modify it
under the terms of the GNU General Public License as published by the
Free Software Foundation; either version 2 of the License, or (at your
option) any later version.""",
    "lgpl": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "agpl-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "mit": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights""",
    "bsd": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at""",
    "mpl-2.0": """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at https://mozilla.org/MPL/2.0/."""}


def test_wrapped_notices_are_named(spark):
    rng = random.Random(3)
    def text():
        return "\n".join(prose(rng, EN, 12) for _ in range(3))

    rows = []
    for i, (family, notice) in enumerate(sorted(NOTICES.items())):
        comment = "\n".join(f" * {x}" for x in notice.split("\n"))
        rows += [(10 * i, notice, family), (10 * i + 1, f"{text()}\n\n{notice}\n\n{text()}", family),
                 (10 * i + 2, f"/*\n * Copyright (C) 2001 Some One\n *\n{comment}\n */\n{text()}", family),
                 (10 * i + 3, "\n" * i + text() + "\n" + notice, family)]
    rows += [(1000 + i, "\n".join(prose(rng, EN, 8) for _ in range(12)), None) for i in range(50)]
    rows += [(2000, "The conditions of the licence were met\nand the permission was granted by the market\nbefore winter", None)]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(df).collect()}
    missed = [(i, family, got[i].licenses) for i, _, family in rows if family and family not in (got[i].licenses or "").split(",")]
    other = [(i, family, got[i].licenses) for i, _, family in rows
             if set((got[i].licenses or "").split(",")) - {"", family, "unknown"}]
    assert not missed and not other, (missed, other)
    assert not [i for i, _, family in rows if i < 2000 and not family and got[i].licenses]


def test_licenses_of_odd_rows(spark):
    text = "Some prose here.\n\nReleased under the MIT License.\n \nmore prose"
    rows = [(1, text, 1), (2, None, 1), (3, "", 1), (4, " \n ", 1), (1, text, 2), (None, text, 1), (5, "only prose here", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, p long")
    got = [(r.doc_id, r.n_paragraphs, r.n_licensed, r.licenses) for r in licenses.scan(df).collect()]
    hit = (3, 1, "mit")
    assert sorted(got, key=str) == sorted([(1, *hit), (1, *hit), (None, *hit), (2, 0, 0, None), (3, 0, 0, None),
                                           (4, 0, 0, None), (5, 1, 0, None)], key=str)
    assert licenses.scan(df.limit(0)).count() == 0
