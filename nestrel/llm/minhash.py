"""b-bit MinHash near-duplicates.

1. One pass over the texts: each document's distinct word shingles are hashed to
   ``bands * rows + more_minima`` minima. The first ones make the buckets of the bands;
   of every minimum the low ``BITS`` bits are kept, packed into 64-bit words. The further
   ones only sharpen the estimate. Texts are not shuffled.
2. Documents with the same words are one representative (the smallest id) from here on.
3. Candidates are representatives that share a bucket. Their similarity is estimated
   by bit counts over the packed signatures, corrected for collisions of the low
   bits; only pairs far below the threshold (``SIGMAS`` standard errors) are left out.
   What remains is confirmed on the full shingle sets.
4. No bucket is expanded into all its pairs. In two rounds every document is held
   against at most two bucket leaders: the smallest one, and the one that leads most of
   its buckets (in the second round leaders come from a bucket's largest star of links).
   That makes one component of a large group of near copies in linearly many comparisons. Then only
   members of *different* components that still share a bucket are compared, from the
   smaller side: pairs inside a component can add nothing.
5. Components come from min-label propagation with pointer jumping over the confirmed
   links, on tables in the shared folder.

With 40 bands of 5 rows a pair at similarity 0.75 shares no bucket with a probability
of 2e-5, and the estimate loses it with one of 3e-5.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from nestrel.llm.common import materialize
from nestrel.llm.shingles import mix, normal, shingle_hashes

BITS, SIGMAS = 4, 4.0
ID_BITS = 1 << 23        # of the bitmap that tells which texts are looked at again
MOST_HELD = 1 << 20      # shingle hashes that a task keeps of texts it may meet again


def coefficients(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n odd multipliers and offsets for 32-bit hashing, from a fixed seed."""
    h = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return (h[:n] >> np.uint64(32)).astype(np.uint32) | np.uint32(1), (h[n:] >> np.uint64(32)).astype(np.uint32)


def minima(sets: list[np.ndarray], n: int) -> np.ndarray:
    """The n minima of each (non-empty) set of 64-bit hashes."""
    a, b = coefficients(n)
    flat = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    at = np.cumsum([0, *(len(s) for s in sets[:-1])])
    out = np.empty((len(sets), n), dtype=np.uint32)
    work = np.empty_like(flat)
    for i in range(n):
        np.multiply(flat, a[i], out=work)
        np.add(work, b[i], out=work)
        work ^= work >> np.uint32(15)
        out[:, i] = np.minimum.reduceat(work, at)
    return out


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int, n: int, id_col: str,
               text_col: str) -> DataFrame:
    """doc_id, n_shingles, set_key (128 bits), buckets (of the first ``bands * rows``
    minima), packed (low bits of all ``n`` minima)."""
    per_word = 64 // BITS

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for start in range(0, len(ids), 200):
                some = [shingle_hashes(normal(t.as_py()), shingle) for t in texts[start:start + 200]]
                full = [i for i, s in enumerate(some) if len(s)]
                buckets = np.zeros((len(some), bands), dtype=np.int64)
                packed = np.zeros((len(some), -(-n // per_word)), dtype=np.int64)
                for lo in range(0, len(full), 20):
                    part = full[lo:lo + 20]
                    m = minima([some[i] for i in part], n)
                    key = np.arange(1, bands + 1, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93)
                    key = np.broadcast_to(key, (len(part), bands)).copy()
                    for r in range(rows):
                        key = mix(key ^ m[:, r:bands * rows:rows].astype(np.uint64) + np.uint64(r + 1))
                    buckets[part] = key.view(np.int64)
                    low = (m & np.uint32((1 << BITS) - 1)).astype(np.uint64)
                    word = np.zeros((len(part), packed.shape[1]), dtype=np.uint64)
                    for j in range(n):
                        word[:, j // per_word] |= low[:, j] << np.uint64(BITS * (j % per_word))
                    packed[part] = word.view(np.int64)
                # the set's own key: two sums over all its hashes, mixed differently
                keys = [np.array([mix(s).sum(), mix(s ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum()], dtype=np.uint64)
                        .tobytes() if len(s) else None for s in some]

                def lists(x):
                    rows_ = pa.array(x.ravel())
                    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), rows_)

                yield pa.RecordBatch.from_arrays(
                    [ids[start:start + 200], pa.array([len(s) for s in some], pa.int64()),
                     pa.array(keys, pa.binary()), lists(buckets), lists(packed)],
                    names=["doc_id", "n_shingles", "set_key", "buckets", "packed"])

    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
            .mapInArrow(task, "doc_id long, n_shingles long, set_key binary, buckets array<long>, packed array<long>"))


def plausible(n: int, words: int, percent: int) -> Column:
    """Collision-corrected estimate of rows a, b: not far below the threshold, and set
    sizes that allow it."""
    t = percent / 100
    agree = t + (1 - t) / (1 << BITS)            # chance that the low bits of two minima agree
    least = agree - SIGMAS * math.sqrt(agree * (1 - agree) / n)
    low = int(("0" * (BITS - 1) + "1") * (64 // BITS), 2)      # the lowest bit of every field
    differ = F.lit(0)
    for i in range(words):
        x = F.col("a.packed")[i].bitwiseXOR(F.col("b.packed")[i])
        for shift in (1, 2):                      # BITS = 4: or of a field's bits in its lowest
            x = x.bitwiseOR(F.shiftrightunsigned(x, shift))
        differ = differ + F.bit_count(x.bitwiseAND(F.lit(low)))
    sizes = (F.least("a.n_shingles", "b.n_shingles") * 100 >= F.greatest("a.n_shingles", "b.n_shingles") * percent)
    return sizes & (differ <= math.floor((1 - least) * n))


def components(nodes: DataFrame, links: DataFrame, most_rounds: int = 200) -> DataFrame:
    """(node, component): the smallest node reachable over ``links`` (a, b); nodes
    without links are their own. Each round every node takes the smallest label of
    itself, its neighbours and its label's own node; rounds end when none changes."""
    both = materialize(links.select("a", "b").union(links.select(F.col("b"), F.col("a"))).distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.min("b").alias("m"))
                         .select(F.col("a").alias("node"), F.least("a", "m").alias("label")), "labels")
    for _ in range(most_rounds):
        near = (both.join(labels.withColumnRenamed("node", "b"), "b")
                .groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near")))
        far = labels.select(F.col("node").alias("label"), F.col("label").alias("far"))
        step = (labels.join(near, "node").join(far, "label")
                .select("node", F.col("label").alias("old"), F.least("label", "near", "far").alias("label")))
        step = materialize(step, "labels")
        labels = step.select("node", "label")
        if step.where("label <> old").isEmpty():
            break
    else:
        raise RuntimeError("components did not settle")
    return (nodes.join(labels, "node", "left")
            .select("node", F.coalesce("label", "node").alias("component")))


def texts_of(source: DataFrame, wanted: DataFrame) -> DataFrame:
    """The rows (doc_id, text) of ``source`` with an id in ``wanted`` (distinct doc_id). A
    bitmap of fixed size over the ids' last bits keeps most other texts out of the
    shuffle; what it lets through the join decides."""
    last = F.col("doc_id").bitwiseAND(F.lit(ID_BITS - 1))
    words = (wanted.groupBy(F.shiftright(last, 6).cast("int").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(doc_id & 63 as int))")).alias("bits")).collect())
    bitmap = np.zeros(ID_BITS // 64, dtype=np.int64)
    for r in words:
        bitmap[r["word"]] = r["bits"]
    shared = source.sparkSession.sparkContext.broadcast(bitmap)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            at = ids & (ID_BITS - 1)
            yield batch.filter(pa.array((shared.value[at >> 6] >> (at & 63)) & 1 > 0))

    return source.mapInArrow(task, "doc_id long, text string").join(wanted.hint("merge"), "doc_id", "left_semi")


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int, shingle: int) -> DataFrame:
    """The pairs (a, b) whose full sets pass 100 * |A n B| >= percent * |A u B|."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict = {}
        held = 0                                  # hashes in ``sets``

        def of(key, text):
            nonlocal held
            if key not in sets:
                if held >= MOST_HELD:
                    sets.clear()
                    held = 0
                sets[key] = shingle_hashes(normal(text.as_py()), shingle)
                held += len(sets[key])
            return sets[key]

        for batch in batches:
            a, b, ta, tb = batch.columns
            ok = []
            for x, y, p, q in zip(a.to_pylist(), b.to_pylist(), ta, tb):
                m, n = of(x, p), of(y, q)
                both = len(np.intersect1d(m, n, assume_unique=True))
                ok.append(100 * both >= percent * (len(m) + len(n) - both))
            yield pa.RecordBatch.from_arrays([a.filter(pa.array(ok, pa.bool_())), b.filter(pa.array(ok, pa.bool_()))],
                                             names=["a", "b"])

    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))
    return (pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb")
            .mapInArrow(task, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, percent: int = 75, shingle: int = 5, bands: int = 40, rows: int = 5,
                    more_minima: int = 400, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept, n_links
    (confirmed links found of the document's representative).

    Documents are linked when 100 * |intersection| >= ``percent`` * |union| of their
    distinct ``shingle``-word shingles. Null, empty and blank texts have no shingles and
    are linked with nothing. A row without an id takes the component of the documents
    with exactly its words, and is not kept then; without such a document it is kept,
    with a null component. Repeated rows share a component and their kept flag; rows of
    one id with different texts are one document, linked by any of them. Other columns
    are ignored; no rows give no rows.
    """
    n_minima = bands * rows + more_minima
    words = -(-n_minima * BITS // 64)
    sig = materialize(signatures(docs, shingle, bands, rows, n_minima, id_col, text_col), "signatures")
    full = sig.where(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
    low = full.groupBy("set_key").agg(F.min("doc_id").alias("doc_id"))
    # one row per class of equal sets: its representative, and what all members share
    reps = materialize(full.join(low, ["set_key", "doc_id"], "left_semi").dropDuplicates(["set_key"])
                       .select("doc_id", "set_key", "n_shingles", "buckets", "packed"), "reps")

    member = reps.select(F.explode("buckets").alias("bucket"), "doc_id")
    shared = materialize(member.join(
        member.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket"), "bucket"), "buckets")
    some = reps.select("doc_id", "n_shingles", "packed")
    source = (docs.where(F.col(id_col).isNotNull())
              .select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")))

    def confirm(pairs: DataFrame) -> DataFrame:
        if pairs.isEmpty():
            return pairs
        wanted = pairs.select(F.col("a").alias("doc_id")).union(pairs.select("b")).distinct()
        texts = materialize(texts_of(source, wanted), "texts")
        return materialize(confirmed(pairs, texts, percent, shingle), "confirmed")

    def mates_in(found: DataFrame) -> DataFrame:
        return shared.join(found.withColumnRenamed("node", "doc_id"), "doc_id")

    nodes = reps.select(F.col("doc_id").alias("node")).distinct()
    first = nodes.select("node", F.col("node").alias("component"))
    links = None
    for rounds in range(2):
        mates = mates_in(first)
        parts = mates.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("low"))
        lead = parts.groupBy("bucket").agg(F.max(F.struct("n", (-F.col("low")).alias("neg"), "component")).alias("x")).select(
            "bucket", (-F.col("x.neg")).alias("leader"), F.col("x.component").alias("main"))
        votes = (mates.join(lead, "bucket").where("component <> main").groupBy("doc_id", "leader")
                 .agg(F.count(F.lit(1)).alias("n")))
        pairs = (votes.groupBy("doc_id").agg(F.min("leader").alias("x"), F.max_by("leader", "n").alias("y"))
                 .select("doc_id", F.explode(F.array_distinct(F.array("x", "y"))).alias("leader"))
                 .select(F.least("doc_id", "leader").alias("a"), F.greatest("doc_id", "leader").alias("b")).distinct())
        pairs = (pairs.join(some.alias("a"), F.col("a") == F.col("a.doc_id"))
                 .join(some.alias("b"), F.col("b") == F.col("b.doc_id"))
                 .where(plausible(n_minima, words, percent)).select(F.col("a"), F.col("b")))
        star = confirm(materialize(pairs, "star"))
        links = star if links is None else links.union(star).distinct()
        if rounds == 0:
            # leaders of the next round come from a bucket's largest star: no labels are followed yet
            hub = links.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("hub"))
            first = materialize(nodes.join(hub, "node", "left").select("node", F.coalesce("hub", "node").alias("component")),
                                "stars")
    first = materialize(components(nodes, links), "components")

    # what is left: bucket mates in different components, found from the smaller side
    mates = mates_in(first)
    mixed = (mates.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
             .groupBy("bucket").agg(F.count(F.lit(1)).alias("parts"), F.max_by("component", "n").alias("main"))
             .where("parts > 1").drop("parts"))
    mates = materialize(mates.join(mixed, "bucket").join(reps.drop("set_key"), "doc_id"), "mates")
    every, final = links, None
    if not mates.isEmpty():
        # a pair is looked at in the smallest of the buckets that it shares
        once = F.array_min(F.array_intersect("a.buckets", "b.buckets")) == F.col("a.bucket")
        small = mates.where("component <> main")
        rest = (small.alias("a").join(mates.alias("b"), (F.col("a.bucket") == F.col("b.bucket"))
                                      & (F.col("a.component") != F.col("b.component"))
                                      & ((F.col("b.component") == F.col("b.main")) | (F.col("a.doc_id") < F.col("b.doc_id")))
                                      & plausible(n_minima, words, percent) & once)
                .select(F.least("a.doc_id", "b.doc_id").alias("a"), F.greatest("a.doc_id", "b.doc_id").alias("b"))
                .distinct())
        rest = materialize(rest, "rest")
        if not rest.isEmpty():
            more = confirm(rest)
            label = first.select(F.col("node").alias("k"), "component")
            joined = (more.join(label.select(F.col("k").alias("a"), F.col("component").alias("ca")), "a")
                      .join(label.select(F.col("k").alias("b"), F.col("component").alias("cb")), "b"))
            joined = materialize(joined.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct(), "joined")
            every = links.union(more).distinct()
            if not joined.isEmpty():
                final = components(first.select(F.col("component").alias("node")).distinct(), joined)
    degree = (every.select("a").union(every.select("b")).groupBy(F.col("a").alias("rep"))
              .agg(F.count(F.lit(1)).alias("n_links")))
    if final is None:
        by_rep = first.select(F.col("node").alias("rep"), F.col("component").alias("component_id"))
    else:
        by_rep = (first.join(final.select(F.col("node").alias("component"), F.col("component").alias("component_id")), "component")
                  .select(F.col("node").alias("rep"), "component_id"))
    by_class = reps.select("set_key", F.col("doc_id").alias("rep")).join(by_rep, "rep").join(degree, "rep", "left")
    out = sig.select("doc_id", "n_shingles", "set_key").join(by_class, "set_key", "left")
    component = F.coalesce("component_id", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, component.isNull()).alias("kept"),
                      F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))
