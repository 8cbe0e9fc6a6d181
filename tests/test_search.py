"""Full-text search: normalisers, pre-filter exactness, index vs scan."""

from pyspark.sql import functions as F

from nestrel.functions import search as S
from tests.plain_porter2 import stem
from nestrel.operators import search as FTS
from tests.conftest import SF_MID

# Stemming pairs of the published English stemmer.
PORTER2_PAIRS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "agreed": "agre",
    "plastered": "plaster", "motoring": "motor", "hopping": "hop", "falling": "fall", "filing": "file",
    "happy": "happi", "relational": "relat", "generously": "generous", "swimming": "swim",
    "running": "run", "dying": "die", "conditional": "condit", "sensibility": "sensibl",
    "hopefulness": "hope", "formality": "formal", "consignment": "consign", "knightly": "knight",
    "generalization": "general", "energy": "energi", "sounds": "sound", "cries": "cri", "gas": "gas",
    "gaps": "gap", "kiwis": "kiwi", "cry": "cri", "proceed": "proceed", "communication": "communic",
}


def test_porter2_golden_pairs():
    assert {w: stem(w) for w in PORTER2_PAIRS} == PORTER2_PAIRS


def test_light_and_exact_normalisers(spark):
    df = spark.createDataFrame([("The Swimming cats, swimmers and the things!",)], "t string")
    ex = set(df.select(S.lexemes(F.col("t"), "exact")).first()[0])
    assert ex == {"swimming", "cats", "swimmers", "things"}     # stop words gone, lowercased
    li = set(df.select(S.lexemes(F.col("t"), "light")).first()[0])
    assert li == {"swim", "cat", "swimmer", "thing"}             # thing: no vowel before -ing
    p2 = set(df.select(S.lexemes(F.col("t"), "porter2")).first()[0])
    assert p2 == {"swim", "cat", "swimmer", "thing"}


def test_null_text_never_matches(spark):
    df = spark.createDataFrame([(1, None), (2, "energy")], "id int, t string")
    assert [r.id for r in FTS.search(df, "t", "energy | sound", "porter2").collect()] == [2]


def test_prefilter_is_exact(spark):
    # the substring pre-filter must never change the answer
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang") == "en")
    for q, kind in [("disgusting", "light"), ("tion | ther", "exact"), ("ering", "light")]:
        full = F.arrays_overlap(S.lexemes(F.col("text"), kind), S.query_lexemes(q, kind))
        a = {r.doc_id for r in docs.where(full).select("doc_id").collect()}
        b = {r.doc_id for r in FTS.search(docs, "text", q, kind).select("doc_id").collect()}
        assert a == b and a


def test_index_search_equals_scan_search(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang") == "en")
    idx = FTS.build_index(docs, "doc_id", "text", "light")
    a = {r.doc_id for r in FTS.search(docs, "text", "ering | swimming", "light").collect()}
    b = {r.doc_id for r in FTS.search_index(idx, docs, "doc_id", "ering | swimming", "light").collect()}
    assert a == b and a


def test_persisted_index_lookup_is_pruned(spark, scratch):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang") == "en")
    FTS.write_index(FTS.build_index(docs, "doc_id", "text", "exact"), f"{scratch}/idx", partitions=4)
    idx = spark.read.parquet(f"{scratch}/idx")
    hits = FTS.search_index(idx, docs.select("doc_id"), "doc_id", "tion | ther", "exact")
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(term, [ther,tion])" in plan or "PushedFilters: [In(term, [tion,ther])" in plan
    scan = {r.doc_id for r in FTS.search(docs, "text", "tion | ther", "exact").collect()}
    assert {r.doc_id for r in hits.collect()} == scan


def test_light_stemmer_spark_and_sql_agree(spark):
    import random

    import duckdb

    from nestrel.plans.catalog import _LIGHT, _tok_sql
    rng = random.Random(5)
    stems = ["hop", "swim", "agr", "feed", "plaster", "cr", "th", "conflat", "siz", "troubl", "fizz",
             "hiss", "ca", "pon", "bl", "x", "tann", "motor", "y", "fall"]
    suffixes = ["", "s", "es", "ies", "sses", "ss", "ed", "eed", "ing", "ings", "eds", "at", "ated", "bling",
                "izing", "ting", "ping", "lling", "ssing"]
    words = sorted({rng.choice(stems) + rng.choice(suffixes) for _ in range(400)})
    text = " ".join(words)
    got = set(spark.createDataFrame([(text,)], "text string").select(S.lexemes(F.col("text"), "light")).first()[0])
    con = duckdb.connect()
    row = con.execute(f"SELECT list_distinct({_tok_sql(_LIGHT)}) FROM (SELECT ? AS text)", [text]).fetchone()
    assert got == set(row[0])


def test_porter2_index_forms_agree(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang") == "en").limit(200)
    flat = {(r.term, r.doc_id) for r in FTS.build_index(docs, "doc_id", "text", "porter2").collect()}
    inrow = {(t, r.doc_id) for r in docs.select("doc_id", S.lexemes(F.col("text"), "porter2").alias("l")).collect()
             for t in r.l}
    assert flat == inrow and flat


def test_porter2_search_paths_agree(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").where(F.col("lang") == "en")
    q = "ering | disgusting | things"
    a = {r.doc_id for r in FTS.search(docs, "text", q, "porter2").collect()}
    b = {r.doc_id for r in FTS.search(docs, "text", q, "porter2", id_col="doc_id").collect()}
    assert a == b and a


def test_stemmer_tries_no_pattern_of_suffixes(spark):
    """A step compares the word's end before anything else; no expression searches a word for a list of suffixes."""
    import random

    from nestrel.functions import porter2 as PO
    rng = random.Random(3)
    ends = sorted({a for a, _ in PO.STEP2 + PO.STEP3} | set(PO.STEP4) | set(PO.STEP1B) | {"", "s", "ies", "y", "e", "ll", "'s", "ou"})
    words = sorted({"".join(rng.choice("aeiouybdlnrstw'") for _ in range(rng.randint(0, 6))) + rng.choice(ends) for _ in range(3000)}
                   | set(PO.EXCEPTIONS) | PO.EXCEPTIONS_AFTER_1A | {p + e for p in PO.R1_PREFIXES for e in ends})
    df = spark.createDataFrame([(w,) for w in words], "w string").select("w", PO.stem_token(F.col("w")).alias("s"))
    assert [(r.w, r.s) for r in df.collect() if r.s != stem(r.w)] == []
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "ization|" not in p and "ement|" not in p and "eedly|" not in p
