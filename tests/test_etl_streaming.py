"""Full rebuild (two waves + checks) and the streaming landing path."""

import json

import pytest

from pyspark.sql import functions as F

from nestrel.plans import etl
from nestrel.streaming import landing as SL
from tests.conftest import SF_SMALL
from tests.test_reference_fixtures import EVO, LISTING, MOVES, POKEMON, SPECIES, U, docs

ABILITY = {"id": 65, "name": "overgrow", "effect_entries": [{"effect": "Boost\n\ngrass  moves.",
                                                              "language": {"name": "en"}}],
           "flavor_text_entries": []}


def test_full_rebuild_two_waves(spark, scratch):
    staged = {"entity": docs(spark, POKEMON), "texts": docs(spark, SPECIES), "trees": docs(spark, EVO),
              "listing": docs(spark, LISTING)}
    store = {"move": {m["id"]: json.dumps(m) for m in MOVES}, "ability": {65: json.dumps(ABILITY)}}
    asked = {}

    def fetch(kind, manifest):
        asked[kind] = sorted(r.id for r in manifest.collect())
        return spark.createDataFrame([(i, store[kind][i]) for i in asked[kind] if i in store[kind]],
                                     "id int, body string")

    report = {r.rule: r.violations for r in etl.run(spark, staged, fetch, f"{scratch}/db").collect()}
    assert asked == {"move": [1, 2], "ability": [65]}
    # pokemon 2 lists a move URL without an id: its NULL move_id breaks the
    # primary key (a key column may not be NULL); it is not a foreign-key orphan
    assert report.pop("pk:pokemon_moves") == 1
    assert report.pop("pk:types") == 1          # the listing entry whose URL has no id
    assert report["fk:pokemon_moves.move_id"] == 0
    assert report["len:pokedex.name<=20"] == 0 and report["len:moves.name<=50"] == 0
    assert all(v == 0 for v in report.values()), report
    ab = spark.read.parquet(f"{scratch}/db/abilities").first()
    assert ab.info == "Boost grass moves."
    assert spark.read.parquet(f"{scratch}/db/pokedex").count() == 3
    # every target table exists with its declared columns
    cols = {n: spark.read.parquet(f"{scratch}/db/{n}").columns for n in etl.KEYS}
    assert cols["pokedex"] == ["id", "name", "height", "weight", "hp", "attack", "defense", "s_attack",
                               "s_defense", "speed", "type", "evo_set", "info"]
    assert cols["types"] == ["id", "name"]
    assert cols["moves"] == ["id", "name", "pp", "damage", "accuracy", "type", "info"]
    assert cols["abilities"] == ["id", "name", "info"]
    assert cols["pokemon_moves"] == ["poke_id", "move_id"]
    assert cols["pokemon_abilities"] == ["poke_id", "ability_id"]


def test_landing_stream_is_idempotent(spark, scratch):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    resp = ev.select(F.col("event_id").alias("id"), F.lit(U).alias("url"),
                     F.when(F.col("event_type") == "error", 404).otherwise(200).alias("status"),
                     F.col("props").alias("body"))
    src = f"{scratch}/responses"
    resp.repartition(4).write.parquet(src)
    # one more file: a 200 response whose body is not JSON
    spark.createDataFrame([(10**9, U, 200, '{"k": ')], resp.schema).write.mode("append").parquet(src)
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    q = SL.start(spark, src, f"{scratch}/staged", f"{scratch}/quarantine", f"{scratch}/ckpt",
                 doc_schema=schema, max_files_per_trigger=1)
    q.awaitTermination(120)
    staged = spark.read.parquet(f"{scratch}/staged")
    quarantined = spark.read.parquet(f"{scratch}/quarantine")
    assert staged.count() == resp.where("status = 200").count()
    assert quarantined.count() == resp.where("status <> 200").count() + 1
    assert quarantined.where(f"id = {10**9}").count() == 1
    assert SL.staged_counts(spark, f"{scratch}/staged").agg(F.sum("docs")).first()[0] == staged.count()
    # replaying a batch rewrites only its own folder
    batch0 = spark.read.parquet(src).limit(10)
    SL.land_batch(batch0, 0, f"{scratch}/staged", f"{scratch}/quarantine", schema)
    SL.land_batch(batch0, 0, f"{scratch}/staged", f"{scratch}/quarantine", schema)
    assert spark.read.parquet(f"{scratch}/staged/batch_id=0").count() == batch0.where("status = 200").count()


def test_staging_tables_dropped_only_when_asked(spark, scratch):
    from nestrel.sources import landing as L
    staged = {"entity": docs(spark, POKEMON), "texts": docs(spark, SPECIES), "trees": docs(spark, EVO),
              "listing": docs(spark, LISTING)}
    for name in ("js_entity", "js_texts"):
        L.land(staged["entity"], f"{scratch}/{name}")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{scratch}/{name}'")

    def fetch(kind, manifest):
        return spark.createDataFrame([], "id int, body string")
    etl.run(spark, staged, fetch, f"{scratch}/db1", keep_staging=True, staging_tables=["js_entity", "js_texts"])
    assert spark.catalog.tableExists("js_entity")
    etl.run(spark, staged, fetch, f"{scratch}/db2", keep_staging=False, staging_tables=["js_entity", "js_texts"])
    assert not spark.catalog.tableExists("js_entity") and not spark.catalog.tableExists("js_texts")
    # a wave-2 fetch that returned nothing leaves every bridge key an orphan
    report = {r.rule: r.violations for r in etl.check(spark, f"{scratch}/db2").collect()}
    assert report["fk:pokemon_moves.move_id"] == 2


def test_a_rebuild_is_published_only_if_it_is_sound(spark, scratch):
    from nestrel.sources import publish as PB
    staged = {"entity": docs(spark, POKEMON), "texts": docs(spark, SPECIES), "trees": docs(spark, EVO),
              "listing": docs(spark, LISTING)}
    store = {"move": {m["id"]: json.dumps(m) for m in MOVES}, "ability": {65: json.dumps(ABILITY)}}

    def fetch(kind, manifest):
        ids = [r.id for r in manifest.collect()]
        return spark.createDataFrame([(i, store[kind][i]) for i in ids if i in store[kind]], "id int, body string")

    def nothing(kind, manifest):
        return spark.createDataFrame([], "id int, body string")

    root = f"{scratch}/db"
    with pytest.raises(PB.NotPublished, match="fk:pokemon_moves.move_id: 2"):
        etl.rebuild(spark, staged, nothing, root)
    assert PB.current(spark, root) is None
    report = {r.rule: r.violations for r in etl.run(spark, staged, fetch, f"{scratch}/try").collect()}
    broken = {r for r, n in report.items() if n and r != "malformed documents"}
    first = etl.rebuild(spark, staged, fetch, root, tolerated=("malformed documents", *broken))
    assert PB.read(spark, root, "pokedex").count() == spark.read.parquet(f"{scratch}/try/pokedex").count()
    with pytest.raises(PB.NotPublished):
        etl.rebuild(spark, staged, nothing, root)
    assert PB.current(spark, root) == first


def test_ids_beyond_integer_are_reported(spark):
    listing = spark.createDataFrame([(1, json.dumps({"results": [{"name": "a", "url": "https://x/type/5/"},
                                                                 {"name": "b", "url": "https://x/type/99999999999/"},
                                                                 {"name": "c", "url": "https://x/none"}]}))], "id int, body string")
    none = listing.limit(0)
    assert etl.lost_ids(none, listing, none).first().violations == 1


def test_readme_usage_flow(spark, scratch):
    """The calls shown in the README's usage section, on the fixtures."""
    from pyspark.sql import functions as F

    from nestrel.functions import arrays as A
    from nestrel.operators import relate as R
    from nestrel.operators import search as FTS
    from nestrel.operators import tree as TR
    from nestrel.plans import user_tables
    staged = {"entity": docs(spark, POKEMON), "texts": docs(spark, SPECIES), "trees": docs(spark, EVO),
              "listing": docs(spark, LISTING)}
    store = {"move": {m["id"]: json.dumps(m) for m in MOVES}, "ability": {65: json.dumps(ABILITY)}}

    def fetch(kind, manifest):
        ids = [r.id for r in manifest.collect()]
        return spark.createDataFrame([(i, store[kind][i]) for i in ids if i in store[kind]], "id int, body string")
    db = f"{scratch}/db"
    etl.run(spark, staged, fetch, db)
    dex = spark.read.parquet(f"{db}/pokedex")
    pm = spark.read.parquet(f"{db}/pokemon_moves")
    hist = {r.type: r.ct for r in R.array_histogram(dex, "type", "type", "ct").collect()}
    assert hist == {"grass": 1, "poison": 1, "water": 2, "rock": 1}
    assert dex.where(A.contains_all(F.col("type"), ["water"])).count() == 2
    assert dex.where(A.set_equal(F.col("type"), ["water", "rock"])).count() == 1
    counts = R.left_join_count(dex, pm, "id", "poke_id", ["id", "name"], "ct")
    assert {r.id: r.rk for r in R.rank_at_most(counts, "ct", 6).collect()} == {2: 1, 3: 1, 1: 3}
    abilities = spark.read.parquet(f"{db}/abilities")
    assert FTS.search(abilities, "info", "grasses", kind="porter2").count() == 1
    assert FTS.search(abilities, "info", "grasses", kind="porter2", id_col="id").count() == 1
    assert TR.walk(docs(spark, EVO)).count() == 9
    user_tables.create(spark, f"{db}/user")
    assert user_tables.insert_roster(spark, f"{db}/user", [(65, 39)], max_rows=6)


def test_bucketed_entity_and_bridge_join_without_shuffle(spark, scratch):
    from nestrel.operators import relate as R
    from nestrel.sources import landing as L
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # force the shuffle-join path
    try:
        ents = spark.range(0, 200).selectExpr("id", "concat('p', id) AS name")
        bridge = spark.range(0, 1000).selectExpr("id % 150 AS poke_id", "id AS move_id")
        L.write_bucketed(ents, "b_entity", ["id"], 8)
        L.write_bucketed(bridge.withColumnRenamed("poke_id", "id"), "b_bridge", ["id"], 8)
        e, b = spark.table("b_entity"), spark.table("b_bridge")
        joined = e.join(b, "id", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange hashpartitioning" not in plan
        counts = R.left_join_count(e, b, "id", "id", ["id", "name"], "ct")
        got = {r.id: r.ct for r in counts.collect()}
        assert got[0] == 7 and got[199] == 1          # 1000 rows over 150 keys; unmatched count 1
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_landing_stream_drops_repeated_ids(spark, scratch):
    src = f"{scratch}/responses"
    first = spark.createDataFrame([(1, U, 200, '{"k": 1}'), (2, U, 200, '{"k": 2}')],
                                  "id long, url string, status int, body string")
    again = spark.createDataFrame([(2, U, 200, '{"k": 2}'), (3, U, 404, "nf")],
                                  "id long, url string, status int, body string")
    first.write.parquet(src)
    again.write.mode("append").parquet(src)
    q = SL.start(spark, src, f"{scratch}/staged", f"{scratch}/quarantine", f"{scratch}/ckpt",
                 max_files_per_trigger=1, dedupe_ids=True)
    q.awaitTermination(120)
    assert sorted(r.id for r in spark.read.parquet(f"{scratch}/staged").collect()) == [1, 2]
    assert [r.id for r in spark.read.parquet(f"{scratch}/quarantine").collect()] == [3]
