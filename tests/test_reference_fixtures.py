"""Reference-shaped JSON fixtures (FIXTURES.md section 1) through the pipelines.

Covers: no 'en' entry, empty entries, several 'en' entries (first wins), an
entry without language (F1), text with \\n, \\n\\n, \\f and double spaces
(F2-F4), JSON null numbers (X8), fewer than 6 stats (X4), duplicate ability
(A8), URL without a trailing id (X14), branching tree, depth 1 and 3, an
entity in no tree, a malformed body (F8) and a non-200 response (S5).
"""

import json
from decimal import Decimal

from pyspark.sql import functions as F

from nestrel.functions import jsonpath as J
from nestrel.operators import integrity as I
from nestrel.plans import pipelines as P
from nestrel.plans import shapes as SH
from nestrel.sources import landing as L

U = "https://api.example.com/"


def stat(v):
    return {"base_stat": v}


POKEMON = [
    {"id": 1, "height": 7, "weight": 69, "species": {"name": "bulba"},
     "stats": [stat(45), stat(49), stat(49), stat(65), stat(65), stat(45)],
     "types": [{"type": {"name": "grass"}}, {"type": {"name": "poison"}}],
     "moves": [{"move": {"url": U + "move/1/"}}, {"move": {"url": U + "move/2/"}}],
     "abilities": [{"ability": {"url": U + "ability/65/"}}, {"ability": {"url": U + "ability/65/"}}]},
    {"id": 2, "height": 10, "weight": 130, "species": {"name": "ivy"},
     "stats": [stat(60), stat(62), stat(63)],
     "types": [{"type": {"name": "water"}}],
     "moves": [{"move": {"url": U + "move/abc/"}}], "abilities": []},
    {"id": 3, "height": 1.5, "weight": 2.25, "species": {"name": "lonely"}, "stats": [],
     "types": [{"type": {"name": "water"}}, {"type": {"name": "rock"}}], "moves": [], "abilities": []},
]
SPECIES = [
    {"id": 1, "flavor_text_entries": [
        {"flavor_text": "Un\ntexte", "language": {"name": "fr"}},
        {"flavor_text": "first\fen\ntext", "language": {"name": "en"}},
        {"flavor_text": "second en", "language": {"name": "en"}}]},
    {"id": 2, "flavor_text_entries": [{"flavor_text": "no language"},
                                      {"flavor_text": "x", "language": {"name": "de"}}]},
    {"id": 3, "flavor_text_entries": []},
]
EVO = [
    {"id": 10, "chain": {"species": {"name": "bulba"}, "evolves_to": [
        {"species": {"name": "ivy"}, "evolves_to": [{"species": {"name": "venu"}, "evolves_to": []}]}]}},
    {"id": 11, "chain": {"species": {"name": "wurm"}, "evolves_to": [
        {"species": {"name": "silc"}, "evolves_to": [{"species": {"name": "beau"}, "evolves_to": []}]},
        {"species": {"name": "casc"}, "evolves_to": [{"species": {"name": "dust"}, "evolves_to": []}]}]}},
    {"id": 12, "chain": {"species": {"name": "solo"}, "evolves_to": []}},
]
LISTING = [{"results": [{"name": "normal", "url": U + "type/1/"}, {"name": "fire", "url": U + "type/10/"},
                        {"name": "odd", "url": U + "type/odd"}]}]
MOVES = [
    {"id": 1, "name": "pound", "pp": 35, "power": 40, "accuracy": 100, "type": {"url": U + "type/1/"},
     "effect_entries": [{"effect": "Inflicts\n\nregular  damage.", "language": {"name": "en"}}],
     "flavor_text_entries": []},
    {"id": 2, "name": "growl", "pp": 40, "power": None, "accuracy": None, "type": {"url": U + "type/10/"},
     "effect_entries": [{"effect": "Lowers attack.", "language": {"name": "en"}}],
     "flavor_text_entries": [{"flavor_text": "Hits\nhard", "language": {"name": "en"}},
                             {"flavor_text": "later", "language": {"name": "en"}}]},
]


def docs(spark, items, extra=()):
    rows = [(i + 1, json.dumps(d)) for i, d in enumerate(items)] + list(extra)
    return spark.createDataFrame(rows, "id int, body string")


def test_entity_table(spark):
    ent = docs(spark, POKEMON, [(99, '{"id": 4, "species": ')])   # malformed body
    out = P.entity_table(ent, SH.ENTITY, docs(spark, EVO), SH.tree(4), 4,
                         docs(spark, SPECIES), SH.TEXTS).orderBy("id").collect()
    assert [r.id for r in out] == [1, 2, 3]
    r1, r2, r3 = out
    assert r1.name == "bulba" and r1.hp == Decimal("45") and r1.speed == Decimal("45")
    assert r1.type == ["grass", "poison"] and r1.evo_set == 10
    assert r1.info == "first en text"                      # first 'en' wins, \f and \n cleaned
    assert (r2.hp, r2.attack, r2.defense) == (Decimal(60), Decimal(62), Decimal(63))
    assert r2.s_attack is None and r2.speed is None         # fewer than 6 stats -> NULL
    assert r2.evo_set == 10 and r2.info is None             # entry without language, no 'en'
    assert r3.evo_set is None and r3.info is None           # in no tree, empty entries
    assert r3.height == Decimal("1.5") and r3.weight == Decimal("2.25")   # scale kept


def test_malformed_quarantined(spark):
    ent = docs(spark, POKEMON, [(99, '{"id": 4, "species": ')])
    good, bad = J.split_valid(ent, SH.ENTITY)
    assert good.count() == 3
    assert [r.id for r in bad.collect()] == [99]


def test_tree_levels_and_branching(spark):
    from nestrel.operators import tree as TR
    t = docs(spark, EVO).select(J.parse(F.col("body"), SH.tree(5)).alias("j"))
    lv = t.select(F.col("j.id").alias("id"),
                  *[TR.level(F.col("j.chain"), k).alias(f"l{k}") for k in (1, 2, 3, 4)]).orderBy("id").collect()
    assert lv[0].l1 == ["bulba"] and lv[0].l2 == ["ivy"] and lv[0].l3 == ["venu"] and lv[0].l4 == []
    assert lv[1].l2 == ["silc", "casc"] and lv[1].l3 == ["beau", "dust"]
    assert lv[2].l1 == ["solo"] and lv[2].l2 == [] and lv[2].l3 == []
    assert all(r.l4 == [] for r in lv)                      # no fourth level


def test_lookup_parallel_unnest(spark):
    out = sorted(P.lookup_table(docs(spark, LISTING), SH.LISTING).collect(), key=lambda r: r.name)
    assert [(r.id, r.name) for r in out] == [(10, "fire"), (1, "normal"), (None, "odd")]


def test_bridges(spark):
    ent = docs(spark, POKEMON)
    moves = P.bridge_table(ent, SH.ENTITY, "moves", "move.url", "move_id").collect()
    assert sorted((r.poke_id, r.move_id) for r in moves if r.move_id is not None) == [(1, 1), (1, 2)]
    assert [r.move_id for r in moves if r.poke_id == 2] == [None]      # URL without an id
    abil = P.bridge_table(ent, SH.ENTITY, "abilities", "ability.url", "ability_id").collect()
    assert len(abil) == 2                                   # duplicate kept without distinct
    abil_d = P.bridge_table(ent, SH.ENTITY, "abilities", "ability.url", "ability_id", distinct=True)
    assert [(r.poke_id, r.ability_id) for r in abil_d.collect()] == [(1, 65)]
    assert I.unique_violations(abil_d, ["poke_id", "ability_id"], primary=True).count() == 0


def test_described_with_fallback_and_json_null(spark):
    from nestrel.functions import text as X
    cols = [F.col("id"), F.col("name"), F.col("pp"), F.col("power").alias("damage"), F.col("accuracy"),
            X.url_id(F.col("type.url"), X.URL_ID_STRICT).alias("type")]
    out = {r.id: r for r in P.described_table(docs(spark, MOVES), SH.MOVES, cols).collect()}
    assert out[1].info == "Inflicts regular damage."       # effect fallback, \n\n and double space
    assert out[2].info == "Hits hard"                       # first flavour text
    assert out[2].damage is None and out[2].accuracy is None   # JSON null
    assert out[1].damage == Decimal("40") and out[1].type == 1 and out[2].type == 10


def test_response_split(spark):
    resp = spark.createDataFrame([(1, U + "x/1", 200, "{}"), (2, U + "x/2", 404, "nf"), (3, U + "x/3", None, "")],
                                 "id int, url string, status int, body string")
    good, bad = L.split_responses(resp)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.id for r in bad.collect()) == [2, 3]


def test_pending_keys_and_manifest(spark):
    bridge = spark.createDataFrame([(1, 5), (1, 3), (2, 3), (2, None)], "poke_id int, move_id int")
    landed = spark.createDataFrame([(3,)], "id int")
    keys = L.pending_keys(bridge, "move_id", landed, "id").collect()
    assert [r.move_id for r in keys] == [5]
    man = L.request_manifest(3, U + "move/", spark=spark).collect()
    assert [r.url for r in man] == [U + "move/1", U + "move/2", U + "move/3"]
    listing = L.request_manifest(None, U + "type/", spark=spark).collect()
    assert [(r.id, r.url) for r in listing] == [(1, U + "type/")]


def test_recursive_walk_any_depth(spark):
    from nestrel.operators import tree as TR
    deep = {"id": 13, "chain": {"species": {"name": "r"}, "evolves_to": [{"species": {"name": "a"}, "evolves_to": [
        {"species": {"name": "b"}, "evolves_to": [{"species": {"name": "c"}, "evolves_to": [
            {"species": {"name": "d"}, "evolves_to": []}]}]}]}]}}
    rows = TR.walk(docs(spark, EVO + [deep])).collect()
    got = sorted((r.id, r.level, r.parent, r.name) for r in rows)
    assert (2, 2, "wurm", "silc") in got and (2, 2, "wurm", "casc") in got       # branching
    assert (2, 3, "silc", "beau") in got and (2, 3, "casc", "dust") in got
    assert [x for x in got if x[0] == 3] == [(3, 1, None, "solo")]                 # depth 1
    assert max(r.level for r in rows if r.id == 4) == 5                            # deeper than any fixed schema
    assert max(r.level for r in rows if r.id == 1) == 3
