"""The full rebuild: staged documents -> normalised tables -> checks.

Mirrors the workload's load script as Spark jobs:

1. wave 1 staged sources (entities, texts, trees, listing) -> ``pokedex``,
   ``types``, ``pokemon_moves``, ``pokemon_abilities``;
2. pending keys: the distinct move / ability ids referenced by wave 1;
3. wave 2: ``fetch(manifest) -> (id, body)`` supplies those documents
   (fetching is the caller's business); -> ``moves``, ``abilities``;
4. every table is written with a full overwrite, range-clustered and sorted by
   key (the sorted load), so key lookups skip files by min/max statistics;
5. malformed documents go to ``quarantine`` with the name of their source, and the
   report counts them;
6. integrity checks (unique keys and names, foreign keys, lengths) run on the written
   tables. ``rebuild`` gives every run a folder of its own and publishes it only if they
   hold, so readers never meet a half-written or unsound version; ``run`` writes where it
   is told. ``keep_staging=False`` removes the staged sources.

No step collects data to the driver; the verdicts are small counts.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.functions import jsonpath as J
from nestrel.functions import text as X
from nestrel.operators import integrity as I
from nestrel.plans import pipelines as P
from nestrel.plans import shapes as SH
from nestrel.sources import landing as L
from nestrel.sources import publish as PB

KEYS = {
    "pokedex": ["id"], "types": ["id"], "moves": ["id"], "abilities": ["id"],
    "pokemon_moves": ["poke_id", "move_id"], "pokemon_abilities": ["poke_id", "ability_id"],
}
# Declared maximum name lengths of the target tables (VARCHAR(n)).
NAME_LENGTH = {"pokedex": 20, "types": 20, "moves": 50, "abilities": 50}

FOREIGN = [
    ("pokemon_moves", "poke_id", "pokedex", "id"), ("pokemon_moves", "move_id", "moves", "id"),
    ("pokemon_abilities", "poke_id", "pokedex", "id"), ("pokemon_abilities", "ability_id", "abilities", "id"),
    ("moves", "type", "types", "id"),
]


def build_wave1(entity: DataFrame, texts: DataFrame, trees: DataFrame, listing: DataFrame,
                tree_depth: int | None = None) -> dict[str, DataFrame]:
    """Trees are read whatever their depth, unless ``tree_depth`` declares one."""
    return {
        "pokedex": P.entity_table(entity, SH.ENTITY, trees, SH.tree(tree_depth) if tree_depth else None, tree_depth,
                                  texts, SH.TEXTS),
        "types": P.lookup_table(listing, SH.LISTING),
        "pokemon_moves": P.bridge_table(entity, SH.ENTITY, "moves", "move.url", "move_id"),
        "pokemon_abilities": P.bridge_table(entity, SH.ENTITY, "abilities", "ability.url", "ability_id",
                                            distinct=True),
    }


def build_wave2(moves: DataFrame, abilities: DataFrame) -> dict[str, DataFrame]:
    mcols = [F.col("id"), F.col("name"), F.col("pp"), F.col("power").alias("damage"), F.col("accuracy"),
             X.url_id(F.col("type.url"), X.URL_ID_STRICT).alias("type")]
    return {
        "moves": P.described_table(moves, SH.MOVES, mcols),
        "abilities": P.described_table(abilities, SH.ABILITIES, [F.col("id"), F.col("name")]),
    }


def check(spark: SparkSession, out_dir: str) -> DataFrame:
    """One row per rule with its violation count (all zero = valid load):
    primary keys, foreign keys and the declared name lengths."""
    tab = {n: spark.read.parquet(f"{out_dir}/{n}") for n in KEYS}
    parts = [I.unique_violations(tab[n], k, primary=True).agg(F.count(F.lit(1)).alias("violations"))
             .select(F.lit(f"pk:{n}").alias("rule"), "violations") for n, k in KEYS.items()]
    parts += [I.unique_violations(tab[n], ["name"]).agg(F.count(F.lit(1)).alias("violations"))
              .select(F.lit(f"unique:{n}.name").alias("rule"), "violations") for n in NAME_LENGTH]
    parts.append(I.fk_orphan_counts(tab, FOREIGN).select(F.concat(F.lit("fk:"), "child", F.lit("."), "fk").alias("rule"),
                                                         F.col("orphans").alias("violations")))
    parts += [I.domain_violations(tab[n], KEYS[n], {"name": {"max_len": m}})
              .agg(F.count(F.lit(1)).alias("violations"))
              .select(F.lit(f"len:{n}.name<={m}").alias("rule"), "violations")
              for n, m in NAME_LENGTH.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def malformed(sources: dict[str, tuple[DataFrame, T.StructType]]) -> DataFrame:
    """``(source, id, body)`` of the documents that are not JSON of their schema."""
    bad = [J.split_valid(df, schema)[1].select(F.lit(name).alias("source"), F.col("id").cast("string").alias("id"), "body")
           for name, (df, schema) in sources.items()]
    out = bad[0]
    for b in bad[1:]:
        out = out.unionByName(b)
    return out


def lost_ids(entity: DataFrame, listing: DataFrame, moves: DataFrame) -> DataFrame:
    """(rule, violations): URLs whose id is too large for its INTEGER column. The tables have NULL
    there, where a cast in the database would have ended the load."""
    def urls(df, schema, column):
        return df.select(J.parse(F.col("body"), schema).alias("j")).select(column.alias("url"))

    j = F.col("j")
    found = [urls(entity, SH.ENTITY, F.explode(J.path_array(j.getField(array), path)))
             for array, path in (("moves", "move.url"), ("abilities", "ability.url"))]
    found += [urls(listing, SH.LISTING, F.explode(J.path_array(j.getField("results"), "url"))),
              urls(moves, SH.MOVES, j.getField("type").getField("url"))]
    every = found[0]
    for f in found[1:]:
        every = every.unionByName(f)
    return every.agg(F.count_if(X.url_id_lost(F.col("url"), X.URL_ID_STRICT)).alias("violations")) \
        .select(F.lit("ids beyond INTEGER").alias("rule"), "violations")


def run(spark: SparkSession, staged: dict[str, DataFrame], fetch: Callable[[str, DataFrame], DataFrame],
        out_dir: str, keep_staging: bool = True, staging_tables: list[str] | None = None) -> DataFrame:
    """Rebuild every table under ``out_dir``; returns the integrity report."""
    w1 = build_wave1(staged["entity"], staged["texts"], staged["trees"], staged["listing"])
    for name, df in w1.items():
        L.rebuild(df, f"{out_dir}/{name}", sort_cols=KEYS[name], cluster=True)
    # second wave depends on the written bridges
    pm = spark.read.parquet(f"{out_dir}/pokemon_moves")
    pa = spark.read.parquet(f"{out_dir}/pokemon_abilities")
    moves = fetch("move", L.pending_keys(pm, "move_id", alias="id"))
    abilities = fetch("ability", L.pending_keys(pa, "ability_id", alias="id"))
    for name, df in build_wave2(moves, abilities).items():
        L.rebuild(df, f"{out_dir}/{name}", sort_cols=KEYS[name], cluster=True)
    own_id = T.StructType([T.StructField("id", T.IntegerType())])
    sources = {"entity": (staged["entity"], SH.ENTITY), "texts": (staged["texts"], SH.TEXTS),
               "trees": (staged["trees"], own_id), "listing": (staged["listing"], SH.LISTING),
               "move": (moves, SH.MOVES), "ability": (abilities, SH.ABILITIES)}
    malformed(sources).write.mode("overwrite").parquet(f"{out_dir}/quarantine")
    held = spark.read.parquet(f"{out_dir}/quarantine").agg(F.count(F.lit(1)).alias("violations")) \
        .select(F.lit("malformed documents").alias("rule"), "violations")
    if not keep_staging:
        for t in staging_tables or []:
            L.drop_table(spark, t)
    return check(spark, out_dir).unionByName(held).unionByName(lost_ids(staged["entity"], staged["listing"], moves))


def rebuild(spark: SparkSession, staged: dict[str, DataFrame], fetch: Callable[[str, DataFrame], DataFrame], root: str,
            tolerated: tuple[str, ...] = ("malformed documents",), keep_staging: bool = True,
            staging_tables: list[str] | None = None) -> str:
    """Rebuild every table in a new version under ``root`` and publish it if its checks hold; returns
    its folder, raises ``NotPublished`` otherwise. Readers ask ``publish.read(spark, root, table)``. Malformed
    documents are set aside in the version's quarantine and do not stop it, unless ``tolerated``
    says so. Staging is removed after publishing only."""
    at = PB.publish(spark, root, lambda path: run(spark, staged, fetch, path), tolerated)
    if not keep_staging:
        for t in staging_tables or []:
            L.drop_table(spark, t)
    return at
