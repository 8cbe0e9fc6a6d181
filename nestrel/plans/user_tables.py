"""User-state tables kept next to the normalised data: a roster of entities
(``trainer``: serial id, entity id, optional ability id) and per-roster-row
items (``trainer_moves``), with capacity limits on appends.

Every operation recomputes its verdict from the stored tables (no cached
counts that go stale), appends all-or-nothing, and reports what it did:

* ``insert_roster``  whole-table limit ``max_rows``; ids continue from the
  current maximum (numbered inside the batch only)
* ``insert_items``   per-roster-row limit ``max_per_key``
* ``truncate_roster`` empties both tables (children first), so ids restart at 1
* ``truncate_items``  empties the item table only
* ``check``          foreign keys of both tables against the entity tables
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.operators import guard as G
from nestrel.operators import integrity as I

ROSTER = T.StructType([T.StructField("id", T.LongType()), T.StructField("poke_id", T.IntegerType()),
                       T.StructField("ability_id", T.IntegerType())])
ITEMS = T.StructType([T.StructField("trainer_id", T.LongType()), T.StructField("move_id", T.IntegerType())])

# Default limits of the roster and of items per roster row.
MAX_ROWS = 6
MAX_PER_KEY = 4


def _paths(base: str) -> tuple[str, str]:
    return f"{base}/trainer", f"{base}/trainer_moves"


def create(spark: SparkSession, base: str) -> None:
    for path, schema in zip(_paths(base), (ROSTER, ITEMS)):
        G.truncate(spark, path, schema)


def roster(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(ROSTER).parquet(_paths(base)[0])


def items(spark: SparkSession, base: str) -> DataFrame:
    return spark.read.schema(ITEMS).parquet(_paths(base)[1])


def insert_roster(spark: SparkSession, base: str, rows: list[tuple], max_rows: int = MAX_ROWS) -> bool:
    """Append ``(poke_id, ability_id)`` rows (ability may be None) iff the
    table stays within ``max_rows``; returns whether the batch was written."""
    existing = roster(spark, base)
    batch = spark.createDataFrame([(i, p, a) for i, (p, a) in enumerate(rows)],
                                  "seq long, poke_id int, ability_id int")
    verdict = G.table_capacity(existing, batch, max_rows)
    numbered = I.assign_ids(batch, "seq", existing.select("id"), "id", buckets=4) \
        .select("id", "poke_id", "ability_id")
    return G.guarded_append(numbered, verdict, _paths(base)[0])


def insert_items(spark: SparkSession, base: str, rows: list[tuple], max_per_key: int = MAX_PER_KEY) -> bool:
    """Append ``(trainer_id, move_id)`` rows iff no roster row ends up with
    more than ``max_per_key`` items; all or nothing."""
    existing = items(spark, base)
    batch = spark.createDataFrame(rows, ITEMS)
    verdict = G.capacity_check(existing, batch, "trainer_id", max_per_key)
    return G.guarded_append(batch, verdict, _paths(base)[1])


def truncate_roster(spark: SparkSession, base: str) -> None:
    r, i = _paths(base)
    G.truncate_cascade(spark, [(i, ITEMS), (r, ROSTER)])


def truncate_items(spark: SparkSession, base: str) -> None:
    G.truncate(spark, _paths(base)[1], ITEMS)


def check(spark: SparkSession, base: str, entities: DataFrame, abilities: DataFrame,
          moves: DataFrame) -> DataFrame:
    """Orphan counts per foreign key (all zero for a consistent state)."""
    r, it = roster(spark, base), items(spark, base)
    parts = [
        I.fk_orphan_count(r, "poke_id", entities, "id").select(F.lit("trainer.poke_id").alias("fk"), "orphans"),
        I.fk_orphan_count(r, "ability_id", abilities, "id").select(F.lit("trainer.ability_id").alias("fk"), "orphans"),
        I.fk_orphan_count(it, "trainer_id", r, "id").select(F.lit("trainer_moves.trainer_id").alias("fk"), "orphans"),
        I.fk_orphan_count(it, "move_id", moves, "id").select(F.lit("trainer_moves.move_id").alias("fk"), "orphans"),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
