"""An inverted index that is kept up to date by appending.

Every batch of changes becomes one segment of postings and one list of the ids it
changed; both are folders named by the batch, so a batch that is replayed writes the
same folders, and an entry in a ledger makes it visible. A posting counts as long as
no later batch lists its id: later texts replace earlier ones, deletions leave nothing.
``merge`` writes the postings that count as a new base, range-clustered by term and id,
and with one ledger entry readers go over to it. Nothing is changed in place, so readers
are never disturbed, and a killed run leaves only folders that nobody reads.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from nestrel.functions.search import lexemes, query_lexeme_list
from nestrel.operators.search import write_index
from nestrel.sources.publish import append_entry, entries, written

CHANGES = "id long, text string, deleted boolean, seq long"      # a NULL ``deleted`` is false
POSTINGS, LOG = "term string, id long", "id long"


def _state(spark: SparkSession, root: str) -> tuple[dict | None, list[int]]:
    """(newest base, batches committed after it)."""
    known = entries(spark, f"{root}/ledger")
    bases = [e for e in known if "base" in e]
    base = max(bases, key=lambda e: (e["upto"], e["base"])) if bases else None
    return base, sorted({e["batch"] for e in known if "batch" in e and (not base or e["batch"] > base["upto"])})


def apply_changes(changes: DataFrame, root: str, batch: int, kind: str = "exact") -> bool:
    """Add one batch of changes (``CHANGES``); False if it had been added before. Of several changes of
    an id in one batch the one with the largest ``seq`` counts. Changes without an id are ignored."""
    spark = changes.sparkSession
    base, later = _state(spark, root)
    if batch in later or (base and batch <= base["upto"]):
        return False
    last = (changes.where("id IS NOT NULL").groupBy("id")
            .agg(F.max_by(F.struct("text", F.coalesce("deleted", F.lit(False)).alias("deleted")), F.coalesce("seq", F.lit(0))).alias("x"))
            .select("id", "x.text", "x.deleted"))
    path = f"{root}/changed/batch={batch}"
    # the terms are made once; ranges are found in a first pass over them and filled in a second one
    last.select("id", F.when(~F.col("deleted"), lexemes(F.col("text"), kind)).alias("terms")).write.mode("overwrite").parquet(path)
    held = spark.read.schema("id long, terms array<string>").parquet(path)
    write_index(held.select(F.explode("terms").alias("term"), "id"), f"{root}/segments/batch={batch}", id_col="id")
    append_entry(spark, f"{root}/ledger", {"batch": batch})
    return True


def postings(spark: SparkSession, root: str, terms: Sequence[str] | None = None) -> DataFrame:
    """The (term, id) rows that count now, of ``terms`` only if given (a filter that reaches
    the scans). The lists of changed ids since the last merge are all that is joined."""
    base, later = _state(spark, root)

    def segment(path, batch):
        some = spark.read.schema(POSTINGS).parquet(path)
        return (some if terms is None else some.where(F.col("term").isin(list(terms)))).withColumn("batch", F.lit(batch))

    parts = [segment(base["base"], -1)] if base else []
    parts += [segment(f"{root}/segments/batch={b}", b) for b in later]
    if not parts:
        return spark.createDataFrame([], POSTINGS)
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    if later:
        changed = spark.read.schema("id long, batch int").option("basePath", f"{root}/changed") \
            .parquet(*[f"{root}/changed/batch={b}" for b in later])
        newest = changed.groupBy("id").agg(F.max("batch").alias("newest"), F.min("batch").alias("oldest"))
        if not base:                    # ids that one batch lists lose no posting
            newest = newest.where("oldest < newest")
            if terms is None:           # all postings are joined: with a table whose size is known, mostly a small one
                newest = written(newest, "replaced")
        found = found.join(newest, "id", "left").where("newest IS NULL OR newest <= batch")
    return found.select("term", "id")


def search(spark: SparkSession, root: str, query: str, kind: str = "exact") -> DataFrame:
    """Ids of the texts that hold a term of the OR query, as the index stands now."""
    return postings(spark, root, query_lexeme_list(query, kind)).select("id").distinct()


def merge(spark: SparkSession, root: str, partitions: int | None = None) -> bool:
    """Fold all committed batches into a new base; False if there is none to fold."""
    _, later = _state(spark, root)
    if not later:
        return False
    path = f"{root}/base/{uuid.uuid4().hex}"
    write_index(postings(spark, root), path, partitions=partitions, id_col="id")
    append_entry(spark, f"{root}/ledger", {"base": path, "upto": later[-1]})
    return True


def feed(spark: SparkSession, source_dir: str, root: str, checkpoint: str, kind: str = "exact", fmt: str = "parquet",
         merge_every: int = 0, max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Keep the index up with files of ``CHANGES`` that arrive in a folder; drains what is there, then
    stops. Batches carry the stream's numbers, so a replay after a failure changes nothing;
    with ``merge_every`` n, every n-th batch is followed by a merge."""
    reader = spark.readStream.schema(CHANGES).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)

    def step(batch: DataFrame, number: int) -> None:
        apply_changes(batch, root, number, kind)
        if merge_every and (number + 1) % merge_every == 0:
            merge(batch.sparkSession, root)

    return (reader.load(source_dir).writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
