"""Composite pipelines: staged documents -> normalised entity table.

``entity_table`` is the normalisation step of the workload, expressed once:

    entities (parsed once) -> indexed stats, type array, species name
    LEFT JOIN family lookup (tree names exploded, one row per name)
    + first matching text entry, computed in-row (no window, no join)

It takes the three staged document sets separately (entity, tree and text
documents, each ``(id, body)``), so it applies equally to reference-shaped
fixtures and to the documents derived from the driver tables.

Plan shape: one scan per staged source, ``from_json`` pruned to the fields
used, one aggregation (family dedup, partial agg), one join for the family and
one for the text documents (both on keys that are unique on the build
side, so hot keys only on the probe side, which AQE's skew-join splits).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.functions import jsonpath as J
from nestrel.functions import text as X
from nestrel.operators import entries as E
from nestrel.operators import tree as TR

STAT_NAMES = ["hp", "attack", "defense", "s_attack", "s_defense", "speed"]


def entity_table(entity_docs: DataFrame, entity_schema: T.StructType,
                 tree_docs: DataFrame, tree_schema: T.StructType | None, tree_depth: int | None,
                 text_docs: DataFrame | None, text_schema: T.StructType | None,
                 lang: str = "en", child_key: str = "evolves_to",
                 height: str = "height", weight: str = "weight") -> DataFrame:
    """One row per entity document. With a ``tree_depth`` the trees are read with the schema
    of that depth; without, whatever their depth. Malformed entity documents are left out:
    ``jsonpath.split_valid`` returns them, ``etl.run`` writes them to its quarantine."""
    ent = J.split_valid(entity_docs, entity_schema)[0].select("j.*").drop(J.CORRUPT)
    stats = [J.index(F.col("stats"), i).base_stat.alias(n) for i, n in enumerate(STAT_NAMES)]
    pd = ent.select(F.col("id"), J.field(F.col("species"), "name").alias("name"),
                    F.col(height).alias("height"), F.col(weight).alias("weight"), *stats,
                    J.path_array(F.col("types"), "type.name").alias("type"))

    if tree_depth is None:
        own = T.StructType([T.StructField("id", ent.schema["id"].dataType)])
        fam = TR.family_of_any_depth(tree_docs.select(J.parse(F.col("body"), own).id.alias("id"), "body"),
                                     "evo_set", child_key=child_key)
    else:
        trees = tree_docs.select(J.parse(F.col("body"), tree_schema).alias("j")) \
            .select(F.col("j.id").alias("evo_set"), F.col("j.chain").alias("chain"))
        fam = TR.family_by_name(trees, "evo_set", TR.all_names(F.col("chain"), tree_depth, child_key))
    out = pd.join(fam, "name", "left")

    if text_docs is not None:
        txt = text_docs.select(J.parse(F.col("body"), text_schema).alias("j")).select(
            F.col("j.id").alias("id"),
            X.clean_flavor(E.first_in_array(
                F.col("j.flavor_text_entries"),
                lambda e: e.language.getField("name") == F.lit(lang),
                lambda e: e.flavor_text)).alias("info"))
        out = out.join(txt, "id", "left")
    else:
        out = out.withColumn("info", F.lit(None).cast("string"))
    return out.select("id", "name", "height", "weight", *STAT_NAMES, "type", "evo_set", "info")


def build_entity(spark: SparkSession, sf_dir: str, render_arrays: bool = True,
                 documents: DataFrame | None = None, labels: DataFrame | None = None) -> DataFrame:
    """The entity pipeline on documents derived from the driver tables.

    The three staged sources are derived per document row (``plans.docs``):
    species = source, stats = line/word counts, types = [lang],
    tree = source -> lines -> sentences, entries = lines.
    """
    from nestrel.plans import docs as D
    from nestrel.sources.tables import table, text_table
    if documents is None:
        documents = text_table(spark, sf_dir, "documents")
    if labels is None:
        labels = table(spark, sf_dir, "labels")
    out = entity_table(D.text_entity_docs(documents, labels), D.TEXT_ENTITY_SCHEMA,
                       D.outline_docs(documents), D.OUTLINE_SCHEMA, D.OUTLINE_DEPTH,
                       D.entries_docs(documents), D.ENTRIES_SCHEMA,
                       height="n_chars", weight="quality")
    if render_arrays:
        out = out.withColumn("type", F.array_join("type", ","))
    return out


def lookup_table(listing_docs: DataFrame, schema: T.StructType) -> DataFrame:
    """Listing page -> ``(id, name)``: parallel unnest of ``results[].url`` and
    ``results[].name`` (zipped, not crossed), id taken from the URL."""
    j = listing_docs.select(J.parse(F.col("body"), schema).alias("j"))
    rows = j.select(F.inline(F.col("j.results")))
    return rows.select(X.url_id(F.col("url"), X.URL_ID_STRICT).alias("id"), F.col("name"))


def bridge_table(entity_docs: DataFrame, schema: T.StructType, array_field: str, url_path: str,
                 right_key: str, distinct: bool = False, left_key: str = "poke_id") -> DataFrame:
    """Entity -> ``(left_key, right_key)`` pairs from the ids in an array of URLs. An entry
    without a URL gives no pair; a URL without an id gives a NULL ``right_key``.

    ``distinct`` de-duplicates pairs (sources that list an item twice)."""
    j = entity_docs.select(J.parse(F.col("body"), schema).alias("j"))
    urls = J.path_array(F.col(f"j.{array_field}"), url_path)
    out = j.select(F.col("j.id").alias(left_key), F.explode(urls).alias("__u")) \
        .where(F.col("__u").isNotNull()) \
        .select(left_key, X.url_id(F.col("__u"), X.URL_ID_STRICT).alias(right_key))
    return out.dropDuplicates([left_key, right_key]) if distinct else out


def described_table(docs: DataFrame, schema: T.StructType, columns: list, lang: str = "en") -> DataFrame:
    """Documents -> typed rows + ``info``: the first ``lang`` flavour text
    (cleaned of line/form feeds), else the first ``lang`` effect text (cleaned
    of double line feeds, line feeds, form feeds and double spaces).

    All in-row: no window, no join back, no shuffle. Malformed documents give no row
    (``jsonpath.split_valid`` returns them).
    """
    j = J.split_valid(docs, schema)[0].select("j.*").drop(J.CORRUPT)

    def first(field, text_field):
        return E.first_in_array(F.col(field), lambda e: e.language.getField("name") == F.lit(lang),
                                lambda e: e.getField(text_field))
    info = F.coalesce(X.clean_flavor(first("flavor_text_entries", "flavor_text")),
                      X.clean_effect(first("effect_entries", "effect")))
    return j.select(*columns, info.alias("info"))
