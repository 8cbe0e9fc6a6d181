"""Queries over what the library keeps: typed loads, index segments, block postings, trees of any depth.

They register themselves in the catalogue.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from nestrel.functions import porter2 as PO
from nestrel.functions import search as S
from nestrel.operators import blocks as B
from nestrel.operators import keystore as KS
from nestrel.operators import relate as R
from nestrel.operators import search as FTS
from nestrel.operators import segments as SG
from nestrel.operators import treeorder as TO
from nestrel.plans import docs as D
from nestrel.plans.catalog import _TOKENS, OR_QUERY, PROBE_TWO, _query_sql, _tok_sql, part_types, query, t
from nestrel.sources import publish as PB
from nestrel.sources import typed as TY

TOKENS_SQL = _tok_sql(_TOKENS)


def query_sql(text: str) -> str:
    return _query_sql(_TOKENS, text)


# ============================================================== typed load
# Staged pages as texts, the way they are scraped; the target declares what a page must be.
# The declaration.
PAGE_TARGET = [
    TY.Field("page_id", "bigint", required=True), TY.Field("host", "string", required=True, max_len=24),
    TY.Field("lang", "string", required=True, max_len=2), TY.Field("item", "smallint", required=True, high=900),
    TY.Field("page_no", "decimal(5,2)"), TY.Field("size", "tinyint", required=True)]

_RAW_PAGES = r"""
WITH raw AS (
  SELECT CAST(page_id AS VARCHAR) AS page_id, regexp_extract(url, '//([^/]+)/', 1) AS host,
         regexp_extract(url, '//[^/]+/([^/]+)/', 1) AS lang, regexp_extract(url, '//[^/]+/[^/]+/([^?#]*)', 1) AS item,
         nullif(regexp_extract(url, '[?&]page=([0-9]+)', 1), '') AS page_no, length(html) / 100 AS size
  FROM pages)"""
_ITEM_OK, _SIZE_OK = "regexp_full_match(item, '[0-9]+') AND CAST(item AS BIGINT) <= 900", "round(size) <= 127"


def raw_pages(spark, d):
    url = F.col("url")
    return t(spark, d, "pages").select(
        F.col("page_id").cast("string").alias("page_id"), F.regexp_extract(url, "//([^/]+)/", 1).alias("host"),
        F.regexp_extract(url, "//[^/]+/([^/]+)/", 1).alias("lang"),
        F.regexp_extract(url, "//[^/]+/[^/]+/([^?#]*)", 1).alias("item"),
        F.nullif(F.regexp_extract(url, "[?&]page=([0-9]+)", 1), F.lit("")).alias("page_no"),
        (F.length("html") / 100).alias("size"))


@query("typed_load", _RAW_PAGES + f"""
SELECT CAST(page_id AS BIGINT) AS page_id, host, lang, CAST(item AS SMALLINT) AS item,
       CAST(CAST(page_no AS DECIMAL(5, 2)) AS DOUBLE) AS page_no, CAST(round(size) AS TINYINT) AS size
FROM raw WHERE length(host) <= 24 AND length(lang) <= 2 AND CASE WHEN {_ITEM_OK} THEN true ELSE false END AND {_SIZE_OK}""")
def q_typed_load(spark, d):
    loaded = TY.accepted(raw_pages(spark, d), PAGE_TARGET)
    return loaded.withColumn("page_no", F.col("page_no").cast("double"))       # a decimal, in a type both engines print alike


@query("typed_load_rejects", _RAW_PAGES + f"""
SELECT page_id, 'host' AS "column", 'length' AS reason, host AS value FROM raw WHERE length(host) > 24
UNION ALL SELECT page_id, 'lang', 'length', lang FROM raw WHERE length(lang) > 2
UNION ALL SELECT page_id, 'item', CASE WHEN regexp_full_match(item, '[0-9]+') THEN 'range' ELSE 'type' END, item
          FROM raw WHERE NOT CASE WHEN {_ITEM_OK} THEN true ELSE false END
UNION ALL SELECT page_id, 'size', 'range', CAST(size AS VARCHAR) FROM raw WHERE NOT {_SIZE_OK}""")
def q_typed_load_rejects(spark, d):
    return TY.rejected(raw_pages(spark, d), PAGE_TARGET, ["page_id"])

# ============================================================== trees of any depth
# Outlines (source -> lines -> sentences) and threads (every line under the one before it).

_LINES = "string_split(text, chr(10))"


@query("tree_descendants", f"""
WITH lines AS (SELECT doc_id, unnest({_LINES}) AS line FROM documents),
     below AS (SELECT doc_id, source AS ancestor, line AS name, 1 AS steps
               FROM (SELECT doc_id, source, unnest({_LINES}) AS line FROM documents)
               UNION ALL
               SELECT doc_id, source, unnest(string_split(line, '. ')), 2
               FROM (SELECT doc_id, source, unnest({_LINES}) AS line FROM documents)
               UNION ALL
               SELECT doc_id, line, unnest(string_split(line, '. ')), 1 FROM lines)
SELECT doc_id AS id, ancestor, name, CAST(steps AS BIGINT) AS steps FROM below WHERE starts_with(ancestor, 'Th')""")
def q_tree_descendants(spark, d):
    # both sides of the join read the nodes, so they are numbered once
    nodes = PB.written(TO.numbered(D.outline_docs(t(spark, d, "documents")), child_key=D.CHILD), "nodes")
    return TO.descendants(nodes, nodes.where(F.col("name").startswith("Th"))).select("id", "ancestor", "name", "steps")


@query("tree_branches_any_depth", f"""
WITH lines AS (
  SELECT doc_id, n, len(string_split(lines[n], '. ')) AS sentences, len(lines) AS n_lines
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS n
        FROM (SELECT doc_id, {_LINES} AS lines FROM documents WHERE text IS NOT NULL AND source IS NOT NULL)))
SELECT doc_id AS id, CAST(1 + count(*) + sum(sentences) AS BIGINT) AS n_nodes, CAST(max(n) + 2 AS BIGINT) AS depth,
       CAST(sum(sentences) AS BIGINT) AS n_leaves,
       CAST(count(*) FILTER (WHERE sentences + CAST(n < n_lines AS INTEGER) > 1) AS BIGINT) AS n_branching,
       CAST(max(sentences + CAST(n < n_lines AS INTEGER)) AS BIGINT) AS most_children
FROM lines GROUP BY doc_id""")
def q_tree_branches_any_depth(spark, d):
    return TO.shapes(TO.numbered(D.thread_docs(t(spark, d, "documents")), child_key=D.CHILD))

# ============================================================== block postings and segments


@query("array_contains_blocks", """
SELECT p_partkey, p_name FROM part WHERE list_has_all(string_split(p_name, ' '), ['red', 'widget'])""")
def q_array_contains_blocks(spark, d):
    p = part_types(spark, d)
    blocks = B.build_blocks(FTS.build_array_index(p, "p_partkey", "types"), "element", "p_partkey")
    return p.select("p_partkey", "p_name").join(B.containing_all(blocks, PROBE_TWO, "element", "p_partkey"), "p_partkey", "left_semi")


@query("fts_block_index", f"""
WITH postings AS (SELECT DISTINCT unnest({TOKENS_SQL}) AS term, doc_id FROM documents)
SELECT term, doc_id // 8192 AS block, count(*) AS n_ids, min(doc_id) AS low, max(doc_id) AS high,
       CAST(sum(doc_id) AS BIGINT) AS id_sum
FROM postings GROUP BY term, doc_id // 8192""")
def q_fts_block_index(spark, d):
    blocks = B.build_blocks(FTS.build_index(t(spark, d, "documents"), "doc_id", "text", "exact"), "term", "doc_id")
    ids = B.ids_of(F.col("low"), F.col("steps"))
    return blocks.select("term", "block", "n_ids", "low", "high", F.aggregate(ids, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("id_sum"))


@query("fts_any_blocks", f"""
SELECT doc_id, source FROM documents
WHERE list_has_any({TOKENS_SQL}, {query_sql(OR_QUERY)})""")
def q_fts_any_blocks(spark, d):
    docs = t(spark, d, "documents")
    blocks = B.build_blocks(FTS.build_index(docs, "doc_id", "text", "exact"), "term", "doc_id")
    found = B.containing_any(blocks, S.query_lexeme_list(OR_QUERY), "term", "doc_id")
    return docs.select("doc_id", "source").join(found, "doc_id", "left_semi")


@query("fts_segments", f"""
SELECT doc_id AS id FROM (
  SELECT doc_id, CASE WHEN coalesce(toxic, 0) = 1 THEN string_split(text, chr(10))[1] ELSE text END AS text
  FROM documents LEFT JOIN labels USING (doc_id) WHERE coalesce(quality, 1) <> 0)
WHERE list_has_any({TOKENS_SQL}, {query_sql(OR_QUERY)})""")
def q_fts_segments(spark, d):
    """All documents arrive in three batches, a replay of the second and a merge between
    them; a fourth one deletes those labelled bad, a fifth replaces texts labelled toxic by
    their first lines."""
    root = PB.scratch_path(spark, "index")
    docs = t(spark, d, "documents").join(t(spark, d, "labels"), "doc_id", "left")
    change = [F.col("doc_id").alias("id"), "text", F.lit(False).alias("deleted"), F.lit(1).cast("bigint").alias("seq")]
    part = F.pmod("doc_id", F.lit(3))
    for number in (0, 1, 1, 2):
        SG.apply_changes(docs.where(part == number).select(*change), root, number)
        if number == 1:
            SG.merge(spark, root)
    SG.apply_changes(docs.where("quality = 0").select("doc_id", F.lit(None).cast("string").alias("text"))
                     .select(F.col("doc_id").alias("id"), "text", F.lit(True).alias("deleted"), F.lit(1).cast("bigint").alias("seq")), root, 3)
    first = docs.where("toxic = 1 AND coalesce(quality, 1) <> 0").withColumn("text", F.split("text", "\n")[0])
    SG.apply_changes(first.select(*change), root, 4)
    return SG.search(spark, root, OR_QUERY)

# ============================================================== stemmed index
# The same published algorithm in SQL, one step after the other over the distinct words.


def _case(word: str, rules: dict[str, str]) -> str:
    return f"CASE {word} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.items()) + " END"


def _suffix_sql(suffixes) -> str:
    return f"regexp_extract(w, '({'|'.join(suffixes)})$', 1)"


def _step_sql(name: str, source: str, rules: dict[str, str], region: str, unless: str) -> str:
    return f"""{name} AS (
  SELECT t, done, r1, r2, CASE WHEN s <> '' AND length(w) - length(s) >= {region} AND NOT ({unless})
                               THEN left(w, length(w) - length(s)) || {_case('s', rules)} ELSE w END AS w
  FROM (SELECT *, {_suffix_sql(rules)} AS s FROM {source}))"""


_SHORT = "'(^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$'"
_PREFIX = f"'^({'|'.join(PO.R1_PREFIXES)})'"
_AFTER_1A = ", ".join(f"'{w}'" for w in sorted(PO.EXCEPTIONS_AFTER_1A))
STEM_SQL = f"""
begun AS (
  SELECT t, CASE WHEN length(t) <= 2 THEN t ELSE {_case('t', PO.EXCEPTIONS)} END AS done,
         array_to_string(list_transform(range(1, length(u) + 1), lambda i:
           CASE WHEN u[i] = 'y' AND i > 1 AND contains('aeiouy', u[i - 1]) THEN 'Y' ELSE u[i] END), '') AS w
  FROM (SELECT t, regexp_replace(ltrim(t, chr(39)), '^y', 'Y') AS u FROM words)),
first_region AS (
  SELECT *, CASE WHEN regexp_matches(w, {_PREFIX}) THEN length(regexp_extract(w, {_PREFIX}, 1))
                 WHEN regexp_matches(w, '[aeiouy][^aeiouy]') THEN length(regexp_extract(w, '^(.*?[aeiouy][^aeiouy])', 1))
                 ELSE length(w) END AS r1
  FROM begun),
second_region AS (
  SELECT t, done, r1, w,
         CASE WHEN regexp_matches(substr(w, r1 + 1), '[aeiouy][^aeiouy]')
              THEN r1 + length(regexp_extract(substr(w, r1 + 1), '^(.*?[aeiouy][^aeiouy])', 1)) ELSE length(w) END AS r2
  FROM first_region),
step_1a AS (
  SELECT t, done, r1, r2,
         CASE WHEN suffix(w, 'sses') THEN left(w, length(w) - 2)
              WHEN suffix(w, 'ied') OR suffix(w, 'ies') THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
              WHEN suffix(w, 'us') OR suffix(w, 'ss') THEN w
              WHEN suffix(w, 's') AND regexp_matches(left(w, greatest(length(w) - 2, 0)), '[aeiouy]') THEN left(w, length(w) - 1)
              ELSE w END AS w
  FROM second_region),
step_1b AS (
  SELECT t, coalesce(done, CASE WHEN w IN ({_AFTER_1A}) THEN w END) AS done, r1, r2, s,
         s <> '' AND NOT starts_with(s, 'eed') AND regexp_matches(left(w, length(w) - length(s)), '[aeiouy]') AS fix,
         CASE WHEN starts_with(s, 'eed') THEN CASE WHEN length(w) - length(s) >= r1 THEN left(w, length(w) - length(s)) || 'ee' ELSE w END
              WHEN s <> '' AND regexp_matches(left(w, length(w) - length(s)), '[aeiouy]') THEN left(w, length(w) - length(s))
              ELSE w END AS w
  FROM (SELECT *, {_suffix_sql(PO.STEP1B)} AS s FROM step_1a)),
mended AS (
  SELECT t, done, r1, r2, CASE WHEN NOT fix THEN w WHEN regexp_matches(w, '(at|bl|iz)$') THEN w || 'e'
              WHEN regexp_matches(w, '({"|".join(PO.DOUBLES)})$') THEN left(w, length(w) - 1)
              WHEN r1 >= length(w) AND regexp_matches(w, {_SHORT}) THEN w || 'e' ELSE w END AS w
  FROM step_1b),
step_1c AS (
  SELECT t, done, r1, r2, CASE WHEN regexp_matches(w, '.[^aeiouy][yY]$') THEN left(w, length(w) - 1) || 'i' ELSE w END AS w FROM mended),
{_step_sql("step_2", "step_1c", dict(PO.STEP2), "r1",
           "(s = 'ogi' AND NOT suffix(w, 'logi')) OR (s = 'li' AND NOT regexp_matches(w, '[cdeghkmnrt]li$'))")},
{_step_sql("step_3", "step_2", dict(PO.STEP3), "r1", "s = 'ative' AND length(w) - 5 < r2")},
{_step_sql("step_4", "step_3", dict.fromkeys(PO.STEP4, ""), "r2", "s = 'ion' AND NOT regexp_matches(w, '[st]ion$')")},
stems AS (
  SELECT t, coalesce(done, translate(CASE
         WHEN suffix(w, 'e') AND (length(w) - 1 >= r2 OR (length(w) - 1 >= r1 AND NOT regexp_matches(left(w, length(w) - 1), {_SHORT})))
           THEN left(w, length(w) - 1)
         WHEN suffix(w, 'll') AND length(w) - 1 >= r2 THEN left(w, length(w) - 1) ELSE w END, 'Y', 'y')) AS stem
  FROM step_4)"""


@query("fts_lexemes", f"""
WITH tokens AS (SELECT doc_id, unnest({TOKENS_SQL}) AS t FROM documents), words AS (SELECT DISTINCT t FROM tokens),{STEM_SQL}
SELECT DISTINCT stem AS lexeme, doc_id FROM tokens JOIN stems USING (t)""")
def q_fts_lexemes(spark, d):
    return FTS.build_index(t(spark, d, "documents"), "doc_id", "text", "porter2", "lexeme")

# ============================================================== checks of a batch


def _plain(df):
    return T.StructType([T.StructField(f.name, f.dataType) for f in df.schema])


@query("unique_check_batch", """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1 AND count(*) FILTER (WHERE l_linestatus = 'O') > 0""")
def q_unique_check_batch(spark, d):
    """Lines of status F are the table; the others arrive as a batch."""
    lines = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    store = KS.open_store(spark, PB.scratch_path(spark, "keys"), ["l_orderkey", "l_linenumber"], _plain(lines))
    store.add(lines.where("l_linestatus <> 'O'"), 0, check=False)       # as they are: they repeat keys, too
    return store.violations(lines.where("l_linestatus = 'O'"))


@query("fk_check_batch", """
SELECT l_orderkey, count(*) AS n FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P') GROUP BY l_orderkey""")
def q_fk_check_batch(spark, d):
    """Orders arrive in two batches; lines of orders that are still pending have no parent."""
    orders = t(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    store = KS.open_store(spark, PB.scratch_path(spark, "keys"), ["o_orderkey"], _plain(orders))
    for number, status in enumerate(("F", "O")):
        store.add(orders.where(F.col("o_orderstatus") == status), number)
    return store.missing(t(spark, d, "lineitem"), ["l_orderkey"])

# ============================================================== pages of a result
PAGE_SIZE = 64


@query("page_directory", f"""
SELECT page, count(*) AS n_rows, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key
FROM (SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // {PAGE_SIZE} AS page FROM orders) GROUP BY page""")
def q_page_directory(spark, d):
    pages = R.page_directory(t(spark, d, "orders"), ["o_orderkey"], PAGE_SIZE)
    return pages.select("page", "n_rows", F.col("first.o_orderkey").alias("first_key"), F.col("last.o_orderkey").alias("last_key"))
