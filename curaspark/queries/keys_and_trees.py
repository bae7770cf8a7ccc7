"""Queries of problems 3 (a few keys hold most records) and 5 (parent links to hierarchies)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions.text import rank_key
from curaspark.operators import dense_keys, hierarchy
from curaspark.queries import sqltext as S
from curaspark.queries import table


def p3_stats(spark: SparkSession, d: str) -> DataFrame:
    """Rows and sums per genus and per family of all lineage records."""
    q = F.col("quality")
    scored = q.between(0, 100) & ~F.isnan(q)
    keys = {"genus": rank_key(F.col("genus")), "family": rank_key(F.col("family"))}
    sums = {"sum_seq_len": F.col("seq_len"), "sum_ambiguous": F.col("n_ambiguous"), "n_scored": F.when(scored, 1).otherwise(0), "sum_quality_cents": F.when(scored, F.round(q * 100).cast("bigint"))}
    return dense_keys.dense_key_stats(table(spark, d, "lineage"), keys, sums)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Genera and families with at least 2 percent of all lineage rows."""
    keys = {"genus": rank_key(F.col("genus")), "family": rank_key(F.col("family"))}
    return dense_keys.heavy_keys(dense_keys.dense_key_stats(table(spark, d, "lineage"), keys, {}), 0.02)


def p5_hierarchy(spark: SparkSession, d: str) -> DataFrame:
    """Path, ranks, depth, root and nested-set range of every node."""
    h = hierarchy.hierarchy(table(spark, d, "nodes"))
    return h.withColumn("path_ids", F.array_join("path_ids", ">")).withColumn("path_ranks", F.array_join("path_ranks", ">"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Nodes that reach themselves over another node, with the smallest id of their cycle."""
    return hierarchy.cycle_nodes(table(spark, d, "nodes"))


QUERIES = {"p3_stats": p3_stats, "p3_found": p3_found, "p5_hierarchy": p5_hierarchy, "p5_found": p5_found}

_SCORED = "quality BETWEEN 0 AND 100 AND NOT isnan(quality)"
_STATS = " UNION ALL ".join(
    f"SELECT '{f}' AS key_field, {S.rank_key(f)} AS key_value, count(*) AS n_rows, coalesce(sum(seq_len), 0)::BIGINT AS sum_seq_len, coalesce(sum(n_ambiguous), 0)::BIGINT AS sum_ambiguous, count(*) FILTER ({_SCORED}) AS n_scored,"
    f" coalesce(sum(CASE WHEN {_SCORED} THEN round(quality * 100) END), 0)::BIGINT AS sum_quality_cents FROM lineage GROUP BY ALL"
    for f in ("genus", "family")
)
_LATEST = f"""raw AS (SELECT tax_id::BIGINT AS id, {S.node_id("parent")} AS p, CASE WHEN coalesce(lower({S.trimmed("rank")}), '') = '' THEN 'no rank' ELSE lower({S.trimmed("rank")}) END AS r, loaded_at FROM nodes WHERE tax_id IS NOT NULL),
one AS (SELECT * FROM raw QUALIFY row_number() OVER (PARTITION BY id ORDER BY loaded_at DESC NULLS LAST, p DESC NULLS LAST, r DESC NULLS LAST) = 1),
latest AS (SELECT id, CASE WHEN p <> id AND p IN (SELECT id FROM one) THEN p END AS parent, r AS rank FROM one)"""
_CYCLES = """walk AS (SELECT id AS start, parent AS here FROM latest WHERE parent IS NOT NULL UNION SELECT w.start, l.parent FROM walk w JOIN latest l ON l.id = w.here WHERE l.parent IS NOT NULL),
cycles AS (SELECT start AS id, min(here) AS low FROM walk GROUP BY start HAVING bool_or(here = start))"""
SQL = {
    "p3_stats": _STATS,
    "p3_found": f"SELECT key_field, key_value FROM ({_STATS}) WHERE key_value IS NOT NULL AND n_rows >= 0.02 * (SELECT count(*) FROM lineage)",
    "p5_found": f"WITH RECURSIVE {_LATEST}, {_CYCLES} SELECT low::INTEGER AS cycle_min_tax_id, id::INTEGER AS tax_id FROM cycles",
    "p5_hierarchy": f"""WITH RECURSIVE {_LATEST}, {_CYCLES},
tree AS (SELECT id, parent, rank, [id] AS ids, [rank] AS ranks FROM latest WHERE parent IS NULL UNION ALL SELECT l.id, l.parent, l.rank, list_append(t.ids, l.id), list_append(t.ranks, l.rank) FROM tree t JOIN latest l ON l.parent = t.id),
below AS (SELECT a AS id, count(*) - 1 AS n FROM (SELECT unnest(ids) AS a FROM tree) GROUP BY a),
placed AS (SELECT *, row_number() OVER (ORDER BY ids) AS lft FROM tree)
SELECT l.id::INTEGER AS tax_id, l.parent::INTEGER AS parent_tax_id, l.rank AS rank, (len(t.ids) - 1)::INTEGER AS depth, t.ids[1]::INTEGER AS root, array_to_string(t.ids, '>') AS path_ids, array_to_string(t.ranks, '>') AS path_ranks, t.lft AS lft, t.lft + b.n AS rgt,
b.n AS n_descendants, c.id IS NOT NULL AS on_cycle, c.low::INTEGER AS cycle_min_tax_id
FROM latest l LEFT JOIN placed t USING (id) LEFT JOIN below b USING (id) LEFT JOIN cycles c USING (id)""",
}
