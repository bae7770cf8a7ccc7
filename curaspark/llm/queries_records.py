"""Queries of problems 1 (representatives), 2 (canonical names) and 4 (caps per contributor)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions.text import BLANK, RANKS
from curaspark.llm import canonical, capping, truth
from curaspark.queries import sqltext as S
from curaspark.queries import table

CAP = 25
#: The largest share of all rows that a genus contributes to p4_genus_share.
SHARE = 0.001


def p1_survivors(spark: SparkSession, d: str) -> DataFrame:
    """One surviving row per record of lineage."""
    return truth.survivors(table(spark, d, "lineage"), table(spark, d, "source_trust"))


def p1_uncontested(spark: SparkSession, d: str) -> DataFrame:
    """The records with both keys, and their ranks on which all filled values agree; null where they differ."""
    s = p1_survivors(spark, d).filter("acc is not null and tax is not null")
    rows = truth.keyed(table(spark, d, "lineage"))
    agreed = rows.groupBy("acc", "tax").agg(*[F.when(F.min(r) == F.max(r), F.max(r)).alias(f"a_{r}") for r in RANKS])
    return s.join(agreed, ["acc", "tax"]).select("acc", "tax", "n_rows", "loaded_at", *[F.when(F.col(f"a_{r}").isNotNull(), F.col(r)).alias(r) for r in RANKS])


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows that are no worse than every other row of their record and better in something."""
    return truth.dominating(p1_survivors(spark, d))


def p2_mapped(spark: SparkSession, d: str) -> DataFrame:
    """Every row of bold_db_targets with the canonical family and whether it was exact, mapped, missing or unmatched."""
    return canonical.mapped(table(spark, d, "bold_db_targets"), table(spark, d, "ncbi_synonyms_filtered"), "bold_row_id", "family", "order_name")


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """Rows whose family is typed otherwise but means one canonical family."""
    return p2_mapped(spark, d).filter("status = 'mapped'").select("bold_row_id", "tax_name")


def p2_misses(spark: SparkSession, d: str) -> DataFrame:
    """Family values that mean no canonical family, with their rows."""
    return p2_mapped(spark, d).filter("status = 'unmatched'").groupBy("family").agg(F.count(F.lit(1)).alias("n_rows"))


def _scored(spark: SparkSession, d: str) -> DataFrame:
    """lineage with a null for a quality that is not a number."""
    return table(spark, d, "lineage").withColumn("quality", F.nanvl("quality", F.lit(None).cast("double")))


def p4_capped(spark: SparkSession, d: str) -> DataFrame:
    """lineage with at most CAP rows per species."""
    return capping.capped(_scored(spark, d), capping.species_key(F.col("species"), F.col("genus")), "row_id", F.col("quality"), CAP)


def p4_genus(spark: SparkSession, d: str) -> DataFrame:
    """lineage with at most CAP rows per genus."""
    return capping.capped(_scored(spark, d), capping.genus_key(F.col("genus")), "row_id", F.col("quality"), CAP)


def p4_genus_share(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the rows of lineage that stay when no genus may have more than SHARE of the rows with a genus."""
    return capping.capped(_scored(spark, d).select("row_id", "genus", "quality"), capping.genus_key(F.col("genus")), "row_id", F.col("quality"), share=SHARE).select("row_id")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Kept rows of the species with more than CAP rows."""
    kept, _ = capping.over_cap(table(spark, d, "lineage"), capping.species_key(F.col("species"), F.col("genus")), "row_id", F.col("quality"), CAP)
    return kept.select("row_id")


QUERIES = {"p1_survivors": p1_survivors, "p1_uncontested": p1_uncontested, "p1_found": p1_found, "p2_mapped": p2_mapped, "p2_found": p2_found, "p2_misses": p2_misses, "p4_capped": p4_capped, "p4_genus": p4_genus, "p4_genus_share": p4_genus_share, "p4_found": p4_found}

_ACC = f"regexp_replace(regexp_extract(regexp_replace(upper({S.narrow('seqid')}), '^[A-Z]+[:|]', ''), '^[^./;,|]+'), '[^A-Z0-9]', '', 'g')"
_TAX = f"upper({S.narrow('taxid')})"
_RECORDS = f"""a AS (SELECT *, {_ACC} AS a0, {_TAX} AS t0 FROM lineage),
b AS (SELECT row_id, loaded_at, {" + ".join(f"(NOT {S.missing(r)})::INT" for r in ("kingdom", "phylum", "class_name", "order_name", "family", "genus", "species"))} AS filled, coalesce((SELECT max(trust) FROM source_trust t WHERE t.source = a.source), -1) AS trust,
CASE WHEN regexp_full_match(a0, '[A-Z]{{2}}[0-9OIL]{{7}}') THEN substr(a0, 1, 2) || translate(substr(a0, 3), 'OIL', '011') WHEN regexp_full_match(a0, '[A-Z]{{5}}[0-9OIL]{{7}}') THEN substr(a0, 1, 5) || translate(substr(a0, 6), 'OIL', '011') WHEN regexp_full_match(a0, 'LAB[0-9OIL]{{11}}') THEN 'LAB' || translate(substr(a0, 4), 'OIL', '011') ELSE nullif(a0, '') END AS acc,
CASE WHEN regexp_extract(t0, '^[A-Z]*[:_|]?0*(\\d+)$', 1) <> '' THEN CASE WHEN regexp_matches(t0, '^(NCBI|BOLD|INTERNAL)[:_|]?\\d+$') THEN regexp_extract(t0, '^[A-Z]+') ELSE 'NCBI' END || ':' || regexp_extract(t0, '^[A-Z]*[:_|]?0*(\\d+)$', 1) END AS tax FROM a)"""
_SP = f"trim(regexp_replace(regexp_replace(lower(species), '<[^>]*>|\\([^)]*\\)|[\"''“”„‘’«»]', '', 'g'), '(?:{BLANK}|[_+])+', ' ', 'g'))"
_WHO = f"""s AS (SELECT *, {_SP} AS s0, lower({S.rank_key("genus")}) AS g0 FROM lineage),
w AS (SELECT *, CASE WHEN NOT {S.missing("species")} AND s0 NOT IN ('', 'none', 'unclassified') AND NOT regexp_matches(s0, '[.0-9]') THEN CASE WHEN contains(s0, ' ') THEN split_part(s0, ' ', 1) || ' ' || split_part(s0, ' ', 2) WHEN g0 <> s0 THEN g0 || ' ' || s0 END END AS who FROM s)"""


def _ranked(who: str) -> str:
    return f"r AS (SELECT *, row_number() OVER (PARTITION BY {who} ORDER BY CASE WHEN quality BETWEEN 0 AND 100 AND NOT isnan(quality) THEN quality ELSE -1 END DESC, row_id) AS rn, count(*) OVER (PARTITION BY {who}) AS cnt FROM w)"


_DROP = "EXCLUDE (s0, g0, who, rn, cnt) REPLACE (CASE WHEN NOT isnan(quality) THEN quality END AS quality)"
SQL = {
    "p1_found": f"""WITH {_RECORDS}, m AS (SELECT *, max(filled) OVER r AS mf, max(loaded_at) OVER r AS ml, max(trust) OVER r AS mt, count(*) OVER r AS n FROM b WHERE acc IS NOT NULL AND tax IS NOT NULL WINDOW r AS (PARTITION BY acc, tax))
SELECT min(row_id) AS row_id FROM m WHERE n > 1 AND filled = mf AND loaded_at = ml AND trust = mt GROUP BY acc, tax HAVING count(*) = 1""",
    "p1_uncontested": f"""WITH {_RECORDS}, v AS (SELECT b.acc, b.tax, b.loaded_at, {", ".join(f"{S.rank_key('a.' + r)} AS {r}" for r in RANKS)} FROM b JOIN a USING (row_id) WHERE acc IS NOT NULL AND tax IS NOT NULL)
SELECT acc, tax, count(*) AS n_rows, max(loaded_at) AS loaded_at, {", ".join(f"CASE WHEN min({r}) = max({r}) THEN max({r}) END AS {r}" for r in RANKS)} FROM v GROUP BY acc, tax""",
    "p4_genus_share": f"WITH {_WHO}, {_ranked('g0')} SELECT row_id FROM r WHERE g0 IS NULL OR rn <= greatest(1, floor({SHARE} * (SELECT count(g0) FROM r)))",
    "p4_capped": f"WITH {_WHO}, {_ranked('who')} SELECT * {_DROP} FROM r WHERE who IS NULL OR rn <= {CAP}",
    "p4_genus": f"WITH {_WHO}, {_ranked('g0')} SELECT * {_DROP} FROM r WHERE g0 IS NULL OR rn <= {CAP}",
    "p4_found": f"WITH {_WHO}, {_ranked('who')} SELECT row_id FROM r WHERE who IS NOT NULL AND cnt > {CAP} AND rn <= {CAP}",
}
