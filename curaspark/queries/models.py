"""Queries of profile models, similarity, the classifier and the whole run."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.config import Params
from curaspark.functions import headers
from curaspark.functions.seq import translated
from curaspark.functions.text import RANKS
from curaspark.operators import classifier, ingest, profiles, similarity, translation
from curaspark.plans.curate import Result, curate
from curaspark.queries import curation as C
from curaspark.queries import table
from curaspark.sources.sinks import format_output

_PRIMERS = {"offset_start": -1, "offset_end": 2, "plen_start": 20, "plen_end": 23, "pad_start": 3, "pad_end": 6}


def _hits(spark: SparkSession, d: str) -> DataFrame:
    """Two hits per sequence of bold_db_targets with coordinates by plain arithmetic, so that all criteria are met and missed."""
    c, i = F.col, F.col("rid") + F.col("domain")
    df = C._bold(spark, d).withColumn("bases", F.length("seq")).filter("bases >= 90").withColumn("domain", F.explode(F.array(F.lit(0), F.lit(1))))
    aa = F.floor((c("bases") - 2) / 3).cast("int")
    df = df.withColumn("target_len", aa).withColumn("frame", F.element_at(F.array(*map(F.lit, (1, 2, 3, -1, -2, -3))), (i % 6 + 1).cast("int")))
    return df.select(
        c("rid").alias("name"), "seq", "bases", "frame", "target_len", F.lit(230).alias("query_len"), (1 + i % 9).cast("int").alias("env_from"), (c("target_len") - i % 11).cast("int").alias("env_to"), (1 + i % 13).cast("int").alias("hmm_from"), (230 - i * 7 % 17).cast("int").alias("hmm_to"),
        (2 + i % 9).cast("int").alias("ali_from"), (c("target_len") - i % 11 - 1).cast("int").alias("ali_to"), (F.lit(30) + i * 31 % 97).cast("double").alias("score"), F.when(i % 19 == 0, 1e-3).otherwise(1e-20).alias("evalue_i"), F.when(i % 23 == 0, 0.5).otherwise(0.9).alias("acc"),
        F.when(i % 5 == 0, F.array((i % 60).cast("int"))).otherwise(F.array().cast("array<int>")).alias("stops"),
    )


def best_hit_coords(spark: SparkSession, d: str) -> DataFrame:
    """Best hits with coordinates, flags and the retained part of the sequence."""
    h = profiles.full_hits(_hits(spark, d))
    return h.select("name", "frame", "nuc_from", "nuc_to", "nuc_len", *[c for c in h.columns if c.startswith("fail_")], "retained", F.when(F.col("retained"), profiles.cut(F.col("seq"), F.col("frame"), F.col("nuc_from"), F.col("nuc_to"))).alias("part"))


def removal_audit(spark: SparkSession, d: str) -> DataFrame:
    """Why records lose their hit, with those that have none."""
    hits = _hits(spark, d)
    return profiles.removal_audit(table(spark, d, "bold_db_targets").select(F.col("bold_row_id").alias("name")), hits)


def amplicon_coords(spark: SparkSession, d: str) -> DataFrame:
    """Amplicon hits with the primers kept and padded."""
    h = profiles.amplicon_hits(_hits(spark, d), primer_info=_PRIMERS)
    return h.select("name", "nuc_from", "nuc_to", "nuc_len", F.round("phmm_cov", 9).alias("phmm_cov"), F.round("amp_cov", 9).alias("amp_cov"), "retained")


def amplicon_coords_trimmed(spark: SparkSession, d: str) -> DataFrame:
    """Amplicon hits with the primers cut off."""
    h = profiles.amplicon_hits(_hits(spark, d), primer_info=_PRIMERS, remove_primers=True, trim=True, min_length=300)
    return h.select("name", "nuc_from", "nuc_to", "nuc_len", F.round("phmm_cov", 9).alias("phmm_cov"), F.round("amp_cov", 9).alias("amp_cov"), "retained")


def hmm_search(spark: SparkSession, d: str) -> DataFrame:
    """All six frames of bold_db_targets searched with a model of the longest sequence."""
    df = C._bold(spark, d).select("rid", "seq")
    first = df.orderBy(F.desc(F.length("seq")), "rid").limit(1).select(F.translate(translated(F.col("seq"), C.CODE), "*", "X").alias("p")).first()
    frames = translation.frames(df, "seq", C.CODE).select("rid", "frame", F.translate("protein", "*", "X").alias("protein"))
    hits = profiles.search(frames, "protein", profiles.build_profile("longest", [first.p]), float(df.count()), 10.0)
    return hits.select("rid", "frame", F.round("score", 3).alias("score"), "hmm_from", "hmm_to", "ali_from", "ali_to", F.round("acc", 4).alias("acc"))


def kmer_cluster(spark: SparkSession, d: str) -> DataFrame:
    """Clusters of all sequences at 97 percent."""
    return similarity.clusters(C._bold(spark, d), "rid", "seq")


def overlap_pid(spark: SparkSession, d: str) -> DataFrame:
    """Identity of all sequences to the longest one."""
    df = C._bold(spark, d).select(F.col("rid").cast("string").alias("name"), "species", "seq")
    keys = df.groupBy().agg(F.max_by(F.struct("name", "species", "seq"), F.struct(F.length("seq"), "name")).alias("k")).select("k.*")
    return similarity.key_identity(keys, df).withColumn("pid", F.round("pid", 9))


def kmer_distances(spark: SparkSession, d: str) -> DataFrame:
    """The nearer of two model sequences of every sequence, by shared k-mers."""
    df = C._bold(spark, d)
    models = [r.s for r in df.groupBy("kingdom").agg(F.max_by("seq", F.struct(F.length("seq"), "rid")).alias("s")).orderBy("kingdom").limit(2).collect()]
    return similarity.closest_model(similarity.kmer_distance(df, "rid", "seq", models), "rid")


def lca_shares(spark: SparkSession, d: str) -> DataFrame:
    """Lowest rank shared by a record and the next one, per step of an identity made of the ids."""
    df = C._lineage(spark, d).select("row_id", *RANKS)
    a = df.select(F.col("row_id").alias("x"), *[F.col(r).alias(f"{r}_a") for r in RANKS])
    b = df.select((F.col("row_id") - 1).alias("x"), *[F.col(r).alias(f"{r}_b") for r in RANKS])
    return similarity.lca_shares(a.join(b, "x").withColumn("identity", (F.col("x") * 7 % 1000) / 1000.0), RANKS)


def idtaxa_train(spark: SparkSession, d: str) -> DataFrame:
    """Problem sequences of a classifier trained on all sequences, with the defaults of a run."""
    p = Params()
    _, problems, _ = classifier.train(C._bold(spark, d), max_group_size=p.idtaxa_max_group_size, max_iterations=p.idtaxa_max_iterations, allow_group_removal=p.idtaxa_allow_group_removal, seed=p.seed, with_model=False)
    return problems


def formatted(spark: SparkSession, d: str) -> DataFrame:
    """Records as they go out, with root and without gaps."""
    df = ingest.named(table(spark, d, "bold_db_targets").withColumns({r: headers.unclassified(F.col(r)) for r in RANKS}).withColumn("tid", F.concat(F.lit("BOLD:"), "bold_taxid")), "processid", "tid")
    return format_output(df.select("name", F.col("nuc").alias("seq")))


def _records(spark: SparkSession, d: str) -> DataFrame:
    """bold_db_targets as records of a source."""
    df = table(spark, d, "bold_db_targets").withColumns({r: headers.unclassified(F.col(r)) for r in RANKS}).withColumn("taxid", F.concat(F.lit("BOLD:"), "bold_taxid"))
    df = ingest.named(df, "processid", "taxid").select("name", F.col("processid").alias("seqid"), "taxid", *RANKS, F.translate("nuc", "-", "").alias("seq")).filter("seq is not null")
    return df


def curation_run(spark: SparkSession, d: str) -> DataFrame:
    """Fates of all sequences over the whole run without model."""
    return curate({"bold": _records(spark, d)}).fate_summary


def _run_with_model(spark: SparkSession, d: str) -> Result:
    """The whole run with a model of the protein of the longest sequence of the largest genus, and an amplicon's model that is its inner half.

    The table's sequences are made up, so stops lie everywhere: they are read by a genetic code without stops, ambiguous ones stay, and limits are low.
    """
    code = 27
    df = C._bold(spark, d)
    genus = df.filter("genus <> 'Unclassified'").groupBy("genus").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "genus").first().genus
    longest = df.filter(F.col("genus") == genus).orderBy(F.desc(F.length("seq")), "rid").limit(1).select(F.translate(translated(F.col("seq"), code), "*", "X").alias("p")).first().p
    model = profiles.build_profile("model", [longest])
    m = len(model)
    p = Params(default_code=code, remove_ambiguous=False, phmm_min_score=10.0, phmm_max_evalue=1.0, phmm_min_acc=0.5, phmm_max_gap=1000, phmm_min_cov=0.02, phmm_min_length=30, amplicon_min_length=30)
    return curate({"bold": _records(spark, d)}, p, profile=model, amplicon=(model.part(m // 4 + 1, 3 * m // 4), {}))


def curation_run_model(spark: SparkSession, d: str) -> DataFrame:
    """Fates of all sequences over the whole run with models."""
    return _run_with_model(spark, d).fate_summary


QUERIES = {f.__name__: f for f in (best_hit_coords, removal_audit, amplicon_coords, amplicon_coords_trimmed, hmm_search, kmer_cluster, overlap_pid, kmer_distances, lca_shares, idtaxa_train, formatted, curation_run, curation_run_model)}

# --- SQL
_HITS = f"""{C._BOLD}, h0 AS (SELECT rid AS name, seq, len(seq) AS bases, (len(seq) - 2) // 3 AS target_len, unnest([rid, rid + 1]) AS i FROM bo WHERE len(seq) >= 90),
h AS (SELECT *, ([1, 2, 3, -1, -2, -3])[i % 6 + 1] AS frame, 230 AS query_len, 1 + i % 9 AS env_from, target_len - i % 11 AS env_to, 1 + i % 13 AS hmm_from, 230 - i * 7 % 17 AS hmm_to, 2 + i % 9 AS ali_from, target_len - i % 11 - 1 AS ali_to, 30 + i * 31 % 97 AS score,
CASE WHEN i % 19 = 0 THEN 1e-3 ELSE 1e-20 END AS evalue_i, CASE WHEN i % 23 = 0 THEN 0.5 ELSE 0.9 END AS acc, CASE WHEN i % 5 = 0 THEN i % 60 END AS stop FROM h0),
best AS (SELECT * FROM h {{where}} QUALIFY row_number() OVER (PARTITION BY name ORDER BY score DESC, evalue_i, frame, env_from, env_to) = 1)"""
_FULL = """g AS (SELECT *, greatest(1, env_from - 1) * 3 - (3 - abs(frame)) AS nuc_from, least(target_len, env_to + 1) * 3 + abs(frame) - 1 AS nuc_to FROM best), f0 AS (SELECT *, nuc_to - nuc_from + 1 AS nuc_len FROM g),
f AS (SELECT *, evalue_i > 1e-10 AS fail_max_evalue, score < 50 AS fail_min_score, acc < 0.85 AS fail_min_acc, hmm_from - 1 > 5 AND env_from - 1 > 5 AS fail_max_gap_start, query_len - hmm_to > 5 AND target_len - env_to > 5 AS fail_max_gap_end, coalesce(stop BETWEEN env_from AND env_to, false) AS fail_stop_codon, nuc_len < 100 AS fail_min_length, (hmm_to - hmm_from + 1) / query_len < 0.1 AS fail_min_cov FROM f0),
r AS (SELECT *, NOT (fail_max_evalue OR fail_min_score OR fail_min_acc OR fail_max_gap_start OR fail_max_gap_end OR fail_stop_codon OR fail_min_length OR fail_min_cov) AS retained FROM f)"""
_FLAGS = "fail_max_evalue, fail_min_score, fail_min_acc, fail_max_gap_start, fail_max_gap_end, fail_stop_codon, fail_min_length, fail_min_cov"
_AMP = "a AS (SELECT *, greatest(ali_from - (hmm_from - 1), 1) AS ff, least(ali_to + (query_len - hmm_to), target_len) AS ft FROM best), b AS (SELECT *, hmm_from - 1 - (ali_from - ff) AS sg, query_len - hmm_to - (ft - ali_to) AS eg FROM a), c AS (SELECT *, greatest(1, {start}) AS nuc_from, least(bases, {end}) AS nuc_to FROM b), e AS (SELECT *, nuc_to - nuc_from + 1 AS nuc_len, (hmm_to - hmm_from + 1) / query_len AS cov FROM c) SELECT name, nuc_from, nuc_to, nuc_len, round(cov, 9) AS phmm_cov, round(nuc_len / {ideal}, 9) AS amp_cov, cov >= 0.95 {extra} AS retained FROM e"
SQL = {
    "best_hit_coords": f"WITH {_HITS.format(where='')}, {_FULL} SELECT name, frame, nuc_from, nuc_to, nuc_len, {_FLAGS}, retained, CASE WHEN retained THEN substr(CASE WHEN frame < 0 THEN {C._RC.format('seq')} ELSE seq END, nuc_from, nuc_len) END AS part FROM r",
    "removal_audit": f"WITH {_HITS.format(where='')}, {_FULL} SELECT name, 'excluded_hit' AS removal_type, {_FLAGS} FROM r WHERE NOT retained UNION ALL SELECT DISTINCT bold_row_id, 'no_hit', {', '.join(['NULL'] * 8)} FROM bold_db_targets WHERE bold_row_id NOT IN (SELECT name FROM r)",
    "amplicon_coords": f"WITH {_HITS.format(where='')}, " + _AMP.format(start="ff * 3 - 2 + least(0, -1 + sg * 3 - 3)", end="ft * 3 + greatest(0, 2 - eg * 3 + 6)", ideal="(query_len * 3 + 1 + 2 + 3 + 6)", extra=""),
    "amplicon_coords_trimmed": f"WITH {_HITS.format(where='')}, " + _AMP.format(start="ff * 3 - 2 + greatest(0, 20 - 1 - sg * 3)", end="ft * 3 - greatest(0, 23 - 2 - eg * 3)", ideal="(query_len * 3 + 1 + 2 - 20 - 23)", extra="AND nuc_len >= 300"),
    "lca_shares": f"WITH {C._LIN}, p AS (SELECT a.row_id AS x, coalesce({', '.join(f'CASE WHEN a.{r} = b.{r} THEN ' + chr(39) + r + chr(39) + ' END' for r in reversed(RANKS))}, 'none') AS rank FROM lin a JOIN lin b ON b.row_id - 1 = a.row_id), g AS (SELECT round(floor((x * 7 % 1000) / 1000 / 0.01) * 0.01, 6) AS identity, rank, count(*) AS n FROM p GROUP BY ALL) SELECT *, round(n / sum(n) OVER (PARTITION BY identity), 9) AS share FROM g",
    "formatted": f"WITH x AS (SELECT processid, bold_taxid, nuc, {', '.join(f'CASE WHEN {C.S.missing(r)} THEN ' + chr(39) + 'Unclassified' + chr(39) + f' ELSE {C.S.trimmed(r)} END AS {r}' for r in RANKS)} FROM bold_db_targets) SELECT regexp_replace(regexp_replace(concat_ws(';', coalesce(processid, 'NA') || '|' || coalesce('BOLD:' || bold_taxid, 'NA'), {', '.join(RANKS)}), ' +', ' ', 'g'), '^([^;]*);', '\\1;Root;') AS name, replace(replace(nuc, '-', ''), '.', '') AS seq FROM x",
}
