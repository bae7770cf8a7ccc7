"""Queries of record filters, group filters and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions import headers
from curaspark.functions import seq as Q
from curaspark.functions.text import RANKS, rank_key
from curaspark.operators import filters, reporting, translation
from curaspark.queries import sqltext as S
from curaspark.queries import table

#: Genetic code of the queries on bold_db_targets: invertebrate mitochondrial.
CODE = 5


def _lineage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineage").withColumns({r: F.coalesce(rank_key(F.col(r)), F.lit("Unclassified")) for r in RANKS})


def _bold(spark: SparkSession, d: str) -> DataFrame:
    ranks = {r: F.coalesce(rank_key(F.col(r)), F.lit("Unclassified")) for r in RANKS}
    return table(spark, d, "bold_db_targets").filter("nuc is not null").withColumns(ranks).select(F.col("bold_row_id").alias("rid"), "processid", *RANKS, Q.dealigned(F.upper("nuc")).alias("seq"), "nuc_basecount")


def _fated(spark: SparkSession, d: str) -> DataFrame:
    """lineage with a fate by plain rules, so that reports have all fates to count."""
    fate = F.get(F.array(*[F.lit(f) for f in [*filters.FATES, filters.FINAL]]), (F.pmod(F.col("row_id"), F.lit(10))).cast("int"))
    return _lineage(spark, d).withColumn("fate", fate)


def unclassified_fates(spark: SparkSession, d: str) -> DataFrame:
    """lineage with the verdict of each mode of the unclassified filter."""
    return _lineage(spark, d).select("row_id", *[filters.unclassified(RANKS, m).alias(m) for m in ("all_ranks", "any_ranks", "terminal")])


def filter_duplicates(spark: SparkSession, d: str) -> DataFrame:
    """Records of lineage that repeat the header of an earlier one."""
    df = table(spark, d, "lineage").withColumn("name", headers.header(F.col("seqid"), F.col("taxid"), [headers.unclassified(F.col(r)) for r in RANKS]))
    return filters.filter_duplicates(df, "name", ["loaded_at", "row_id"]).select("row_id", "fate")


def filter_ambiguous(spark: SparkSession, d: str) -> DataFrame:
    """Sequences with ambiguous letters."""
    return filters.filter_ambiguous(table(spark, d, "bold_db_targets"), "nuc").select("bold_row_id", "fate")


def dealigned(spark: SparkSession, d: str) -> DataFrame:
    """Sequences without gaps, their lengths, and reverse complements of the cleaned ones."""
    n = F.col("nuc")
    return table(spark, d, "bold_db_targets").select("bold_row_id", Q.dealigned(n).alias("plain"), Q.gapless_length(n).alias("n"), Q.revcomp(Q.clean_dna(n)).alias("rc"))


def six_frames(spark: SparkSession, d: str) -> DataFrame:
    """Six frames, proteins and stops of every distinct sequence."""
    df = translation.frames(_bold(spark, d).select("rid", "seq"), "seq", CODE)
    return df.select("rid", "frame", "protein", F.array_join(F.col("stops").cast("array<string>"), "|").alias("stops"))


def reading_frames(spark: SparkSession, d: str) -> DataFrame:
    """The frame without stop codons, draws by majority."""
    return translation.reading_frames(_bold(spark, d), "seq", CODE).select("rid", "reading_frame")


def codon_filtered(spark: SparkSession, d: str) -> DataFrame:
    """Sequences with a frame, turned forward; draws left out."""
    return translation.codon_filtered(_bold(spark, d), "seq", CODE, draws="remove").select("rid", "reading_frame", "seq")


def codon_entropy(spark: SparkSession, d: str) -> DataFrame:
    """Entropy of the three codon positions."""
    df = translation.codon_filtered(_bold(spark, d), "seq", CODE, draws="remove")
    return translation.codon_entropy(df.withColumn("seq", F.expr("substr(seq, reading_frame)")), "rid", "seq")


def alignment_entropy(spark: SparkSession, d: str) -> DataFrame:
    """Entropy of each column over all sequences as they stand."""
    return translation.alignment_entropy(table(spark, d, "bold_db_targets").withColumn("s", F.upper("nuc")), "s", max_gaps=0.2)


def mixed_clusters(spark: SparkSession, d: str) -> DataFrame:
    """Consensus families of clusters (order and length) of lineage."""
    df = _lineage(spark, d).select(F.concat_ws("|", "order_name", "seq_len").alias("cluster"), "seqid", "family").filter("seqid is not null")
    return filters.mixed_clusters(df, "cluster", "seqid", "family")


def mixed_clusters_counts(spark: SparkSession, d: str) -> DataFrame:
    """Families of the mixed clusters with their members."""
    df = _lineage(spark, d).select(F.concat_ws("|", "order_name", "seq_len").alias("cluster"), "seqid", "family").filter("seqid is not null")
    return filters.mixed_clusters(df, "cluster", "seqid", "family", returned="counts")


def mixed_clusters_removed(spark: SparkSession, d: str) -> DataFrame:
    """Members that differ from a sure consensus of genera."""
    df = _lineage(spark, d).select(F.concat_ws("|", "family", "seq_len").alias("cluster"), "seqid", "genus").filter("seqid is not null")
    return filters.mixed_clusters(df, "cluster", "seqid", "genus", 0.6, "all").select("cluster", "seqid", "taxon", "consensus", "confidence")


def rank_groups(spark: SparkSession, d: str) -> DataFrame:
    """Records per hash of the lineage down to the genus."""
    return _lineage(spark, d).withColumn("h", filters.rank_hash(RANKS[:6])).groupBy("h").agg(F.count(F.lit(1)).alias("n"))


def redundant_absorbed(spark: SparkSession, d: str) -> DataFrame:
    """Identical and contained sequences of each species, absorbed and counted."""
    return filters.absorbed(_bold(spark, d), ["species"], "rid", "seq")


def weighted_centres(spark: SparkSession, d: str) -> DataFrame:
    """The embedding of each label with the least weighted median distance."""
    df = table(spark, d, "embeddings").withColumn("w", F.col("vec_id") % 3 + 1)
    return filters.centres(df, ["label"], "vec_id", "embedding", "w", "vector").select("label", "centre")


def prune_groups_length(spark: SparkSession, d: str) -> DataFrame:
    """Representatives by length, five a lineage, internal ones first among equals."""
    df = _bold(spark, d).withColumn("source", F.when(F.col("rid") % 5 == 0, "internal").otherwise("bold"))
    return filters.select_final(df, 5, "length").select("rid", "fate")


def source_fate_join(spark: SparkSession, d: str) -> DataFrame:
    """Sources and fates of lineage's records joined on the accession."""
    a = _fated(spark, d).filter("seqid is not null")
    return reporting.sources_and_fates(a.select(F.col("row_id").cast("string").alias("name"), "source"), a.select(F.col("row_id").cast("string").alias("name"), "fate")).groupBy("source", "fate").agg(F.count(F.lit(1)).alias("n"))


def fate_summary(spark: SparkSession, d: str) -> DataFrame:
    """Removed and retained records of each step."""
    return reporting.fate_summary(_fated(spark, d))


def taxa_summary(spark: SparkSession, d: str) -> DataFrame:
    """Distinct names of each rank, of all records and of each fate."""
    return reporting.taxa_summary(_fated(spark, d))


def _keys(spark: SparkSession, d: str) -> list[str]:
    rows = table(spark, d, "ncbi_synonyms_filtered").filter("rank = 'species'").select("tax_name").distinct().orderBy("tax_name").collect()
    return [" ".join(r.tax_name.split()) for r in rows] + ["Nullus nomen"]


def key_species(spark: SparkSession, d: str) -> DataFrame:
    """Fates of the records of all species in the synonym table, and of one that has none."""
    return reporting.key_species_summary(_fated(spark, d), list(dict.fromkeys(_keys(spark, d))))


def core_sequences(spark: SparkSession, d: str) -> DataFrame:
    """Core sequences: the longest of each family and of all."""
    return reporting.core_sequences(_lineage(spark, d), "seq_len", "row_id").select("row_id", "is_core")


def summarise(spark: SparkSession, d: str) -> DataFrame:
    """Lengths of lineage's records."""
    return reporting.summarise(table(spark, d, "lineage"), "seq_len", "taxid")


def summarise_by_source(spark: SparkSession, d: str) -> DataFrame:
    """Lengths by source."""
    return reporting.summarise(table(spark, d, "lineage"), "seq_len", "taxid", ["source"])


def top_hits(spark: SparkSession, d: str) -> DataFrame:
    """Best subjects of queries, lineitem rows standing for hits."""
    return reporting.top_hits(_hits(spark, d), 20.0, 10.0)


def _hits(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    return table(spark, d, "lineitem").select(
        c("l_orderkey").alias("qseqid"), (c("l_suppkey") % 3).alias("sseqid"), F.concat(F.lit("s"), (c("l_suppkey") % 3).cast("string")).alias("stitle"), (c("l_quantity") + 50).alias("pident"), (c("l_linenumber") * 10).alias("length"),
        (c("l_linenumber") * 7).alias("qstart"), (c("l_linenumber") * 7 + 9).alias("qend"), F.lit(100).alias("qlen"), (c("l_partkey") % 60 + 80).alias("slen"), (F.lit(40) + c("l_suppkey") % 3).alias("qcovs"), c("l_quantity").alias("bitscore"), c("l_discount").alias("evalue"),
    )


def assigned_species(spark: SparkSession, d: str) -> DataFrame:
    """Species that the best subjects agree on."""
    top = reporting.top_hits(_hits(spark, d), 20.0, 10.0)
    return reporting.assigned_species(top.withColumn("genus", F.concat(F.lit("G"), (F.col("sseqid") % 2).cast("string"))).withColumn("species", F.concat_ws(" ", "genus", "stitle")))


def acc_hex(spark: SparkSession, d: str) -> DataFrame:
    """Accessions as hexadecimal digits and back."""
    h = Q.acc_to_hex(F.col("seqid"))
    return table(spark, d, "lineage").select("row_id", h.alias("hex"), Q.hex_to_acc(h).alias("acc"))


QUERIES = {f.__name__: f for f in (unclassified_fates, filter_duplicates, filter_ambiguous, dealigned, six_frames, reading_frames, codon_filtered, codon_entropy, alignment_entropy, mixed_clusters, mixed_clusters_counts, mixed_clusters_removed, rank_groups, redundant_absorbed, weighted_centres, prune_groups_length, source_fate_join, fate_summary, taxa_summary, key_species, core_sequences, summarise, summarise_by_source, top_hits, assigned_species, acc_hex)}

# --- SQL
_R = ", ".join(RANKS)
_LIN = f"lin AS (SELECT * REPLACE ({', '.join(f'coalesce({S.rank_key(r)}, {chr(39)}Unclassified{chr(39)}) AS {r}' for r in RANKS)}) FROM lineage)"
_SEQ = "replace(replace(upper(nuc), '-', ''), '.', '')"
_BOLD = f"bo AS (SELECT bold_row_id AS rid, processid, {', '.join(f'coalesce({S.rank_key(r)}, {chr(39)}Unclassified{chr(39)}) AS {r}' for r in RANKS)}, {_SEQ} AS seq, nuc_basecount FROM bold_db_targets WHERE nuc IS NOT NULL)"
_RC = f"reverse(translate({{}}, '{Q.COMPLEMENT_FROM}', '{Q.COMPLEMENT_TO}'))"
_TABLE = Q.GENETIC_CODES[CODE]
_AMB = "MAP {" + ", ".join(f"'{c}': '{a}'" for c, a in Q.ambiguous_codons(CODE).items()) + "}"
_FRAMES = f"""fr AS (SELECT rid, f.frame AS frame, f.t[1:len(f.t) - len(f.t) % 3] AS fs FROM (SELECT rid, unnest([{", ".join(f"{{'frame': {f}, 't': substr({'seq' if f > 0 else _RC.format('seq')}, {abs(f)})}}" for f in (1, 2, 3, -1, -2, -3))}]) AS f FROM bo)),
cd AS (SELECT rid, frame, [fs[3 * i + 1 : 3 * i + 3] FOR i IN range(len(fs) // 3)] AS c FROM fr), am AS (SELECT {_AMB} AS m),
pr AS (SELECT rid, frame, coalesce(array_to_string([CASE WHEN regexp_full_match(x, '[ACGT]{{3}}') THEN substr('{_TABLE}', (16 * (strpos('TCAG', x[1]) - 1) + 4 * (strpos('TCAG', x[2]) - 1) + strpos('TCAG', x[3]))::BIGINT, 1) ELSE coalesce(m[x], 'X') END FOR x IN c], ''), '') AS protein FROM cd, am)"""
_READ = f"""st AS (SELECT rid, frame, len(regexp_replace(protein, '[^*]', '', 'g')) AS s FROM pr),
ag AS (SELECT rid, count(*) FILTER (s = 0 AND frame > 0) AS nf, min(frame) FILTER (s = 0 AND frame > 0) AS f, count(*) FILTER (s = 0 AND frame < 0) AS nr, max(frame) FILTER (s = 0 AND frame < 0) AS r FROM st GROUP BY rid),
rf AS (SELECT rid, CASE WHEN nf = 1 THEN f WHEN nf > 1 THEN 0 WHEN nr = 1 THEN r WHEN nr > 1 THEN 0 END AS rf FROM ag)"""
_CF = f"cf AS (SELECT bo.rid, abs(rf) AS reading_frame, CASE WHEN rf < 0 THEN {_RC.format('seq')} ELSE seq END AS seq FROM bo JOIN rf USING (rid) WHERE rf <> 0)"
_CL = "{0} AS (SELECT concat_ws('|', {1}, seq_len) AS cluster, seqid, {2} AS taxon FROM lin WHERE seqid IS NOT NULL AND {2} <> 'Unclassified'), u AS (SELECT cluster, taxon, count(DISTINCT seqid) AS n, count(*) AS k FROM m GROUP BY ALL), mx AS (SELECT cluster, sum(n)::BIGINT AS n_members, count(*) AS n_taxa, max(n) AS most FROM u GROUP BY cluster HAVING sum(k) > 2 AND count(*) > 1), ag AS (SELECT mx.cluster, CASE WHEN count(*) = 1 THEN min(taxon) END AS consensus, round(any_value(most) / any_value(n_members), 9) AS confidence, any_value(n_members) AS n_members, any_value(n_taxa) AS n_taxa FROM mx JOIN u ON u.cluster = mx.cluster AND u.n = mx.most GROUP BY mx.cluster)"
_FATE = f"fa AS (SELECT *, ([{', '.join(repr(f) for f in [*filters.FATES, filters.FINAL])}])[row_id % 10 + 1] AS fate FROM lin)"
_QS = ", ".join(f"quantile_cont(seq_len, {q / 100}) AS q{q}" for q in (0, 25, 50, 75, 100))
_HITS = """h0 AS (SELECT l_orderkey AS qseqid, l_suppkey % 3 AS sseqid, 's' || (l_suppkey % 3) AS stitle, l_quantity + 50 AS pident, l_linenumber * 10 AS length, l_linenumber * 7 AS qstart, l_linenumber * 7 + 9 AS qend, l_partkey % 60 + 80 AS slen, 40 + l_suppkey % 3 AS qcovs, l_quantity AS bitscore, l_discount AS evalue FROM lineitem),
h AS (SELECT *, pident * length / (length - (qend - qstart + 1) + least(100, slen)) AS fullp, row_number() OVER () AS id FROM h0 QUALIFY row_number() OVER (PARTITION BY qseqid, sseqid, stitle, qstart, qend, length, pident * length / (length - (qend - qstart + 1) + least(100, slen)) ORDER BY bitscore DESC, pident DESC, qcovs DESC, evalue) = 1),
j AS (SELECT a.id, bool_or((a.bitscore, a.pident, a.qcovs) >= (b.bitscore, b.pident, b.qcovs)) AS wins, a.qseqid, a.sseqid FROM h a JOIN h b ON a.qseqid = b.qseqid AND a.sseqid = b.sseqid AND a.id <> b.id AND a.qstart <= b.qend AND b.qstart <= a.qend GROUP BY ALL),
k AS (SELECT h.* FROM h LEFT JOIN j ON j.id = h.id WHERE (h.qseqid, h.sseqid) NOT IN (SELECT (qseqid, sseqid) FROM j) OR wins),
per AS (SELECT qseqid, sseqid, stitle, round(sum(fullp), 6) AS pident, max(qcovs) AS qcovs, max(bitscore) AS max_score, sum(bitscore) AS total_score, min(evalue) AS evalue FROM k GROUP BY ALL HAVING round(sum(fullp), 6) > 20 AND max(qcovs) > 10),
top AS (SELECT * FROM per QUALIFY rank() OVER (PARTITION BY qseqid ORDER BY total_score DESC, max_score DESC, qcovs DESC, pident DESC) = 1)"""
SQL = {
    "unclassified_fates": f"WITH {_LIN} SELECT row_id, {' AND '.join(f'{r} = ' + chr(39) + 'Unclassified' + chr(39) for r in RANKS)} AS all_ranks, {' OR '.join(f'contains({r}, ' + chr(39) + 'Unclassified' + chr(39) + ')' for r in RANKS)} AS any_ranks, ends_with(species, 'Unclassified') AS terminal FROM lin",
    "filter_duplicates": f"""WITH x AS (SELECT row_id, loaded_at, regexp_replace(concat_ws(';', coalesce(seqid, 'NA') || '|' || coalesce(taxid, 'NA'), {", ".join(f"CASE WHEN {S.missing(r)} THEN 'Unclassified' ELSE {S.trimmed(r)} END" for r in RANKS)}), ' +', ' ', 'g') AS name FROM lineage)
SELECT row_id, CASE WHEN row_number() OVER (PARTITION BY name ORDER BY loaded_at, row_id) > 1 THEN 'filter_duplicates' END AS fate FROM x""",
    "filter_ambiguous": f"SELECT bold_row_id, CASE WHEN regexp_matches(nuc, '{Q.AMBIGUOUS}') THEN 'filter_ambiguous' END AS fate FROM bold_db_targets",
    "dealigned": f"SELECT bold_row_id, replace(replace(nuc, '-', ''), '.', '') AS plain, len(replace(replace(nuc, '-', ''), '.', '')) AS n, {_RC.format(f'''regexp_replace(replace({_SEQ}, 'U', 'T'), '[^ACGTRYMKSWHBVDN]', 'N', 'g')''')} AS rc FROM bold_db_targets",
    "six_frames": f"WITH {_BOLD}, {_FRAMES} SELECT rid, frame, protein, array_to_string([i FOR i IN range(1, len(protein) + 1) IF protein[i] = '*'], '|') AS stops FROM pr",
    "reading_frames": f"WITH {_BOLD}, {_FRAMES}, {_READ} SELECT rid, CASE WHEN rf = 0 THEN (SELECT rf FROM rf WHERE rf > 0 GROUP BY rf ORDER BY count(*) DESC, rf LIMIT 1) ELSE rf END AS reading_frame FROM rf",
    "codon_filtered": f"WITH {_BOLD}, {_FRAMES}, {_READ}, {_CF} SELECT * FROM cf",
    "codon_entropy": f"WITH {_BOLD}, {_FRAMES}, {_READ}, {_CF}, b AS (SELECT rid, unnest(string_split(substr(seq, reading_frame), '')) AS b, generate_subscripts(string_split(substr(seq, reading_frame), ''), 1) AS i FROM cf), n AS (SELECT rid, (i - 1) % 3 + 1 AS p, b, count(*) AS n FROM b GROUP BY ALL), s AS (SELECT rid, p, n / sum(n) OVER (PARTITION BY rid, p) AS s FROM n) SELECT rid, {', '.join(f'round(sum(-s * ln(s)) FILTER (p = {p}) + 0.0, 9) AS pos{p}' for p in (1, 2, 3))} FROM s GROUP BY rid",
    "alignment_entropy": "WITH b AS (SELECT unnest(string_split(upper(nuc), '')) AS b, generate_subscripts(string_split(upper(nuc), ''), 1) AS pos FROM bold_db_targets WHERE nuc IS NOT NULL), c AS (SELECT pos, count(*) AS n, count(*) FILTER (b = 'A') AS n_A, count(*) FILTER (b = 'C') AS n_C, count(*) FILTER (b = 'G') AS n_G, count(*) FILTER (b = 'T') AS n_T, count(*) FILTER (b = '-') AS n_gap FROM b GROUP BY pos), t AS (SELECT *, n_A + n_C + n_G + n_T AS t FROM c) SELECT pos, n_A, n_C, n_G, n_T, n_gap, n - n_gap AS bases, n_gap / n AS prop_gaps, CASE WHEN n_gap / n <= 0.2 AND t > 0 THEN round("
    + " + ".join(f"CASE WHEN n_{a} > 0 THEN -(n_{a} / t) * ln(n_{a} / t) ELSE 0 END" for a in "ACGT")
    + ", 9) END AS ent FROM t",
    "mixed_clusters": f"WITH {_LIN}, {_CL.format('m', 'order_name', 'family')} SELECT * FROM ag",
    "mixed_clusters_counts": f"WITH {_LIN}, {_CL.format('m', 'order_name', 'family')} SELECT u.cluster, taxon, n FROM u JOIN mx USING (cluster)",
    "mixed_clusters_removed": f"WITH {_LIN}, {_CL.format('m', 'family', 'genus')} SELECT DISTINCT m.cluster, seqid, taxon, consensus, confidence FROM m JOIN ag USING (cluster) WHERE confidence >= 0.6 AND taxon <> consensus",
    "rank_groups": f"WITH {_LIN} SELECT md5(concat_ws(';', {', '.join(RANKS[:6])})) AS h, count(*) AS n FROM lin GROUP BY h",
    "redundant_absorbed": f"""WITH {_BOLD}, o AS (SELECT species, seq, min(rid) AS k, count(*) AS n FROM bo GROUP BY ALL), c AS (SELECT a.species, a.seq, a.k, a.n, (SELECT b.k FROM o b WHERE b.species = a.species AND len(b.seq) > len(a.seq) AND contains(b.seq, a.seq) ORDER BY len(b.seq) DESC, b.k LIMIT 1) AS l FROM o a),
t AS (SELECT coalesce(l, k) AS k, sum(n)::BIGINT AS c FROM c GROUP BY 1), r AS (SELECT rid, CASE WHEN l IS NOT NULL THEN l WHEN rid <> c.k THEN c.k END AS absorbed_by FROM bo JOIN c USING (species, seq))
SELECT rid, CASE WHEN absorbed_by IS NULL THEN c ELSE NULL END AS count, absorbed_by FROM r LEFT JOIN t ON t.k = rid UNION ALL SELECT bold_row_id, 1, NULL FROM bold_db_targets WHERE false""",
    "weighted_centres": "WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v, vec_id % 3 + 1 AS w FROM embeddings), p AS (SELECT a.label, a.vec_id AS i, unnest(list_resize([]::DOUBLE[], b.w, list_sum(list_transform(list_zip(a.v, b.v), lambda x: (x[1] - x[2]) * (x[1] - x[2]))))) AS d FROM e a JOIN e b USING (label)), m AS (SELECT label, i, round(median(d), 9) AS m FROM p GROUP BY ALL) SELECT label, arg_min(i, (m, i)) AS centre FROM m GROUP BY label",
    "prune_groups_length": f"""WITH {_BOLD}, s AS (SELECT *, (rid % 5 = 0)::INT AS i FROM bo), f AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY species, seq ORDER BY i DESC, rid) = 1), k AS (SELECT rid FROM f WHERE ends_with(species, 'Unclassified') UNION ALL SELECT rid FROM (SELECT rid FROM f WHERE NOT ends_with(species, 'Unclassified') QUALIFY row_number() OVER (PARTITION BY {_R} ORDER BY len(seq) DESC, i DESC, rid) <= 5))
SELECT rid, CASE WHEN rid NOT IN (SELECT rid FROM k) THEN 'select_final_sequences' END AS fate FROM s""",
    "source_fate_join": f"WITH {_LIN}, {_FATE} SELECT source, fate, count(*) AS n FROM fa WHERE seqid IS NOT NULL GROUP BY ALL",
    "fate_summary": f"""WITH {_LIN}, {_FATE}, d AS (SELECT unnest([{", ".join(repr(f) for f in [*filters.FATES, filters.FINAL])}]) AS fate, unnest(range(1, 11))::INTEGER AS ord), n AS (SELECT d.fate, ord, count(fa.fate) AS n FROM d LEFT JOIN fa USING (fate) GROUP BY ALL), a AS (SELECT count(*) AS input FROM fa)
SELECT 'input' AS fate, 0::INTEGER AS ord, 0::BIGINT AS removed, input AS retained FROM a UNION ALL SELECT fate, ord, CASE WHEN fate = 'final_database' THEN 0 ELSE n END, CASE WHEN fate = 'final_database' THEN n ELSE (input - sum(n) OVER (ORDER BY ord))::BIGINT END FROM n, a""",
    "taxa_summary": f"WITH {_LIN}, {_FATE} SELECT 'input' AS step, {', '.join(f'count(DISTINCT {r}) AS {r}' for r in RANKS)} FROM fa UNION ALL SELECT fate, {', '.join(f'count(DISTINCT {r})' for r in RANKS)} FROM fa GROUP BY fate",
    "key_species": f"WITH {_LIN}, {_FATE}, ks AS (SELECT DISTINCT trim(tax_name) AS key FROM ncbi_synonyms_filtered WHERE rank = 'species' UNION SELECT 'Nullus nomen'), g AS (SELECT {_R}, {', '.join(f'count(*) FILTER (fate = {f!r}) AS {f}' for f in [*filters.FATES, filters.FINAL])} FROM fa GROUP BY {_R}) SELECT key, {', '.join(RANKS[:6])}, coalesce(species, key) AS species, {', '.join(f'coalesce({f}, 0) AS {f}' for f in [*filters.FATES, filters.FINAL])} FROM ks LEFT JOIN g ON species = key",
    "core_sequences": f"""WITH {_LIN}, p AS (SELECT ceil(1000 / count(DISTINCT family))::BIGINT AS n, (SELECT quantile_cont(seq_len, 0.5) FROM lin) AS m FROM lin), t AS (SELECT row_id, seq_len, row_number() OVER (PARTITION BY family ORDER BY seq_len DESC NULLS LAST, row_id) AS r, row_number() OVER (ORDER BY seq_len DESC NULLS LAST, row_id) AS a FROM lin) SELECT row_id, coalesce(a <= 200 OR (r <= n AND seq_len >= m), false) AS is_core FROM t, p""",
    "summarise": f"SELECT count(*) AS nseqs, count(DISTINCT taxid) AS nspecies, round(avg(seq_len), 6) AS mean_length, {_QS} FROM lineage",
    "summarise_by_source": f"SELECT source, count(*) AS nseqs, count(DISTINCT taxid) AS nspecies, round(avg(seq_len), 6) AS mean_length, {_QS} FROM lineage GROUP BY source",
    "top_hits": f"WITH {_HITS} SELECT * FROM top",
    "assigned_species": f"WITH {_HITS}, o AS (SELECT DISTINCT qseqid, 'G' || (sseqid % 2) AS genus, stitle AS spp FROM top), g AS (SELECT qseqid, string_agg(DISTINCT spp, '/' ORDER BY spp) AS spp, count(DISTINCT genus) AS n FROM o GROUP BY qseqid) SELECT DISTINCT qseqid, genus, CASE WHEN n = 1 THEN genus || ' ' || g.spp END AS binomial FROM o JOIN g USING (qseqid)",
    "acc_hex": "SELECT row_id, lower(hex(seqid)) AS hex, seqid AS acc FROM lineage",
}
