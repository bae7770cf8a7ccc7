"""Queries of the taxonomy tables and of bringing source rows to harmonised records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions import headers
from curaspark.functions.text import RANKS, rank_key, trimmed
from curaspark.operators import ingest, taxonomy, translation
from curaspark.queries import keys_and_trees as K
from curaspark.queries import sqltext as S
from curaspark.queries import table
from curaspark.session import as_table


def _tnr(spark: SparkSession, d: str) -> DataFrame:
    return taxonomy.taxid_name_rank(taxonomy.tax_names(table(spark, d, "taxon_names")), taxonomy.node_ranks(table(spark, d, "nodes")))


#: The ranked lineages of a folder, made once a session, as several queries of a run read them.
_LINEAGES: dict[tuple[str, str], DataFrame] = {}


def _ranked(spark: SparkSession, d: str) -> DataFrame:
    key = (spark.sparkContext.applicationId, d)
    if key not in _LINEAGES:
        _LINEAGES[key] = as_table(taxonomy.ranked_lineage(table(spark, d, "nodes"), taxonomy.tax_names(table(spark, d, "taxon_names"))))
    return _LINEAGES[key]


def _bold(spark: SparkSession, d: str) -> DataFrame:
    return ingest.extract_bold(table(spark, d, "bold_db_targets"), _targets(spark, d))


def _targets(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ncbi_synonyms_filtered").filter(F.col("rank").isin("family", "genus")).select(trimmed(F.col("tax_name")).alias("name"), "rank").distinct()


def _synonyms(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "ncbi_synonyms_filtered").select("synonym", trimmed(F.col("tax_name")).alias("tax_name"), "rank", "parent_taxon", "grandparent_taxon")


def _lineage(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineage").withColumns({r: headers.unclassified(F.col(r)) for r in RANKS})


def taxidnamerank(spark: SparkSession, d: str) -> DataFrame:
    """Names with the ranks of their nodes."""
    return _tnr(spark, d)


def synonyms(spark: SparkSession, d: str) -> DataFrame:
    """Synonyms with the names and ranks they stand for."""
    return taxonomy.synonyms(table(spark, d, "taxon_names"), _tnr(spark, d))


def synonym_names(spark: SparkSession, d: str) -> DataFrame:
    """All other names of taxa that have a synonym."""
    return taxonomy.synonym_names(table(spark, d, "taxon_names"))


def resolved_names(spark: SparkSession, d: str) -> DataFrame:
    """lineage's species with synonyms replaced."""
    syn = taxonomy.synonym_names(table(spark, d, "taxon_names"))
    return taxonomy.resolve_names(table(spark, d, "lineage").select("row_id", "species"), "species", syn)


def species_taxids(spark: SparkSession, d: str) -> DataFrame:
    """The tax ids that lineage's species name."""
    return taxonomy.name_to_taxid(table(spark, d, "lineage").select("row_id", "species"), "species", taxonomy.tax_names(table(spark, d, "taxon_names")))


def ranked_lineage(spark: SparkSession, d: str) -> DataFrame:
    """Names of the ancestors at the seven ranks."""
    return _ranked(spark, d)


def own_rank_fill(spark: SparkSession, d: str) -> DataFrame:
    """Ranked lineages with the taxon's own rank filled."""
    return taxonomy.own_rank_filled(_ranked(spark, d), _tnr(spark, d))


def lineage_parents(spark: SparkSession, d: str) -> DataFrame:
    """Taxa with the ranks and names of parent and grandparent."""
    return taxonomy.lineage_parents(_ranked(spark, d), _tnr(spark, d))


def gencodes(spark: SparkSession, d: str) -> DataFrame:
    """Taxa with lineage and genetic codes."""
    return taxonomy.gencodes(_ranked(spark, d), table(spark, d, "nodes"))


def synonym_table(spark: SparkSession, d: str) -> DataFrame:
    """Synonyms at the seven ranks with the names of parent and grandparent."""
    tnr, ranked = _tnr(spark, d), _ranked(spark, d)
    return taxonomy.synonyms_with_parents(taxonomy.synonyms(table(spark, d, "taxon_names"), tnr), taxonomy.lineage_parents(ranked, tnr))


def taxa_below(spark: SparkSession, d: str) -> DataFrame:
    """All taxa below each order."""
    nodes = table(spark, d, "nodes")
    return taxonomy.below(nodes, taxonomy.node_ranks(nodes).filter("rank = 'order'").select("tax_id"))


def extract_targets(spark: SparkSession, d: str) -> DataFrame:
    """Distinct rows of bold_db_targets on target, filtered."""
    return _bold(spark, d)


def extract_targets_by_method(spark: SparkSession, d: str) -> DataFrame:
    """The same without rows that were identified by their sequence."""
    return ingest.extract_bold(table(spark, d, "bold_db_targets"), _targets(spark, d), idmethod_filter=True, min_length=200, max_length=700)


def synonym_chain(spark: SparkSession, d: str) -> DataFrame:
    """Rows of bold_db_targets with synonyms resolved down the ranks."""
    return ingest.resolve_synonyms(table(spark, d, "bold_db_targets").select("bold_row_id", *RANKS), _synonyms(spark, d))


def synonym_changes(spark: SparkSession, d: str) -> DataFrame:
    """The distinct lineages before and after."""
    return ingest.synonym_changes(synonym_chain(spark, d))


def identification(spark: SparkSession, d: str) -> DataFrame:
    """Lowest identified rank with parent and grandparent."""
    df = table(spark, d, "bold_db_targets").select("bold_row_id", *[F.when(F.col(c) != "None", F.col(c)).alias(c) for c in RANKS])
    return ingest.identified(df)


def _matched(spark: SparkSession, d: str) -> DataFrame:
    df = ingest.identified(ingest.resolve_synonyms(table(spark, d, "bold_db_targets").select("bold_row_id", "bold_taxid", *RANKS), _synonyms(spark, d)))
    return ingest.match_lineage(df, as_table(taxonomy.lineage_parents(_ranked(spark, d), _tnr(spark, d))))


def lineage_match(spark: SparkSession, d: str) -> DataFrame:
    """Rows of bold_db_targets matched to the taxonomy, null-safe on the parents."""
    return _matched(spark, d).select("bold_row_id", "tax_id", "taxid", *RANKS)


def matching_taxids(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of ids of the two taxonomies."""
    return ingest.matching_taxids(_matched(spark, d))


def harmonised_headers(spark: SparkSession, d: str) -> DataFrame:
    """Headers of the extracted and harmonised rows."""
    parents = as_table(taxonomy.lineage_parents(_ranked(spark, d), _tnr(spark, d)))
    return ingest.harmonise_bold(_bold(spark, d), _synonyms(spark, d), parents).select("name", "seq")


def placeholder_digits(spark: SparkSession, d: str) -> DataFrame:
    """lineage with placeholder names and names with digits as Unclassified."""
    return ingest.placeholders(_lineage(spark, d).select("row_id", *RANKS))


def genbank_lineage(spark: SparkSession, d: str) -> DataFrame:
    """lineage rows with an NCBI id, with the taxonomy's ranks."""
    df = table(spark, d, "lineage").filter(F.col("taxid").rlike(r"^NCBI:\d+$")).select("row_id", F.substring("taxid", 6, 12).alias("tid"))
    ranked = _ranked(spark, d)
    return ingest.join_ranked_lineage(df, "tid", taxonomy.own_rank_filled(ranked, _tnr(spark, d)))


def source_counts(spark: SparkSession, d: str) -> DataFrame:
    """Records of the sources, joined and counted."""
    a = table(spark, d, "lineage").select("seqid")
    b = table(spark, d, "bold_db_targets").select(F.col("processid").alias("seqid"))
    return ingest.source_counts(ingest.combine_sources(lineage=a, bold=b))


def build_header(spark: SparkSession, d: str) -> DataFrame:
    """Headers of all lineage rows."""
    return ingest.named(_lineage(spark, d), "seqid", "taxid").select("row_id", "name")


def parse_header(spark: SparkSession, d: str) -> DataFrame:
    """Headers taken apart again, with the accession in front of the first bar."""
    return headers.parsed(build_header(spark, d)).withColumn("acc", headers.accession_of(F.col("name"))).select("row_id", "acc", "seqid", "taxid", *RANKS)


def header_formats(spark: SparkSession, d: str) -> DataFrame:
    """Headers for other classifiers, and with a root."""
    df = ingest.named(_lineage(spark, d), "seqid", "taxid")
    ranks = [F.col(r) for r in RANKS]
    return df.select("row_id", headers.with_root(F.col("name")).alias("rooted"), *[headers.lineage_format(F.col("seqid"), ranks, f).alias(f) for f in ("hierarchy", "genus", "species")])


def best_gencode_match(spark: SparkSession, d: str) -> DataFrame:
    """Genetic codes of all lineage rows, by id or by the best matching lineage."""
    records = table(spark, d, "lineage").select("row_id", "taxid", *[F.coalesce(rank_key(F.col(r)), F.lit("Unclassified")).alias(r) for r in RANKS])
    codes = as_table(taxonomy.gencodes(_ranked(spark, d), table(spark, d, "nodes")))
    return translation.assign_codes(records, codes).select("row_id", "gencode", "mtgencode", "plgencode", "hdgencode", "rank_matches", "match_tax_id")


def newick_tree(spark: SparkSession, d: str) -> DataFrame:
    """The tree of families of lineage with record counts."""
    df = table(spark, d, "lineage").select(*[rank_key(F.col(r)).alias(r) for r in RANKS])
    return taxonomy.newick(df, RANKS[:5], counts=True)


def infraspecific_excluded(spark: SparkSession, d: str) -> DataFrame:
    """lineage without species names that the taxonomy has below the species rank only."""
    return taxonomy.exclude_taxa(table(spark, d, "lineage").select("row_id", "species"), "species", _tnr(spark, d), F.col("rank").isin("subspecies", "varietas", "forma"))


def mapped_names(spark: SparkSession, d: str) -> DataFrame:
    """lineage's names mapped over synonym, id and name."""
    df = table(spark, d, "lineage").select("row_id", "taxid", "species")
    names = taxonomy.tax_names(table(spark, d, "taxon_names"))
    by_id = names.select(F.concat(F.lit("NCBI:"), "tax_id").alias("id"), F.col("tax_name").alias("mapped"))
    syn = taxonomy.synonym_names(table(spark, d, "taxon_names")).select("synonym", F.col("tax_name").alias("mapped"))
    return taxonomy.map_by_id_then_name(df, "taxid", "species", by_id, names.select(F.col("tax_name").alias("name"), F.col("tax_name").alias("mapped")), syn)


QUERIES = {f.__name__: f for f in (taxidnamerank, synonyms, synonym_names, resolved_names, species_taxids, ranked_lineage, own_rank_fill, lineage_parents, gencodes, synonym_table, taxa_below, extract_targets, extract_targets_by_method, synonym_chain, synonym_changes, identification, lineage_match, matching_taxids, harmonised_headers, placeholder_digits, genbank_lineage, source_counts, build_header, parse_header, header_formats, best_gencode_match, newick_tree, infraspecific_excluded, mapped_names)}

# --- SQL
_U = dict(zip(["species", "genus", "family", "order", "class", "phylum", "kingdom"], reversed(RANKS)))
_COL = {v: k for k, v in _U.items()}  # column to rank
_RANKS = ", ".join(RANKS)
_NAMES = """nm AS (SELECT tax_id, min(name_txt) AS tax_name FROM taxon_names WHERE name_class = 'scientific name' AND tax_id IS NOT NULL AND name_txt IS NOT NULL GROUP BY tax_id),
nr AS (SELECT tax_id, nullif(lower(trim(rank)), '') AS rank FROM nodes WHERE tax_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tax_id ORDER BY loaded_at DESC NULLS LAST, rank DESC NULLS LAST) = 1),
tnr AS (SELECT nm.tax_id, tax_name, rank FROM nm LEFT JOIN nr USING (tax_id)),
sn AS (SELECT o.name_txt AS synonym, o.tax_id AS synonym_taxid, nm.tax_name FROM taxon_names o JOIN nm USING (tax_id) WHERE o.name_class <> 'scientific name' AND o.tax_id IN (SELECT tax_id FROM taxon_names WHERE name_class = 'synonym'))"""
_RANKED = f"""{K._LATEST}, tree AS (SELECT l.id, [l.rank] AS ranks, [nm.tax_name] AS names FROM latest l LEFT JOIN nm ON nm.tax_id = l.id WHERE parent IS NULL UNION ALL SELECT l.id, list_append(t.ranks, l.rank), list_append(t.names, nm.tax_name) FROM tree t JOIN latest l ON l.parent = t.id LEFT JOIN nm ON nm.tax_id = l.id),
ranked AS (SELECT id::INTEGER AS tax_id, names[len(names)] AS tax_name, {", ".join(f"names[list_position(ranks[1:len(ranks) - 1], '{r}')] AS {c}" for r, c in reversed(_U.items()))} FROM tree WHERE names[len(names)] IS NOT NULL)"""
_OWN = ", ".join(f"CASE WHEN rank = '{_COL[c]}' THEN tax_name ELSE {c} END AS {c}" for c in RANKS)
_UP = "CASE {} WHEN 'species' THEN 'genus' WHEN 'genus' THEN 'family' WHEN 'family' THEN 'order' WHEN 'order' THEN 'class' WHEN 'class' THEN 'phylum' WHEN 'phylum' THEN 'kingdom' END"
_VAL = "CASE {} " + " ".join(f"WHEN '{r}' THEN {c}" for r, c in _U.items()) + " END"
_ALLOWED = "('kingdom', 'phylum', 'class', 'order', 'family', 'genus', 'species')"
_PARENTS = f"""own AS (SELECT r.tax_id, tax_name, t.rank, {_OWN} FROM ranked r LEFT JOIN tnr t USING (tax_id, tax_name) WHERE species IS NULL AND t.rank IN {_ALLOWED}),
up1 AS (SELECT *, {_UP.format("rank")} AS parent_rank FROM own), up2 AS (SELECT *, {_UP.format("parent_rank")} AS grandparent_rank FROM up1),
parents AS (SELECT *, {_VAL.format("parent_rank")} AS parent_taxon, {_VAL.format("grandparent_rank")} AS grandparent_taxon FROM up2)"""
_CODES = "gencode, mtgencode, plgencode, hdgencode"
_GENCODES = f"""nc AS (SELECT tax_id, lower(trim(rank)) AS rank, {_CODES} FROM (SELECT * FROM nodes WHERE tax_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY tax_id ORDER BY loaded_at DESC NULLS LAST, rank DESC NULLS LAST, gencode DESC NULLS LAST, mtgencode DESC NULLS LAST, plgencode DESC NULLS LAST, hdgencode DESC NULLS LAST) = 1) WHERE lower(trim(rank)) IN {_ALLOWED}),
gc0 AS (SELECT tax_id, tax_name, {", ".join(f"regexp_replace(coalesce({c}, 'Unclassified'), ' +', ' ', 'g') AS {c}" for c in RANKS)} FROM ranked),
gc AS (SELECT g.tax_id, tax_name, rank, {_OWN}, {_CODES} FROM gc0 g JOIN nc USING (tax_id))"""
_TARGETS = "tg AS (SELECT DISTINCT trim(tax_name) AS name, rank FROM ncbi_synonyms_filtered WHERE rank IN ('family', 'genus'))"
_EXTRACT = f"""{_TARGETS}, ex AS (SELECT DISTINCT processid, bold_taxid, {_RANKS}, replace(nuc, '-', '') AS nuc FROM bold_db_targets b WHERE marker_code = 'COI-5P' AND nuc IS NOT NULL AND NOT regexp_matches(sequence_run_site, 'GenBank|NCBI')
{{extra}} AND (family IN (SELECT name FROM tg WHERE rank = 'family') OR genus IN (SELECT name FROM tg WHERE rank = 'genus')))"""
_EX = _EXTRACT.format(extra="AND nuc_basecount BETWEEN 100 AND 2000")


def _chain(source: str, keep: str) -> str:
    """CTEs that resolve synonyms rank by rank; the last is named chain."""
    out = [f"sy AS (SELECT synonym, trim(tax_name) AS tax_name, rank, parent_taxon, grandparent_taxon FROM ncbi_synonyms_filtered), c0 AS (SELECT {keep}, {', '.join(f"nullif({c}, 'None') AS {c}" for c in RANKS)} FROM {source})"]
    for i, c in enumerate(RANKS):
        keys = ["synonym"] + ["parent_taxon"] * (i >= 1) + ["grandparent_taxon"] * (i >= 2)
        on = f"x.{c} = y.synonym" + "".join(f" AND x.{up} IS NOT DISTINCT FROM y.{k}" for k, up in zip(keys[1:], (RANKS[i - 1], RANKS[i - 2])))
        out.append(f"c{i + 1} AS (SELECT x.* EXCLUDE ({c}), CASE WHEN y.n IS NOT NULL THEN x.{c} END AS {c}_old, coalesce(y.n, x.{c}) AS {c} FROM c{i} x LEFT JOIN (SELECT {', '.join(keys)}, min(tax_name) AS n FROM sy WHERE rank = '{_COL[c]}' AND synonym IS NOT NULL GROUP BY {', '.join(keys)}) y ON {on})")
    astray = "species IS NOT NULL AND NOT starts_with(species, genus)"
    out.append(f"chain AS (SELECT * REPLACE (CASE WHEN {astray} THEN genus END AS genus_old, CASE WHEN {astray} THEN nullif(regexp_extract(species, '^(\\w+) ', 1), '') ELSE genus END AS genus) FROM c7)")
    return ", ".join(out)


_LOWEST = "CASE " + " ".join(f"WHEN {c} IS NOT NULL THEN '{r}'" for r, c in _U.items()) + " ELSE 'species' END"
_ID = "i1 AS (SELECT *, {low} AS identification_rank FROM {{0}}), i2 AS (SELECT *, {p} AS parent_rank FROM i1), i3 AS (SELECT *, {g} AS grandparent_rank FROM i2), ident AS (SELECT *, {a} AS identification, {b} AS parent, {c} AS grandparent FROM i3)".format(
    low=_LOWEST, p=_UP.format("identification_rank"), g=_UP.format("parent_rank"), a=_VAL.format("identification_rank"), b=_VAL.format("parent_rank"), c=_VAL.format("grandparent_rank")
)
_MATCH = f"""mm AS (SELECT rank, tax_name, parent_taxon, grandparent_taxon, min(tax_id) AS m FROM parents GROUP BY ALL),
matched AS (SELECT i.* EXCLUDE ({_RANKS}), m AS tax_id, {", ".join(f"coalesce(CASE WHEN m IS NOT NULL THEN p.{c} ELSE i.{c} END, 'Unclassified') AS {c}" for c in RANKS)}, CASE WHEN m IS NOT NULL THEN 'NCBI:' || m ELSE 'BOLD:' || coalesce(bold_taxid::VARCHAR, 'NA') END AS taxid
FROM ident i LEFT JOIN mm ON i.identification_rank = mm.rank AND i.identification = mm.tax_name AND i.parent IS NOT DISTINCT FROM mm.parent_taxon AND i.grandparent IS NOT DISTINCT FROM mm.grandparent_taxon LEFT JOIN parents p ON p.tax_id = m)"""
_PH = ", ".join([f"CASE WHEN regexp_matches({c}, '[0-9]') THEN 'Unclassified' ELSE {c} END AS {c}" for c in RANKS[:-1]] + ["CASE WHEN contains(species, '.') OR regexp_matches(species, '[0-9]') THEN 'Unclassified' ELSE species END AS species"])
_UN = ", ".join(f"CASE WHEN {S.missing(c)} THEN 'Unclassified' ELSE {S.trimmed(c)} END AS {c}" for c in RANKS)
_LIN = f"lin AS (SELECT * REPLACE ({_UN}) FROM lineage)"
_HEAD = f"regexp_replace(concat_ws(';', coalesce({{0}}, 'NA') || '|' || coalesce({{1}}, 'NA'), {_RANKS}), ' +', ' ', 'g')"
_HEADERS = f"{_LIN}, hd AS (SELECT *, {_HEAD.format('seqid', 'taxid')} AS name FROM lin)"
_GM = " UNION ALL ".join(
    f"SELECT l.key, {' + '.join(f'coalesce((l.{c} = g.{c})::INT, 0)' for c in RANKS)} AS matches, {k} AS level, g.tax_id, g.gencode, g.mtgencode, g.plgencode, g.hdgencode FROM own2 l JOIN "
    + (f"(SELECT * FROM gp WHERE {RANKS[k - 1]} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {', '.join(RANKS[:k])}, {_CODES} ORDER BY tax_id) = 1)" if k < 7 else "gp")
    + f" g ON l.{RANKS[k - 1]} = g.{RANKS[k - 1]}"
    for k in range(7, 0, -1)
)
_T = f"WITH RECURSIVE {_NAMES}, {_RANKED}"
_B = "bold_db_targets"
SQL = {
    "taxidnamerank": f"WITH {_NAMES} SELECT * FROM tnr",
    "synonyms": f"WITH {_NAMES} SELECT t.*, tax_name, rank FROM taxon_names t LEFT JOIN tnr USING (tax_id) WHERE name_class = 'synonym'",
    "synonym_names": f"WITH {_NAMES} SELECT * FROM sn",
    "resolved_names": f"WITH {_NAMES} SELECT row_id, coalesce(n, species) AS species FROM lineage LEFT JOIN (SELECT synonym, min(tax_name) AS n FROM sn GROUP BY synonym) ON species = synonym",
    "species_taxids": f"WITH {_NAMES} SELECT row_id, species, t.tax_id FROM lineage LEFT JOIN (SELECT tax_name, min(tax_id) AS tax_id FROM nm GROUP BY tax_name) t ON species = tax_name",
    "ranked_lineage": f"{_T} SELECT * FROM ranked",
    "own_rank_fill": f"{_T} SELECT tax_id, {', '.join(f'CASE WHEN rank IS NOT NULL THEN {c} END AS {c}' for c in RANKS)} FROM (SELECT tax_id, rank, {_OWN} FROM ranked LEFT JOIN tnr USING (tax_id, tax_name))",
    "lineage_parents": f"{_T}, {_PARENTS} SELECT * FROM parents",
    "gencodes": f"{_T}, {_GENCODES} SELECT * FROM gc",
    "synonym_table": f"{_T}, {_PARENTS} SELECT name_txt AS synonym, t.tax_name, t.rank, parent_taxon, grandparent_taxon FROM taxon_names JOIN tnr t USING (tax_id) LEFT JOIN parents p USING (tax_id) WHERE name_class = 'synonym' AND t.rank IN {_ALLOWED}",
    "taxa_below": f"WITH RECURSIVE {_NAMES}, {K._LATEST}, tree AS (SELECT id, [id] AS ids FROM latest WHERE parent IS NULL UNION ALL SELECT l.id, list_append(t.ids, l.id) FROM tree t JOIN latest l ON l.parent = t.id), u AS (SELECT unnest(ids)::INTEGER AS target, id::INTEGER AS tax_id FROM tree) SELECT u.* FROM u JOIN nr ON nr.tax_id = target WHERE nr.rank = 'order'",
    "extract_targets": f"WITH {_EX} SELECT * FROM ex",
    "extract_targets_by_method": f"WITH {_EXTRACT.format(extra='AND nuc_basecount BETWEEN 200 AND 700 AND NOT regexp_matches(identification_method, ' + chr(39) + 'BIN|(B|b)arcode|DNA|BOLD|(T|t)ree|(S|s)equence' + chr(39) + ')')} SELECT * FROM ex",
    "synonym_chain": f"WITH {_chain(_B, 'bold_row_id')} SELECT * FROM chain",
    "synonym_changes": f"WITH {_chain(_B, 'bold_row_id')} SELECT DISTINCT * EXCLUDE (bold_row_id) FROM chain",
    "identification": f"WITH src AS (SELECT bold_row_id, {', '.join(f'nullif({c}, ' + chr(39) + 'None' + chr(39) + f') AS {c}' for c in RANKS)} FROM {_B}), {_ID.format('src')} SELECT * FROM ident",
    "lineage_match": f"{_T}, {_PARENTS}, {_chain(_B, 'bold_row_id, bold_taxid')}, {_ID.format('chain')}, {_MATCH} SELECT bold_row_id, tax_id, taxid, {_RANKS} FROM matched",
    "matching_taxids": f"{_T}, {_PARENTS}, {_chain(_B, 'bold_row_id, bold_taxid')}, {_ID.format('chain')}, {_MATCH} SELECT DISTINCT identification AS taxon_name, bold_taxid, tax_id AS ncbi_taxid, identification_rank AS rank FROM matched WHERE tax_id IS NOT NULL",
    "harmonised_headers": f"{_T}, {_PARENTS}, {_EX}, {_chain('ex', 'processid, bold_taxid, nuc')}, {_ID.format('chain')}, {_MATCH}, ph AS (SELECT processid, taxid, nuc, {_PH} FROM matched) SELECT {_HEAD.format('processid', 'taxid')} AS name, nuc AS seq FROM ph",
    "placeholder_digits": f"WITH {_LIN} SELECT row_id, {_PH} FROM lin",
    "genbank_lineage": f"{_T}, filled AS (SELECT tax_id, {', '.join(f'CASE WHEN rank IS NOT NULL THEN {c} END AS {c}' for c in RANKS)} FROM (SELECT tax_id, rank, {_OWN} FROM ranked LEFT JOIN tnr USING (tax_id, tax_name))) SELECT row_id, substr(taxid, 6, 12) AS tid, {', '.join(f'coalesce(f.{c}, ' + chr(39) + 'Unclassified' + chr(39) + f') AS {c}' for c in RANKS)} FROM lineage l LEFT JOIN filled f ON f.tax_id = substr(taxid, 6, 12)::INTEGER WHERE regexp_full_match(taxid, 'NCBI:[0-9]+')",
    "source_counts": "SELECT 'lineage' AS source, count(*) AS n_seqs FROM lineage UNION ALL SELECT 'bold', count(*) FROM bold_db_targets",
    "build_header": f"WITH {_HEADERS} SELECT row_id, name FROM hd",
    "parse_header": f"WITH {_HEADERS} SELECT row_id, split_part(name, '|', 1) AS acc, coalesce(seqid, 'NA') AS seqid, coalesce(taxid, 'NA') AS taxid, {_RANKS} FROM (SELECT row_id, name, regexp_replace(seqid, ' +', ' ', 'g') AS seqid, regexp_replace(taxid, ' +', ' ', 'g') AS taxid, {', '.join(f'regexp_replace({c}, ' + chr(39) + ' +' + chr(39) + ', ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + 'g' + chr(39) + f') AS {c}' for c in RANKS)} FROM hd)",
    "header_formats": f"WITH {_HEADERS} SELECT row_id, regexp_replace(name, '^([^;]*);', '\\1;Root;') AS rooted, concat_ws(';', seqid, {_RANKS}) AS hierarchy, concat_ws(';', {', '.join(RANKS[:6])}) || ';' AS genus, concat_ws(' ', seqid, replace(species, '_', ' ')) AS species FROM hd",
    "best_gencode_match": f"""{_T}, {_GENCODES}, gp AS (SELECT tax_id, {", ".join(f"CASE WHEN lower({c}) <> 'unclassified' THEN {c} END AS {c}" for c in RANKS)}, {_CODES} FROM gc),
rec AS (SELECT row_id, TRY_CAST(regexp_extract(taxid, '^NCBI:([0-9]+)$', 1) AS INTEGER) AS n, {", ".join(f"{S.rank_key(c)} AS {c}" for c in RANKS)} FROM lineage),
own2 AS (SELECT row_id AS key, {_RANKS} FROM rec r WHERE NOT EXISTS (SELECT 1 FROM gp WHERE gp.tax_id = r.n AND gencode IS NOT NULL)), f AS ({_GM}),
best AS (SELECT * FROM f WHERE matches >= 2 QUALIFY row_number() OVER (PARTITION BY key ORDER BY matches DESC, level DESC, tax_id) = 1)
SELECT r.row_id, {", ".join(f"CASE WHEN x.gencode IS NULL THEN b.{c} ELSE x.{c} END AS {c}" for c in _CODES.split(", "))}, CASE WHEN x.gencode IS NULL THEN b.matches END AS rank_matches, CASE WHEN x.gencode IS NULL THEN b.tax_id ELSE r.n END AS match_tax_id
FROM rec r LEFT JOIN gp x ON x.tax_id = r.n LEFT JOIN best b ON b.key = r.row_id""",
    "newick_tree": None,
    "infraspecific_excluded": f"WITH {_NAMES}, bad AS (SELECT tax_name FROM tnr GROUP BY tax_name HAVING bool_and(coalesce(rank IN ('subspecies', 'varietas', 'forma'), true)) AND bool_or(rank IN ('subspecies', 'varietas', 'forma'))) SELECT row_id, species FROM lineage WHERE species IS NULL OR species NOT IN (SELECT tax_name FROM bad)",
    "mapped_names": f"WITH {_NAMES} SELECT row_id, taxid, species, coalesce((SELECT min(tax_name) FROM sn WHERE synonym = species), (SELECT tax_name FROM nm WHERE 'NCBI:' || tax_id = taxid), (SELECT min(tax_name) FROM nm WHERE tax_name = species)) AS mapped_name FROM lineage",
}


def _newick_sql() -> str:
    ranks = RANKS[:5]
    cte = [f"n5 AS (SELECT {', '.join(f'''regexp_replace(coalesce({S.rank_key(r)}, 'Unclassified'), '[\\s(),:;\\[\\]'']+', '_', 'g') AS {r}''' for r in ranks)}, count(*) AS n, '' AS t FROM lineage GROUP BY ALL)"]
    for k in range(5, 0, -1):
        r, group = ranks[k - 1], ", ".join(ranks[: k - 1])
        label = f"CASE WHEN t <> '' THEN '(' || t || ')' ELSE '' END || {r} || '_' || n"
        cte.append(f"n{k - 1} AS (SELECT {group + ', ' if group else ''}string_agg({label}, ',' ORDER BY {r}, {label}) AS t, sum(n)::BIGINT AS n FROM n{k}{' GROUP BY ' + group if group else ''})")
    return f"WITH {', '.join(cte)} SELECT '(' || t || ');' AS newick FROM n0"


SQL["newick_tree"] = _newick_sql()
