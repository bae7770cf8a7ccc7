"""Schemas of what is read. Nothing is inferred."""

# Column names and types of the formats.
RANKEDLINEAGE = "tax_id int, tax_name string, species string, genus string, family string, order_name string, class_name string, phylum string, kingdom string, domain_realm string"
NODES = (
    "tax_id int, parent string, rank string, embl_code string, division_id string, div_inherit int, gencode string, gc_inherit int, mtgencode string, mtgc_inherit int, hidden int, hidden_subtree int, comments string,"
    " plgencode string, plgc_inherit int, specified_species int, hdgencode string, hdgc_inherit int"
)
NAMES = "tax_id int, name_txt string, unique_name string, name_class string"
FULLNAMELINEAGE = "tax_id int, tax_name string, lineage string"
BOLD_USED = ["processid", "taxid", "kingdom", "phylum", "class", "order", "family", "genus", "species", "marker_code", "nuc", "nuc_basecount", "sequence_run_site", "identification_method"]
DOMTBLOUT = (
    "target_name string, target_accession string, target_len double, query_name string, query_accession string, query_len double, evalue_full double, score_full double, bias_full double, domain_n int, domain_total int,"
    " evalue_c double, evalue_i double, score double, bias double, hmm_from double, hmm_to double, ali_from double, ali_to double, env_from double, env_to double, acc double, description string"
)
PRIMER_INFO = "offset_start int, offset_end int, plen_start int, plen_end int, pad_start int, pad_end int"
