"""All parameters of a curation run, typed, with their defaults."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # targets and marker
    target_taxon: str | None = None
    target_rank: str | None = None
    marker: str = "COI"
    default_code: int = 5  # genetic code of records for which none is known
    key_species: tuple[str, ...] = ()
    # sources
    min_length_input: int = 100
    max_length_input: int = 2000
    bold_idmethod_filter: bool = False
    # record filters
    remove_ambiguous: bool = True
    remove_unclassified: str = "all_ranks"
    placeholder_as_unclassified: bool = True
    digits_as_unclassified: bool = True
    # full profile model
    phmm_max_evalue: float = 1e-10
    phmm_min_score: float = 50.0
    phmm_max_hits: int | None = None  # no effect unless given
    phmm_min_acc: float = 0.85
    phmm_max_gap: int = 5
    phmm_min_cov: float = 0.1
    phmm_min_length: int = 100
    # amplicon
    primer_fwd: str | None = None
    primer_rev: str | None = None
    trim_to_amplicon: bool = False
    pad_fwd: int = 0
    pad_rev: int = 0
    remove_primers: bool = False
    amplicon_min_cov: float = 0.95
    amplicon_min_length: int = 100
    # clusters and outliers
    cluster_rank: tuple[str, ...] = ("genus",)
    cluster_threshold: float = 0.97
    cluster_confidence: float = 0.8
    dist_threshold: float = 0.05
    # selection and output
    max_group_size: int = 1
    selection_method: str = "length"
    add_root: bool = True
    aligned_output: bool = False
    compressed_output: bool = False
    # model training
    train_idtaxa: bool = False
    idtaxa_max_group_size: int = 10
    idtaxa_max_iterations: int = 3
    idtaxa_allow_group_removal: bool = True
    seed: int = 0

    def __post_init__(self) -> None:
        if self.remove_unclassified not in ("all_ranks", "any_ranks", "terminal", "none"):
            raise ValueError("remove_unclassified is all_ranks, any_ranks, terminal or none")
        if self.selection_method not in ("length", "random"):
            raise ValueError("selection_method is length or random")
        if self.min_length_input > self.max_length_input:
            raise ValueError("min_length_input is larger than max_length_input")
        if (self.primer_fwd is None) != (self.primer_rev is None):
            raise ValueError("give both primers or none")


# Fixed values of the markers that are known: GenBank query, BOLD code, coding, genome, profile model and seed alignment.
MARKERS = {
    "COI": {"genbank_query": "COI[GENE] OR COX1[GENE] OR COXI[GENE]", "bold_code": "COI-5P", "coding": True, "type": "mitochondrial", "profile": "PF00115"},
}


def marker(name: str) -> dict:
    """What is known of a marker, in any letter case."""
    try:
        return MARKERS[name.upper()]
    except KeyError:
        raise ValueError(f"unknown marker {name}; known: {', '.join(MARKERS)}") from None
