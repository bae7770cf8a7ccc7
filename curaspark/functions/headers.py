"""Record headers: acc|taxid;kingdom;...;species."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions.text import RANKS, filled

# Fixed value: how a missing rank is written.
UNCLASSIFIED = "Unclassified"


def unclassified(c: Column) -> Column:
    """A rank value, 'Unclassified' where it is missing."""
    return F.coalesce(filled(c), F.lit(UNCLASSIFIED))


def header(acc: Column, taxid: Column, ranks: list[Column]) -> Column:
    """acc|taxid;ranks, runs of blanks as one; null accession or taxid as 'NA'."""
    first = F.concat_ws("|", F.coalesce(acc, F.lit("NA")), F.coalesce(taxid, F.lit("NA")))
    return F.regexp_replace(F.concat_ws(";", first, *ranks), " +", " ")


def parsed(df: DataFrame, name: str = "name") -> DataFrame:
    """df with seqid, taxid and the seven ranks of a header. What follows the seventh ';' goes to the species, as what follows the first '|' to
    the taxid; fields that a header lacks are null. Columns of these names are replaced."""
    part = F.split(F.col(name), ";", 8)
    ids = F.split(F.get(part, F.lit(0)), r"\|", 2)
    return df.withColumns({"seqid": F.get(ids, F.lit(0)), "taxid": F.get(ids, F.lit(1))} | {r: F.get(part, F.lit(i + 1)) for i, r in enumerate(RANKS)})


def with_root(name: Column) -> Column:
    """Header with 'Root' as a rank before the kingdom."""
    return F.regexp_replace(name, "^([^;]*);", "$1;Root;")


def accession_of(name: Column) -> Column:
    """What stands before the first '|' of a header."""
    return F.split_part(name, F.lit("|"), F.lit(1))


def lineage_format(acc: Column, ranks: list[Column], fmt: str) -> Column:
    """A header for other classifiers: 'hierarchy' (acc;ranks), 'genus' (kingdom;...;genus;), 'species' (acc Genus species)."""
    if fmt == "hierarchy":
        return F.concat_ws(";", acc, *ranks)
    if fmt == "genus":
        return F.concat(F.concat_ws(";", *ranks[:6]), F.lit(";"))
    if fmt == "species":
        return F.concat_ws(" ", acc, F.translate(ranks[6], "_", " "))
    raise ValueError(fmt)
