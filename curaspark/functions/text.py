"""Column expressions for names and ids that were written by hand. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
RANKS = ["kingdom", "phylum", "class_name", "order_name", "family", "genus", "species"]
MISSING = ["", "none", "unclassified"]
#: Blanks of any kind, and marks without width.
BLANK = r"[\s\p{Z}\x{85}\x{AD}\x{180E}\x{200B}-\x{200F}\x{2060}\x{FEFF}]"
BLANKS = "\t\n\x0b\x0c\r \x85\xa0\xad\u1680\u180e" + "".join(map(chr, range(0x2000, 0x2010))) + "\u2028\u2029\u202f\u205f\u2060\u3000\ufeff"
FULL_WIDTH = "".join(chr(c) for c in range(0xFF01, 0xFF5F))
ASCII = "".join(chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F))
DASHES = "‐‑‒–—―−"


def trimmed(c: Column) -> Column:
    """c without blanks of any kind at its ends; null stays null."""
    return F.btrim(c, F.lit(BLANKS))


def missing(c: Column) -> Column:
    """True where a rank value is null, blank, None or Unclassified in any letter case; never null."""
    return F.coalesce(F.lower(trimmed(c)).isin(MISSING), F.lit(True))


def filled(c: Column) -> Column:
    """The trimmed value, or null where it is missing."""
    return F.when(~missing(c), trimmed(c))


def capital(c: Column) -> Column:
    """First letter as a capital, the rest in lower case."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 1_000_000)))


def rank_key(c: Column) -> Column:
    """A rank value as a key: trimmed, one letter case, null where missing."""
    return F.when(~missing(c), capital(trimmed(c)))


def narrow(c: Column) -> Column:
    """Full-width signs as ASCII, every dash as '-', no blanks and no marks without width."""
    return F.translate(c, FULL_WIDTH + DASHES + BLANKS, ASCII + "-" * len(DASHES))


def node_id(c: Column) -> Column:
    """The number of a tax id in any writing ('+12', 'taxon:12', '12.0', full-width digits), or null."""
    return F.regexp_extract(narrow(c), r"^(?:[A-Za-z]+[:_]?)?\+?0*(\d+)(?:\.0*)?$", 1).try_cast("bigint")
