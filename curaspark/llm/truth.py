"""Best representative of each group of records by iterative truth discovery (problem 1)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curaspark.functions.text import RANKS, narrow, rank_key
from curaspark.llm.skew import hot_anti, hot_join
from curaspark.session import as_table, counted_table, lookup_join

#: Weight of the trust that is known beforehand, in claims, in a source's error rate.
PRIOR_CLAIMS = 20.0
#: How a claim without source is named among the sources.
NO_SOURCE = "\0"
#: What speaks for a row as the representative of its record.
CRITERIA = ("filled", "at", "trust")


def accession(c: Column) -> Column:
    """The accession that a seqid names, in one writing; null for null and for what has no letter or digit.

    Blanks, dashes, letter case, full-width signs, a database prefix and separators make no difference. What follows a
    dot, slash, comma, semicolon or bar (a version, a marker) is not part of it. In the shapes in use, two letters with 7
    digits, five with 7 and LAB with 11, the letters O, I and L in the place of a digit are 0, 1 and 1.
    """
    usual = F.when(c.rlike(r"^(?:[A-Z]{2}[0-9]{7}|[A-Z]{5}[0-9]{5}-[0-9]{2}|LAB_[0-9]{2}_[0-9]{9})(?:\.[0-9]+)?$"), F.translate(F.substring_index(c, ".", 1), "-_", ""))
    s = F.regexp_replace(F.regexp_extract(F.upper(narrow(c)), r"^(?:[A-Z]+[:|])?([^./;,|]+)", 1), r"[^A-Z0-9]+", "")
    digits = lambda at: F.concat(F.substring(s, 1, at), F.translate(F.substring(s, at + 1, 99), "OIL", "011"))
    odd = F.when(s.rlike(r"^[A-Z]{2}[0-9OIL]{7}$"), digits(2)).when(s.rlike(r"^[A-Z]{5}[0-9OIL]{7}$"), digits(5)).when(s.rlike(r"^LAB[0-9OIL]{11}$"), digits(3)).when(s != "", s)
    return F.coalesce(usual, odd)


def taxon(c: Column) -> Column:
    """The namespace and number of a taxid in one writing; without a known namespace it is NCBI's. Null where no number is named."""
    usual = F.when(c.rlike("^(?:NCBI|BOLD|INTERNAL):[1-9][0-9]*$"), c)
    s = F.upper(narrow(c))
    space = F.regexp_extract(s, r"^(NCBI|BOLD|INTERNAL)[:_|]?\d+$", 1)
    number = F.regexp_extract(s, r"^[A-Z]*[:_|]?0*(\d+)$", 1)
    return F.coalesce(usual, F.when(number != "", F.concat(F.when(space != "", space).otherwise("NCBI"), F.lit(":"), number)))


def _weight(errors: Column) -> Column:
    """Weight of a source with a share of errors; always above 0."""
    return -F.ln(F.least(F.greatest(errors, F.lit(1e-6)), F.lit(0.999)))


def _trusts(source_trust: DataFrame) -> DataFrame:
    return source_trust.filter("source is not null").groupBy("source").agg(F.max("trust").alias("trust"))


def keyed(lineage: DataFrame) -> DataFrame:
    """row_id, acc, tax, source, loaded_at and the ranks in one writing of all rows."""
    ranks = [rank_key(F.col(r)).alias(r) for r in RANKS]
    return lineage.select("row_id", accession(F.col("seqid")).alias("acc"), taxon(F.col("taxid")).alias("tax"), *ranks, "source", "loaded_at")


def _claims(lineage: DataFrame, trust: DataFrame) -> tuple[DataFrame, int]:
    """The rows with both keys: row_id, acc, tax, the ranks in one writing, source, loaded_at, at, filled, trust; and their number."""
    filled = sum((F.col(r).isNotNull().cast("int") for r in RANKS), F.lit(0))
    at = F.coalesce(F.unix_micros(F.col("loaded_at").cast("timestamp")), F.lit(-(2**62)))
    rows = lookup_join(keyed(lineage).filter("acc is not null and tax is not null"), _trusts(trust), "source", "left", salt=F.col("row_id"))
    return counted_table(rows.withColumns({"filled": filled, "at": at, "trust": F.coalesce("trust", F.lit(-1))}))


def chosen(votes: DataFrame, weights: DataFrame) -> DataFrame:
    """acc, tax, field, value of the highest-supported value; of equal ones the latest, then the greatest.

    votes: acc, tax, field, value, source, n (claims), last. weights: source, weight.
    """
    weighed = lookup_join(votes, weights, "source", salt=F.col("value"))
    support = weighed.groupBy("acc", "tax", "field", "value").agg(F.round(F.sum(F.col("n") * F.col("weight")), 9).alias("s"), F.max("last").alias("last"))
    return support.groupBy("acc", "tax", "field").agg(F.max(F.struct("s", "last", "value")).alias("b")).select("acc", "tax", "field", "b.value")


def reliability(votes: DataFrame, trusts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(weights, choices) by truth discovery: source and weight; acc, tax, field, value chosen in the end.

    A round takes in every field of every record the value with most weighted votes, then sets a source's weight to minus the logarithm
    of its share of errors. It starts from a plain vote in which the more trusted win ties, and ends when no choice changes, or when choices come
    back that were met before. trusts: source, trust. Sources, however many, are rows; one number a round comes to the driver.
    """
    most = max(float(trusts.agg(F.max("trust")).first()[0] or 0), 1.0)
    total = votes.groupBy("source").agg(F.sum("n").alias("total"))
    total = as_table(lookup_join(total, trusts, "source", "left").select("source", "total", F.greatest(F.coalesce(0.95 * F.col("trust") / most, F.lit(0.0)), F.lit(0.0)).alias("prior")))
    weights, met = total.select("source", (1 + 0.1 * F.col("prior")).alias("weight")), set()
    while True:
        now = as_table(chosen(votes, weights))
        mark = F.bit_xor(F.xxhash64("acc", "tax", "field", "value"))
        state = now.agg(mark).first()[0]
        if state is None or state in met:
            return weights, now
        met.add(state)
        agree = votes.join(now, ["acc", "tax", "field", "value"]).groupBy("source").agg(F.sum("n").alias("agree"))
        error = (F.col("total") - F.coalesce("agree", F.lit(0)) + PRIOR_CLAIMS * (1 - F.col("prior"))) / (F.col("total") + PRIOR_CLAIMS)
        weights = as_table(lookup_join(total, agree, "source", "left").select("source", _weight(error).alias("weight")))


def _bits() -> Column:
    """Which criteria a row is first in within its record, as a number of as many bits."""
    return sum(((F.col(c) == F.col(f"top_{c}")).cast("int") * (1 << i) for i, c in enumerate(CRITERIA)), F.lit(0))


def criteria_weights(kinds: dict[int, int]) -> list[float]:
    """Weights of CRITERIA by the same discovery, with the criteria as sources that vote for the rows they put first.

    kinds: records by the set of _bits() of their rows, bit b for rows with these bits; at most 2^8. A criterion errs where the row with most support is
    not first in it. All weights are above 0, so a row that is first in all is chosen always.
    """
    n, k = sum(kinds.values()), len(CRITERIA)
    weights, met = [1.0] * k, set()
    support = lambda b: round(sum(w for i, w in enumerate(weights) if b >> i & 1), 9)
    while True:
        best = {mask: max((b for b in range(1 << k) if mask >> b & 1), key=lambda b: (support(b), -b)) for mask in kinds}
        state = tuple(sorted(best.items()))
        if state in met or not n:
            return weights
        met.add(state)
        errors = [sum(c for mask, c in kinds.items() if not best[mask] >> i & 1) for i in range(k)]
        weights = [-math.log(min(max((e + PRIOR_CLAIMS / 2) / (n + PRIOR_CLAIMS), 1e-6), 0.999)) for e in errors]


def _records(rows: DataFrame) -> DataFrame:
    """The records with two or more rows: acc, tax, n_rows, top_filled, top_at, top_trust, and for each rank whether its values differ (c_...)."""
    hashes = [F.when(F.col(r).isNotNull(), F.xxhash64(r)).alias(f"h_{r}") for r in RANKS]
    conflict = [F.coalesce(F.min(f"h_{r}") != F.max(f"h_{r}"), F.lit(False)).alias(f"c_{r}") for r in RANKS]
    tops = [F.max(c).alias(f"top_{c}") for c in CRITERIA]
    keyed = rows.select("acc", "tax", *CRITERIA, *hashes)
    return keyed.groupBy("acc", "tax").agg(F.count(F.lit(1)).alias("n_rows"), *tops, *conflict).filter("n_rows > 1")


def _votes(members: DataFrame) -> DataFrame:
    """Claims on the fields in conflict, counted by value and source: acc, tax, field, value, source, n, last."""
    fields = F.array(*[F.struct(F.lit(i).alias("field"), F.when(F.col(f"c_{r}"), F.col(r)).alias("value")) for i, r in enumerate(RANKS)])
    facts = members.filter(" or ".join(f"c_{r}" for r in RANKS))
    facts = facts.select("acc", "tax", "loaded_at", F.coalesce("source", F.lit(NO_SOURCE)).alias("source"), F.explode(F.filter(fields, lambda x: x.value.isNotNull())).alias("f"))
    return as_table(facts.groupBy("acc", "tax", "f.field", "f.value", "source").agg(F.count(F.lit(1)).alias("n"), F.max("loaded_at").alias("last")))


def survivors(lineage: DataFrame, source_trust: DataFrame) -> DataFrame:
    """One row per record: acc, tax, n_rows, representative_row_id, dominates, loaded_at, the seven ranks.

    Rows are one record when accession() and taxon() agree; rows where either is null are left to be records of their own, and
    come out with null keys and their own values. A rank on which all rows with a value agree keeps it; where they differ reliability()
    over all such fields decides, with the trust of source_trust as prior, so complete (a missing value never votes), trusted and recent (ties) values win.

    The representative is the row with the most support when completeness, time of loading and trust vote with the weights that
    criteria_weights() finds; of equal rows the one that has most of the values chosen in conflicts, then the first by filled ranks, loaded_at, trust and
    smallest row_id. dominates tells, by an exact check, that it is no worse than each other row in all three and better in one.

    An unknown or null source is trusted less than any other; a null loaded_at is earlier than any other. An empty table gives no rows. Columns
    other than those named play no part. Hot records are pre-aggregated and never gathered in one task; sources may be any number.
    """
    rows, total = _claims(lineage, source_trust)
    several = as_table(_records(rows))
    members = as_table(hot_join(rows, several, ["acc", "tax"], "n_rows", total).withColumn("bits", _bits()))

    votes = _votes(members)
    _, choices = reliability(votes, _trusts(source_trust))
    truths = as_table(choices.groupBy("acc", "tax").agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("truth")))  # at most 7 fields

    masks = members.groupBy("acc", "tax").agg(F.bit_or(F.expr("shiftleft(1, bits)")).alias("mask")).groupBy("mask").agg(F.count(F.lit(1)).alias("n"))
    weights = criteria_weights({r["mask"]: r["n"] for r in masks.collect()})  # fewer than 256 rows
    support = F.round(sum((F.when(F.col("bits").bitwiseAND(1 << i) != 0, w).otherwise(0.0) for i, w in enumerate(weights)), F.lit(0.0)), 9)
    order = F.struct(support.alias("s"), "agree", *CRITERIA, (-F.col("row_id")).alias("r"))
    keys = ["acc", "tax"]

    def best(df: DataFrame) -> DataFrame:
        first = [F.max(order).alias("o"), F.first("n_rows").alias("n_rows"), F.max("loaded_at").alias("loaded_at"), *[F.max(r).alias(r) for r in RANKS]]
        return df.groupBy(*keys).agg(*first, (F.count(F.when(F.col("bits") == (1 << len(CRITERIA)) - 1, 1))).alias("firsts"))

    disputed = F.expr(" or ".join(f"c_{r}" for r in RANKS))
    sizes = several.filter(disputed).select(*keys, "n_rows").join(truths, keys)
    same = [F.when(F.col("truth")[i] == F.col(r), 1).otherwise(0) for i, r in enumerate(RANKS)]
    judged = hot_join(members.filter(disputed), sizes.withColumnRenamed("n_rows", "_n"), keys, "_n", total).withColumn("agree", sum(same, F.lit(0)))
    built = best(judged).join(truths, keys)
    built = built.withColumns({r: F.coalesce(F.col("truth")[i], F.col(r)) for i, r in enumerate(RANKS)}).drop("truth")
    built = built.unionByName(best(members.filter(~disputed).withColumn("agree", F.lit(0))))
    built = built.select(*keys, "n_rows", (-F.col("o.r")).alias("representative_row_id"), (F.col("firsts") == 1).alias("dominates"), "loaded_at", *RANKS)

    alone = lambda df: df.select(*keys, F.lit(1).cast("bigint").alias("n_rows"), F.col("row_id").alias("representative_row_id"), F.lit(False).alias("dominates"), "loaded_at", *RANKS)
    return built.unionByName(alone(hot_anti(rows, several, keys, "n_rows", total))).unionByName(alone(keyed(lineage).filter("acc is null or tax is null")))


def dominating(survivors_: DataFrame) -> DataFrame:
    """row_id of the representatives that are no worse than any other row of their record and better in something."""
    return survivors_.filter("dominates").select(F.col("representative_row_id").alias("row_id"))
