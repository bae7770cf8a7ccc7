"""Queries of problems 6 (token ids), 7 (containers) and 8 (garbled texts)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.llm import mojibake, packing, tokens
from curaspark.queries import table

VOCABULARY = "byte_bpe_50k.tiktoken"


def p6_ids(spark: SparkSession, d: str) -> DataFrame:
    """Token ids of every document."""
    return tokens.encoded(table(spark, d, "documents"), "doc_id", "text", tokens.vocabulary(VOCABULARY))


def p7_containers(spark: SparkSession, d: str) -> DataFrame:
    """Containers of every document in each pack of pack_capacity."""
    sizes = tokens.token_counts(table(spark, d, "documents"), "doc_id", "text", tokens.vocabulary(VOCABULARY))
    return packing.packed(sizes, "doc_id", "n_tokens", table(spark, d, "pack_capacity"))


def p7_fill(spark: SparkSession, d: str) -> DataFrame:
    """Containers, tokens and slack of each pack."""
    packs = F.broadcast(table(spark, d, "pack_capacity").groupBy("pack_name").agg(F.max("capacity_tokens").alias("cap")))
    bins = p7_containers(spark, d).filter("container is not null").groupBy("pack_name", "container").agg(F.sum("size").alias("tokens"))
    return bins.join(packs, "pack_name").groupBy("pack_name").agg(F.count(F.lit(1)).alias("containers"), F.sum("tokens").alias("tokens"), F.sum(F.col("cap") - F.col("tokens")).alias("slack"), F.max(F.col("tokens") - F.col("cap")).alias("most_over"))


def p8_restored(spark: SparkSession, d: str) -> DataFrame:
    """Every document with whether it is garbled and its restored text."""
    docs = table(spark, d, "documents")
    return mojibake.restored(docs, "doc_id", "text", mojibake.fit(docs, "text"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """Ids of the documents that were read, wholly or in part, in a wrong encoding."""
    return p8_restored(spark, d).filter("garbled").select("doc_id")


QUERIES = {"p8_restored": p8_restored, "p8_found": p8_found, "p6_ids": p6_ids, "p7_containers": p7_containers, "p7_fill": p7_fill}
SQL: dict[str, str] = {}
