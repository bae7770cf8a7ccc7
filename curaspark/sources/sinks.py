"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curaspark.functions import headers
from curaspark.functions.seq import dealigned


def write_fasta(df: DataFrame, path: str, name: str = "name", seq: str = "seq", compress: bool = False, single: bool = False) -> None:
    """Two lines a record into a folder of files; gzip with compress. single makes one file, which one task writes."""
    out = df.select(F.concat(F.lit(">"), F.coalesce(name, F.lit("")), F.lit("\n"), F.coalesce(seq, F.lit(""))).alias("value"))
    (out.coalesce(1) if single else out).write.mode("overwrite").option("compression", "gzip" if compress else "none").text(path)


def format_output(df: DataFrame, add_root: bool = True, aligned: bool = False) -> DataFrame:
    """name, seq as they go out: with a root in the header, and without gaps unless aligned."""
    return df.select((headers.with_root(F.col("name")) if add_root else F.col("name")).alias("name"), (F.col("seq") if aligned else dealigned(F.col("seq"))).alias("seq"))


def write_table(df: DataFrame, path: str, sep: str = ",", single: bool = True) -> None:
    """Delimited text with a header; reports are small, so one file unless told otherwise."""
    (df.coalesce(1) if single else df).write.mode("overwrite").option("sep", sep).option("header", True).option("nullValue", "NA").csv(path)


def write_by_lineage(df: DataFrame, path: str, ranks: list[str]) -> None:
    """Records in one folder for each hash of the lineage down to a rank. Salted by sequence, so a lineage with a third of the records is many files."""
    from curaspark.operators.filters import rank_hash

    salted = df.withColumn("lineage_hash", rank_hash(ranks)).withColumn("_s", F.pmod(F.xxhash64("name"), F.lit(8)))
    salted.repartition("lineage_hash", "_s").drop("_s").select(F.concat(F.lit(">"), "name", F.lit("\n"), "seq").alias("value"), "lineage_hash").write.mode("overwrite").partitionBy("lineage_hash").text(path)


def write_model(model: DataFrame, problems: DataFrame, groups: DataFrame, children: DataFrame, path: str) -> None:
    """What classifier.train() returns and the tree of its records, as folders of parquet: model, problem_sequences, problem_groups, tree."""
    for name, df in (("model", model), ("problem_sequences", problems), ("problem_groups", groups), ("tree", children)):
        df.write.mode("overwrite").parquet(f"{path}/{name}")


def read_model(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(model, tree) of write_model(), as classifier.classify() takes them."""
    return spark.read.parquet(f"{path}/model"), spark.read.parquet(f"{path}/tree")


def fates_chart(summary: DataFrame, width: int = 40) -> str:
    """The report of fates as a bar chart in text; the summary has one row a fate."""
    rows = summary.orderBy("ord").collect()
    most = max([r.retained for r in rows] + [1])
    return "\n".join(f"{r.fate:<24} {'#' * round(width * r.retained / most):<{width}} {r.retained} (-{r.removed})" for r in rows)
