"""Session settings, tables that cut lineage, and joins whose small side has a checked size."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

#: Most rows of a lookup side that is sent to every executor; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Parts (column part) that a table is cut into for table_part().
PARTS = 1 << 20


def get_spark(app: str = "curaspark", cores: int | str = "*", **conf: str) -> SparkSession:
    """A session with the settings that the operators expect. It is local with so many cores unless conf names a master (spark.master)."""
    b = (
        SparkSession.builder.master(conf.pop("spark.master", f"local[{cores}]"))
        .appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in conf.items():
        b = b.config(k, v)
    return b.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share. It is spark.checkpoint.dir; one is made up only where that is unset (tests)."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        at = tempfile.mkdtemp(prefix="curaspark-")
        sc.setCheckpointDir(at)
        at = sc.getCheckpointDir()
    return at.rstrip("/")


#: Tables made within scratch(), innermost last.
_OPEN: list[list[str]] = []


def as_table(df: DataFrame) -> DataFrame:
    """Write df to the shared folder and read it again: lineage ends there, and a lost executor costs no recomputation.

    The files go at the end of the scratch() in which they were made, else when the JVM ends (deleteOnExit).
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/t-{uuid.uuid4().hex}"
    df.write.parquet(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)
    if _OPEN:
        _OPEN[-1].append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._table_path = path
    return out


@contextmanager
def scratch(spark: SparkSession) -> Iterator:
    """Deletes the tables made within it when it ends; `keep` (what it yields) takes out one that as_table() returned."""
    made: list[str] = []
    _OPEN.append(made)

    def keep(df: DataFrame) -> DataFrame:
        made.remove(df._table_path)
        if len(_OPEN) > 1:
            _OPEN[-2].append(df._table_path)
        return df

    try:
        yield keep
    finally:
        _OPEN.pop()
        for path in made:
            at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


@contextmanager
def lean(spark: SparkSession) -> Iterator:
    """Deletes shuffle files at the end of each query that runs within it, where every result is a table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


#: The last part that this worker read, by (path, part, parts).
_PART: dict[tuple, pa.Table] = {}


def table_part(path: str, i: int, n: int, order: str) -> pa.Table:
    """The i-th of n shares of a table of as_table() with a column part (0 to PARTS - 1), by that column, sorted by `order`. For tasks; a worker keeps the last one."""
    if (path, i, n) not in _PART:
        _PART.clear()
        fs, at = pyarrow.fs.FileSystem.from_uri(path if not path.startswith("file:") else "/" + path.removeprefix("file:").lstrip("/"))
        part = ds.field("part")
        table = ds.dataset(at, filesystem=fs, format="parquet").to_table(filter=(part >= i * PARTS // n) & (part < (i + 1) * PARTS // n))
        _PART[path, i, n] = table.drop_columns("part").sort_by(order).combine_chunks()
    return _PART[path, i, n]


def counted_table(df: DataFrame) -> tuple[DataFrame, int]:
    """as_table() with the number of its rows, which are counted as they are written."""
    seen = Observation()
    out = as_table(df.observe(seen, F.count(F.lit(1)).alias("n")))
    return out, seen.get["n"]


def at_most(df: DataFrame, rows: int) -> bool:
    """Whether df has no more than so many rows; reads no further than that."""
    return df.limit(rows + 1).count() <= rows


def lookup_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner", salt: Column | None = None, most: int = BROADCAST_ROWS) -> DataFrame:
    """Join big with small, unique in `on`. small is broadcast while it has at most `most` rows.

    Beyond that both sides shuffle. With `salt` (an expression over big) each row of small goes to 16 buckets, so one
    key that holds a third of big is spread over 16 tasks. how: inner, left or left_anti. The hints keep Spark from broadcasting
    all the same, as it goes by the size of files, which are compressed and lack the 16 buckets.
    """
    if at_most(small, most):
        return big.join(F.broadcast(small), on, how)
    if salt is None:
        return big.join(small.hint("merge"), on, how)
    n = 16
    big = big.withColumn("_salt", F.pmod(F.hash(salt), F.lit(n)))
    small = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
    return big.join(small.hint("merge"), [on, "_salt"], how).drop("_salt")


def spread(df: DataFrame) -> DataFrame:
    """df in at least as many partitions as there are cores, for work that costs far more than moving its rows.

    Partitions are only counted where df comes from its files without a shuffle; counting others would run them.
    """
    n = df.sparkSession.sparkContext.defaultParallelism
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    if any(x in plan for x in ("Join", "Aggregate", "Repartition", "Sort", "Window", "Deduplicate", "Distinct", "Limit", "FlatMap")):
        return df.repartition(n)
    return df if df.rdd.getNumPartitions() >= n else df.repartition(n)
