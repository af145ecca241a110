"""Shared steps of the corpus operators: tables, written intermediates, link components."""

from __future__ import annotations

import os
import tempfile
import zipfile

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir

BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
FOLDS = 4
HELD_OUT_FOLD = 2


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_shipped: set[str] = set()


def release() -> None:
    """Give memory that Arrow no longer uses back, before a task's next large step."""
    pa.default_memory_pool().release_unused()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers of the session, once, as ``--py-files`` would.

    Rows are whole texts: where the session does not say how many go to Python at a time, it is
    ``BATCH_ROWS`` instead of Spark's 10,000.
    """
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    if not spark.sparkContext.getConf().contains(BATCH_SETTING):
        spark.conf.set(BATCH_SETTING, str(BATCH_ROWS))
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="code-"), "tidemark_code.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(n for n in names if n.endswith(".py")):
                path = os.path.join(folder, name)
                out.write(path, os.path.relpath(path, os.path.dirname(package)))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(app)


def pieces(column: pa.Array, limit: int) -> Iterator[tuple[int, list[bytes]]]:
    """The texts of a column as bytes, whole and in order, about ``limit`` bytes at a time, each time
    with the number of the first; a null is an empty text."""
    release()
    raw = column.cast(pa.large_binary())
    first, held = 0, 0
    for i, n in enumerate(pc.binary_length(raw).fill_null(0).to_pylist()):
        if i > first and held + n > limit:
            yield first, [t or b"" for t in raw.slice(first, i - first).to_pylist()]
            first, held = i, 0
        held += n
    if first < len(raw):
        yield first, [t or b"" for t in raw.slice(first).to_pylist()]


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a Parquet table in the shared folder: the lineage ends there, and an executor that
    is lost later costs nothing but the running tasks."""
    spark = df.sparkSession
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """The name, with as many underscores before it as it takes to clash with no column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def held_out(doc_id: str = "doc_id"):
    """True for the quarter of the ids that no learner may see; a null id is never held out."""
    return F.coalesce(
        F.crc32(F.col(doc_id).cast("string").cast("binary")) % FOLDS == HELD_OUT_FOLD,
        F.lit(False))


def components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of the links ``(a, b)``; the component is the smallest
    node reachable.

    Alternates large-star and small-star steps. Every step is a combining minimum and a join, so that
    a node with very many links is pre-aggregated per map task and its join can be split.
    Each round is written to the shared folder; the number of rounds grows with the logarithm of a
    chain's length.
    """
    links = written(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where("u <> v").distinct(), "links")
    mark = None
    while True:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(
            "u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        links = written(
            small.unionByName(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct(),
            "links")
        new = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")),
                        F.sum(F.col("v").cast("decimal(38,0)"))).first()
        if new == mark:
            break
        mark = new
    return (links.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component")))
            .groupBy("node").agg(F.min("component").alias("component")))
