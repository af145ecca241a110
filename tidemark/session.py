"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


def build_session(cores: str | int = "*", app: str = "tidemark", checkpoint_dir: str | None = None) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own. ``checkpoint_dir`` is for machines
    whose Spark defaults name none."""
    partitions = os.cpu_count() if cores == "*" else int(cores)
    builder = SparkSession.builder
    if checkpoint_dir is not None:
        builder = builder.config("spark.checkpoint.dir", checkpoint_dir)
    return (
        builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # Java does not compile methods above 8000 bytes: let Spark split very wide projections.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def use_utc(spark: SparkSession) -> SparkSession:
    """Every timestamp in the data model is UTC: zoneless Parquet times are read as such, without a
    cast, so that filters on them still reach the Parquet scan."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.inferTimestampNTZ.enabled", "false")
    return spark


def shared_dir(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder of the folder all executors can reach.

    ``spark.checkpoint.dir`` names that folder; it is set when the session is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise ValueError("start the session with spark.checkpoint.dir set to a folder every executor can reach")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
