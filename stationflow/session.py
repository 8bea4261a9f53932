"""Session helpers: local sessions for tests, and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# The JVM never compiles a method of more bytecode than this.
COMPILED_METHOD_BYTES = 8000


def tuned(spark: SparkSession) -> SparkSession:
    """Keep wide projections compiled.

    A feature table of a hundred columns makes one generated method per stage
    that is too long for the JVM to compile, so it would be interpreted. With
    this limit Spark splits such stages into small methods instead; narrow
    stages keep whole-stage code.
    """
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", str(COMPILED_METHOD_BYTES))
    return spark


def local_session(cores: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks; clusters bring their own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("stationflow")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session that names none (tests, a laptop) gets a temporary
    folder: on a cluster every executor would write to its own disk.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext.getCheckpointDir()
        # The context appends its own unique child to the folder it was given.
        if not current and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = current.rsplit("/", 1)[0] if current else tempfile.mkdtemp(prefix="stationflow-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder, never reused between calls."""
    return f"{shared_dir(spark)}/stationflow/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, options: dict | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    It cuts the lineage as a checkpoint does, and is columnar, so later reads
    prune columns and rows.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
