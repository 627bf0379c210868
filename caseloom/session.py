"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "caseloom", **conf: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    settings = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Checkpoint files go when nothing refers to them any more.
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for name, value in settings.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for lineage cuts.

    ``spark.checkpoint.dir`` names it on a cluster. Only a local session may fall
    back to a folder of its own, because there every task sees the same disk.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    if known.isDefined():
        return known.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="run-")
    context.setCheckpointDir(folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in reliable storage and forget how it was made."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
