"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "clickfolk", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**_SETTINGS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: it gets one temporary folder. On a cluster a missing
    setting is an error, since a folder of one machine would be lost with it.
    """
    context = spark.sparkContext
    folder = context.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    folder = folder or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="clickfolk-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def unsent(df: DataFrame) -> DataFrame:
    """A side of a join that grows with users or events: it is shuffled, however small its file.

    The planner goes by the size of files, and a compressed file of repetitive columns is far smaller than the
    memory its rows take when they are broadcast.
    """
    return df.hint("merge")


def materialise(df: DataFrame, label: str, **options) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives lost executors, and gives the planner the size of the files, so it can tell a side
    that may be broadcast from one that may not. Rows may take far more than their file: see ``unsent``. ``options`` are
    those of the Parquet writer.
    """
    path = fresh_path(df.sparkSession, label)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
