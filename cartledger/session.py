"""Session set-up and lineage cutting."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int = 8, memory: str = "12g", **conf: str) -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("cartledger")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def work_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables: ``spark.checkpoint.dir``, which must be set.

    The library never falls back to a machine-local folder; a harness that runs on
    one machine names its own before it starts.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    return folder


def cut_lineage(df: DataFrame, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    Iterative operators call this once per round. The written table survives
    the loss of executors, keeps plans short, and carries the size statistics
    that decide later join strategies. It stays until :func:`release`.
    """
    spark = df.sparkSession
    path = os.path.join(work_dir(spark), f"cut-{uuid.uuid4().hex}")
    df.write.parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def release(*tables: DataFrame) -> None:
    """Delete the files of tables that :func:`cut_lineage` wrote, once nothing reads them any more:
    all that was derived from them must have been written. Other DataFrames are left alone."""
    for table in tables:
        spark = table.sparkSession
        folders = {os.path.dirname(f) for f in table.inputFiles()}
        for folder in folders:
            if os.path.basename(folder).startswith("cut-") and len(folders) == 1:
                path = spark._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)
