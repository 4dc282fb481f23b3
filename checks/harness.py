"""What only a harness may do: name a work folder for a local session that names none."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; a temporary one for local runs without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "").startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="cartledger-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder
