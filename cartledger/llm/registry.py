"""Registered queries of this subpackage: one for each operator, over whole tables."""

from __future__ import annotations

from checks.harness import shared_folder

from .queries import ALL
from .twins import ORACLE  # noqa: F401


def _query(fn):
    def run(spark, sf_dir):
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        shared_folder(spark)
        return fn(spark, sf_dir)

    return run


QUERIES = {name: _query(fn) for name, fn in ALL.items()}
