"""Session factory: one place for the settings every plan relies on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "galefold", master: str | None = None, **conf: str) -> SparkSession:
    """A session with UTC timestamps, AQE and nanosecond Parquet readable as longs.

    ``master`` and any keyword (dots written as ``__``) override the defaults, so a cluster's
    own submit-time settings stay in force unless they are named here.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.legacy.parquet.nanosAsLong": "true",
        "spark.sql.parquet.filterPushdown": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.ui.enabled": os.environ.get("GALEFOLD_UI", "false"),
        "spark.ui.showConsoleProgress": "false",
    }
    settings |= {k.replace("__", "."): str(v) for k, v in conf.items()}
    builder = SparkSession.builder.appName(app).config(map=settings)
    return (builder.master(master) if master else builder).getOrCreate()
