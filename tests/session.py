from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def local_session(cores: str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("textgraph")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.checkpoint.dir", os.environ.get("TEXTGRAPH_SCRATCH") or tempfile.mkdtemp(prefix="textgraph-tests-"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="textgraph-warehouse-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
