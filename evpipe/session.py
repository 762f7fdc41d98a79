"""Session settings used by tests and the benchmark, and recommended for clusters."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Above 8000 bytes of bytecode the JVM interprets a method for good. Wide rule projections
    # exceed that in one fused loop; below the limit Spark splits them into compiled methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # One flag per accepted id for good: that state belongs on disk, with small checkpoints.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Of repeated keys in a JSON object the last one counts.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    for name, value in RUNTIME_CONF.items():
        spark.conf.set(name, value)
    return spark


def local_session(cpus: int = 8, memory: str = "8g") -> SparkSession:
    """A local session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("evpipe")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", memory)
        # One process on one machine: here, and only here, a folder of its own is a shared one.
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="evpipe-"))
    )
    for name, value in RUNTIME_CONF.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
