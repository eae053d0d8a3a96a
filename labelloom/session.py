"""A session with the settings the engine expects; any other session works as well."""

from __future__ import annotations

from pyspark.sql import SparkSession

from labelloom.scale import LOCAL_SHARED


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    spark = (SparkSession.builder.master(f"local[{cores}]").appName("labelloom")
             .config("spark.sql.shuffle.partitions", str(partitions))
             .config("spark.driver.memory", memory)
             .config("spark.sql.session.timeZone", "UTC")
             # Intermediate tables; on a cluster, a folder that all executors share.
             .config("spark.checkpoint.dir", LOCAL_SHARED)
             # Joins hash instead of sort where every partition is measured small enough.
             .config("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64m")
             .config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
