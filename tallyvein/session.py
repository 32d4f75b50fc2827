"""Session settings and the written tables that cut the lineage of loops."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

_local_roots: dict[str, str] = {}


def build_session(app: str = "tallyvein", cpus: str | int = "*", **conf: str) -> SparkSession:
    """A local session as used by the tests and the bench. On a cluster, bring your own."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.shuffle.partitions": "8",
        "spark.driver.memory": os.environ.get("TALLYVEIN_DRIVER_MEMORY", "12g"),
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        # Small local tables: keep all cores busy although the shuffles carry few bytes.
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "32k",
        "spark.sql.files.maxPartitionBytes": "2m",
    }
    settings.update(conf)
    builder = SparkSession.builder.master(f"local[{cpus}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A temporary folder stands in only when the setting is missing and all executors live in this
    process; on a cluster a machine-local folder would lose data with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tallyvein-")
        atexit.register(shutil.rmtree, _local_roots[app], ignore_errors=True)
    return _local_roots[app]


class Scratch:
    """Tables of one run of an operator, written below the scratch root.

    A written table survives the loss of any executor, cuts the plan of a loop, and comes back with
    its real size, so that the next join is planned from facts.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"

    def path(self, name: str) -> str:
        return f"{self.base}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df.schema)

    def write_counted(self, df: DataFrame, name: str, **measures: Column) -> tuple[DataFrame, dict]:
        """Write a table and return it with aggregates taken while it was written."""
        seen = Observation()
        table = self.write(df.observe(seen, *[column.alias(key) for key, column in measures.items()]), name)
        return table, seen.get

    def read(self, name: str, schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(self.path(name))

    def drop(self, name: str | None = None) -> None:
        """Remove a table, or all of them, once no live DataFrame reads it any more."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(name) if name else self.base)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)
