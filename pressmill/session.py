"""Session defaults and the shared folder used to cut lineage."""
from __future__ import annotations

import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"

# Settings every job of this package relies on; all can be changed at run time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Gives the Python workers this package, for sessions that were started without it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = os.path.dirname(os.path.abspath(__file__))
        archive = shutil.make_archive(
            os.path.join(tempfile.mkdtemp(prefix="pressmill-py-"), "pressmill"), "zip",
            root_dir=os.path.dirname(package), base_dir=os.path.basename(package))
        spark.sparkContext.addPyFile(archive)
        _shipped.add(app)
    return spark


def local_session(cpus: str | int = "*", app: str = "pressmill", **conf: str) -> SparkSession:
    """A single-machine session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_root(spark: SparkSession) -> str:
    """The folder named by the cluster; a temporary one only for a local master without it."""
    root = spark.conf.get(CHECKPOINT_KEY, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="pressmill-")
        spark.conf.set(CHECKPOINT_KEY, root)
    return root


_here = threading.local()  # a run records what its own thread is given, not what others beside it use


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    path = f"{shared_root(spark).rstrip('/')}/pressmill/{label}-{uuid.uuid4().hex}"
    for scope in getattr(_here, "scopes", []):
        scope.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """Gathers the paths that this thread is given meanwhile, for ``remove_scratch``."""
    paths: list[str] = []
    outer = getattr(_here, "scopes", [])
    _here.scopes = [*outer, paths]
    try:
        yield paths
    finally:
        _here.scopes = outer


def remove_scratch(spark: SparkSession, paths: list[str]) -> None:
    """Deletes tables that no frame still in use reads."""
    for path in paths:
        target = spark._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` once and go on from the written table.

    Cuts the lineage of iterative jobs; survives the loss of any executor, because the rows lie in
    the shared folder.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, label: str = "cut") -> tuple[DataFrame, int]:
    """``df`` written once, and the number of its rows, observed while they are written."""
    seen = Observation()
    rows = materialize(df.observe(seen, F.count(F.lit(1)).alias("n")), label)
    return rows, seen.get.get("n", 0)


def fan_out(df: DataFrame) -> DataFrame:
    """Spreads a scan that has fewer splits than the cluster has cores (one small or unsplittable
    file) before work that is heavy per row. A large input has splits enough and is left alone."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df
