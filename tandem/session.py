"""Session helpers: building one, staging tables, and small driver-made tables."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"
CLEANUP_KEY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "tandem", cores: int | None = None, **conf: str) -> SparkSession:
    """Local session for tests and benches; a cluster brings its own settings."""
    cores = cores or int(os.environ.get("BENCH_CPUS", "8"))
    settings = {
        "spark.sql.shuffle.partitions": str(cores),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, from ``spark.checkpoint.dir``.

    Only a local session may run without it; it then gets a scratch folder.
    """
    path = spark.conf.get(CHECKPOINT_KEY, None) or spark.sparkContext.getConf().get(CHECKPOINT_KEY)
    if path:
        return path.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_KEY} to a folder every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="tandem-")
    return _LOCAL_DIRS[app]


def enable_checkpoints(spark: SparkSession) -> None:
    """Let iterative fits cut their lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def stage_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the application's own folder, which can be dropped as a whole."""
    return f"{shared_dir(spark)}/tandem/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, partition_by: tuple[str, ...] = (), options: dict[str, str] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder, with the writer's ``options``, and read it back.

    Used where several later passes need the same rows. Unlike a cache it
    outlives lost executors, cuts the lineage, and still prunes columns. What was
    shuffled for it is dropped with the write, not at some later garbage collection.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    before = spark.conf.get(CLEANUP_KEY, "false")
    spark.conf.set(CLEANUP_KEY, "true")
    try:
        df.write.options(**options or {}).partitionBy(*partition_by).parquet(path)
    finally:
        spark.conf.set(CLEANUP_KEY, before)
    if _MADE:
        _MADE[-1].append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Paths of what was staged inside the calls of ``stage_result`` that are under way, the innermost last.
_MADE: list[list[str]] = []


def stage_result(spark: SparkSession, make: Callable[[], DataFrame], label: str) -> DataFrame:
    """``stage`` for what ``make`` returns; tables that it staged on the way are dropped then.

    ``make`` must not hand a table that it staged to anything but its result.
    """
    _MADE.append([])
    try:
        done = stage(make(), label)
        passed = _MADE[-1].pop()
    finally:
        made = _MADE.pop()
        for path in made:
            at = spark._jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
    if _MADE:
        _MADE[-1].append(passed)
    return done


def pinned(df: DataFrame) -> DataFrame:
    """Run a fitted table once and keep its rows for later uses.

    The planner knows the size of the written files and picks the join from it, whatever the number of rows.
    """
    return stage(df, "fitted")


def local_rows(spark: SparkSession, columns: dict, schema: str) -> DataFrame:
    """A small driver-made table from column lists."""
    return spark.createDataFrame(pa.table(columns), schema=schema)
