"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
# Folders of the open ``scratch`` blocks, the innermost last.
_scratch: list[str] = []

# Runtime settings the plans in this package rely on; all can be set on a live session.
SQL_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot id is split even where the split costs one more exchange.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session someone else created, and give its executors this package."""
    for name, value in SQL_SETTINGS.items():
        spark.conf.set(name, value)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> None:
    """Send the package to the executors once for each application, as ``--py-files`` would.

    Functions that run in tasks are found by module name there, whatever folder
    the driver was started from.
    """
    context = spark.sparkContext
    if getattr(context, "_hearthspark_sent", None):
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    # The driver's file server reads it for as long as executors may start.
    folder = tempfile.TemporaryDirectory(prefix="hearthspark-ship-")
    packed = os.path.join(folder.name, "hearthspark_package.zip")
    with zipfile.ZipFile(packed, "w") as archive:
        for path, _, names in sorted(os.walk(os.path.join(root, "hearthspark"))):
            for name in sorted(names):
                if name.endswith(".py"):
                    whole = os.path.join(path, name)
                    archive.write(whole, os.path.relpath(whole, root))
    context.addPyFile(packed)
    context._hearthspark_sent = folder


def local_session(cpus: int | str = 8, memory: str = "12g", name: str = "hearthspark") -> SparkSession:
    """A session for tests and the bench on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.ui.enabled", "false")
        # Call sites of single columns cost more than all other plan building together.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    Only where the setting is absent (a local test session) a temporary
    folder is made; a cluster without the setting is an error.
    """
    if _scratch:
        return _scratch[-1]
    named = spark.conf.get(CHECKPOINT_SETTING, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_SETTING} to a folder all executors share")
    made = tempfile.mkdtemp(prefix="hearthspark-")
    spark.conf.set(CHECKPOINT_SETTING, made)
    return made


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Stages written inside the block go to a folder of their own, which is deleted at its end.

    Whatever reads them has to be written or collected inside the block.
    """
    folder = os.path.join(shared_dir(spark), f"run-{uuid.uuid4().hex}")
    _scratch.append(folder)
    try:
        yield folder
    finally:
        _scratch.remove(folder)
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def fresh_path(spark: SparkSession, label: str) -> str:
    return os.path.join(shared_dir(spark), f"{label}-{uuid.uuid4().hex}")


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared folder and go on from the written copy.

    Used where a plan is read by several later jobs, or where a step must not
    be evaluated twice with different results. The files outlive executors.
    """
    path = fresh_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def in_parallel(tasks: Sequence[Callable[[], object]], width: int = 4) -> list[object]:
    """Run independent fits side by side; each is a Spark job of its own."""
    session = SparkSession.getActiveSession()
    with ThreadPoolExecutor(max_workers=width) as pool:
        return list(pool.map(lambda task: inheritable_thread_target(session)(task)(), tasks))
