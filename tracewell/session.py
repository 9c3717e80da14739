"""Session settings the library needs, and where it may write intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Wire timestamps are rendered in UTC, map merges are last-wins, and the nested-value walker is
# a deep expression that needs more analyzer passes than the default 100.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.analyzer.maxIterations": "1000",
    "spark.sql.optimizer.maxIterations": "1000",
    # Session windows of a few hot keys are merged in the tasks that read them before they move.
    "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true",
    # State with lists, maps, timers and a time to live needs this store; it also keeps state on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


# Into how many tasks the small tables of tests and bench are spread; unset on a cluster.
SPREAD = "spark.tracewell.spread"


def configure(spark: SparkSession) -> SparkSession:
    for name, value in SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", memory: str = "8g", app: str = "tracewell") -> SparkSession:
    """A single-machine session for tests and the bench."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call sites are recorded for every Column otherwise, which slows building large plans.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", cores if cores.isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config(SPREAD, cores if cores.isdigit() else "8")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can read, as the cluster names it.

    Only where the cluster names none and the session is local does a temporary folder serve.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tracewell-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def use_checkpoints(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint` usable, in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


_runs: list[list[str]] = []


def new_table_path(spark: SparkSession, name: str) -> str:
    """A path of its own below the shared folder, so that runs never collide."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    for run in _runs:
        run.append(path)
    return path


@contextmanager
def tables_of_a_run(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables that are made inside are removed at the end, when results have been written or collected."""
    made: list[str] = []
    _runs.append(made)
    try:
        yield
    finally:
        _runs.remove(made)
        hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
        settings = spark.sparkContext._jsc.hadoopConfiguration()
        for path in made:
            place = hadoop.Path(path)
            place.getFileSystem(settings).delete(place, True)
