"""Session settings and the shared folder used for tables between jobs."""

from __future__ import annotations

import os
import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context
from threading import Lock

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lets a join on (block, key) reuse rows already partitioned by block.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # A repeated key in a JSON object counts with its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.ui.enabled": "false",
}


def build_session(app: str = "tallyfold", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings the jobs are written for. `extra` wins."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **extra}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: `spark.checkpoint.dir` of the session.

    Only a local master may do without it; there a temporary folder serves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="tallyfold-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _local_dirs[app]


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, folder: str) -> None:
    """Deletes a folder that a job made for itself."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


_scratch: ContextVar[str | None] = ContextVar("scratch", default=None)


@contextmanager
def scratch(spark: SparkSession):
    """Keeps the staged tables of one job together and removes them when it ends."""
    folder = fresh_path(spark, "job")
    token = _scratch.set(folder)
    try:
        # What the job counts and collects is planned like what it writes.
        with writing(spark):
            yield
    finally:
        _scratch.reset(token)
        remove(spark, folder)


@contextmanager
def outside_scratch():
    """What is staged inside stays, whatever job is under way."""
    token = _scratch.set(None)
    try:
        yield
    finally:
        _scratch.reset(token)


# Settings of every write. Shuffle files of a finished query are removed at its end, not when the driver happens to
# collect garbage; a join on (block, key) keeps rows that lie by block where they are.
WRITING = {
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
}
# At most so many bytes, packed, for a task that reads files or shuffled rows: what it sorts or counts is many times as
# large, and with Spark's own sizes is spilled where a core has a few hundred MB.
TASK_BYTES = 16 << 20
TASK_SETTINGS = ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")
# The planner knows a table by its packed size, and ids in a row are packed to a fiftieth of what they take in a hash
# table: ten MB of them filled the driver. So it broadcasts tables of at most so many packed bytes by itself; what is
# shuffled, and so measured, may be broadcast after all up to the size of the second setting.
PACKED_JOIN_BYTES = 512 << 10
JOIN_BYTES = 10 << 20
PACKED_JOIN, MEASURED_JOIN = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
# Of each session (a stream runs its batches in a copy of the one it was started from): writes under way, and what its
# settings were before.
_writers: dict[int, tuple[int, dict]] = {}
_writers_lock = Lock()


def _bytes(spark: SparkSession, setting: str) -> int:
    """A size in bytes; some settings are turned off by -1, which no reader of sizes takes."""
    return -1 if setting.startswith("-") else spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(setting)


def _lowered(spark: SparkSession) -> dict[str, str]:
    """Sizes of the session that are larger than those of the writes, lowered to them; smaller ones stay."""
    now = {k: _bytes(spark, spark.conf.get(k)) for k in (*TASK_SETTINGS, PACKED_JOIN)}
    # Without a value of its own the second takes that of the first.
    now[MEASURED_JOIN] = _bytes(spark, spark.conf.get(MEASURED_JOIN, None) or spark.conf.get(PACKED_JOIN))
    most = {**dict.fromkeys(TASK_SETTINGS, TASK_BYTES), PACKED_JOIN: PACKED_JOIN_BYTES, MEASURED_JOIN: JOIN_BYTES}
    return {k: f"{n}b" if n >= 0 else "-1" for k, n in ((k, min(now[k], most[k])) for k in now) if n != now[k] or k == MEASURED_JOIN}


@contextmanager
def writing(spark: SparkSession):
    """`WRITING`, small tasks and small broadcasts hold inside, and until the last of the writes of the session that run
    side by side ends."""
    at = spark._jsparkSession.hashCode()
    with _writers_lock:
        n, before = _writers.get(at, (0, {}))
        if not n:
            settings = {**WRITING, **_lowered(spark)}
            before = {k: spark.conf.get(k, None) for k in settings}
            for k, v in settings.items():
                spark.conf.set(k, v)
        _writers[at] = n + 1, before
    try:
        yield
    finally:
        with _writers_lock:
            n, before = _writers.pop(at)
            if n > 1:
                _writers[at] = n - 1, before
            for k, v in before.items() if n == 1 else ():
                spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def stage(df, name: str = "stage"):
    """Write once, read back: cuts lineage and survives the loss of any executor.

    Outside of `scratch` the written table stays, as the result depends on it. What was shuffled to make it goes.
    """
    spark = df.sparkSession
    path = f"{_scratch.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with writing(spark):
        df.write.parquet(path, compression="zstd")
    return spark.read.schema(df.schema).parquet(path)


def unstage(staged) -> None:
    """Removes a staged table that nothing is read from any more."""
    for folder in {name.rsplit("/", 1)[0] for name in staged.inputFiles()}:
        remove(staged.sparkSession, folder)


def side_by_side(*jobs):
    """Run independent jobs at once, so that small ones share the cluster; their results in order."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [done.result() for done in [pool.submit(copy_context().run, job) for job in jobs]]
