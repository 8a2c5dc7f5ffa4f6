"""Session settings and the folder that every executor can reach."""

from __future__ import annotations

import gc
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.legacy.javaCharsets": "true",  # opens the CSV reader to Korean charsets
}


_LOCAL_ROOTS: dict[str, str] = {}


def build_session(app: str = "postsieve", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are tested with; extra settings win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Root for checkpoints and hand-over tables.

    A cluster names it in ``spark.checkpoint.dir``, and must. Only with a local master (a laptop, the tests) is a
    local folder made where it is unset, and then it is remembered so that one session uses one folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    master = spark.conf.get("spark.master", "")
    if not master.startswith("local") or master.startswith("local-cluster"):
        raise ValueError(f"spark.checkpoint.dir must name a folder that all executors share (master {master!r})")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="postsieve-")
    return _LOCAL_ROOTS[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    """Fresh path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df, name: str, **options: str):
    """Write a frame to the shared folder, with options of the Parquet writer, and read it back.

    Used where one costly frame feeds several actions (folds of a model, branches of a merge). The
    written table survives lost executors, unlike cached blocks.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df) -> None:
    """Deletes a frame that ``cut_lineage`` has written, once nothing will read it again."""
    spark = df.sparkSession
    root = shared_dir(spark).rstrip("/") + "/"
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        system = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if str(system.makeQualified(path)).startswith(str(system.makeQualified(spark._jvm.org.apache.hadoop.fs.Path(root)))):
            system.delete(path, True)


def release_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files of frames that are no longer used: it does so once the driver's JVM collects what refers to them."""
    gc.collect()
    spark._jvm.System.gc()


ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
_ARROW = {"lock": threading.Lock(), "users": 0, "before": None}


@contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Few rows in an Arrow batch while wide ones go to Python: a batch is cut by rows, 10,000 of them, and held whole on both sides.

    The setting is that of the session; of fits side by side the first one changes it and the last one puts it back.
    """
    with _ARROW["lock"]:
        if not _ARROW["users"]:
            _ARROW["before"] = spark.conf.get(ARROW_ROWS)
            spark.conf.set(ARROW_ROWS, str(rows))
        _ARROW["users"] += 1
    try:
        yield
    finally:
        with _ARROW["lock"]:
            _ARROW["users"] -= 1
            if not _ARROW["users"]:
                spark.conf.set(ARROW_ROWS, _ARROW["before"])
