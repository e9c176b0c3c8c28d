"""Session construction and the shared scratch folder.

Jobs never invent a machine-local folder on a cluster: intermediate tables go
under ``spark.checkpoint.dir``, which the cluster names.  Only a local-mode
session that names none (a single machine) gets a fresh folder of its own.
"""

from __future__ import annotations

import contextlib
import tempfile
import threading
import uuid

from pyspark.sql import SparkSession

_LOCAL_SCRATCH: dict[str, str] = {}
_STAGED = threading.local()


def build_session(scratch: str, app: str = "keyledger", extra: dict | None = None) -> SparkSession:
    """A session configured the way every job in this package expects: UTC
    session time zone, AQE with partition coalescing and skew-join splitting, no
    UI server, intermediate tables under ``scratch`` (a folder that all
    executors share).  Master, memory and partition counts are the submitter's
    (``spark-submit`` or ``extra``)."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.checkpoint.dir", scratch)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables: ``spark.checkpoint.dir``.
    Only a local-mode session may do without; on a cluster executors could not
    share a folder of this machine, so the setting is required there."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    sc = spark.sparkContext
    if not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder on shared storage (e.g. HDFS or an object store)")
    if sc.applicationId not in _LOCAL_SCRATCH:
        _LOCAL_SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL_SCRATCH[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, never-reused directory under the checkpoint root."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/keyledger/{name}-{uuid.uuid4().hex[:12]}"


def stage(df, name: str):
    """Cut lineage: write ``df`` once as parquet under the checkpoint root and
    return a frame reading it back.  Used for a result that several outputs
    read, so a lost executor costs a re-read instead of computing it again."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    if (paths := getattr(_STAGED, "paths", None)) is not None:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_all(named: dict) -> dict:
    """``stage`` several frames at once, as concurrent jobs of one session, so
    independent inputs are written side by side instead of one after the
    other."""
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(max_workers=max(1, len(named))) as pool:
        futures = {k: pool.submit(stage, df, k) for k, df in named.items()}
        return {k: f.result() for k, f in futures.items()}


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder that ``scratch_path`` made."""
    if not path.startswith(f"{checkpoint_root(spark).rstrip('/')}/keyledger/"):
        raise ValueError(f"not a scratch folder: {path}")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(p, True)


@contextlib.contextmanager
def staging(spark: SparkSession):
    """Delete, at the end, every table that this thread has staged meanwhile:
    for jobs, which have written their outputs by then.  A frame returned to a
    caller is read later, so what a query stages stays in the scratch folder."""
    outer, _STAGED.paths = getattr(_STAGED, "paths", None), []
    try:
        yield
    finally:
        mine, _STAGED.paths = _STAGED.paths, outer
        for path in mine:
            drop_path(spark, path)
