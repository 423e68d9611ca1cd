"""Session helpers: building a session for local runs and materialising plans.

Library code never hard-codes partition counts or memory; it reads what the session
was started with. The only setting we may supply ourselves is a checkpoint folder,
and only for a local master (tests, bench) when the cluster named none.
"""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

MAX_BUCKETS = 100_000  # Spark's own limit for a bucketed table
_TABLES: dict[str, str] = {}       # bucketed tables by their folder, until it is dropped
_RECORDS: list[list[str]] = []     # where new scratch folders are noted


def local_session(cores: int | str = "*", app: str = "hamper", shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """A local session configured like the tests and the bench expect."""
    n = shuffle_partitions or ((os.cpu_count() or 8) if cores == "*" else int(cores))
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(n))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder of the session.

    The cluster's ``spark.checkpoint.dir`` wins. Only when it is unset and the master is
    local (tests, bench) do we create a scratch folder; on a cluster an unset folder is an
    error, because a machine-local folder would not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf:
        sc.setCheckpointDir(conf)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    path = tempfile.mkdtemp(prefix="hamper-ckpt-")
    atexit.register(shutil.rmtree, path, ignore_errors=True)  # ours alone, made for this run
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir()


def _scratch_root(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/hamper-scratch/{spark.sparkContext.applicationId}"


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder under the session's checkpoint folder (shared on a cluster)."""
    path = f"{_scratch_root(spark)}/{name}-{uuid.uuid4().hex}"
    for folders in _RECORDS:
        folders.append(path)
    return path


@contextmanager
def recorded_scratch() -> Iterator[list[str]]:
    """The scratch folders that are made inside the ``with`` block, for ``drop_folders``. Blocks may nest."""
    folders: list[str] = []
    _RECORDS.append(folders)
    try:
        yield folders
    finally:
        _RECORDS[:] = [r for r in _RECORDS if r is not folders]   # an outer record may hold the same names


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete these scratch folders (and the bucketed tables in them), and let Spark's cleaner delete the
    shuffles that no frame refers to any more. Frames that read the folders fail afterwards."""
    for path in folders:
        if path in _TABLES:
            spark.sql(f"DROP TABLE IF EXISTS {_TABLES.pop(path)}")
        drop_dir(spark, path)
    gc.collect()             # frames that are gone let go of their plans
    spark._jvm.System.gc()   # which the cleaner learns from a collection on the driver


@contextmanager
def shuffles_cleaned(spark: SparkSession, every: float = 5.0) -> Iterator[None]:
    """While the ``with`` block runs, let Spark's cleaner delete the shuffles that nothing refers to any
    more: long jobs that allocate little on the driver would keep them to their end."""
    done = threading.Event()

    def collect() -> None:
        while not done.wait(every):
            spark._jvm.System.gc()

    cleaning = threading.Thread(target=collect, daemon=True)
    cleaning.start()
    try:
        yield
    finally:
        done.set()
        cleaning.join()


def drop_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch folder. Call it once the results that were built on
    stored rows have been written; frames that still read them fail afterwards."""
    while _TABLES:
        spark.sql(f"DROP TABLE IF EXISTS {_TABLES.popitem()[1]}")
    drop_dir(spark, _scratch_root(spark))


def drop_dir(spark: SparkSession, path: str) -> None:
    """Remove a folder of stored rows through Spark's own file system layer."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def materialize(df: DataFrame) -> DataFrame:
    """Store ``df`` in the shared scratch folder and read it back.

    Cuts the lineage as reliably as a checkpoint (nothing depends on an executor's disk), but
    as Parquet: compressed, with column pruning and a size that the planner knows.
    """
    path = scratch_dir(df.sparkSession, "rows")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_bucketed(df: DataFrame, column: str, buckets: int | None = None, compression: str = "snappy") -> DataFrame:
    """Store ``df`` as ``materialize`` does, bucketed by ``column``: windows, aggregates, joins and
    cogroups that cluster by the column (and others) read it back without a shuffle. The
    number of buckets defaults to the session's shuffle partitions."""
    spark = df.sparkSession
    buckets = min(buckets or int(spark.conf.get("spark.sql.shuffle.partitions", "200")), MAX_BUCKETS)
    name, path = f"hamper_rows_{uuid.uuid4().hex}", scratch_dir(spark, "buckets")
    (df.write.format("parquet").option("path", path).option("compression", compression)
     .bucketBy(buckets, column).saveAsTable(name))
    _TABLES[path] = name
    return spark.table(name)


def is_plain_read(df: DataFrame) -> bool:
    """Whether ``df`` only picks columns and rows from files, so that reading it twice gives the same
    rows and costs less than storing them first."""
    plan = df._jdf.queryExecution().optimizedPlan()
    if not plan.deterministic():
        return False
    while plan.nodeName() in ("Project", "Filter"):
        plan = plan.children().head()
    return plan.nodeName().startswith("LogicalRelation")
