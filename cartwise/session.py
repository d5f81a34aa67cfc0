"""Session helpers: a local session for tests/bench and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "cartwise") -> SparkSession:
    """A local session for tests and the benchmark (the caller owns cluster sessions)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions: for a repartition whose rows grow afterwards, and which AQE should not shrink."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a folder that the driver and all executors share, and
    it is used as is. Only a local master may do without: then a scratch folder of our own is set.
    Elsewhere an unset folder is an error, since a machine-local one would lose the executors' files.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError(f"spark.checkpoint.dir is unset on {sc.master}: name a folder that the driver and all executors share")
        configured = tempfile.mkdtemp(prefix="cartwise-ckpt-")
    sc.setCheckpointDir(configured)
    return configured


_written: list[str] = []

#: Called with every DataFrame that is about to be written as an intermediate (plan checks in tests).
before_write: list[Callable[[DataFrame], None]] = []


def intermediate_path(spark: SparkSession) -> str:
    """A fresh path under the shared checkpoint folder, removed by ``release_intermediates``."""
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cartwise-{uuid.uuid4().hex}"
    _written.append(path)
    return path


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    One job (``Dataset.checkpoint`` computes an unpersisted input twice), lineage cut so a lost
    executor re-reads files instead of recomputing upstream stages, and the re-read table carries
    real size statistics for AQE's join planning.
    """
    spark = df.sparkSession
    for hook in before_write:
        hook(df)
    path = intermediate_path(spark)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out._cartwise_path = path
    return out


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def discard(*tables: DataFrame) -> None:
    """Remove what ``cut_lineage`` wrote for these tables; nothing may read them any more."""
    for df in tables:
        discard_path(df.sparkSession, getattr(df, "_cartwise_path", None))


def discard_path(spark: SparkSession, path: str | None) -> None:
    """Remove what was written under an ``intermediate_path``."""
    if path in _written:
        _written.remove(path)
        _delete(spark, path)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished queries now.

    It does so when the driver's JVM collects the plans that own them, which a driver with free memory may not do for half an hour.
    """
    spark.sparkContext._jvm.System.gc()


def release_intermediates(spark: SparkSession, since: int = 0) -> int:
    """Remove every written intermediate (from the ``since``-th on) once results are consumed; how many."""
    gone = _written[since:]
    del _written[since:]
    for path in gone:
        _delete(spark, path)
    return len(gone)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[None]:
    """Scope of a query's intermediates: those written inside are removed at the end.

    Consume the result (write it, count it) inside the block.
    """
    since = len(_written)
    try:
        yield
    finally:
        release_intermediates(spark, since)
