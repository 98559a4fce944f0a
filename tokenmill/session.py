"""Session helpers: one place for the settings every job relies on.

Nothing here changes a setting the cluster already made; defaults are
applied only where a key is unset (tests, local runs).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Size above which a side is never broadcast by our own code (bytes).
BROADCAST_LIMIT_BYTES = 64 * 1024 * 1024


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "tokenmill") -> SparkSession:
    """Local session for tests and the bench (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder named by the cluster.

    On a cluster ``spark.checkpoint.dir`` points at shared storage and is
    used as is. Where it is unset, a local session gets a scratch folder,
    and any other master an error.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() if hasattr(sc, "getCheckpointDir") else None
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not conf_dir:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        conf_dir = tempfile.mkdtemp(prefix="tokenmill-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return conf_dir


def checkpoint_dir(spark: SparkSession) -> str:
    return ensure_checkpoint_dir(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written intermediates."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, name)


def bounded_size(df: DataFrame, max_rows: int) -> tuple[int, int]:
    """(rows, bytes) of the first ``max_rows + 1`` rows of ``df``: 16 bytes a
    value, plus the length of strings and binaries, plus 8 bytes an array element."""
    size = F.lit(16 * len(df.columns))
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind in ("string", "binary"):
            size = size + F.coalesce(F.octet_length(c), F.lit(0))
        elif kind in ("array", "map"):
            size = size + 8 * F.coalesce(F.size(c), F.lit(0))
        elif kind == "struct":
            size = size + F.octet_length(F.to_json(c))
    r = df.limit(max_rows + 1).agg(F.count(F.lit(1)), F.coalesce(F.sum(size.cast("long")), F.lit(0))).first()
    return int(r[0]), int(r[1])


def broadcast_if_bounded(df: DataFrame, max_rows: int, limit: int = BROADCAST_LIMIT_BYTES) -> DataFrame:
    """Broadcast ``df`` only when a bounded read proves that it has at most
    ``max_rows`` rows whose summed sizes fit ``limit``; otherwise return it
    unchanged for a shuffle join. The check reads at most ``max_rows + 1`` rows."""
    rows, size = bounded_size(df, max_rows)
    return F.broadcast(df) if rows <= max_rows and size <= limit else df


def materialize(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the shared checkpoint folder: cuts the
    lineage of an intermediate that later steps read more than once
    (recomputation would repeat its shuffles; a lost executor re-reads
    the files instead of recomputing)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
