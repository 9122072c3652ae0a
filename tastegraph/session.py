"""Spark session defaults and lineage cutting.

Everything the engine does is DataFrame/SQL, so the only knobs that matter are
the shuffle sizing, AQE (runtime coalescing, skew-join splitting and
broadcast conversion from *measured* sizes) and where reliable checkpoints go.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

# Session settings that hold for local tests and for a large cluster alike.
# Sizes are advisory targets for AQE, not row caps.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # keep small shuffles that feed row-expanding joins spread over the cores;
    # irrelevant at scale, where the advisory size decides
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "256k",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128m",
    # split a skewed join partition even when what follows then needs an extra
    # shuffle. AQE splits a side only if that side is a plain shuffle, not an
    # aggregate or window, so tables joined to many rows of one user are stored
    # first; only measured skew above the thresholds triggers it
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Folders of intermediate tables, for `drop_tables`.
_FOLDERS: list[str] = []


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "tastegraph", extra_conf: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the engine defaults.

    ``master`` and ``shuffle_partitions`` are only applied when given, so the
    same call works under spark-submit on a cluster (where the launcher sets
    the master) and in local tests.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in DEFAULT_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str | None:
    """Return the reliable checkpoint folder, creating a local one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is; when a cluster session names none, None is returned (a machine-local
    folder would not survive the loss of that machine). Only in a local
    session with nothing configured (tests) a fresh temp folder is made.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if configured:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if on_cluster(spark):
        return None
    local = tempfile.mkdtemp(prefix="tastegraph-ckpt-")
    spark.conf.set("spark.checkpoint.dir", local)
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir()


def on_cluster(spark: SparkSession) -> bool:
    master = spark.sparkContext.master or ""
    return not master.startswith("local")


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Gives this package to the session's Python workers, once, so that they needn't find it on their own path."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent
        path = f"{tempfile.mkdtemp(prefix='package-')}/{package.name}.zip"
        with zipfile.ZipFile(path, "w") as out:
            for f in sorted(package.rglob("*.py")):
                out.write(f, f.relative_to(package.parent))
        context.addPyFile(path)  # served by the driver to every executor
        _SHIPPED.add(context.applicationId)
    return spark


def materialize(df: DataFrame, mode: str = "auto") -> DataFrame:
    """Materialise an expensive intermediate that is reused downstream.

    ``table`` writes a Parquet table into the shared checkpoint folder named
    by ``spark.checkpoint.dir`` and reads it back, ``checkpoint`` writes an RDD
    checkpoint there; both cut the lineage, so a lost executor costs a re-read
    of the written data, not a re-run of the scans and shuffles that produced
    it. ``persist`` keeps it in executor memory/disk and recomputes lost
    blocks from lineage. ``auto`` writes a table whenever a checkpoint folder
    is known (named by the session on a cluster, a fresh local one in local
    runs) and persists otherwise. ``none`` returns the plan unchanged.
    """
    if mode == "auto":
        mode = "table" if ensure_checkpoint_dir(df.sparkSession) else "persist"
    if mode in ("checkpoint", "table") and not ensure_checkpoint_dir(df.sparkSession):
        raise ValueError(f"materialize({mode!r}) needs spark.checkpoint.dir on a cluster")
    if mode == "checkpoint":
        return mark_stored(df.checkpoint(eager=True))
    if mode == "table":
        # a Parquet table in the checkpoint folder: lineage is cut like a
        # checkpoint, later reads prune columns and push filters into the
        # scan, and two reads of it are the same scan, so Spark can write
        # one shuffle for both sides of a self-join (it does not for a
        # persisted or checkpointed input)
        path = new_folder(df.sparkSession, "table")
        with shuffles_removed(df.sparkSession):
            df.write.parquet(path)
        stored = mark_stored(df.sparkSession.read.schema(df.schema).parquet(path))
        stored._tastegraph_folder = path
        return stored
    if mode == "persist":
        return mark_stored(df.persist(StorageLevel.MEMORY_AND_DISK))
    if mode == "none":
        return df
    raise ValueError(f"unknown materialize mode {mode!r}")


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession):
    """Shuffle files of frames made in the block are removed when their action ends, not when the driver happens to collect garbage."""
    old = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP) if old is None else spark.conf.set(SHUFFLE_CLEANUP, old)


def stored_folder(df: DataFrame) -> str | None:
    """URI of the folder of a table that `materialize` wrote."""
    return getattr(df, "_tastegraph_folder", None)


def mark_stored(df: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Says that reading ``df`` again costs no more than reading a copy of it.

    `materialize` marks what it has stored; a caller marks a filter or a union
    of stored tables (``source``: only if that is marked).
    """
    if source is None or is_stored(source):
        df._tastegraph_stored = True
    return df


def is_stored(df: DataFrame) -> bool:
    return getattr(df, "_tastegraph_stored", False)


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI (file:, hdfs:, s3:, gs:) or of a plain local path."""
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)


def new_folder(spark: SparkSession, name: str) -> str:
    """URI of a folder of its own in the shared folder, removed by `drop_tables` or when the program ends."""
    uri = f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    _FOLDERS.append(uri)
    return uri


def drop_tables() -> None:
    """Removes the intermediate tables of all queries so far; frames that read them can't be used any more."""
    while _FOLDERS:
        f, path = open_fs(_FOLDERS.pop())
        if f.get_file_info(path).type != fs.FileType.NotFound:
            f.delete_dir(path)


atexit.register(drop_tables)


def all_rows(df: DataFrame) -> list:
    """The rows of a small result; what was shuffled for it is removed."""
    with shuffles_removed(df.sparkSession):
        return df.select("*").collect()


def first_row(df: DataFrame):
    """The first row, as `all_rows`."""
    with shuffles_removed(df.sparkSession):
        return df.first()


def scalar(df: DataFrame, column: str | None = None):
    """Fetch one aggregate value (a single-row, single-value result) to the driver."""
    row = first_row(df)
    if row is None:
        return None
    return row[column] if column else row[0]
