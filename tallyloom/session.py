"""Session settings, the shared folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# A side with at most this many (narrow) rows may be broadcast.
BROADCAST_ROWS = 200_000
# Rows a task may get from a shuffle inside small_tasks, and what bounds it in bytes; most of it is compressed many times.
ROWS_PER_TASK = 500_000
SMALL = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": ("67108864b", "8m"), "spark.sql.files.maxPartitionBytes": ("134217728b", "32m")}
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# Stream state on disk and off the heap; state by record needs it.
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

_local_folders: dict[str, str] = {}


def build_session(app: str = "tallyloom", cpus: str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benches; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="tallyloom-warehouse-"))
        .config(STATE_STORE, ROCKSDB)
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


@contextmanager
def state_by_record(spark: SparkSession) -> Iterator[None]:
    """Streams that start inside keep their state in RocksDB, whatever the session says.

    Spark's default store cannot hold several states of a key. The session gets
    its own setting back; a stream that goes on has its store from its checkpoint.
    """
    before = spark.conf.get(STATE_STORE, None)
    spark.conf.set(STATE_STORE, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(STATE_STORE)
        else:
            spark.conf.set(STATE_STORE, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local-mode session may fall back to a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tallyloom-")
    return _local_folders[app]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing has written to yet."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, fixes values that a
    second evaluation could change, and gives the planner real sizes.
    ``options`` are those of the Parquet writer.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_lean(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Like ``saved``; the shuffle files of ``df`` go as soon as it is written, not when the driver forgets it."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return saved(df, label, **options)
    finally:
        if before is None:
            conf.unset(CLEANUP)
        else:
            conf.set(CLEANUP, before)


def drop_saved(df: DataFrame) -> None:
    """Remove what ``saved`` wrote for ``df``; nothing may read it after that. What lies elsewhere stays."""
    spark = df.sparkSession
    conf, Path = spark._jsparkSession.sessionState().newHadoopConf(), spark._jvm.org.apache.hadoop.fs.Path
    root = Path(shared_folder(spark))
    root = root.getFileSystem(conf).makeQualified(root)
    for folder in {file.rsplit("/", 1)[0] for file in df.inputFiles()}:
        path = Path(spark._jvm.java.net.URI(folder))
        if path.getParent().equals(root):
            path.getFileSystem(conf).delete(path, True)


def saved_in_buckets(df: DataFrame, label: str, keys: Sequence[str], buckets: int) -> DataFrame:
    """Like ``saved``, laid out by a hash of ``keys``: joins and counts by them read it without an exchange.

    The files lie in the shared folder; the session's catalog only knows their
    layout, under a name of their own.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    table = "tallyloom_" + path.rsplit("/", 1)[-1].replace("-", "_")
    df.write.bucketBy(buckets, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
    return spark.table(table)


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast when ``df`` is counted to be small, else leave it.

    Beyond ``max_rows`` the join shuffles and adaptive execution splits the
    skewed partitions. ``df`` should be cheap to count (a saved or narrow frame).
    """
    small = df.limit(max_rows + 1).count() <= max_rows
    return F.broadcast(df) if small else df


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


@contextmanager
def small_tasks(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside has a shuffle partition for every ``ROWS_PER_TASK`` of ``rows`` rows, so tasks do not grow with the input.

    Adaptive execution would put partitions together up to a size in compressed
    bytes, which for rows of sorted keys is very many of them. Sizes that the
    session has chosen itself, and more partitions, stay.
    """
    conf = spark.conf
    before = {"spark.sql.shuffle.partitions": conf.get("spark.sql.shuffle.partitions", None)}
    conf.set("spark.sql.shuffle.partitions", str(max(shuffle_partitions(spark), -(-rows // ROWS_PER_TASK))))
    for name, (default, small) in SMALL.items():
        if conf.get(name) == default:
            before[name] = None
            conf.set(name, small)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                conf.unset(name)
            else:
                conf.set(name, value)


def spread(df: DataFrame) -> DataFrame:
    """Even out a scan that has fewer partitions than the session has task slots.

    A small table or an unsplittable file would otherwise keep one task busy.
    A scan with enough partitions is left as it is, without a shuffle.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= slots else df.repartition(slots)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
