"""What the operators share: shared storage, joins that survive hot keys, exact cuts of a global order."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
#: Shuffle files go when the action that wrote them is over.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The most bytes of one Arrow batch for Python.
BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_own: dict[int, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir, or in local mode, where that is unset (tests), a temporary one."""
    told = spark.conf.get("spark.checkpoint.dir", None)
    if told:
        return told.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    key = id(spark.sparkContext)
    if key not in _own:
        _own[key] = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
    return _own[key]


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that nothing else uses; it is removed when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def written(df: DataFrame, name: str, narrow: bool = False) -> DataFrame:
    """df as a Parquet table in the shared folder: it cuts the lineage, and a lost executor costs nothing but a reread.

    narrow: rows without texts that no Python makes in the writing stage. A task writes up to 16 shuffle partitions of these one after another, into one file; two tasks a core stay.
    On a local file system without Hadoop's native library each file costs the executor two child processes (chmod).
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    if narrow:
        df = df.coalesce(max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // 16))
    with _small_batches(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _small_batches(spark: SparkSession, most: int = 4 << 20) -> Iterator[None]:
    """Python workers get rows in Arrow batches of about `most` bytes, so that neither they nor the JVM hold many texts at once."""
    before = spark.conf.get(BATCH, None)
    spark.conf.set(BATCH, str(most))
    try:
        yield
    finally:
        spark.conf.unset(BATCH) if before is None else spark.conf.set(BATCH, before)


@contextlib.contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Frames made in here leave no shuffle files behind their actions; otherwise these stay until the driver collects garbage. Such a frame is for one action: another one of it
    would shuffle again, so what an operator returns is made outside."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)


def row_keys(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[Column, Column]:
    """(id, hash): two longs that tell rows apart and are never null, so that pandas keeps them exact. A null id is 0 with an odd hash; other hashes are even."""
    null = F.col(id_col).isNull()
    hashed = F.xxhash64(as_text(df, text_col)).bitwiseAND(F.lit(-2)).bitwiseOR(null.cast("long"))
    return F.coalesce(F.col(id_col).cast("long"), F.lit(0).cast("long")), hashed


def null_again(row_id: str, row_hash: str) -> Column:
    """The id of a row from its keys."""
    return F.when(F.col(row_hash).bitwiseAND(F.lit(1)) == 0, F.col(row_id))


def free_name(df: DataFrame, name: str) -> str:
    """name, or name with underscores after it if df has such a column already (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def heaviest(groups: DataFrame, weight: str, k: int = 1000) -> DataFrame:
    """The k rows of the largest weight: at most k rows whatever the input, so they may be broadcast."""
    return groups.orderBy(F.col(weight).desc_nulls_last(), *[F.col(c) for c in groups.columns if c != weight]).limit(k)


def lookup(rows: DataFrame, groups: DataFrame, key: str, weight: str, k: int = 1000) -> DataFrame:
    """rows left-joined with groups, which has one row per key and the number of rows that hold it.

    The k heaviest keys are joined by a broadcast of exactly k rows at most, so no key that is left for the shuffle join holds over a
    k-th of the rows. key may be null on neither side.
    """
    hot = heaviest(groups, weight, k)
    return lookup_hot(rows, groups, hot, key, k)


def lookup_hot(rows: DataFrame, groups: DataFrame, hot: DataFrame, key: str, k: int) -> DataFrame:
    hot = written(hot, "hot")
    if hot.count() < k:  # these are all
        return rows.join(F.broadcast(hot), key, "left").select(*rows.columns, *[c for c in groups.columns if c != key])
    mark = free_name(rows, "is_hot")
    marked = rows.join(F.broadcast(hot.withColumn(mark, F.lit(True))), key, "left")
    names = [*rows.columns, *[c for c in groups.columns if c != key]]
    first = marked.filter(F.col(mark)).select(*names)
    rest = marked.filter(F.col(mark).isNull()).select(*rows.columns)
    cold = groups.join(F.broadcast(hot.select(key)), key, "left_anti")
    return first.unionByName(rest.join(cold, key, "left").select(*names))


def as_text(df: DataFrame, column: str) -> Column:
    """The column as string, null as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions_for(total_bytes: int, each: int = 24 << 20, least: int = 1) -> int:
    return max(least, -(-int(total_bytes) // each))
