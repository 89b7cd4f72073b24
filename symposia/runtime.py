"""Session access shared by every operator: table reading, lineage cuts and size checks."""

from __future__ import annotations

import atexit
import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side is broadcast only when it was found to have no more rows and no more bytes of text than this.
BROADCAST_ROWS, BROADCAST_BYTES = 200_000, 32 << 20
#: A key with more rows than this is spread over tasks of this many rows.
ROWS_PER_TASK = 1_000_000


def read(spark: SparkSession, base: str, table: str) -> DataFrame:
    """One table of the data directory. Zone-less timestamps stay zone-less; the session zone plays no part."""
    return spark.read.parquet(f"{base}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only where the setting is absent on one machine."""
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not sc.master.startswith("local[") and sc.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    if not hasattr(sc, "_symposia_dir"):
        sc._symposia_dir = tempfile.mkdtemp(prefix="symposia-shared-")
        atexit.register(shutil.rmtree, sc._symposia_dir, ignore_errors=True)
    return sc._symposia_dir


def _place(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/symposia/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


class Placed:
    """A place in the shared folder for what workers write there themselves; ``located`` and ``drop`` take it as a table."""

    def __init__(self, spark: SparkSession) -> None:
        self.sparkSession, self._symposia_path = spark, _place(spark)


def cut(df: DataFrame) -> DataFrame:
    """``df`` written as a compressed table in the shared folder and read from there, so that lost executors cost nothing,
    lineage stays short and what is kept is small. ``drop`` deletes it when nothing reads it any more."""
    spark = df.sparkSession
    path = _place(spark)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._symposia_path = path
    return out


def located(table: DataFrame | Placed) -> str:
    """Where a worker finds what ``cut`` wrote, as a whole URI."""
    spark = table.sparkSession
    at = spark._jvm.org.apache.hadoop.fs.Path(table._symposia_path)
    uri = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString()
    return uri if "://" in uri else uri.replace(":/", ":///", 1)


def fetched(uri: str) -> pa.Table:
    """A table of the shared folder, read whole in a worker."""
    from pyarrow import fs, parquet

    system, path = fs.FileSystem.from_uri(uri)
    return parquet.read_table(path, filesystem=system)


def counted_off(names: DataFrame) -> DataFrame:
    """The rows with a number ``id``: from 0, in their order and without gaps, so that it is a place in an array."""
    rows = cut(names.withColumn("id", F.monotonically_increasing_id()))
    part, total, begin = F.shiftright("id", 33), 0, []
    for row in sorted(rows.groupBy(part.alias("part")).count().collect()):
        begin += [F.lit(row["part"]), F.lit(total)]
        total += row["count"]
    if not begin:
        return rows
    out = cut(rows.withColumn("id", (F.element_at(F.create_map(*begin), part) + F.col("id").bitwiseAND((1 << 33) - 1)).cast("bigint")))
    drop(rows)
    return out


def drop(*tables: DataFrame | Placed | None) -> None:
    """Delete what ``cut`` wrote for these; others are left alone."""
    for df in tables:
        path = getattr(df, "_symposia_path", None)
        if path:
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def freed(spark: SparkSession) -> None:
    """Lets go of the shuffle files that only tables already written by ``cut`` were made of; else they stay until the driver
    happens to collect its garbage."""
    gc.collect()
    spark._jvm.System.gc()


#: Numbers sorted and packed: the first byte, the seven others of all that begin with it.
PACKED = "bucket int, rest binary"


def parted(arrays: Iterator[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Unsigned numbers of 64 bits as ``PACKED``, a million at a time; bytes of one place lie together, as they compress so."""
    held, n = [], 0

    def out() -> pa.RecordBatch:
        rows = bundled(np.concatenate(held))
        return pa.RecordBatch.from_arrays([pa.array([k for k, _ in rows], pa.int32()), pa.array([x for _, x in rows], pa.binary())], ["bucket", "rest"])

    for array in arrays:
        held.append(array)
        n += len(array)
        if n >= 1_000_000:
            yield out()
            held, n = [], 0
    if n:
        yield out()


def bundled(numbers: np.ndarray) -> list[tuple[int, bytes]]:
    """(bucket, rest) of unsigned numbers of 64 bits."""
    h = np.sort(numbers.astype("<u8"))
    at = np.searchsorted(h, np.arange(256, dtype=np.uint64) << np.uint64(56)).tolist() + [len(h)]
    rest = h.view(np.uint8).reshape(-1, 8)[:, :7]
    return [(k, rest[at[k] : at[k + 1]].T.tobytes()) for k in range(256) if at[k] < at[k + 1]]


def unbundled(bucket: int, parts: list[bytes]) -> np.ndarray:
    """The numbers of a bucket, sorted."""
    rest = [np.frombuffer(x, np.uint8).reshape(7, -1).T for x in parts]
    h = np.full((sum(map(len, rest)), 8), bucket, np.uint8)
    h[:, :7] = np.concatenate(rest)
    return np.sort(h.view("<u8").ravel())


def tasks(spark: SparkSession) -> int:
    """Over how many tasks ``PACKED`` rows are spread."""
    return min(256, max(3 * spark.sparkContext.defaultParallelism, partitions(spark)))


def packed(numbers: DataFrame) -> DataFrame:
    """``PACKED`` of the one column, eight bytes a row."""
    return numbers.mapInArrow(lambda batches: parted(np.frombuffer(b"".join(x.column(0).to_pylist()), ">u8") for x in batches), PACKED)


def repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    buckets: dict[int, list[bytes]] = {}
    for batch in batches:
        for k, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            buckets.setdefault(k, []).append(x)
    for k, parts in buckets.items():
        h = unbundled(k, parts)
        if (h[1:] == h[:-1]).any():
            yield pa.RecordBatch.from_arrays([pa.array([1], pa.int32())], ["n"])
            return


def repeats(rows: DataFrame) -> bool:
    """Whether a number of ``PACKED`` rows is there twice; exact, some six bytes of each are moved."""
    return rows.repartition(tasks(rows.sparkSession), "bucket").mapInArrow(repeated, "n int").count() > 0


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def small(df: DataFrame, limit: int = BROADCAST_ROWS, most: int = BROADCAST_BYTES) -> bool:
    """Whether ``df`` has at most ``limit`` rows and ``most`` bytes of text; reads no more rows than it needs to know."""
    texts = [F.coalesce(F.octet_length(F.col(f"`{f.name}`").cast("string")), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() in ("string", "array", "map", "struct")]
    row = df.limit(limit + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(sum(texts, F.lit(0))).alias("b")).first()
    return row["n"] <= limit and (row["b"] or 0) <= most


def lookup(facts: DataFrame, table: DataFrame, on: list[str], how: str = "left", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join to a lookup table: broadcast when its size is proven, otherwise the join that resists hot keys."""
    if small(table, limit):
        return facts.join(F.broadcast(table), on, how)
    return salted_join(facts, table, on, how)


def hot_keys(rows: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame | None:
    """(on, salts) of the keys with more rows than a task should hold and how many tasks each needs; None where there is none.

    The bound rises with the table so that no more than BROADCAST_ROWS keys can lie above it: the result may be broadcast."""
    counts = cut(rows.where(F.expr(" and ".join(f"`{c}` is not null" for c in on))).groupBy(*on).agg(F.count(F.lit(1)).alias("_n")))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    bound = max(rows_per_task, total // BROADCAST_ROWS)
    hot = counts.where(F.col("_n") > bound).select(*on, F.ceil(F.col("_n") / bound).cast("int").alias("_salts"))
    if hot.limit(1).count():
        hot = cut(hot)
        drop(counts)
        return hot
    drop(counts)
    return None


def salted(facts: DataFrame, table: DataFrame, on: list[str], rows_per_task: int = ROWS_PER_TASK) -> tuple[DataFrame, DataFrame]:
    """``facts`` and ``table`` with a further join column ``_salt``: only hot keys are spread, and only their table rows copied."""
    hot = hot_keys(facts, on, rows_per_task)
    # a map has no hash: its text stands for it
    spread = F.xxhash64(*[F.col(f"`{c}`").cast("string") if "map<" in kind else F.col(f"`{c}`") for c, kind in facts.dtypes if c not in on] or [F.lit(0)])
    no_key = F.expr(" or ".join(f"`{c}` is null" for c in on))
    # null keys match nothing, so they are spread at will
    loose = F.pmod(spread, F.lit(partitions(facts.sparkSession))).cast("int")
    if hot is None:
        return facts.withColumn("_salt", F.when(no_key, loose).otherwise(F.lit(0))), table.withColumn("_salt", F.lit(0))
    left = facts.join(F.broadcast(hot), on, "left").withColumn("_salt", F.when(no_key, loose).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1))).cast("int"))).drop("_salts")
    right = table.join(F.broadcast(hot), on, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_salts")
    return left, right


def salted_join(facts: DataFrame, table: DataFrame, on: list[str], how: str = "left", rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Equi-join, ``left`` or ``inner``, to a table unique on ``on``, in which keys of more than ``rows_per_task`` fact rows
    are spread over as many tasks as they need. No row is dropped or sampled."""
    left, right = salted(facts, table, on, rows_per_task)
    return left.join(right, [*on, "_salt"], how).drop("_salt")


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers once per session, so that executors need no copy of the repository."""
    import os
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_symposia_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="symposia-code-"), "symposia.zip")
    with zipfile.ZipFile(target, "w") as archive:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith((".py", ".npz")):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(target)
    sc._symposia_shipped = True


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` over enough partitions for a costly Python step.

    A scan that already has three tasks a core is left as it lies, as any large table does. A smaller one, whose few
    uneven splits would leave cores idle, is hash-partitioned by ``keys``. Rows stay what they are either way."""
    wanted = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= wanted else df.repartition(wanted, *keys)
