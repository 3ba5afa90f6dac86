"""Intermediate tables, checked broadcasts and Arrow output for the operators."""

import os
import shutil
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

#: A side of a join is broadcast only if it was counted and has no more rows of a few numbers.
BROADCAST_ROWS = 500_000


_SHIPPED = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once a session, where they would not find it."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    app = spark.sparkContext.applicationId
    found = [os.path.abspath(p) for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root in found or app in _SHIPPED:
        return
    _SHIPPED.add(app)
    base = os.path.join(tempfile.mkdtemp(prefix="turnout-"), "turnout-package")
    spark.sparkContext.addPyFile(shutil.make_archive(base, "zip", root, "turnout"))


def scratch_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, which all machines share.

    Where the setting is missing, a local session gets a temporary folder; a
    cluster must name one.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        root = tempfile.mkdtemp(prefix="turnout-")
        spark.sparkContext.setCheckpointDir(root)
        root = spark.sparkContext.getCheckpointDir()
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame, group_rows: int | None = None) -> DataFrame:
    """The same rows, written to the shared folder and read back.

    Cuts the lineage and survives lost executors.  The files stay until the
    owner of the folder clears it.  ``group_rows`` is for rows of several megabytes: Spark decodes
    4,096 rows at once, but never more than a row group has.
    """
    path = scratch_folder(df.sparkSession)
    writer = df.write
    if group_rows:
        writer = writer.option("parquet.block.row.count.limit", group_rows)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_shuffles(spark: SparkSession) -> None:
    """Have Spark delete the shuffle files and broadcasts of plans that are done with.

    Spark deletes them when the driver's JVM collects what refers to them, which a driver with memory to spare
    puts off while the disks of the executors fill.
    """
    spark.sparkContext._jvm.System.gc()


def checked_broadcast(small: DataFrame, rows: int | None = None) -> DataFrame:
    """Hint a broadcast if the stored table has few rows; else leave the join to be shuffled."""
    rows = small.count() if rows is None else rows
    return F.broadcast(small) if rows <= BROADCAST_ROWS else small


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_ids(docs: DataFrame, id_col: str = "doc_id") -> tuple[DataFrame, str]:
    """``docs`` with an id of its own for each row, and that column's name.

    The id is the row's own, but that of rows without one, and of all but the first of those that share one, lies
    above all others; ``docs`` is stored then, so that the ids stay.
    """
    name = free_name(docs, "row_id")
    own = F.col(f"`{id_col}`").cast("long")
    several = docs.groupBy(own.alias("id")).agg(F.count("*").alias("n")).where("n > 1 or id is null")
    several = stored(several.select("id"))
    if several.isEmpty():
        return docs.withColumn(name, own), name
    numbered = stored(docs.withColumn(name, F.monotonically_increasing_id()))
    own = F.col(f"`{id_col}`").cast("long")
    top = numbered.agg(F.coalesce(F.max(own), F.lit(-1))).first()[0] + 1
    first = numbered.groupBy(own.alias("id")).agg(F.min(name).alias("first")).join(several, "id")
    first = stored(first.where("id is not null").select(F.col("first").alias("_first"))) # one row a shared id
    single = numbered.join(several.where("id is not null"), own == F.col("id"), "left_anti").where(own.isNotNull())
    kept = numbered.join(first, F.col(name) == F.col("_first"), "left_semi")
    rest = numbered.join(several, own.eqNullSafe(F.col("id")), "left_semi").join(
        first, F.col(name) == F.col("_first"), "left_anti")
    return single.withColumn(name, own).unionByName(kept.withColumn(name, own)).unionByName(
        rest.withColumn(name, F.col(name) + top)), name


def only(docs: DataFrame, rows: DataFrame, key: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` whose key is in the stored table ``rows``."""
    return docs.join(checked_broadcast(rows.select(key)), key, "left_semi")


def shared_bytes(spark: SparkSession, value):
    """Send one value of bounded size to all executors."""
    return spark.sparkContext.broadcast(value)


def lists(arrays: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from one numpy array a row."""
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    values = np.concatenate(arrays) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def rows_of(batch: pa.RecordBatch, *columns: str):
    """The rows of a batch as tuples of Python values, one at a time."""
    for start in range(0, batch.num_rows, 256):
        part = batch.slice(start, 256)
        yield from zip(*[part.column(c).to_pylist() for c in columns], strict=True)
