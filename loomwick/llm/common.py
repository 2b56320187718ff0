"""What the corpus operators share: table access, the shared scratch folder, materialising."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows handed to Python at once: texts may be long, and a worker holds one batch at a time.
ARROW_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder, read by Spark, so that any store Spark reads will do."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where that is unset (tests, a single machine) a local folder is made and set once.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        known = spark.sparkContext._jsc.sc().getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="loomwick-")
        spark.sparkContext.setCheckpointDir(root)
        return spark.sparkContext._jsc.sc().getCheckpointDir().get()
    return root


#: Folders made in this process, the latest last.
_made: list[str] = []


def scratch(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark).rstrip('/')}/loomwick-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@contextlib.contextmanager
def made_here() -> Iterator[list[str]]:
    """The folders that are made inside the block, in order, once it is left."""
    first, paths = len(_made), []
    yield paths
    paths += _made[first:]


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors.

    The folder goes when the driver ends, or before by ``drop_path``.
    """
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    gone_at_end(df.sparkSession, path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def gone_at_end(spark: SparkSession, path: str) -> None:
    """Delete a folder that exists when the driver's JVM ends: rows that are read later still find it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)


def released(partition: Callable) -> Callable:
    """A partition function that gives freed memory back at its end: workers are kept for later stages."""

    @wraps(partition)
    def run(batches: Iterator) -> Iterator:
        try:
            yield from partition(batches)
        finally:
            import ctypes

            import pyarrow as pa

            pa.default_memory_pool().release_unused()
            with contextlib.suppress(OSError, AttributeError):  # another libc has nothing of the kind
                ctypes.CDLL("libc.so.6").malloc_trim(0)

    return run


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store."""
    if path in _made:
        _made.remove(path)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


#: A key is heavy if it has more than one in so many of a table's rows, so at most so many keys are, and more than this.
HEAVY_PARTS, HEAVY_ROWS = 1000, 200


def spread_join(big: DataFrame, small: DataFrame, on: list[str], rows: int, how: str = "inner") -> DataFrame:
    """big joined with small, so that no key is one task's work.

    small has one row for each key ``on``, and ``n``, the key's rows in big; rows: all rows of big.  Heavy keys, of which
    there are at most ``HEAVY_PARTS``, are broadcast; all others have a thousandth of big's rows, or a few hundred.  how: inner or left.
    """
    most = max(HEAVY_ROWS, rows // HEAVY_PARTS)
    heavy, light = small.filter(F.col("n") > most).drop("n"), small.filter(F.col("n") <= most).drop("n")
    marked = big.join(F.broadcast(heavy.withColumn("heavy_key", F.lit(True))), on, "left")
    found = marked.filter("heavy_key").drop("heavy_key")
    rest = marked.filter("heavy_key is null").select(*big.columns).join(light, on, how)
    return found.unionByName(rest)


def whole_text(text: str = "text") -> Column:
    """The text, null read as empty."""
    return F.coalesce(F.col(text).cast("string"), F.lit(""))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Just (doc_id, text): other columns, whatever their names, can't clash."""
    return df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def held_out_by(modulus: int, rest: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id's decimal text, modulo; a null id counts as not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus == rest, F.lit(False))
