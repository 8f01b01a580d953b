"""What the operators share: slim input frames, tables in the shared folder, Arrow mapping."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import weakref
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_fallback: str | None = None
_places: weakref.WeakKeyDictionary = weakref.WeakKeyDictionary()  # frame of a table: its path


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; one of our own only in local mode, where that is unset.

    On a cluster an unset folder is an error: other machines could not read ours.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    global _fallback
    _fallback = _fallback or f"file://{tempfile.mkdtemp(prefix='tallygrove-')}"
    return _fallback


def materialise(df: DataFrame, name: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write df to a table in the shared folder and read it again.

    This cuts the lineage in a place that survives lost executors. The table is
    removed when the driver ends, or when another is made instead of it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tallygrove/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    if instead_of is not None and instead_of in _places:
        _remove(spark, _places[instead_of])
    made = spark.read.schema(df.schema).parquet(path)
    _places[made] = path
    return made


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may have ended before
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def slim(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under fixed names: extra columns of the input cannot clash with ours."""
    return df.select(*(F.col(f"`{source}`").alias(name) for name, source in columns.items()))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name in taken:
        name = "_" + name
    return name


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the value as text, modulo modulus; null stays null."""
    return F.crc32(column.cast("string").cast("binary")) % modulus


def texts(array) -> Iterator[str]:
    """The strings of an Arrow array, '' for null, one at a time."""
    for value in array:
        yield value.as_py() or ""


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, each: Callable, schema: str) -> DataFrame:
    """mapInArrow with a function from one record batch to zero or more."""

    def run(batches):
        for batch in batches:
            yield from each(batch)

    return df.mapInArrow(run, schema)
