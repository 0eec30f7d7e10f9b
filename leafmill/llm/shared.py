"""What several operators share: the shared folder, written tables and text columns."""

from __future__ import annotations

import atexit
import contextlib
import gc
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The white space of every word rule here: space and bytes 9 to 13.
WS = " \t\n\x0b\x0c\r"
_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where that is unset (tests on one machine) a new local one is set."""
    found = spark.conf.get("spark.checkpoint.dir", None) or (_own[0] if _own else None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='leafmill-')}"
        _own.append(found)
        atexit.register(shutil.rmtree, found.removeprefix("file://"), True)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/leafmill/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet into the shared folder and read it: lineage ends, and a lost executor loses nothing."""
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of finished jobs now; it does so when the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def give_back() -> None:
    """At the end of a task, return what the worker has freed: idle workers stay beside later stages."""
    import ctypes

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def delete(spark: SparkSession, folder: str) -> None:
    """Delete a folder, if it is there."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, folder: str) -> bool:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)


def rename(spark: SparkSession, old: str, new: str) -> None:
    """Move a folder inside the shared folder."""
    a, b = (spark.sparkContext._jvm.org.apache.hadoop.fs.Path(x) for x in (old, new))
    store = a.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    store.mkdirs(b.getParent())
    if not store.rename(a, b):
        raise OSError(f"{old} can't be moved to {new}")


def discard(df: DataFrame) -> None:
    """Delete the files of a materialized table that no later plan reads."""
    for f in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        delete(df.sparkSession, f)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def text_key(text: Column) -> Column:
    """128 bits of a text's SHA-256: with doc_id the name of a row. Rows with one name are alike in both."""
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def packed(df: DataFrame, leave: tuple[str, ...] = ()) -> Column:
    """The columns of df but those named in `leave` as one struct `row`: whatever they are called, they don't meet the names of an operator."""
    return F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(df.columns) if c.lower() not in leave]).alias("row")


def unpacked(columns: list[str], **found: Column) -> list[Column]:
    """The columns that packed() took, by their names; those in `found` (by lower-case name) are given anew."""
    return [(found[c.lower()] if c.lower() in found else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(columns)]


def whole_text(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))
