"""Tables written between steps: into the folder that spark.checkpoint.dir names, so a lost executor loses none of them."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Only where that is unset (one machine) a local one is made, once."""
    found = spark.conf.get("spark.checkpoint.dir", None) or (_own[0] if _own else None)
    if not found:
        found = f"file://{tempfile.mkdtemp(prefix='leafmill-')}"
        _own.append(found)
        atexit.register(shutil.rmtree, found.removeprefix("file://"), True)
    return found.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a table of its own: what made it runs once, whatever reads it and however often."""
    path = f"{shared_dir(df.sparkSession)}/leafmill/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a written table that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
