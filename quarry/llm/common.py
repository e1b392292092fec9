"""Session helpers shared by the corpus operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes in one Arrow batch. Documents can be long, so batches are kept small; a longer row is a batch of its own.
ARROW_ROWS, ARROW_BYTES = 1000, 4 << 20
#: Spark's setting to drop an execution's shuffle files when it ends, and not at some later garbage collection.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bound the rows and bytes of an Arrow batch, so that long documents cannot fill a worker.

    The settings are read when a job is planned, after the operator has returned, so they stay.
    """
    for key, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        now = int(str(spark.conf.get(f"spark.sql.execution.arrow.{key}")).rstrip("bB"))
        if now <= 0 or now > most:
            spark.conf.set(f"spark.sql.execution.arrow.{key}", str(most))


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir.

    Only a local session without that setting (tests) gets a temporary folder.
    """
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not (sc.master or "").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="quarry-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables that written() has made in this process, in order; see discard().
_made: list[str] = []


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write df to the shared folder and read it again: cuts lineage, survives lost executors.

    The written table takes the place of the shuffle files, which are dropped.
    """
    spark, path = df.sparkSession, new_path(df.sparkSession, name)
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path), path


def made() -> int:
    """How many tables written() has made so far; a mark for discard()."""
    return len(_made)


def discard(spark: SparkSession, since: int, but: str) -> None:
    """Delete the tables written since a mark but one, once that one holds all that is read from now on."""
    for path in _made[since:]:
        if path != but:
            remove(spark, path)
    del _made[since:]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared store that nothing reads any more."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def word_count(text) -> F.Column:
    """Number of words `[^\\x20\\x09-\\x0D]+` of a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
