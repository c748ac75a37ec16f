"""Reading tables and cutting lineage through files that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from hazeline.session import work_dir

#: Spark's setting under which a finished action's shuffle files go at once.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, purpose: str) -> DataFrame:
    """The same rows, read back from a table under the shared folder.

    Later steps read the files, so a lost executor costs no recomputation of
    what lies before, and nothing before is computed twice. Shuffle files of the
    write are no longer needed then and go; else they would stay until the driver
    happens to collect its garbage.
    """
    spark = df.sparkSession
    path = work_dir(spark, f"llm-{purpose}")
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``DataFrame.checkpoint`` work where the session names no folder, as in tests."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(work_dir(spark, "llm-checkpoints"))
