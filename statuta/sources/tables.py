"""Readers of the star-schema and corpus tables."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The Parquet table `name` below `sf_dir`, by any path Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpointed(df: DataFrame) -> DataFrame:
    """`df` written to the shared checkpoint folder and read back, with its lineage cut.

    The folder is the session's spark.checkpoint.dir. Where none is set, a folder of this machine
    would do only if all executors are on it: with another master than a local one that is an error.
    """
    spark = df.sparkSession
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None:
            if not re.match(r"local(\[|$)", sc.master):
                raise ValueError("spark.checkpoint.dir is not set: name a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="checkpoints-")
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def unsized(df: DataFrame) -> DataFrame:
    """`df`, which is checkpointed, as rows of an RDD, of which Spark estimates no size.

    A checkpoint keeps the estimate of the plan it cuts, and a join's is the product of its sides'. In a
    loop that joins a frame with what comes of it the estimate's digits double each round, until the
    driver's time and memory go to multiplying them.
    """
    spark = df.sparkSession
    return DataFrame(spark._jsparkSession.createDataFrame(df._jdf.toJavaRDD(), df._jdf.schema()), spark)
