"""What the operators need from the session: the package on the workers, stored tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from oreline.session import shared_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package also where the driver was started in another folder."""
    have = spark.sparkContext.environment.get("PYTHONPATH", "")
    if ROOT not in have.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (have, ROOT) if x)


def store(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the folder all executors share and read back."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
