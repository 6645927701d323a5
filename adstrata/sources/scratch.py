"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from adstrata.session import shared_folder


def written(df: DataFrame, name: str) -> DataFrame:
    """``df``, computed once into a fresh folder and read back; safe from lost executors.

    Tables stay in ``spark.checkpoint.dir`` until that folder is cleaned up.
    """
    path = f"{shared_folder(df.sparkSession)}/adstrata/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark delete the shuffle files of tables that are stored by now.

    Spark cleans up behind shuffles that the driver no longer refers to, once the driver has collected
    its garbage; left alone it does so every half hour, while the disks of executors fill.
    """
    gc.collect()
    spark._jvm.System.gc()
