"""Tables written once into the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from caudal.session import shared_dir, ship


def _file(spark: SparkSession, name: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(name)
    return path, path.getFileSystem(spark._jsc.hadoopConfiguration())


class Stage:
    """A folder of intermediate tables.

    A written table cuts the lineage: a lost executor costs the running tasks only,
    and every later reader sees the same rows. The folder goes when the session ends,
    ``drop`` removes a table that nothing reads any more.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.root = f"{shared_dir(spark)}/caudal-{uuid.uuid4().hex}"
        path, system = _file(spark, self.root)
        system.mkdirs(path)
        system.deleteOnExit(path)
        ship(spark)

    def put(self, df: DataFrame, name: str, free: bool = True) -> DataFrame:
        """Write a frame and read it again. ``free`` gives the shuffle files of the finished work back.

        Spark removes them when the driver has collected their dependency, and what refers to it is
        finalised first.
        """
        df.write.mode("overwrite").parquet(f"{self.root}/{name}")
        schema = df.schema
        del df
        if free:
            gc.collect()
            system = self.spark._jvm.System
            system.gc()
            system.runFinalization()
            system.gc()
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            path, system = _file(self.spark, f"{self.root}/{name}")
            system.delete(path, True)
