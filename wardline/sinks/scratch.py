"""Intermediate tables under the shared checkpoint folder that go as soon as they are superseded."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from wardline.sinks import files


class Scratch:
    """Named Parquet tables in a folder of their own.

    ``keep`` cuts lineage like a checkpoint. Keeping another table under the same name deletes
    the one before, once the new one is written; ``drop`` and ``clear`` delete tables that no
    later step reads. Tables that a returned DataFrame still reads must stay.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root = spark, files.fresh_dir(spark, name)
        self.paths: dict[str, str] = {}

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if name in self.paths:
                files.delete(self.spark, self.paths.pop(name))

    def clear(self) -> None:
        self.drop(*list(self.paths))
        files.delete(self.spark, self.root)
