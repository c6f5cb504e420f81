"""Tables an operator writes on its way, in the folder the whole cluster shares."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; where that is unset, one below the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    return base or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/llm-scratch"


def find_package(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver did, wherever they were started. A cluster whose machines
    have it elsewhere, or get it with the job, is not disturbed."""
    root, workers = os.path.abspath(os.path.join(os.path.dirname(__file__), "..", "..")), spark.sparkContext.environment
    paths = [p for p in workers.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        workers["PYTHONPATH"] = os.pathsep.join([*paths, root])


class Scratch:
    """A folder for one call of an operator.

    A written table cuts the lineage, survives the loss of any executor and is never computed twice, so numbers
    given out by `monotonically_increasing_id` stay what they are. The folder can go once the result is written.
    """

    def __init__(self, spark: SparkSession, name: str):
        find_package(spark)
        self.spark = spark
        self.folder = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self._count = 0

    def table(self, df: DataFrame, **options) -> DataFrame:
        """``options`` are the writer's."""
        self._count += 1
        path = f"{self.folder}/{self._count}"
        df.write.options(**options).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def delete_spaces(text: Column) -> Column:
    """The text without the six ASCII white space characters."""
    for c in " \n\t\r\x0b\f":
        text = F.replace(text, F.lit(c), F.lit(""))
    return text
