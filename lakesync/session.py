"""Session settings every job relies on, and reliable lineage cuts."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Pin the settings results depend on.

    Instants are read and written in UTC, in files as microseconds, of which
    files keep the least and greatest so that windows skip them. A JSON object
    that repeats a key keeps the last value instead of failing.
    """
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor reaches, for checkpoints of frames and streams."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        return shared
    if spark.sparkContext.master.startswith("local"):
        return spark.conf.get("spark.sql.warehouse.dir") + "/_checkpoints"
    raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever Spark keeps it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


class Scratch:
    """Tables written to the shared folder: lineage ends there, and a lost executor costs only a re-read.

    Tables of loops are dropped as soon as the next one is written; the rest
    stay for the frames that read them and go with ``drop_all``, or at the end
    of a ``with`` block around the use of what was made from them.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []
        self.root = f"{shared_folder(spark)}/scratch-{uuid.uuid4().hex}"

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop_all()

    def cut(self, df: DataFrame) -> DataFrame:
        path = f"{self.root}/{len(self.paths)}"
        self.paths.append(path)
        df.write.parquet(path)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch_path = path
        return back

    def drop(self, df: DataFrame) -> None:
        remove(self.spark, df._scratch_path)

    def drop_all(self) -> None:
        remove(self.spark, self.root)
