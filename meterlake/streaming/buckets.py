"""Tables that a feed keeps between batches, in buckets of a key's hash: a batch reads and writes only the buckets it has news for."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BUCKETS = 32
PLACE = re.compile(r"/batch=(\d+)/bucket=(\d+)/")


def read_if_any(spark: SparkSession, *paths: str, base: str | None = None) -> DataFrame | None:
    """The Parquet table, or None where nothing was written yet."""
    try:
        reader = spark.read if base is None else spark.read.option("basePath", base)
        return reader.parquet(*paths)
    except AnalysisException as error:
        if "PATH_NOT_FOUND" in str(error) or "UNABLE_TO_INFER_SCHEMA" in str(error):
            return None
        raise


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the store that the path names."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class BucketTable:
    """Rows under `path/batch=N/bucket=B`; the newest batch of each bucket holds all its rows.

    A batch that is repeated replaces what it wrote and reads what it read before: the version before it is kept until the next
    batch that touches the bucket.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path, key, buckets

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets of the rows: at most `buckets` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket()).distinct().collect())

    def versions(self) -> dict[int, list[int]]:
        """Batches that wrote each bucket, from the names of the files."""
        table = read_if_any(self.spark, self.path)
        found: dict[int, set[int]] = {}
        for name in [] if table is None else table.inputFiles():
            place = PLACE.search(name)
            found.setdefault(int(place[2]), set()).add(int(place[1]))
        return {b: sorted(v) for b, v in found.items()}

    def read(self, buckets: list[int] | None = None, before: int | None = None) -> DataFrame | None:
        """Rows of the buckets (all, if none are named) as they were before a batch."""
        paths = []
        for bucket, batches in self.versions().items():
            known = [n for n in batches if before is None or n < before]
            if known and (buckets is None or bucket in buckets):
                paths.append(f"{self.path}/batch={known[-1]}/bucket={bucket}")
        return read_if_any(self.spark, *paths, base=self.path).drop("batch", "bucket") if paths else None

    def write(self, rows: DataFrame, number: int) -> None:
        """New state of the buckets that the rows fall into; versions that no repeat can ask for go."""
        before = self.versions()
        dealt = rows.withColumn("bucket", self.bucket()).repartition("bucket")
        dealt.write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/batch={number}")
        for bucket, batches in self.versions().items():
            if number in batches:
                for old in [n for n in before.get(bucket, []) if n < number][:-1]:
                    remove(self.spark, f"{self.path}/batch={old}/bucket={bucket}")
