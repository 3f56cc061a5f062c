"""Delivering a table to a landing folder period by period, as if it arrived over time."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import next_file_number
from strandline.sinks import WHOLE_TIMES


class ArrivalReplay:
    """``staged`` holds the periods, ``landing`` receives them as ``01.json``, ``02.json``, ...

    A period is a folder of JSON-lines files, so that it can be of any size.
    """

    def __init__(self, spark: SparkSession, staged: str, landing: str):
        self.spark = spark
        self.staged = staged
        self.landing = landing

    @classmethod
    def stage(cls, df: DataFrame, period: Column, staged: str, landing: str) -> ArrivalReplay:
        """Split a table by a period number from 1 upwards.

        The rebalance hint lets Spark cut a period that holds much of the data into several files.
        """
        parts = df.withColumn("_period", period.cast("int")).hint("rebalance", "_period")
        parts.write.options(**WHOLE_TIMES).partitionBy("_period").json(staged)
        return cls(df.sparkSession, staged, landing)

    def next_number(self) -> int:
        """One more than the highest number delivered so far, by a listing of the landing folder."""
        listing = self.spark.read.format("binaryFile").option("recursiveFileLookup", True)
        try:
            files = listing.load(self.landing).select("path")
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return 1
        folder = F.element_at(F.split("path", "/"), -2)
        return files.agg(next_file_number(folder)).first()[0]

    def last_number(self) -> int:
        """The highest staged period, by a listing: no file is opened."""
        listing = self.spark.read.format("binaryFile").load(self.staged)
        return listing.agg(F.max(F.col("_period").cast("int"))).first()[0]

    def deliver(self) -> int | None:
        """Deliver the next period; None when there are no more. Lines are copied unparsed."""
        number = self.next_number()
        if number > self.last_number():
            return None
        lines = self.spark.read.text(self.staged).where(F.col("_period") == number).select("value")
        lines.write.mode("overwrite").text(f"{self.landing}/{number:02}.json")
        return number

    def deliver_all(self) -> int:
        """Deliver everything that is left; returns how many periods that were."""
        n = 0
        while self.deliver() is not None:
            n += 1
        return n
