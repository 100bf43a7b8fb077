"""Records as they arrive: rule checks per micro-batch. An extension; the checks themselves are those of the batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillsift.operators import rules


def first_arrivals(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Rows (id, arrived, ...) once an id, within ``late`` of each other."""
    return stream.withWatermark("arrived", late).dropDuplicatesWithinWatermark(["id"])


def traces(stream: DataFrame) -> DataFrame:
    """Assistant residue in arriving texts (id, section, text): stateless."""
    return rules.trace_hits(stream.select("id", "section", "text"))


def each_batch(stream: DataFrame, check: Callable[[DataFrame, int], None], checkpoint: str):
    """Runs a batch check on every micro-batch."""
    return stream.writeStream.foreachBatch(check).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def hourly(stream: DataFrame, late: str = "1 hour") -> DataFrame:
    """Arrivals an hour, late ones within the watermark included."""
    return stream.withWatermark("arrived", late).groupBy(F.window("arrived", "1 hour")).agg(F.count(F.lit(1)).alias("n"))
