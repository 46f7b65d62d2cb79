"""Most frequent values among billions, in bounded memory.

Each partition keeps a space-saving summary: at most `capacity` counters and a `cut`, the count that a value without a
counter may have had. A counter's `low` never exceeds the true count, and low + cut never falls below it; cut is at most
N / (capacity + 1). Summaries are merged in a tree (add the counters, add the cuts, lower everything by the largest
counter that has to go), which keeps these bounds. A second pass then counts the survivors exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FAN_IN = 32
SCHEMA = "leaf long, field string, value string, low long, cut long, total long"
_ARROW = pa.schema([("leaf", pa.int64()), ("field", pa.string()), ("value", pa.string()), ("low", pa.int64()), ("cut", pa.int64()), ("total", pa.int64())])


def prune(counts: dict[str, int], cut: int, capacity: int) -> tuple[dict[str, int], int]:
    """The summary with at most `capacity` counters, all lowered by the largest that has to go."""
    if len(counts) <= capacity:
        return counts, cut
    values = np.fromiter(counts.values(), np.int64, len(counts))
    gone = int(np.partition(values, len(values) - capacity - 1)[len(values) - capacity - 1])
    return {k: n - gone for k, n in counts.items() if n > gone}, cut + gone


def _rows(leaf: int, summaries: dict[str, list]) -> pa.RecordBatch:
    """A row per counter, and one with a null value for the summary's own figures."""
    out: list[list] = [[], [], [], [], [], []]
    for field, (counts, cut, total) in summaries.items():
        n = len(counts) + 1
        for column, part in zip(out, ([leaf] * n, [field] * n, [*counts, None], [*counts.values(), 0], [0] * (n - 1) + [cut], [0] * (n - 1) + [total]), strict=True):
            column += part
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _ARROW, strict=True)], schema=_ARROW)


def _leaves(capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        summaries: dict[str, list] = {}
        for batch in batches:
            counted = pa.Table.from_batches([batch]).group_by(["field", "value"]).aggregate([([], "count_all")])
            for field, value, n in zip(counted["field"].to_pylist(), counted["value"].to_pylist(), counted["count_all"].to_pylist(), strict=True):
                s = summaries.setdefault(field, [{}, 0, 0])
                s[0][value] = s[0].get(value, 0) + n
                s[2] += n
            for s in summaries.values():
                if len(s[0]) > 2 * capacity:
                    s[0], s[1] = prune(s[0], s[1], capacity)
        for s in summaries.values():
            s[0], s[1] = prune(s[0], s[1], capacity)
        yield _rows(TaskContext.get().partitionId(), summaries)

    return run


def _merge(capacity: int):
    def run(table: pa.Table) -> pa.Table:
        counts: dict[str, int] = {}
        cut = total = 0
        for value, low, c, n in zip(*(table[x].to_pylist() for x in ("value", "low", "cut", "total")), strict=True):
            if value is None:
                cut, total = cut + c, total + n
            else:
                counts[value] = counts.get(value, 0) + low
        counts, cut = prune(counts, cut, capacity)
        return pa.Table.from_batches([_rows(table["leaf"][0].as_py(), {table["field"][0].as_py(): [counts, cut, total]})])

    return run


def summarise(values: DataFrame, capacity: int = 2000, levels: int = 3) -> DataFrame:
    """(field, value, low, high, total): one summary per field of a table of (field, value).

    low <= true count <= high for every value listed; a value that isn't listed stands at most `high - low` times, at
    most total / (capacity + 1). Rows with a null field or value don't count. No rows, no summary.
    """
    level = values.where("field is not null and value is not null").select("field", "value").mapInArrow(_leaves(capacity), SCHEMA)
    for i in range(levels):
        up = F.lit(0).cast("long") if i == levels - 1 else F.floor(F.col("leaf") / FAN_IN)
        level = level.withColumn("leaf", up).groupBy("field", "leaf").applyInArrow(_merge(capacity), SCHEMA)
    own = level.where("value is null").select("field", "cut", "total")
    return level.where("value is not null").select("field", "value", "low").join(F.broadcast(own), "field").select(
        "field", "value", "low", (F.col("low") + F.col("cut")).alias("high"), "total"
    )


def frequent(values: DataFrame, share: float, capacity: int = 2000) -> DataFrame:
    """(field, value, n, total, low, high): the values that hold at least `share` of all rows of their field, counted
    exactly. capacity must exceed 1 / share, so that none can be missed."""
    if capacity * share <= 1:
        raise ValueError("capacity must be greater than 1 / share")
    spark = values.sparkSession
    # at most capacity rows a field reach the driver; the bound keeps every value that may hold its share
    found = summarise(values, capacity).where(F.col("high") >= F.col("total") * share).collect()
    names = spark.createDataFrame([(r.field, r.value, r.low, r.high, r.total) for r in found], "field string, value string, low long, high long, total long")
    exact = values.join(F.broadcast(names.select("field", "value")), ["field", "value"], "left_semi").groupBy("field", "value").agg(F.count("*").alias("n"))
    return exact.join(F.broadcast(names), ["field", "value"]).where(F.col("n") >= F.col("total") * share).select("field", "value", "n", "total", "low", "high")
