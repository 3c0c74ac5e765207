"""Training meters as aggregates (G5, L7 batch twin).

A running meter ``update(val, n)`` is ``sum += val*n; count += n``; its average
is ``sum / count`` and ``val`` is the last value.  Over a table of updates that
is one grouped aggregate (combined map-side); a reset per epoch is a grouping
key, a reset per time span is a ``window``.
"""

from __future__ import annotations

from typing import Sequence, Union

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColLike = Union[str, Column]


def _c(x: ColLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def meter_aggs(value: ColLike = "val", n: ColLike = "n", order: ColLike = "step") -> list[Column]:
    v, w, o = _c(value), _c(n), _c(order)
    return [F.sum(v * w).alias("sum"), F.sum(w).cast("bigint").alias("count"),
            (F.sum(v * w) / F.sum(w)).alias("average"), F.max_by(v, o).alias("last")]


def weighted_meter(df: DataFrame, group: Sequence[ColLike] = ("tag",), value: ColLike = "val",
                   n: ColLike = "n", order: ColLike = "step") -> DataFrame:
    """``sum, count, average, last`` per group."""
    return df.groupBy(*group).agg(*meter_aggs(value, n, order))


def meters_by_window(df: DataFrame, time_col: str, duration: str, group: Sequence[ColLike] = ("tag",),
                     value: ColLike = "val", n: ColLike = "n", order: ColLike = "step") -> DataFrame:
    """Meters reset on tumbling event-time windows (``window_start`` as epoch seconds)."""
    g = df.groupBy(F.window(time_col, duration).alias("__w"), *group).agg(*meter_aggs(value, n, order))
    return g.select(F.unix_timestamp(F.col("__w.start")).alias("window_start"), *[c for c in g.columns if c != "__w"])
