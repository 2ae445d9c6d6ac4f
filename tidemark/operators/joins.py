"""As-of and range joins, by windows over a union, so that a shuffle by key is all they need."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, events: DataFrame, key: str | None, at: str, event_at: str, order: list[str] | None = None) -> DataFrame:
    """Left rows with the columns of the latest event at or before them (null if none).

    ``order`` breaks ties between events of one time: the last wins.  One shuffle by key; both sides
    meet in one sorted pass, whatever their sizes.
    """
    keep = [c for c in events.columns if c != key]
    packed = F.struct(*keep)
    names = left.columns
    ties = order or []
    a = left.select(F.struct("*").alias("_row"), *([F.col(key)] if key else []), F.col(at).alias("_t"), F.lit(1).alias("_side"), F.lit(None).cast(events.select(packed).schema[0].dataType).alias("_e"), *[F.lit(None).cast(events.schema[c].dataType).alias(f"_o_{c}") for c in ties])
    b = events.select(F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"), *([F.col(key)] if key else []), F.col(event_at).alias("_t"), F.lit(0).alias("_side"), packed.alias("_e"), *[F.col(c).alias(f"_o_{c}") for c in ties])
    w = (Window.partitionBy(key) if key else Window.partitionBy()).orderBy("_t", "_side", *[f"_o_{c}" for c in ties]).rowsBetween(Window.unboundedPreceding, 0)
    met = a.unionByName(b).withColumn("_last", F.last("_e", ignorenulls=True).over(w)).where("_side = 1")
    return met.select(*[F.col("_row")[c].alias(c) for c in names], *[F.col("_last")[c].alias(c) for c in keep if c not in names])


def range_aggregate(left: DataFrame, events: DataFrame, key: str, at: str, event_at: str, lo: int, hi: int, value: Column, out: str) -> DataFrame:
    """Sum of ``value`` over the events from lo to hi days after each left row (negative: before); 0 if none.

    Window frame over the union of both sides, ordered by day number.
    """
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    names = left.columns
    a = left.select(F.struct("*").alias("_row"), key, day(at).alias("_t"), F.lit(None).cast("double").alias("_v"))
    b = events.select(F.lit(None).cast(left.select(F.struct("*")).schema[0].dataType).alias("_row"), key, day(event_at).alias("_t"), value.cast("double").alias("_v"))
    w = Window.partitionBy(key).orderBy("_t").rangeBetween(lo, hi)
    met = a.unionByName(b).withColumn("_s", F.coalesce(F.sum("_v").over(w), F.lit(0.0))).where("_row is not null")
    return met.select(*[F.col("_row")[c].alias(c) for c in names], F.col("_s").alias(out))


def at_session(left: DataFrame, right: DataFrame, calendar: DataFrame, keys: list[str], date: str, ahead: int, value: str, out: str) -> DataFrame:
    """``value`` of the right row exactly ``ahead`` sessions later, null if there is no row on that session."""
    pos = F.broadcast(calendar.select(F.col("trade_date").alias(date), F.col("pos")))  # one row per session
    end = F.broadcast(calendar.select((F.col("pos") - ahead).alias("pos"), F.col("trade_date").alias("_end")))
    later = right.select(*keys, F.col(date).alias("_end"), F.col(value).alias(out))
    return left.join(pos, date).join(end, "pos", "left").join(later, [*keys, "_end"], "left").drop("pos").withColumnRenamed("_end", f"{out}_date")
