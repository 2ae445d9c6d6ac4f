"""Market layer: wealth returns, self-built benchmarks, exact-session labels, raw market factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions import safe_div, source_available_at
from tidemark.operators import windows as W

RATIOS = ("cash_dividend", "bonus_ratio", "transfer_ratio", "allotment_ratio")
HORIZONS = (20, 60, 120)


def summed_actions(actions: DataFrame) -> DataFrame:
    """One row per security and ex-date: ratios and cash add up, the allotment price is weighted by its ratio."""
    cash = F.sum(F.col("allotment_ratio") * F.coalesce("allotment_price", F.lit(0.0)))
    ratio = F.sum("allotment_ratio")
    return actions.groupBy("security_id", F.col("ex_date").alias("trade_date")).agg(
        *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in RATIOS], F.when(ratio > 0, cash / ratio).alias("allotment_price")
    )


def total_returns(bars: DataFrame, actions: DataFrame) -> DataFrame:
    """Bars with the wealth return of the day and the total-return index.

    Bars and summed actions meet on (security, date) and stay dealt by security for the windows.
    """
    d = bars.join(summed_actions(actions), ["security_id", "trade_date"], "left").fillna(0.0, list(RATIOS))
    d = d.withColumn("prev_close", F.lag("close").over(W.own()))
    wealth = F.expr("close * (1 + bonus_ratio + transfer_ratio + allotment_ratio) + cash_dividend - allotment_ratio * coalesce(allotment_price, 0.0D)")
    d = d.withColumn("ret", F.when(F.col("prev_close") > 0, wealth / F.col("prev_close") - 1))
    return d.withColumn("tri", W.compounded(F.col("ret")))


def benchmarks(returns: DataFrame, valuation: DataFrame) -> DataFrame:
    """Equal, float and total value weighted return per date, weights and eligibility from the row before."""
    v = valuation.select("security_id", "trade_date", "float_mv", "total_mv").dropDuplicates(["security_id", "trade_date"])
    d = returns.select("security_id", "trade_date", "ret").join(v, ["security_id", "trade_date"], "left")
    lagged = [F.lag(c).over(W.own()).alias(n) for c, n in (("float_mv", "fw"), ("total_mv", "cw"), ("ret", "before"))]
    d = d.select("trade_date", "ret", *lagged).where("before is not null and ret is not null")

    def weighted(w: str):
        return F.sum(F.when(F.col(w) > 0, F.col("ret") * F.col(w))) / F.sum(F.when(F.col(w) > 0, F.col(w)))

    b = d.groupBy("trade_date").agg(F.avg("ret").alias("ew"), weighted("fw").alias("ffm"), weighted("cw").alias("cap"), F.count("*").alias("names"))
    by_date = W.own(key=None)  # one row per date
    return b.select("*", *[W.compounded(F.col(c), by_date).alias(f"{c}_tri") for c in ("ew", "ffm", "cap")])


def labels(returns: DataFrame, bench: DataFrame, calendar: DataFrame) -> DataFrame:
    """Excess return from each session to exactly 20, 60 and 120 sessions later; rows without any are left out.

    Sessions are numbered without gaps, so the session h later is the frame of exactly that number: one
    window over a security's own rows, and one over the date-sized benchmark path, instead of joins.
    """
    by_pos = Window.orderBy("pos")  # one row per session
    path = calendar.join(bench.select("trade_date", F.col("ffm_tri").alias("b0")), "trade_date", "left")
    path = path.select("trade_date", "pos", "b0", *[F.lead(c, h).over(by_pos).alias(f"{n}{h}") for h in HORIZONS for c, n in (("b0", "b"), ("trade_date", "d"))])
    own = Window.partitionBy("security_id").orderBy("pos")
    d = returns.select("security_id", "trade_date", "tri").join(F.broadcast(path), "trade_date")  # one row per session
    d = d.withColumns({f"e{h}": F.first("tri").over(own.rangeBetween(h, h)) for h in HORIZONS}).where("tri > 0 and b0 is not null")
    out = []
    for h in HORIZONS:
        both = F.col(f"e{h}").isNotNull() & F.col(f"b{h}").isNotNull()
        out.append(F.round(F.col(f"e{h}") / F.col("tri") - F.col(f"b{h}") / F.col("b0"), 6).alias(f"excess_{h}"))
        out.append(F.when(both, source_available_at(f"d{h}")).alias(f"end_{h}"))
    any_end = F.coalesce(*[F.col(f"end_{h}") for h in HORIZONS]).isNotNull()
    return d.select("security_id", F.col("trade_date").alias("as_of_date"), *out).where(any_end)


def technical(returns: DataFrame) -> DataFrame:
    """Rolling values per security; all windows share one sort by (security, date)."""
    c, v = F.col("close"), F.col("volume")
    d = returns.withColumn("r1", F.col("tri") / F.lag("tri").over(W.own()) - 1)
    fall = F.when(F.col("r1") < 0, F.col("r1")).otherwise(0.0)
    idle = F.when(F.coalesce("amount", F.lit(0.0)) <= 0, 1.0).otherwise(0.0)
    return d.select(
        "security_id", "trade_date", "close", "amount", "tri", "r1",
        W.change("tri", 60).alias("ret60"),
        (safe_div(F.lag("tri", 21).over(W.own()), F.lag("tri", 126).over(W.own())) - 1).alias("mom"),
        W.rolling(c, 252, 120, F.max).alias("high252"),
        *[W.rolling(c, n, n // 2, F.avg).alias(f"ma{n}") for n in (20, 60, 120)],
        *[W.rolling(v, n, n // 2, F.avg).alias(f"vol{n}") for n in (20, 120)],
        W.rolling(fall, 20, 10, F.stddev_samp).alias("down20"),
        W.rolling(idle, 20, 10, F.avg).alias("zero20"),
        W.rolling(F.abs("r1") / F.when(F.col("amount") != 0, F.col("amount")), 20, 10, F.avg).alias("amihud20"),
    )


def date_factors(bars: DataFrame, bench: DataFrame, tech: DataFrame) -> DataFrame:
    """one row per date."""
    by_date = W.own(key=None)
    f12 = bench.select("trade_date", W.change("ffm_tri", 120, by_date).alias("raw_f12"))
    f13 = tech.groupBy("trade_date").agg(F.avg(F.when(F.col("close") > F.col("ma120"), 1.0).otherwise(0.0)).alias("raw_f13"))
    amt = bars.groupBy("trade_date").agg(F.sum("amount").alias("amt"))
    f15 = amt.select(
        "trade_date", (W.rolling(F.col("amt"), 20, 10, F.avg, by_date) / W.rolling(F.col("amt"), 120, 60, lambda x: F.percentile(x, F.lit(0.5)), by_date) - 1).alias("raw_f15")
    )
    return f12.join(f13, "trade_date", "left").join(f15, "trade_date", "left")


def illiquidity_rank(over_all_dates: bool = False) -> Column:
    return W.rank_share(F.round("amihud20", 15), *([F.lit(0)] if over_all_dates else ["trade_date"]))


def raw_factors(tech: DataFrame, dates: DataFrame, over_all_dates: bool = False, ranks: DataFrame | None = None) -> DataFrame:
    """F47-F50 and F55 per security, date factors beside them.

    F55 ranks illiquidity within each date; ``over_all_dates`` ranks over the whole panel instead,
    which lets later rows change earlier values (and sorts the panel in one task).  ``ranks``: those ranks
    by security and date, where they are there already.
    """
    ratio = F.col("close") / F.col("ma20") - 1 + F.col("ma20") / F.col("ma60") - 1 + F.col("ma60") / F.col("ma120") - 1
    if ranks is not None:
        tech = tech.join(ranks, ["security_id", "trade_date"], "left")
    rank = illiquidity_rank(over_all_dates) if ranks is None else F.col("rank")
    out = tech.select(
        "security_id", "trade_date", F.col("mom").alias("raw_f47"), (F.col("close") / F.col("high252") - 1).alias("raw_f48"), ratio.alias("raw_f49"),
        (F.col("ret60") * safe_div("vol20", "vol120")).alias("raw_f50"), (F.col("down20") + F.col("zero20") + rank).alias("raw_f55"),
    )
    return out.join(F.broadcast(dates), "trade_date", "left").withColumnRenamed("trade_date", "as_of_date")  # one row per date
