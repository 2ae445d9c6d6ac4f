"""Raw factors F06 to F55, their standardisation, coverage and lineage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from tidemark.functions import log_positive, safe_div
from tidemark.operators import windows as W
from tidemark.operators.joins import asof_join, range_aggregate

#: Factor groups and the words that name their series.
MACRO = {
    "raw_f06": ("gdp", "pmi", "industrial", "retail"),
    "raw_f07": ("tsf", "social financing", "m2", "credit"),
    "raw_f08": ("lpr", "repo", "dr007", "yield"),
    "raw_f09": ("fiscal", "government expenditure", "财政支出"),
}
MACHINE = (22, 34, 35, 36, 37, 38, 40, 45)
MARKET = (12, 13, 15, 16, 17, 47, 48, 49, 50, 55)
MISSING = (1, 2, 3, 4, 5, 10, 11, 17, 19, 39)
#: Rows of F42's frame, and how many of them must have a value.
RANKED = (756, 126)
VERSION = "V3.0.3-H1-REAL-V1"


def panel_window() -> WindowSpec:
    return W.own("as_of_date")


def growth(c: str) -> Column:
    return safe_div(c, f"{c}_lag4") - 1


def by_industry(d: DataFrame, **values: Column) -> DataFrame:
    """Adds aggregates over the rows of one date and industry, null where the industry is."""
    w = Window.partitionBy("as_of_date", "industry")
    return d.withColumns({n: F.when(F.col("industry").isNotNull(), v.over(w)) for n, v in values.items()})


def by_industry_stored(keep) -> Callable[..., DataFrame]:
    """The same from a table of one row per date and industry, which ``keep`` stores: the rows themselves never move."""

    def add(d: DataFrame, **values: Column) -> DataFrame:
        sums = d.where("industry is not null").groupBy("as_of_date", "industry").agg(*[v.alias(n) for n, v in values.items()])
        return d.join(F.broadcast(keep(sums, "industries")), ["as_of_date", "industry"], "left")  # a row per session and industry

    return add


def joined(market: DataFrame, membership: DataFrame, reports: DataFrame, valuation: DataFrame, margin: DataFrame) -> DataFrame:
    """The market panel with what was known of each security on each date: industry, last report, valuation, margin."""
    d = asof_join(market, membership, "security_id", "as_of_date", "effective_from").drop("effective_from").withColumnRenamed("industry_code", "industry")
    return valued(asof_join(d, reports, "security_id", "as_of_date", "available_at", ["report_period"]), valuation, margin)


def combo() -> Column:
    return (log_positive("pe_ttm") + log_positive("pb")) / 2


def valued(d: DataFrame, valuation: DataFrame, margin: DataFrame) -> DataFrame:
    v = valuation.withColumnRenamed("trade_date", "as_of_date").dropDuplicates(["security_id", "as_of_date"])
    m = margin.withColumnRenamed("trade_date", "as_of_date").dropDuplicates(["security_id", "as_of_date"])
    d = d.join(v, ["security_id", "as_of_date"], "left").join(m, ["security_id", "as_of_date"], "left")
    return d.withColumn("combo", combo()).withColumn("bal", W.filled(F.col("balance"), panel_window()))


def known(dates: DataFrame, membership: DataFrame, reports: DataFrame, supply: DataFrame, regulatory: DataFrame, schedule: DataFrame) -> DataFrame:
    """For each security and date the industry, the keys of the last report, and F52 to F54.

    The same as the as-of joins of ``joined`` and as ``event_factors``, but all sides move at once, as keys.
    """
    day = lambda c: F.unix_date(F.col(c).cast("date"))
    at = lambda d, c, side, **values: d.select("security_id", day(c).alias("_t"), F.lit(side).alias("_side"), *[v.alias(n) for n, v in values.items()])
    parts = [
        at(membership, "effective_from", 0, _i=F.struct("industry_code")),
        at(reports, "available_at", 0, _o=F.col("report_period"), _r=F.struct("report_period", "available_at")),
        at(supply, "event_date", 0, _supply=F.col("qty").cast("double")),
        at(regulatory, "event_date", 0, _regulatory=F.lit(1.0)),
        at(schedule, "event_date", 0, _schedule=F.lit(1.0)),
    ]
    d = at(dates, "as_of_date", 1, as_of_date=F.col("as_of_date"))
    for p in parts:
        d = d.unionByName(p, allowMissingColumns=True)
    by = Window.partitionBy("security_id")
    last = lambda c: F.last(c, ignorenulls=True).over(by.orderBy("_t", "_side", "_o").rowsBetween(Window.unboundedPreceding, 0))
    total = lambda c, lo, hi: F.coalesce(F.sum(c).over(by.orderBy("_t").rangeBetween(lo, hi)), F.lit(0.0))
    d = d.select("security_id", "as_of_date", last("_i").alias("_i"), last("_r").alias("_r"), total("_supply", 1, 180).alias("raw_f53"), total("_regulatory", -179, 0).alias("raw_f54"), total("_schedule", 1, 90).alias("raw_f52"))
    return d.where("as_of_date is not null").select("security_id", "as_of_date", F.col("_i.industry_code").alias("industry"), "_r.report_period", "_r.available_at", "raw_f52", "raw_f53", "raw_f54")


def raw_panel(d: DataFrame, by_industry=by_industry, f42: Column | None = None) -> DataFrame:
    """All raw company factors that need no event tables; ``f42``: where its rank shares are there already."""
    d = by_industry(d, _revenue=F.sum("revenue_ttm")).withColumns({
        "mey": safe_div("pre_adj_np_ttm", "total_mv"),
        "mdisp": safe_div("disp_adj_np_ttm", "total_mv"),
        "raw_f24": growth("revenue_ttm") - (safe_div("revenue_ttm_lag1", "revenue_ttm_lag5") - 1),
        "share": safe_div("revenue_ttm", "_revenue"),
    })
    d = d.withColumns({
        "raw_f34": W.difference("mey", 21, panel_window()),
        "raw_f35": W.difference("mey", 63, panel_window()),
        "raw_f40": -W.difference("mdisp", 63, panel_window()),
        "raw_f51": W.change("bal", 20, panel_window()),
        "raw_f23": W.difference("share", 252, panel_window()),
        "raw_f42": -(W.rolling_rank_share(F.col("combo"), *RANKED, panel_window()) if f42 is None else f42),
    })
    d = d.drop("_revenue").withColumn("raw_f36", F.signum(F.coalesce("raw_f34", F.lit(0.0))))
    return by_industry(d, raw_f22=F.avg("raw_f36"), raw_f18=F.median("raw_f24")).withColumns({
        "raw_f25": growth("adj_np_ttm") - (safe_div("adj_np_ttm_lag1", "adj_np_ttm_lag5") - 1),
        "raw_f26": safe_div("op_cost_ttm_lag1", "revenue_ttm_lag1") - safe_div("op_cost_ttm", "revenue_ttm"),
        "raw_f27": safe_div("op_profit_ttm", "assets"),
        "raw_f28": safe_div("op_profit_ttm", "assets") - safe_div("op_profit_ttm_lag1", "assets_lag1"),
        "raw_f29": safe_div(F.col("cfo_ttm"), F.abs("net_income_ttm")),
        "raw_f30": safe_div(F.col("net_income_ttm") - F.col("cfo_ttm"), F.col("assets")),
        "raw_f31": growth("ar") - growth("revenue_ttm"),
        "raw_f32": growth("inventory") - growth("revenue_ttm"),
        "raw_f33": safe_div("liabilities", "assets") + safe_div("current_liab", "current_assets"),
        "raw_f37": safe_div(F.col("adj_np_ttm") - F.col("pre_adj_np_ttm"), F.col("scale_adj_np_ttm")),
        "raw_f38": safe_div(F.col("revenue_ttm") - F.col("pre_revenue_ttm"), F.col("scale_revenue_ttm")),
        "raw_f41": -F.col("combo"),
        "raw_f43": safe_div(F.col("cfo_ttm") - F.col("capex_ttm"), F.col("total_mv")),
        "raw_f44": safe_div(growth("adj_np_ttm"), F.abs("pe_ttm")),
        "raw_f45": F.col("raw_f35") - F.col("raw_f47"),
        "raw_f20": safe_div("inventory", "revenue_ttm"),
        "raw_f21": F.col("raw_f24") - growth("inventory"),
        "raw_f46": W.rolling(F.col("turnover_rate"), 20, 10, F.avg, panel_window()) + F.coalesce("raw_f51", F.lit(0.0)),
    })


def event_factors(market: DataFrame, supply: DataFrame, regulatory: DataFrame, schedule: DataFrame) -> DataFrame:
    """quantity to come in 180 days; F54: events of the last 180 days; F52: disclosures of the next 90."""
    d = market.select("security_id", "as_of_date")
    d = range_aggregate(d, supply, "security_id", "as_of_date", "event_date", 1, 180, F.col("qty"), "raw_f53")
    d = range_aggregate(d, regulatory, "security_id", "as_of_date", "event_date", -179, 0, F.lit(1.0), "raw_f54")
    return range_aggregate(d, schedule, "security_id", "as_of_date", "event_date", 1, 90, F.lit(1.0), "raw_f52")


def macro_moves(macro: DataFrame) -> DataFrame:
    """Three-step change of the daily mean of each keyword group's series; a series may be of several groups."""
    name = F.lower("series")
    named = [F.when(F.exists(F.array(*map(F.lit, words)), name.contains), F.lit(f)) for f, words in MACRO.items()]
    d = macro.select(F.explode(F.array_compact(F.array(*named))).alias("factor"), "release_date", "value")
    d = d.groupBy("factor", "release_date").agg(F.avg("value").alias("v"))
    w = Window.partitionBy("factor").orderBy("release_date")
    return d.select("factor", "release_date", F.when(F.col("factor") == "raw_f08", -W.difference("v", 3, w)).otherwise(W.change("v", 3, w)).alias("move"))


def macro_factors(calendar: DataFrame, macro: DataFrame) -> DataFrame:
    """F06 to F09 as known on each session; one row per date."""
    d, moves = calendar.select(F.col("trade_date").alias("as_of_date")), macro_moves(macro)
    for f in MACRO:
        own = moves.where(F.col("factor") == f).select("release_date", F.col("move").alias(f))
        d = asof_join(d, own, None, "as_of_date", "release_date").drop("release_date")
    return d


def full_panel(panel: DataFrame, *by_date: DataFrame) -> DataFrame:
    """F01 to F55 for each row of a panel that has F52 to F54 too; those that have no open source (``MISSING``) as null columns."""
    d = panel
    for one in by_date:
        d = d.join(F.broadcast(one), "as_of_date", "left")  # a row per session
    d = d.withColumns({f"raw_f{i:02}": F.lit(None).cast("double") for i in MISSING})
    return d.select("security_id", "as_of_date", *(f"raw_f{i:02}" for i in range(1, 56)))


def earnings_yield(valuation: DataFrame) -> DataFrame:
    """median earnings yield per date."""
    return valuation.groupBy(F.col("trade_date").alias("as_of_date")).agg(F.median(F.try_divide(F.lit(1.0), "pe_ttm")).alias("raw_f14"))


def small_minus_large(panel: DataFrame, least: int = 50) -> DataFrame:
    """F16: median momentum of the smaller half by market value less that of the larger half, per date."""
    by_date = Window.partitionBy("as_of_date")
    d = panel.select("as_of_date", "total_mv", "raw_f47").where("total_mv is not null and raw_f47 is not null")
    d = d.withColumns({"mid": F.median("total_mv").over(by_date), "n": F.count("*").over(by_date)}).where(F.col("n") >= least)
    half = lambda c: F.median(F.when(c, F.col("raw_f47")))
    return d.groupBy("as_of_date").agg((half(F.col("total_mv") <= F.col("mid")) - half(F.col("total_mv") > F.col("mid"))).alias("raw_f16"))


def standardised(panel: DataFrame, factor: str, least: int = 20) -> DataFrame:
    """Cross-sectional, industry-neutral score of a company factor (nulls where a date has too few)."""
    d = panel.select("security_id", "as_of_date", "industry", factor)
    return W.cross_section_z(d, factor, "as_of_date", "industry", least)


def date_score(dates: DataFrame, factor: str, least: int = 60) -> DataFrame:
    """Score of a date factor against strictly earlier dates."""
    return W.expanding_z(dates.select("as_of_date", factor), factor, "as_of_date", least).select("as_of_date", "z")


def source_family(factor: Column) -> Column:
    n = F.substring(factor, 2, 2).cast("int")
    return F.when(n.isin(*MACHINE), "OPEN_MACHINE_PROXY").when(n.isin(*MARKET), "MARKET").otherwise("OPEN_PIT_REAL")


def lineage(scores: DataFrame, factors: list[str]) -> DataFrame:
    """One row per non-missing cell with a digest of where it comes from."""
    long = scores.unpivot(["security_id", "as_of_date"], factors, "factor_id", "value").where("value is not null")
    long = long.withColumn("factor_id", F.upper(F.regexp_replace("factor_id", "^raw_", ""))).withColumn("source_ids", source_family(F.col("factor_id")))
    known = F.concat(F.col("as_of_date").cast("string"), F.lit(" 07:00:00+00:00"))
    payload = F.concat_ws("|", F.concat(F.col("as_of_date").cast("string"), F.lit(" 00:00:00")), F.col("security_id").cast("string"), "factor_id", "source_ids", known, F.lit(VERSION))
    return long.select("security_id", "as_of_date", "factor_id", "source_ids", F.sha2(payload, 256).alias("lineage_hash"))


def coverage(panel: DataFrame, factors: list[str], of: int = 55) -> DataFrame:
    held = sum((F.when(F.col(f).isNotNull(), 1).otherwise(0) for f in factors), F.lit(0))
    return panel.select("security_id", "as_of_date", held.alias("factor_coverage_count"), F.round(held / of, 6).alias("factor_coverage_pct"))
