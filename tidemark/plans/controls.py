"""Audit checks, override builders, walk-forward calibration, gates and the release lock."""

from __future__ import annotations

import math

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark import functions as T
from tidemark.operators import stats
from tidemark.operators import windows as W
from tidemark.operators.quantiles import exact_median
from tidemark.plans import calibration as C
from tidemark.plans.catalog import FIX, REPORT, Panel, R, col, query, r, select
from tidemark.sources import stored

# ---- audit: one row per check --------------------------------------------------------------------


#: Ledgers that a strict audit asks for, by the name of their check.
LEDGERS = {
    "H1_DELISTING_TERMINAL_VALUES": "openpit_overrides/delisting_terminal_values.parquet",
    "H1_EXACT_FINANCIAL_VINTAGES": "openpit_overrides/financial_field_vintages.parquet",
    "H1_ANNOUNCEMENT_TIMESTAMPS": "openpit_overrides/announcement_timestamp_registry.parquet",
    "H1_MACRO_VINTAGES": "openpit_overrides/macro_vintages.parquet",
    "BF3_FACTOR_PANEL": "openpit_features/factor_panel_wide.parquet",
    "H1_EXACT_FACTOR_LINEAGE": "openpit_features/factor_lineage.parquet",
    "BF3_FORWARD_LABELS": "openpit_features/forward_labels.parquet",
}


def checks(m: Panel) -> DataFrame:
    """Every check as a row (check_id, passed, value, blocking); what can't be read fails with a null value."""
    n = lambda d: d.agg(F.count("*").alias("value"))
    keys = lambda d, *k: d.groupBy(*k).count().where("count > 1").agg(F.count("*").alias("value"))
    days = lambda d, c: d.agg(c.cast("long").alias("value"))
    day = lambda x: F.lit(x).cast("date")
    broken = "high < greatest(open, close, low) - 1e-9 or low > least(open, close, high) + 1e-9 or volume < 0 or amount < 0"
    traded = lambda: m.bars.select("security_id", F.lit(1).alias("b")).distinct()
    rows = [
        ("BF1_MARKET_ROWS", lambda: n(m.bars), "value > 0", True),
        ("BF1_MARKET_DUPLICATES", lambda: keys(m.bars, "security_id", "trade_date"), "value = 0", True),
        ("BF1_MARKET_OHLC", lambda: n(m.bars.where(broken)), "value = 0", True),
        ("BF1_MARKET_WINDOW_START", lambda: days(m.bars, F.datediff(F.min("trade_date"), day("1992-01-10"))), "value <= 0", True),
        ("BF1_MARKET_WINDOW_END", lambda: days(m.bars, F.datediff(day("1998-06-01"), F.max("trade_date"))), "value <= 0", True),
        ("BF1_INSTRUMENTS", lambda: n(m.securities), "value > 0", True),
        ("BF1_CORPORATE_ACTIONS", lambda: n(m.actions), "value > 0", True),
        ("BF1_ADJ_FACTORS", lambda: n(m.adj_factors), "value > 0", True),
        ("BF1_DELISTING_EVENTS", lambda: n(m.delisted), "value > 0", True),
        ("BF1_SURVIVORSHIP_HISTORY", lambda: days(m.delisted.select("security_id").distinct().join(traded(), "security_id", "left"), F.floor(100 * F.count("b") / F.count("*"))), "value >= 90", True),
        ("BF1_TRADING_STATUS_HISTORY", lambda: days(m.trading_status, F.datediff(F.min("trade_date"), day("1992-01-10"))), "value <= 0", True),
        ("BF2_FINANCIAL_ROWS", lambda: n(m.statements), "value > 0", True),
        ("BF2_ANNOUNCEMENT_ROWS", lambda: n(m.announcements), "value > 0", True),
        ("BF2_MACRO_ROWS", lambda: n(m.macro), "value > 0", True),
        ("BF2_VALUATION_ROWS", lambda: n(m.valuation), "value > 0", True),
        ("BF2_FINANCIAL_ANNOUNCE_DATE", lambda: n(m.statements.where("available_at is null")), "value = 0", True),
        ("BF2_FINANCIAL_KEY_UNIQUE", lambda: keys(m.items, "security_id", "report_period", "statement_type", "item", "available_at"), "value = 0", True),
        ("BF2_INDUSTRY_PIT", lambda: days(m.membership, F.datediff(F.min("effective_from"), day("1992-01-31"))), "value <= 0", False),
        *((name, lambda path=path: m.holds(path), "value > 0", True) for name, path in LEDGERS.items()),
    ]
    out = None
    for name, value, rule, blocking in rows:
        try:
            found = value()
        except AnalysisException:  # no such table, or not with these columns
            found = m.spark.range(1).select(F.lit(None).cast("long").alias("value"))
        one = found.select(F.lit(name).alias("check_id"), F.coalesce(F.expr(rule), F.lit(False)).alias("passed"), "value", F.lit(blocking).alias("blocking"))
        out = one if out is None else out.unionByName(one)
    return out


def _count(table: str, where: str = "true") -> str:
    return f"(select count(*) from {table} where {where})"


def _keys(table: str, key: str) -> str:
    return f"(select count(*) from (select {key} from {table} group by {key} having count(*) > 1))"


AUDIT = [
    ("BF1_MARKET_ROWS", _count("bars"), "v > 0", True),
    ("BF1_MARKET_DUPLICATES", _keys("bars", "security_id, trade_date"), "v = 0", True),
    ("BF1_MARKET_OHLC", _count("bars", "high < greatest(open, close, low) - 1e-9 or low > least(open, close, high) + 1e-9 or volume < 0 or amount < 0"), "v = 0", True),
    ("BF1_MARKET_WINDOW_START", "(select date_diff('day', date '1992-01-10', min(trade_date)) from bars)", "v <= 0", True),
    ("BF1_MARKET_WINDOW_END", "(select date_diff('day', max(trade_date), date '1998-06-01') from bars)", "v <= 0", True),
    ("BF1_INSTRUMENTS", _count("securities"), "v > 0", True),
    ("BF1_CORPORATE_ACTIONS", _count("actions"), "v > 0", True),
    ("BF1_ADJ_FACTORS", _count("adj_factors"), "v > 0", True),
    ("BF1_DELISTING_EVENTS", _count("delisted"), "v > 0", True),
    ("BF1_SURVIVORSHIP_HISTORY", "(select floor(100.0 * count(*) filter (where security_id in (select security_id from bars)) / count(*)) from (select distinct security_id from delisted) d)", "v >= 90", True),
    ("BF1_TRADING_STATUS_HISTORY", "(select date_diff('day', date '1992-01-10', min(trade_date)) from trading_status)", "v <= 0", True),
    ("BF2_FINANCIAL_ROWS", _count("statements"), "v > 0", True),
    ("BF2_ANNOUNCEMENT_ROWS", _count("announcements"), "v > 0", True),
    ("BF2_MACRO_ROWS", _count("macro"), "v > 0", True),
    ("BF2_VALUATION_ROWS", _count("valuation"), "v > 0", True),
    ("BF2_FINANCIAL_ANNOUNCE_DATE", _count("statements", "available_at is null"), "v = 0", True),
    ("BF2_FINANCIAL_KEY_UNIQUE", _keys("items", "security_id, report_period, statement_type, item, available_at"), "v = 0", True),
    ("BF2_INDUSTRY_PIT", "(select date_diff('day', date '1992-01-31', min(effective_from)) from membership)", "v <= 0", False),
    *((name, "0", "v > 0", True) for name in LEDGERS),  # the driver's tables come without ledgers
]
AUDIT_SQL = " union all ".join(f"select '{i}' as check_id, {rule} as passed, v as value, {str(b).lower()} as blocking from (select cast({v} as bigint) as v) c" for i, v, rule, b in AUDIT)
select("audit_checks", AUDIT_SQL, checks)
select("audit_verdict", f"select bool_and(passed or not blocking) as strict_pit_gate_pass, count(*) filter (where not passed and blocking) as blocking_failures from ({AUDIT_SQL}) a",
       lambda m: checks(m).agg(F.bool_and(col("passed") | ~col("blocking")).alias("strict_pit_gate_pass"), F.count_if(~col("passed") & col("blocking")).alias("blocking_failures")))

# ---- overrides -------------------------------------------------------------------------------------
select("override_announcement_registry", "select announcement_id, announce_date + interval 16 hour as available_at, 'DATE_ONLY_NEXT_CALENDAR_DAY_00_SHANGHAI' as timing_policy from announcements",
       lambda m: m.announcements.select("announcement_id", T.next_day_available_at("announce_date").alias("available_at"), F.lit("DATE_ONLY_NEXT_CALENDAR_DAY_00_SHANGHAI").alias("timing_policy")))
select("override_correction_queue", f"select announcement_id, true as requires_original_field_reconstruction from announcements where regexp_matches(coalesce(title, ''), '{REPORT}') and regexp_matches(coalesce(title, ''), '{FIX}')",
       lambda m: m.announcements.where(F.coalesce("title", F.lit("")).rlike(REPORT) & F.coalesce("title", F.lit("")).rlike(FIX)).select("announcement_id", F.lit(True).alias("requires_original_field_reconstruction")))
select("override_financial_quarantine", "select security_id, report_period, false as strict_pit_eligible from statements", lambda m: m.statements.select("security_id", "report_period", F.lit(False).alias("strict_pit_eligible")))
select("override_macro_candidates", "select series, release_date, release_date + interval 16 hour as candidate_available_at from macro", lambda m: m.macro.select("series", "release_date", T.next_day_available_at("release_date").alias("candidate_available_at")))
select("override_terminal_queue", "select d.security_id, arg_max(b.close, b.trade_date) as terminal_value_candidate, max(b.trade_date) as last_trade_date from delisted d left join bars b on b.security_id = d.security_id group by 1",
       lambda m: m.delisted.select("security_id").join(m.bars.join(m.delisted.select("security_id"), "security_id", "left_semi").groupBy("security_id").agg(F.max_by("close", "trade_date").alias("terminal_value_candidate"), F.max("trade_date").alias("last_trade_date")), "security_id", "left"))

# ---- calibration -----------------------------------------------------------------------------------
#: A simple prediction to calibrate against the 20-session label; ``names`` is how many a date needs.
PREDICTED = "(select l.security_id, l.as_of_date, l.excess_20 as y, round(cast(m.raw_f48 as double), 9) as p from labels l join market m on m.security_id = l.security_id and m.as_of_date = l.as_of_date where l.excess_20 is not null and m.raw_f48 is not null) pr"
SHARE = "(rank() over (partition by as_of_date order by {c}) + (count(*) over (partition by as_of_date, {c}) - 1) / 2.0)"
NAMES = 5


def predicted(m: Panel) -> DataFrame:
    x = m.market.select("security_id", "as_of_date", R("raw_f48", 9).alias("p"))
    return m.labels.select("security_id", "as_of_date", col("excess_20").alias("y")).join(x, ["security_id", "as_of_date"]).na.drop(subset=["y", "p"])


def correlation(a: str, b: str):
    """Pearson correlation; null where a side doesn't vary."""
    return F.try_divide(F.covar_pop(a, b), F.stddev_pop(a) * F.stddev_pop(b))


def daily_ic(d: DataFrame, names: int = NAMES) -> DataFrame:
    """Rank correlation of y and p per date with enough names and three values of each."""
    ranked = d.select("as_of_date", "y", "p", W.rank_share(col("y"), "as_of_date").alias("ry"), W.rank_share(col("p"), "as_of_date").alias("rp"))
    g = ranked.groupBy("as_of_date").agg(F.count("*").alias("n"), F.countDistinct("y").alias("uy"), F.countDistinct("p").alias("up"), correlation("ry", "rp").alias("ic"))
    return g.where((col("n") >= names) & (col("uy") >= 3) & (col("up") >= 3)).select("as_of_date", "ic", "n")


IC = f"(select as_of_date, corr(ry, rp) as ic, count(*) as n from (select *, {SHARE.format(c='y')} as ry, {SHARE.format(c='p')} as rp from {PREDICTED}) q group by 1 having count(*) >= {NAMES} and count(distinct y) >= 3 and count(distinct p) >= 3) ic"
select("c12_daily_rank_ic", f"select as_of_date, {r('ic')} as ic, n from {IC}", lambda m: daily_ic(predicted(m)).select("as_of_date", R("ic", 6).alias("ic"), "n"))
select("c12_icir", f"select {r('avg(ic)', 5)} as ic, {r('avg(ic) / (stddev_samp(ic) + 1e-12) * sqrt(252)', 4)} as icir, count(*) as days from {IC}",
       lambda m: daily_ic(predicted(m)).agg(R(F.avg("ic"), 5).alias("ic"), R(F.avg("ic") / (F.stddev_samp("ic") + 1e-12) * math.sqrt(252), 4).alias("icir"), F.count("*").alias("days")))
#: Share of a date's names at either end: a quarter here, as the driver's tables have few names a date (a tenth otherwise).
END_SHARE = 0.25


def ends(d: DataFrame, share: float = 0.1, names: int = NAMES) -> DataFrame:
    """Per date with enough names: mean y of the top and bottom share by p, and the share of the top above zero."""
    q = d.withColumn("q", W.rank_share(col("p"), "as_of_date"))
    top, bottom = col("q") >= 1 - share, col("q") <= share
    return q.groupBy("as_of_date").agg(F.count("*").alias("n"), F.avg(F.when(top, col("y"))).alias("top"), F.avg(F.when(bottom, col("y"))).alias("bottom"), F.avg(F.when(top, (col("y") > 0).cast("double"))).alias("hit")).where(col("n") >= names)


ENDS = f"(select as_of_date, avg(case when q >= {1 - END_SHARE} then y end) as top, avg(case when q <= {END_SHARE} then y end) as bottom, avg(case when q >= {1 - END_SHARE} then case when y > 0 then 1.0 else 0.0 end end) as hit from (select *, {SHARE.format(c='p')} / count(*) over (partition by as_of_date) as q from {PREDICTED}) q group by 1 having count(*) >= {NAMES}) d"
select("c13_decile_spread", f"select {r('avg(top - bottom)', 5)} as spread, {r('avg(hit)', 5)} as top_positive from {ENDS} where top is not null and bottom is not null",
       lambda m: ends(predicted(m), END_SHARE).where("top is not null and bottom is not null").agg(R(F.avg(col("top") - col("bottom")), 5).alias("spread"), R(F.avg("hit"), 5).alias("top_positive")))
select("c16_cost_adjusted_alpha", f"select as_of_date, {r('top - 0.002', 9)} as alpha from {ENDS}", lambda m: ends(predicted(m), END_SHARE).select("as_of_date", R(col("top") - 0.002, 9).alias("alpha")))
select("c19_hit_rate", f"select {r('avg(case when sign(y) = sign(p + 0.02) then 1.0 else 0.0 end)')} as hit from {PREDICTED}", lambda m: predicted(m).agg(R(F.avg((F.signum("y") == F.signum(col("p") + 0.02)).cast("double")), 6).alias("hit")))
select("c15_brier_skill", f"select {r('1 - avg(power(g - case when y > 0 then 1 else 0 end, 2)) / (avg(case when y > 0 then 1.0 else 0.0 end) * (1 - avg(case when y > 0 then 1.0 else 0.0 end)))')} as skill from (select *, 1 / (1 + exp(-p)) as g from {PREDICTED}) b",
       lambda m: predicted(m).withColumn("g", 1 / (1 + F.exp(-col("p")))).withColumn("u", (col("y") > 0).cast("double")).agg(R(1 - F.avg((col("g") - col("u")) * (col("g") - col("u"))) / (F.avg("u") * (1 - F.avg("u"))), 6).alias("skill")))
HITS = f"""(select security_id, as_of_date, case when pr.y < pr.p + e.q5 then 1 else 0 end as v from {PREDICTED} join
    (select year(as_of_date) + 1 as test_year, quantile_cont(y - p, 0.05) as q5 from {PREDICTED} group by 1) e on year(pr.as_of_date) = e.test_year) h"""


def violations(m: Panel) -> DataFrame:
    """Whether y falls below the value at risk: the prediction plus the 5 % quantile of the errors of the year before."""
    d = predicted(m).withColumn("test_year", F.year("as_of_date"))
    errors = d.groupBy((col("test_year") + 1).alias("test_year")).agg(F.percentile(col("y") - col("p"), F.lit(0.05)).alias("q5"))  # one row per year
    return d.join(F.broadcast(errors), "test_year").select("security_id", "as_of_date", (col("y") < col("p") + col("q5")).cast("int").alias("v"))


select("c11_var_violations", f"select cast(year(as_of_date) as int) as year, count(*) as n, cast(sum(v) as bigint) as hits from {HITS} group by 1", lambda m: violations(m).groupBy(F.year("as_of_date").alias("year")).agg(F.count("*").alias("n"), F.sum("v").alias("hits")))
select("w20_transitions", f"select before, v, count(*) as n from (select v, lag(v) over (partition by security_id order by as_of_date) as before from {HITS}) t where before is not null group by 1, 2",
       lambda m: violations(m).withColumn("before", F.lag("v").over(W.own("as_of_date"))).where("before is not null").groupBy("before", "v").agg(F.count("*").alias("n")))


def _one(m: Panel, **values) -> DataFrame:
    types = {float: "double", int: "long", bool: "boolean", str: "string"}
    fields = ", ".join(f"{k} {types[type(v)] if v is not None else 'double'}" for k, v in values.items())
    return m.spark.createDataFrame([tuple(values.values())], fields)


def hac(series: DataFrame, value: str, order: str, lag: int) -> float | None:
    """Newey-West t of a daily series: lagged products in Spark, weights on the driver."""
    mean = series.agg(F.avg(value)).first()[0]
    u = series.where(col(value).isNotNull()).select(order, (col(value) - (mean or 0.0)).alias("u"))
    w = Window.partitionBy().orderBy(order)  # one row per date
    sums = u.select("u", *[F.lag("u", k).over(w).alias(f"u{k}") for k in range(1, lag + 1)]).agg(F.count("u").alias("n"), *[F.coalesce(F.sum(col("u") * col(f"u{k}" if k else "u")), F.lit(0.0)) for k in range(lag + 1)]).first()
    return stats.hac_t(sums[0], mean, [float(x) for x in sums[1:]], lag) if mean is not None else None


@query("w19_hac_t", None)
def _(m):
    t = hac(daily_ic(predicted(m)), "ic", "as_of_date", 19)
    return _one(m, t=t, p_bonferroni3=min(1.0, 3 * 0.5 * math.erfc(t / math.sqrt(2))) if t is not None else 1.0)


@query("c14_kupiec_christoffersen", None)
def _(m):
    v = violations(m)
    n, hits = v.agg(F.count("*"), F.sum("v")).first()
    pairs = {(x["before"], x["v"]): x["count"] for x in v.withColumn("before", F.lag("v").over(W.own("as_of_date"))).where("before is not null").groupBy("before", "v").count().collect()}  # four rows
    four = [pairs.get(k, 0) for k in ((0, 0), (0, 1), (1, 0), (1, 1))]
    return _one(m, kupiec_p=stats.kupiec(n, hits or 0), christoffersen_p=stats.christoffersen(n, *four))


@query("w21_block_bootstrap", None)
def _(m):
    """Lower bound of the mean from 1000 seeded resamples of blocks of 20 days."""
    return block_bootstrap(daily_ic(predicted(m)).select(col("as_of_date").alias("d"), col("ic").alias("x")), 20, 1000)


def block_bootstrap(series: DataFrame, block: int, times: int, seed: int = 20260827) -> DataFrame:
    spark = series.sparkSession
    ranked = series.select((F.row_number().over(Window.partitionBy().orderBy("d")) - 1).alias("i"), "x")  # one row per date
    n = ranked.count()
    if n < block:
        return spark.createDataFrame([(None, n)], "lcb double, n long")
    draws = spark.range(times).select("id", F.explode(F.sequence(F.lit(0), F.lit(-(-n // block) - 1))).alias("k"))
    first = F.pmod(F.xxhash64("id", "k", F.lit(seed)), F.lit(max(1, n - block + 1)))
    picked = draws.select("id", (F.col("k") * block).alias("at"), first.alias("s")).select("id", "at", "s", F.explode(F.sequence(F.lit(0), F.lit(block - 1))).alias("j")).where(F.col("at") + F.col("j") < n)
    means = picked.select("id", (F.col("s") + F.col("j")).cast("int").alias("i")).join(F.broadcast(ranked), "i").groupBy("id").agg(F.avg("x").alias("mean"))  # one row per date
    return means.agg(F.percentile("mean", 0.025).alias("lcb"), F.lit(n).cast("long").alias("n"))


def folds(m: Panel, train_years: int = 3, embargo: int = 20) -> DataFrame:
    """(test_year, role, rows): walk-forward years; a label must end before the session ``embargo`` before the next role."""
    years = m.calendar.groupBy(F.year("trade_date").alias("year")).agg(F.min("pos").alias("first"), F.row_number().over(Window.orderBy(F.year("trade_date"))).alias("i"))
    stop = years.join(m.calendar.select((col("pos") + embargo).alias("first"), col("trade_date").alias("stop")), "first", "left").select("year", "i", "stop")
    test = stop.where(col("i") > train_years + 1).select(col("year").alias("test_year"), col("i").alias("ti"), col("stop").alias("tstop"))
    valid = stop.select((col("i") + 1).alias("ti"), col("year").alias("valid_year"), col("stop").alias("vstop"))
    f = F.broadcast(test.join(valid, "ti"))  # one row per year
    end = F.greatest("end_20", "end_60", "end_120")
    d = m.labels.select(F.year("as_of_date").alias("y"), end.alias("label_end"))
    at = lambda c: F.col(c).cast("timestamp") - F.make_dt_interval(hours=F.lit(8))
    role = F.when(col("y") == col("test_year"), "test").when((col("y") == col("valid_year")) & (col("label_end") < at("tstop")), "validate").when((col("y") < col("valid_year")) & (col("label_end") < at("vstop")), "train")
    return d.join(f, col("y") <= col("test_year")).select("test_year", role.alias("role")).where("role is not null").groupBy("test_year", "role").agg(F.count("*").alias("rows"))


FOLDS = """select cast(test_year as int) as test_year, role, count(*) as rows from (select f.test_year, case when year(l.as_of_date) = f.test_year then 'test' when year(l.as_of_date) = f.valid_year and greatest(end_20, end_60, end_120) < f.tstop - interval 8 hour then 'validate'
    when year(l.as_of_date) < f.valid_year and greatest(end_20, end_60, end_120) < f.vstop - interval 8 hour then 'train' end as role from labels l join (select t.year as test_year, v.year as valid_year, cast(t.stop as timestamp) as tstop, cast(v.stop as timestamp) as vstop from
    (select y.year, y.i, c.trade_date as stop from (select year(trade_date) as year, min(pos) as first, row_number() over (order by year(trade_date)) as i from calendar group by 1) y left join calendar c on c.pos = y.first - 20) t join
    (select y.year, y.i, c.trade_date as stop from (select year(trade_date) as year, min(pos) as first, row_number() over (order by year(trade_date)) as i from calendar group by 1) y left join calendar c on c.pos = y.first - 20) v on v.i = t.i - 1 where t.i > 4) f
    on year(l.as_of_date) <= f.test_year) x where role is not null group by 1, 2"""
select("c01_walk_forward_folds", FOLDS, folds)
select("c02_pit_gate", "select count(*) filter (where trade_date + interval 7 hour > trade_date + interval 12 hour) as future_rows, count(*) - count(distinct (security_id, trade_date)) as duplicates from bars",
       lambda m: m.bars.agg(F.count_if(T.source_available_at("trade_date") > T.decision_cutoff("trade_date")).alias("future_rows"), (F.count("*") - F.countDistinct("security_id", "trade_date")).alias("duplicates")))


def imputed(m: Panel) -> DataFrame:
    """Market values, missing ones as the exact median of all; bars are made once."""
    d = stored(m.valuation.select("security_id", "trade_date", "total_mv"), "total-mv")
    mid = F.lit(exact_median(d, "total_mv"))
    return d.select("security_id", "trade_date", R(F.coalesce("total_mv", mid), 6).alias("total_mv"), F.when(col("total_mv").isNull(), 1).otherwise(0).alias("was_missing"))


select("c03_median_impute", f"select security_id, trade_date, {r('coalesce(total_mv, mid)')} as total_mv, case when total_mv is null then 1 else 0 end as was_missing from valuation, (select median(total_mv) as mid from valuation) g",
       imputed)
select("c04_standard_score", f"select security_id, trade_date, {r('(turnover_rate - m) / s')} as z from valuation, (select avg(turnover_rate) as m, stddev_pop(turnover_rate) as s from valuation) g",
       lambda m: (lambda g: m.valuation.select("security_id", "trade_date", R((col("turnover_rate") - F.lit(g[0])) / F.lit(g[1]), 6).alias("z")))(m.valuation.agg(F.avg("turnover_rate"), F.stddev_pop("turnover_rate")).first()))


def design(m: Panel) -> DataFrame:
    """Label and three imputed, scaled factors of the calibration models."""
    names = ["raw_f47", "raw_f48", "raw_f49"]
    d = m.market.select("security_id", "as_of_date", *names).join(m.labels.select("security_id", "as_of_date", col("excess_20").alias("y")), ["security_id", "as_of_date"]).where("y is not null")
    d = stored(d, "design")
    g = d.agg(*[F.median(c).alias(c) for c in names]).first()
    d = d.fillna({c: float(g[c] or 0.0) for c in names})
    s = d.agg(*[x for c in names for x in (F.avg(c), F.stddev_pop(c))]).first()
    return d.select("security_id", "as_of_date", "y", *[((col(c) - F.lit(s[2 * i])) / F.lit(s[2 * i + 1] or 1.0)).alias(c) for i, c in enumerate(names)])


def assembled(d: DataFrame) -> DataFrame:
    from pyspark.ml.feature import VectorAssembler

    return VectorAssembler(inputCols=["raw_f47", "raw_f48", "raw_f49"], outputCol="features").transform(d)


def linear(d: DataFrame, alpha: float, l1_ratio: float | None = None):
    """Elastic net (or ridge, if no l1_ratio) with the penalty of the usual single-machine parametrisation."""
    from pyspark.ml.regression import LinearRegression

    n, sigma = d.agg(F.count("*"), F.stddev_pop("y")).first()
    if l1_ratio is None:
        reg, mix = alpha * sigma / n, 0.0
    else:
        reg = alpha * (l1_ratio + sigma * (1 - l1_ratio))
        mix = alpha * l1_ratio / reg
    solver = "auto" if l1_ratio else "normal"
    return LinearRegression(labelCol="y", regParam=reg, elasticNetParam=mix, standardization=False, solver=solver).fit(d)


def _coefficients(m: Panel, model) -> DataFrame:
    a, b, c = (float(x) for x in model.coefficients)
    return _one(m, intercept=round(float(model.intercept), 9), f47=round(a, 9), f48=round(b, 9), f49=round(c, 9))


query("c05_elastic_net", None)(lambda m: _coefficients(m, linear(assembled(design(m)), 0.001, 0.25)))
query("c06_ridge", None)(lambda m: _coefficients(m, linear(assembled(design(m)), 1.0)))


@query("c07_boosted_trees", None)
def _(m):
    from pyspark.ml.regression import GBTRegressor

    d = assembled(design(m))
    model = GBTRegressor(labelCol="y", maxDepth=2, stepSize=0.05, maxIter=20, minInstancesPerNode=50, seed=20260827).fit(d)
    return model.transform(d).agg(F.sqrt(F.avg(F.pow(col("prediction") - col("y"), 2))).alias("rmse"), F.count("*").alias("n"))


@query("c08_best_of_family", None)
def _(m):
    """The model with the best rank correlation, then the least error, first of equals."""
    d = assembled(design(m))
    best = None
    for alpha in (1.0, 10.0):
        p = linear(d, alpha).transform(d).select("as_of_date", "y", col("prediction").alias("p"))
        ic = daily_ic(p).agg(F.avg("ic")).first()[0]
        rmse = p.agg(F.sqrt(F.avg(F.pow(col("p") - col("y"), 2)))).first()[0]
        key = (ic if ic is not None else -999.0, -rmse)
        if best is None or key > best[0]:
            best = (key, f"ridge_{alpha:g}")
    return _one(m, model=best[1], ic=round(best[0][0], 6), rmse=round(-best[0][1], 6))


@query("c09_stack_weights", None)
def _(m):
    """Weights of three predictions on a grid of tenths with the best mean rank correlation."""
    d = design(m)
    grid = [(i, j, 10 - i - j) for i in range(11) for j in range(11 - i)]
    weights = F.array(*[F.struct(F.lit(k).alias("k"), *[F.lit(x / 10).alias(n) for x, n in zip(w, ("a", "b", "c"), strict=True)]) for k, w in enumerate(grid)])
    p = d.select("as_of_date", "y", "raw_f47", "raw_f48", "raw_f49", F.explode(weights).alias("w"))
    p = p.select("as_of_date", "y", col("w.k").alias("k"), (col("w.a") * col("raw_f47") + col("w.b") * col("raw_f48") + col("w.c") * col("raw_f49")).alias("p"))
    ranked = p.select("k", "as_of_date", W.rank_share(col("y"), "k", "as_of_date").alias("ry"), W.rank_share(col("p"), "k", "as_of_date").alias("rp"), F.pow(col("y") - col("p"), 2).alias("e"))
    ic = ranked.groupBy("k", "as_of_date").agg(correlation("ry", "rp").alias("ic"), F.count("*").alias("n"), F.sum("e").alias("e"))
    score = ic.groupBy("k").agg(F.avg(F.when(col("n") >= NAMES, col("ic"))).alias("ic"), (-F.sqrt(F.sum("e") / F.sum("n"))).alias("fit"))
    best = score.agg(F.max_by("k", F.struct("ic", "fit", -col("k"))).alias("k"))
    return best.select(F.get(weights, col("k")).alias("w")).select("w.a", "w.b", "w.c")


@query("c10_logistic", None)
def _(m):
    from pyspark.ml.classification import LogisticRegression

    d = assembled(design(m)).withColumn("up", (col("y") > 0).cast("double"))
    model = LogisticRegression(labelCol="up", regParam=1.0 / d.count(), standardization=False).fit(d)
    return _coefficients(m, model)


GATES = [("OOS_RANK_IC", "ic >= 0.015"), ("OOS_ICIR", "icir >= 0.2"), ("MIN_DAYS", "days >= 60")]
select("c18_gates_and_status", "select " + ", ".join(f"{g} as {n.lower()}" for n, g in GATES) + ", case when " + " and ".join(g for _, g in GATES) + f" then 'CALIBRATED_PRODUCTION' else 'VALIDATION_FAILED_NOT_PRODUCTION' end as status from (select avg(ic) as ic, avg(ic) / (stddev_samp(ic) + 1e-12) * sqrt(252) as icir, count(*) as days from {IC}) g",
       lambda m: daily_ic(predicted(m)).agg(F.avg("ic").alias("ic"), (F.avg("ic") / (F.stddev_samp("ic") + 1e-12) * math.sqrt(252)).alias("icir"), F.count("*").alias("days")).select(*[F.expr(g).alias(n.lower()) for n, g in GATES], F.when(F.expr(" and ".join(g for _, g in GATES)), "CALIBRATED_PRODUCTION").otherwise("VALIDATION_FAILED_NOT_PRODUCTION").alias("status")))


def locked(status: DataFrame, audit: DataFrame) -> DataFrame:
    """A calibrated status needs the audit as its second key."""
    keyed = status.withColumn("_k", F.lit(0)).join(audit.withColumn("_k", F.lit(0)), "_k")  # one row each
    blocked = (col("status") == "CALIBRATED_PRODUCTION") & ~col("strict_pit_gate_pass")
    return keyed.select(col("status").alias("pre_h1_status"), F.when(blocked, "BLOCKED_PIT_AUDIT_FAILED").otherwise(col("status")).alias("status"), "strict_pit_gate_pass")


select("c20_two_key_lock", f"select s.status as pre_h1_status, case when s.status = 'CALIBRATED_PRODUCTION' and not a.strict_pit_gate_pass then 'BLOCKED_PIT_AUDIT_FAILED' else s.status end as status, strict_pit_gate_pass from (select 'CALIBRATED_PRODUCTION' as status) s, (select bool_and(passed or not blocking) as strict_pit_gate_pass from ({AUDIT_SQL}) c) a",
       lambda m: locked(m.spark.range(1).select(F.lit("CALIBRATED_PRODUCTION").alias("status")), checks(m).agg(F.bool_and(col("passed") | ~col("blocking")).alias("strict_pit_gate_pass"))))


# ---- walk-forward as a whole ---------------------------------------------------------------------------
#: Least numbers that fit the driver's tables: seven years, few names a date. The defaults of ``Settings`` are the full procedure's.
SMALL = C.Settings(train_years=3, least_rows=(100, 30, 30), least_names=NAMES, least_folds=2, end_share=END_SHARE, features=("raw_f47", "raw_f48", "raw_f49", "raw_f50", "raw_f55"))


def calibration_panel(m: Panel, s: C.Settings) -> DataFrame:
    labels = m.labels.select("security_id", "as_of_date", *[f"excess_{h}" for h in s.horizons], F.greatest(*[f"end_{h}" for h in s.horizons]).alias("label_end"))
    factors = m.market.select("security_id", "as_of_date", *s.features, T.source_available_at("as_of_date").alias("known_at"), T.decision_cutoff("as_of_date").alias("cutoff"))
    return stored(factors.join(labels, ["security_id", "as_of_date"]), "calibration-panel")


def walk_forward(m: Panel, s: C.Settings = SMALL):
    panel = calibration_panel(m, s)
    return panel, *C.out_of_sample(panel, stored(m.calendar, "calendar"), s, stored)


@query("c21_fold_choices", None)
def _(m):
    """The model of each family that validation chose, by fold and horizon."""
    return walk_forward(m)[2].select("test_year", "horizon", "family", "model", R("rmse", 9).alias("rmse"), R("ic", 9).alias("ic"))


@query("c22_stack_weights_by_fold", None)
def _(m):
    return walk_forward(m)[3]


@query("c23_out_of_sample", None)
def _(m):
    """Calibrated predictions of all test years."""
    return walk_forward(m)[1]


@query("c24_metrics", None)
def _(m):
    """Out-of-sample figures by horizon."""
    found = C.metrics(walk_forward(m)[1], SMALL)
    rows = [(h, k, None if v is None else float(v)) for h, x in sorted(found.items()) for k, v in x.items()]
    return m.spark.createDataFrame(rows, "horizon int, metric string, value double")


@query("c25_twelve_gates", None)
def _(m):
    """Every gate and the state they lead to."""
    panel, oos, choice, _ = walk_forward(m)
    pit = panel.agg(C.pit_gate(panel, SMALL)).first()[0]
    passed = C.gates(C.metrics(oos, SMALL), pit, choice.select("test_year").distinct().count(), SMALL)
    return m.spark.createDataFrame([(k, v, C.status(passed)) for k, v in passed.items()], "gate string, passed boolean, status string")
