"""DuckDB equivalents of the panel's tables, as named common table expressions."""

from __future__ import annotations

import re

YTD = "over (partition by security_id, year order by quarter)"
EVER = "over (partition by security_id order by year, quarter)"
DAY = "(security_id + day(trade_date))"
OWN = "partition by security_id order by trade_date"
PANEL = "partition by security_id order by as_of_date"


def roll(agg: str, x: str, n: int, least: int, order: str = OWN) -> str:
    frame = f"over ({order} rows between {n - 1} preceding and current row)"
    return f"case when count({x}) {frame} >= {least} then {agg}({x}) {frame} end"


def div(a: str, b: str) -> str:
    return f"(({a}) / nullif({b}, 0))"


CTE: dict[str, str] = {
    "bars": """select l_suppkey as security_id, cast(l_shipdate as date) as trade_date,
        first(1000 + l_extendedprice / l_quantity / 20 order by l_orderkey, l_linenumber, l_partkey, l_extendedprice) as open,
        max(1000 + l_extendedprice / l_quantity / 20) as high, min(1000 + l_extendedprice / l_quantity / 20) as low, 1000 + cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) / sum(l_quantity) / 20 as close,
        sum(l_quantity) as volume, cast(sum(cast(l_extendedprice as decimal(18, 2))) as double) as amount from lineitem group by 1, 2""",
    "calendar": "select trade_date, row_number() over (order by trade_date) - 1 as pos from (select distinct trade_date from bars)",
    "actions": """select l_suppkey as security_id, cast(l_shipdate as date) as ex_date, l_discount as cash_dividend, l_tax / 10 as bonus_ratio, l_tax / 40 as transfer_ratio,
        case when l_linenumber % 3 = 0 then l_tax / 20 else 0.0 end as allotment_ratio, case when l_linenumber % 2 = 0 then l_extendedprice / l_quantity end as allotment_price
        from lineitem where l_returnflag = 'R'""",
    "securities": """select s_suppkey as security_id, ['sh.', 'sz.', 'bj.'][s_suppkey % 3 + 1] || lpad(cast(s_suppkey as varchar), 6, '0') as code,
        case when s_suppkey % 7 = 0 then '2' else '1' end as type, date '1992-01-01' + cast(s_suppkey % 10 * 90 as int) as ipo_date,
        case when s_suppkey % 5 = 0 then date '1996-06-30' + cast(s_suppkey % 100 as int) end as out_date, s_nationkey as industry, s_name, round(s_acctbal, 2) as balance from supplier""",
    "valuation": f"""select security_id, trade_date, case when {DAY} % 17 = 0 then null when {DAY} % 19 = 0 then -1.0 else close * (1 + security_id % 7) end as float_mv,
        case when {DAY} % 23 = 0 then null else close * (2 + security_id % 9) end as total_mv,
        case when {DAY} % 11 = 0 then -5.0 when {DAY} % 13 = 0 then 0.0 else close / 100 end as pe_ttm, case when {DAY} % 29 = 0 then null else close / 500 end as pb,
        volume / 1000 as turnover_rate from bars""",
    "membership": """select s_suppkey as security_id, date '1992-01-01' as effective_from, 'R' || n_regionkey as industry_code from supplier join nation on s_nationkey = n_nationkey
        union all select s_suppkey, date '1995-06-01', 'S' || (s_suppkey % 4) from supplier join nation on s_nationkey = n_nationkey""",
    "quarters": """select o_custkey % (select count(*) from supplier) + 1 as security_id, year(o_orderdate) as year, quarter(o_orderdate) as quarter, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) as sales,
        count(*) as orders, cast(sum(cast(case when o_orderpriority = '1-URGENT' then o_totalprice else 0.0 end as decimal(18, 2))) as double) as urgent from orders group by 1, 2, 3""",
    "statements": f"""select security_id, last_day(make_date(year, quarter * 3, 1)) as report_period, last_day(make_date(year, quarter * 3, 1)) + cast(30 + security_id % 25 as int) as available_at,
        sum(sales) {YTD} as revenue, 0.6 * sum(sales) {YTD} + 100 * sum(orders) {YTD} as op_cost, 0.2 * sum(urgent) {YTD} - 50 as adj_np,
        0.15 * sum(sales) {YTD} - 30 * sum(orders) {YTD} as net_income, 0.25 * sum(sales) {YTD} as op_profit, 0.18 * sum(sales) {YTD} - 0.1 * sum(urgent) {YTD} as cfo,
        0.05 * sum(sales) {YTD} as capex, 0.2 * sales as ar, 0.3 * sales + 10 * orders as inventory, 3 * sum(sales) {EVER} as assets,
        1.4 * sum(sales) {EVER} + 0.1 * sales as liabilities, 0.5 * sales + 10 * orders + 100 as current_assets, 0.4 * sales + 1 as current_liab from quarters""",
    "supply": "select o_custkey % (select count(*) from supplier) + 1 as security_id, cast(o_orderdate as date) as event_date, floor(abs(o_totalprice)) as qty from orders where o_orderstatus = 'O'",
    "regulatory": "select o_custkey % (select count(*) from supplier) + 1 as security_id, cast(o_orderdate as date) as event_date from orders where o_orderpriority = '1-URGENT'",
    "schedule": "select security_id, available_at as event_date from statements",
    "margin": "select security_id, trade_date, case when (security_id + day(trade_date)) % 5 = 0 then null else amount / 10 end as balance from bars",
    "macro": """select lower(case o_orderpriority when '1-URGENT' then 'gdp growth' when '2-HIGH' then 'M2 credit' when '3-MEDIUM' then 'LPR 1y' when '4-NOT SPECIFIED' then 'fiscal outlays' else 'retail credit' end) as series,
        last_day(cast(o_orderdate as date)) as release_date, cast(sum(cast(o_totalprice as decimal(18, 2))) as double) / 1000 as value from orders group by 1, 2""",
    "announcements": """select doc_id as announcement_id, text as title, date '2019-01-01' + cast(doc_id % 700 as int) as announce_date, source from documents""",
    "adj_factors": "select security_id, ex_date, 1 + bonus_ratio + transfer_ratio as factor from actions",
    "trading_status": "select security_id, trade_date, volume > 0 as trades from bars",
    "delisted": "select security_id, out_date from securities where out_date is not null",
    "summed": """select security_id, ex_date as trade_date, coalesce(sum(cash_dividend), 0) as cash_dividend, coalesce(sum(bonus_ratio), 0) as bonus_ratio, coalesce(sum(transfer_ratio), 0) as transfer_ratio,
        coalesce(sum(allotment_ratio), 0) as allotment_ratio, case when sum(allotment_ratio) > 0 then sum(allotment_ratio * coalesce(allotment_price, 0)) / sum(allotment_ratio) end as allotment_price
        from actions group by 1, 2""",
    "moves": f"""select b.*, coalesce(a.cash_dividend, 0) as cash_dividend, coalesce(bonus_ratio, 0) as bonus_ratio, coalesce(transfer_ratio, 0) as transfer_ratio, coalesce(allotment_ratio, 0) as allotment_ratio,
        allotment_price, lag(close) over (partition by b.security_id order by b.trade_date) as prev_close from bars b left join summed a on a.security_id = b.security_id and a.trade_date = b.trade_date""",
    "returns0": """select *, case when prev_close > 0 then (close * (1 + bonus_ratio + transfer_ratio + allotment_ratio) + cash_dividend - allotment_ratio * coalesce(allotment_price, 0)) / prev_close - 1 end as ret from moves""",
    "returns": f"select *, product(1 + greatest(coalesce(ret, 0), -0.999999)) over ({OWN} rows between unbounded preceding and current row) as tri from returns0",
    "eligible": """select * from (select r.security_id, r.trade_date, ret, lag(float_mv) over w as fw, lag(total_mv) over w as cw, lag(ret) over w as before from returns r
        left join valuation v on v.security_id = r.security_id and v.trade_date = r.trade_date window w as (partition by r.security_id order by r.trade_date)) where before is not null and ret is not null""",
    "bench0": """select trade_date, avg(ret) as ew, sum(case when fw > 0 then ret * fw end) / sum(case when fw > 0 then fw end) as ffm,
        sum(case when cw > 0 then ret * cw end) / sum(case when cw > 0 then cw end) as cap, count(*) as names from eligible group by 1""",
    "bench": "select *, " + ", ".join(f"product(1 + greatest(coalesce({c}, 0), -0.999999)) over (order by trade_date rows between unbounded preceding and current row) as {c}_tri" for c in ("ew", "ffm", "cap")) + " from bench0",
    "labels": " ".join(
        ["select t.security_id, t.trade_date as as_of_date,", ", ".join(f"round(e{h}.tri / t.tri - f{h}.ffm_tri / b.ffm_tri, 6) as excess_{h}, case when e{h}.tri is not null and f{h}.ffm_tri is not null then c{h}.trade_date + interval 7 hour end as end_{h}" for h in (20, 60, 120)),
         "from returns t join calendar c using (trade_date) join bench b using (trade_date)"]
        + [f"left join calendar c{h} on c{h}.pos = c.pos + {h} left join returns e{h} on e{h}.security_id = t.security_id and e{h}.trade_date = c{h}.trade_date left join bench f{h} on f{h}.trade_date = c{h}.trade_date" for h in (20, 60, 120)]
        + ["where t.tri > 0 and (" + " or ".join(f"(e{h}.tri is not null and f{h}.ffm_tri is not null)" for h in (20, 60, 120)) + ")"]
    ),
    "one_day": f"select *, tri / lag(tri) over ({OWN}) - 1 as r1 from returns",
    "technical": f"""select security_id, trade_date, close, amount, tri, r1, tri / nullif(lag(tri, 60) over ({OWN}), 0) - 1 as ret60, lag(tri, 21) over ({OWN}) / nullif(lag(tri, 126) over ({OWN}), 0) - 1 as mom,
        {roll("max", "close", 252, 120)} as high252, {roll("avg", "close", 20, 10)} as ma20, {roll("avg", "close", 60, 30)} as ma60, {roll("avg", "close", 120, 60)} as ma120,
        {roll("avg", "volume", 20, 10)} as vol20, {roll("avg", "volume", 120, 60)} as vol120, {roll("stddev_samp", "(case when r1 < 0 then r1 else 0 end)", 20, 10)} as down20,
        {roll("avg", "(case when coalesce(amount, 0) <= 0 then 1.0 else 0.0 end)", 20, 10)} as zero20, {roll("avg", "(abs(r1) / nullif(amount, 0))", 20, 10)} as amihud20 from one_day""",
    "dates": f"""select d.trade_date, d.ffm_tri / lag(d.ffm_tri, 120) over (order by d.trade_date) - 1 as raw_f12, b.breadth as raw_f13, l.liq as raw_f15 from bench d
        left join (select trade_date, avg(case when close > ma120 then 1.0 else 0.0 end) as breadth from technical group by 1) b using (trade_date)
        left join (select trade_date, {roll("avg", "amt", 20, 10, "order by trade_date")} / ({roll("median", "amt", 120, 60, "order by trade_date")}) - 1 as liq from (select trade_date, sum(amount) as amt from bars group by 1)) l using (trade_date)""",
    "market": """select t.security_id, t.trade_date as as_of_date, mom as raw_f47, close / high252 - 1 as raw_f48, close / ma20 - 1 + ma20 / ma60 - 1 + ma60 / ma120 - 1 as raw_f49, ret60 * vol20 / nullif(vol120, 0) as raw_f50,
        down20 + zero20 + case when amihud20 is not null then (rank() over (partition by t.trade_date order by round(amihud20, 15) nulls last) + (count(*) over (partition by t.trade_date, round(amihud20, 15)) - 1) / 2.0)
        / count(amihud20) over (partition by t.trade_date) end as raw_f55, raw_f12, raw_f13, raw_f15 from technical t left join dates d on d.trade_date = t.trade_date""",
}
FLOW = ("revenue", "op_cost", "adj_np", "net_income", "op_profit", "cfo", "capex")
STOCK = ("ar", "inventory", "assets", "liabilities", "current_assets", "current_liab")
REPORT = "partition by security_id order by report_period"
LAGGED = [f"{c}_ttm" for c in FLOW] + list(STOCK)
CTE["items"] = "select security_id, report_period, available_at, item, value, case when item in (" + ", ".join(f"'{c}'" for c in FLOW) + ") then 'flow' else 'stock' end as statement_type from (unpivot statements on " + ", ".join(FLOW + STOCK) + " into name item value value)"
CTE["single"] = "select *, " + ", ".join(
    f"case when quarter(report_period) = 1 or lag({c}) over y is null then {c} else {c} - lag({c}) over y end as {c}_q" for c in FLOW
) + " from statements window y as (partition by security_id, year(report_period) order by report_period)"
CTE["ttm"] = "select *, " + ", ".join(roll("sum", f"{c}_q", 4, 4, REPORT) + f" as {c}_ttm" for c in FLOW) + " from single"
CTE["lagged"] = "select *, " + ", ".join(f"lag({c}, {k}) over r as {c}_lag{k}" for c in LAGGED for k in (1, 4, 5)) + f" from ttm window r as ({REPORT})"
_prior = "list({c}) filter ({c} is not null) over (" + REPORT + " rows between unbounded preceding and 1 preceding)"
CTE["history"] = "select *, " + ", ".join(f"coalesce({_prior.format(c=c)}, []) as h_{c}" for c in ("adj_np_ttm", "revenue_ttm")) + " from lagged"


def _models(c: str) -> str:
    h = f"h_{c}"
    return (f"list_filter([{h}[-1], case when len({h}) >= 2 then coalesce({h}[-1] * ({h}[-1] / nullif({h}[-2], 0)), {h}[-1]) end, "
            f"case when len({h}) >= 4 then -0.5 * {h}[-4] + 0.5 * {h}[-2] + {h}[-1] end], lambda x: x is not null)")


CTE["models"] = "select *, " + ", ".join(f"{_models(c)} as m_{c}" for c in ("adj_np_ttm", "revenue_ttm")) + " from history"
CTE["forecast0"] = "select *, " + ", ".join(f"list_median(m_{c}) as pre_{c}, case when len(m_{c}) >= 2 then list_stddev_pop(m_{c}) end as disp_{c}, abs({c} - list_median(m_{c})) as err_{c}" for c in ("adj_np_ttm", "revenue_ttm")) + " from models"
CTE["forecast1"] = "select *, " + ", ".join(f"lag(err_{c}) over ({REPORT}) as e1_{c}" for c in ("adj_np_ttm", "revenue_ttm")) + " from forecast0"
CTE["forecast"] = "select *, " + ", ".join(f"1.4826 * {roll('median', f'e1_{c}', 8, 3, REPORT)} as scale_{c}" for c in ("adj_np_ttm", "revenue_ttm")) + " from forecast1"
CTE["in_industry"] = "select m.*, i.industry_code as industry from market m asof left join membership i on i.security_id = m.security_id and i.effective_from <= m.as_of_date"
CTE["with_reports"] = "select m.*, f.* exclude (security_id) from in_industry m asof left join forecast f on f.security_id = m.security_id and f.available_at <= m.as_of_date"
CTE["valued0"] = "select w.*, v.float_mv, v.total_mv, v.pe_ttm, v.pb, v.turnover_rate, (case when pe_ttm > 0 then ln(pe_ttm) end + case when pb > 0 then ln(pb) end) / 2 as combo from with_reports w left join valuation v on v.security_id = w.security_id and v.trade_date = w.as_of_date"


def _growth(c: str) -> str:
    return f"({div(c, c + '_lag4')} - 1)"


CTE["valued"] = f"""select *, {div("pre_adj_np_ttm", "total_mv")} as mey, {div("disp_adj_np_ttm", "total_mv")} as mdisp, {_growth("revenue_ttm")} - ({div("revenue_ttm_lag1", "revenue_ttm_lag5")} - 1) as raw_f24 from valued0"""
CTE["machine"] = f"""select *, mey - lag(mey, 21) over ({PANEL}) as raw_f34, mey - lag(mey, 63) over ({PANEL}) as raw_f35, -(mdisp - lag(mdisp, 63) over ({PANEL})) as raw_f40,
    case when industry is not null then {div("revenue_ttm", "sum(revenue_ttm) over (partition by as_of_date, industry)")} end as share,
    last_value(balance ignore nulls) over ({PANEL} rows between unbounded preceding and current row) as bal from (select v.*, m.balance from valued v left join margin m on m.security_id = v.security_id and m.trade_date = v.as_of_date)"""
_less = "list(combo) filter (combo is not null) over (" + PANEL + " rows between 755 preceding and current row)"
CTE["raw"] = f"""select *, {_growth("adj_np_ttm")} - ({div("adj_np_ttm_lag1", "adj_np_ttm_lag5")} - 1) as raw_f25,
    (1 - {div("op_cost_ttm", "revenue_ttm")}) - (1 - {div("op_cost_ttm_lag1", "revenue_ttm_lag1")}) as raw_f26, {div("op_profit_ttm", "assets")} as raw_f27,
    {div("op_profit_ttm", "assets")} - {div("op_profit_ttm_lag1", "assets_lag1")} as raw_f28, {div("cfo_ttm", "abs(net_income_ttm)")} as raw_f29, {div("net_income_ttm - cfo_ttm", "assets")} as raw_f30,
    {_growth("ar")} - {_growth("revenue_ttm")} as raw_f31, {_growth("inventory")} - {_growth("revenue_ttm")} as raw_f32, {div("liabilities", "assets")} + {div("current_liab", "current_assets")} as raw_f33,
    sign(coalesce(raw_f34, 0)) as raw_f36, case when industry is not null then avg(sign(coalesce(raw_f34, 0))) over (partition by as_of_date, industry) end as raw_f22,
    {div("adj_np_ttm - pre_adj_np_ttm", "scale_adj_np_ttm")} as raw_f37, {div("revenue_ttm - pre_revenue_ttm", "scale_revenue_ttm")} as raw_f38, -combo as raw_f41,
    {div("cfo_ttm - capex_ttm", "total_mv")} as raw_f43, {div(_growth("adj_np_ttm"), "abs(pe_ttm)")} as raw_f44, raw_f35 - raw_f47 as raw_f45,
    case when industry is not null then median(raw_f24) over (partition by as_of_date, industry) end as raw_f18, {div("inventory", "revenue_ttm")} as raw_f20, raw_f24 - {_growth("inventory")} as raw_f21,
    share - lag(share, 252) over ({PANEL}) as raw_f23, bal / nullif(lag(bal, 20) over ({PANEL}), 0) - 1 as raw_f51,
    ({roll("avg", "turnover_rate", 20, 10, PANEL)}) + coalesce(bal / nullif(lag(bal, 20) over ({PANEL}), 0) - 1, 0) as raw_f46 from machine"""
CTE["ranked"] = f"select security_id, as_of_date, combo, {_less} as h from valued0"
CTE["f42"] = "select security_id, as_of_date, case when combo is not null and len(h) >= 126 then -(len(list_filter(h, lambda x: x < combo)) + (len(list_filter(h, lambda x: x = combo)) + 1) / 2.0) / len(h) end as raw_f42 from ranked"
for _f, _t, _lo, _hi, _v in (("f53", "supply", 1, 180, "qty"), ("f54", "regulatory", -179, 0, "1.0"), ("f52", "schedule", 1, 90, "1.0")):
    CTE[_f] = (f"select m.security_id, m.as_of_date, coalesce(sum(case when e.event_date is not null then {_v} end), 0.0) as raw_{_f} from market m left join {_t} e on e.security_id = m.security_id "
               f"and e.event_date between m.as_of_date + {_lo} and m.as_of_date + {_hi} group by 1, 2").replace("+ -", "- ")
_in_order = "order by release_date"
_GROUPS = {"f06": ("gdp", "pmi", "industrial", "retail"), "f07": ("tsf", "social financing", "m2", "credit"), "f08": ("lpr", "repo", "dr007", "yield"), "f09": ("fiscal", "government expenditure", "财政支出")}
CTE["macro_daily"] = " union all ".join(f"select '{f}' as factor, release_date, avg(value) as v from macro where " + " or ".join(f"contains(series, '{w}')" for w in words) + " group by 2" for f, words in _GROUPS.items())
CTE["macro_moves"] = "select factor, release_date, case when factor = 'f08' then -(v - lag(v, 3) over w) else v / nullif(lag(v, 3) over w, 0) - 1 end as move from macro_daily window w as (partition by factor order by release_date)"
CTE["macro_asof"] = "select d.trade_date as as_of_date, " + ", ".join(f"{f}.move as raw_{f}" for f in ("f06", "f07", "f08", "f09")) + " from (select trade_date from calendar) d " + " ".join(
    f"asof left join (select * from macro_moves where factor = '{f}') {f} on {f}.release_date <= d.trade_date" for f in ("f06", "f07", "f08", "f09"))
CTE["f14"] = "select trade_date as as_of_date, median(1 / nullif(pe_ttm, 0)) as raw_f14 from valuation group by 1"
CTE["f16"] = """select as_of_date, median(case when total_mv <= mid then raw_f47 end) - median(case when total_mv > mid then raw_f47 end) as raw_f16 from
    (select *, median(total_mv) over (partition by as_of_date) as mid, count(*) over (partition by as_of_date) as n from raw where total_mv is not null and raw_f47 is not null) where n >= 20 group by 1"""


def sql(body: str) -> str:
    """A query with the common table expressions it needs, in order."""
    order: list[str] = []

    def need(text: str, own: str = "") -> None:
        for name in CTE:
            if name != own and name not in order and re.search(rf"\b{name}\b(?!\s*\()", _tables(text)):
                need(CTE[name], name)
                order.append(name)

    need(body)
    if not order:
        return body
    head = ", ".join(f"{n} as materialized ({CTE[n]})" for n in order)
    return f"with {head}, {body[5:]}" if body.startswith("with ") else f"with {head} {body}"


def _tables(text: str) -> str:
    """What stands after from or join."""
    return " ".join(re.findall(r"\b(?:from|join)\s+\(?\s*(\w+)", text))
