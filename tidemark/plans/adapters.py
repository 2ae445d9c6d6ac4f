"""The panel's tables, built from the driver's order, lineitem and supplier tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Flow items are cumulative within the year, stock items are balances.
FLOWS = ("revenue", "op_cost", "adj_np", "net_income", "op_profit", "cfo", "capex")
STOCKS = ("ar", "inventory", "assets", "liabilities", "current_assets", "current_liab")


def price() -> Column:
    """A calm price: unit prices vary too much from day to day to compound over years."""
    return 1000 + F.col("l_extendedprice") / F.col("l_quantity") / 20


def money(column: str) -> Column:
    """Sum of an amount in cents, exact whatever the order of rows."""
    return F.sum(F.col(column).cast("decimal(18,2)")).cast("double")


class Tables:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def bars(self) -> DataFrame:
        order = F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice")
        return (
            self.raw("lineitem")
            .groupBy(F.col("l_suppkey").alias("security_id"), F.col("l_shipdate").cast("date").alias("trade_date"))
            .agg(
                F.min_by(price(), order).alias("open"),
                F.max(price()).alias("high"),
                F.min(price()).alias("low"),
                (1000 + money("l_extendedprice") / F.sum("l_quantity") / 20).alias("close"),
                F.sum("l_quantity").alias("volume"),
                money("l_extendedprice").alias("amount"),
            )
        )

    @cached_property
    def calendar(self) -> DataFrame:
        """Sessions and their position; one row per date."""
        return self.bars.select("trade_date").distinct().selectExpr("trade_date", "row_number() over (order by trade_date) - 1 as pos")

    @cached_property
    def actions(self) -> DataFrame:
        return self.raw("lineitem").where("l_returnflag = 'R'").selectExpr(
            "l_suppkey as security_id", "cast(l_shipdate as date) as ex_date", "l_discount as cash_dividend", "l_tax / 10 as bonus_ratio", "l_tax / 40 as transfer_ratio",
            "case when l_linenumber % 3 = 0 then l_tax / 20 else 0.0D end as allotment_ratio", "case when l_linenumber % 2 = 0 then l_extendedprice / l_quantity end as allotment_price",
        )

    @cached_property
    def securities(self) -> DataFrame:
        return self.raw("supplier").selectExpr(
            "s_suppkey as security_id", "concat(element_at(array('sh.', 'sz.', 'bj.'), cast(s_suppkey % 3 as int) + 1), lpad(cast(s_suppkey as string), 6, '0')) as code",
            "case when s_suppkey % 7 = 0 then '2' else '1' end as type", "date_add(date '1992-01-01', cast(s_suppkey % 10 * 90 as int)) as ipo_date",
            "case when s_suppkey % 5 = 0 then date_add(date '1996-06-30', cast(s_suppkey % 100 as int)) end as out_date", "s_nationkey as industry", "s_name",
            "round(s_acctbal, 2) as balance",
        )

    @cached_property
    def valuation(self) -> DataFrame:
        d = "(security_id + day(trade_date))"
        return self.bars.selectExpr(
            "security_id", "trade_date", f"case when {d} % 17 = 0 then null when {d} % 19 = 0 then -1.0D else close * (1 + security_id % 7) end as float_mv",
            f"case when {d} % 23 = 0 then null else close * (2 + security_id % 9) end as total_mv",
            f"case when {d} % 11 = 0 then -5.0D when {d} % 13 = 0 then 0.0D else close / 100 end as pe_ttm", f"case when {d} % 29 = 0 then null else close / 500 end as pb",
            "volume / 1000 as turnover_rate",
        )

    @cached_property
    def membership(self) -> DataFrame:
        """Industry changes: a security's nation, then its region for a while from 1995 on."""
        s = self.raw("supplier").join(F.broadcast(self.raw("nation")), F.col("s_nationkey") == F.col("n_nationkey"))  # nation has 25 rows
        rows = F.array(
            F.struct(F.lit("1992-01-01").cast("date").alias("effective_from"), F.concat(F.lit("R"), "n_regionkey").alias("industry_code")),
            F.struct(F.lit("1995-06-01").cast("date").alias("effective_from"), F.concat(F.lit("S"), F.col("s_suppkey") % 4).alias("industry_code")),
        )
        return s.select(F.col("s_suppkey").alias("security_id"), F.inline(rows))

    @cached_property
    def n_securities(self) -> int:
        return self.raw("supplier").count()

    @cached_property
    def statements(self) -> DataFrame:
        """One row per security and quarter, all items as columns; flows are cumulative within the year."""
        n = self.n_securities
        urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice")).otherwise(0.0).cast("decimal(18,2)")
        q = (
            self.raw("orders")
            .groupBy((F.col("o_custkey") % n + 1).alias("security_id"), F.year("o_orderdate").alias("year"), F.quarter("o_orderdate").alias("quarter"))
            .agg(money("o_totalprice").alias("sales"), F.count("*").alias("orders"), F.sum(urgent).cast("double").alias("urgent"))
        )
        ytd, all_ = "over (partition by security_id, year order by quarter)", "over (partition by security_id order by year, quarter)"
        return q.selectExpr(
            "security_id", "last_day(make_date(year, quarter * 3, 1)) as report_period", "date_add(last_day(make_date(year, quarter * 3, 1)), cast(30 + security_id % 25 as int)) as available_at",
            f"sum(sales) {ytd} as revenue", f"0.6D * sum(sales) {ytd} + 100 * sum(orders) {ytd} as op_cost", f"0.2D * sum(urgent) {ytd} - 50 as adj_np",
            f"0.15D * sum(sales) {ytd} - 30 * sum(orders) {ytd} as net_income", f"0.25D * sum(sales) {ytd} as op_profit", f"0.18D * sum(sales) {ytd} - 0.1D * sum(urgent) {ytd} as cfo",
            f"0.05D * sum(sales) {ytd} as capex", "0.2D * sales as ar", "0.3D * sales + 10 * orders as inventory", f"3 * sum(sales) {all_} as assets",
            f"1.4D * sum(sales) {all_} + 0.1D * sales as liabilities", "0.5D * sales + 10 * orders + 100 as current_assets", "0.4D * sales + 1 as current_liab",
        )

    @cached_property
    def items(self) -> DataFrame:
        """Statements as a long table of items."""
        long = self.statements.unpivot(["security_id", "report_period", "available_at"], [*FLOWS, *STOCKS], "item", "value")
        return long.withColumn("statement_type", F.when(F.col("item").isin(*FLOWS), "flow").otherwise("stock"))

    @cached_property
    def supply(self) -> DataFrame:
        """Supply events: large open orders as quantities to come."""
        n = self.n_securities
        return self.raw("orders").where("o_orderstatus = 'O'").select((F.col("o_custkey") % n + 1).alias("security_id"), F.col("o_orderdate").cast("date").alias("event_date"), F.floor(F.abs("o_totalprice")).cast("double").alias("qty"))

    @cached_property
    def regulatory(self) -> DataFrame:
        n = self.n_securities
        return self.raw("orders").where("o_orderpriority = '1-URGENT'").select((F.col("o_custkey") % n + 1).alias("security_id"), F.col("o_orderdate").cast("date").alias("event_date"))

    @cached_property
    def schedule(self) -> DataFrame:
        return self.statements.select("security_id", F.col("available_at").alias("event_date"))

    @cached_property
    def margin(self) -> DataFrame:
        return self.bars.selectExpr("security_id", "trade_date", "case when (security_id + day(trade_date)) % 5 = 0 then null else amount / 10 end as balance")

    @cached_property
    def macro(self) -> DataFrame:
        """Monthly series by order priority, named like macro indicators."""
        name = "element_at(map('1-URGENT', 'gdp growth', '2-HIGH', 'M2 credit', '3-MEDIUM', 'LPR 1y', '4-NOT SPECIFIED', 'fiscal outlays', '5-LOW', 'retail credit'), o_orderpriority)"
        return self.raw("orders").groupBy(F.expr(f"lower({name})").alias("series"), F.expr("last_day(cast(o_orderdate as date))").alias("release_date")).agg((money("o_totalprice") / 1000).alias("value"))

    @cached_property
    def announcements(self) -> DataFrame:
        """Documents as announcements, their whole texts as titles."""
        return self.raw("documents").selectExpr(
            "doc_id as announcement_id", "text as title", "date_add(date '2019-01-01', cast(doc_id % 700 as int)) as announce_date", "source"
        )

    @cached_property
    def adj_factors(self) -> DataFrame:
        return self.actions.selectExpr("security_id", "ex_date", "1 + bonus_ratio + transfer_ratio as factor")

    @cached_property
    def trading_status(self) -> DataFrame:
        return self.bars.selectExpr("security_id", "trade_date", "volume > 0 as trades")

    def holds(self, path: str) -> DataFrame:
        """One row, value 1 if the lake has a file or folder of that name, else 0."""
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.sf_dir}/{path}")
        there = at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at)
        return self.spark.range(1).select(F.lit(int(there)).cast("long").alias("value"))

    @cached_property
    def delisted(self) -> DataFrame:
        return self.securities.where("out_date is not null").select("security_id", "out_date")
