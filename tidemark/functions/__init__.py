"""Column functions with the missing-value rules of panels: bad or empty input gives null, never an error."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ZONE = "Asia/Shanghai"
SOURCE_HOUR, DECISION_HOUR = 15, 20


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_num(c: Column | str) -> Column:
    """Number or null; text that isn't a number, and NaN, are null."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def to_date(c: Column | str) -> Column:
    return col(c).try_cast("date")


def safe_div(a: Column | str, b: Column | str) -> Column:
    """a / b, null where b is null or 0."""
    return F.try_divide(col(a), col(b))


def clip_floor(c: Column | str, least: float) -> Column:
    return F.when(col(c).isNotNull(), F.greatest(col(c), F.lit(least)))


def clip(c: Column | str, lo: Column, hi: Column) -> Column:
    return F.when(col(c).isNotNull(), F.greatest(lo, F.least(hi, col(c))))


def log_positive(c: Column | str) -> Column:
    return F.when(col(c) > 0, F.ln(col(c)))


def at_local_hour(date: Column | str, hour: int) -> Column:
    """The UTC instant of an hour of a local day."""
    return F.to_utc_timestamp(col(date).cast("date").cast("timestamp") + F.make_dt_interval(hours=F.lit(hour)), ZONE)


def source_available_at(date: Column | str) -> Column:
    return at_local_hour(date, SOURCE_HOUR)


def decision_cutoff(date: Column | str) -> Column:
    return at_local_hour(date, DECISION_HOUR)


def next_day_available_at(date: Column | str) -> Column:
    """A disclosure known by its date only becomes usable when the next local day begins."""
    return at_local_hour(F.date_add(col(date).cast("date"), 1), 0)


def median_of(sorted_list: Column) -> Column:
    """Median of a sorted array; null if it is empty."""
    n = F.size(sorted_list)
    return F.when(n > 0, (F.get(sorted_list, ((n - 1) / 2).cast("int")) + F.get(sorted_list, (n / 2).cast("int"))) / 2)


def find_column(df: DataFrame, names: Sequence[str], by_part: bool = False) -> str | None:
    """First of the names that the frame has, in any case; parts of names match on request only."""
    have = {c.lower(): c for c in df.columns}
    for n in names:
        if n.lower() in have:
            return have[n.lower()]
    if by_part:
        return next((c for c in df.columns for n in names if n.lower() in c.lower()), None)
    return None


def vendor_security_id(code: Column | str) -> tuple[Column, Column]:
    """(security id, exchange) of a vendor code such as sh.600000."""
    c = col(code)
    sh, sz = c.startswith("sh."), c.startswith("sz.")
    plain = F.regexp_replace(c, r"^(sh|sz|bj)\.", "")
    return (
        F.concat(plain, F.when(sh, ".SH").when(sz, ".SZ").otherwise(".BJ")),
        F.when(sh, "SSE").when(sz, "SZSE").otherwise("BSE"),
    )
