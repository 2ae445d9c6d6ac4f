"""Session defaults and the study window."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import SparkSession


@dataclass(frozen=True)
class StudyWindow:
    """Dates of a study: bars are loaded from a year before ``start`` as warm-up."""

    start: dt.date = dt.date(2018, 1, 1)
    end: dt.date = dt.date(2026, 8, 27)
    calendar_end: dt.date = dt.date(2027, 6, 30)
    start_check_slack_days: int = 9

    @property
    def warmup_start(self) -> dt.date:
        return self.start.replace(year=self.start.year - 1)

    @property
    def latest_acceptable_start(self) -> dt.date:
        return self.start + dt.timedelta(days=self.start_check_slack_days)


def session(app: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the engine relies on: UTC clocks, ANSI, adaptive plans."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
    } | conf
    return builder.config(map=settings).getOrCreate()
