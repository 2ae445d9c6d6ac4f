"""The walk-forward against plain Python on a small panel."""

import datetime as dt
import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.plans import calibration as C
from tidemark.sources import stored

S = C.Settings(horizons=(2, 3), train_years=1, embargo=3, least_rows=(10, 5, 5), least_names=4, least_folds=1, end_share=0.25, gate_horizons=(2, 3), features=("f1", "f2"), draws=50)
DAYS = [dt.date(y, 1, 1) + dt.timedelta(days=5 * i) for y in (2001, 2002, 2003, 2004) for i in range(40)]


def panel(spark, names=6, seed=2):
    rng = np.random.default_rng(seed)
    rows = []
    for (i, d), k in itertools.product(enumerate(DAYS), range(names)):
        f1, f2 = rng.normal(), rng.normal()
        y = 0.5 * f1 + 0.1 * f2 + 0.3 * rng.normal()
        end = DAYS[i + 3] if i + 3 < len(DAYS) else None
        stamp = end and dt.datetime.combine(end, dt.time(7))
        rows.append((k, d, None if rng.random() < 0.1 else float(f1), float(f2), float(y), float(y / 2) if k else None, stamp, dt.datetime.combine(d, dt.time(7)), dt.datetime.combine(d, dt.time(12))))
    return spark.createDataFrame(rows, "security_id long, as_of_date date, f1 double, f2 double, excess_2 double, excess_3 double, label_end timestamp, known_at timestamp, cutoff timestamp")


def calendar(spark):
    return spark.createDataFrame([(d, i) for i, d in enumerate(DAYS)], "trade_date date, pos int")


def roles(rows):
    """(test_year, role) of every row by the definition."""
    out = []
    years = sorted({d.year for d in DAYS})
    for i in range(S.train_years + 1, len(years)):
        test, valid = years[i], years[i - 1]
        stop = {y: dt.datetime.combine(DAYS[max(0, DAYS.index(min(d for d in DAYS if d.year == y)) - S.embargo)], dt.time()) - dt.timedelta(hours=8) for y in (test, valid)}
        for r in rows:
            y, end = r["as_of_date"].year, r["label_end"]
            if y == test:
                out.append((test, "test", r))
            elif y == valid and end and end < stop[test]:
                out.append((test, "validate", r))
            elif y < valid and end and end < stop[valid]:
                out.append((test, "train", r))
    return out


def test_roles_and_moments(spark):
    d = panel(spark)
    rows = C.by_role(d, calendar(spark), S)
    want = {}
    for year, role, r in roles(d.collect()):
        for h in S.horizons:
            if r[f"excess_{h}"] is not None:
                want[year, h, role] = want.get((year, h, role), 0) + 1
    got = {(r["test_year"], r["horizon"], r["role"]): r["count"] for r in rows.groupBy("test_year", "horizon", "role").count().collect()}
    assert got == want and len({k[0] for k in got}) == 2
    x = C.imputed(rows, S)
    found = C.moments(x, 4)
    own = [r for r in x.where("role = 'train' and test_year = 2003 and horizon = 2").collect()]
    n, mean, c, y, xy, _ = found[2003, 2]
    a, b = np.array([r["x"] for r in own]), np.array([r["y"] for r in own])
    assert n == len(own) and np.allclose(mean, a.mean(0)) and np.allclose(c, np.cov(a.T, bias=True)) and np.isclose(y, b.mean())
    assert np.allclose(xy, ((a - a.mean(0)) * (b - b.mean())[:, None]).mean(0))


def test_linear_solutions_meet_their_conditions():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 4))
    x = (x - x.mean(0)) / x.std(0)
    y = x @ [1.0, 0.0, -0.5, 0.01] + rng.normal(size=300)
    y -= y.mean()
    corr, cov = x.T @ x / 300, x.T @ y / 300
    for alpha, l1 in ((0.05, 0.5), (0.5, 0.9)):
        b = C.elastic_net(corr, cov, alpha, l1)
        slope = cov - corr @ b - alpha * (1 - l1) * b
        for s, v in zip(slope, b, strict=True):
            assert abs(s - alpha * l1 * np.sign(v)) < 1e-9 if v else abs(s) <= alpha * l1 + 1e-9


def test_walk_forward_end_to_end(spark):
    d = panel(spark)
    oos, choice, weights = C.out_of_sample(d, calendar(spark), S, stored)
    assert choice.count() == 2 * 2 * 2 and all(abs(sum(r["weights"]) - 1) < 1e-12 for r in weights.collect())
    rows = oos.collect()
    assert {r["test_year"] for r in rows} == {2003, 2004} and all(0 < r["prob_up"] < 1 for r in rows)
    found = C.metrics(oos, S)
    assert found[2]["rank_ic"] > 0.5 and found[2]["brier_skill"] > 0.2 and found[2]["alpha"] > 0
    mine = [r for r in rows if r["horizon"] == 2]
    assert found[2]["hit_rate"] == pytest.approx(np.mean([np.sign(r["y"]) == np.sign(r["p"]) for r in mine]))
    assert 0.01 < np.mean([r["var_violation"] for r in mine]) < 0.12
    passed = C.gates(found, d.agg(C.pit_gate(d, S)).first()[0], 2, S)
    assert len(passed) == 12 and passed["PIT_CHECK"] and passed["OOS_RANK_IC_60"]


def test_logistic_meets_its_conditions(spark):
    rng = np.random.default_rng(4)
    p = rng.normal(size=200)
    y = np.where(rng.random(200) < 1 / (1 + np.exp(-2 * p)), 1.0, -1.0)
    d = spark.createDataFrame([(2003, 2, float(a), float(b)) for a, b in zip(p, y, strict=True)], "test_year int, horizon int, p double, y double")
    a, b = C.logistic(d)[2003, 2]
    e = 1 / (1 + np.exp(-(a + b * p))) - (y > 0)
    assert abs(e.sum()) < 1e-6 and abs((e * p).sum() + b) < 1e-6


def test_states():
    ok = dict.fromkeys(C.gates({}, True, 9, S), True)
    assert C.status(ok) == "CALIBRATED_PRODUCTION"
    assert C.status(ok | {"VAR_KUPIEC": False}) == "VALIDATION_FAILED_NOT_PRODUCTION"
    assert C.status(ok | {"MIN_TEST_FOLDS": False}) == "BLOCKED_INSUFFICIENT_HISTORY"
    assert C.status(ok | {"PIT_CHECK": False}) == "BLOCKED_PIT_AUDIT_FAILED"
    assert not any(v for k, v in C.gates({}, True, 9, S).items() if k not in ("PIT_CHECK", "MIN_TEST_FOLDS"))


def test_pit_gate_refuses_late_values_and_repeats(spark):
    d = panel(spark)
    gate = lambda x: x.agg(C.pit_gate(x, S)).first()[0]
    assert gate(d) and not gate(d.unionByName(d.limit(1)))
    assert not gate(d.withColumn("known_at", F.col("cutoff") + F.make_dt_interval(mins=F.lit(1))))
    assert not gate(d.withColumn("f1", F.lit(None).cast("double")))


def test_lower_bound_is_below_the_mean():
    x = [math.sin(i) for i in range(200)]
    assert C.lower_bound(x, 200) < np.mean(x) and C.lower_bound(x[:5], 10) is None
