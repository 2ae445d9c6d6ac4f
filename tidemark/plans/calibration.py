"""Walk-forward calibration: folds by year, linear families, stacking, calibrated outputs, gates.

All folds and horizons go through Spark together, keyed by (test_year, horizon): one pass gives the
medians, one the moment matrices from which every candidate of a family is solved on the driver (a
few numbers per fold), one the validation scores of all candidates, and so on.  Nothing of the size of
the panel reaches the driver.  Boosted trees need a fit per fold and horizon; they take part where
``Settings.trees`` names how many.
"""

from __future__ import annotations

import itertools
import math
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators import stats
from tidemark.operators import windows as W

KEY = ("test_year", "horizon")
SEED = 20260827


@dataclass(frozen=True)
class Settings:
    """Fixed values of the procedure; the least numbers follow the size of the data at hand."""

    horizons: tuple[int, ...] = (20, 60, 120)
    train_years: int = 6
    embargo: int = 20
    least_rows: tuple[int, int, int] = (1000, 200, 200)  # train, validate, test
    least_names: int = 30
    least_folds: int = 5
    end_share: float = 0.1
    cost: float = 0.002
    var_share: float = 0.05
    most_missing: float = 0.25
    elastic_net: tuple[tuple[float, float], ...] = ((0.001, 0.25), (0.001, 0.75), (0.01, 0.25), (0.01, 0.75))
    ridge: tuple[float, ...] = (1.0, 10.0)
    trees: int = 0
    tree_grid: tuple[tuple[int, float], ...] = ((2, 0.03), (2, 0.05), (3, 0.03), (3, 0.05))
    gate_horizons: tuple[int, int] = (60, 120)
    draws: int = 1000
    features: tuple[str, ...] = field(default=())


# ---- folds -----------------------------------------------------------------------------------------


def by_role(panel: DataFrame, calendar: DataFrame, s: Settings) -> DataFrame:
    """Rows of every fold and horizon with their role; train and validation labels end before the embargo of the next role."""
    year = F.year("trade_date")
    starts = calendar.groupBy(year.alias("year")).agg(F.min("pos").alias("first"), F.row_number().over(Window.orderBy(year)).alias("i"))
    at = calendar.select((F.col("pos") + s.embargo).alias("first"), F.col("trade_date").alias("stop"))
    stop = starts.join(at, "first", "left").select("year", "i", (F.col("stop").cast("timestamp") - F.make_dt_interval(hours=F.lit(8))).alias("stop"))
    test = stop.where(F.col("i") > s.train_years + 1).select(F.col("year").alias("test_year"), F.col("i").alias("ti"), F.col("stop").alias("test_stop"))
    valid = stop.select((F.col("i") + 1).alias("ti"), F.col("year").alias("valid_year"), F.col("stop").alias("valid_stop"))
    folds = F.broadcast(test.join(valid, "ti").drop("ti"))  # one row per year
    y, end = F.year("as_of_date"), F.col("label_end")
    role = (
        F.when(y == F.col("test_year"), "test")
        .when((y == F.col("valid_year")) & (end < F.col("test_stop")), "validate")
        .when((y < F.col("valid_year")) & (end < F.col("valid_stop")), "train")
    )
    wide = panel.join(folds, y <= F.col("test_year")).withColumn("role", role).where("role is not null")
    ys = F.array(*[F.struct(F.lit(h).alias("horizon"), F.col(f"excess_{h}").alias("y")) for h in s.horizons])
    long = wide.select("security_id", "as_of_date", "test_year", "role", F.inline(ys), *s.features).where("y is not null")
    counts = long.groupBy(*KEY).agg(*[F.count_if(F.col("role") == r).alias(r) for r in ("train", "validate", "test")])
    enough = counts.where((F.col("train") >= s.least_rows[0]) & (F.col("validate") >= s.least_rows[1]) & (F.col("test") >= s.least_rows[2])).select(*KEY)
    return long.join(F.broadcast(enough), list(KEY), "left_semi")  # one row per fold and horizon


# ---- linear families from moments --------------------------------------------------------------------


def imputed(rows: DataFrame, s: Settings) -> DataFrame:
    """x: factors with the training median for missing values, then marks of what was missing."""
    train = rows.where("role = 'train'").groupBy(*KEY).agg(*[F.coalesce(F.median(c), F.lit(0.0)).alias(f"m_{c}") for c in s.features])
    d = rows.join(F.broadcast(train), list(KEY))  # one row per fold and horizon
    x = [F.coalesce(c, f"m_{c}") for c in s.features] + [F.col(c).isNull().cast("double") for c in s.features]
    return d.select("security_id", "as_of_date", *KEY, "role", "y", F.array(*x).alias("x"))


def moments(rows: DataFrame, p: int) -> dict[tuple[int, int], tuple[float, np.ndarray, np.ndarray, float, np.ndarray, float]]:
    """Per fold and horizon: n, means of x, covariance of x, mean of y, covariance of x and y, deviation of y."""
    x = [F.col("x")[i] for i in range(p)]
    pairs = list(itertools.combinations_with_replacement(range(p), 2))
    sums = [F.count("*").alias("n"), F.avg("y").alias("y"), F.var_pop("y").alias("yy")]
    sums += [F.avg(c).alias(f"x{i}") for i, c in enumerate(x)] + [F.covar_pop(c, F.col("y")).alias(f"y{i}") for i, c in enumerate(x)]
    sums += [F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i, j in pairs]
    out = {}
    for r in rows.where("role = 'train'").groupBy(*KEY).agg(*sums).collect():  # one row per fold and horizon
        c = np.zeros((p, p))
        for i, j in pairs:
            c[i, j] = c[j, i] = r[f"c{i}_{j}"]
        out[r["test_year"], r["horizon"]] = (r["n"], np.array([r[f"x{i}"] for i in range(p)]), c, r["y"], np.array([r[f"y{i}"] for i in range(p)]), r["yy"])
    return out


def elastic_net(corr: np.ndarray, cov: np.ndarray, alpha: float, l1: float, rounds: int = 8000) -> np.ndarray:
    """Minimiser of half the mean squared error plus the penalty, by coordinates, for scaled features."""
    b = np.zeros(len(cov))
    for _ in range(rounds):
        before = b.copy()
        for j in range(len(b)):
            if corr[j, j] > 0:
                g = cov[j] - corr[j] @ b + corr[j, j] * b[j]
                b[j] = np.sign(g) * max(abs(g) - alpha * l1, 0.0) / (corr[j, j] + alpha * (1 - l1))
        if np.abs(b - before).max(initial=0) < 1e-12:
            break
    return b


def solved(found: dict, s: Settings) -> list[tuple]:
    """(test_year, horizon, family, model, intercept, weights) of every candidate."""
    out = []
    for (year, horizon), (n, mean, c, y, xy, _) in sorted(found.items()):
        scale = np.sqrt(np.diag(c))
        scale[scale == 0] = 1.0
        corr, cov = c / np.outer(scale, scale), xy / scale
        fits = [("ELASTIC_NET", f"en_{a:g}_{l:g}", elastic_net(corr, cov, a, l)) for a, l in s.elastic_net]
        fits += [("RIDGE", f"ridge_{a:g}", np.linalg.solve(corr + a / n * np.eye(len(cov)), cov)) for a in s.ridge]
        for family, model, b in fits:
            weights = b / scale
            out.append((year, horizon, family, model, float(y - weights @ mean), [float(w) for w in weights]))
    return out


def predictions(rows: DataFrame, fits: list[tuple]) -> DataFrame:
    """Predictions of the linear candidates outside training, one row per candidate."""
    models = rows.sparkSession.createDataFrame(fits, "test_year int, horizon int, family string, model string, intercept double, weights array<double>")
    products = F.zip_with("x", "weights", lambda a, b: a * b)
    p = F.col("intercept") + F.aggregate(products, F.lit(0.0), lambda acc, v: acc + v)
    out = rows.where("role <> 'train'").join(F.broadcast(models), list(KEY))  # a few rows per fold and horizon
    return out.select("security_id", "as_of_date", *KEY, "role", "y", "family", "model", p.alias("p"))


def tree_predictions(rows: DataFrame, s: Settings) -> DataFrame:
    """Predictions of boosted trees, fitted fold by fold and horizon by horizon."""
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.regression import GBTRegressor

    d = rows.withColumn("features", array_to_vector("x"))
    out = None
    for year, horizon in sorted(tuple(r) for r in rows.select(*KEY).distinct().collect()):  # one row per fold and horizon
        own = d.where((F.col("test_year") == year) & (F.col("horizon") == horizon))
        for depth, rate in s.tree_grid:
            model = GBTRegressor(labelCol="y", maxDepth=depth, stepSize=rate, maxIter=s.trees, minInstancesPerNode=50, seed=SEED).fit(own.where("role = 'train'"))
            p = model.transform(own.where("role <> 'train'")).select("security_id", "as_of_date", *KEY, "role", "y", F.lit("GBM").alias("family"), F.lit(f"gbm_{depth}_{rate:g}").alias("model"), F.col("prediction").alias("p"))
            out = p if out is None else out.unionByName(p)
    return out


# ---- choice on validation ------------------------------------------------------------------------------


def rank_ic(d: DataFrame, keys: list[str], names: int) -> DataFrame:
    """Rank correlation of y and p by the keys and date, where a date has enough names and three values of each."""
    by = [*keys, "as_of_date"]
    ranked = d.select(*by, "y", "p", W.rank_share(F.col("y"), *by).alias("ry"), W.rank_share(F.col("p"), *by).alias("rp"))
    ic = F.try_divide(F.covar_pop("ry", "rp"), F.stddev_pop("ry") * F.stddev_pop("rp"))
    g = ranked.groupBy(*by).agg(F.count("*").alias("n"), F.countDistinct("y").alias("uy"), F.countDistinct("p").alias("up"), ic.alias("ic"))
    return g.where((F.col("n") >= names) & (F.col("uy") >= 3) & (F.col("up") >= 3) & F.col("ic").isNotNull()).select(*by, "ic")


def scores(d: DataFrame, keys: list[str], names: int) -> DataFrame:
    """Mean rank correlation (null if there is none) and root mean squared error by the keys."""
    rmse = d.groupBy(*keys).agg(F.sqrt(F.avg(F.pow(F.col("p") - F.col("y"), 2))).alias("rmse"))
    return rmse.join(rank_ic(d, keys, names).groupBy(*keys).agg(F.avg("ic").alias("ic")), keys, "left")


def best(d: DataFrame, per: list[str], of: str, names: int) -> DataFrame:
    """Per group the candidate of the best rank correlation, then the least error, then the first name."""
    order = F.struct(F.coalesce("ic", F.lit(-999.0)), -F.col("rmse"))
    w = Window.partitionBy(*per).orderBy(order.desc(), of)
    return scores(d, [*per, of], names).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def stacked(chosen: DataFrame, s: Settings) -> tuple[DataFrame, DataFrame]:
    """Predictions as the mix of families that is best on validation, and the weights (tenths) per fold and horizon."""
    row = ["security_id", "as_of_date", *KEY, "role"]
    families = ["ELASTIC_NET", "RIDGE", *(["GBM"] if s.trees else [])]
    wide = chosen.groupBy(*row).pivot("family", families).agg(F.first("p")).join(chosen.select(*row, "y").distinct(), row)
    grid = [w for w in itertools.product(range(11), repeat=len(families)) if sum(w) == 10]
    mixes = F.array(*[F.struct(F.lit(k).alias("mix"), F.array(*[F.lit(x / 10) for x in w]).alias("weights")) for k, w in enumerate(grid)])
    mixed = sum((F.col("weights")[i] * F.col(f) for i, f in enumerate(families)), F.lit(0.0))
    tried = wide.where("role = 'validate'").select(*row, "y", *families, F.inline(mixes)).select(*row, "y", "mix", mixed.alias("p"))
    weights = F.broadcast(best(tried, list(KEY), "mix", s.least_names).join(_grid(chosen, grid), "mix").select(*KEY, "weights"))  # one row per fold and horizon
    return wide.join(weights, list(KEY)).select(*row, "y", mixed.alias("p")), weights


def _grid(d: DataFrame, grid: list[tuple[int, ...]]) -> DataFrame:
    return F.broadcast(d.sparkSession.createDataFrame([(k, [x / 10 for x in w]) for k, w in enumerate(grid)], "mix int, weights array<double>"))  # at most 66 rows


# ---- calibrated outputs ------------------------------------------------------------------------------------


def logistic(valid: DataFrame, rounds: int = 25) -> dict[tuple[int, int], tuple[float, float]]:
    """Intercept and slope of the chance that y is above 0, unit penalty on the slope; Newton steps over all folds at once."""
    spark, at = valid.sparkSession, {}
    for r in valid.select(*KEY).distinct().collect():  # one row per fold and horizon
        at[r["test_year"], r["horizon"]] = (0.0, 0.0)
    for _ in range(rounds):
        now = spark.createDataFrame([(*k, *v) for k, v in at.items()], "test_year int, horizon int, a double, b double")
        g = 1 / (1 + F.exp(-(F.col("a") + F.col("b") * F.col("p"))))
        d = valid.join(F.broadcast(now), list(KEY)).select(*KEY, "p", (g - (F.col("y") > 0).cast("double")).alias("e"), (g * (1 - g)).alias("v"))
        sums = d.groupBy(*KEY).agg(F.sum("e"), F.sum(F.col("e") * F.col("p")), F.sum("v"), F.sum(F.col("v") * F.col("p")), F.sum(F.col("v") * F.col("p") * F.col("p"))).collect()
        moved = 0.0
        for year, horizon, ga, gb, haa, hab, hbb in sums:
            a, b = at[year, horizon]
            step = np.linalg.solve(np.array([[haa + 1e-12, hab], [hab, hbb + 1.0]]), np.array([ga, gb + b]))
            at[year, horizon] = (a - float(step[0]), b - float(step[1]))
            moved = max(moved, float(np.abs(step).max()))
        if moved < 1e-9:
            break
    return at


def calibrated(mix: DataFrame, s: Settings) -> DataFrame:
    """Test rows with the expected return (ridge of y on the prediction), the chance to rise and the value at risk."""
    valid = mix.where("role = 'validate'")
    slope = F.covar_pop("p", "y") * F.count("*") / (F.var_pop("p") * F.count("*") + 1.0)
    lines = valid.groupBy(*KEY).agg(slope.alias("slope"), (F.avg("y") - slope * F.avg("p")).alias("level"), F.percentile(F.col("y") - F.col("p"), s.var_share).alias("risk"))
    chances = mix.sparkSession.createDataFrame([(*k, *v) for k, v in logistic(valid).items()], "test_year int, horizon int, a double, b double")
    d = mix.where("role = 'test'").join(F.broadcast(lines), list(KEY)).join(F.broadcast(chances), list(KEY))  # one row per fold and horizon
    p = F.col("p")
    return d.select(
        "security_id", "as_of_date", *KEY, "y", "p", (F.col("level") + F.col("slope") * p).alias("expected_return"),
        (1 / (1 + F.exp(-(F.col("a") + F.col("b") * p)))).alias("prob_up"), (F.col("y") < p + F.col("risk")).cast("int").alias("var_violation"),
    )


def ends(d: DataFrame, keys: list[str], s: Settings) -> DataFrame:
    """Per date with enough names: mean y of the top and bottom share by p, and the share of the top above zero."""
    by = [*keys, "as_of_date"]
    q = d.withColumn("q", W.rank_share(F.col("p"), *by))
    top, bottom = F.col("q") >= 1 - s.end_share, F.col("q") <= s.end_share
    out = q.groupBy(*by).agg(F.count("*").alias("n"), F.avg(F.when(top, F.col("y"))).alias("top"), F.avg(F.when(bottom, F.col("y"))).alias("bottom"), F.avg(F.when(top, (F.col("y") > 0).cast("double"))).alias("hit"))
    return out.where(F.col("n") >= s.least_names)


def lower_bound(x: list[float], draws: int, block: int = 20) -> float | None:
    """2.5 % quantile of the means of resampled blocks of a daily series."""
    n = len(x)
    if n < 20:
        return None
    v, rng = np.array(x), np.random.default_rng(SEED)
    first = rng.integers(0, max(1, n - block + 1), (draws, -(-n // block)))
    at = np.minimum(first[:, :, None] + np.arange(block), n - 1).reshape(draws, -1)[:, :n]
    return float(np.quantile(v[at].mean(1), 0.025))


def metrics(oos: DataFrame, s: Settings) -> dict[int, dict[str, float | None]]:
    """Out-of-sample figures by horizon; daily series (a few thousand numbers) are finished on the driver."""
    out: dict[int, dict[str, float | None]] = {}
    ic = rank_ic(oos, ["horizon"], s.least_names)
    sides = ends(oos, ["horizon"], s)
    up = (F.col("y") > 0).cast("double")
    sums = oos.groupBy("horizon").agg(
        F.avg((F.signum("y") == F.signum("p")).cast("double")).alias("hit_rate"), F.avg(F.pow(F.col("prob_up") - up, 2)).alias("brier"), F.avg(up).alias("up"),
        F.count("*").alias("n"), F.sum("var_violation").alias("hits"),
    )
    order = Window.partitionBy("horizon", "security_id").orderBy("as_of_date")
    steps = oos.withColumn("before", F.lag("var_violation").over(order)).where("before is not null").groupBy("horizon").pivot("before", [0, 1]).agg(F.count_if(F.col("var_violation") == 0).alias("none"), F.count_if(F.col("var_violation") == 1).alias("hit"))
    chain = {r["horizon"]: [r[f"{a}_{b}"] or 0 for a in (0, 1) for b in ("none", "hit")] for r in steps.collect()}
    daily = {r["horizon"]: [v["ic"] for v in sorted(r["x"], key=lambda v: v["d"])] for r in ic.groupBy("horizon").agg(F.collect_list(F.struct(F.col("as_of_date").alias("d"), "ic")).alias("x")).collect()}
    spread = {r["horizon"]: sorted(r["x"], key=lambda v: v["d"]) for r in sides.groupBy("horizon").agg(F.collect_list(F.struct(F.col("as_of_date").alias("d"), "top", "bottom", "hit")).alias("x")).collect()}
    for r in sums.collect():  # one row per horizon
        h = r["horizon"]
        a, e = np.array(daily.get(h, []), float), spread.get(h, [])
        both = [(v["top"] - v["bottom"], v["hit"]) for v in e if v["top"] is not None and v["bottom"] is not None]
        alpha = [v["top"] - s.cost for v in e if v["top"] is not None]
        lag = h - 1
        u = a - a.mean() if len(a) else a
        t = stats.hac_t(len(a), float(a.mean()), [float(u[k:] @ u[: len(u) - k]) for k in range(min(lag, len(u) - 1) + 1)], lag) if len(a) > 1 else None
        climate = r["up"] * (1 - r["up"])
        out[h] = {
            "rank_ic": float(a.mean()) if len(a) else None, "icir": float(a.mean() / (a.std(ddof=1) + 1e-12) * math.sqrt(252)) if len(a) > 1 else None, "ic_days": len(a), "hit_rate": r["hit_rate"],
            "spread": float(np.mean([x for x, _ in both])) if both else None, "top_positive": float(np.mean([x for _, x in both])) if both else None, "hac_t": t,
            "brier_skill": 1 - r["brier"] / climate if climate > 0 else None, "alpha": float(np.mean(alpha)) if alpha else None, "alpha_lcb95": lower_bound(alpha, s.draws),
            "kupiec_p": stats.kupiec(r["n"], r["hits"]), "christoffersen_p": stats.christoffersen(r["n"], *chain.get(h, [0, 0, 0, 0])),
            "p_bonferroni3": min(1.0, 3 * 0.5 * math.erfc(t / math.sqrt(2))) if t is not None else 1.0,
        }
    return out


def gates(found: dict[int, dict], pit_pass: bool, n_folds: int, s: Settings) -> dict[str, bool]:
    """The twelve gates. Names and thresholds; a figure that is missing fails its gate."""
    first, second = (found.get(h, {}) for h in s.gate_horizons)
    at = lambda d, k, ok: d.get(k) is not None and ok(d[k])
    return {
        "PIT_CHECK": pit_pass,
        "MIN_TEST_FOLDS": n_folds >= s.least_folds,
        "OOS_RANK_IC_60": at(first, "rank_ic", lambda x: x >= 0.015),
        "OOS_RANK_IC_120": at(second, "rank_ic", lambda x: x >= 0.01),
        "OOS_ICIR_60": at(first, "icir", lambda x: x >= 0.2),
        "OOS_IC60_HAC_T": at(first, "hac_t", lambda x: x >= 1.96),
        "BRIER_SKILL_60": at(first, "brier_skill", lambda x: x > 0),
        "TOP_MINUS_BOTTOM_DECILE_60": at(first, "spread", lambda x: x > 0),
        "VAR_KUPIEC": at(first, "kupiec_p", lambda x: x >= 0.05),
        "VAR_CHRISTOFFERSEN": at(first, "christoffersen_p", lambda x: x >= 0.05),
        "COST_ADJUSTED_ALPHA_LCB95": at(first, "alpha_lcb95", lambda x: x > 0),
        "SELECTION_BIAS_CONTROL": at(first, "p_bonferroni3", lambda x: x < 0.05),
    }


def status(passed: dict[str, bool]) -> str:
    """One of the four states."""
    if not passed["PIT_CHECK"]:
        return "BLOCKED_PIT_AUDIT_FAILED"
    if not passed["MIN_TEST_FOLDS"]:
        return "BLOCKED_INSUFFICIENT_HISTORY"
    return "CALIBRATED_PRODUCTION" if all(passed.values()) else "VALIDATION_FAILED_NOT_PRODUCTION"


def pit_gate(panel: DataFrame, s: Settings) -> Column:
    """No value from after its cutoff, no repeated key, few missing values: over columns known_at and cutoff."""
    missing = sum((F.avg(F.col(c).isNull().cast("double")) for c in s.features), F.lit(0.0)) / max(1, len(s.features))
    once = F.count("*") == F.countDistinct("security_id", "as_of_date")
    return (F.count_if(F.col("known_at") > F.col("cutoff")) == 0) & once & (missing <= s.most_missing)


def out_of_sample(panel: DataFrame, calendar: DataFrame, s: Settings, store) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Calibrated test predictions of all folds, the chosen model of each family, the weights of the mix.

    panel: security_id, as_of_date, label_end, excess_h, the features; ``store`` writes a table and reads it back.
    """
    rows = store(imputed(by_role(panel, calendar, s), s), "calibration-rows")
    tried = predictions(rows, solved(moments(rows, 2 * len(s.features)), s))
    if s.trees:
        tried = tried.unionByName(tree_predictions(rows, s))
    tried = store(tried, "calibration-tried")
    choice = store(best(tried.where("role = 'validate'"), [*KEY, "family"], "model", s.least_names), "calibration-choice")
    chosen = tried.join(F.broadcast(choice.select(*KEY, "family", "model")), [*KEY, "family", "model"], "left_semi")  # a row per fold, horizon and family
    mix, weights = stacked(chosen, s)
    return store(calibrated(store(mix, "calibration-mix"), s), "calibration-oos"), choice, weights
