"""Forecasters as aggregate state plus closed expressions, fitted for all series at once.

A series is reduced to one row of fixed-width state (its last levels, a handful of sums, a
regression line and twelve calendar-month sums). Every model is then an expression over that
row, so no series is ever gathered in memory and all models share one shuffle.

Two models stand in for iterative fits and are not numerically equal to them:

``seasonal_ar``      with d(t) = y(t) - y(t-1):  d(t) = a d(t-1) + b d(t-12), least squares
                     over t = 14..n, rolled out recursively.
``trend_seasonal``   least-squares line over the month index plus the mean residual of the
                     calendar month (0 for a month never seen).

Two more are fitted only where they are asked for by name, from further sums of the same kind:

``seasonal_arma``    d(t) = a d(t-1) + b d(t-12) + c e(t-1), in two steps of least squares: the
                     residuals e of a longer autoregression (d(t-1), d(t-2), d(t-12); t = 14..n)
                     are regressors of the second (t = 15..n). The last residual enters the
                     first month forecast, later ones have none.
``trend_changepoints``  a line whose slope may change at fixed shares of the training span, plus
                     two yearly waves: normal equations from aggregated moments, with a ridge
                     on slope changes and waves, solved row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from prodseries.functions.measures import month_index, nan_to_null
from prodseries.schemas import FORECAST_CONTEXT

HORIZON = 3
MIN_TRAIN = 24
MOVING_AVERAGE_WINDOW = 3
SEASONAL_MIN_ROWS = 24
SEASON = 12

# Levels kept per series: enough for the lags t-1, t-2, t-12 and t-13.
TAIL = 13

SERIES = ["level", "series_id"]


# --------------------------------------------------------------------------- state


def order_history(history: DataFrame) -> DataFrame:
    """Number each series' rows by date and attach the lags the fits need (one sort)."""
    series = Window.partitionBy(*SERIES).orderBy("period_date")
    context = [c for c in FORECAST_CONTEXT if c not in SERIES]
    return (
        history.select(
            *SERIES,
            # A series is described by its first row.
            *[F.first(c).over(series).alias(c) for c in context],
            "period_date",
            F.col("target_value").alias("y"),
            F.row_number().over(series).alias("rn"),
            F.count("*").over(Window.partitionBy(*SERIES)).alias("n_rows"),
            *[F.lag("target_value", k).over(series).alias(f"l{k}") for k in (1, 2, 3, SEASON, SEASON + 1)],
        )
        .withColumns(
            {
                "d0": F.expr("y - l1"), "d1": F.expr("l1 - l2"), "d2": F.expr("l2 - l3"),
                "d12": F.expr(f"l{SEASON} - l{SEASON + 1}"),
            }
        )
        .drop("l1", "l2", "l3", f"l{SEASON}", f"l{SEASON + 1}")
    )


def _aggregates(named: dict[str, str]) -> list[Column]:
    return [F.expr(sql).alias(name) for name, sql in named.items()]


# ------------------------------------------------------- state of the models by name


def _det3(m: list[list[str]]) -> str:
    """The determinant of a 3 x 3 matrix of SQL terms."""
    a, b, c = m
    return (
        f"({a[0]} * ({b[1]} * {c[2]} - {b[2]} * {c[1]}) - {a[1]} * ({b[0]} * {c[2]} - {b[2]} * {c[0]})"
        f" + {a[2]} * ({b[0]} * {c[1]} - {b[1]} * {c[0]}))"
    )


def _solved3(moment, target) -> tuple[str, list[str]]:
    """Whether three normal equations have one solution, and the three unknowns (else NULL).
    ``moment(i, j)`` and ``target(i)`` name sums of products."""
    m = [[moment(min(i, j), max(i, j)) for j in range(3)] for i in range(3)]
    whole = _det3(m)
    proper = f"coalesce({whole} > {SINGULAR} * {m[0][0]} * {m[1][1]} * {m[2][2]}, false)"
    swapped = [[[target(i) if j == k else m[i][j] for j in range(3)] for i in range(3)] for k in range(3)]
    return proper, [f"CASE WHEN {proper} THEN {_det3(x)} / {whole} END" for x in swapped]


SINGULAR = 1e-10
_LONG = ("d1", "d2", "d12")
_SHORT = ("d1", "d12", "e1")


def _arma_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the residuals of the long autoregression, their own (e0) and the month before's (e1)."""
    fitted = Window.partitionBy(*SERIES, *keys)
    used = F.expr(f"rn <= train_rows AND rn >= {SEASON + 2}")

    def over(a: str, b: str) -> Column:
        return F.sum(F.when(used, F.col(a) * F.col(b))).over(fitted)

    sums = {f"_m{i}{j}": over(_LONG[i], _LONG[j]) for i in range(3) for j in range(i, 3)}
    sums |= {f"_t{i}": over(_LONG[i], "d0") for i in range(3)}
    proper, unknowns = _solved3(lambda i, j: f"_m{i}{j}", lambda i: f"_t{i}")
    residual = " - ".join(["d0", *[f"({u}) * {x}" for u, x in zip(unknowns, _LONG, strict=True)]])
    named = rows.withColumns(sums).withColumn("e0", F.when(F.col("rn") >= SEASON + 2, F.expr(residual)))
    return named.withColumn("e1", F.lag("e0").over(fitted.orderBy("rn"))).drop(*sums)


def _arma_state() -> tuple[dict[str, str], dict[str, str]]:
    used = f"FILTER (WHERE rn <= train_rows AND rn >= {SEASON + 3})"
    sums = {f"arma_m{i}{j}": f"sum({_SHORT[i]} * {_SHORT[j]}) {used}" for i in range(3) for j in range(i, 3)}
    sums |= {f"arma_t{i}": f"sum({_SHORT[i]} * d0) {used}" for i in range(3)}
    sums["arma_last"] = "max(e0) FILTER (WHERE rn = train_rows)"
    proper, unknowns = _solved3(lambda i, j: f"arma_m{i}{j}", lambda i: f"arma_t{i}")
    packed = {"arma_proper": f"{proper} AND arma_last IS NOT NULL", "arma_last": "arma_last"}
    return sums, packed | dict(zip(("arma_1", "arma_12", "arma_e"), unknowns, strict=True))


# Shares of the training span at which the slope may change, yearly waves, and their ridges.
CHANGEPOINTS = (0.2, 0.4, 0.6, 0.8)
WAVES = 2
SLOPE_RIDGE, WAVE_RIDGE = 0.1, 0.1


def _terms(share: str, x: str) -> list[str]:
    """The regressors of a month ``x`` at a share of the training span, as SQL."""
    angles = [f"2 * pi() * {k} * ({x}) / {SEASON}" for k in range(1, WAVES + 1)]
    hinges = [f"greatest(({share}) - {c}, 0.0D)" for c in CHANGEPOINTS]
    return ["1.0D", f"({share})", *hinges, *[f"{f}({angle})" for angle in angles for f in ("sin", "cos")]]


_RIDGES = [0.0, 0.0] + [SLOPE_RIDGE] * len(CHANGEPOINTS) + [WAVE_RIDGE] * 2 * WAVES


def _span_rows(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the regressors, whose changepoints depend on the series' training span."""
    fitted, used = Window.partitionBy(*SERIES, *keys), F.col("rn") <= F.col("train_rows")
    spans = rows.withColumns({"x_first": F.min(F.when(used, F.col("x"))).over(fitted), "x_last": F.max(F.when(used, F.col("x"))).over(fitted)})
    share = "coalesce(try_divide(x - x_first, x_last - x_first), 0.0D)"
    return spans.withColumns({f"z{i}": F.expr(t) for i, t in enumerate(_terms(share, "x"))})


def _span_state() -> tuple[dict[str, str], dict[str, str]]:
    n, used = len(_RIDGES), "FILTER (WHERE rn <= train_rows)"
    sums = {f"z{i}_{j}": f"sum(z{i} * z{j}) {used}" for i in range(n) for j in range(i, n)}
    sums |= {f"z{i}_y": f"sum(z{i} * y) {used}" for i in range(n)} | {"x_first": "max(x_first)", "x_last": "max(x_last)"}

    def cell(i: int, j: int) -> str:
        ridge = f" + {_RIDGES[i]}D" if i == j else ""
        return f"z{min(i, j)}_{max(i, j)}{ridge}"

    matrix = ", ".join(f"array({', '.join(cell(i, j) for j in range(n))}, z{i}_y)" for i in range(n))
    # Gauss and Jordan; the ridges make pivots positive wherever there are two dates.
    solved = (
        f"aggregate(sequence(0, {n - 1}), array({matrix}), (m, i) -> transform(m, (row, r) -> IF(r = i,"
        " transform(row, v -> try_divide(v, m[i][i])),"
        " transform(row, (v, c) -> v - try_divide(m[r][i], m[i][i]) * m[i][c]))))"
    )
    packed = {
        "span_first": "x_first",
        "span": "x_last - x_first",
        "span_fit": f"CASE WHEN x_last > x_first THEN transform({solved}, row -> row[{n}]) END",
    }
    return sums, packed


# Models with a state of their own: rows are prepared, then sums and what is packed of them.
NAMED_STATES = {"seasonal_arma": (_arma_rows, _arma_state), "trend_changepoints": (_span_rows, _span_state)}


def fit_series(
    ordered: DataFrame, holdout: Column, extra_keys: list[str], horizon: int = 0, models: list[str] | None = None
) -> DataFrame:
    """One row of state per series, fitted on all but the last ``holdout`` rows.

    With ``horizon`` the held-out dates and values come along as ``test_date`` / ``test_y``.
    ``models`` names those whose own state is wanted besides the common one.
    """
    rows = ordered.withColumns(
        {
            "train_rows": (F.col("n_rows") - holdout).cast("int"),
            "x": month_index(F.col("period_date")).cast("double"),
            "m": F.month("period_date"),
        }
    )
    named = [NAMED_STATES[name] for name in models or [] if name in NAMED_STATES]
    for prepare, _ in named:
        rows = prepare(rows, extra_keys)
    months, steps, tail = range(1, SEASON + 1), range(1, horizon + 1), range(TAIL)
    lagged = f"FILTER (WHERE rn <= train_rows AND rn >= {SEASON + 2})"
    state = {
        "last_period": "max(period_date) FILTER (WHERE rn <= train_rows)",
        "recent_mean": (
            f"avg(y) FILTER (WHERE rn <= train_rows AND rn > train_rows - {MOVING_AVERAGE_WINDOW})"
        ),
        "s11": f"sum(d1 * d1) {lagged}",
        "s22": f"sum(d12 * d12) {lagged}",
        "s12": f"sum(d1 * d12) {lagged}",
        "s1": f"sum(d1 * d0) {lagged}",
        "s2": f"sum(d12 * d0) {lagged}",
        "slope": "regr_slope(y, x) FILTER (WHERE rn <= train_rows)",
        "intercept": "regr_intercept(y, x) FILTER (WHERE rn <= train_rows)",
    }
    # tail_0 is the latest training level.
    state |= {f"tail_{k}": f"max(y) FILTER (WHERE rn = train_rows - {k})" for k in tail}
    for m in months:
        state[f"y_m{m}"] = f"avg(y) FILTER (WHERE rn <= train_rows AND m = {m})"
        state[f"x_m{m}"] = f"avg(x) FILTER (WHERE rn <= train_rows AND m = {m})"
    for step in steps:
        state[f"test_date_{step}"] = f"max(period_date) FILTER (WHERE rn = train_rows + {step})"
        state[f"test_y_{step}"] = f"max(y) FILTER (WHERE rn = train_rows + {step})"

    keys = [*FORECAST_CONTEXT, "n_rows", "train_rows", *extra_keys]
    seasonal = ", ".join(f"coalesce(y_m{m} - intercept - slope * x_m{m}, 0)" for m in months)
    packed = {
        "last_period": "last_period",
        "last_x": "12 * year(last_period) + month(last_period)",
        "recent_mean": "recent_mean",
        # Oldest first, ending with the latest level.
        "tail": f"array({', '.join(f'tail_{k}' for k in reversed(tail))})",
        "solvable": "coalesce(s11 * s22 - s12 * s12 > 1e-12 * s11 * s22, false)",
        "ar_1": "CASE WHEN s11 * s22 - s12 * s12 > 1e-12 * s11 * s22"
        " THEN (s1 * s22 - s2 * s12) / (s11 * s22 - s12 * s12) END",
        "ar_12": "CASE WHEN s11 * s22 - s12 * s12 > 1e-12 * s11 * s22"
        " THEN (s2 * s11 - s1 * s12) / (s11 * s22 - s12 * s12) END",
        # A single distinct date has no slope: the line is then flat.
        "slope": "coalesce(slope, 0)",
        "intercept": "coalesce(intercept, recent_mean)",
        "seasonal": f"array({seasonal})",
    }
    for _, own in named:
        sums, more = own()
        state |= sums
        packed |= more
    if horizon:
        packed["test_date"] = f"array({', '.join(f'test_date_{s}' for s in steps)})"
        packed["test_y"] = f"array({', '.join(f'test_y_{s}' for s in steps)})"
    return rows.groupBy(*keys).agg(*_aggregates(state)).select(*keys, *_aggregates(packed))


# -------------------------------------------------------------------------- models


@dataclass(frozen=True)
class Forecaster:
    """A model as SQL over a state row: ``path`` is an array of ``{h}`` forecasts, ``reason``
    is non-NULL when the model cannot be fitted to that row. Dynamic models follow the
    calendar, flat ones repeat one value. The ordinal breaks ties between equal models."""

    name: str
    ordinal: int
    dynamic: bool
    path: str
    reason: str = "CAST(NULL AS STRING)"

    def path_of(self, h: str) -> Column:
        return F.expr(self.path.format(h=h))

    def reason_of(self) -> Column:
        return F.expr(self.reason)


_STEPS = "sequence(1, greatest({h}, 1))"

# d(t) = ar_1 d(t-1) + ar_12 d(t-12), on levels, one level appended per step.
_EXTEND = (
    "(levels, step) -> concat(levels, array(element_at(levels, -1)"
    " + ar_1 * (element_at(levels, -1) - element_at(levels, -2))"
    f" + ar_12 * (element_at(levels, -{SEASON}) - element_at(levels, -{SEASON + 1}))))"
)

_EXTEND_ARMA = (
    "(levels, step) -> concat(levels, array(element_at(levels, -1)"
    " + arma_1 * (element_at(levels, -1) - element_at(levels, -2))"
    f" + arma_12 * (element_at(levels, -{SEASON}) - element_at(levels, -{SEASON + 1}))"
    " + IF(step = 1, arma_e * arma_last, 0.0D)))"
)
_NEXT_SHARE = "(last_x + step - span_first) / span"
_CHANGEPOINT_LEVEL = " + ".join(f"span_fit[{i}] * {t}" for i, t in enumerate(_terms(_NEXT_SHARE, "last_x + step")))

MODELS = {
    f.name: f
    for f in (
        Forecaster("naive", 0, False, "array_repeat(element_at(tail, -1), {h})"),
        Forecaster("moving_average", 1, False, "array_repeat(recent_mean, {h})"),
        Forecaster(
            "seasonal_ar",
            2,
            True,
            f"slice(aggregate({_STEPS}, tail, {_EXTEND}), {TAIL + 1}, {{h}})",
            f"CASE WHEN train_rows < {SEASONAL_MIN_ROWS} THEN 'series too short for seasonal baseline'"
            " WHEN NOT solvable THEN 'singular_fit' END",
        ),
        Forecaster(
            "trend_seasonal",
            3,
            True,
            f"transform({_STEPS}, step -> intercept + slope * (last_x + step)"
            f" + get(seasonal, (last_x + step - 1) % {SEASON}))",
        ),
        Forecaster(
            "seasonal_arma",
            4,
            True,
            f"slice(aggregate({_STEPS}, tail, {_EXTEND_ARMA}), {TAIL + 1}, {{h}})",
            f"CASE WHEN train_rows < {SEASONAL_MIN_ROWS} THEN 'series too short for seasonal baseline'"
            " WHEN NOT arma_proper THEN 'singular_fit' END",
        ),
        Forecaster(
            "trend_changepoints",
            5,
            True,
            f"transform({_STEPS}, step -> {_CHANGEPOINT_LEVEL})",
            f"CASE WHEN train_rows < {SEASONAL_MIN_ROWS} THEN 'series too short for seasonal baseline'"
            " WHEN span_fit IS NULL OR exists(span_fit, b -> b IS NULL) THEN 'singular_fit' END",
        ),
    )
}
# What is fitted unless models are named.
STANDARD_MODELS = [name for name in MODELS if name not in NAMED_STATES]
DYNAMIC_MODELS = [f.name for f in MODELS.values() if f.dynamic]


def resolve_models(names: list[str] | None = None) -> list[Forecaster]:
    names = STANDARD_MODELS if names is None else names
    unknown = [n for n in names if n not in MODELS]
    if unknown:
        raise ValueError(f"Unsupported model: {unknown[0]}")
    return [MODELS[n] for n in names]


def path_of(model: str, h: str) -> Column:
    """Forecast path of the model that column ``model`` names; only that branch is evaluated."""
    branches = " ".join(f"WHEN '{f.name}' THEN {f.path.format(h=h)}" for f in resolve_models())
    return F.expr(f"CASE {model} {branches} END")


def reason_of(model: str) -> Column:
    branches = " ".join(f"WHEN '{f.name}' THEN {f.reason}" for f in resolve_models())
    return F.expr(f"CASE {model} {branches} ELSE concat('Unsupported model: ', {model}) END")


def model_ordinal(model: Column) -> Column:
    names = F.array(*[F.lit(n) for n in MODELS])
    # Unknown names rank after every known one.
    return F.coalesce(F.nullif(F.array_position(names, model), F.lit(0)), F.lit(len(MODELS) + 1))


# ------------------------------------------------------------------------ backtest


def split_train_test(history: DataFrame, horizon: int = HORIZON, min_train: int = MIN_TRAIN) -> DataFrame:
    """History rows tagged ``train`` / ``test``; series that are too short are left out."""
    return (
        order_history(history)
        .filter(F.col("n_rows") >= horizon + min_train)
        .select(
            *FORECAST_CONTEXT,
            "period_date",
            F.col("y").alias("target_value"),
            F.when(F.col("rn") > F.col("n_rows") - horizon, "test").otherwise("train").alias("split"),
        )
    )


def _insufficient() -> Column:
    return F.concat(F.lit("insufficient_history(len="), F.col("n_rows").cast("string"), F.lit(")"))


def _fits(models: list[Forecaster], h: int) -> Column:
    """One struct per model; a path is only evaluated where the model fits."""
    structs = ", ".join(
        f"named_struct('model', '{f.name}', 'reason', {f.reason},"
        f" 'path', CASE WHEN ({f.reason}) IS NULL THEN {f.path.format(h=h)} END)"
        for f in models
    )
    return F.expr(f"array({structs})")


def backtest_state(
    history: DataFrame, horizon: int = HORIZON, min_train: int = MIN_TRAIN, models: list[str] | None = None
) -> DataFrame:
    """One row per series: the fits of all models with and without the held-out rows.

    The two fits are two groups of the same aggregation, so the history is shuffled once.
    """
    fits = order_history(history).withColumn("holdout", F.explode(F.array(F.lit(horizon), F.lit(0))))
    state = fit_series(fits, F.col("holdout"), ["holdout"], horizon, models)
    enough = F.col("n_rows") >= horizon + min_train
    return state.select(
        *FORECAST_CONTEXT,
        "n_rows",
        "train_rows",
        "last_period",
        "holdout",
        "test_date",
        "test_y",
        enough.alias("enough"),
        F.when(enough, _fits(resolve_models(models), horizon)).alias("fits"),
    )


def _tested(state: DataFrame) -> DataFrame:
    return state.filter("holdout > 0 AND enough").withColumn("fit", F.explode("fits"))


def backtest_predictions(state: DataFrame) -> DataFrame:
    """Held-out rows with the forecast made for their step."""
    return (
        _tested(state)
        .filter("fit.reason IS NULL")
        .select(
            *FORECAST_CONTEXT,
            F.col("fit.model").alias("model"),
            "train_rows",
            F.col("holdout").alias("test_rows"),
            F.col("last_period").alias("train_last_period"),
            F.posexplode(F.arrays_zip("test_date", "test_y", F.col("fit.path").alias("path"))).alias("i", "p"),
        )
        .select(
            *FORECAST_CONTEXT,
            "model",
            "train_rows",
            "test_rows",
            "train_last_period",
            (F.col("i") + 1).alias("horizon_step"),
            F.col("p.test_date").alias("period_date"),
            F.col("p.test_y").alias("y_true"),
            F.col("p.path").alias("y_pred"),
            F.abs(F.col("p.test_y") - F.col("p.path")).alias("abs_error"),
        )
    )


def backtest_metrics(predictions: DataFrame) -> DataFrame:
    """mae, rmse, mape and smape per series and model; the last two skip zero denominators."""
    y, f = F.col("y_true"), F.col("y_pred")
    error, scale = F.abs(y - f), F.abs(y) + F.abs(f)
    return predictions.groupBy(
        *FORECAST_CONTEXT, "model", "train_rows", "test_rows", "train_last_period"
    ).agg(
        F.avg(error).alias("mae"),
        F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.when(y != 0, error / F.abs(y))) * 100).alias("mape"),
        (F.avg(F.when(scale != 0, 2 * error / scale)) * 100).alias("smape"),
    )


def _paired_fits(state: DataFrame) -> DataFrame:
    """Per series and model: did the backtest fit pass, and the fit on the full history."""
    exploded = state.filter("enough").withColumn("fit", F.explode("fits"))
    full = F.col("holdout") == 0
    return exploded.groupBy(*FORECAST_CONTEXT, F.col("fit.model").alias("model")).agg(
        F.max(F.when(~full, F.col("fit.reason"))).alias("test_reason"),
        F.max(F.when(full, F.col("fit.reason"))).alias("future_reason"),
        F.max(F.when(full, F.col("fit.path"))).alias("path"),
        F.max(F.when(full, F.col("last_period"))).alias("train_last_period"),
    )


def future_forecasts(state: DataFrame) -> DataFrame:
    """Next months from the full history, for models whose backtest fit passed."""
    return (
        _paired_fits(state)
        .filter("test_reason IS NULL AND future_reason IS NULL")
        .select(*FORECAST_CONTEXT, "model", "train_last_period", F.posexplode("path").alias("i", "forecast_value"))
        .select(
            *FORECAST_CONTEXT,
            "model",
            (F.col("i") + 1).alias("horizon_step"),
            F.add_months("train_last_period", F.col("i") + 1).alias("forecast_period_date"),
            "forecast_value",
            "train_last_period",
        )
    )


def skipped_series(state: DataFrame) -> DataFrame:
    """Why a series or a model of it has no forecast: ``level, series_id, model, reason``."""
    columns = [*SERIES, "model", "reason"]
    short = state.filter("holdout = 0 AND NOT enough").select(
        *SERIES, F.lit("all").alias("model"), _insufficient().alias("reason")
    )
    failed = _paired_fits(state).select(
        *SERIES,
        F.when(F.col("test_reason").isNotNull(), F.col("model"))
        .otherwise(F.concat("model", F.lit("_future")))
        .alias("model"),
        F.coalesce("test_reason", "future_reason").alias("reason"),
    )
    return short.unionByName(failed.filter(F.col("reason").isNotNull()).select(*columns))


class Backtest:
    """Four views over one fitted state. They share its plan: write ``state`` to a table first
    when several of them are going to be written."""

    def __init__(self, state: DataFrame):
        self.state = state

    @property
    def predictions(self) -> DataFrame:
        return backtest_predictions(self.state)

    @property
    def metrics(self) -> DataFrame:
        return backtest_metrics(self.predictions)

    @property
    def future(self) -> DataFrame:
        return future_forecasts(self.state)

    @property
    def skipped(self) -> DataFrame:
        return skipped_series(self.state)


def backtest(
    history: DataFrame, horizon: int = HORIZON, min_train: int = MIN_TRAIN, models: list[str] | None = None
) -> Backtest:
    return Backtest(backtest_state(history, horizon, min_train, models))


def forecast_with(history: DataFrame, model: str, horizon: int = HORIZON) -> DataFrame:
    """One model for every series: the next ``horizon`` months after its last row."""
    (forecaster,) = resolve_models([model])
    state = fit_series(order_history(history), F.lit(0), [], models=[model])
    return (
        state.filter(forecaster.reason_of().isNull())
        .select(
            *FORECAST_CONTEXT, "last_period", F.posexplode(forecaster.path_of(str(horizon))).alias("i", "forecast_value")
        )
        .select(
            *FORECAST_CONTEXT,
            (F.col("i") + 1).alias("horizon_step"),
            F.add_months("last_period", F.col("i") + 1).alias("forecast_period_date"),
            "forecast_value",
        )
    )


# --------------------------------------------------------------------- leaderboard


def leaderboard(metrics: DataFrame) -> DataFrame:
    """Mean metrics per level and model; unknown metrics are left out of the means."""
    return metrics.groupBy("level", "model").agg(
        F.count_distinct("series_id").alias("n_series"),
        *[F.avg(nan_to_null(F.col(m))).alias(f"{m}_mean") for m in ("mae", "rmse", "mape", "smape")],
    )


def sort_leaderboard(board: DataFrame) -> DataFrame:
    return board.orderBy(
        "level", F.col("mae_mean").asc_nulls_last(), F.col("rmse_mean").asc_nulls_last(), "model"
    )


def best_by_level(board: DataFrame) -> DataFrame:
    """Lowest mean mae, then rmse, per level; unknown metrics come last, then model name."""
    rank = F.struct(
        F.col("mae_mean").isNull(), "mae_mean", F.col("rmse_mean").isNull(), "rmse_mean", "model"
    )
    best = F.struct("model", "mae_mean", "rmse_mean", "mape_mean", "smape_mean")
    return (
        board.groupBy("level")
        .agg(F.min_by(best, rank).alias("best"))
        .select(
            "level",
            F.col("best.model").alias("best_model_by_mae"),
            "best.mae_mean",
            "best.rmse_mean",
            "best.mape_mean",
            "best.smape_mean",
        )
    )


def forecast_report(history: DataFrame, views: Backtest) -> DataFrame:
    """Row counts of the backtest's outputs and the series covered, per level."""
    def rows(df: DataFrame, name: str) -> DataFrame:
        return df.groupBy("level").agg(F.count("*").alias("n")).select("level", F.lit(name).alias("measure"), "n")

    parts = [
        rows(views.predictions, "predictions"),
        rows(views.metrics, "series_metrics"),
        rows(views.future, "future_forecasts"),
        rows(views.skipped, "skipped_rows"),
        history.groupBy("level").agg(F.count_distinct("series_id").alias("n")).select(
            "level", F.lit("series").alias("measure"), "n"
        ),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
