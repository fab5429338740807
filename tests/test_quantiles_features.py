import datetime
import random

import numpy as np
import pandas as pd
import pytest

from prodseries.operators import features, quantiles


def grouped(spark, data):
    return spark.createDataFrame(data, "g string, v double")


@pytest.mark.parametrize("slices", [2, 7, 256])
def test_quantiles_equal_pandas(spark, monkeypatch, slices):
    monkeypatch.setattr(quantiles, "SLICES", slices)
    rng = random.Random(slices)
    data = [(rng.choice(["a", "b", None]), float(rng.choice([rng.randint(0, 9), rng.gauss(0, 50)]))) for _ in range(900)]
    # A group with a third of all rows, a single-row group, and missing values.
    data += [("hot", float(rng.randint(0, 400))) for _ in range(450)] + [("one", 4.0), ("a", None), ("none", None)]
    got = {r.g: r for r in quantiles.iqr_outliers(grouped(spark, data), ["g"], "v").collect()}
    frame = pd.DataFrame(data, columns=["g", "v"])
    for name, group in frame.groupby("g", dropna=False):
        sample = group["v"].dropna()
        key = None if pd.isna(name) else name
        if sample.empty:
            assert key not in got
            continue
        q1, q3 = sample.quantile(0.25), sample.quantile(0.75)
        low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        assert got[key].q1 == pytest.approx(q1, abs=1e-12) and got[key].q3 == pytest.approx(q3, abs=1e-12)
        assert got[key].n_values == len(sample)
        assert got[key].n_outliers == int(((sample < low) | (sample > high)).sum())


@pytest.mark.parametrize(("slices", "ranked"), [(2, 3), (4, 20), (16, 5)])
def test_slices_are_sliced_until_they_can_be_ranked(spark, monkeypatch, slices, ranked):
    """One group has all rows but a few; ties, infinities and few distinct values besides."""
    monkeypatch.setattr(quantiles, "SLICES", slices)
    monkeypatch.setattr(quantiles, "RANKED", ranked)
    rounds = []
    real = quantiles._holders

    def counted(rows, groups):
        out = real(rows, groups)
        rounds.append(out)
        return out

    monkeypatch.setattr(quantiles, "_holders", counted)
    rng = random.Random(slices)
    data = [("all", rng.gauss(0, 1e6)) for _ in range(1200)] + [("all", 7.0)] * 300
    data += [(None, float(i % 4)) for i in range(40)] + [("inf", float("inf"))] * 3 + [("inf", 1.0), ("one", 2.5)]
    got = {r.g: r for r in quantiles.iqr_outliers(grouped(spark, data), ["g"], "v").collect()}
    frame = pd.DataFrame([d for d in data if d[0] != "inf"], columns=["g", "v"])
    for name, group in frame.groupby("g", dropna=False):
        key = None if pd.isna(name) else name
        assert got[key].q1 == pytest.approx(group["v"].quantile(0.25), abs=1e-9)
        assert got[key].q3 == pytest.approx(group["v"].quantile(0.75), abs=1e-9)
    assert got["inf"].q3 == float("inf")
    assert len(rounds) >= 2
    last = rounds[-1].groupBy("g", "part").count().agg({"count": "max"}).first()[0]
    assert last <= ranked


def series(spark, values, start=0, gap_after=None):
    rows, month = [], start
    for i, v in enumerate(values):
        if gap_after is not None and i == gap_after:
            month += 1
        d = datetime.date(2020 + month // 12, month % 12 + 1, 1)
        rows.append((d, d.strftime("%Y-%m"), d.year, d.month, (d.month - 1) // 3 + 1, 1, "m", "u", "m|u", v))
        month += 1
    return spark.createDataFrame(
        rows,
        "period_date date, period_yyyymm string, year int, month int, quarter int, semester int, mineral string,"
        " unidad string, series_id string, target_value double",
    )


def test_series_features_equal_pandas(spark):
    values = [5.0, 0.0, 7.0, None, 9.0, 2.0, 4.0, 8.0, 6.0, 1.0, 3.0, 10.0, 12.0, 11.0, 13.0, 20.0]
    df = features.add_series_features(
        features.add_calendar_features(series(spark, values, gap_after=9)), ["mineral", "unidad"]
    ).orderBy("period_date").toPandas()
    s = pd.Series(values, dtype=float)
    for k in features.LAGS:
        np.testing.assert_allclose(df[f"lag_{k}"].astype(float), s.shift(k))
    for w in features.WINDOWS:
        past = s.shift(1).rolling(w, min_periods=1)
        np.testing.assert_allclose(df[f"roll_mean_{w}"].astype(float), past.mean())
        np.testing.assert_allclose(df[f"roll_min_{w}"].astype(float), past.min())
        np.testing.assert_allclose(df[f"roll_max_{w}"].astype(float), past.max())
        np.testing.assert_allclose(
            df[f"roll_std_{w}"].astype(float), s.shift(1).rolling(w, min_periods=2).std(), atol=1e-9
        )
    for h in features.HORIZONS:
        np.testing.assert_allclose(df[f"target_t_plus_{h}"].astype(float), s.shift(-h))
    previous = s.shift(1)
    np.testing.assert_allclose(df["mom_pct"].astype(float), (s / previous - 1).where(previous > 0))
    assert list(df["series_index"]) == list(range(len(values)))
    assert list(df["ready_for_model_h1"]) == list(s.shift(12).notna() & s.shift(-1).notna())
    np.testing.assert_allclose(df["month_sin"], np.sin(2 * np.pi * df["month"] / 12), atol=1e-12)


def test_targets_of_both_levels(spark):
    from tests.test_quality_tidy import frame, observation
    from prodseries.operators.tidy import tidy_observations

    facts = tidy_observations(
        frame(
            spark,
            observation("A", area="Lima", value=1.0),
            observation("B", area="Lima", value=2.0),
            observation("C", area="Junin", value=None),
            observation("T2", area="total", value=50.0),
            observation("T1", area="Total", value=40.0),
            observation("T0", area="Total", value=None),
        )
    )
    got = {(r.level, r.series_id): r.target_value for r in features.series_targets(facts).collect()}
    assert got == {
        ("nacional_mineral", "Cobre|tm.f"): 40.0,
        ("departamento_mineral", "Cobre|Lima|tm.f"): 3.0,
        ("departamento_mineral", "Cobre|Junin|tm.f"): 0.0,
    }


def test_one_shuffle_and_one_sort_for_all_features(spark):
    df = features.add_series_features(series(spark, [1.0, 2.0]), ["mineral", "unidad"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1 and "Python" not in plan
