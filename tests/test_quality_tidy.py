import datetime

import pytest

from prodseries.functions.measures import gap_class, round_half_even
from prodseries.operators import explore, quality, tidy
from prodseries.schemas import LONG_SCHEMA
from pyspark.sql import functions as F

D = datetime.date


def observation(code="C1", date=D(2024, 1, 1), mineral="Cobre", area="Lima", unit="tm.f", value=1.0, raw="Ene24", **kw):
    row = dict(
        source_dataset="s", period_raw=raw, period_date=date, year=date.year if date else None,
        month=date.month if date else None, series_code=code, series_description="d", mineral=mineral,
        departamento=area, unidad=unit, value=value, is_missing=False, is_invalid_numeric=False, value_raw="1",
    )
    row.update(kw)
    return tuple(row[c] for c in LONG_SCHEMA.fieldNames())


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), LONG_SCHEMA)


def statuses(rules):
    return {r.rule_id: (r.status, r.detail) for r in rules.collect()}


def test_clean_table_passes(spark):
    rules = quality.validation_rules(frame(spark, observation(), observation("C2")))
    assert {s for s, _ in statuses(rules).values()} == {"PASS"}
    assert quality.validation_verdict(rules).first().overall_status == "PASS"


def test_each_rule_fails_on_its_fault(spark):
    df = frame(
        spark,
        observation(),
        observation(),
        observation("C2", unit="oz", value=-1.0),
        observation("C3", month=13),
        observation("C4", date=None),
        observation("C5", value=float("nan"), is_missing=True),
    )
    got = statuses(quality.validation_rules(df))
    assert got["R02"] == ("PASS", "rows=6")
    assert got["R03"][0] == "FAIL" and '"value": 1' in got["R03"][1] and '"period_date": 1' in got["R03"][1]
    assert got["R04"] == ("FAIL", "invalid_period_date=1")
    assert got["R05"] == ("FAIL", "inconsistent_rows=2")
    assert got["R06"] == ("FAIL", "invalid_month_rows=2")
    assert got["R07"] == ("FAIL", "nan_values=1 negative_values=1")
    assert got["R08"] == ("FAIL", "duplicate_keys=1")
    assert got["R09"] == ("FAIL", "invalid_units=1")
    assert got["R10"] == ("FAIL", "is_missing_true=1 is_invalid_numeric_true=0")
    assert quality.validation_failures(quality.validation_rules(df)).count() == 8


def test_empty_and_incomplete_tables(spark):
    empty = statuses(quality.validation_rules(frame(spark)))
    assert empty["R02"] == ("FAIL", "rows=0") and empty["R08"][0] == "PASS"
    short = statuses(quality.validation_rules(frame(spark, observation()).drop("unidad").withColumn("x", F.lit(1))))
    assert short == {"R01": ("FAIL", "missing=['unidad'] extra=['x']"), "R02": ("PASS", "rows=1")}


def test_many_invalid_units_are_counted_and_listed(spark):
    df = spark.range(1005).select(F.concat(F.lit("u"), "id").alias("unidad"))
    assert quality._unit_rule(df).first().detail == "invalid_units=1005"
    assert quality.invalid_units(df).count() == 1005


def test_contract_counts_nulls_absent_fields_and_enums(spark):
    docs = spark.createDataFrame([("a", "bad"), (None, None)], "mineral string, gap_quality_flag string")
    contract = {
        "types": {"mineral": "string", "value": "number", "gap_quality_flag": "string"},
        "required": ["mineral", "value"],
        "enums": {"gap_quality_flag": ["ok", None]},
        "nullable": ["gap_quality_flag"],
    }
    got = {(r.field, r.rule): r.n_violations for r in quality.contract_violations(docs, "c", contract).collect()}
    assert got == {
        ("mineral", "required"): 0, ("value", "required"): 2, ("mineral", "type"): 1, ("value", "type"): 0,
        ("gap_quality_flag", "type"): 0, ("gap_quality_flag", "enum"): 1,
    }


def test_tidy_columns(spark):
    rows = tidy.tidy_observations(
        frame(spark, observation(area="TOTAL", value=2.0000005), observation("C2", area=None, date=None))
    ).orderBy("series_code").collect()
    assert (rows[0].period_yyyymm, rows[0].month_name_es, rows[0].quarter, rows[0].semester) == ("2024-01", "Enero", 1, 1)
    assert (rows[0].metric_level, rows[0].area_geografica) == ("total_oficial", "Nacional")
    assert rows[0].value_rounded_6 == 2.0  # halves go to the even neighbour
    assert rows[0].record_id == "2024-01|C1"
    assert (rows[1].semester, rows[1].is_total_departamento, rows[1].record_id) == (None, False, "nan|C2")


def test_gap_against_official_total(spark):
    facts = tidy.tidy_observations(
        frame(
            spark,
            observation("A", area="Lima", value=60.0),
            observation("B", area="Junin", value=30.0),
            observation("T2", area="Total", value=999.0),
            observation("T1", area="Total", value=None),
            observation("T3", area="Total", value=100.0),
            # Only a total: dropped. Only detail: no official value. A zero total: no percentage.
            observation("X", mineral="Oro", area="Total"),
            observation("Z", mineral="Zinc", value=None),
            observation("P", mineral="Plata", value=5.0),
            observation("PT", mineral="Plata", area="Total", value=0.0),
            # A NULL group key drops the row.
            observation("N", mineral=None, value=1e9),
        )
    )
    got = {r.mineral: r for r in tidy.agg_mineral_period(facts).collect()}
    assert set(got) == {"Cobre", "Zinc", "Plata"}
    cobre = got["Cobre"]
    # The first non-missing official value in (departamento, series_code) order is T2's.
    assert (cobre.dept_sum_value, cobre.n_departamentos, cobre.official_total_value) == (90.0, 2, 999.0)
    assert cobre.abs_gap_vs_total == 909.0
    assert (got["Zinc"].dept_sum_value, got["Zinc"].official_total_value) == (0.0, None)
    assert (got["Plata"].abs_gap_vs_total, got["Plata"].pct_gap_vs_total) == (-5.0, None)
    flags = explore.gap_flag_counts(tidy.agg_mineral_period(facts)).first()
    assert (flags.ok, flags.warning, flags.critical) == (0, 0, 3)


def test_two_spellings_of_a_month_stay_apart(spark):
    facts = tidy.tidy_observations(frame(spark, observation("A"), observation("B", raw="ene24", area="Junin")))
    assert tidy.agg_mineral_period(facts).count() == 2
    assert tidy.agg_departamento_period(facts).count() == 2


def test_gap_class_edges(spark):
    df = spark.createDataFrame([(1.0,), (1.1,), (5.0,), (5.1,), (None,), (float("nan"),)], "p double")
    assert [r[0] for r in df.select(gap_class(F.col("p"))).collect()] == [
        "ok", "warning", "warning", "critical", "critical", "critical",
    ]
    with pytest.raises(ValueError):
        gap_class(F.col("p"), 5, 5)


def test_rounding_matches_numpy(spark):
    import numpy as np

    values = [0.5e-6, 1.5e-6, 2.5e-6, -2.5e-6, 123.4567895, 1e20]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(round_half_even(F.col("v"), 6)).collect()] == list(np.round(values, 6))


def test_signals_default_when_nothing_matches(spark):
    facts = tidy.tidy_observations(frame(spark, observation(unit="kg.f")))
    assert tuple(explore.top_departamento(facts).first()) == ("n/a", 0.0)
    assert tuple(explore.top_mineral_unit(facts).first()) == ("n/a", 0.0)
    summary = explore.eda_summary(facts, tidy.agg_mineral_period(facts), tidy.agg_departamento_period(facts)).first()
    assert (summary.rows_tidy, summary.rows_official, summary.top_gap_mineral_label) == (1, 0, "Cobre")


def test_top_ties_go_to_the_first_name(spark):
    df = spark.createDataFrame([("b", 1.0), ("a", 1.0), ("c", None)], "name string, v double")
    assert [r.name for r in explore.top(df, "v", ["name"], 3).collect()] == ["a", "b", "c"]
