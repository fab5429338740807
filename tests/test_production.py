"""The whole monthly run on a small delimited sheet."""

import csv
import json
import math

import pytest

from prodseries.plans.production import MonthlyRun, QualityError, Settings
from prodseries.schemas import MONTH_ABBREVIATIONS
from prodseries.sources.sheets import read_sheet

MONTHS = 48  # 2022-01 .. 2025-12
AREAS = {"Lima": 100.0, "Junín": 60.0, "Total": 162.0}


def write_sheet(path, broken=False):
    columns = [(m, a) for m in ("Cobre", "Oro") for a in AREAS]
    with open(path, "w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out)
        writer.writerow(["", *[f"{m}_{a}" for m, a in columns]])
        writer.writerow(["", *[f"Producción - {m} - {a} ({'TM.F' if m == 'Cobre' else 'grs.f'})" for m, a in columns]])
        for i in range(MONTHS):
            token = MONTH_ABBREVIATIONS[i % 12].capitalize() + str(22 + i // 12)
            wave = 1 + 0.2 * math.sin(i * math.pi / 6) + 0.01 * i + 0.03 * math.sin(i * i)
            cells = [f"{AREAS[a] * wave * (1 if m == 'Cobre' else 5):,.3f}" for m, a in columns]
            if broken and i == 3:
                cells[0] = "abc"
            if i == 5:
                cells[1] = "n.d."
            writer.writerow([token, *cells])


def settings(**kw):
    return Settings(source_dataset="sheet.csv", now="2026-01-15 00:00:00", load_strategy="full_refresh", **kw)


def read_json(folder):
    (part,) = folder.glob("part-*.json")
    return [json.loads(line) for line in part.read_text().splitlines()]


def test_monthly_run(spark, tmp_path):
    write_sheet(tmp_path / "sheet.csv")
    root = tmp_path / "run"
    run = MonthlyRun(spark, str(root), settings())
    counters = run.run(read_sheet(spark, str(tmp_path / "sheet.csv")))
    assert counters["facts"]["upserted_count"] == MONTHS * 6 - 1
    # Two minerals; two departments in two units, less the one month without a value.
    assert counters["aggregates"]["upserted_count"] == MONTHS * 2 + MONTHS * 4 - 1
    assert counters["predictions"]["upserted_count"] == 6

    report = read_json(root / "reports/cleaning")[0]
    assert report["rows_after_dedup"] == MONTHS * 6 and report["rows_missing_semantic"] == 1
    assert run.table("processed/eval_predictions").count() == 6 * 4 * 3
    executive = run.table("processed/operational_executive")
    assert executive.columns[-11:] == [f"2026-{m:02d}" for m in range(2, 13)]
    assert executive.count() == 6
    assert executive.dropna().count() == 6
    documents = run.table("published/predictions").collect()
    assert {d.source.selection_mode for d in documents} == {"series_mae_dynamic"}
    assert {d.forecast_window_months for d in documents} == {11}
    assert run.table("charts/smoothed_trend").count() == 3
    assert run.table("reports/invalid_units").count() == 0
    load = read_json(root / "reports/load_facts")[0]
    assert load["selected_rows"] == MONTHS * 6 - 1 and load["strategy"] == "full_refresh" and not load["dry_run"]
    assert load["upserted_count"] == MONTHS * 6 - 1
    assert run.table("reports/contract_facts").filter("rule = 'type'").agg({"n_violations": "max"}).first()[0] == 0
    operational = read_json(root / "reports/operational_forecast")[0]
    assert operational["rows"] == {"operational_forecast": 66, "operational_executive": 6, "operational_skipped": 0}
    assert operational["forecast_window"]["months"] == 11 and len(operational["selected_models"]) == 2

    # A second load of the newest month changes nothing but its stamps.
    again = MonthlyRun(
        spark, str(root), Settings(source_dataset="sheet.csv", now="2026-02-15 00:00:00", load_strategy="incremental")
    )
    assert again.publish_facts()["facts"] == {
        "n_operations": 6, "matched_count": 6, "modified_count": 6, "upserted_count": 0,
    }
    load = read_json(root / "reports/load_facts")[0]
    assert load["selected_rows"] == 6 and load["input_rows"] == MONTHS * 6 - 1 and load["selected_period"]

    # A dry run reports what it would load and writes nothing.
    before = run.table("published/facts").count()
    dry = MonthlyRun(spark, str(root), settings(dry_run=True))
    assert dry.publish_facts()["facts"]["n_operations"] == 0
    assert read_json(root / "reports/load_facts")[0]["dry_run"]
    facts = run.table("published/facts")
    assert facts.count() == before
    assert facts.count() == MONTHS * 6 - 1
    assert facts.filter("updated_at > timestamp_ntz'2026-02-01 00:00:00'").count() == 6
    assert facts.filter("ingested_at > timestamp_ntz'2026-02-01 00:00:00'").count() == 0


def test_failed_quality_stops_the_run(spark, tmp_path):
    write_sheet(tmp_path / "sheet.csv", broken=True)
    run = MonthlyRun(spark, str(tmp_path / "run"), settings())
    with pytest.raises(QualityError, match="3 of 10"):
        run.run(read_sheet(spark, str(tmp_path / "sheet.csv")))
    assert not (tmp_path / "run/processed").exists()
    failed = {r.rule_id for r in run.table("reports/validation_failures").collect()}
    assert failed == {"R03", "R07", "R10"}
