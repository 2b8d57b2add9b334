"""Both data products from files to their last table, with known counts."""

from decimal import Decimal

import pytest
from fixtures import isin, price, prices_json, survey_line, write_csv_source, write_json_source
from pyspark.sql import functions as F

from siltbed.operators.checks import run_checks
from siltbed.operators.expectations import statistics, validate
from siltbed.operators.merge import compare_sources
from siltbed.plans import emissions, prices
from siltbed.plans.layers import Layers
from siltbed.plans.models import emission_models, price_models
from siltbed.plans.record_loads import load_country_emissions, load_fund_master, load_fund_positions
from siltbed.sources.files import PROVENANCE, Run, ingest, read_files
from siltbed.sources.tables import VersionedTable, partition_stats

RUN = Run("run", "2026-01-05T08:00:00Z")


@pytest.fixture(scope="module")
def built(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("emissions")
    layers = Layers(spark, str(root / "layers"))
    models = emission_models(
        spark, str(write_csv_source(root / "csv", "\r\n")), str(write_json_source(root / "json")), RUN
    )
    layers.build_to(models, "trusted")
    return layers, models


def counts(layers, models):
    return {f"{r['layer']}.{r['table_name']}": r["row_count"] for r in layers.row_counts(models).collect()}


FULL = {
    "raw.cdp": 1,
    "raw.nzdpu": 1,
    "staging.cdp": 100,
    "staging.nzdpu": 90,
    "curated.companies": 30,
    "curated.emissions": 150,
    "trusted.emissions": 150,
}


def test_row_counts_per_layer(built):
    assert counts(*built) == FULL


def test_staging_profile(built):
    staged = built[0].read("staging.cdp")
    found = staged.agg(
        F.count_if(F.col("isin").isNull()),
        F.count_if(F.col("scope_1_tco2e").isNull()),
        F.count_if(F.col("isin").isNotNull() & F.col("scope_1_tco2e").isNull()),
        F.min("row_number"),
        F.max("row_number"),
        F.count_if(F.col("public_disclosure") == "Yes"),
    ).first()
    assert tuple(found) == (40, 11, 6, 2, 101, 100)


def test_curated_values(built):
    curated = built[0].read("curated.emissions")
    assert dict(curated.dtypes)["scope_1_tco2e"] == "decimal(18,3)"
    row = curated.filter((F.col("isin") == isin(5)) & (F.col("reporting_year") == 2022)).orderBy("source_system").collect()
    assert [(r["source_system"], r["scope_1_tco2e"]) for r in row] == [("cdp", Decimal("8.250")), ("nzdpu", Decimal("7022.000"))]
    both = compare_sources(curated, ["isin", "reporting_year"], "source_system", "scope_1_tco2e", "cdp", "nzdpu")
    assert both.count() == 54
    companies = built[0].read("curated.companies")
    assert companies.filter("preferred_source = 'nzdpu' AND lei IS NOT NULL").count() == 30
    assert {r[0] for r in companies.select("primary_sector").distinct().collect()} == {"Industrials", "Technology"}


def test_provenance_reaches_the_last_layer(built):
    layers, _ = built
    raw = layers.read("raw.cdp").select("ingestion_id", "source_file_hash", "ingestion_timestamp")
    trusted = layers.read("trusted.emissions").filter("source_system = 'cdp'")
    assert trusted.select(*raw.columns).distinct().collect() == raw.collect()
    assert set(PROVENANCE) <= set(layers.read("staging.nzdpu").columns)


def test_declared_tests_and_suite(built):
    layers, models = built
    report = layers.test(models)
    red = [(r["layer"], r["check"], r["column"], r["failures"]) for r in report.filter("not success").collect()]
    assert red == [("trusted", "not_null", "scope_1_tco2e", 6)]
    assert report.count() == 8 + 8 + 6 + 8 + 5 + 8 + 8
    assert statistics(validate(layers.read("curated.emissions"), emissions.CURATED_SUITE)).first()["success"]


def test_quoted_and_plain_csv_agree(built):
    raw = built[0].read("raw.cdp")
    quoted, plain = emissions.stage_cdp(raw), emissions.stage_cdp(raw, quoted=False)
    assert quoted.exceptAll(plain).count() == 0 and plain.exceptAll(quoted).count() == 0


def test_states(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    models = emission_models(spark, str(write_csv_source(tmp_path / "c")), str(write_json_source(tmp_path / "j", 3)), RUN)
    assert set(counts(layers, models).values()) == {0}
    layers.build_to(models, "curated")
    assert counts(layers, models)["trusted.emissions"] == 0 and counts(layers, models)["curated.companies"] == 30
    version = layers.table("raw.cdp").entry()["version"]
    layers.build_to(models, "raw", rebuild=False)
    assert [k for k, n in counts(layers, models).items() if n] == ["raw.cdp", "raw.nzdpu"]
    assert layers.table("raw.cdp").entry()["version"] == version
    layers.build_to(models, "raw")
    assert layers.table("raw.cdp").entry()["version"] == version + 1
    layers.build_to(models, None)
    assert set(counts(layers, models).values()) == {0}


def test_blank_identifiers_count_as_missing(spark, tmp_path):
    (tmp_path / "s.csv").write_text(emissions.CDP_HEADER + "\n" + survey_line(1, 2022).replace(isin(1).lower(), "  ") + "\n")
    staged = emissions.stage_cdp(ingest(read_files(spark, str(tmp_path)), emissions.CDP_FILES, RUN))
    nothing = emissions.stage_nzdpu(spark.createDataFrame([], "raw_payload string, " + ", ".join(f"{c} string" for c in PROVENANCE)))
    assert staged.count() == 1
    assert emissions.curate_emissions(nothing, staged).count() == 0
    assert emissions.curate_companies(nothing, staged).count() == 0
    loose = emissions.curate_emissions(nothing, staged, strict=False)
    assert [r["isin"] for r in loose.collect()] == [None]


def weekdays(n):
    from datetime import date, timedelta

    days, day = [], date(2026, 1, 5)
    while len(days) < n:
        if day.weekday() < 5:
            days.append(day.isoformat())
        day += timedelta(days=1)
    return days


def test_fund_prices_with_a_correction(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    records = [price(f"F{f}", day, 127.49 if f == 0 else float(f)) for f in range(5) for day in weekdays(90)]
    (folder / "load1.json").write_text(prices_json(records))
    layers = Layers(spark, str(tmp_path / "layers"))
    first_run = price_models(spark, str(folder), Run("r1", "2026-05-01T06:00:00Z"))
    layers.build_to(first_run, "staging")
    staged = layers.read("staging.prices")
    assert (layers.read("raw.prices").count(), staged.count()) == (1, 450)

    table = layers.table("curated.prices_history")
    prices.record_prices(table, staged, F.lit("2026-05-01 07:00:00").cast("timestamp"))
    assert prices.read_history(table).count() == 450

    # The correction arrives as a second file of a later run.
    second = tmp_path / "correction"
    second.mkdir()
    (second / "load2.json").write_text(
        prices_json([price("F0", "2026-04-20", 126.81)], correction_reason="late trade")
    )
    raw = layers.table("raw.prices")
    later = price_models(spark, str(second), Run("r2", "2026-05-02T06:00:00Z"))[0].build()
    raw.append(later)
    assert [raw.read(v).count() for v in (1, 2)] == [1, 2]
    before = layers.table("staging.prices").entry()
    layers.extend(first_run[1])
    entry = layers.table("staging.prices").entry()
    assert (entry["operation"], entry["summary"]["added-records"], entry["parts"][:1]) == ("append", "1", before["parts"])
    assert layers.extend(first_run[1]) == entry["version"]
    staged = layers.read("staging.prices")
    assert staged.count() == 451
    for run_at in ("2026-05-02 07:00:00", "2026-05-03 07:00:00", "2026-05-04 07:00:00"):
        prices.record_prices(table, staged, F.lit(run_at).cast("timestamp"))
    found = prices.read_history(table)
    assert (found.count(), found.filter("valid_to IS NULL").count()) == (451, 450)
    corrected = found.filter("isin = 'F0' AND business_date = '2026-04-20'").orderBy("valid_from").collect()
    assert [(r["nav"], r["valid_to"] is None) for r in corrected] == [(127.49, False), (126.81, True)]
    assert run_checks(found, prices.HISTORY_CHECKS).filter("not success").count() == 0
    assert run_checks(staged, prices.STAGING_CHECKS).filter("not success").count() == 0
    assert len(prices.HISTORY_CHECKS) == 7
    fresh = layers.table("staging.prices").added_since(before["version"])
    assert fresh.count() == 1
    prices.record_prices(table, fresh, F.lit("2026-05-05 07:00:00").cast("timestamp"))
    assert prices.read_history(table).count() == 451
    raw.delete_where(F.col("ingestion_id") == "r2")
    layers.extend(first_run[1])
    assert layers.read("staging.prices").count() == 450

    # Back to the first load: a new history starts from it.
    layers.build_to(first_run, "staging")
    assert layers.read("staging.prices").count() == 450


def test_record_loads(spark, tmp_path):
    (tmp_path / "m.csv").write_text(
        "fund_isin,fund_wkn,fund_name,fund_type,currency,inception_date,domicile\nDE1,W,Fund,Equity,EUR,2001-02-03,DE\n"
    )
    (tmp_path / "p.csv").write_text(
        "fund_isin,holding_isin,weight_pct,position_date\nDE1,X,40.5,2023-12-31\nDE1,Y,59.5,2023-12-31\nDE1,Y,100,2024-06-30\n"
    )
    (tmp_path / "c.csv").write_text("country,year,co2\nGermany,2020,600.5\nFrance,2021,300\n")
    tables = [VersionedTable(spark, str(tmp_path / name)) for name in ("master", "positions", "countries")]
    load_fund_master(spark, str(tmp_path / "m.csv"), tables[0])
    load_fund_positions(spark, str(tmp_path / "p.csv"), tables[1])
    load_country_emissions(spark, str(tmp_path / "c.csv"), tables[2])
    assert str(tables[0].read().first()["inception_date"]) == "2001-02-03"
    stats = {str(r["position_date"]): r["record_count"] for r in partition_stats(tables[1].read(), ["position_date"]).collect()}
    assert stats == {"2023-12-31": 2, "2024-06-30": 1}
    assert dict(tables[2].read().dtypes) == {"country": "string", "co2": "double", "year": "int"}


def test_history_is_a_model_with_tests_and_a_reset(spark, tmp_path):
    folder = tmp_path / "prices"
    folder.mkdir()
    (folder / "load1.json").write_text(prices_json([price("F1", "2026-01-05", 1.0), price("F2", "2026-01-05", 2.0)]))
    layers = Layers(spark, str(tmp_path / "layers"))
    models = price_models(spark, str(folder), Run("r1", "2026-05-01T06:00:00Z"))
    layers.build_to(models, "curated")
    layers.build_to(models, "curated")
    assert counts(layers, models) == {"raw.prices": 1, "staging.prices": 2, "curated.prices_history": 2}
    report = layers.test(models)
    assert report.filter("table_name = 'prices_history'").count() == len(prices.HISTORY_CHECKS) == 7
    assert report.filter("NOT success").count() == 0
    layers.build_to(models, None)
    assert set(counts(layers, models).values()) == {0}
    layers.build_to(models, "curated")
    assert counts(layers, models)["curated.prices_history"] == 2
