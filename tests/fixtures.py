"""Source files in the shapes the models expect, made for the tests."""

import json
from pathlib import Path

from siltbed.plans.emissions import CDP_HEADER


def company(n, isin, periods, **more):
    return {
        "company_id": f"C{n}",
        "company_name": f"Company {n}",
        "isin": isin,
        "lei": f"LEI{n}",
        "country_of_incorporation": "DE",
        "primary_sector": "Automobiles" if n % 2 else "IT",
        **({"reporting_periods": periods} if periods is not ... else {}),
        **more,
    }


def period(year, scope_1, location=None, scope_3=None):
    return {
        "reporting_year": year,
        "reporting_framework": "GRI",
        "verification_status": "limited",
        "scope_1": {"value": scope_1, "unit": "tCO2e"},
        "scope_2_location_based": {"value": location, "unit": "tCO2e"} if location is not None else None,
        "scope_2_market_based": None,
        "scope_3": {"total": scope_3} if scope_3 is not None else None,
        "net_zero_target": {"target_year": 2040} if year == 2023 else None,
    }


def isin(n):
    return f"DE{n:09d}0"


def write_json_source(folder: Path, companies: int = 30) -> Path:
    data = [
        company(n, isin(n), [period(year, 1000 * n + year, 10 * n, 5 * n if n % 3 else None) for year in (2021, 2022, 2023)])
        for n in range(1, companies + 1)
    ]
    folder.mkdir(parents=True, exist_ok=True)
    wrapper = {"status": "ok", "total_records": len(data), "source": "registry", "data": data}
    (folder / "companies.json").write_text(json.dumps(wrapper))
    return folder


def survey_line(n, year, known=True, scope_1="12.5", unit="metric tons CO2e"):
    cells = [f"A-{n}-{year}", f"Survey {n}", "Banking", "Banks", "DE", isin(n).lower() if known else "", str(year)]
    return ",".join([*cells, scope_1, "", "", "", unit, "self", "B", "Yes"])


def write_csv_source(folder: Path, end: str = "\n") -> Path:
    """100 lines: 60 with identifier, 40 without; 11 without scope 1, 6 of them identified."""
    lines = []
    for i in range(100):
        known = i < 60
        empty = i < 6 or 60 <= i < 65
        lines.append(survey_line(1 + i // 2, 2022 + i % 2, known, "" if empty else f"{i}.25"))
    folder.mkdir(parents=True, exist_ok=True)
    (folder / "survey.csv").write_bytes((end.join([CDP_HEADER, *lines]) + end).encode())
    return folder


def prices_json(records, **wrapper):
    return json.dumps({"source_system": "fundsys", "source_version": "v1", "record_count": len(records), **wrapper, "records": records})


def price(isin_, day, nav, currency="EUR"):
    return {"isin": isin_, "fund_name": f"Fund {isin_}", "business_date": day, "nav": nav, "currency": currency}
