"""The ledger of processed files finds new and changed files of the dates it is asked for, and lists no others."""

from datetime import date

import pytest

from railgauge.sources import ledger, tables

DAYS = [date(2024, 1, d) for d in (1, 2, 3)]


@pytest.fixture
def landing(tmp_path):
    def land(day, name, text="{}"):
        folder = tmp_path / "in" / f"poll_{day:%Y%m%d}_{name}"
        folder.mkdir(parents=True, exist_ok=True)
        (folder / "snapshot.json").write_text(text)
        return f"file:{folder}/snapshot.json"

    land.path, land.ledger = str(tmp_path / "in"), str(tmp_path / "ledger")
    return land


def states(df):
    return {r["source_file"]: r["state"] for r in df.collect()}


def test_new_then_known_then_changed(spark, landing):
    first, second = landing(DAYS[0], "000000"), landing(DAYS[1], "120000")
    found = ledger.open_files(spark, landing.path, landing.ledger, DAYS)
    assert states(found) == {first: "new", second: "new"}
    ledger.record_files(found.filter(found.source_file == first), landing.ledger)
    assert states(ledger.open_files(spark, landing.path, landing.ledger, DAYS)) == {second: "new"}
    ledger.record_files(ledger.open_files(spark, landing.path, landing.ledger, DAYS), landing.ledger)
    third = landing(DAYS[0], "001500")
    landing(DAYS[1], "120000", '{"other": 1}')
    assert states(ledger.open_files(spark, landing.path, landing.ledger, DAYS)) == {third: "new", second: "changed"}
    ledger.record_files(ledger.open_files(spark, landing.path, landing.ledger, DAYS), landing.ledger)
    assert states(ledger.open_files(spark, landing.path, landing.ledger, DAYS)) == {}


def test_only_the_dates_asked_for_are_listed(spark, landing, monkeypatch):
    for day in DAYS:
        landing(day, "000000")
    ledger.record_files(ledger.landed_files(spark, landing.path, DAYS), landing.ledger)
    late = landing(DAYS[2], "010000")
    asked, real = [], tables.list_files
    monkeypatch.setattr(ledger, "list_files", lambda spark, path, glob: asked.append(path) or real(spark, path, glob))
    found = ledger.open_files(spark, landing.path, landing.ledger, [DAYS[2]])
    assert states(found) == {late: "new"}
    assert asked == [f"{landing.path}/poll_20240103*"]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "2024-01-03" in plan and "event_date=2024-01-01" not in plan and "event_date=2024-01-02" not in plan


def test_nothing_landed(spark, landing):
    assert states(ledger.open_files(spark, landing.path, landing.ledger, DAYS)) == {}
    ledger.record_files(ledger.landed_files(spark, landing.path, DAYS), landing.ledger)
    assert states(ledger.open_files(spark, landing.path, landing.ledger, DAYS)) == {}
