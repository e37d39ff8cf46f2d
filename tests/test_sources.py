from __future__ import annotations

import datetime as dt
import json
from pathlib import Path

import pytest

from rollcall import operators as op
from rollcall import sources
from rollcall.plans import master_feeds, publish
from rollcall.rules import Settings
from rollcall.schemas import ANALYTICS_COLUMNS, CRM_RAW, MASTER_COLUMNS

AT = dt.datetime(2024, 7, 1, 12, 30, 45)


def test_columns_bind_by_position(spark, tmp_path):
    path = tmp_path / "crm.csv"
    path.write_text(
        "a,b,c,d,e,f,g,h,i,j\n"
        'C1, Ann ,"Lee, Jr",,"",1 St,Leeds,UK,2020-01-01,2021-01-01\n'
        "C2,Bob\n"
        "C3,1,2,3,4,5,6,7,8,9,extra\n"
    )
    rows = {r.customer_id: r for r in sources.read_crm(spark, str(path)).collect()}
    assert (rows["C1"].first_name, rows["C1"].last_name) == (" Ann ", "Lee, Jr")
    assert (rows["C1"].email, rows["C1"].phone) == (None, None)
    assert rows["C2"].last_name is rows["C2"].last_updated is None
    assert rows["C3"].last_updated == "9"


def test_feeds_survive_a_round_trip(spark, crm_raw, trx_raw, tmp_path):
    for raw, read in ((crm_raw, sources.read_crm), (trx_raw, sources.read_transactions)):
        path = str(tmp_path / read.__name__)
        sources.write_feed(raw, path)
        back = read(spark, path)
        assert back.schema == raw.schema
        assert sorted(map(repr, back.collect())) == sorted(map(repr, raw.collect()))


def test_staged_tables_go_with_their_run(spark, crm_raw, tmp_path):
    for given, where in ((None, spark.conf.get("spark.checkpoint.dir")), (str(tmp_path), str(tmp_path))):
        with sources.Scratch(spark, given) as scratch:
            staged = scratch.stage(crm_raw, "crm")
            assert staged.schema == CRM_RAW
            assert where in staged.inputFiles()[0]
            assert sorted(map(repr, staged.collect())) == sorted(map(repr, crm_raw.collect()))
            assert sources.Scratch(spark, given).folder != scratch.folder
        assert not Path(scratch.folder).exists()


def test_a_folder_must_be_named():
    class Session:
        conf = {}

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        sources.Scratch(Session())


def test_main_leaves_nothing_staged(spark, crm_raw, trx_raw, tmp_path, monkeypatch, capsys):
    from rollcall import __main__ as program

    for raw, name in ((crm_raw, "crm"), (trx_raw, "trx")):
        sources.write_feed(raw, str(tmp_path / name))
    (tmp_path / "scratch").mkdir()
    arguments = {"crm": "crm", "transactions": "trx", "layers": "layers", "reports": "reports", "scratch": "scratch"}
    line = ["rollcall"] + [x for k, v in arguments.items() for x in (f"--{k}", str(tmp_path / v))]
    monkeypatch.setattr("sys.argv", line)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    program.main()
    assert "name_address" in capsys.readouterr().out
    assert list((tmp_path / "scratch").iterdir()) == []
    assert len(list((tmp_path / "reports").rglob("*.json"))) == 3


def test_report_is_a_json_document(crm_raw, tmp_path):
    report = op.profile(op.clean_crm(crm_raw), "CRM", at=AT)
    path = sources.write_report(report, str(tmp_path), "CRM", AT)
    assert path == f"{tmp_path}/01-07-24/CRM_data_quality_report_20240701_123045.json"
    text = Path(path).read_text()
    assert [p.name for p in Path(path).parent.iterdir() if not p.name.startswith(".")] == [Path(path).name]
    assert text.count("\n") > 20
    saved = json.loads(text)
    assert list(saved) == [
        "source", "total_records", "generated_at", "column_count", "completeness",
        "format_validity", "uniqueness", "freshness",
    ]
    assert saved["completeness"]["city"]["completeness_percentage"] == 80.0
    assert saved["freshness"] == {
        "column": "last_updated", "min_date": "2024-01-01", "max_date": "2024-03-01",
    }


@pytest.mark.parametrize("staged", [False, True])
def test_whole_batch(spark, crm_raw, trx_raw, tmp_path, staged):
    scratch = sources.Scratch(spark) if staged else None
    run = master_feeds(crm_raw, trx_raw, as_of=dt.date(2024, 6, 30), at=AT, scratch=scratch)
    done = publish(run, str(tmp_path / "layers"), str(tmp_path / "reports"), at=AT)
    full = spark.read.parquet(str(tmp_path / "layers" / "gold_raw"))
    subset = spark.read.parquet(str(tmp_path / "layers" / "ba_gold"))
    assert full.columns == list(MASTER_COLUMNS)
    assert subset.columns == list(ANALYTICS_COLUMNS)
    assert sorted(map(repr, subset.collect())) == sorted(
        map(repr, full.select(*ANALYTICS_COLUMNS).collect())
    )
    assert {r["match_type"]: r["count"] for r in done.stats.collect()} == {
        "email": 1, "phone": 1, "name_address": 1, None: 2,
    }
    names = [Path(p).name.split("_")[0] for p in done.reports]
    assert names == ["CRM", "TRX", "GOLDEN"]
    assert all(json.loads(Path(p).read_text())["total_records"] for p in done.reports)


def test_settings_from_a_mapping():
    settings = Settings.from_mapping(
        {
            "reconciliation": {
                "match_keys": ["email"],
                "confidence_scoring": {"phone_match": 0.4},
                "confidence_threshold": 0.45,
            },
            "data_quality": {"email_pattern": "@", "columns_to_check": ["city"]},
        }
    )
    assert [r.confidence for r in settings.match_rules] == [1.0, 0.4, 0.6]
    assert settings.confidence_threshold == 0.45
    assert settings.profile.columns == ("city",)
    assert settings.profile.formats[0] == ("email", "normalized_email", "@")
    assert Settings.from_mapping({}) == Settings()


def test_lines_that_do_not_fit_are_set_apart(spark, tmp_path):
    head = ",".join(CRM_RAW.names)
    good = "C1,Ann,Lee,a@x.org,1,\"1, High St\",Leeds,UK,2020-01-01,2020-01-02"
    (tmp_path / "one.csv").write_bytes(f"{head}\n{good}\n{good},extra\nC2,too,few\n".encode())
    (tmp_path / "two.csv").write_bytes(f"{head}\n".encode() + good.replace("Ann", "\u00c4nn").encode("latin-1") + b"\n")
    found = sources.read_sifted(spark, str(tmp_path), CRM_RAW)
    assert [(r.customer_id, r.address) for r in found.rows.collect()] == [("C1", "1, High St")]
    assert found.rows.columns == CRM_RAW.names
    rejects = sorted((r.file.rsplit("/")[-1], r.reason, r.line[:6]) for r in found.rejects.collect())
    assert rejects == [("one.csv", "columns", "C1,Ann"), ("one.csv", "columns", "C2,too"), ("two.csv", "encoding", "C1,\ufffdnn")]
    # Counting needs no column, and still counts right.
    assert (found.rows.count(), found.rejects.count()) == (1, 3)
