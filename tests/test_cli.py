import json

import pytest

from ledgerloom import sources
from ledgerloom.__main__ import main
from ledgerloom.schema import RAW_FIELDS
from tests.test_ingest import PLAIN


def test_csv_to_published_files(spark, tmp_path, capsys):
    rows = [PLAIN | {"Day": str(d), "Amount": f"${d}.00"} for d in range(1, 6)]
    (tmp_path / "in.csv").write_text(
        "\n".join([",".join(RAW_FIELDS)] + [",".join(r[n] for n in RAW_FIELDS) for r in rows]) + "\n"
    )
    (tmp_path / "rates.json").write_text(json.dumps({"date": "2002-01-01", "usd": {"vnd": 25000}}))
    lake, warehouse, dest = (str(tmp_path / n) for n in ("lake", "warehouse", "out"))
    rates = ["--rates", str(tmp_path / "rates.json")]

    main(["ingest-csv", "--input", str(tmp_path / "in.csv"), "--lake", lake, "--batch", "b", *rates])
    assert sources.read_clean(spark, lake).count() == 5

    main(["send-csv", "--input", str(tmp_path / "in.csv"), "--format", "text", "--path", str(tmp_path / "topic")])
    main([
        "ingest-stream", "--format", "text", "--path", str(tmp_path / "topic"), "--lake", lake,
        "--checkpoint", str(tmp_path / "checkpoint"), "--available-now", *rates,
    ])
    assert sources.read_clean(spark, lake).count() == 10

    main(["daily", "--lake", lake, "--warehouse", warehouse, "--dest", dest])
    assert (tmp_path / "out" / "daily_summary.csv").read_text().count("\n") == 6
    main(["verify", "--dest", dest])
    assert "daily_summary" in capsys.readouterr().out


def test_ingest_time_decides_the_rate(spark, tmp_path):
    (tmp_path / "in.csv").write_text(",".join(RAW_FIELDS) + "\n" + ",".join((PLAIN | {"Amount": "$1.00"})[n] for n in RAW_FIELDS) + "\n")
    (tmp_path / "rates.json").write_text("\n".join(json.dumps({"date": d, "usd": {"vnd": v}}) for d, v in [("2002-01-01", 100), ("2003-01-01", 200)]))
    lake = str(tmp_path / "lake")
    for time, want in (("2002-06-01 00:00:00", 100), ("2004-01-01 00:00:00", 200)):
        main(["ingest-csv", "--input", str(tmp_path / "in.csv"), "--lake", lake, "--batch", "b", "--rates", str(tmp_path / "rates.json"), "--ingest-time", time])
        assert [r.amount_vnd for r in sources.read_clean(spark, lake).collect()] == [want]


def test_arguments_are_required():
    with pytest.raises(SystemExit):
        main(["send-csv", "--input", "x"])
    with pytest.raises(SystemExit):
        main(["daily"])
