from pathlib import Path

import pytest

from layerloom.__main__ import main
from layerloom.plans import daily
from layerloom.schemas import USER
from layerloom.session import scratch_path
from layerloom.sinks.tables import read_partitions
from layerloom.sources import synthetic
from tests.test_streaming import BATCHES, put

DT = "2024-01-31"


@pytest.fixture(scope="module")
def root(spark):
    folder = scratch_path(spark, "line")
    made = synthetic.updated_tables(spark, DT, users=20, products=10, orders=30, details=40)
    for name, df in made.items():
        df.write.parquet(f"{folder}/source/{name}")
    main(["run-day", "--root", f"{folder}/house", "--source", f"{folder}/source", DT, "--use-digests"])
    return folder


def test_day_backfill_and_export(spark, root, rows, capsys):
    house = daily.Warehouse(spark, f"{root}/house")
    before = {t: rows(house.dws(t).drop("etl_time")) for t in daily.day_metrics(house, [DT], "x")}
    assert all(len(found) == 1 for found in before.values())
    main(["backfill", "--root", f"{root}/house"])
    assert {t: rows(house.dws(t).drop("etl_time")) for t in before} == before
    main(["check", "--root", f"{root}/house", "--source", f"{root}/source", DT])
    assert "false" not in capsys.readouterr().out
    main(["export", "--root", f"{root}/house", "--folder", f"{root}/csv", "--since", "2024-01-01"])
    assert len(list(Path(f"{root}/csv").glob("*/*.csv"))) == 4


def test_changes(spark, root):
    main(["import-changes", "--root", f"{root}/changes", "--source", f"{root}/source", DT])
    main(["import-changes", "--root", f"{root}/changes", "--source", f"{root}/source", DT])
    assert daily.Warehouse(spark, f"{root}/changes").ods("u_user").count() == 20


def test_ingest_and_replay(spark, root, tmp_path, rows):
    for n, lines in enumerate(BATCHES):
        put(tmp_path / "in", n, lines)
    line = ["ingest", "--root", f"{root}/cdc", "--checkpoint", str(tmp_path / "ck"), "--files", str(tmp_path / "in"), "--once"]
    main([*line, "--append-only"])
    path = f"{root}/cdc/dwd/{USER.dwd_name}"
    assert read_partitions(spark, path, USER.dwd_schema()).count() == 0
    main(["replay", "--root", f"{root}/cdc", "2024-01-01"])
    assert rows(read_partitions(spark, path, USER.dwd_schema()), "username") == [("a2",), ("b1",)]


def test_arguments_are_checked():
    with pytest.raises(SystemExit):
        main(["run-day"])
    with pytest.raises(SystemExit):
        main(["unknown", "--root", "x"])


def test_validation_and_configured_ingest(spark, root, tmp_path, capsys):
    main(["validate", "--root", f"{root}/house", DT])
    assert "repeated_key" in capsys.readouterr().out
    put(tmp_path / "in", 0, BATCHES[0])
    configs = tmp_path / "configs.txt"
    configs.write_text("# tables\nu_user|changes|users|id:BIGINT(20):user_id,name:STRING:username\n")
    line = ["ingest", "--root", f"{root}/configured", "--checkpoint", str(tmp_path / "ck"), "--files", str(tmp_path / "in"), "--once"]
    main([*line, "--configs", str(configs), "--rate", "1"])
    assert spark.read.parquet(f"{root}/configured/ods/users").count() == 2
