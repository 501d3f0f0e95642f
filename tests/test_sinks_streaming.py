import os

import pytest

import fixtures as FX
from ledgerlens.plans import analyses as A
from ledgerlens.sinks import result_path, run_folder, stage_table, write_result
from ledgerlens.sources import parse_transactions, read_result
from ledgerlens.streaming import start_monthly_stats


def test_result_round_trip_keeps_digits(spark, lines, tmp_path):
    tx = parse_transactions(lines(FX.TX))
    run = run_folder()
    assert ":" not in run
    path = write_result(A.monthly_total_value(tx), str(tmp_path), "q1_total", run)
    assert path == result_path(str(tmp_path), "q1_total", run)
    back = {r.month: r.total for r in read_result(spark, path, schema="month string, total string").collect()}
    assert back == {"08-2015": "84155363699941767867374649", "09-2015": "12"}


def test_run_id_must_be_hadoop_safe(tmp_path):
    with pytest.raises(ValueError):
        result_path(str(tmp_path), "x", "cw_02-12-2026_11:05:09")


def test_stage_table_partitioned(spark, lines, tmp_path):
    tx = parse_transactions(lines(FX.TX)).select("to_address", "value", "block_timestamp")
    tx = tx.withColumn("month", A.month_label(A.strict_int(tx.block_timestamp, "bigint")))
    path = stage_table(tx, str(tmp_path / "tx"), ["month"])
    assert sorted(d for d in os.listdir(path) if d.startswith("month=")) == ["month=08-2015", "month=09-2015"]
    assert spark.read.parquet(path).where("month = '09-2015'").count() == 3


def test_streaming_monthly_stats_equal_batch(spark, lines, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "part-1.csv").write_text("\n".join(FX.TX[:5]) + "\n")
    (src / "part-2.csv").write_text("\n".join(FX.TX[5:]) + "\n")
    q = start_monthly_stats(
        spark, str(src), "ledger_monthly_test", checkpoint=str(tmp_path / "ckpt"), available_now=True
    )
    q.awaitTermination(120)
    got = {r.month: (r.n, r.total) for r in spark.sql("SELECT * FROM ledger_monthly_test").collect()}
    want = {r.month: (r.n, r.total) for r in A.monthly_value_stats(parse_transactions(lines(FX.TX))).collect()}
    assert got == want


def test_checkpoint_dir_is_taken_from_the_session(spark):
    from ledgerlens.session import ensure_checkpoint_dir

    configured = spark.conf.get("spark.checkpoint.dir", None)
    got = ensure_checkpoint_dir(spark)
    if configured:
        assert got == configured
    else:
        assert got and got == spark.sparkContext.getCheckpointDir()


def test_command_line_runs_an_analysis_on_dump_files(spark, tmp_path):
    from ledgerlens.__main__ import main

    (tmp_path / "tx.csv").write_text("\n".join(FX.TX) + "\n")
    (tmp_path / "contracts.csv").write_text("\n".join(FX.CONTRACTS) + "\n")
    args = ["top_contracts_by_value", "--transactions", str(tmp_path / "tx.csv"),
            "--contracts", str(tmp_path / "contracts.csv"), "--out", str(tmp_path / "out"),
            "--run-id", "run_1"]
    assert main(args) == 0
    back = read_result(spark, str(tmp_path / "out" / "run_1" / "top_contracts_by_value"),
                       schema="address string, total string").collect()
    assert sorted((r.address, r.total) for r in back) == [("0xc1", "84155363699941767867374649")] * 2


def test_publishing_on_an_existing_folder(spark, tmp_path):
    from ledgerlens.sinks import path_exists, publish

    target = str(tmp_path / "stage" / "kind")
    rows = lambda n: spark.range(n).selectExpr("cast(id as string) AS value")
    publish(spark, rows(5), target, "text")
    assert path_exists(spark, target + "/_SUCCESS")
    with pytest.raises(FileExistsError):
        publish(spark, rows(7), target, "text")
    assert spark.read.text(target).count() == 5
    publish(spark, rows(7), target, "text", existing="keep")
    assert spark.read.text(target).count() == 5
    publish(spark, rows(7), target, "text", existing="overwrite")
    assert spark.read.text(target).count() == 7
    # a half-written folder is no result: it is replaced
    os.remove(tmp_path / "stage" / "kind" / "_SUCCESS")
    publish(spark, rows(3), target, "text", existing="keep")
    assert spark.read.text(target).count() == 3
    assert not [p for p in os.listdir(tmp_path / "stage") if ".tmp-" in p]
    assert not [p for p in os.listdir(target) if ".tmp-" in p]


def test_staging_again_fails_or_replaces(spark, tmp_path):
    from ledgerlens.__main__ import main

    dump = tmp_path / "tx.csv"
    args = ["stage", "--transactions", str(dump), "--out", str(tmp_path / "staged")]
    dump.write_text("\n".join(FX.TX[:3]) + "\n")
    assert main(args) == 0
    first = spark.read.parquet(str(tmp_path / "staged" / "transactions")).count()
    dump.write_text("\n".join(FX.TX) + "\n")
    with pytest.raises(FileExistsError):
        main(args)
    assert main([*args, "--overwrite"]) == 0
    assert spark.read.parquet(str(tmp_path / "staged" / "transactions")).count() > first


def test_a_table_that_changes_under_its_path_changes_the_answer(spark, tmp_path):
    import shutil

    from ledgerlens.plans.registry import QUERIES

    source = "/root/testdata/sf0.001"
    if not os.path.isdir(source):
        pytest.skip("supplied tables missing")
    for name in ("lineitem", "supplier"):
        shutil.copy(f"{source}/{name}.parquet", tmp_path / f"{name}.parquet")
    whole = QUERIES["series_total"](spark, str(tmp_path)).first().total
    import pyarrow.parquet as pq

    os.chmod(tmp_path / "lineitem.parquet", 0o644)
    pq.write_table(pq.read_table(f"{source}/lineitem.parquet").slice(0, 100), tmp_path / "lineitem.parquet")
    assert 0 < QUERIES["series_total"](spark, str(tmp_path)).first().total <= 100 < whole


def test_an_epoch_is_replaced(spark, lines, tmp_path):
    from ledgerlens.streaming import latest_epoch, start_monthly_stats_to_files

    src, out = tmp_path / "in", str(tmp_path / "out")
    src.mkdir()
    for k, rows in enumerate((FX.TX[:4], FX.TX)):
        (src / "part.csv").write_text("\n".join(rows) + "\n")
        q = start_monthly_stats_to_files(spark, str(src), out, f"ledger_epoch_{k}", checkpoint=str(tmp_path / f"c{k}"), available_now=True)
        q.awaitTermination(120)
    got = read_result(spark, latest_epoch(spark, out), schema="month string, n long, total string, avg double")
    assert {r.month: r.n for r in got.collect()} == {"08-2015": 3, "09-2015": 3}


def test_object_store_settings():
    from ledgerlens.session import object_store_conf

    conf = object_store_conf("http://store:9000", "key", "secret", path_style=False)
    assert conf == {
        "spark.hadoop.fs.s3a.endpoint": "http://store:9000",
        "spark.hadoop.fs.s3a.access.key": "key",
        "spark.hadoop.fs.s3a.secret.key": "secret",
        "spark.hadoop.fs.s3a.path.style.access": "false",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": "false",
    }


def test_streaming_resumes_from_its_checkpoint(spark, lines, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    ckpt = str(tmp_path / "ckpt")
    (src / "part-1.csv").write_text("\n".join(FX.TX[:4]) + "\n")
    q = start_monthly_stats(spark, str(src), "ledger_resume_a", checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    first = {r.month: r.n for r in spark.sql("SELECT * FROM ledger_resume_a").collect()}
    assert first == {"08-2015": 2, "09-2015": 1}
    (src / "part-2.csv").write_text("\n".join(FX.TX[4:]) + "\n")
    q = start_monthly_stats(spark, str(src), "ledger_resume_b", checkpoint=ckpt, available_now=True)
    q.awaitTermination(120)
    second = {r.month: r.n for r in spark.sql("SELECT * FROM ledger_resume_b").collect()}
    assert second == {"08-2015": 3, "09-2015": 3}  # state carried over, part-1 not re-read


def test_command_line_stage_then_typed_run(spark, tmp_path):
    from ledgerlens.__main__ import main

    (tmp_path / "tx.csv").write_text("\n".join(FX.TX) + "\n")
    (tmp_path / "reg.json").write_text("\n".join(FX.REGISTRY) + "\n")
    assert main(["stage", "--transactions", str(tmp_path / "tx.csv"), "--registry", str(tmp_path / "reg.json"),
                 "--out", str(tmp_path / "staged")]) == 0
    assert main(["most_lucrative_scam", "--typed", "--transactions", str(tmp_path / "staged" / "transactions"),
                 "--registry", str(tmp_path / "staged" / "registry"), "--out", str(tmp_path / "out"),
                 "--run-id", "r"]) == 0
    back = read_result(spark, str(tmp_path / "out" / "r" / "most_lucrative_scam"), schema="id long, total string")
    assert [(r.id, r.total) for r in back.collect()] == [(1, "12")]


def test_streaming_to_files_publishes_each_epoch(spark, lines, tmp_path):
    from ledgerlens.streaming import start_monthly_stats_to_files

    src = tmp_path / "in"
    src.mkdir()
    (src / "part-1.csv").write_text("\n".join(FX.TX) + "\n")
    out = tmp_path / "out"
    q = start_monthly_stats_to_files(spark, str(src), str(out), "ledger_files_test",
                                     checkpoint=str(tmp_path / "ckpt"), available_now=True)
    q.awaitTermination(120)
    epochs = sorted(p for p in os.listdir(out) if p.startswith("epoch="))
    assert epochs
    latest = read_result(spark, str(out / epochs[-1]), schema="month string, n long, total string, avg double")
    assert {r.month: (r.n, r.total) for r in latest.collect()} == {
        "08-2015": (3, "84155363699941767867374649"), "09-2015": (3, "12")}
