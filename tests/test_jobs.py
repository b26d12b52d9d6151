"""The jobs end to end: messages in, graph out, every step from its command line."""

import subprocess
import sys
from pathlib import Path

import pytest

from covisit import fixtures as fx
from covisit.jobs import main, parser
from covisit.plans.click_window import latest_clicks
from covisit.plans.ingest import ingest_actions
from covisit.plans.similarity import item_similarity
from covisit.sources import graph_store
from covisit.sources.messages import read_files
from covisit.sources.tables import DayTaken, _claim_path, claimed_day, create_text


def same(left, right):
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_pipeline(spark, sf, tmp_path):
    def job(line):
        return main(line.split(), spark)

    raw = tmp_path / "raw"
    fx.raw_messages(spark, sf, damaged=True).write.parquet(str(raw))
    accepted, rejected = ingest_actions(read_files(spark, str(raw)), "20240130")

    job("init --db dwd")
    line = f"ingest --path {raw} --p-date 20240130 --bad-records-path {tmp_path}/bad"
    counts = {"accepted": accepted.count(), "rejected": rejected.count()}
    assert job(line) == counts
    assert job(line) == counts  # again: the same table
    with claimed_day(spark, "dwd.action", "20240130"):
        with pytest.raises(DayTaken):
            job(line)
    create_text(spark, _claim_path(spark, "dwd.action", "20240130"), "a run that died")
    assert job(f"{line} --take-over") == counts
    assert same(spark.table("dwd.action"), accepted)
    reasons = {r.reason: r["count"] for r in rejected.groupBy("reason").count().collect()}
    assert job(f"ingest --path {raw} --p-date 20240129") == {"accepted": counts["accepted"], **reasons}
    bad = spark.read.option("basePath", f"{tmp_path}/bad").parquet(f"{tmp_path}/bad")
    assert bad.count() == counts["rejected"] and "raw" in bad.columns

    job("cluster --first 20240130 --last 20240130")
    assert same(spark.table("dwd.action").where("p_date = '20240130'"), accepted)

    clicks = latest_clicks(spark.table("dwd.action"), "20240130")
    assert job("click-window --end-date 20240130") == clicks.count() > 0
    assert same(spark.table("dwd.click7aggre"), clicks)

    similar = item_similarity(spark.table("dwd.click7aggre"), top_k=10)
    assert job("similarity --top-k 10") == similar.count() > 0
    assert same(spark.table("dwd.item_similarity"), similar)
    line = f"similarity --top-k 10 --store-path {tmp_path}/store --buckets 4 --dst-table kept_up"
    assert job(line) == job(line) == similar.count()
    assert same(spark.table("dwd.kept_up"), similar)
    line = f"click-window --end-date 20240130 --days-path {tmp_path}/days --buckets 4 --dst-table rolled"
    assert job(line) == job(f"{line} --again 20240130") == clicks.count()
    assert same(spark.table("dwd.rolled"), clicks)
    with pytest.raises(ValueError):
        job("similarity --alpha -1")

    job(f"graph --path {tmp_path}/graph --write-vertex false")
    assert not (tmp_path / "graph" / "vertices").exists()
    written = job(f"graph --path {tmp_path}/graph")
    edges = graph_store.read_edges(spark, f"{tmp_path}/graph/edges")
    assert edges.count() == similar.count() == written["edges"]
    assert graph_store.read_vertices(spark, f"{tmp_path}/graph/vertices").count() == written["vertices"]

    job(f"report types --first 20240130 --out {tmp_path}/types")
    types = spark.read.parquet(f"{tmp_path}/types")
    assert sum(r.cnt for r in types.collect()) == counts["accepted"]
    for name in ("day", "range", "hours", "activity"):
        job(f"report {name} --first 20240130 --out {tmp_path}/{name}")
    job(f"report history --first 20240101 --user 5 --out {tmp_path}/history")
    assert spark.read.parquet(f"{tmp_path}/history").count() == 20
    job(f"report item-history --first 20240101 --user 5 --item 5 --out {tmp_path}/ih")

    assert job("retention --first-kept 20240130") == ["20240129"]
    assert same(spark.table("dwd.action"), accepted)

    job(f"ingest-stream --path {raw} --p-date 20240130 --accepted-path {tmp_path}/ok "
        f"--checkpoint {tmp_path}/cp --bad-records-path {tmp_path}/bad2")
    assert spark.read.parquet(f"{tmp_path}/ok").count() == counts["accepted"]
    for _ in range(2):
        publish = f"publish --accepted-path {tmp_path}/ok --p-date 20240130 --table streamed"
        assert job(publish) == counts["accepted"]
    assert same(spark.table("dwd.streamed"), accepted)


def test_defaults_are_the_documented_ones():
    a = parser().parse_args(["similarity"])
    assert (a.alpha, a.top_k, a.user_cap, a.symmetric, a.min_score) == (1.0, 100, 200, False, None)
    a = parser().parse_args(["click-window"])
    assert (a.days, a.action_type, a.src_table, a.dst_table) == (7, 2, "action", "click7aggre")
    a = parser().parse_args(["graph"])
    assert (a.batch, a.write_vertex, a.write_edge) == (1000, "true", "true")
    a = parser().parse_args(["ingest", "--p-date", "20240101"])
    assert (a.starting_offsets, a.ending_offsets, a.fail_on_data_loss) == (None, None, "false")
    with pytest.raises(SystemExit):
        parser().parse_args(["ingest"])
    with pytest.raises(SystemExit):
        main(["ingest", "--p-date", "20240101"], spark=object())


def test_a_report_shows_all_rows(spark, sf, capsys):
    fx.action(spark, sf).write.mode("overwrite").saveAsTable("shown")
    hours = main("report hours --db default --table shown --first 20240115".split(), spark)
    lines = capsys.readouterr().out.splitlines()
    expected = spark.table("shown").where("p_date = '20240115'").selectExpr("hour(action_ts)", "action_type").distinct().count()
    assert hours is None and len(lines) == expected + 1 > 101
    main("report hours --db default --table shown --first 20240115 -n 3".split(), spark)
    assert len(capsys.readouterr().out.splitlines()) == 4


def test_both_halves_of_a_graph_go_where_they_are_told(spark, tmp_path):
    spark.createDataFrame([(1, 2, 0.5), (1, 3, 0.25)], "item_i long, item_j long, score double").write.mode("overwrite").saveAsTable("pairs")
    line = f"graph --src-db default --src-table pairs --format json --vertex-option path={tmp_path}/v --edge-option path={tmp_path}/e"
    assert main(line.split(), spark) == {"vertices": 3, "edges": 2}
    assert (spark.read.json(f"{tmp_path}/v").count(), spark.read.json(f"{tmp_path}/e").count()) == (3, 2)


def test_jobs_work_as_processes_of_their_own(spark, sf, tmp_path):
    """No metastore: what one process leaves, the next one finds in the folder of tables."""
    raw = tmp_path / "raw"
    fx.raw_messages(spark, sf).write.parquet(str(raw))
    first = ["--master", "local[2]", "--catalog", str(tmp_path / "tables"), "--conf", "spark.ui.enabled=false",
             "--conf", "spark.sql.shuffle.partitions=4", "--conf", f"spark.checkpoint.dir={tmp_path}/shared"]
    for line in (f"ingest --path {raw} --p-date 20240130", f"ingest --path {raw} --p-date 20240130", "click-window --end-date 20240130",
                 "similarity --top-k 10", f"graph --path {tmp_path}/graph", f"report types --first 20240130 --out {tmp_path}/types"):
        done = subprocess.run([sys.executable, "-m", "covisit.jobs", *first, *line.split()], capture_output=True, text=True, timeout=300,
                              cwd=Path(__file__).resolve().parents[1])
        assert done.returncode == 0, done.stderr[-2000:]
    accepted, _ = ingest_actions(read_files(spark, str(raw)), "20240130")
    clicks = latest_clicks(accepted, "20240130")
    similar = item_similarity(clicks, top_k=10)
    edges = graph_store.read_edges(spark, f"{tmp_path}/graph/edges")
    assert same(edges, similar.toDF("srcid", "dstid", "simscore"))
    assert sum(r.cnt for r in spark.read.parquet(f"{tmp_path}/types").collect()) == accepted.count()
