"""Command-line jobs: read a table, run a plan, write a table.

    spark-submit covisit/jobs.py <job> [options]      or      python -m covisit.jobs <job> ...

Jobs: init, ingest, ingest-stream, publish, click-window, similarity, graph, retention, cluster,
report.
"""

from __future__ import annotations

import argparse
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from covisit.plans import reports
from covisit.plans.click_window import latest_clicks
from covisit.plans.graph import graph_edges, graph_vertices
from covisit.plans.incremental import BUCKETS as STORE_BUCKETS
from covisit.plans.incremental import SimilarityStore
from covisit.plans.ingest import REASONS, parse_actions, split_parsed
from covisit.plans.rolling import BUCKETS as ROLLING_BUCKETS
from covisit.plans.rolling import RollingClicks
from covisit.plans.similarity import (
    ALPHA,
    SCORE_DIGITS,
    TOP_K,
    USER_CAP,
    StagedSimilarity,
    cap_losses,
)
from covisit.schemas import CLICK, CLICK_CODE, SIMILARITY
from covisit.session import Staged, session_builder
from covisit.sources import graph_store, messages, tables
from covisit.streaming.ingest_stream import ingest_stream, read_accepted


def init(spark: SparkSession, a: argparse.Namespace) -> None:
    tables.ensure_tables(spark, a.db, a.table)


def ingest(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    """One day from a topic or files. Running it again replaces the day."""
    table = f"{a.database}.{a.table}"
    tables.ensure_database(spark, a.database)
    tables.ensure_action_table(spark, table)
    if a.take_over:
        tables.release_day(spark, table, a.p_date)
    if a.bad_records_path is None:
        # what is not kept is counted at least, by reason, while the accepted rows are written
        parsed = parse_actions(_raw(spark, a), a.p_date, a.align, a.precision)
        seen = Observation(f"reasons_{uuid.uuid4().hex}")
        parsed = parsed.observe(seen, *(F.count_if(F.col("reason") == r).alias(r) for r in REASONS))
        accepted = tables.overwrite_day(split_parsed(parsed)[0], table, a.p_date)
        return {"accepted": accepted, **{r: n for r, n in seen.get.items() if n}}
    # two writes from one read: "latest" may move between two reads of a topic
    parsed = parse_actions(_raw(spark, a), a.p_date, a.align, a.precision)
    with Staged(parsed, "parsed") as staged:
        accepted, rejected = split_parsed(staged)
        return {
            "accepted": tables.overwrite_day(accepted, table, a.p_date),
            "rejected": tables.write_quarantine(rejected, a.bad_records_path, a.p_date),
        }


def _raw(spark: SparkSession, a: argparse.Namespace) -> DataFrame:
    if a.path:
        return messages.read_files(spark, a.path, a.path_format)
    return messages.read_topic(
        spark, servers=a.bootstrap_servers, topic=a.topic, starting=a.starting_offsets,
        ending=a.ending_offsets, fail_on_data_loss=a.fail_on_data_loss == "true",
        min_partitions=a.min_partitions,
        day=a.p_date if a.starting_offsets is None and a.ending_offsets is None else None,
    )


def ingest_new(spark: SparkSession, a: argparse.Namespace) -> None:
    """Everything that came since the last run, exactly once."""
    if a.path:
        raw = messages.stream_files(spark, a.path, a.path_format)
    else:
        raw = messages.stream_topic(
            spark, servers=a.bootstrap_servers, topic=a.topic, starting=a.starting_offsets or "earliest",
            fail_on_data_loss=a.fail_on_data_loss == "true", min_partitions=a.min_partitions,
            max_per_batch=a.max_offsets_per_batch,
        )
    ingest_stream(
        raw, a.p_date, a.accepted_path, a.checkpoint, a.bad_records_path, a.align, a.precision, a.repeats_within
    ).awaitTermination()


def click_window(spark: SparkSession, a: argparse.Namespace) -> int:
    action = spark.table(f"{a.src_db}.{a.src_table}")
    if a.days_path:
        store = RollingClicks(spark, a.days_path, a.action_type, a.buckets)
        store.advance(action, a.end_date, a.days, a.again)
        tables.ensure_database(spark, a.dst_db)
        return tables.replace_snapshot(store.window(a.end_date, a.days), f"{a.dst_db}.{a.dst_table}", CLICK)
    ingested = (a.first_ingested, a.last_ingested) if a.first_ingested and a.last_ingested else None
    clicks = latest_clicks(action, a.end_date, a.days, a.action_type, a.date_col, ingested)
    tables.ensure_database(spark, a.dst_db)
    return tables.replace_snapshot(clicks, f"{a.dst_db}.{a.dst_table}", CLICK)


def similarity(spark: SparkSession, a: argparse.Namespace) -> int:
    if a.shuffle_partitions > 0:
        spark.conf.set("spark.sql.shuffle.partitions", str(a.shuffle_partitions))
    tables.ensure_database(spark, a.dst_db)
    source, target = spark.table(f"{a.src_db}.{a.src_table}"), f"{a.dst_db}.{a.dst_table}"
    if a.store_path:
        store = SimilarityStore(spark, a.store_path, a.alpha, a.user_cap, a.buckets)
        done = store.advance(source)
        print(f"{done.users_changed} users changed, {done.pairs_made} pairs made", file=sys.stderr)
        kept_up = store.similarity(a.top_k, a.symmetric, a.min_score, a.score_digits)
        return tables.replace_snapshot(kept_up, target, SIMILARITY)
    with StagedSimilarity(
        source, a.alpha, a.top_k, a.user_cap or None, a.symmetric, a.min_score, a.score_digits,
    ) as neighbours:
        written = tables.replace_snapshot(neighbours, target, SIMILARITY)
    if a.user_cap == 0:
        return written
    lost = cap_losses(source, a.user_cap).first()
    print(f"the cap of {a.user_cap} left out {lost.events_cut} events of {lost.users_cut} users", file=sys.stderr)
    return written


def graph(spark: SparkSession, a: argparse.Namespace) -> dict[str, int]:
    """Both halves read the similarity table, each only the columns it needs."""
    source = spark.table(f"{a.src_db}.{a.src_table}")
    both = _pairs(a.option)
    written = {}
    if a.write_vertex == "true":
        vertices = graph_vertices(source)
        options = {**both, **_pairs(a.vertex_option), "type": "vertex"}
        written["vertices"] = (
            graph_store.write_connector(vertices, a.format, options, a.batch)
            if a.format else graph_store.write_vertices(vertices, f"{a.path}/vertices")
        )
    if a.write_edge == "true":
        edges = graph_edges(source, unique=True)  # the similarity job writes each pair once
        options = {**both, **_pairs(a.edge_option), "type": "edge"}
        written["edges"] = (
            graph_store.write_connector(edges, a.format, options, a.batch)
            if a.format else graph_store.write_edges(edges, f"{a.path}/edges")
        )
    return written


def _pairs(options: list[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in options)


def publish(spark: SparkSession, a: argparse.Namespace) -> int:
    """A day of streamed rows, in many small files, into the action table."""
    table = f"{a.database}.{a.table}"
    tables.ensure_database(spark, a.database)
    tables.ensure_action_table(spark, table)
    if a.take_over:
        tables.release_day(spark, table, a.p_date)
    day = reports.actions_on_day(read_accepted(spark, a.accepted_path, a.p_date), a.p_date)
    return tables.overwrite_day(day, table, a.p_date)


def retention(spark: SparkSession, a: argparse.Namespace) -> list[str]:
    return tables.drop_expired(spark, f"{a.db}.{a.table}", a.first_kept)


def cluster(spark: SparkSession, a: argparse.Namespace) -> None:
    """Rewrite days of the fact table in clustered order."""
    table = f"{a.db}.{a.table}"
    days = reports.actions_in_range(spark.table(table), a.first, a.last)
    with Staged(days, "cluster") as rows:
        tables.write_clustered(rows, table)


def report(spark: SparkSession, a: argparse.Namespace) -> None:
    action = spark.table(f"{a.db}.{a.table}")
    last = a.last or a.first
    frames: dict[str, Callable[[], DataFrame]] = {
        "day": lambda: reports.actions_on_day(action, a.first),
        "range": lambda: reports.actions_in_range(action, a.first, last),
        "types": lambda: reports.actions_by_type(action, a.first),
        "hours": lambda: reports.actions_by_hour(action, a.first),
        "history": lambda: reports.user_history(action, a.user, a.first, a.n or 20),
        "item-history": lambda: reports.user_item_history(action, a.user, a.item, a.first),
        "activity": lambda: reports.user_activity(action, a.first, last, a.n or 100),
    }
    answer = frames[a.name]()
    if a.out:
        answer.write.mode("overwrite").parquet(a.out)
    else:
        if a.n:
            answer = answer.limit(a.n)
        print("\t".join(answer.columns))
        for row in answer.toLocalIterator():  # all rows, a partition at a time
            print("\t".join("" if value is None else str(value) for value in row))


# --- fixed values: names of jobs and flags, and their defaults, are a command-line contract -----


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="covisit.jobs", description=__doc__.splitlines()[0])
    top.add_argument("--master", help="Spark master; spark-submit's by default")
    top.add_argument("--catalog", help="folder of tables, where there is no metastore")
    top.add_argument("--conf", action="append", default=[], metavar="KEY=VALUE")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run: Callable, help: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help)
        sub.set_defaults(run=run)
        return sub

    p = job("init", init, "create the database and its tables")
    p.add_argument("--db", default="dwd")
    p.add_argument("--table", default="action")

    def messages_from(p: argparse.ArgumentParser) -> None:
        p.add_argument("--path", help="message files instead of a topic")
        p.add_argument("--path-format", default="parquet", choices=["parquet", "text"])
        p.add_argument("--bootstrap-servers", help="needed without --path")
        p.add_argument("--topic", default="action")
        p.add_argument("--starting-offsets", help="instead of the messages of --p-date")
        p.add_argument("--fail-on-data-loss", default="false", choices=["true", "false"])
        p.add_argument("--min-partitions", type=int)
        p.add_argument("--p-date", required=True, help="label of the rows, yyyyMMdd")
        p.add_argument("--bad-records-path", help="where rejected rows go; nowhere by default")
        p.add_argument("--align", default="compact", choices=["compact", "strict"])
        p.add_argument("--precision", default="s", choices=["s", "ms"])

    p = job("ingest", ingest, "one day of messages into the action table")
    messages_from(p)
    p.add_argument("--ending-offsets", help="instead of the messages of --p-date")
    p.add_argument("--take-over", action="store_true", help="the day of a run that died while it owned it")
    p.add_argument("--database", default="dwd")
    p.add_argument("--table", default="action")

    p = job("ingest-stream", ingest_new, "new messages, exactly once")
    messages_from(p)
    p.add_argument("--accepted-path", required=True)
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--max-offsets-per-batch", type=int, default=50_000_000)
    p.add_argument("--repeats-within", metavar="INTERVAL", help="count a message that is sent again within this time once")

    p = job("publish", publish, "a day of streamed rows into the action table")
    p.add_argument("--take-over", action="store_true", help="the day of a run that died while it owned it")
    p.add_argument("--accepted-path", required=True)
    p.add_argument("--p-date", required=True)
    p.add_argument("--database", default="dwd")
    p.add_argument("--table", default="action")

    def from_to(p: argparse.ArgumentParser, source: str, target: str | None) -> None:
        p.add_argument("--src-db", default="dwd")
        p.add_argument("--src-table", default=source)
        if target:
            p.add_argument("--dst-db", default="dwd")
            p.add_argument("--dst-table", default=target)

    p = job("click-window", click_window, "latest click per user and item")
    from_to(p, "action", "click7aggre")
    p.add_argument("--end-date", help="yyyyMMdd, today by default")
    p.add_argument("--days", type=int, default=7)
    p.add_argument("--action-type", type=int, default=CLICK_CODE)
    p.add_argument("--date-col", default="p_date")
    p.add_argument("--days-path", help="keep daily clicks there, and read new days only (by ingest day)")
    p.add_argument("--again", action="append", default=[], metavar="DAY", help="with --days-path: a day that was ingested anew")
    p.add_argument("--buckets", type=int, default=ROLLING_BUCKETS, help="of the daily clicks")
    p.add_argument("--first-ingested", help="with --last-ingested: the ingest days to read")
    p.add_argument("--last-ingested")

    p = job("similarity", similarity, "the most similar items of each item")
    from_to(p, "click7aggre", "item_similarity")
    p.add_argument("--alpha", type=float, default=ALPHA)
    p.add_argument("--top-k", type=int, default=TOP_K)
    p.add_argument("--user-cap", type=int, default=USER_CAP, help="newest events of a user; 0 takes all")
    p.add_argument("--shuffle-partitions", type=int, default=0, help="0 leaves the session's")
    p.add_argument("--symmetric", action="store_true")
    p.add_argument("--min-score", type=float)
    p.add_argument("--score-digits", type=int, default=SCORE_DIGITS)
    p.add_argument("--store-path", help="keep pair sums there, and pair changed users only")
    p.add_argument("--buckets", type=int, default=STORE_BUCKETS, help="of the store")

    p = job("graph", graph, "similarity to vertices and edges")
    from_to(p, "item_similarity", None)
    p.add_argument("--path", help="folder for Parquet vertices and edges")
    p.add_argument("--format", help="a graph connector instead of Parquet")
    for half in ("", "vertex-", "edge-"):
        p.add_argument(f"--{half}option", action="append", default=[], metavar="KEY=VALUE")
    p.add_argument("--batch", type=int, default=graph_store.BATCH)
    p.add_argument("--write-vertex", default="true", choices=["true", "false"])
    p.add_argument("--write-edge", default="true", choices=["true", "false"])

    p = job("retention", retention, "drop old days")
    p.add_argument("--db", default="dwd")
    p.add_argument("--table", default="action")
    p.add_argument("--first-kept", required=True)

    p = job("cluster", cluster, "rewrite days in clustered order")
    p.add_argument("--db", default="dwd")
    p.add_argument("--table", default="action")
    p.add_argument("--first", required=True)
    p.add_argument("--last", required=True)

    p = job("report", report, "a standing question about the action table")
    p.add_argument("name", choices=[
        "day", "range", "types", "hours", "history", "item-history", "activity"])
    p.add_argument("--db", default="dwd")
    p.add_argument("--table", default="action")
    p.add_argument("--first", required=True, help="the day, or the first day")
    p.add_argument("--last")
    p.add_argument("--user", type=int)
    p.add_argument("--item", type=int)
    p.add_argument("-n", type=int)
    p.add_argument("--out", help="write the answer as Parquet instead of showing it")
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> object:
    a = parser().parse_args(argv)
    if a.job in ("ingest", "ingest-stream") and not (a.path or a.bootstrap_servers):
        parser().error("name --path or --bootstrap-servers")
    if spark is not None:
        return a.run(spark, a)
    extra = _pairs(a.conf)
    if a.catalog:
        extra["spark.sql.warehouse.dir"] = a.catalog
    spark = session_builder(f"covisit-{a.job}", a.master, extra).getOrCreate()
    try:
        if a.catalog:
            tables.attach(spark, a.catalog)
        return a.run(spark, a)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
