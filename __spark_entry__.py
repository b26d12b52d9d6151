"""Registry of runnable queries and of the SQL that each must agree with.

``queries()`` maps a name to a function of (spark, folder of tables); ``oracle_sql()`` maps the
same names to SQL over the same tables.
"""

from __future__ import annotations

import json
import uuid
import warnings
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from covisit import fixtures as fx
from covisit.functions.days import trailing_days
from covisit.operators.cleaning import distinct_events, multiset_difference, split_rows
from covisit.operators.pairing import W2_BITS, W2_LOW, W_BITS, W_LOW, item_pairs, recent_per_user
from covisit.operators.profile import table_profile
from covisit.operators.ranking import latest_version
from covisit.plans import reports
from covisit.plans.bounded import BoundedSimilarity
from covisit.plans.click_window import latest_clicks
from covisit.plans.graph import graph_edges, graph_vertices, similar_items, vertex_lookup
from covisit.plans.incremental import Advance, SimilarityStore
from covisit.plans.ingest import ingest_actions
from covisit.plans.rolling import RollingClicks
from covisit.plans.similarity import StagedSimilarity, cap_losses, item_similarity, scores_from_sets, user_sets
from covisit.plans.sketches import SketchStore
from covisit.schemas import ACTION, olap_copy
from covisit.session import Staged, shared_dir
from covisit.sources import graph_store, tables
from covisit.sources.merging import MergingTable
from covisit.sources.offsets import read_log

try:  # the subpackage and the pipeline may be absent, and so may the libraries that they need
    from corpus_pipeline import ORACLE_SQL as PIPELINE_SQL
    from corpus_pipeline import run as run_pipeline
    from covisit.llm.queries import ORACLE_SQL as LLM_SQL
    from covisit.llm.queries import QUERIES as LLM_QUERIES
except ModuleNotFoundError as missing:
    if (missing.name or "").startswith("covisit") and not missing.name.startswith("covisit.llm"):
        raise
    if not (missing.name or "").startswith(("covisit.llm", "corpus_pipeline")):
        warnings.warn(f"training-data queries are left out: {missing}", stacklevel=1)
    LLM_QUERIES, LLM_SQL = {}, {}
else:
    LLM_QUERIES = {**LLM_QUERIES, "pipeline": run_pipeline}
    LLM_SQL = {**LLM_SQL, **({"pipeline": PIPELINE_SQL} if PIPELINE_SQL else {})}

SF_SMOKE = "/root/testdata/sf0.001"

# parameters of the registered queries
TOP = 10
CAP = 200
SMALL_CAP = 20
USER, ITEM = 12, 58
IDS = (7, 42, 58)
DAY, FROM, TO = "20240115", "20240123", "20240130"
MIN_SCORE = 0.001
DAY_BEFORE = "20240129"
LAST_ORDERS = "2001-07-25"
STORE_BUCKETS = 8

Query = Callable[[SparkSession, str], DataFrame]


def _clicks(spark: SparkSession, d: str) -> DataFrame:
    return latest_clicks(fx.action(spark, d), fx.LAST_DAY)


def _basket_graph(spark: SparkSession, d: str) -> DataFrame:
    return item_similarity(fx.basket(spark, d), top_k=TOP)


def _kept_basket_graph(spark: SparkSession, d: str) -> DataFrame:
    """The same, stored: what reads it several times, or samples it for ranges, computes it once."""
    return Staged(_basket_graph(spark, d), "basket_graph").frame


def _staged_similarity(spark: SparkSession, d: str) -> DataFrame:
    """The job's form. Its files stay in the shared folder, as the frame is read later."""
    return StagedSimilarity(fx.basket(spark, d), top_k=TOP).__enter__()


def _new_folder(spark: SparkSession, label: str) -> str:
    """A folder for what a query stores. It stays, as the query's frame is read later."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _advanced(spark: SparkSession, *windows: DataFrame) -> tuple[SimilarityStore, Advance]:
    """A store taken from window to window, and what the last step did."""
    store = SimilarityStore(spark, _new_folder(spark, "similarity"), buckets=STORE_BUCKETS)
    return store, [store.advance(window) for window in windows][-1]


def _basket_windows(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """All orders but those of the last days, then all."""
    basket = fx.basket(spark, d)
    return basket.where(F.col("action_ts") < F.lit(LAST_ORDERS).cast("timestamp")), basket


def _similarity_after_day(spark: SparkSession, d: str) -> DataFrame:
    action = fx.action(spark, d)
    return _advanced(spark, latest_clicks(action, DAY_BEFORE), latest_clicks(action, fx.LAST_DAY))[0].similarity(TOP)


def _advance_counts(spark: SparkSession, d: str) -> DataFrame:
    done = _advanced(spark, *_basket_windows(spark, d))[1]
    return spark.createDataFrame([(done.users_changed, done.pairs_made)], "users_changed bigint, pairs_made bigint")


def _rolling_clicks(spark: SparkSession, d: str) -> DataFrame:
    """The week before, then one day more."""
    store, action = RollingClicks(spark, _new_folder(spark, "clicks"), buckets=STORE_BUCKETS), fx.action(spark, d)
    for day in (DAY_BEFORE, fx.LAST_DAY):
        store.advance(action, day)
    return store.window(fx.LAST_DAY)


def _merging_table(spark: SparkSession, d: str) -> MergingTable:
    """Actions that came in three runs."""
    table = MergingTable(
        spark, _new_folder(spark, "merging"), ACTION, ["user_id", "creation_id"], "action_ts", ["action_type", "p_date"], STORE_BUCKETS)
    action = fx.action(spark, d)
    for part in range(3):
        table.append(action.where(F.pmod(F.xxhash64("action_ts", "user_id"), F.lit(3)) == part))
    return table


def _merged(spark: SparkSession, d: str) -> MergingTable:
    table = _merging_table(spark, d)
    table.compact()
    return table


def _ingest_offsets(spark: SparkSession, d: str) -> DataFrame:
    first, last = (json.dumps({fx.LOG_TOPIC: offsets}) for offsets in (fx.LOG_FROM, fx.LOG_TO))
    return fx.zoneless(ingest_actions(read_log(fx.message_log(spark, d), fx.LOG_TOPIC, first, last)[0], fx.LAST_DAY)[0])


def _sketches(spark: SparkSession, d: str) -> SketchStore:
    store = SketchStore(spark, _new_folder(spark, "sketches"), buckets=STORE_BUCKETS)
    store.add(fx.action(spark, d), trailing_days(fx.LAST_DAY, 30))
    return store


def _profile_sketched(spark: SparkSession, d: str) -> DataFrame:
    """The profile by sketches, and whether its distinct counts are within three standard errors of the exact ones."""
    exact = table_profile(fx.action(spark, d)).select("column", F.col("distinct").alias("exact"))
    off = F.abs(F.col("distinct") - F.col("exact")) / F.greatest("exact", F.lit(1))
    return _sketches(spark, d).table_profile(fx.FIRST_DAY, fx.LAST_DAY).join(exact, "column").select(
        "column", "n", "nulls", (off <= 0.05).alias("distinct_within_5_percent"))


def _plane(spark: SparkSession, d: str) -> DataFrame:
    """Actions, stored by user and item alike."""
    action, path = fx.action(spark, d), _new_folder(spark, "plane")
    tables.write_plane(action, path)
    return spark.read.schema(ACTION).parquet(path)


def _stored_graph(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """Vertices and edges, written and read back."""
    similarity, path = _kept_basket_graph(spark, d), _new_folder(spark, "graph")
    graph_store.write_edges(graph_edges(similarity), f"{path}/edges")
    edges = graph_store.read_edges(spark, f"{path}/edges")
    graph_store.write_vertices(graph_vertices(edges.withColumnsRenamed({"srcid": "item_i", "dstid": "item_j"})), f"{path}/vertices")
    return graph_store.read_vertices(spark, f"{path}/vertices"), edges


def _small_parts(spark: SparkSession, d: str) -> DataFrame:
    return fx.table(spark, d, "part").where("p_size <= 10").select("p_partkey")


def _graph_by_key(spark: SparkSession, d: str) -> DataFrame:
    """Edges inserted with lower scores, then as they are, then some of them again."""
    graph, edges = graph_store.KeyedGraph(spark, _new_folder(spark, "keyed"), STORE_BUCKETS), graph_edges(_kept_basket_graph(spark, d))
    graph.insert_edges(edges.withColumn("simscore", F.col("simscore") / 2))
    graph.insert_edges(edges)
    graph.insert_edges(edges.where("srcid % 3 = 0"))
    return graph.edges()


def _twice(similarity: DataFrame) -> DataFrame:
    """Every pair a second time, with a lower score; the pairs are computed once."""
    return similarity.withColumn("score", F.explode(F.array(F.col("score"), F.col("score") / 2)))


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    unit = F.lit(1e9)
    return df.select(
        *((F.rint(F.col(c) * unit) / unit).alias(c) if c in names else F.col(c) for c in df.columns)
    )


def entry(spark: SparkSession) -> DataFrame:
    """Clicks of a week, the latest per user and item, to the ten most similar items of each."""
    return queries()["item_similarity_topk"](spark, SF_SMOKE)


def queries() -> dict[str, Query]:
    return {
        **LLM_QUERIES,
        "click_window": lambda s, d: fx.zoneless(_clicks(s, d)),
        "click_window_event_time": lambda s, d: fx.zoneless(
            latest_clicks(fx.action(s, d), fx.LAST_DAY, date_col="action_ts")
        ),
        "click_window_late_events": lambda s, d: fx.zoneless(
            latest_clicks(fx.late_action(s, d), fx.LAST_DAY, date_col="action_ts")
        ),
        "click_window_rolling": lambda s, d: fx.zoneless(_rolling_clicks(s, d)),
        "dedup_events": lambda s, d: fx.zoneless(
            distinct_events(fx.basket(s, d), ["user_id", "creation_id", "action_ts"])
        ),
        "user_cap_recent": lambda s, d: fx.zoneless(
            recent_per_user(
                distinct_events(fx.basket(s, d), ["user_id", "creation_id", "action_ts"]),
                SMALL_CAP,
            )
        ),
        "user_item_sets": lambda s, d: user_sets(fx.basket(s, d)).select(
            "user_id", "deg", "weight", F.array_join(F.col("items").cast("array<string>"), ",").alias("items_csv")
        ),
        "item_pairs": lambda s, d: _rounded(item_pairs(user_sets(_clicks(s, d)), CAP), "w", "w2"),
        "item_similarity": lambda s, d: scores_from_sets(user_sets(_clicks(s, d))),
        "item_similarity_topk": lambda s, d: item_similarity(_clicks(s, d), top_k=TOP),
        "item_similarity_basket": lambda s, d: item_similarity(fx.basket(s, d), top_k=TOP),
        "item_similarity_capped": lambda s, d: item_similarity(
            fx.basket(s, d), alpha=0.5, top_k=TOP, user_cap=SMALL_CAP
        ),
        "item_similarity_basket_staged": _staged_similarity,
        "item_similarity_uncapped": lambda s, d: item_similarity(fx.basket(s, d), top_k=TOP, user_cap=None),
        "item_similarity_skewed": lambda s, d: item_similarity(fx.skewed_basket(s, d), top_k=TOP),
        "item_similarity_symmetric_basket": lambda s, d: item_similarity(
            fx.basket(s, d), top_k=TOP, symmetric=True
        ),
        "item_similarity_after_day": _similarity_after_day,
        "item_similarity_after_day_basket": lambda s, d: _advanced(s, *_basket_windows(s, d))[0].similarity(TOP),
        "similarity_advance_counts": _advance_counts,
        "item_similarity_bounded": lambda s, d: BoundedSimilarity(fx.basket(s, d), top_k=TOP).__enter__(),
        "item_similarity_bounded_skewed": lambda s, d: BoundedSimilarity(
            fx.skewed_basket(s, d), top_k=TOP, symmetric=True
        ).__enter__(),
        "user_cap_losses": lambda s, d: cap_losses(fx.basket(s, d), SMALL_CAP),
        "item_similarity_symmetric": lambda s, d: item_similarity(
            _clicks(s, d), top_k=TOP, symmetric=True
        ),
        "item_similarity_min_score": lambda s, d: item_similarity(
            fx.basket(s, d), top_k=TOP, min_score=MIN_SCORE
        ),
        "ingest_roundtrip": lambda s, d: fx.zoneless(
            ingest_actions(fx.raw_messages(s, d), fx.LAST_DAY)[0]
        ),
        "ingest_offsets": _ingest_offsets,
        "ingest_untidy": lambda s, d: fx.zoneless(ingest_actions(fx.untidy_messages(s, d), fx.LAST_DAY)[0]),
        "ingest_untidy_reasons": lambda s, d: ingest_actions(fx.untidy_messages(s, d), fx.LAST_DAY)[1].groupBy(
            "user_id", "reason").agg(F.count(F.lit(1)).alias("n")),
        "ingest_millis": lambda s, d: fx.zoneless(
            ingest_actions(fx.raw_messages(s, d), fx.LAST_DAY, "strict", "ms")[0]
        ),
        "ingest_accepted_damaged": lambda s, d: fx.zoneless(
            ingest_actions(fx.raw_messages(s, d, damaged=True), fx.LAST_DAY)[0]
        ),
        "ingest_quarantine": lambda s, d: ingest_actions(
            fx.raw_messages(s, d, damaged=True), fx.LAST_DAY
        )[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n")),
        "ingest_rejected_rows": lambda s, d: fx.zoneless(
            ingest_actions(fx.raw_messages(s, d, damaged=True), fx.LAST_DAY)[1].where("reason <> 'corrupt_json'")
        ),
        "except_all_multiplicities": lambda s, d: _except_some(fx.action(s, d)),
        "except_all_rows": lambda s, d: _except_all(fx.action(s, d)),
        "reject_complement": lambda s, d: fx.zoneless(
            split_rows(fx.action(s, d), F.col("action_type") == 2)[1]
        ),
        "actions_on_day": lambda s, d: fx.zoneless(reports.actions_on_day(fx.action(s, d), DAY)),
        "actions_in_range": lambda s, d: fx.zoneless(
            reports.actions_in_range(fx.action(s, d), FROM, TO)
        ),
        "actions_by_type": lambda s, d: reports.actions_by_type(fx.action(s, d), DAY),
        "actions_by_hour": lambda s, d: reports.actions_by_hour(fx.action(s, d), DAY),
        "user_history": lambda s, d: fx.zoneless(
            reports.user_history(fx.action(s, d), USER, fx.FIRST_DAY)
        ),
        "user_item_history": lambda s, d: fx.zoneless(
            reports.user_item_history(fx.action(s, d), USER, ITEM, fx.FIRST_DAY)
        ),
        "item_actions_stored": lambda s, d: fx.zoneless(
            reports.actions_in_range(_plane(s, d), FROM, TO).where(F.col("creation_id") == ITEM)
        ),
        "user_actions_stored": lambda s, d: fx.zoneless(
            reports.actions_in_range(_plane(s, d), FROM, TO).where(F.col("user_id") == USER)
        ),
        "user_activity": lambda s, d: reports.user_activity(
            fx.action(s, d), fx.FIRST_DAY, fx.LAST_DAY
        ),
        "latest_version": lambda s, d: fx.zoneless(
            latest_version(
                fx.action(s, d), ["user_id", "creation_id"], "action_ts", ["action_type", "p_date"]
            ).select("user_id", "creation_id", "action_type", "action_ts")
        ),
        "merging_table_exact": lambda s, d: fx.zoneless(_merging_table(s, d).exact()),
        "merging_table_eventual": lambda s, d: fx.zoneless(_merging_table(s, d).eventual().distinct()).groupBy(
            "user_id", "creation_id").agg(F.max("action_ts").alias("action_ts")),
        "merging_table_compacted": lambda s, d: fx.zoneless(_merged(s, d).eventual()),
        "table_profile": lambda s, d: table_profile(fx.action(s, d)),
        "table_profile_sketched": _profile_sketched,
        "user_activity_sketched": lambda s, d: _sketches(s, d).user_activity(fx.FIRST_DAY, fx.LAST_DAY),
        "olap_copy": lambda s, d: fx.zoneless(olap_copy(fx.action(s, d), ACTION)),
        "graph_vertices": lambda s, d: graph_vertices(_basket_graph(s, d)),
        "graph_edges": lambda s, d: graph_edges(_basket_graph(s, d)),
        "graph_edges_of_repeated_pairs": lambda s, d: graph_edges(_twice(_basket_graph(s, d))),
        "graph_vertex_lookup": lambda s, d: vertex_lookup(graph_vertices(_basket_graph(s, d)), IDS),
        "graph_vertex_lookup_stored": lambda s, d: vertex_lookup(_stored_graph(s, d)[0], IDS),
        "graph_edges_by_key": _graph_by_key,
        "similar_items_of_many": lambda s, d: graph_store.similar_items_of_many(_stored_graph(s, d)[1], _small_parts(s, d), 3),
        "similar_items": lambda s, d: similar_items(graph_edges(_basket_graph(s, d)), ITEM, TOP),
    }


def _except_all(action: DataFrame) -> DataFrame:
    clicks = action.where(F.col("action_type") == 2)
    return fx.zoneless(multiset_difference(action, clicks))


def _except_some(action: DataFrame) -> DataFrame:
    """Types of actions per user, as many times as they occur, less one occurrence of each click."""
    kinds = action.select("user_id", "action_type")
    return multiset_difference(kinds, kinds.where(F.col("action_type") == 2).distinct())


# --- the same questions as SQL -----------------------------------------------------------

_ACTION = """
action AS (
  SELECT user_id, ts AS action_ts,
         CAST(CASE event_type WHEN 'view' THEN 1 WHEN 'click' THEN 2 WHEN 'purchase' THEN 3
              WHEN 'signup' THEN 4 WHEN 'error' THEN 5 END AS INTEGER) AS action_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS creation_id,
         strftime(ts, '%Y%m%d') AS p_date, event_id
  FROM events)"""

_CLICKS = _ACTION + """,
clicks AS (
  SELECT user_id, creation_id, max(action_ts) AS action_ts FROM action
  WHERE p_date BETWEEN '20240124' AND '20240130' AND action_type = 2
    AND user_id IS NOT NULL AND creation_id IS NOT NULL
  GROUP BY user_id, creation_id)"""

_LATE = """
late AS (
  SELECT user_id, creation_id, action_type,
         CASE WHEN event_id % 5 = 0 THEN NULL ELSE action_ts END AS action_ts,
         CASE WHEN event_id % 3 = 0 THEN strftime(action_ts + INTERVAL 2 DAY, '%Y%m%d') ELSE p_date END AS p_date
  FROM action),
timed AS (SELECT *, coalesce(action_ts, strptime(p_date, '%Y%m%d')) AS moment FROM late)"""

_BASKET = """
basket AS (
  SELECT o_custkey AS user_id, l_partkey AS creation_id, o_orderdate AS action_ts
  FROM orders JOIN lineitem ON o_orderkey = l_orderkey)"""


def _sets(source: str, cap: int = CAP, alpha: float = 1.0) -> str:
    return f""",
dedup AS (
  SELECT DISTINCT user_id, creation_id, action_ts FROM {source}
  WHERE user_id IS NOT NULL AND creation_id IS NOT NULL AND action_ts IS NOT NULL),
capped AS (
  SELECT user_id, creation_id, action_ts FROM (
    SELECT *, row_number() OVER (
      PARTITION BY user_id ORDER BY action_ts DESC, creation_id) AS rn FROM dedup)
  WHERE rn <= {cap}),
items AS (SELECT DISTINCT user_id, creation_id FROM capped),
degrees AS (
  SELECT user_id, CAST(count(*) AS INTEGER) AS deg,
         CAST(1 AS DOUBLE) / (CAST(count(*) AS DOUBLE) + CAST({alpha} AS DOUBLE)) AS weight
  FROM items GROUP BY user_id)"""


def _scores(source: str, cap: int = CAP, alpha: float = 1.0) -> str:
    return _sets(source, cap, alpha) + f""",
pairs AS (
  SELECT a.creation_id AS item_i, b.creation_id AS item_j, weight AS w, weight * weight AS w2
  FROM items a JOIN items b ON a.user_id = b.user_id AND a.creation_id < b.creation_id
  JOIN degrees d ON d.user_id = a.user_id),
sums AS (
  SELECT item_i, item_j, count(*) AS n, {_exact('w', W_BITS, W_LOW)} AS s, {_exact('w2', W2_BITS, W2_LOW)} AS q
  FROM pairs GROUP BY item_i, item_j),
raw AS (
  SELECT item_i, item_j, CASE WHEN n = 1 THEN CAST(0 AS DOUBLE) ELSE greatest(s * s - q, CAST(0 AS DOUBLE)) END AS x
  FROM sums),
scores AS (SELECT item_i, item_j, {_significant('x', 9)} AS score FROM raw)"""


def _item_lists(source: str) -> str:
    return f"""
      SELECT user_id, list_sort(list(DISTINCT creation_id)) AS items, count(DISTINCT creation_id) AS d FROM (
        SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY action_ts DESC, creation_id) AS rn
        FROM (SELECT DISTINCT user_id, creation_id, action_ts FROM {source}))
      WHERE rn <= {CAP} GROUP BY user_id"""


def _exact(column: str, bits: int, low: int) -> str:
    whole = f"CAST(round_even({column} * CAST({2**bits} AS DOUBLE), 0) AS BIGINT)"
    return (f"(CAST(sum({whole} >> {low}) AS DOUBLE) * CAST({2**low} AS DOUBLE) + CAST(sum({whole} & {2**low - 1}) AS DOUBLE))"
            f" / CAST({2**bits} AS DOUBLE)")


def _significant(x: str, digits: int) -> str:
    cases = " ".join(
        f"WHEN {x} >= CAST('1e{p}' AS DOUBLE) THEN round_even({x} * CAST('1e{digits - 1 - p}' AS DOUBLE), 0) / CAST('1e{digits - 1 - p}' AS DOUBLE)"
        for p in range(12, -25, -1))
    return f"CASE {cases} ELSE CAST(0 AS DOUBLE) END"


def _top(scores: str = "scores", where: str = "") -> str:
    return f"""
  SELECT item_i, item_j, score FROM (
    SELECT *, row_number() OVER (PARTITION BY item_i ORDER BY score DESC, item_j) AS rk
    FROM {scores} {where})
  WHERE rk <= {TOP}"""


_ACTION_COLUMNS = "user_id, action_ts, action_type, creation_id, p_date"
_NEWEST = f"""WITH {_ACTION}
  SELECT {_ACTION_COLUMNS} FROM (
    SELECT *, row_number() OVER (PARTITION BY user_id, creation_id ORDER BY action_ts DESC, action_type DESC, p_date DESC) AS rn FROM action)
  WHERE rn = 1"""
_GRAPH = f"WITH {_BASKET}{_scores('basket')}, similarity AS ({_top()}\n)"


def oracle_sql() -> dict[str, str]:
    return {
        **LLM_SQL,
        "click_window": f"WITH {_CLICKS} SELECT user_id, creation_id, action_ts FROM clicks",
        "click_window_rolling": f"WITH {_CLICKS} SELECT user_id, creation_id, action_ts FROM clicks",
        "click_window_event_time": f"""WITH {_ACTION}
            SELECT user_id, creation_id, max(action_ts) AS action_ts FROM action
            WHERE action_ts >= TIMESTAMP '2024-01-24' AND action_ts < TIMESTAMP '2024-01-31'
              AND action_type = 2 GROUP BY user_id, creation_id""",
        "click_window_late_events": f"""WITH {_ACTION}, {_LATE}
            SELECT user_id, creation_id, max(moment) AS action_ts FROM timed
            WHERE moment >= TIMESTAMP '2024-01-24' AND moment < TIMESTAMP '2024-01-31' AND action_type = 2
            GROUP BY user_id, creation_id""",
        "dedup_events": f"WITH {_BASKET}{_sets('basket')} SELECT * FROM dedup",
        "user_cap_recent": f"WITH {_BASKET}{_sets('basket', SMALL_CAP)} SELECT * FROM capped",
        "user_item_sets": f"""WITH {_BASKET}{_sets('basket')}
            SELECT i.user_id, d.deg, d.weight,
                   string_agg(CAST(creation_id AS VARCHAR), ',' ORDER BY creation_id) AS items_csv
            FROM items i JOIN degrees d ON i.user_id = d.user_id
            GROUP BY i.user_id, d.deg, d.weight""",
        "item_pairs": f"""WITH {_CLICKS}{_scores('clicks')}
            SELECT item_i, item_j,
                   round_even(w * CAST(1e9 AS DOUBLE), 0) / CAST(1e9 AS DOUBLE) AS w,
                   round_even(w2 * CAST(1e9 AS DOUBLE), 0) / CAST(1e9 AS DOUBLE) AS w2
            FROM pairs""",
        "item_similarity": f"WITH {_CLICKS}{_scores('clicks')} SELECT * FROM scores",
        "item_similarity_topk": f"WITH {_CLICKS}{_scores('clicks')} {_top()}",
        "item_similarity_basket": f"WITH {_BASKET}{_scores('basket')} {_top()}",
        "item_similarity_capped": f"WITH {_BASKET}{_scores('basket', SMALL_CAP, 0.5)} {_top()}",
        "item_similarity_basket_staged": f"WITH {_BASKET}{_scores('basket')} {_top()}",
        "item_similarity_uncapped": f"WITH {_BASKET}{_scores('basket', 10**9)} {_top()}",
        "item_similarity_skewed": f"""WITH {_BASKET}, skewed AS (
            SELECT * FROM basket UNION ALL
            SELECT o_custkey, -i, o_orderdate FROM orders, range(1, {fx.HOT_ITEMS + 1}) r(i))
            {_scores('skewed')} {_top()}""",
        "item_similarity_after_day": f"WITH {_CLICKS}{_scores('clicks')} {_top()}",
        "item_similarity_after_day_basket": f"WITH {_BASKET}{_scores('basket')} {_top()}",
        "similarity_advance_counts": f"""WITH {_BASKET},
            earlier AS (SELECT * FROM basket WHERE action_ts < TIMESTAMP '{LAST_ORDERS}'),
            now AS ({_item_lists('basket')}), was AS ({_item_lists('earlier')})
            SELECT count(*) AS users_changed,
                   CAST(coalesce(sum(coalesce(now.d * (now.d - 1) // 2, 0) + coalesce(was.d * (was.d - 1) // 2, 0)), 0) AS BIGINT) AS pairs_made
            FROM now FULL JOIN was ON now.user_id = was.user_id WHERE now.items IS DISTINCT FROM was.items""",
        "item_similarity_bounded": f"WITH {_BASKET}{_scores('basket')} {_top()}",
        "item_similarity_bounded_skewed": f"""WITH {_BASKET}, skewed AS (
            SELECT * FROM basket UNION ALL
            SELECT o_custkey, -i, o_orderdate FROM orders, range(1, {fx.HOT_ITEMS + 1}) r(i))
            {_scores('skewed')},
            mirrored AS (
              SELECT item_i, item_j, score FROM scores
              UNION ALL SELECT item_j, item_i, score FROM scores)
            {_top('mirrored')}""",
        "item_similarity_symmetric_basket": f"""WITH {_BASKET}{_scores('basket')},
            mirrored AS (
              SELECT item_i, item_j, score FROM scores
              UNION ALL SELECT item_j, item_i, score FROM scores)
            {_top('mirrored')}""",
        "user_cap_losses": f"""WITH {_BASKET}{_sets('basket')}
            SELECT count(*) FILTER (n > {SMALL_CAP}) AS users_cut,
                   CAST(coalesce(sum(greatest(n - {SMALL_CAP}, 0)), 0) AS BIGINT) AS events_cut
            FROM (SELECT user_id, count(*) AS n FROM dedup GROUP BY user_id)""",
        "item_similarity_symmetric": f"""WITH {_CLICKS}{_scores('clicks')},
            mirrored AS (
              SELECT item_i, item_j, score FROM scores
              UNION ALL SELECT item_j, item_i, score FROM scores)
            {_top('mirrored')}""",
        "item_similarity_min_score": f"""WITH {_BASKET}{_scores('basket')}
            {_top(where=f'WHERE score >= {MIN_SCORE}')}""",
        "ingest_roundtrip": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('second', action_ts) AS action_ts, action_type, creation_id,
                   '{fx.LAST_DAY}' AS p_date FROM action""",
        "ingest_offsets": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('second', action_ts) AS action_ts, action_type, creation_id, '{fx.LAST_DAY}' AS p_date
            FROM action WHERE {' OR '.join(
                f"(event_id % 4 = {p} AND event_id // 4 >= {max(o, 0)}" + (f" AND event_id // 4 < {fx.LOG_TO[p]})" if fx.LOG_TO[p] >= 0 else ")")
                for p, o in fx.LOG_FROM.items())}""",
        "ingest_untidy": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('second', action_ts) AS action_ts, action_type, creation_id, '{fx.LAST_DAY}' AS p_date
            FROM action WHERE event_id % 8 IN (0, 3, 4, 5, 7)""",
        "ingest_untidy_reasons": f"""WITH {_ACTION}
            SELECT CASE WHEN event_id % 8 <> 2 THEN user_id END AS user_id,
                   CASE event_id % 8 WHEN 1 THEN 'bad_type' WHEN 2 THEN 'null_payload' ELSE 'bad_time' END AS reason, count(*) AS n
            FROM action WHERE event_id % 8 IN (1, 2, 6) GROUP BY ALL""",
        "ingest_millis": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('millisecond', action_ts) AS action_ts, action_type,
                   creation_id, '{fx.LAST_DAY}' AS p_date FROM action""",
        "ingest_accepted_damaged": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('second', action_ts) AS action_ts, action_type, creation_id,
                   '{fx.LAST_DAY}' AS p_date FROM action WHERE user_id % 7 IN (0, 5, 6)""",
        "ingest_quarantine": f"""WITH {_ACTION}
            SELECT 'corrupt_json' AS reason, count(*) AS n FROM (
              SELECT DISTINCT user_id, p_date, event_id // {fx.MESSAGE_SPAN} FROM action
              WHERE user_id % 7 = 1) HAVING count(*) > 0
            UNION ALL
            SELECT CASE user_id % 7 WHEN 2 THEN 'missing_user' WHEN 3 THEN 'bad_type'
                   ELSE 'bad_time' END AS reason, count(*) AS n
            FROM action WHERE user_id % 7 IN (2, 3, 4) GROUP BY 1""",
        "ingest_rejected_rows": f"""WITH {_ACTION}
            SELECT user_id, action_ts, action_type, creation_id, '{fx.LAST_DAY}' AS p_date, reason,
                   '{{' || CASE WHEN user_id IS NULL THEN '' ELSE '"userId":' || user_id || ',' END
                   || '"actionTypeList":"' || kind || '","creationIdList":"' || creation_id || '","timestampList":"' || time_text || '"}}' AS raw
            FROM (
              SELECT CASE WHEN user_id % 7 = 2 THEN NULL ELSE user_id END AS user_id,
                     CASE WHEN user_id % 7 = 4 THEN NULL ELSE date_trunc('second', action_ts) END AS action_ts,
                     CASE WHEN user_id % 7 = 3 THEN NULL ELSE action_type END AS action_type, creation_id,
                     CASE user_id % 7 WHEN 2 THEN 'missing_user' WHEN 3 THEN 'bad_type' ELSE 'bad_time' END AS reason,
                     CASE WHEN user_id % 7 = 3 THEN 'x' ELSE CAST(action_type AS VARCHAR) END AS kind,
                     CASE WHEN user_id % 7 = 4 THEN 'junk' ELSE CAST(epoch_us(action_ts) // 1000 AS VARCHAR) END AS time_text
              FROM action WHERE user_id % 7 IN (2, 3, 4))""",
        "except_all_multiplicities": f"""WITH {_ACTION}
            SELECT user_id, action_type FROM action EXCEPT ALL
            SELECT DISTINCT user_id, action_type FROM action WHERE action_type = 2""",
        "except_all_rows": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action EXCEPT ALL
            SELECT {_ACTION_COLUMNS} FROM action WHERE action_type = 2""",
        "reject_complement": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action WHERE action_type <> 2 OR action_type IS NULL""",
        "actions_on_day": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action WHERE p_date = '{DAY}'""",
        "actions_in_range": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action WHERE p_date BETWEEN '{FROM}' AND '{TO}'""",
        "actions_by_type": f"""WITH {_ACTION}
            SELECT action_type, count(*) AS cnt FROM action WHERE p_date = '{DAY}'
            GROUP BY action_type ORDER BY cnt DESC, action_type""",
        "actions_by_hour": f"""WITH {_ACTION}
            SELECT CAST(hour(action_ts) AS INTEGER) AS hour, action_type, count(*) AS cnt
            FROM action WHERE p_date = '{DAY}'
            GROUP BY 1, 2 ORDER BY hour, cnt DESC, action_type""",
        "user_history": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action
            WHERE p_date >= '{fx.FIRST_DAY}' AND user_id = {USER}
            ORDER BY action_ts DESC, creation_id DESC, action_type DESC, p_date DESC LIMIT 20""",
        "user_item_history": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action
            WHERE p_date >= '{fx.FIRST_DAY}' AND user_id = {USER} AND creation_id = {ITEM}
            ORDER BY action_ts DESC, creation_id DESC, action_type DESC, p_date DESC""",
        "item_actions_stored": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action WHERE p_date BETWEEN '{FROM}' AND '{TO}' AND creation_id = {ITEM}""",
        "user_actions_stored": f"""WITH {_ACTION}
            SELECT {_ACTION_COLUMNS} FROM action WHERE p_date BETWEEN '{FROM}' AND '{TO}' AND user_id = {USER}""",
        "user_activity": f"""WITH {_ACTION}
            SELECT user_id, count(*) AS action_count, count(DISTINCT creation_id) AS creation_count
            FROM action WHERE p_date BETWEEN '{fx.FIRST_DAY}' AND '{fx.LAST_DAY}'
            GROUP BY user_id ORDER BY action_count DESC, user_id LIMIT 100""",
        "latest_version": f"""WITH {_ACTION}
            SELECT user_id, creation_id, action_type, action_ts FROM (
              SELECT *, row_number() OVER (PARTITION BY user_id, creation_id
                ORDER BY action_ts DESC, action_type DESC, p_date DESC) AS rn FROM action)
            WHERE rn = 1""",
        "merging_table_exact": _NEWEST,
        "merging_table_eventual": f"WITH {_ACTION} SELECT user_id, creation_id, max(action_ts) AS action_ts FROM action GROUP BY ALL",
        "merging_table_compacted": _NEWEST,
        "table_profile": f"WITH {_ACTION} " + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS nulls,
                count(DISTINCT {c}) AS "distinct" FROM action"""
            for c in _ACTION_COLUMNS.split(", ")
        ),
        "table_profile_sketched": f"WITH {_ACTION} " + " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) AS n, count(*) - count({c}) AS nulls, TRUE AS distinct_within_5_percent FROM action"""
            for c in _ACTION_COLUMNS.split(", ")
        ),
        "user_activity_sketched": f"""WITH {_ACTION}
            SELECT user_id, count(*) AS action_count, count(DISTINCT creation_id) AS creation_count FROM action GROUP BY user_id""",
        "olap_copy": f"""WITH {_ACTION}
            SELECT user_id, date_trunc('second', action_ts) AS action_ts, action_type, creation_id,
                   p_date FROM action""",
        "graph_vertices": f"""{_GRAPH}
            SELECT item_i AS creation_id FROM similarity UNION SELECT item_j FROM similarity""",
        "graph_edges": f"""{_GRAPH}
            SELECT item_i AS srcid, item_j AS dstid, max(score) AS simscore FROM similarity
            GROUP BY 1, 2""",
        "graph_edges_of_repeated_pairs": f"""{_GRAPH}
            SELECT item_i AS srcid, item_j AS dstid, max(score) AS simscore FROM (
              SELECT * FROM similarity UNION ALL SELECT item_i, item_j, score / 2 FROM similarity)
            GROUP BY 1, 2""",
        "graph_vertex_lookup": f"""{_GRAPH}, vertices AS (
            SELECT item_i AS creation_id FROM similarity UNION SELECT item_j FROM similarity)
            SELECT creation_id FROM vertices WHERE creation_id IN {IDS}""",
        "graph_vertex_lookup_stored": f"""{_GRAPH}, vertices AS (
            SELECT item_i AS creation_id FROM similarity UNION SELECT item_j FROM similarity)
            SELECT creation_id FROM vertices WHERE creation_id IN {IDS}""",
        "graph_edges_by_key": f"{_GRAPH} SELECT item_i AS srcid, item_j AS dstid, score AS simscore FROM similarity",
        "similar_items_of_many": f"""{_GRAPH}
            SELECT srcid, dstid, simscore FROM (
              SELECT item_i AS srcid, item_j AS dstid, score AS simscore,
                     row_number() OVER (PARTITION BY item_i ORDER BY score DESC, item_j) AS rn
              FROM similarity JOIN part ON item_i = p_partkey WHERE p_size <= 10)
            WHERE rn <= 3""",
        "similar_items": f"""{_GRAPH}
            SELECT item_j AS dstid, score AS simscore FROM similarity WHERE item_i = {ITEM}
            ORDER BY simscore DESC, dstid LIMIT {TOP}""",
    }
