"""Ingest rules on adversarial messages, with ANSI mode on."""

import json

import pytest
from pyspark.sql import functions as F

from covisit.functions.parsing import instant, spaced_number, split_list, whole_number
from covisit.plans.ingest import ingest_actions, parse_actions

BASE = "2025-11-30 00:00:0"


def message(user=None, types=None, items=None, times=None, **more):
    fields = {"userId": user, "actionTypeList": types, "creationIdList": items,
              "timestampList": times, **more}
    return json.dumps({k: v for k, v in fields.items() if v is not None})


# (message, rows of (reason or None, user, time as text, type, item))
GOLDEN = [
    (message(1, "2,2", "10,11", "1764460800,1764460800123"),
     [(None, 1, BASE + "0", 2, 10), (None, 1, BASE + "0", 2, 11)]),
    (message(2, "1,,2", " 10 , 20,30", "1764460800,1764460801,1764460802"),
     [(None, 2, BASE + "0", 1, 10), (None, 2, BASE + "1", 2, 20),
      ("bad_type", 2, BASE + "2", None, 30)]),
    (message(3, "2,2", "10", "1764460800,1764460801"),
     [(None, 3, BASE + "0", 2, 10), (None, 3, BASE + "1", 2, None)]),
    (message(4, "", "", ""), [("bad_time", 4, None, None, None)]),
    (message(5, "2,2,2", "10,11,12", "2025-11-30T01:02:03,2025-11-30 01:02:03,20251130"),
     [(None, 5, "2025-11-30 01:02:03", 2, 10), (None, 5, "2025-11-30 01:02:03", 2, 11),
      (None, 5, "1970-08-23 09:18:50", 2, 12)]),
    (message(6, "x,2.9,99999999999", "1 0,abc,12", "1764460800,1764460801.7,1764460802"),
     [("bad_type", 6, BASE + "0", None, 10), (None, 6, BASE + "1", 2, None),
      ("bad_type", 6, BASE + "2", None, 12)]),
    (message(7, "2,2,2,2", "1,2,3,4", "-5,9999999999,10000000000,1764460800123456"),
     [(None, 7, "1969-12-31 23:59:55", 2, 1), (None, 7, "2286-11-20 17:46:39", 2, 2),
      (None, 7, "1970-04-26 17:46:40", 2, 3), (None, 7, "+57883-", 2, 4)]),
    (message("8", "2", "1", "1764460800"), [("corrupt_json", None, BASE + "0", 2, 1)]),
    (message(9), [("bad_time", 9, None, None, None)]),
    ("{}", [("missing_user", None, None, None, None)]),
    ("not json", [("corrupt_json", None, None, None, None)]),
    ('{"userId": 1, "actionTyp', [("corrupt_json", None, None, None, None)]),
    ("", [("null_payload", None, None, None, None)]),
    (None, [("null_payload", None, None, None, None)]),
    (message(None, "2", "1", "1764460800"), [("missing_user", None, BASE + "0", 2, 1)]),
    (message(10, 2, 5, 1764460800, other=True), [(None, 10, BASE + "0", 2, 5)]),
    # numbers far outside the range of a timestamp must not fail the job
    (message(11, "2,2", "1,2", "9223372036854775807,-9223372036854775808"),
     [("bad_time", 11, None, 2, 1), ("bad_time", 11, None, 2, 2)]),
    (message(12, "2", str(2**63 - 1), "1764460800"), [(None, 12, BASE + "0", 2, 2**63 - 1)]),
]


def raw(spark, texts):
    rows = [(None if t is None else bytearray(t.encode()),) for t in texts]
    return spark.createDataFrame(rows, "value binary")


def shown(df):
    return df.select("reason", "user_id", F.col("action_ts").cast("string").alias("t"),
                     "action_type", "creation_id", "p_date", "raw")


@pytest.mark.parametrize("place", range(len(GOLDEN)))
def test_golden(spark, place):
    text, want = GOLDEN[place]
    got = shown(parse_actions(raw(spark, [text]), "20251130")).collect()
    assert len(got) == len(want)
    for g, w in zip(got, want):
        if w[2] and w[2].startswith("+"):
            assert g.t.startswith(w[2])
            assert (g.reason, g.user_id, g.action_type, g.creation_id) == (w[0], w[1], w[3], w[4])
        else:
            assert tuple(g)[:5] == w
        assert g.p_date == "20251130"
        if g.reason is None:
            assert g.raw is None
        elif g.reason in ("null_payload", "corrupt_json") or len(want) == 1 and not w[2]:
            assert g.raw == text


def test_rejected_text_can_be_ingested_again(spark):
    texts = [message(2, "1,,2", " 10 , 20,30", "1764460800,1764460801,1764460802"),
             message(6, "x,2", "1 0,7", "1764460800,1764460800")]
    rejected = ingest_actions(raw(spark, texts), "20251130")[1].collect()
    assert sorted(r.raw for r in rejected) == [
        '{"userId":2,"creationIdList":"30","timestampList":"1764460802"}',
        '{"userId":6,"actionTypeList":"x","creationIdList":"1 0","timestampList":"1764460800"}',
    ]
    again = ingest_actions(raw(spark, [r.raw for r in rejected]), "20251130")[1].collect()
    assert sorted(map(str, again)) == sorted(map(str, rejected))
    mended = [r.raw.replace('"x"', '"2"') for r in rejected]
    accepted = ingest_actions(raw(spark, mended), "20251130")[0].collect()
    assert [(r.user_id, r.creation_id) for r in accepted] == [(6, 10)]


def test_long_bad_message_is_kept_about_once(spark):
    n = 2000
    text = json.dumps({"userId": "x", "actionTypeList": ",".join(["2"] * n),
                       "creationIdList": ",".join(["1"] * n),
                       "timestampList": ",".join(["1764460800"] * n)})
    rejected = ingest_actions(raw(spark, [text]), "20251130")[1]
    size, rows = rejected.agg(F.sum(F.length("raw")), F.count(F.lit(1))).first()
    assert rows == n and size < 10 * len(text)
    assert rejected.where(F.col("raw") == text).count() == 1


def test_halves_are_complements(spark):
    frame = raw(spark, [text for text, _ in GOLDEN])
    accepted, rejected = ingest_actions(frame, "20251130")
    every = [row for _, rows in GOLDEN for row in rows]
    assert accepted.count() == sum(row[0] is None for row in every)
    assert rejected.count() == sum(row[0] is not None for row in every)
    assert accepted.columns == ["user_id", "action_ts", "action_type", "creation_id", "p_date"]
    # the literal multiset difference says the same
    columns = accepted.columns
    everything = parse_actions(frame, "20251130").select(columns)
    difference = everything.exceptAll(accepted).collect()
    assert sorted(map(str, difference)) == sorted(map(str, rejected.select(columns).collect()))


def test_strict_alignment_and_millis(spark):
    text = message(2, "1,,2", " 10 , 20,30", "1764460800,1764460801,1764460802123")
    got = shown(parse_actions(raw(spark, [text]), "20251130", "strict", "ms")).collect()
    assert [tuple(g)[:5] for g in got] == [
        (None, 2, BASE + "0", 1, 10), ("bad_type", 2, BASE + "1", None, 20),
        (None, 2, BASE + "2.123", 2, 30),
    ]
    empty = shown(parse_actions(raw(spark, [message(4, "", " ", "")]), "20251130", "strict"))
    assert [tuple(g)[:5] for g in empty.collect()] == [("bad_time", 4, None, None, None)]


NUMBERS = {
    "2": 2, " 2 ": 2, "+2": 2, "-2": -2, "2.9": 2, "-2.9": -2, ".5": 0, "5.": 5, "007": 7,
    "1e3": None, "": None, "x": None, "1 0": None, "2.9.1": None, "+": None, "0x10": None,
    "9223372036854775807": 2**63 - 1, "9223372036854775808": None,
    "9223372036854775807.99": 2**63 - 1, "NaN": None,
}


def test_whole_number(spark):
    frame = spark.createDataFrame([(t,) for t in NUMBERS], "t string")
    got = {r.t: r.n for r in frame.select("t", whole_number(F.col("t")).alias("n")).collect()}
    assert got == NUMBERS
    small = spark.createDataFrame([("2147483647",), ("2147483648",)], "t string")
    assert [r[0] for r in small.select(whole_number(F.col("t"), "int")).collect()] == [2**31 - 1, None]
    spaced = spark.createDataFrame([("1 0",), (" 1\t2 .5",)], "t string")
    assert [r[0] for r in spaced.select(spaced_number(F.col("t"))).collect()] == [10, 12]


def test_split_list(spark):
    frame = spark.createDataFrame([("1,,2",), (" a , b",), ("",), (",",), (None,)], "t string")
    compact = [r[0] for r in frame.select(split_list(F.col("t"))).collect()]
    assert compact == [["1", "2"], ["a", "b"], [], [], []]
    strict = [r[0] for r in frame.select(split_list(F.col("t"), keep_blanks=True)).collect()]
    assert strict == [["1", None, "2"], ["a", "b"], [], [None, None], []]


def test_instant_rejects_unknown_precision(spark):
    with pytest.raises(ValueError):
        instant(F.lit("1"), "us")
    with pytest.raises(ValueError):
        parse_actions(raw(spark, ["{}"]), "20251130", align="loose")
    with pytest.raises(ValueError):
        parse_actions(raw(spark, ["{}"]), "2025-11-30")


def test_parse_runs_once_without_shuffle_or_python(spark):
    accepted, rejected = ingest_actions(raw(spark, ["{}"]), "20251130")
    for half in (accepted, rejected):
        plan = half._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan
        assert plan.count("from_json") == 1


def test_milliseconds_at_both_ends_of_their_range(spark):
    texts = ["9223372036854775", "9223372036854776", "9223372036854999", "99999999999999999999", "10000000000", "-9223372036854775"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(instant(F.col("t"), "ms").isNotNull().alias("ok"))
    assert [r.ok for r in rows.collect()] == [True, False, False, False, True, False]
