import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow.parquet as pq
import pytest

from covisit.llm import toxicity as tox
from covisit.llm.queries import QUERIES

from .tools import documents, frame

MIDDLE = "/root/testdata/sf0.01"
LABELS = "doc_id long, quality int, toxic int"


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def plain_model(rows, labels):
    """The ratio of a word, from plain dictionaries."""
    d = tox.DISCOUNT
    count, stems = ({}, {}), (Counter(), Counter())
    for r in rows:
        y = labels.get(r["doc_id"])
        if y is not None and crc(r["doc_id"]) % 3 != 1 and (crc(r["doc_id"]) // 3) % tox.CALIBRATION_PART:
            for w in tox.words(r["text"]):
                count[y][w] = count[y].get(w, 0) + 1
                stems[y][w[: tox.STEM]] += 1
    below = [defaultdict(set), defaultdict(set)]
    for y in (0, 1):
        for w in count[y]:
            below[y][w[: tox.STEM]].add(w)
    both = {s: below[0].get(s, set()) | below[1].get(s, set()) for s in stems[0] | stems[1]}

    def step(n, kinds, shared, total):
        return (max(n - d, 0) + d * kinds / shared) / total if total else 1 / shared

    def ratio(word):
        s = word[: tox.STEM]
        if s not in both or not sum(stems[0].values()) or not sum(stems[1].values()):
            return 0
        a = [step(stems[y][s], len(stems[y]), len(both), sum(stems[y].values())) for y in (0, 1)]
        value = math.log(a[1]) - math.log(a[0])
        if word in both[s]:
            b = [step(count[y].get(word, 0), len(below[y].get(s, ())), len(both[s]), stems[y][s]) for y in (0, 1)]
            value += math.log(b[1]) - math.log(b[0])
        return round(value * tox.UNIT)

    return ratio


def expected(rows, labels):
    ratio, out = plain_model(rows, labels), {}
    for r in rows:
        values = [ratio(w) for w in tox.words(r["text"])]
        out[r["doc_id"]] = (len(values), sum(values), sum(max(v - int(tox.MARGIN * tox.UNIT), 0) for v in values))
    return out


def made_up(n=240, seed=5):
    rng = random.Random(seed)
    plain = [f"{a}{b}" for a in ("lam", "torv", "senn", "briq", "ulde") for b in ("", "o", "is", "ant", "ery")]
    bad = [f"zork{e}" for e in ("", "s", "er", "ig", "lich", "a", "ung")]
    rows, labels = [], []
    for k in range(n):
        toxic = int(rng.random() < 0.25)
        text = [rng.choice(plain) for _ in range(rng.randint(5, 60))]
        if toxic:
            for _ in range(max(1, len(text) // 20)):
                text[rng.randrange(len(text))] = rng.choice(bad)
        rows.append({"doc_id": k, "text": " ".join(text)})
        labels.append((k, 1, toxic))
    return rows, labels


def close(got, want):
    assert got.keys() == want.keys()
    for k, (n, ratio, excess) in want.items():  # the last bit of a logarithm may differ between libraries
        assert got[k][0] == n and abs(got[k][1] - ratio) <= n and abs(got[k][2] - excess) <= n


@pytest.mark.parametrize("model_rows", [tox.MODEL_ROWS, 9])
def test_sums_as_by_brute_force(spark, model_rows):
    rows, labels = made_up()
    docs, known = frame(spark, rows, "doc_id long, text string"), tox.learnable(spark.createDataFrame(labels, LABELS))
    entries = tox.staged(tox.model_entries(tox.word_counts(docs, known)), "model")
    assert entries.count() > 9
    got = {r["doc_id"]: (r["n_words"], r["ratio"], r["excess"]) for r in tox.features(docs, entries, model_rows).collect()}
    close(got, expected(rows, {d: t for d, _, t in labels}))


def test_held_out_texts_of_the_supplied_tables(spark):
    found = {r["doc_id"]: r for r in QUERIES["op11_toxicity"](spark, MIDDLE).collect()}
    docs = pq.read_table(f"{MIDDLE}/documents.parquet").to_pylist()
    assert found.keys() == {r["doc_id"] for r in docs}
    assert all(r["held_out"] == (crc(k) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for k, r in found.items())
    toxic = {r["doc_id"]: r["toxic"] for r in pq.read_table(f"{MIDDLE}/labels.parquet").to_pylist() if r["toxic"] is not None}
    test = [(found[k]["predicted"], y, found[k]["score"]) for k, y in toxic.items() if k in found and found[k]["held_out"]]
    caught = sum(p and y for p, y, _ in test)
    assert caught >= 0.85 * sum(y for _, y, _ in test) and caught >= 0.95 * sum(p for p, _, _ in test)


def test_unseen_forms_and_no_leak_from_held_out_labels(spark):
    rows, labels = made_up()
    extra = [{"doc_id": 9000, "text": "lamo torvis zorkost senn ulde briqant"}, {"doc_id": 9001, "text": "lamo torvis senn ulde briqant"}]
    docs = frame(spark, rows + extra, "doc_id long, text string")
    got = {r["doc_id"]: r for r in tox.scored(docs, spark.createDataFrame(labels, LABELS)).collect()}
    assert got[9000]["score"] > 0.7 > 0.3 > got[9001]["score"]
    turned = [(d, q, 1 - t) if crc(d) % 3 == 1 else (d, q, t) for d, q, t in labels]
    again = {r["doc_id"]: r for r in tox.scored(docs, spark.createDataFrame(turned, LABELS)).collect()}
    assert got == again


def test_odd_rows(spark):
    rows, labels = made_up()
    odd = [{"doc_id": None, "text": "zork zorks"}, {"doc_id": None, "text": None}, {"doc_id": 1, "text": "lamo"}, {"doc_id": 700, "text": ""},
           {"doc_id": 701, "text": "\n \t--"}, {"doc_id": 702, "text": "lamo torv " * 60_000}, {"doc_id": 703, "text": "x" * 500_000}, {"doc_id": 703, "text": "x" * 500_000}]
    names = "doc_id long, text string, score string, _key string, toxic string"
    docs = frame(spark, [{**r, "score": "s", "_key": "k", "toxic": "t"} for r in rows + odd], names)
    more = labels + [(None, 1, 1), (5, 1, None), (6, 0, 1), (6, 0, 0), (99999, 1, 1)]
    for model_rows in (tox.MODEL_ROWS, 9):
        got = tox.scored(docs, spark.createDataFrame(more, LABELS), model_rows).collect()
        assert len(got) == len(rows) + len(odd)
        by_id = defaultdict(list)
        for r in got:
            by_id[r["doc_id"]].append(r)
        assert len(by_id[None]) == 2 and len(by_id[1]) == 2 and by_id[703][0] == by_id[703][1]
        assert by_id[700][0]["score"] == by_id[701][0]["score"] < 0.3 and by_id[702][0]["score"] < 0.3
        assert all(r["held_out"] is False for r in by_id[None])


@pytest.mark.parametrize("labels", [[], [(0, 1, 0), (2, 1, 0), (3, 1, 0)], [(k, 1, 1) for k in range(40)], [(1, 1, None)]])
def test_labels_of_one_class_or_none(spark, labels):
    docs = frame(spark, documents(["some text", "", "more text"]))
    got = tox.scored(docs, spark.createDataFrame(labels, LABELS)).collect()
    assert len(got) == 3 and all(0 <= r["score"] <= 1 for r in got)
    assert tox.scored(frame(spark, []), spark.createDataFrame(labels, LABELS)).collect() == []


def test_regression_separates_and_keeps_to_its_prior():
    assert np.allclose(tox.regression(np.zeros((0, 3)), np.zeros(0)), tox.PRIOR)
    x = np.r_[np.zeros((50, 3)), np.ones((50, 3))]
    w = tox.regression(x, np.r_[np.zeros(50), np.ones(50)])
    assert w[0] < -1 and w[0] + sum(w[1:]) > 1
