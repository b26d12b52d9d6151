import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from covisit.llm import graph, line_dedup, ngram_join, substring_dedup
from covisit.llm.common import mixed, word_hashes
from covisit.llm.queries import QUERIES

from .tools import SMALL, documents, frame, rows_of, words

HARD = ["", None, "one two", "the " * 70, "a b c d e " * 30, "x " + "a b c d e " * 30, "one two", "One two", "w " * 40_000]


def hard_documents():
    """Supplied texts, odd ones, and near copies: every tenth word of a long text changed from a place on."""
    texts = [r["text"] for r in sorted(rows_of("documents"), key=lambda r: r["doc_id"])]
    base = max(texts[:50], key=len).split()
    for k in range(0, len(base), max(1, len(base) // 20)):
        texts.append(" ".join(base[:k] + ["changed"] + base[k + 1 :]))
    short = "p q r s t u v w x y z a1 b1 c1 d1 e1 f1".split()
    texts += [" ".join(short), " ".join(short[:-1]), " ".join(short[1:]), " ".join(["P", *short[1:]]), " ".join([*short, "g1"])]
    return documents(texts + HARD)


# --- substrings ------------------------------------------------------------------------------


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 12), min_size=1, max_size=40))
def test_ranks_look_up_two_bounds_a_level(symbols):
    tree = substring_dedup.WaveletTree(np.array(symbols), 4)
    lookups = []

    class Counted(np.ndarray):
        def __getitem__(self, at):
            lookups.append(at)
            return np.asarray(self)[at]

    tree._ones = [x.view(Counted) for x in tree._ones]
    places = [(c, a, b) for c in range(16) for a in range(len(symbols) + 1) for b in range(a, len(symbols) + 1)]
    low, high = tree.ranks(*(np.array(x) for x in zip(*places)))
    assert low.tolist() == [symbols[:a].count(c) for c, a, _ in places]
    assert high.tolist() == [symbols[:b].count(c) for c, _, b in places]
    assert len(lookups) == 2 * 4


def kept_words(rows):
    first, out = set(), {}
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        own = words(r["text"])
        gone = set()
        for k in range(len(own) - 19):
            window = tuple(own[k : k + 20])
            if window in first:
                gone.update(range(k, k + 20))
            first.add(window)
        out[r["doc_id"]] = (len(own), len(gone), " ".join(w for k, w in enumerate(own) if k not in gone))
    return out


def test_substring_query(spark):
    expected = {d: (n, g, hashlib.sha256(t.encode()).hexdigest()) for d, (n, g, t) in kept_words(rows_of("documents")).items()}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op6_substring_dedup"](spark, SMALL).collect()} == expected


@pytest.mark.parametrize("share", [substring_dedup.COMMON_SHARE, 40])
def test_substrings_of_hard_documents(spark, monkeypatch, share):
    monkeypatch.setattr(substring_dedup, "COMMON_SHARE", share)
    rows = hard_documents()
    found = substring_dedup.deduplicated(frame(spark, rows).repartition(5)).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == kept_words(rows)


def test_substrings_of_odd_tables(spark):
    assert substring_dedup.deduplicated(frame(spark, [])).count() == 0
    text = " ".join(f"w{k}" for k in range(25))
    rows = [{"doc_id": 5, "text": text}, {"doc_id": 5, "text": text}, {"doc_id": None, "text": text}]
    found = substring_dedup.deduplicated(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is not None, r["n_removed"]) for r in found) == [(False, 0), (True, 25), (True, 25)]


def test_wavelet_tree_counts():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 37, 500)
    tree = substring_dedup.WaveletTree(x, 6)
    symbols, low = rng.integers(0, 37, 200), rng.integers(0, 500, 200)
    a, b = tree.ranks(symbols, low, np.full(200, 500))
    assert a.tolist() == [int((x[:k] == s).sum()) for s, k in zip(symbols, low)] and b.tolist() == [int((x == s).sum()) for s in symbols]


def test_matching_statistics_of_foreign_patterns():
    rng = np.random.default_rng(2)
    text = np.append(rng.integers(1, 4, 300), 0)
    pattern = rng.integers(1, 4, 60)
    size, many, first = substring_dedup.FMIndex(text, 8).matches(pattern, np.array([0, 30]), np.array([30, 30]))
    flat = text.tolist()
    for k in range(60):
        stop = 30 if k < 30 else 60
        runs = [pattern[k : k + n].tolist() for n in range(min(8, stop - k) + 1)]
        places = [[i for i in range(len(flat)) if flat[i : i + len(r)] == r] for r in runs]
        best = max(n for n in range(len(runs)) if places[n])
        assert (size[k], many[k]) == (best, len(places[best])) and first[k] == (places[8][0] if best == 8 else -1)


# --- n-gram join -----------------------------------------------------------------------------


def shingle_set(text):
    own = words("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(own[k : k + 4]) for k in range(max(1, len(own) - 3))} if own else set()


def brute_components(rows):
    rows = sorted(rows, key=lambda r: r["doc_id"])
    sets = [shingle_set(r["text"]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    lists = defaultdict(list)
    for k, s in enumerate(sets):
        for x in s:
            lists[x].append(k)
    pairs = {(a, b) for own in lists.values() for i, a in enumerate(own) for b in own[i + 1 :]}
    for a, b in sorted(pairs):
        common = len(sets[a] & sets[b])
        if 100 * common >= 85 * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {r["doc_id"]: (len(sets[k]), rows[find(k)]["doc_id"]) for k, r in enumerate(rows)}


def test_join_query(spark):
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op7_ngram_jaccard_join"](spark, SMALL).collect()} == brute_components(rows_of("documents"))


@pytest.mark.parametrize("limit", [None, 0, ngram_join.LIGHT_MOST])
def test_join_of_hard_documents(spark, monkeypatch, limit):
    """Whatever the boundary between light and heavy, and with hardly any shingle rare."""
    if limit is not None:
        monkeypatch.setattr(ngram_join, "light_limit", lambda sizes: limit)
        monkeypatch.setattr(ngram_join, "FREQUENT", 2)
    rows = hard_documents()
    assert {r[0]: tuple(r)[1:] for r in ngram_join.joined(frame(spark, rows).repartition(3)).collect()} == brute_components(rows)


def test_join_of_chains_and_sizes(spark):
    """Texts that lose a word at either end, step by step: links between neighbours only."""
    rng = random.Random(3)
    texts = []
    for n in (3, 4, 9, 14, 17, 20, 23, 30):
        own = [f"{n}-{k}" for k in range(n + 12)]
        texts += [" ".join(own[k : k + n + rng.randint(0, 2)]) for k in range(10)]
    rows = documents(texts)
    assert {r[0]: tuple(r)[1:] for r in ngram_join.joined(frame(spark, rows)).collect()} == brute_components(rows)


def near_copies(count, words_of_each=147, seed=5):
    """Copies of one text with other words in some places: about a tenth of all pairs link."""
    rng = random.Random(seed)
    base = [f"w{k}" for k in range(words_of_each)]
    return documents([" ".join(w if rng.random() > 0.018 else f"x{rng.random()}" for w in base) for _ in range(count)])


def test_join_of_near_copies_makes_rows_by_their_number_not_its_square(spark, monkeypatch):
    """Components are whole, though what a round connects isn't compared again."""
    held, verified = [], ngram_join.verified

    def counted(pairs, keyed, sets):
        held.append(pairs.count())
        return verified(pairs, keyed, sets)

    monkeypatch.setattr(ngram_join, "verified", counted)
    rows = near_copies(300)
    assert {r[0]: tuple(r)[1:] for r in ngram_join.joined(frame(spark, rows)).collect()} == brute_components(rows)
    assert sum(held) < 300 * 299 // 2 // 4, held


def test_join_of_odd_tables(spark):
    assert ngram_join.joined(frame(spark, [])).count() == 0
    rows = [{"doc_id": 5, "text": "a b c d e"}, {"doc_id": 5, "text": "a b c d e"}, {"doc_id": None, "text": "A b c d e"}, {"doc_id": 7, "text": None}]
    found = ngram_join.joined(frame(spark, rows)).collect()
    assert sorted(map(str, found)) == sorted(map(str, [*[r for r in found if r["n_shingles"] == 2], *[r for r in found if r["doc_id"] == 7]]))
    assert [r["component_id"] for r in found if r["n_shingles"] == 2] == [None] * 3
    assert ngram_join.one_of_each(frame(spark, rows)).count() == 2


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components(spark, pairs):
    parts = {x: {x} for p in pairs for x in p}
    for a, b in pairs:
        joined = parts[a] | parts[b]
        for x in joined:
            parts[x] = joined
    found = graph.components(spark.createDataFrame(pairs, "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {x: min(p) for x, p in parts.items() if len(p) > 1}


def test_links_that_are_stars_need_no_round(spark, monkeypatch):
    made = []
    monkeypatch.setattr(graph, "staged", lambda df, label: made.append(label) or df)
    found = graph.components(spark.createDataFrame([(1, 2), (3, 1), (9, 5)], "a long, b long")).collect()
    assert {r["id"]: r["component"] for r in found} == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5}
    assert made == ["links"]


# --- lines -----------------------------------------------------------------------------------


def test_words_that_differ_tell_that_lines_are_alike(monkeypatch):
    a = " ".join(f"word{k}" for k in range(40))
    monkeypatch.setattr(line_dedup, "_middles", None)  # no distance is computed
    assert line_dedup.edit_similarity(a, a.replace("word7 ", "other ").replace("word33", "w"))


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["ab", "abc", "b", "", "bca"]), max_size=7), st.lists(st.sampled_from(["ab", "abc", "b", "", "x"]), max_size=7))
def test_edit_similarity_is_that_of_whole_texts(ours, theirs):
    for other in (theirs, [*ours[:3], *theirs[:1], *ours[3:]], [*theirs[:1], *ours[1:]]):
        a, b = " ".join(ours), " ".join(other)
        assert line_dedup.edit_similarity(a, b) == (distance(a, b) <= int(0.2 * max(len(a), len(b)) + 1e-9))


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@given(st.text("abc", max_size=14), st.text("abc", max_size=14))
def test_edit_similarity(a, b):
    longer = max(len(a), len(b))
    assert line_dedup.edit_similarity(a, b) == (distance(a, b) <= int((1 - line_dedup.SIMILARITY) * longer + 1e-9))


def brute_lines(rows):
    """Removed line numbers per document: links by the definition, all pairs of lines with like SimHashes."""
    places = defaultdict(list)
    for r in sorted(rows, key=lambda r: r["doc_id"]):
        for n, line in enumerate((r["text"] or "").split("\n")):
            own = line_dedup.normalised(line)
            if len(own) >= line_dedup.MIN_WORDS:
                places[" ".join(own)].append((r["doc_id"], n))
    lines = list(places)
    sims = line_dedup.SimHashes().of([x.split() for x in lines])
    root = list(range(len(lines)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    links = 0
    for i in range(len(lines)):
        for j in np.nonzero(np.bitwise_count(sims[i + 1 :] ^ sims[i]) <= line_dedup.DISTANCE)[0] + i + 1:
            if distance(lines[i], lines[j]) <= int((1 - line_dedup.SIMILARITY) * max(len(lines[i]), len(lines[j])) + 1e-9):
                root[find(j)] = find(i)
                links += 1
    groups, removed = defaultdict(list), defaultdict(set)
    for k, line in enumerate(lines):
        groups[find(k)] += places[line]
    for own in groups.values():
        for d, n in sorted(own)[1:]:
            removed[d].add(n)
    return removed, links


def without(text, gone):
    return "\n".join(x for k, x in enumerate((text or "").split("\n")) if k not in gone)


def test_line_query(spark):
    rows = rows_of("documents")
    removed, _ = brute_lines(rows)
    expected = {r["doc_id"]: (len(r["text"].split("\n")), len(removed[r["doc_id"]]), hashlib.sha256(without(r["text"], removed[r["doc_id"]]).encode()).hexdigest()) for r in rows}
    assert {r[0]: tuple(r)[1:] for r in QUERIES["op3_line_dedup"](spark, SMALL).collect()} == expected


def test_lines_that_differ_in_a_word(spark):
    rng = random.Random(5)
    texts = []
    for k in range(12):
        own = [f"{rng.choice('abcdefgh')}{rng.randint(0, 999)}x{k}" for _ in range(90)]
        for _ in range(6):
            changed = list(own)
            changed[rng.randrange(90)] = f"new{rng.randint(0, 99)}y"
            texts.append(" ".join(changed) + "\nShort line.\n" + " ".join(own).upper() + "!")
    rows = documents(texts + [None, "", "\n\n", "A b c, d e 5", "a B c d e 7!"])
    removed, links = brute_lines(rows)
    assert links > 20
    found = line_dedup.deduplicated(frame(spark, rows).repartition(3)).collect()
    assert {r["doc_id"]: (r["text"], r["n_removed"]) for r in found} == {
        r["doc_id"]: (None if r["text"] is None else without(r["text"], removed[r["doc_id"]]), len(removed[r["doc_id"]])) for r in rows}


def test_lines_of_one_shape_stay_unless_they_are_alike(spark):
    texts = ["10 20 30 40 50", "11 22 33 44 55", "10 20 30 40 50!", "revenue in 2019 was 512 million", "revenue in 2023 was 874 million",
             "the report of the year 2019 is here", "The report of the year 2024 is here"]
    found = line_dedup.deduplicated(frame(spark, documents(texts))).orderBy("doc_id").collect()
    assert [r["n_removed"] for r in found] == [0, 0, 1, 0, 0, 0, 1]
    assert line_dedup.normalised("A b c, d e 5") == line_dedup.normalised("a B c d e 7!")


def test_lines_of_odd_tables(spark):
    assert line_dedup.deduplicated(frame(spark, [])).count() == 0
    rows = [{"doc_id": 5, "text": "a b c d e"}, {"doc_id": 5, "text": "a b c d e"}, {"doc_id": None, "text": "A b c d e"}]
    found = line_dedup.deduplicated(frame(spark, rows)).collect()
    assert sorted((r["doc_id"] is None, r["n_removed"]) for r in found) == [(False, 1), (False, 1), (True, 0)]


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aBcd \u00c9\u0130\u03a3\u03c3_-.\t\x1c\u2028\u0663\u00b2059\n\U0001d7ce\u4e2d"), max_size=60))
def test_a_text_is_read_at_once_as_its_lines_are(text):
    found, digits = line_dedup.spaced(text)
    assert [x.split() for x in found.split("\n")] == [re.findall(r"[^\W_]+", x.lower()) for x in text.split("\n")]
    assert digits == bool(re.search(r"\d", text))


def test_simhashes_of_long_lines_count_every_word():
    lines = [[f"w{k % 7}" for k in range(n)] for n in (5, 254, 255, 256, 510, 511, 3000)]
    expected = []
    for line in lines:
        bits = np.unpackbits(mixed(word_hashes([w.encode() for w in line])).view(np.uint8).reshape(-1, 8), axis=1).astype(int)
        expected.append(np.packbits(2 * bits.sum(0) > len(line)).view(np.uint64)[0])
    assert line_dedup.SimHashes().of_joined([" ".join(x) for x in lines]).tolist() == [int(x) for x in expected]
