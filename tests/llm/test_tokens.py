import struct
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from covisit.llm import common, packing, token_files, tokens
from covisit.llm.queries import QUERIES

from .tools import SMALL, documents, frame, rows_of

ODD = ["", " ", "\n", "a  b", " a", "a ", "a\n\nb", "a \n b", "it's don't I'LL", "x<|endoftext|>y <|endoftext|> z", "\ta b c", "é ́e",
       "İ ΣΣ", "a\0b", "1234 5 67", "\U0001f600 ‍!!", "\x1c a\x85b", "<|startoftext|>", "  lead", "tail\n"]


def plain(name, texts, end):
    t = Tokenizer.from_file(tokens.vocabulary_path(name))
    return [[*t.encode(x or "", add_special_tokens=False).ids, end] for x in texts]


@pytest.mark.parametrize("name", [tokens.WORD, tokens.BYTE])
def test_pieces_give_the_ids_of_whole_texts(name):
    texts = ODD + [None] + [r["text"] for r in rows_of("documents")]
    assert [x.tolist() for x in tokens.Pieces(name).encode(texts, 7)] == plain(name, texts, 7)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet=" \n\tab'sé0.́ ", max_size=12), max_size=6))
@pytest.mark.parametrize("name", [tokens.WORD, tokens.BYTE])
def test_pieces_of_odd_texts(name, texts):
    assert [x.tolist() for x in tokens.Pieces(name).encode(texts, 0)] == plain(name, texts, 0)


@pytest.mark.parametrize("name", [tokens.WORD, tokens.BYTE])
def test_pieces_of_texts_with_bars_and_of_more_words_than_are_kept(name, monkeypatch):
    monkeypatch.setattr(tokens, "PIECES", 40)
    monkeypatch.setattr(tokens, "_AT_ONCE", 60)
    monkeypatch.setattr(tokens, "_LEARNT", 7)
    texts = ["a | b", "|", "||", "x| |y |", "# | #", "| \u0301", ".| ,", "\u2581|"] + [f"the w{k} of v{k % 9}, |{k}" for k in range(200)] + ODD
    assert [x.tolist() for x in tokens.Pieces(name).encode(texts, 7)] == plain(name, texts, 7)


@pytest.mark.parametrize("name", [tokens.WORD, tokens.BYTE])
def test_memory_of_pieces_is_bounded(name, monkeypatch):
    """No call gets all new pieces at once, those met once are forgotten, those met again are kept."""
    monkeypatch.setattr(tokens, "PIECES", 3000)
    own, calls = tokens.Pieces(name), []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **more):
            calls.append(len(" ".join(texts).split()))
            return self.tokenizer.encode_batch_fast(texts, **more)

    own._tokenizer = Counting(own._tokenizer)
    for part in range(10):
        list(own.encode([" ".join(f"the w{part}x{k}" for k in range(2900))], 7))
    assert max(calls) <= 2 * 2000 + 2
    assert len(own._numbers) <= 3000 + 2900 + 2 and sum(calls) < 2 * 10 * 2902 + 100


def test_token_files_query(spark):
    rows = sorted(rows_of("documents"), key=lambda r: r["doc_id"])
    ids = plain(tokens.WORD, [r["text"] for r in rows], 2)
    at, expected = 0, []
    for r, x in zip(rows, ids):
        expected.append((r["doc_id"], at, len(x), zlib.crc32(np.array(x, "<u4").tobytes())))
        at += len(x)
    assert sorted(map(tuple, QUERIES["op5_token_files"](spark, SMALL).collect())) == expected


def test_files_read_single_documents_and_notice_damage():
    content = token_files.encode_file([(5, np.array([1, 2, 3])), (9, np.array([2]))])
    reader = token_files.FileReader(content)
    assert reader.documents([9, 4]).keys() == {9} and reader.documents([5])[5].tolist() == [1, 2, 3]
    assert struct.unpack("<I", content[-4:])[0] == 0x8F92EAB1
    broken = bytearray(content)
    broken[len(content) - 9 - 12 * 3 + 8] ^= 1  # the first frame's checksum
    with pytest.raises(ValueError):
        token_files.FileReader(bytes(broken)).documents([5])


def test_files_of_odd_tables(spark):
    assert token_files.token_ids(frame(spark, [])).count() == 0
    rows = documents([None, "", "a b", "a b"])
    rows[3]["doc_id"] = 2
    rows.append({"doc_id": None, "text": "c"})
    found = token_files.token_ids(frame(spark, rows)).orderBy("start").collect()
    assert [r["n_tokens"] for r in found] == [2, 1, 1, 3, 3] and [r["start"] for r in found] == [0, 2, 3, 4, 7]


def test_files_keep_null_and_repeated_doc_ids(spark):
    rows = documents(["a b", "a", "c", "d"])
    for r, d in zip(rows, (700, 700, None, -3)):
        r["doc_id"] = d
    found = token_files.token_ids(frame(spark, rows)).orderBy("start").collect()
    assert [(r["doc_id"], r["n_tokens"]) for r in found] == [(None, 2), (-3, 2), (700, 2), (700, 3)]
    files = token_files.token_files(frame(spark, rows).coalesce(1)).collect()
    readers = [token_files.FileReader(bytes(f["content"])) for f in files]
    assert [sum(len(x.places(d)) for x in readers) for d in (None, 700, -3, 0)] == [1, 2, 1, 0]


def test_cuts_fill_classes():
    for n in range(1, 3 * packing.CAPACITY):
        cut = packing.cuts(n)
        assert sum(cut) == n and all(c * (packing.CAPACITY // c) >= (1 - packing.WASTE) * packing.CAPACITY for c in cut)


def check_packing(rows, pieces):
    ids = {r["doc_id"]: x for r, x in zip(rows, plain(tokens.BYTE, [r["text"] for r in rows], 1))}
    at, sequences = {}, {}
    for p in sorted(pieces, key=lambda p: (p["doc_id"], p["start"])):
        own = ids[p["doc_id"]]
        assert p["doc_tokens"] == len(own) and p["start"] == at.get(p["doc_id"], 0) and p["length"] > 0
        at[p["doc_id"]] = p["start"] + p["length"]
        assert p["ids_crc32"] == zlib.crc32(np.array(own[p["start"] : at[p["doc_id"]]], "<u4").tobytes())
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert at == {d: len(x) for d, x in ids.items()}
    used = padded = 0
    for own in sequences.values():
        end = 0
        for offset, length in sorted(own):
            assert offset == end
            end += length
        assert end <= packing.CAPACITY
        used += end
        padded += end if end & (end - 1) == 0 else packing.CAPACITY
    return used / padded if padded else 1


def test_packing_query(spark):
    assert check_packing(rows_of("documents"), QUERIES["op8_packing"](spark, SMALL).collect()) > 0.97


def test_packing_of_odd_tables(spark):
    from covisit.llm.queries import packed

    rows = documents([None, "", "a", "b " * 9000])
    assert check_packing(rows, packed(frame(spark, rows)).collect()) > 0.9
    assert packed(frame(spark, [])).count() == 0
    assert packed(frame(spark, [{"doc_id": None, "text": "x"}, {"doc_id": None, "text": "x"}])).count() == 2


@pytest.mark.parametrize("name", [tokens.WORD, tokens.BYTE])
def test_new_pieces_are_one_text_without_separators(name):
    own, given_texts, words = tokens.Pieces(name), [], []

    class Counting:
        def __init__(self, tokenizer):
            self.tokenizer = tokenizer

        def encode_batch_fast(self, texts, **more):
            given_texts.append(len(texts))
            words.append(len(" ".join(texts).split()))
            return self.tokenizer.encode_batch_fast(texts, **more)

    own._tokenizer = Counting(own._tokenizer)
    text = " ".join(f"w{k}x don't-{k} <|endoftext|>" for k in range(500)) + " é " + "|"
    assert [x.tolist() for x in own.encode([text], 7)] == plain(name, [text], 7)
    assert max(given_texts) <= 3 and sum(words) <= 1010


def test_words_are_split_and_numbered_together():
    texts = [b" a  b\x0ba ", None, b"", b" \t", "é x a".encode(), b"a\x1cb"]
    words, counts = common.split_words(pa.array(texts, pa.binary()))
    expected = [t.split() if t else [] for t in texts]
    assert counts.tolist() == [len(x) for x in expected]
    numbers, distinct = common.distinct_numbers(words)
    assert [distinct[n] for n in numbers] == [w for x in expected for w in x] and len(distinct) == len(set(distinct))
    assert common.split_words(pa.array([], pa.binary()))[1].tolist() == []
