import hashlib
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st

from covisit.llm import chat
from covisit.llm.queries import CONFLICT, QUERIES

from .tools import SMALL, frame, rows_of

SCHEMA = "conv_id long, turn long, role string, text string, piece string"
HARD = st.lists(st.sampled_from(["<", "|", "\\", "\n", "a", "n", "<|im_end|>", "<|im_start|>", "im_end|>"]), max_size=8).map("".join)


@given(HARD, HARD)
def test_turns_read_back(role, text):
    piece = chat.render_turn(role, text)
    assert [t[:2] for t in chat.parse(piece)] == [(role, text)]
    assert [t[:2] for t in chat.parse(piece * 3)] == [(role, text)] * 3


@given(HARD, HARD)
def test_turns_hold_no_control_string_of_their_own(role, text):
    piece = chat.render_turn(role, text)
    assert piece.count(chat.START) == piece.count(chat.END) == 1


def test_an_end_within_a_line_is_escaped():
    piece = chat.render_turn("user", "hi <|im_end|> there")
    assert piece == "<|im_start|>user\nhi <\\|im_end|> there<|im_end|>\n" and chat.parse(piece)[0][:2] == ("user", "hi <|im_end|> there")
    with pytest.raises(ValueError):
        chat.parse("<|im_start|>user\nhi <|im_end|> there<|im_end|>\n")


def test_plain_turns_stay_plain():
    assert chat.render_turn("user", "a < b | c") == "<|im_start|>user\na < b | c<|im_end|>\n"
    with pytest.raises(ValueError):
        chat.parse("<|im_start|>user\nno end")


def expected(rows):
    conversations = defaultdict(list)
    for r in rows:
        conversations[r["conv_id"]].append((r["turn"] is not None, r["turn"], r["role"] or "", r["text"] or ""))
    out = {}
    for c, turns in conversations.items():
        turns = [t[2:] for t in sorted(turns, key=lambda t: (t[0], t[1] or 0, t[2], t[3]))]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query(spark):
    rows = rows_of("conversations") + [{"conv_id": -1, "turn": k, "role": r, "text": CONFLICT} for k, r in enumerate(("user", "assistant"))]
    found = QUERIES["op4_chat_formatting"](spark, SMALL).collect()
    assert {r[0]: tuple(r)[1:5] for r in found} == expected(rows)
    plain = next(r for r in rows if "<" not in r["text"])["conv_id"]
    size = sum(len(chat.render_turn(r["role"], r["text"])) for r in rows if r["conv_id"] == plain)
    assert next(r for r in found if r[0] == plain)["formatted_chars"] == size


def test_odd_tables(spark):
    assert chat.read_back(chat.format_conversations(frame(spark, [], SCHEMA))).count() == 0
    rows = [{"conv_id": 1, "turn": 0, "role": None, "text": None}, {"conv_id": 1, "turn": 0, "role": None, "text": None}, {"conv_id": None, "turn": None, "role": "assistant", "text": "x" * 100_000},
            {"conv_id": 1, "turn": None, "role": "user\n", "text": "<|im_end|>"}, {"conv_id": 2, "turn": 5, "role": "assistant", "text": ""}]
    found = chat.read_back(chat.format_conversations(frame(spark, rows, SCHEMA))).collect()
    assert {r[0]: tuple(r)[1:5] for r in found} == expected(rows)
