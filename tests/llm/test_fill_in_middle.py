import hashlib
import re

import pytest
from pyspark.sql import functions as F

from covisit.llm import fill_in_middle as fim
from covisit.llm.queries import QUERIES

from .tools import SMALL, documents, frame, rows_of


def parts(doc_id, text, rate=90, spm_rate=20):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    d = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(d[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return len(units), "plain", text, None, None
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_rate:
        return len(units), "spm", f"<S>{s}<P>{p}<M>{m}", len(p), len(m)
    return len(units), "psm", f"<P>{p}<S>{s}<M>{m}", len(p), len(m)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query(spark):
    found = {r["doc_id"]: r for r in QUERIES["op13_fill_in_middle"](spark, SMALL).collect()}
    rows = rows_of("documents")
    assert len(found) == len(rows)
    for r in rows:
        n, form, output, p, m = parts(r["doc_id"], r["text"])
        assert tuple(found[r["doc_id"]]) == (r["doc_id"], n, form, p, m, sha(output), sha(r["text"] or ""))
    assert {r["form"] for r in found.values()} == {"plain", "psm", "spm"}


ODD = ["", None, "a", "\n", "é𝄞 \r\n x", "$1 \\2 {3}+ (x) [y]", "a<S>b", "<P>", "< P><S", "<<S", "ab" * 200_000, "a b\n" * 150_000, "x", "x"]


@pytest.mark.parametrize("rate, spm_rate", [(90, 20), (100, 0), (100, 100), (0, 50)])
def test_odd_texts(spark, rate, spm_rate):
    rows = documents(ODD) + [{"doc_id": None, "text": "no id has this"}] * 2 + [{"doc_id": 3, "text": "again"}] * 2
    out = fim.fill_in_middle(frame(spark, rows), rate, spm_rate)
    out = out.withColumn("back", fim.restored(F.col("output"), F.col("form")))
    got = sorted(((r["doc_id"] is None, r["doc_id"], r["n"], r["form"], r["output"], r["prefix_chars"], r["middle_chars"], r["back"]) for r in out.collect()), key=repr)
    want = sorted(((r["doc_id"] is None, r["doc_id"], *parts(r["doc_id"], r["text"], rate, spm_rate), r["text"] or "") for r in rows), key=repr)
    assert got == want


def test_no_rows_and_clashing_names(spark):
    assert fim.fill_in_middle(frame(spark, [])).collect() == []
    docs = frame(spark, documents(["some text of words"])).withColumns({"form": F.lit(7), "row": F.lit(1), "whole": F.lit("w"), "h": F.lit(2), "a.b": F.lit(3)})
    row = fim.fill_in_middle(docs, rate=100).first()
    assert (row["row"], row["whole"], row["h"], row["a.b"]) == (1, "w", 2, 3)
    assert (row["n"], row["form"], row["output"], row["prefix_chars"], row["middle_chars"]) == parts(0, "some text of words", 100)
