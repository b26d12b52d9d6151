"""What the tests of this folder share: small tables of hard cases, and reading of supplied ones."""

import re

import pyarrow.parquet as pq

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def rows_of(name, sf=SMALL):
    return pq.read_table(f"{sf}/{name}.parquet").to_pylist()


def frame(spark, rows, schema=SCHEMA):
    names = [c.split()[0] for c in schema.split(", ")]
    return spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows], schema)


def documents(texts, **more):
    return [{"doc_id": k, "text": t, "lang": "en", "source": "s", "n_chars": len(t or ""), **more} for k, t in enumerate(texts)]


def words(text):
    return WORD.findall(text or "")
