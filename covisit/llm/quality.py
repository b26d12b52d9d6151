"""Quality rules: counts within a document, and how often its lines recur across a host's documents.

All on DataFrame functions. Documents of one ``source`` are one host's.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit.llm.common import SPACE, bounded_join, let, staged, with_key

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class QualityRules:
    """Limits. A line is boilerplate of a host if at least ``line_docs`` of its documents, and either a share of
    ``line_share`` of them or ``hot_docs``, have it.

    Documents whose lines are all alike, in order, count once: text that is common because it was copied
    isn't boilerplate. Documents without a line don't count.
    """

    min_words: int = 10
    repeat_percent: int = 20
    line_docs: int = 10
    line_share: float = 0.02
    hot_docs: int = 1000
    min_left_words: int = 10
    min_left_share: float = 0.1


def _without(text: Column, chars: str) -> Column:
    for c in chars:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def _words(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \\t-\\r]+"), "")


def _repeated(words: Column) -> Column:
    """How many words lie in 5-word windows that the text has twice or more.

    Windows are compared by 64-bit hashes. Most texts have no window twice, and stop after the set.
    """

    def covered(ordered: Column) -> Column:
        near = F.filter(
            F.transform(ordered, lambda w, i: F.when(
                (w["h"] == F.get(ordered, i - 1)["h"]) | (w["h"] == F.get(ordered, i + 1)["h"]), w["i"])),
            lambda i: i.isNotNull())
        return let(F.sort_array(near), lambda starts: F.aggregate(
            F.transform(starts, lambda s, i: F.coalesce(F.least(F.lit(5), F.get(starts, i + 1) - s), F.lit(5))),
            F.lit(0), lambda a, x: a + x))

    def windows(w: Column) -> Column:
        return F.transform(F.sequence(F.lit(0), F.size(w) - 5), lambda i: F.xxhash64(*(F.get(w, i + k) for k in range(5))))

    def counted(h: Column) -> Column:
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(
            F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i")))), covered))

    return F.when(F.size(words) < 6, F.lit(0)).otherwise(let(windows(words), counted)).cast("long")


def text_counts(docs: DataFrame) -> DataFrame:
    """Each row with the counts of its whole ``text`` and ``base_failed``; a null text counts as empty."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.withColumn("_text", text)
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    whole = F.col("_text")
    counted = split.withColumns({
        "_all": let(_words(whole), lambda w: F.struct(
            F.size(w).cast("long").alias("n"), _repeated(w).alias("r"), F.length(F.array_join(w, "")).cast("long").alias("c"))),
        "n_symbols": (F.length(whole) - F.length(_without(whole, SYMBOLS))).cast("long"),
        "n_dup_lines": let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
    })
    return counted.withColumns({
        "n_words": F.col("_all.n"), "n_repeat_words": F.col("_all.r"), "word_chars": F.col("_all.c")}).drop("_all", "_text")


def _base_failed(rules: QualityRules) -> Column:
    return (F.col("n_words") < rules.min_words) | (100 * F.col("n_repeat_words") > rules.repeat_percent * F.col("n_words"))


def normalised_lines(text: Column) -> Column:
    """Lower case, without white space at either end."""
    return F.transform(F.split(F.lower(text), "\n"), lambda x: F.btrim(x, F.lit(SPACE)))


def document_lines(docs: DataFrame) -> DataFrame:
    """_key, host, copies (a hash of all its lines in order), and its lines that have a word: hash and words."""
    lines = F.filter(normalised_lines(F.coalesce("text", F.lit(""))), lambda x: x != "")
    hashed = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("line"), F.size(_words(x)).alias("words")))
    rows = docs.select("_key", F.col("source").alias("host"), hashed.alias("all"))
    return rows.withColumn("copies", F.xxhash64("all.line")).select("_key", "host", "copies", F.inline("all"))


def boilerplate_lines(lines: DataFrame, rules: QualityRules) -> DataFrame:
    """host, line of the lines that are above the limits. Counts cover all documents of all hosts."""
    hosts = lines.select("host", "copies").distinct().groupBy("host").agg(F.count(F.lit(1)).alias("host_docs"))
    per_line = lines.select("host", "line", "copies").distinct().groupBy("host", "line").agg(F.count(F.lit(1)).alias("docs"))
    often = per_line.where(F.col("docs") >= rules.line_docs)
    often = often.join(hosts, often["host"].eqNullSafe(hosts["host"])).drop(hosts["host"])
    above = (F.col("docs") >= rules.line_share * F.col("host_docs")) | (F.col("docs") >= rules.hot_docs)
    return often.where(above).select("host", "line")


def line_verdicts(docs: DataFrame, rules: QualityRules) -> DataFrame:
    """_key, removed_words, removed (line hashes) of the rows that have lines above the limits. ``docs``: _key, text, source."""
    lines = staged(document_lines(docs), "lines")
    common = staged(boilerplate_lines(lines, rules), "boilerplate")
    common = common.select(F.col("host").alias("_host"), F.col("line").alias("_line"))
    found = lines.join(common, (lines["line"] == common["_line"]) & lines["host"].eqNullSafe(common["_host"]))
    return found.groupBy("_key").agg(F.sum("words").alias("removed_words"), F.collect_set("line").alias("removed"))


def quality(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """Every row of ``docs`` (doc_id, text, source) with counts, ``removed_words`` and ``kept``.

    Null texts count as empty, a null source as a host of its own. Each row is judged by itself: rows that share a
    doc_id, or have none, get the verdict of their own text. Other columns of ``docs`` are not returned.
    """
    keyed = with_key(docs, ["doc_id", "text", "source"])
    rows = text_counts(keyed.select("_key", "doc_id", "text")).drop("text").withColumn("base_failed", _base_failed(rules))
    return _judged(rows.join(line_verdicts(keyed, rules), "_key", "left").drop("_key"), rules)


def _judged(rows: DataFrame, rules: QualityRules) -> DataFrame:
    rows = rows.withColumn("removed_words", F.coalesce("removed_words", F.lit(0)))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & (
        (left < rules.min_left_words) | (left < rules.min_left_share * F.col("n_words")))
    return rows.withColumn("kept", ~F.col("base_failed") & ~depleted)


def filtered(docs: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """The rows that are kept, without their boilerplate lines, in the columns of ``docs``.

    ``n_chars``, where there is one, is counted anew in rows that lose lines.
    """
    keyed = with_key(docs.withColumnsRenamed({c: f"_in_{c}" for c in docs.columns if c not in ("doc_id", "text")}))
    rows = text_counts(keyed).withColumn("base_failed", _base_failed(rules)).where(~F.col("base_failed"))
    verdicts = line_verdicts(keyed.select("_key", "text", F.col("_in_source").alias("source")), rules)
    rows = bounded_join(rows, verdicts, ["_key"], "left", "verdicts")
    rows = _judged(rows, rules).where("kept")
    keys = F.transform(normalised_lines(F.col("text")), lambda x: F.xxhash64(x))
    cleaned = F.array_join(let(keys, lambda k: F.filter(
        F.split("text", "\n"), lambda _, i: ~F.array_contains("removed", F.get(k, i)))), "\n")
    out = {c: F.col(c if c in ("doc_id", "text") else f"_in_{c}") for c in docs.columns}
    out["text"] = F.when(F.col("removed").isNull(), F.col("text")).otherwise(cleaned)
    if "n_chars" in out:
        out["n_chars"] = F.when(F.col("removed").isNull(), out["n_chars"]).otherwise(F.length(out["text"]).cast("long"))
    return rows.select(*(value.alias(c) for c, value in out.items()))
