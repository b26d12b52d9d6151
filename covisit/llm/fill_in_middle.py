"""Fill-in-middle transformation with counted quantifiers.

A text is n units (a run of letters, or any one other character). ``regexp_count`` gives n; two cuts
``a <= b`` make a pattern of the row's own, whose possessive groups take ``a`` units, then ``b - a``, then the
rest. One match captures prefix, middle and suffix, and its replacement writes the output. Possessive
groups never go back, so a match takes time and stack in proportion to the text.

All on DataFrame functions, row by row: nothing shuffles.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: a unit of text (letters, or one other character), and the sentinels
UNIT = "[A-Za-z]+|[^A-Za-z]"
ATOM = "(?:[A-Za-z]++|[^A-Za-z])"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Java patterns that read an output back; sentinels don't overlap, and no text that is cut holds one.
PSM = f"(?s)\\A{PREFIX}(.*?){SUFFIX}(.*?){MIDDLE}(.*+)\\z"
SPM = f"(?s)\\A{SUFFIX}(.*?){PREFIX}(.*?){MIDDLE}(.*+)\\z"

RESULTS = ("n", "form", "output", "prefix_chars", "middle_chars")


def _draws(doc_id: Column, seed: int) -> Column:
    """Four numbers below 2^32 from the id alone; a null id is an empty one."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    return F.array(*(F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint") for k in range(4)))


def _pattern(first: Column, second: Column) -> Column:
    """Anchored at both ends: it matches a whole text of at least ``second`` units, once."""
    return F.concat(
        F.lit(f"(?s)\\A({ATOM}{{"), first.cast("string"), F.lit(f"}}+)({ATOM}{{"), (second - first).cast("string"), F.lit("}+)(.*+)\\z"))


def restored(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of."""
    psm = F.regexp_replace(output, F.lit(PSM), F.lit("$1$3$2"))
    spm = F.regexp_replace(output, F.lit(SPM), F.lit("$2$3$1"))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def fill_in_middle(docs: DataFrame, rate: int = 90, spm_rate: int = 20, seed: int = 1) -> DataFrame:
    """Every row of ``docs`` (doc_id, text) with ``n``, ``form``, ``output``, ``prefix_chars`` and ``middle_chars``.

    Of 100 rows about ``rate`` are cut, of those about ``spm_rate`` with the suffix first (``spm``, else ``psm``).
    The cuts are two draws among the n + 1 places between units, so a part may be empty. A text that is null
    (it counts as empty), empty, or holds a sentinel stays as it is: ``plain``, with null ``*_chars``.
    Rows are judged one by one: repeated rows get the same result, an empty table gives none, a null
    doc_id draws as an empty one. Other columns pass through; one that bears a result's name is replaced.
    """
    rest = [c for c in docs.columns if c not in RESULTS]
    # columns of the input are kept in a struct, so that no name clashes; each step is a column of its own,
    # which later steps read and don't compute again
    rows = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in rest)).alias("row"), F.coalesce(F.col("text"), F.lit("")).alias("whole"),
        _draws(F.col("doc_id"), seed).alias("h"))
    rows = rows.withColumn("n", F.regexp_count("whole", F.lit(UNIT)).cast("bigint"))
    whole, h, n = F.col("whole"), F.col("h"), F.col("n")
    plain = (whole == "") | (h[2] % 100 >= rate)
    for sentinel in (PREFIX, SUFFIX, MIDDLE):
        plain = plain | F.contains(whole, F.lit(sentinel))
    one, two = h[0] % (n + 1), h[1] % (n + 1)
    rows = rows.withColumns({
        "form": F.when(plain, "plain").when(h[3] % 100 < spm_rate, "spm").otherwise("psm"),
        "pattern": _pattern(F.least(one, two), F.greatest(one, two))})
    written = F.when(F.col("form") == "spm", F.lit(f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2")).otherwise(F.lit(f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2"))
    output = F.when(F.col("form") == "plain", whole).otherwise(F.regexp_replace(whole, F.col("pattern"), written))
    rows = rows.withColumn("output", output)

    def chars(start: str, end: str) -> Column:
        """Code points between two sentinels; without ``end``, to the end of the output."""
        begin = F.locate(start, F.col("output")) + len(start)
        stop = F.locate(end, F.col("output")) if end else F.length("output") + 1
        return (stop - begin).cast("bigint")

    kind = F.col("form")
    return rows.select(
        *(F.col("row")[c].alias(c) for c in rest), "n", "form", "output",
        F.when(kind == "psm", chars(PREFIX, SUFFIX)).when(kind == "spm", chars(PREFIX, MIDDLE)).alias("prefix_chars"),
        F.when(kind != "plain", chars(MIDDLE, "")).alias("middle_chars"))
