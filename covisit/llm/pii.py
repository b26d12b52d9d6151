"""Personal data: candidate spans, scored by boosted trees, selected by calibrated thresholds.

Generators propose spans that may overlap: the base patterns, and wide ones with high recall. Base
spans that pass their check always stay. Strict grammars label candidates: one half of all, by hash,
fits, for each kind, boosted trees over features of a span's format and of the text
around it, and the other half sets the kind's threshold. Equal features are counted first, splits come
from sums over all counted features. Made-up texts of both labels, made by rule,
belong to each half, so each kind has a model whatever the corpus holds, at any size. Trees become
column expressions, so all candidates, of all documents, are scored by Spark. Selected spans that
overlap one another are one; those within a base span go.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from covisit.llm.common import let, staged, with_key

KINDS = ("email", "ip", "card", "phone", "secret")
_LOCAL = "A-Za-z0-9._%+-"
#: name -> kind, pattern, what a text must contain. Runs are possessive and start where a run starts (or the
#: last match ended), so long runs cost no backtracking and matches are those of the plain patterns.
_DOT = r"(?:\.|[\x20]?(?:\(dot\)|\[dot\]|\{dot\})[\x20]?)"
_AT = rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++"
GENERATORS: dict[str, tuple[str, str, str]] = {
    "email": ("email", rf"{_AT}@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@"),
    "ip": ("ip", r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}", "."),
    "card": ("card", r"[0-9](?:[\x20-]?[0-9])++", ""),
    "phone": ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+"),
    "wide_email": ("email", rf"{_AT}[\x20]?(?:@|\(at\)|\[at\]|\{{at\}})[\x20]?[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)*+", "(at)|[at]|{at}|@"),
    "wide_ip": ("ip", r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{0,4}){2,7}", ":"),
    "wide_card": ("card", r"(?<![0-9])[0-9](?:[\x20./_-]?[0-9]){11,18}(?![0-9])", ""),
    "wide_phone": ("phone", r"(?<![0-9])\(?[0-9]{2,4}\)?[\x20./-]?[0-9]{3,4}[\x20./-][0-9]{3,4}(?![0-9])", ""),
    "wide_secret": ("secret", r"(?i)(?:token|secret|passw(?:or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key)[\"'\x20]{0,3}[:=][\"'\x20]{0,3}[A-Za-z0-9+/_=.-]{6,}+", "=|:"),
}
BASE = ("email", "ip", "card", "phone")
#: Characters before and after a span that features look at.
CONTEXT = 24
CUES = {
    "email": "mail|contact|write|reach", "ip": "ip|host|server|addr|login|client", "card": "card|visa|master|amex|pay|credit|debit",
    "phone": "tel|phone|call|mobile|fax|cell", "secret": "key|token|secret|pass",
}


@dataclass(frozen=True)
class Fit:
    """``sample``: what a kind's candidates of the corpus weigh together, at most, half for each label; all of them count.

    ``seeds``: made-up texts per kind and label that join them, each of weight 1.
    """

    sample: int = 4000
    seeds: int = 150
    least_of_each: int = 20
    rounds: int = 25
    rate: float = 0.3
    precision: float = 0.98


def _matches(text: Column, name: str) -> Column:
    """All matches of a generator: its place among them, the characters since the last one, and what is around."""
    kind, pattern, needs = GENERATORS[name]
    fields = "array<struct<generator:string,kind:string,i:int,gap:int,size:int,value:string,before:string,after:string>>"
    there = reduce(lambda a, b: a | b, (F.contains(text, F.lit(n)) for n in needs.split("|"))) if needs else F.lit(True)
    found = let(F.split(text, pattern, -1), lambda parts: F.transform(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
        lambda value, i: F.struct(
            F.lit(name).alias("generator"), F.lit(kind).alias("kind"), i.alias("i"), F.length(parts[i]).alias("gap"),
            F.length(value).alias("size"), value.alias("value"), F.right(parts[i], F.lit(CONTEXT)).alias("before"),
            F.left(parts[i + 1], F.lit(CONTEXT)).alias("after"))))
    return F.when(there, found.cast(fields)).otherwise(F.array().cast(fields))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    numbers = F.transform(F.sequence(F.lit(1), F.length(digits)), lambda i: F.substring(F.reverse(digits), i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1))
    return F.aggregate(numbers, F.lit(0), lambda s, x: s + F.when(x > 9, x - 9).otherwise(x)) % 10 == 0


def _octets(value: Column) -> Column:
    return F.forall(F.split(value, r"\."), lambda p: let(F.ltrim(p, F.lit("0")), lambda x: (F.length(x) < 3) | (F.length(x) == 3) & (x <= "255")))


def _issued(value: Column) -> Column:
    """A card of 13 to 15 digits whose first digits name an issuer of that length."""
    return _digits(value).rlike("^(?:4[0-9]{12}|3[47][0-9]{13}|3(?:0[0-5]|[68][0-9])[0-9]{11})$")


def _version_6(value: Column) -> Column:
    """Eight groups of hexadecimal digits, or fewer with one :: that stands for the rest."""
    groups = F.size(F.filter(F.split(value, ":"), lambda g: g != ""))
    short = value.contains("::") & ~value.rlike(":::|::.*::|[^:]:$") & (groups <= 7) & value.rlike("[0-9]")
    return (groups == 8) & value.rlike("^(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}$") | short


def _passes(value: Column, kind: Column) -> Column:
    digits = F.length(_digits(value))
    card = (digits >= 16) & (digits <= 19)
    return (F.when(kind == "ip", _octets(value)).when(kind == "card", F.when(card, _luhn(_digits(value))).otherwise(False))
            .when(kind == "phone", (digits >= 8) & (digits <= 15)).otherwise(True))


def candidates(keyed: DataFrame) -> DataFrame:
    """_key, generator, kind, start, end (code points), value, before, after, base (a base span that passes)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    numeric = [n for n in GENERATORS if GENERATORS[n][0] not in ("secret", "email")]
    other = [n for n in GENERATORS if n not in numeric]
    with_digits = F.flatten(F.array(*(_matches(F.col("_text"), n) for n in numeric)))
    found = keyed.select("_key", text.alias("_text"), F.flatten(F.array(*(_matches(text, n) for n in other))).alias("other"))
    found = found.withColumn("numeric", F.when(F.col("_text").rlike("[0-9]"), with_digits).otherwise(F.slice("other", 1, 0)))
    rows = found.select("_key", F.concat("other", "numeric").alias("all")).where(F.size("all") > 0).select("_key", F.inline("all"))
    until = Window.partitionBy("_key", "generator").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("end", F.sum(F.col("gap") + F.col("size")).over(until)).withColumn("start", F.col("end") - F.col("size"))
    return rows.select(
        "_key", "generator", "kind", "start", "end", "value", "before", "after",
        (F.col("generator").isin(*BASE) & _passes(F.col("value"), F.col("kind"))).alias("base"))


# --- features and trees ------------------------------------------------------------------


def features() -> dict[str, Column]:
    """Whole numbers that describe a candidate's format and context."""
    value, digits = F.col("value"), _digits(F.col("value"))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    tail = F.when(F.col("kind") == "secret", F.regexp_extract(value, _TAIL, 1)).otherwise("")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    cue = reduce(lambda a, kind: a.when(F.col("kind") == kind, F.lower(F.concat("before", F.when(F.col("kind") == "secret", value).otherwise(""))).rlike(CUES[kind])), KINDS[1:],
                 F.when(F.col("kind") == KINDS[0], F.lower("before").rlike(CUES[KINDS[0]])))
    return {
        "f_size": F.length(value),
        "f_digits": F.length(digits),
        "f_letters": letters,
        "f_marks": F.length(value) - F.length(digits) - letters,
        "f_distinct": F.size(F.array_distinct(F.split(value, ""))),
        "f_runs": F.size(F.split(value, "[^A-Za-z0-9]+")),
        "f_dots": F.length(value) - F.length(F.replace(value, F.lit("."), F.lit(""))),
        "f_check": flag(F.when(F.length(digits).between(12, 19), _luhn(digits))),
        "f_octets": flag(F.when(value.rlike(r"^[0-9.]+$"), _octets(value))),
        "f_form": flag(value.rlike(_CARD_FORM)),
        "f_issued": flag(_issued(value)),
        "f_version_6": flag(F.when(F.col("kind") == "ip", _version_6(value))),
        "f_spaces": F.length(value) - F.length(F.replace(value, F.lit(" "), F.lit(""))),
        "f_brackets": F.length(value) - F.length(F.regexp_replace(value, r"[()\[\]{}]", "")),
        "f_domain": flag(value.rlike(r"[.)\]}]\s?[A-Za-z]{2,}$")),
        "f_tail": F.length(tail),
        "f_tail_mixed": flag(_mixed(tail)),
        "f_plus": flag(value.startswith("+")),
        "f_mixed": flag(value.rlike("[0-9]") & value.rlike("[A-Za-z]")),
        "f_cue": flag(cue),
        "f_glued": flag(_glued()),
        "f_part": flag(_part()),
    }


_CARD_FORM = r"^(?:[0-9]{13,19}|[0-9]{4}([\x20./_-])(?:[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{6}\1[0-9]{4,5}))$"
_TAIL = r"([A-Za-z0-9+/_=.-]+)$"


def _mixed(value: Column) -> Column:
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]")


def _glued() -> Column:
    """The span goes on as a word."""
    return F.col("before").rlike("[A-Za-z0-9]$") | F.col("after").rlike("^[A-Za-z0-9]")


def _part() -> Column:
    """The span is part of a longer number."""
    return F.col("before").rlike("[0-9][.:/-]$") | F.col("after").rlike("^[.:/-][0-9]")


def labelled(found: DataFrame) -> DataFrame:
    """``found`` with ``label``: 1 if a strict grammar of the kind takes the candidate, else 0.

    Email: an address that ends in letters, its @ and dots plain or in brackets. ip: four octets, or version 6.
    card: Luhn, in usual groups or none, and 16 to 19 digits or 13 to 15 of an issuer. phone: 8 to 15 digits after +, or an area code in
    brackets or a cue before. secret: 16 characters or more with letters and digits after the name.
    """
    value, digits = F.col("value"), F.length(_digits(F.col("value")))
    tail = F.regexp_extract(value, _TAIL, 1)
    address = value.rlike(rf"^[{_LOCAL}]++(?:@|[\x20]?(?:\(at\)|\[at\]|\{{at\}})[\x20]?)[A-Za-z0-9-]") & value.rlike(rf"{_DOT}[A-Za-z]{{2,}}$")
    card = F.when(digits.between(13, 19), _luhn(_digits(value))).otherwise(False) & ((digits >= 16) | _issued(value)) & value.rlike(_CARD_FORM)
    cued = value.startswith("(") | F.lower("before").rlike(CUES["phone"])
    label = (F.when(F.col("kind") == "email", address)
             .when(F.col("generator") == "wide_ip", _version_6(value) & ~_glued())
             .when(F.col("kind") == "ip", _octets(value))
             .when(F.col("kind") == "card", card & ~_part())
             .when(F.col("generator") == "wide_phone", cued & digits.between(8, 15) & ~_part() & ~_glued())
             .when(F.col("kind") == "phone", digits.between(8, 15))
             .otherwise((F.length(tail) >= 16) & _mixed(tail)))
    return found.withColumn("label", (label | F.col("base")).cast("int"))


def _with_check_digit(number: str) -> str:
    total = sum(x - 9 * (x > 9) for x in (int(c) * (2 - k % 2) for k, c in enumerate(reversed(number))))
    return number + str(-total % 10)


def seed_texts(count: int) -> list[str]:
    """For every kind ``count`` texts with a span and ``count`` with a look-alike, made by rule."""
    rng = random.Random(0)
    some = lambda letters, a, b: "".join(rng.choice(letters) for _ in range(rng.randint(a, b)))
    letters, digits, hexes = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
    words = lambda: " ".join(some(letters, 2, 8) for _ in range(3))
    cards = (("4", 13), ("4", 16), ("34", 15), ("37", 15), ("36", 14), ("302", 14), ("51", 16), ("6011", 19))
    out = []
    for k in range(count):
        opened, closed = ("()", "[]", "{}")[k % 3]
        at, dot = f"{opened}at{closed}", f"{opened}dot{closed}"
        space = " " * (k % 2)
        name, host = some(letters, 3, 9), some(letters, 3, 9)
        prefix, size = cards[k % len(cards)]
        number = _with_check_digit(prefix + some(digits, size - 1 - len(prefix), size - 1 - len(prefix)))
        wrong = number[:-1] + str((int(number[-1]) + 1 + k % 8) % 10)
        mark, odd = "-. /"[k // 2 % 4], "./"[k % 2].join(number[a : a + 3] for a in range(0, size, 3))
        if k % 2:
            edges = (0, 4, 8, 12, size) if size > 15 else (0, 4, 10, size) if size > 13 else (0, size)
            number, wrong = (mark.join(n[a:b] for a, b in zip(edges, edges[1:])) for n in (number, wrong))
        if k % 3 == 0:  # digits that pass, in groups that no card has
            wrong = odd
        groups = [some(hexes, 1, 4) for _ in range(8)]
        cut = 1 + k % 5
        short = ":".join(groups[:cut]) + "::" + str(k % 10) + ":".join(["", *groups[cut + 2 :]])
        octets = [rng.randint(0, 255) for _ in range(4)]
        area, line = some(digits, 3, 3), f"{some(digits, 3, 3)}-{some(digits, 4, 4)}"
        key = ("token", "secret", "password", "api_key", "access-key")[k % 5]
        mark = (" = ", ": ", '="', ":")[k % 4]
        out += [
            f"{words()} {name}{space}{at}{space}{host}{space}{dot}{space}com {words()}" if k % 3 else f"{words()} {name}@{host}.org {words()}",
            f"{words()} {name} {at if k % 2 else '@'} {host} {words()}",
            f"{words()} {':'.join(groups) if k % 2 else short} {words()}" if k % 3 else f"{words()} {'.'.join(map(str, octets))} {words()}",
            f"{words()} {':'.join(some(digits, 2, 2) for _ in range(3 + k % 4))} {words()}" if k % 3 else f"{words()} {'.'.join(str(300 + o) for o in octets)} {words()}",
            f"{words()} {number} {words()}",
            f"{words()} {wrong} {words()}",
            f"{words()} ({area}) {line} {words()}" if k % 3 else f"{words()} +{some(digits, 9, 14)} {words()}" if k % 2 else f"call {area}-{line} {words()}",
            f"{words()} {area}{'.-/'[k % 3]}{line} {words()}" if k % 3 else f"{words()} +{some(digits, 3, 5) if k % 4 == 1 else some(digits, 16, 24)} {words()}" if k % 2 else f"{words()} {some(digits, 2, 3)}.{area}.{area}.{area} {words()}",
            f"{words()} {key}{mark}{some(letters, 1, 3)}{some(digits, 1, 3)}{some(letters + digits, 14, 40)} {words()}",
            f"{words()} {key}{mark}{some(letters, 6, 20) if k % 2 else some(letters + digits, 6, 12)} {words()}",
        ]
    return out


#: Per feature its values in ascending order, and the sums of gradients and curvatures at each.
Sums = list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def _best_split(sums: Sums) -> tuple[float, int, int, tuple[float, float], tuple[float, float]]:
    """Gain, feature and limit of the best split, and gradient and curvature below and above it; feature -1 if there is none."""
    best = (0.0, -1, 0, (float(sums[0][1].sum()), float(sums[0][2].sum())), (0.0, 0.0))
    for f, (values, g, c) in enumerate(sums):
        g, c = np.cumsum(g), np.cumsum(c)
        gains = g[:-1] ** 2 / (c[:-1] + 1) + (g[-1] - g[:-1]) ** 2 / (c[-1] - c[:-1] + 1) - g[-1] ** 2 / (c[-1] + 1)
        if len(gains) and gains.max() > best[0] + 1e-9:
            k = int(np.argmax(gains))
            best = (float(gains[k]), f, int(values[k]), (float(g[k]), float(c[k])), (float(g[-1] - g[k]), float(c[-1] - c[k])))
    return best


def grown(starts: dict[str, float], sums: Callable[[dict, dict], dict[tuple[str, int], Sums]], fit: Fit) -> dict[str, list]:
    """Per kind trees of depth 2 for the log-odds; a tree is a leaf or (feature, limit, below, above).

    ``sums(trees, splits)`` gives the sums, at the scores of these trees, of each kind's node 0, or, with its
    split (feature, limit), of nodes 0 below and 1 above it.
    """
    trees: dict[str, list] = {kind: [] for kind in starts}
    leaf = lambda side: fit.rate * side[0] / (side[1] + 1.0)

    def node(split):
        return (split[1], split[2], leaf(split[3]), leaf(split[4])) if split[1] >= 0 else leaf(split[3])

    for _ in range(fit.rounds):
        tops = {kind: _best_split(x) for (kind, _), x in sums(trees, {}).items()}
        splits = {kind: top[1:3] for kind, top in tops.items() if top[1] >= 0}
        below = {key: _best_split(x) for key, x in sums(trees, splits).items()} if splits else {}
        for kind, top in tops.items():
            trees[kind].append((*splits[kind], node(below[kind, 0]), node(below[kind, 1])) if kind in splits else leaf(top[3]))
    return trees


def evaluated(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    return np.where(x[:, tree[0]] <= tree[1], evaluated(tree[2], x), evaluated(tree[3], x))


#: Sums are over whole numbers, so that they don't depend on the order of rows: this many to one.
_ONE = float(1 << 30)


def memory_sums(rows: dict[str, tuple[np.ndarray, np.ndarray, np.ndarray]], starts: dict[str, float]) -> Callable[[dict, dict], dict]:
    """``sums`` of ``grown`` from each kind's features and what each row weighs for either label (yes, no)."""
    bins = {}
    for kind, (x, _, _) in rows.items():
        bins[kind] = []
        for v in x.T:
            _, at = np.unique(np.where(v < 64, v, 64 + np.floor(np.log2(np.maximum(v, 64) / 64) * 16)), return_inverse=True)
            most = np.zeros(at.max() + 1, np.int64)
            np.maximum.at(most, at, v)
            bins[kind].append((most, at))

    def sums(trees: dict, splits: dict) -> dict[tuple[str, int], Sums]:
        out = {}
        for kind, (x, yes, no) in rows.items():
            if splits and kind not in splits:
                continue
            p = 1 / (1 + np.exp(-starts[kind] - sum(evaluated(t, x) for t in trees[kind])))
            g, c = np.rint((yes - (yes + no) * p) * _ONE), np.rint((yes + no) * p * (1 - p) * _ONE)
            nodes = x[:, splits[kind][0]] > splits[kind][1] if splits else np.zeros(len(x), bool)
            for k in range(2 if splits else 1):
                own = nodes == k
                out[kind, k] = [(most, np.bincount(at[own], g[own], len(most)) / _ONE, np.bincount(at[own], c[own], len(most)) / _ONE) for most, at in bins[kind]]
        return out

    return sums


def boosted(x: np.ndarray, y: np.ndarray, fit: Fit) -> tuple[float, list]:
    """Start score and trees for the log-odds of y, from rows in memory."""
    start = math.log((y.sum() + 1) / (len(y) - y.sum() + 1))
    return start, grown({"": start}, memory_sums({"": (x, y, 1 - y)}, {"": start}), fit)[""]


def evaluate(tree, row) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def _expression(tree, names: list[str]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(F.col(names[tree[0]]) <= tree[1], _expression(tree[2], names)).otherwise(_expression(tree[3], names))


def calibrated(scores: np.ndarray, y: np.ndarray, fit: Fit, weights: np.ndarray | None = None) -> float | None:
    """The middle between the least score from which on the wanted precision holds and the score below it."""
    limits, at = np.unique(scores, return_inverse=True)
    weights = np.ones(len(y)) if weights is None else weights
    right, chosen = (np.cumsum(np.bincount(at, w, len(limits))[::-1])[::-1] for w in (weights * y, weights))
    for k, limit in enumerate(limits):
        if right[k] < fit.least_of_each:
            return None
        if right[k] >= fit.precision * chosen[k]:
            return float((limit + limits[k - 1]) / 2 if k else limit)
    return None


def featured(found: DataFrame) -> DataFrame:
    """Candidates with their label, features and half (0 for thresholds, 1 for trees)."""
    half = F.pmod(F.xxhash64("_key", "generator", "start"), F.lit(2)).alias("half")
    return labelled(found).withColumns(features()).select("_key", "kind", "start", "end", "base", "label", half, *features())


#: So many counted features (22 numbers and two weights each) or fewer are summed in memory, more by Spark.
MEMORY_ROWS = 50_000
#: Scores are told apart by this much when a threshold is set.
_STEP = 0.001


def _whole(value: Column) -> Column:
    return F.sum(F.round(value * _ONE).cast("long"))


def _binned(value: Column) -> Column:
    """Values below 64 one by one, larger ones by 16 bins to each doubling."""
    return F.when(value < 64, value).otherwise(64 + F.floor(F.log2(F.greatest(value, F.lit(64)) / 64) * 16)).cast("long")


def _scores(models: dict[str, tuple[float, list]], names: list[str]) -> Column:
    """Start score and trees of each kind as one expression."""
    score = F.lit(None).cast("double")
    for kind, (start, trees) in models.items():
        score = F.when(F.col("kind") == kind, reduce(lambda a, t: a + _expression(t, names), trees, F.lit(float(start)))).otherwise(score)
    return score


def weighed(rows: DataFrame, fit: Fit) -> DataFrame:
    """kind, half, features, and what candidates of either label weigh (yes, no): all of ``rows`` and of the seeds.

    A kind's label with more candidates than half of ``fit.sample`` weighs that much in all, each the same.
    """
    names, most = list(features()), fit.sample // 2
    by = ["kind", "half", *names]
    ones, zeros = F.sum("label"), F.sum(1 - F.col("label"))
    own = rows.groupBy(*by).agg(ones.alias("yes"), zeros.alias("no"))
    share = F.lit(1.0), F.lit(1.0)
    for r in rows.groupBy("kind").agg(ones.alias("yes"), zeros.alias("no")).collect():
        share = tuple(F.when(F.col("kind") == r["kind"], min(1.0, most / max(1, r[c]))).otherwise(s) for c, s in zip(("yes", "no"), share))
    own = own.select(*by, (F.col("yes") * share[0]).alias("yes"), (F.col("no") * share[1]).alias("no"))
    one = rows.sparkSession.range(0, 1, 1, 1)  # a row made by Spark itself, so that no Python worker starts
    seeds = one.select(F.posexplode(F.split(F.lit("\n".join(seed_texts(fit.seeds))), "\n")).alias("k", "text"))
    seeds = candidates(seeds.select((-1 - F.col("k")).cast("long").alias("_key"), "text"))
    place = Window.partitionBy("kind", "label").orderBy(F.xxhash64("_key", "generator", "start"), "value")
    made = labelled(seeds).withColumn("half", (F.row_number().over(place) % 2).cast("long")).withColumns(features())
    made = made.groupBy(*by).agg(ones.cast("double").alias("yes"), zeros.cast("double").alias("no")).coalesce(1)  # as many whatever the corpus holds
    return staged(own.unionByName(made), "weighed")


def table_sums(trained: DataFrame, starts: dict[str, float]) -> Callable[[dict, dict], dict]:
    """``memory_sums`` for rows of any number (kind, yes, no, features)."""
    names = list(features())

    def sums(trees: dict, splits: dict) -> dict[tuple[str, int], Sums]:
        p = 1 / (1 + F.exp(-_scores({kind: (start, trees[kind]) for kind, start in starts.items()}, names)))
        node = F.lit(None).cast("int") if splits else F.lit(0)
        for kind, (f, limit) in splits.items():
            node = F.when(F.col("kind") == kind, (F.col(names[f]) > limit).cast("int")).otherwise(node)
        own = trained.select("kind", node.alias("node"), "yes", (F.col("yes") + F.col("no")).alias("all"), p.alias("p"), F.array(*names).alias("values"))
        cells = own.where("node IS NOT NULL").select(
            "kind", "node", (F.col("yes") - F.col("all") * F.col("p")).alias("g"), (F.col("all") * F.col("p") * (1 - F.col("p"))).alias("c"),
            F.posexplode("values").alias("f", "value"))
        cells = cells.groupBy("kind", "node", "f", _binned(F.col("value")).alias("bin")).agg(
            F.max("value").alias("value"), _whole(F.col("g")).alias("g"), _whole(F.col("c")).alias("c"))
        found: dict = defaultdict(lambda: [[] for _ in names])
        for r in cells.collect():  # some hundred bins of each feature at most
            found[r["kind"], r["node"]][r["f"]].append((r["value"], r["g"] / _ONE, r["c"] / _ONE))
        return {key: [tuple(map(np.array, zip(*sorted(x)))) for x in columns] for key, columns in sorted(found.items())}

    return sums


def models(rows: DataFrame, fit: Fit = Fit()) -> dict[str, tuple[float, list, float]]:
    """Per kind the start score, trees and threshold, from all of ``rows`` (as ``featured``) and the seeds.

    Kinds that can't hold the wanted precision are left out.
    """
    names = list(features())
    vectors = weighed(rows, fit)
    masses: dict[str, dict] = defaultdict(lambda: {0: (0.0, 0.0), 1: (0.0, 0.0)})
    for r in vectors.groupBy("kind", "half").agg(_whole(F.col("yes")).alias("yes"), _whole(F.col("no")).alias("no")).collect():
        masses[r["kind"]][r["half"]] = (r["yes"] / _ONE, r["no"] / _ONE)
    starts = {kind: math.log((masses[kind][1][0] + 1) / (masses[kind][1][1] + 1)) for kind in KINDS
              if min(*masses[kind][0], *masses[kind][1]) >= fit.least_of_each}
    if not starts:
        return {}
    trained = vectors.where(F.col("half") == 1).where(F.col("kind").isin(*starts))
    if trained.limit(MEMORY_ROWS + 1).count() <= MEMORY_ROWS:
        table = trained.select("kind", "yes", "no", *names).toArrow()
        x, yes, no, kinds = np.column_stack([table[c].to_numpy() for c in names]), table["yes"].to_numpy(), table["no"].to_numpy(), np.array(table["kind"].to_pylist())
        sums = memory_sums({kind: (x[kinds == kind], yes[kinds == kind], no[kinds == kind]) for kind in starts}, starts)
    else:
        sums = table_sums(trained, starts)
    trees = grown(starts, sums, fit)
    score = F.round(_scores({kind: (start, trees[kind]) for kind, start in starts.items()}, names) / _STEP).cast("long")
    held = vectors.where(F.col("half") == 0).where(F.col("kind").isin(*starts)).groupBy("kind", score.alias("score"))
    held = held.agg(_whole(F.col("yes")).alias("yes"), _whole(F.col("no")).alias("no")).collect()
    out = {}
    for kind, start in starts.items():
        own = [(r["score"] * _STEP, label, r[c] / _ONE) for r in held if r["kind"] == kind for c, label in (("yes", 1.0), ("no", 0.0)) if r[c]]
        limit = calibrated(*(np.array(x) for x in list(zip(*own))[:2]), fit, np.array([x[2] for x in own]))
        if limit is not None:
            out[kind] = (start, trees[kind], limit)
    return out


def _selected(rows: DataFrame, trained: dict[str, tuple[float, list, float]]) -> DataFrame:
    """Candidates that reach their kind's threshold and aren't within a base span, those that overlap as one."""
    score = _scores({kind: (start - limit, trees) for kind, (start, trees, limit) in trained.items()}, list(features()))
    scored = rows.where(F.col("base") | F.col("kind").isin(*trained)).select("_key", "kind", "start", "end", "base", score.alias("score"))
    scored = scored.where("base OR score >= -1e-9")
    reach = Window.partitionBy("_key").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    scored = scored.withColumn("base_end", F.max(F.when(F.col("base"), F.col("end"))).over(reach))
    extra = scored.where(~F.col("base") & (F.coalesce("base_end", F.lit(0)) < F.col("end"))).select("_key", "kind", "start", "end", "score")
    ahead = Window.partitionBy("_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("_key").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1)
    extra = extra.withColumn("new", (F.col("start") >= F.coalesce(F.max("end").over(before), F.lit(0))).cast("int"))
    extra = extra.withColumn("island", F.sum("new").over(ahead))
    return extra.groupBy("_key", "island").agg(
        F.max_by("kind", F.struct("score", "end")).alias("kind"), F.min("start").alias("start"), F.max("end").alias("end")).drop("island")


def spans(keyed: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """_key, kind, start, end, base of all spans to be redacted in ``keyed`` (_key, text)."""
    rows = staged(featured(candidates(keyed)), "features")  # each file that a task writes starts processes, so few frames are staged
    base = rows.where("base").select("_key", "kind", "start", "end", F.lit(True).alias("base"))
    trained = models(rows, fit)
    if not trained:
        return base
    return base.unionByName(_selected(rows, trained).withColumn("base", F.lit(False)))


def personal_data(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, base_spans and spans (arrays of kind, start, end; by kind, then start) of every row of ``docs`` (doc_id, text).

    Null and empty texts have none. Rows with null or repeated doc_ids are documents of their own.
    """
    keyed = with_key(docs, ["doc_id", "text"])
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct(order.alias("order"), "start", "end", "kind")
    rows = spans(keyed.select("_key", "text"), fit).groupBy("_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base_spans"), F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<order:bigint,start:bigint,end:bigint,kind:string>>")
    return keyed.select("_key", F.col("doc_id").cast("long").alias("doc_id")).join(rows, "_key", "left").select(
        "doc_id", F.coalesce("base_spans", none).alias("base_spans"), F.coalesce("spans", none).alias("spans"))


def listed(found: Column) -> Column:
    """kind:start:end of each span, joined by commas."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def redacted(docs: DataFrame, fit: Fit = Fit()) -> DataFrame:
    """doc_id, text of every row of ``docs``, each span replaced by its kind in brackets (of overlapping ones, the first)."""
    keyed = with_key(docs, ["doc_id", "text"])
    found = spans(keyed.select("_key", "text"), fit).groupBy("_key").agg(F.array_sort(F.collect_list(F.struct("start", "end", "kind"))).alias("s"))
    begin = F.struct(F.lit("").alias("text"), F.lit(0).cast("long").alias("at"))

    def add(done: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), (done["at"] + 1).cast("int"), (s["start"] - done["at"]).cast("int"))
        return F.when(s["start"] < done["at"], F.struct(done["text"].alias("text"), F.greatest(done["at"], s["end"]).alias("at"))).otherwise(
            F.struct(F.concat(done["text"], gap, F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("text"), s["end"].alias("at")))

    rows = keyed.join(found, "_key", "left").withColumn("r", F.aggregate("s", begin, add))
    rest = F.substring(F.col("text"), (F.col("r.at") + 1).cast("int"), F.length("text"))
    return rows.select("doc_id", F.when(F.col("s").isNull(), F.col("text")).otherwise(F.concat("r.text", rest)).alias("text"))
