"""Item sets of users, item pairs within a user, and pair scores.

Fixed values, the definition of the score: a user with ``d`` distinct items has the weight ``1 / (d + alpha)``. The score of two items
sums ``2 * w_u * w_v`` over the pairs of their common users, computed from two sums as
``(sum w)^2 - sum w^2``. One common user scores exactly 0.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from covisit.operators.ranking import top_n_per_key

# items paired by one row of work when users may have more than this
BLOCK = 1024


def recent_per_user(events: DataFrame, user_cap: int) -> DataFrame:
    """The ``user_cap`` newest events of each user; equal times go to the smaller item."""
    newest = [F.col("action_ts").desc(), F.col("creation_id").asc()]
    return top_n_per_key(events, ["user_id"], newest, user_cap)


def cut_by_cap(events: DataFrame, user_cap: int) -> DataFrame:
    """``users_cut, events_cut``: one row that says whom a cap cuts, and how many events it drops."""
    per_user = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    beyond = F.greatest(F.col("n") - user_cap, F.lit(0))
    return per_user.agg(
        F.count_if(beyond > 0).alias("users_cut"), F.coalesce(F.sum(beyond), F.lit(0)).alias("events_cut")
    )


def item_sets(events: DataFrame, alpha: float) -> DataFrame:
    """Per user: sorted distinct ``items``, their number ``deg``, and ``weight``.

    Feed it events already cut per user: the cut is what bounds an array.
    """
    if alpha <= -1:
        raise ValueError(f"alpha must be greater than -1, not {alpha}")
    return (
        events.groupBy("user_id")
        .agg(F.sort_array(F.collect_set("creation_id")).alias("items"))
        .withColumn("deg", F.size("items"))
        .withColumn("weight", F.lit(1.0) / (F.col("deg") + F.lit(float(alpha))))
    )


def pair_count() -> Column:
    """How many pairs the item sets will make: the number that predicts the cost."""
    deg = F.col("deg").cast("bigint")
    return F.coalesce(F.sum(F.call_function("div", deg * (deg - 1), F.lit(2))), F.lit(0))


def anchors(sets: DataFrame, largest_set: int, both: bool = False) -> DataFrame:
    """Every user's items, each with the larger items of that user: ``item_i, weight, later`` (and ``sign``, if there is one).

    The compact form of all pairs, eight bytes a pair. Up to ``BLOCK`` items per user it is a
    narrow step over the sorted array. Beyond that a single user could keep a task busy with
    billions of pairs, so the arrays are cut into blocks, the pairs of blocks are spread over the
    cluster, and an item comes with its larger items one block at a time. With ``both`` an item comes
    with all items of the user, itself among them.
    """
    sets = sets.where(F.size("items") >= 2)
    return _whole_anchors(sets, both) if largest_set <= BLOCK else _blocked_anchors(sets, both)


def _kept(sets: DataFrame) -> list[str]:
    return [c for c in ("weight", "sign") if c in sets.columns]


def _whole_anchors(sets: DataFrame, both: bool = False) -> DataFrame:
    kept = _kept(sets)
    if both:
        return sets.select(F.explode("items").alias("item_i"), *kept, F.col("items").alias("later"))
    later = F.slice("items", F.col("pos") + 2, F.size("items"))
    rows = sets.select(*kept, "items", F.posexplode("items").alias("pos", "item_i"))
    return rows.where(F.col("pos") + 1 < F.size("items")).select("item_i", *kept, later.alias("later"))


def _blocked_anchors(sets: DataFrame, both: bool = False) -> DataFrame:
    kept = _kept(sets)
    blocks = F.ceil(F.size("items") / F.lit(BLOCK)).cast("int")
    left = sets.select(
        "user_id", *kept, "items", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("a")
    )
    least = F.lit(0) if both else F.col("a")
    pairs = left.select("*", F.explode(F.sequence(least, blocks - 1)).alias("b")).select(
        "user_id", *kept, "a", "b",
        F.slice("items", F.col("a") * BLOCK + 1, F.lit(BLOCK)).alias("left"),
        F.slice("items", F.col("b") * BLOCK + 1, F.lit(BLOCK)).alias("right"),
    )
    spread = pairs.repartition("user_id", "a", "b")
    if both:
        return spread.select(F.explode("left").alias("item_i"), *kept, F.col("right").alias("later"))
    # in a block paired with itself only later items count; in two blocks all do
    first = F.when(F.col("a") == F.col("b"), F.col("pos") + 2).otherwise(F.lit(1))
    return spread.select(
        *kept, "a", "b", "right", F.posexplode("left").alias("pos", "item_i")
    ).select("item_i", *kept, F.slice("right", first, F.lit(BLOCK)).alias("later"))


def expand(anchor_rows: DataFrame) -> DataFrame:
    """``item_i, item_j, w, w2``: one row per user and unordered pair, smaller id first."""
    weight = F.col("weight")
    return anchor_rows.select("item_i", "weight", F.explode("later").alias("item_j")).select(
        "item_i", "item_j", weight.alias("w"), (weight * weight).alias("w2")
    )


def item_pairs(sets: DataFrame, largest_set: int) -> DataFrame:
    """All pairs within each user, one row each. Narrow: no join, no shuffle, no Python."""
    return expand(anchors(sets, largest_set))


def uncapped_cells(events: DataFrame, alpha: float) -> DataFrame:
    """All items of every user, however many a user has: ``user_id, deg, weight, cells, cell, items``.

    No user is gathered whole: items are dealt by hash into ``cells`` of about ``BLOCK``, ``items`` are sorted.
    """
    if alpha <= -1:
        raise ValueError(f"alpha must be greater than -1, not {alpha}")
    items = events.select("user_id", "creation_id").distinct()
    degrees = items.groupBy("user_id").agg(F.count(F.lit(1)).alias("deg")).where("deg > 1")
    cells = F.ceil(F.col("deg") / F.lit(BLOCK)).cast("bigint")
    dealt = items.join(degrees, "user_id").withColumn("cells", cells)
    dealt = dealt.withColumn("cell", F.pmod(F.xxhash64("creation_id"), F.col("cells")))
    gathered = dealt.groupBy("user_id", "deg", "cells", "cell").agg(F.sort_array(F.collect_set("creation_id")).alias("items"))
    return gathered.withColumn("weight", F.lit(1.0) / (F.col("deg") + F.lit(float(alpha))))


def cell_pair_count() -> Column:
    """``pair_count`` of what ``uncapped_cells`` gives."""
    ends = F.sum(F.size("items").cast("bigint") * (F.col("deg") - 1))
    return F.coalesce(F.call_function("div", ends, F.lit(2)), F.lit(0))


def cell_anchors(cells: DataFrame, both: bool = False) -> DataFrame:
    """``anchors`` of ``uncapped_cells``: every two cells of a user meet in a task of their own, and so does each with itself."""
    alone = _whole_anchors(cells, both)
    several = cells.where("cells > 1").select("*", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("other")).where("cell <> other")
    met = several.groupBy("user_id", "weight", F.least("cell", "other").alias("a"), F.greatest("cell", "other").alias("b")).agg(
        F.first(F.when(F.col("cell") < F.col("other"), F.col("items")), ignorenulls=True).alias("left"),
        F.first(F.when(F.col("cell") > F.col("other"), F.col("items")), ignorenulls=True).alias("right"),
    ).where("left IS NOT NULL AND right IS NOT NULL")
    sides = F.array(F.struct(F.col("left").alias("here"), F.col("right").alias("there")), F.struct(F.col("right").alias("here"), F.col("left").alias("there")))
    ones = met.select("weight", F.inline(sides)).select("weight", "there", F.explode("here").alias("item_i"))
    there = F.col("there") if both else F.filter("there", lambda x: x > F.col("item_i"))
    return alone.unionAll(ones.select("item_i", "weight", there.alias("later")))


# --- fixed values: weights and their squares are summed in units of 2^-50 and 2^-60, each as the
# sums of its upper and lower bits, so sums are exact for over 10^9 common users -----------------
W_BITS, W_LOW = 50, 25
W2_BITS, W2_LOW = 60, 30
# -------------------------------------------------------------------------------------------


#: What is summed per pair: common users, and the halves of the sums of weights and of their squares.
SUMS = ("n", "w_high", "w_low", "w2_high", "w2_low")


def _halves(value: Column, bits: int, low: int, name: str) -> dict[str, Column]:
    whole = F.rint(value * F.lit(float(2**bits))).cast("bigint")
    return {f"{name}_high": F.shiftright(whole, low), f"{name}_low": whole.bitwiseAND(2**low - 1)}


def _parts(w: Column, w2: Column) -> dict[str, Column]:
    """What one common user adds to ``SUMS``, but for ``n``."""
    return {**_halves(w, W_BITS, W_LOW, "w"), **_halves(w2, W2_BITS, W2_LOW, "w2")}


def _joined(bits: int, low: int, name: str) -> Column:
    high, rest = F.col(f"{name}_high").cast("double"), F.col(f"{name}_low").cast("double")
    return (high * F.lit(float(2**low)) + rest) / F.lit(float(2**bits))


# powers of ten that `significant` tells apart
_LEAST_POWER, _MOST_POWER = -24, 12


def significant(value: Column, digits: int) -> Column:
    """``value`` (not negative) rounded half-even to ``digits`` significant digits; below 1e-24 it is 0.

    The logarithm finds the power of ten, one comparison each way corrects it at the edges.
    """
    powers = range(_LEAST_POWER, _MOST_POWER + 1)
    floors = F.array(*(F.lit(float(f"1e{p}")) for p in powers))
    units = F.array(*(F.lit(float(f"1e{digits - 1 - p}")) for p in powers))
    last = len(powers) - 1
    near = F.least(F.greatest(F.floor(F.log10(value)).cast("int") - _LEAST_POWER, F.lit(0)), F.lit(last))
    up, down = F.least(near + 1, F.lit(last)), F.greatest(near - 1, F.lit(0))
    place = F.when(value >= F.get(floors, up), up).when(value < F.get(floors, near), down).otherwise(near)
    unit = F.get(units, place)
    return F.when(value >= F.lit(float(f"1e{_LEAST_POWER}")), F.rint(value * unit) / unit).otherwise(F.lit(0.0))


def pair_sums(pairs: DataFrame) -> DataFrame:
    """``item_i, item_j`` and the columns ``SUMS``: whole numbers, so that sums of sums are exact, taking away included.

    Weights are below 1 (a pair needs two items) and are summed in a fixed unit. Sums combine within each task before
    the shuffle, so a hot pair never travels as rows, and pairs of a hot item go to different tasks. A column
    ``sign`` (1 or -1), if there is one, says which pairs are added and which taken out.
    """
    return _summed(pairs, ["item_i", "item_j"])


#: Pairs that one task sends on, those that one adds up, and those of one item that stay together.
SENT_PER_TASK, SUMMED_PER_TASK, PAIRS_PER_ITEM = 16_000_000, 2_000_000, 16_000_000


def tasks_for(pairs: int, per_task: int, least: int) -> int:
    return max(least, -(-pairs // per_task))


def sizes(sets: DataFrame, both: bool = False) -> tuple[int, list[tuple[int, int]]]:
    """How many pairs the sets make, and the items that have too many for one task with the parts to cut them into.

    One job; its one row holds at most as many items as pairs fill parts.
    """
    size = F.size("items") if "cell" not in sets.columns else F.col("deg")  # of cells, an upper bound of an item's pairs
    after = size - 1 if both or "cell" in sets.columns else size - 1 - F.col("pos")
    rows = sets.select("*", F.posexplode("items").alias("pos", "item_i")).select("item_i", after.cast("bigint").alias("load"))
    item = rows.groupBy("item_i").agg(F.sum("load").alias("load"))
    parts = F.ceil(F.col("load") / F.lit(PAIRS_PER_ITEM)).cast("int")
    hot = F.collect_list(F.when(F.col("load") > PAIRS_PER_ITEM, F.struct("item_i", parts.alias("parts"))))
    found = item.agg(F.coalesce(F.sum("load"), F.lit(0)).alias("pairs"), hot.alias("hot")).first()
    return found["pairs"], [tuple(row) for row in found["hot"]]


#: Pairs of one item among which those with one common user are told apart in one array.
SORTED_MOST = 1_000_000


def sums_of_anchors(
    anchor_rows: DataFrame, tasks: int, hot: list[tuple[int, int]] | None = None, lone: int | None = None
) -> DataFrame:
    """``pair_sums`` of the pairs that anchors stand for, in ``tasks`` tasks by ``item_i``.

    What is sent are the anchors, as distances: two bytes a pair where the items of a user lie within 2^15 of each other, three
    within 2^23, four within 2^31, and eight elsewhere. Pairs are made where they are added up, so none of them travels as a row. ``hot``
    names items and the parts into which their partners are dealt, by hash; with None the tasks are those of ``item_i`` alone, and Spark
    knows. With a number as ``lone``, pairs of one common user, which score 0, may be missing but for those with the ``lone`` smallest
    partners of an item: lists of that length hold no others.
    """
    kept, keys = _kept(anchor_rows), ["item_i"]
    rows = anchor_rows
    if hot is not None:
        keys.append("part")
    if hot == []:
        # 0, but no constant: Spark takes what is dealt by it for several parts, and cuts rankings before their shuffle
        rows = rows.withColumn("part", F.pmod(F.hash("item_i"), F.lit(1)))
    elif hot:
        parts = rows.sparkSession.createDataFrame(hot, f"item_i {dict(rows.dtypes)['item_i']}, parts int")
        cut = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda p: F.filter("later", lambda x: F.pmod(F.xxhash64(x), F.col("parts")) == p))
        rows = rows.join(F.broadcast(parts), "item_i", "left").select(
            "item_i", *kept, F.posexplode(F.when(F.col("parts").isNull(), F.array("later")).otherwise(cut)).alias("part", "later"))
    if dict(rows.dtypes)["item_i"] == "bigint":
        rows = rows.select(*keys, *kept, *_distances()).repartition(tasks, *keys).select(*keys, *kept, _near(), "far")
        listed = [F.col("near").cast("array<bigint>"), F.col("far")]
        if lone is not None:
            rows = _with_candidates(rows, keys, lone)
            listed.insert(0, F.array_intersect("near", "candidates").cast("array<bigint>"))
        base = F.when(F.col("far").isNull(), F.col("item_i")).otherwise(F.lit(0).cast("bigint"))
        rows = rows.select(*keys, *kept, base.alias("from"), F.explode(F.coalesce(*listed)).alias("to"))
        rows = rows.select(*keys, *kept, (F.col("from") + F.col("to")).alias("item_j"))
    else:
        rows = rows.repartition(tasks, *keys).select(*keys, *kept, F.explode("later").alias("item_j"))
    rows = rows.where(F.col("item_i") != F.col("item_j")).withColumn("w", F.col("weight")).withColumn("w2", F.col("weight") * F.col("weight"))
    return _summed(rows, [*keys, "item_j"]).select("item_i", "item_j", *SUMS)


def _distances() -> list[Column]:
    """``near_low, near_high, near_whole, far``: the sorted ``later`` less ``item_i`` in as few bytes as hold it, the others null.

    ``near_low`` has the lower 16 bits, with their sign, and ``near_high``, unless all of it is 0, what is above; elements are known not to be null.
    """
    first, last = (F.try_subtract(F.get("later", at), F.col("item_i")) for at in (F.lit(0), F.size("later") - 1))

    def within(most: int) -> Column:
        return F.coalesce((first >= -most) & (last < most), F.size("later") == 0)

    def each(of: Callable[[Column], Column]) -> Column:
        return F.transform("later", lambda x: F.coalesce(of((x - F.col("item_i")).cast("int")), F.lit(0)))

    def low(x: Column) -> Column:
        return F.shiftright(F.shiftleft(x, 16), 16)

    short, three, four = within(2**15), within(2**23 - 2**15), within(2**31)
    return [
        F.when(three, each(low).cast("array<smallint>")).alias("near_low"),
        F.when(three & ~short, each(lambda x: F.shiftright(x - low(x), 16)).cast("array<tinyint>")).alias("near_high"),
        F.when(four & ~three, each(lambda x: x)).alias("near_whole"),
        F.when(~four, F.transform("later", lambda x: F.coalesce(x, F.lit(0).cast("bigint")))).alias("far"),
    ]


def _near() -> Column:
    """``near``: whole distances again, null where they are ``far``."""
    joined = F.zip_with("near_high", "near_low", lambda high, low: F.coalesce(high.cast("int") * F.lit(2**16) + low, F.lit(0)))
    return F.coalesce(joined, F.col("near_low").cast("array<int>"), F.col("near_whole")).alias("near")


def _with_candidates(rows: DataFrame, keys: list[str], lone: int) -> DataFrame:
    """Anchors with the distances of ``candidates``: partners with two common users or more, and the ``lone`` smallest ones.

    All distances of an item are sorted in one array, where a partner of several users stands beside itself. Null, which
    stands for all partners, is given where that takes too long an array or saves too little, and where distances are ``far``.
    """
    item = rows.groupBy(*keys).agg(F.collect_list(F.struct(*(c for c in rows.columns if c not in keys))).alias("anchors"))
    item = item.select(*keys, "anchors", F.array_remove(F.flatten(F.col("anchors")["near"]), 0).alias("all"))
    item = item.select(*keys, "anchors", F.when(F.size("all") <= SORTED_MOST, F.sort_array("all")).alias("all"))
    item = item.select(*keys, "anchors", "all", F.filter("all", lambda x, at: x == F.get("all", at + 1)).alias("several"))
    least = F.array_distinct(F.slice("all", 1, F.size("several") + lone))  # holds that many others, or all there are
    found = F.concat("several", least) if lone else F.col("several")
    item = item.select(*keys, "anchors", F.size("all").alias("pairs"), found.alias("candidates"))
    # each anchor is held against the candidates anew
    few = F.size("anchors").cast("bigint") * F.size("candidates") <= F.col("pairs") * 4
    return item.select(*keys, F.when(few, F.col("candidates")).alias("candidates"), F.inline("anchors"))


def _summed(pairs: DataFrame, keys: list[str]) -> DataFrame:
    sign = F.col("sign") if "sign" in pairs.columns else None
    n = F.count(F.lit(1)) if sign is None else F.sum(sign).cast("bigint")
    sums = (F.sum(part if sign is None else sign * part).alias(name) for name, part in _parts(F.col("w"), F.col("w2")).items())
    return pairs.groupBy(*keys).agg(n.alias("n"), *sums)


def compact_sums(sums: DataFrame, alpha: float) -> DataFrame:
    """``item_i, item_j`` and ``SUMS`` as they are stored: a pair of one common user has the size of its set, ``lone``, instead.

    Only where all sums follow from the size; ``whole_sums`` gives them back.
    """
    whole = F.shiftleft("w_high", W_LOW) + F.col("w_low")
    deg = F.rint(F.try_divide(F.lit(float(2**W_BITS)), whole) - F.lit(float(alpha))).try_cast("int")
    rows = sums.withColumn("deg", F.when(F.col("n") == 1, deg)).withColumn("of_one", _parts_of_one("deg", alpha))
    follows = F.lit(True)
    for name in SUMS[1:]:
        follows = follows & (F.col("of_one")[name] == F.col(name))
    rows = rows.withColumn("lone", F.when(F.coalesce(follows, F.lit(False)), F.col("deg")))
    return rows.select("item_i", "item_j", "lone", *(F.when(F.col("lone").isNull(), F.col(name)).alias(name) for name in SUMS))


def whole_sums(stored: DataFrame, alpha: float) -> DataFrame:
    """``item_i, item_j`` and ``SUMS`` of what ``compact_sums`` gave, or as they are if nothing is left out of them."""
    if "lone" not in stored.columns:
        return stored
    rows = stored.withColumn("of_one", _parts_of_one("lone", alpha))
    parts = (F.coalesce(F.col(name), F.col("of_one")[name]).alias(name) for name in SUMS[1:])
    return rows.select("item_i", "item_j", F.coalesce("n", F.lit(1).cast("bigint")).alias("n"), *parts)


def _parts_of_one(deg: str, alpha: float) -> Column:
    """What one user with ``deg`` items adds to ``SUMS``, but for ``n``; null without such a user."""
    weight = F.lit(1.0) / (F.col(deg) + F.lit(float(alpha)))
    return F.when(F.col(deg) > F.lit(-float(alpha)), F.struct(*(part.alias(name) for name, part in _parts(weight, weight * weight).items())))


def raw_score() -> Column:
    """The score behind the columns ``SUMS``, not rounded. One common user scores exactly 0."""
    one, two = _joined(W_BITS, W_LOW, "w"), _joined(W2_BITS, W2_LOW, "w2")
    return F.when(F.col("n") <= 1, F.lit(0.0)).otherwise(F.greatest(one * one - two, F.lit(0.0)))


def scores_of_sums(sums: DataFrame, digits: int) -> DataFrame:
    """``item_i, item_j, score``, rounded half-even to ``digits`` significant digits."""
    return sums.select("item_i", "item_j", raw_score().alias("score")).select(
        "item_i", "item_j", significant(F.col("score"), digits).alias("score")
    )


def both_directions(scores: DataFrame) -> DataFrame:
    """Every pair under each of its two items."""
    i, j = F.col("item_i"), F.col("item_j")
    ways = F.array(
        F.struct(i.alias("item_i"), j.alias("item_j")), F.struct(j.alias("item_i"), i.alias("item_j"))
    )
    return scores.select(F.inline(ways), "score")


def best_neighbours(scores: DataFrame, top_k: int) -> DataFrame:
    """The ``top_k`` highest scores of each ``item_i``; equal scores go to the smaller item."""
    highest = [F.col("score").desc(), F.col("item_j").asc()]
    return top_n_per_key(scores, ["item_i"], highest, top_k)
