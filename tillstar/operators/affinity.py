"""Exact top-k item pairs by co-occurrence, without listing the pairs of wide baskets.

``score(p, q)`` is the number of line pairs of ``p`` and ``q`` that share a basket. Baskets are split by size:

* Narrow baskets (at most ``wide_basket`` lines) are joined with themselves; each yields a bounded number of pairs.
* Wide baskets are first reduced to one row per basket and item with its line count ``c``. Their share of a score is
  the dot product of two count vectors. Pairs that surely have their score give a floor for the k-th best one, and two
  bounds rule out what cannot reach it:

  - by Cauchy-Schwarz a share is at most ``sqrt(s_p * s_q)`` with ``s_p`` = the sum of ``c^2``;
  - with baskets put in order by size, an item may leave out its widest baskets as long as what they could give with the
    greatest count in each, ``c`` times that count, stays below the floor. A pair that reaches the floor then shares a
    basket that neither left out: the narrowest one that they share. Pairs are only formed there. A flat basket of any
    width is left out by all its items once some pair scores more than it gives.

  Pairs that merely tie with the floor count only if they come before the last sure pair, so only items up to its first
  are looked at for ties. What is left is counted exactly over all baskets.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillstar.operators.joins import few
from tillstar.session import materialised

_WIDE = "decimal(38,0)"  # sums of products of counts outgrow 64 bits on very wide baskets
# Relative allowance for rounding in the floating-point bounds. It is only ever added on the side that keeps more.
_SLACK = 1.0 - 1e-12


def _ranked(scores: DataFrame, k: int) -> DataFrame:
    return scores.orderBy(F.desc("n"), "item_1", "item_2").limit(k)


def _narrow_pairs(lines: DataFrame) -> DataFrame:
    other = lines.select("basket", F.col("item").alias("item_2"))
    return (
        lines.withColumnRenamed("item", "item_1")
        .join(other, "basket")
        .filter(F.col("item_1") < F.col("item_2"))
        .groupBy("item_1", "item_2")
        .agg(F.count("*").alias("n"))
    )


def _dot_products(entries: DataFrame) -> DataFrame:
    """Scores of the pairs of entries that share a wide basket."""
    a = entries.select("basket", F.col("item").alias("item_1"), F.col("c").alias("c_1"))
    b = entries.select("basket", F.col("item").alias("item_2"), F.col("c").alias("c_2"))
    return (
        a.join(b, "basket")
        .filter(F.col("item_1") < F.col("item_2"))
        .groupBy("item_1", "item_2")
        .agg(F.sum(F.col("c_1").cast(_WIDE) * F.col("c_2")).cast(_WIDE).alias("n"))
    )


def top_pairs(lines: DataFrame, basket: str, item: str, k: int = 5, wide_basket: int = 200) -> DataFrame:
    """The ``k`` item pairs (``item_1 < item_2``) of highest ``pair_count``; ties go to the lower items."""
    lines = lines.select(F.col(basket).alias("basket"), F.col(item).alias("item")).dropna()
    sizes = lines.groupBy("basket").agg(F.count("*").alias("lines"))
    wide = sizes.filter(F.col("lines") > wide_basket).select("basket")
    if wide.isEmpty():
        best = _ranked(_narrow_pairs(lines), k)
    else:
        best = _with_wide_baskets(lines, wide, k)
    return best.select("item_1", "item_2", F.col("n").cast("bigint").alias("pair_count"))


def _with_wide_baskets(lines: DataFrame, wide: DataFrame, k: int) -> DataFrame:
    wide = materialised(wide)
    narrow = materialised(_narrow_pairs(lines.join(wide, "basket", "left_anti")).withColumn("n", F.col("n").cast(_WIDE)))
    counts = materialised(
        lines.join(wide, "basket", "left_semi").groupBy("basket", "item").agg(F.count("*").alias("c"))
    )
    weights = materialised(
        counts.groupBy("item").agg(F.sum(F.col("c").cast("double") * F.col("c")).alias("s"))
    )
    baskets = materialised(counts.groupBy("basket").agg(
        F.max("c").alias("most"), F.floor(F.log2(F.count("*")) * _CLASSES).cast("int").alias("width")))
    reach, last = _floor(narrow, counts, weights, baskets, k)

    lefts = _kept(counts, weights, baskets, reach + 1)
    rights = lefts
    candidates = _meeting(lefts, rights)
    ties = F.lit(True)
    if last is not None:
        ties = (F.col("item_1") < F.lit(last["item_1"])) | (
            (F.col("item_1") == F.lit(last["item_1"])) & (F.col("item_2") <= F.lit(last["item_2"])))
    rights = _kept(counts, weights, baskets, reach)
    lefts = rights if last is None else rights.filter(F.col("item") <= F.lit(last["item_1"]))
    candidates = candidates.unionByName(_meeting(lefts, rights).filter(ties)).distinct()

    # Pairs seen in narrow baskets that can still reach the floor get their wide share added.
    none = F.lit(0.0)
    hopeful = (
        narrow.join(weights.toDF("item_1", "s_1"), "item_1", "left")
        .join(weights.toDF("item_2", "s_2"), "item_2", "left")
        .filter(
            F.col("n").cast("double") + F.sqrt(F.coalesce("s_1", none) * F.coalesce("s_2", none))
            >= F.lit(float(reach) * _SLACK)
        )
        .select("item_1", "item_2", "n")
    )
    pairs = candidates.withColumn("n", F.lit(0).cast(_WIDE))
    pairs = narrow.join(candidates, ["item_1", "item_2"], "left_semi").unionByName(pairs).unionByName(hopeful)
    pairs = materialised(pairs.groupBy("item_1", "item_2").agg(F.max("n").alias("n")))
    return _ranked(_with_shares(pairs, counts), k)


def _with_shares(pairs: DataFrame, counts: DataFrame) -> DataFrame:
    """Pairs with what the wide baskets give, exactly, added to ``n``."""
    share = (
        pairs.select("item_1", "item_2")
        .join(counts.toDF("basket", "item_1", "c_1"), "item_1")
        .join(counts.toDF("basket", "item_2", "c_2"), ["basket", "item_2"])
        .groupBy("item_1", "item_2")
        .agg(F.sum(F.col("c_1").cast(_WIDE) * F.col("c_2")).cast(_WIDE).alias("n"))
    )
    total = pairs.unionByName(share).groupBy("item_1", "item_2").agg(F.sum("n").cast(_WIDE).alias("n"))
    return total.filter("n > 0")


def _floor(narrow: DataFrame, counts: DataFrame, weights: DataFrame, baskets: DataFrame, k: int):
    """A score that k pairs surely reach, and the last of these pairs; 0 and None when fewer pairs are known.

    Tried are the best pairs of the narrow baskets, the heaviest items of the wide ones and the lowest items of the widest.
    """
    heaviest = weights.orderBy(F.desc("s"), "item").limit(4 * k).select("item")
    widest = baskets.orderBy(F.desc("width"), "basket").limit(1).select("basket")
    lowest = counts.join(few(widest, 1), "basket", "left_semi").orderBy("item").limit(4 * k).select("item")
    items = heaviest.unionByName(lowest).distinct()
    seeds = counts.join(few(items, 8 * k), "item", "left_semi")
    tried = _ranked(narrow, 4 * k).select("item_1", "item_2").unionByName(
        _ranked(_dot_products(seeds), 4 * k).select("item_1", "item_2")).distinct()
    tried = materialised(few(tried, 8 * k).join(narrow, ["item_1", "item_2"], "left").select(
        "item_1", "item_2", F.coalesce("n", F.lit(0)).cast(_WIDE).alias("n")))
    found = _ranked(_with_shares(tried, counts), k).collect()  # at most k rows
    return (0, None) if len(found) < k else (int(found[-1]["n"]), found[-1])


#: Steps of a doubling of a basket's size that count as different widths.
_CLASSES = 4


def _kept(counts: DataFrame, weights: DataFrame, baskets: DataFrame, floor: int) -> DataFrame:
    """The entries that an item keeps: without its widest baskets that together stay below the floor.

    Widths are few, so the sums run over a handful of rows an item, however many baskets it is in.
    """
    if floor <= 1:  # one shared line is enough
        return counts.join(weights, "item").join(baskets.select("basket", "width"), "basket")
    strongest = weights.agg(F.max("s")).first()[0] or 0.0
    strong = weights.filter(F.col("s") * F.lit(strongest) >= F.lit(float(floor) ** 2 * _SLACK))
    entries = counts.join(strong, "item").join(baskets, "basket")
    gives = (F.col("c").cast(_WIDE) * F.col("most")).cast(_WIDE)
    sums = entries.groupBy("item", "width").agg(F.sum(gives).cast(_WIDE).alias("gives"))
    wider = Window.partitionBy("item").orderBy(F.desc("width"))
    cut = (sums.withColumn("upto", F.sum("gives").over(wider)).filter(F.col("upto") >= F.lit(floor))
           .groupBy("item").agg(F.max("width").alias("widest")))
    return entries.join(cut, "item").filter(F.col("width") <= F.col("widest")).select("basket", "item", "c", "s", "width")


def _meeting(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs of kept entries that share a basket."""
    a = left.select("basket", F.col("item").alias("item_1"))
    b = right.select("basket", F.col("item").alias("item_2"))
    return a.join(b, "basket").filter(F.col("item_1") < F.col("item_2")).select("item_1", "item_2").distinct()
