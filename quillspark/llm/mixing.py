"""Mixing sources to target weights by Pfair scheduling.

The documents of a source, in a hashed order, form blocks.  With weight w, the k-th block (from 0) of a source has the
release time floor(k / w) and the deadline ceil((k + 1) / w); of the released blocks the one with the earliest deadline
gets the next slot.  So after t slots a source has had t * w blocks, less than one more or fewer.

Weights are exact: the targets are brought to whole parts with a common denominator, a source's weight is its parts
over those of all live sources, and release times and deadlines are quotients of whole numbers.  The schedule repeats
after as many slots as there are parts, so the driver computes one such period for the live sources, and a block's slot
follows from its number.  When a source ends, the others' parts stay and a new phase begins with a shorter period; there
are as many phases as sources at most.  Every document gets exactly one place.

What the driver holds is bounded by EXACT numbers.  Only where a period times the live sources is larger (targets with
huge denominators) are the parts brought to the nearest of PERIOD in all, and the bound of one block then
holds against those.

The number of sources scheduled one by one is bounded by SOURCES.  With more the LARGE ones of most weight are scheduled as above,
each on its own; the others are put together by the time at which they end (four classes to a doubling), and a class is
scheduled like one source with the sum of its weights and blocks.  In its class, the k-th block of a source with weight
w comes by (k + u) / w, u a hash of the source in [0, 1), so inside the fluid schedule's span of that block.  The bound
of one block holds for the large sources and for classes as wholes; a class keeps its weight until its last block.

Cases: a null source is a source of its own (None among the targets); a source without a target has OTHER; empty and very
long texts and repeated rows are placed like any other; ties of the hash fall to the text's hash; an empty table gives an empty result; other
columns stay as they are, and a name among block, slot and place that is taken gets underscores.
"""

from __future__ import annotations

from fractions import Fraction
from heapq import heappop, heappush
from math import gcd, lcm

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import parallelism

BLOCK, PERIOD, SOURCES, LARGE = 32, 10_000, 500, 200
#: Numbers of a phase's schedule that the driver holds at most: slots of the period times live sources.
EXACT = 1 << 22
#: Steps to a doubling of the end time, and the classes at most on either side of 1; LARGE and all classes stay below SOURCES.
STEPS, FARTHEST = 4, 120
#: Where no targets are given at all: shares in proportion to size to this power, the usual tempering of large sources.
TEMPER = 0.7
#: The target weights of op9 and of the pipeline, in parts, and that of each source which is not named.
TARGETS: dict[str | None, int] = {"src0": 12, "src1": 10, "src2": 9, "src3": 8, "src4": 7, "src5": 7, "src6": 6, "src7": 6, "src8": 5, "src9": 5, "src10": 4, "src11": 4, "src12": 3, "src13": 3, "src14": 3, "src15": 2, "src16": 2, "src17": 2, "src18": 1, "src19": 1}
OTHER = 1
#: A target given as a float stands for the fraction of the least denominator up to this that is nearest to it.
DENOMINATOR = 1_000_000


def whole_parts(weights: dict) -> dict:
    """The weights as whole numbers in the same proportions."""
    exact = {s: Fraction(w) if isinstance(w, (int, Fraction)) else Fraction(w).limit_denominator(DENOMINATOR) for s, w in weights.items()}
    exact = {s: w or Fraction(1, DENOMINATOR) for s, w in exact.items()}
    below = lcm(*(w.denominator for w in exact.values())) if exact else 1
    parts = {s: int(w * below) for s, w in exact.items()}
    common = gcd(*parts.values()) or 1
    return {s: a // common for s, a in parts.items()}


def shares(weights: dict, period: int = PERIOD) -> dict:
    """Slots of a period for each source, by largest remainders, one at least."""
    total = sum(weights.values())
    exact = {s: Fraction(w) * period / Fraction(total) for s, w in weights.items()}
    out = {s: max(1, int(x)) for s, x in exact.items()}
    order = sorted(weights, key=lambda s: (int(exact[s]) - exact[s], str(s)))
    i = 0
    while sum(out.values()) < period:
        out[order[i % len(order)]] += 1
        i += 1
    while sum(out.values()) > period:
        out[max(out, key=lambda s: (out[s], str(s)))] -= 1
    return out


def one_period(share: dict, period: int = PERIOD) -> dict[object, list[int]]:
    """Slots of the blocks of a period: earliest deadline first among those released."""
    slots: dict[object, list[int]] = {s: [] for s in share}
    coming = [(0, -(-period // a), str(s), s, 0) for s, a in share.items()]
    coming.sort(key=lambda x: x[:3])
    heap: list = []
    later: list = []
    for x in coming:
        heappush(later, x)
    for t in range(period):
        while later and later[0][0] <= t:
            release, deadline, name, s, k = heappop(later)
            heappush(heap, (deadline, release, name, s, k))
        deadline, release, name, s, k = heappop(heap)
        slots[s].append(t)
        a, k = share[s], k + 1
        if k < a:
            heappush(later, (k * period // a, -(-(k + 1) * period // a), name, s, k))
    return slots


def phases(weights: dict, blocks: dict, period: int = PERIOD) -> list[tuple]:
    """(source, first block, blocks a period, first slot, slots of a period, length of the period) for each phase and live source."""
    left, done, slot, out = {s: n for s, n in blocks.items() if n}, dict.fromkeys(blocks, 0), 0, []
    parts = whole_parts({s: weights[s] for s in left})
    while left:
        share = {s: parts[s] for s in left}
        common = gcd(*share.values())
        share = {s: a // common for s, a in share.items()}
        if sum(share.values()) * len(left) > EXACT:
            share = shares(share, max(period, len(left)))
        size = sum(share.values())
        table = one_period(share, size)
        at = lambda s, k: (k // share[s]) * size + table[s][k % share[s]]  # noqa: E731, B023
        end = min(at(s, n - 1) for s, n in left.items()) + 1  # slots until the first source ends
        whole, rest = divmod(end, size)
        for s in list(left):
            out.append((s, done[s], share[s], slot, table[s], size))
            n = whole * share[s] + sum(x < rest for x in table[s])
            done[s] += n
            left[s] -= n
            if not left[s]:
                del left[s]
        slot += end
    return out


def added(columns: list[str]) -> tuple[str, str, str]:
    """Names for block, slot and place that no column has: underscores are added to one that is taken."""
    out = []
    for name in ("block", "slot", "place"):
        while name.lower() in {c.lower() for c in columns}:
            name += "_"
        out.append(name)
    return tuple(out)


#: The key of the sources without a target among the parts.
OTHERS = object()


def many(totals: DataFrame, weights: dict | None, block: int, buckets: int, other=OTHER) -> tuple[dict, dict, DataFrame]:
    """Weights and blocks of the large sources and of the classes of all others; for each block of the others its class and number there."""
    spark = totals.sparkSession
    if weights:
        parts = whole_parts({**weights, OTHERS: other})
        least = parts.pop(OTHERS)
        given = [("0" if s is None else f"1{s}", a) for s, a in parts.items()]
        named = spark.createDataFrame(given, "source string, w long")
        weighed = totals.join(named, "source", "left").withColumn("w", F.coalesce("w", F.lit(least)))
    else:
        weighed = totals.withColumn("w", F.round(F.pow("n", F.lit(TEMPER)) * 1000).cast("long"))
    weighed = weighed.withColumn("blocks", F.ceil(F.col("n") / block).cast("long"))
    large = weighed.orderBy(F.desc("w"), F.desc("n"), "source").limit(LARGE).collect()
    names = spark.createDataFrame([(r.source,) for r in large], "source string")
    step = F.floor(F.log2(F.col("blocks") / F.col("w")) * STEPS)
    step = F.greatest(F.lit(-FARTHEST), F.least(F.lit(FARTHEST), step))
    rest = weighed.join(F.broadcast(names), "source", "left_anti").withColumn("step", step).withColumn("class", F.concat(F.lit("2"), "step"))
    classes = rest.groupBy("class").agg(F.sum(F.col("w").cast("decimal(28,0)")).alias("w"), F.sum("blocks").alias("blocks")).collect()
    own = {r.source: r.w for r in large} | {r["class"]: int(r.w) for r in classes}
    blocks = {r.source: r.blocks for r in large} | {r["class"]: r.blocks for r in classes}
    u = F.shiftrightunsigned(F.xxhash64("source", F.lit(20_012)), 11) / F.lit(float(1 << 53))
    due = rest.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).withColumn("due", (F.col("block") + u) / F.col("w"))
    share = F.col("due") / F.pow(F.lit(2.0), (F.col("step") + 1) / STEPS)  # from 0 to 1 but for the outermost classes
    due = due.withColumn("part", F.least(F.lit(buckets - 1), F.floor(share * buckets)))
    before = Window.partitionBy("class").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = due.groupBy("class", "part").agg(F.count(F.lit(1)).alias("c")).withColumn("before", F.coalesce(F.sum("c").over(before), F.lit(0))).drop("c")
    nth = Window.partitionBy("class", "part").orderBy("due", "source", "block")
    small = due.withColumn("nth", F.row_number().over(nth) - 1).join(offsets, ["class", "part"])
    return own, blocks, small.select("source", "block", "class", (F.col("before") + F.col("nth")).alias("nth_block"))


def mix_sources(docs: DataFrame, weights: dict | None = None, block: int = BLOCK, source: str = "source", other=OTHER) -> DataFrame:
    """docs with block (number in its source), slot (place of the block among all) and place (row in the block).

    weights: the target of each source (None for the null source); a source that has none, or one of zero, has other.
    """
    spark = docs.sparkSession
    buckets = parallelism(spark) * 8
    tie = F.xxhash64("text") if "text" in docs.columns else F.lit(0).cast("long")
    name = F.col(f"`{source}`").cast("string")
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.when(name.isNull(), F.lit("0")).otherwise(F.concat(F.lit("1"), name)).alias("source"),
        F.xxhash64(F.col("doc_id"), F.lit(20_011)).alias("key"),
        tie.alias("tie"),
    ).withColumn("bucket", F.shiftrightunsigned("key", 33) % buckets)
    counts = rows.groupBy("source", "bucket").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("source").agg(F.sum("n").alias("n"))
    sizes = {r[0]: r[1] for r in totals.limit(SOURCES + 1).collect()}
    small = None
    if len(sizes) > SOURCES:
        own, blocks, small = many(totals, {s: w for s, w in weights.items() if w > 0} if weights else None, block, buckets, other)
    else:
        own = {s: (weights.get(None if s[0] == "0" else s[1:]) or other) if weights else round(1000 * n**TEMPER) for s, n in sizes.items()}
        blocks = {s: -(-n // block) for s, n in sizes.items()}
    plan = phases(own, blocks)
    spans = spark.createDataFrame(plan, "unit string, first long, share long, start long, slots array<int>, size long")
    later = Window.partitionBy("unit").orderBy("first", "start")
    spans = spans.withColumn("end", F.coalesce(F.lead("first").over(later), F.lit(1 << 62))).filter("first < end")
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))).select("source", "bucket", "before")
    nth = Window.partitionBy("source", "bucket").orderBy("key", "tie")
    rank = rows.withColumn("nth", F.row_number().over(nth) - 1).join(offsets, ["source", "bucket"]).withColumn("rank", F.col("before") + F.col("nth"))
    rank = rank.withColumns({"block": F.expr(f"rank div {block}"), "place": (F.col("rank") % block).cast("int")})
    if small is None:
        rank = rank.withColumns({"unit": F.col("source"), "at": F.col("block")})
    else:
        rank = rank.join(small, ["source", "block"], "left").withColumns({"unit": F.coalesce("class", "source"), "at": F.coalesce("nth_block", "block")})
    placed = rank.join(F.broadcast(spans), "unit").filter("at >= first and at < end")  # spans: SOURCES * (SOURCES + 1) / 2 rows at most
    k = F.col("at") - F.col("first")
    slot = F.col("start") + F.expr("(at - first) div share * size") + F.element_at("slots", ((k % F.col("share")) + 1).cast("int"))
    names = added(docs.columns)
    return placed.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns], F.col("block").alias(names[0]), slot.cast("long").alias(names[1]), F.col("place").alias(names[2]))
