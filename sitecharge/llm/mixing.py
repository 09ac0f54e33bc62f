"""Mixing sources to target weights with a low-discrepancy schedule.

A document's size is its number of words. Sources in order of code point (null last) weigh ``WEIGHTS`` in
turn; together they get ``share`` times all words, each at most ``most`` times what it has, and what a
source cannot take is shared anew by weight among the others. Every source's documents, in a hashed order, form a
stream that is cut into blocks of ``block`` words. Point i of the golden-ratio sequence, mapped through the
cumulative targets, names the source of slot i; its n-th slot takes the source's n-th block, from
the first again when all are taken, and the last slot only what is left of the target. Slots that a
source has left when the sequence ends follow it.

Rows without text have size 0 and are taken with 0 words; a source without words has target 0. A null or
repeated doc_id makes no difference (rows are told apart by a number for equal rows, so that equal rows lie one
after another in the stream). Extra columns are ignored. The result is the same for every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sitecharge.llm.shared import ranked, stored

WEIGHTS = [3, 1, 2]
SHARE = 1.5
MOST = 2.0
BLOCK_WORDS = 4096
#: Parts that a source's stream, and the schedule, are summed in.
_PARTS = 4096
_GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    """Words are runs of characters other than ASCII white space."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def targets(sources: DataFrame, weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(place, target) added to unique sources of (source, source_size).

    A source is full if its share by weight reaches its limit, which those with the least limit per weight
    do first: in this order, one is full if, what the ones before it take at their limits left
    out, its share of the rest by weight reaches its limit.
    """
    numbered = ranked(sources, [F.col("source").isNull(), F.col("source")], "place")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.col("place") % len(weights) + 1).cast("int"))
    numbered = numbered.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(most))
    level = F.col("limit") / F.col("weight")
    filled = stored(ranked(numbered, [level, F.col("place")], "turn", {"limit": "limits", "weight": "weights"}))
    total, heavy = filled.agg(F.sum("source_size") * F.lit(share), F.sum("weight")).first()
    full = F.lit(total or 0.0) - F.col("limits") >= level * (F.lit(heavy or 0.0) - F.col("weights"))
    taken, rest = filled.agg(
        F.sum(F.when(full, F.col("limit"))), F.sum(F.when(~full, F.col("weight")))
    ).first()
    each = ((total or 0.0) - (taken or 0.0)) / rest if rest else 0.0
    target = F.when(full, F.col("limit")).otherwise(F.least(F.col("limit"), F.col("weight") * F.lit(each)))
    return filled.select("source", "source_size", "place", target.alias("target"))


def schedule(goals: DataFrame, block: int = BLOCK_WORDS) -> DataFrame:
    """(slot, place, block, epoch, words): which block of which source each slot takes, and how much of it.

    ``goals`` has place, source_size and target. Slots with equal numbers, behind the end of the
    sequence, are ordered by place.
    """
    size, goal = F.col("source_size"), F.round("target").cast("long")
    blocks, epochs = F.ceil(size / block), F.floor(goal / size)
    slots = F.when(size > 0, epochs * blocks + F.ceil((goal - epochs * size) / block)).otherwise(0).cast("long")
    goals = goals.select("place", "source_size", goal.alias("goal"), blocks.alias("blocks"), slots.alias("slots"))
    goals = stored(ranked(goals.where("slots > 0"), [F.col("place")], "turn", {"slots": "before"}))
    n, many = goals.agg(F.coalesce(F.sum("slots"), F.lit(0)), F.count("*")).first()

    # points meet the sources' intervals in cells of the unit interval
    cells = max(_PARTS, many)
    low, high = F.col("before") / max(1, n), (F.col("before") + F.col("slots")) / max(1, n)
    spread = goals.select("place", "slots", low.alias("low"), high.alias("high"))
    ends = [F.floor(F.col(c) * cells).cast("long") for c in ("low", "high")]
    spread = spread.withColumn("cell", F.explode(F.sequence(*ends)))
    points = goals.sparkSession.range(n).withColumn("at", (F.col("id") + 0.5) * _GOLDEN % 1).withColumn("cell", F.floor(F.col("at") * cells))
    named = points.join(spread, "cell").where("low <= at AND at < high").select("id", "place", "slots")

    # the rank of a point among its source's: counted by part of the sequence, then within the part
    named = stored(named.withColumn("part", F.floor(F.col("id") / max(1, -(-n // _PARTS)))))
    counts = named.groupBy("place", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0)))
    within = F.row_number().over(Window.partitionBy("place", "part").orderBy("id")) - 1
    drawn = named.withColumn("within", within).join(counts.drop("n"), ["place", "part"])
    drawn = drawn.select(F.col("id").alias("slot"), "place", (F.col("start") + F.col("within")).alias("nth"), "slots").where("nth < slots")
    got = counts.groupBy("place").agg(F.sum("n").alias("got"))
    left = goals.join(got, "place", "left").withColumn("got", F.least("slots", F.coalesce("got", F.lit(0)))).where("got < slots")
    left = left.withColumn("nth", F.explode(F.sequence("got", F.col("slots") - 1)))
    left = left.select((F.lit(n) + F.col("nth") - F.col("got")).alias("slot"), "place", "nth", "slots")
    every = drawn.unionByName(left).drop("slots").join(goals, "place")
    epoch, at = F.floor(F.col("nth") / F.col("blocks")), F.col("nth") % F.col("blocks")
    whole = F.least(F.lit(block).cast("long"), F.col("source_size") - at * block)
    words = F.least(whole, F.col("goal") - epoch * F.col("source_size") - at * block)
    return every.select("slot", "place", at.alias("block"), epoch.alias("epoch"), words.alias("words"))


def row_hash() -> Column:
    return F.xxhash64("doc_id", "source", "text")


def mixed_documents(
    docs: DataFrame, weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK_WORDS
) -> tuple[DataFrame, DataFrame]:
    """The documents as (row, doc_id, h, size, source, source_size, target), ``row`` being unique, and the mix as
    (slot, place, block, epoch, row, first, last): words [first, last) of a document, slot by slot."""
    rows = docs.select("doc_id", "source", row_hash().alias("h"), word_count(F.col("text")).alias("size"))
    order = [F.col("source").isNull(), F.col("source"), F.col("h"), F.col("doc_id")]
    rows = stored(ranked(rows, order, "row", {"size": "before"}))
    sources = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.min("before").alias("start"))
    goals = stored(targets(sources.drop("start"), weights, share, most))
    same = F.col("g.source").eqNullSafe(F.col("s.source"))
    known = goals.alias("g").join(sources.alias("s"), same).select("g.*", "start")
    placed = rows.alias("r").join(known.alias("k"), F.col("r.source").eqNullSafe(F.col("k.source")))
    placed = stored(
        placed.select("row", "doc_id", "h", "size", "r.source", "source_size", "target", "place", (F.col("before") - F.col("start")).alias("at"))
    )
    ends = F.col("at") + F.col("size")
    pieces = placed.where("size > 0").select("row", "place", "at", ends.alias("to"))
    pieces = pieces.withColumn("block", F.explode(F.sequence(F.floor(F.col("at") / block), F.floor((F.col("to") - 1) / block))))
    slots = schedule(goals, block)
    start = F.col("block") * block
    first = F.greatest(F.col("at"), start)
    last = F.least(F.col("to"), start + F.col("words"))
    mix = slots.join(pieces, ["place", "block"]).where(first < last)
    mix = mix.select("slot", "place", "block", "epoch", "row", (first - F.col("at")).alias("first"), (last - F.col("at")).alias("last"))
    return placed, mix


def taken(docs: DataFrame, weights: list[float] = WEIGHTS, share: float = SHARE, most: float = MOST, block: int = BLOCK_WORDS) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) per row; taken counts a document's words in the mix."""
    placed, mix = mixed_documents(docs, weights, share, most, block)
    words = mix.groupBy("row").agg(F.sum(F.col("last") - F.col("first")).alias("taken"))
    return placed.join(words, "row", "left").select(
        "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken")
    )
