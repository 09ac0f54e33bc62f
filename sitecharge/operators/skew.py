"""Joins that stay balanced when one key owns a large part of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 32


def broadcastable(df: DataFrame) -> bool:
    """Whether Spark puts the size of ``df`` below the session's broadcast threshold."""
    spark = df.sparkSession
    limit = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    return int(str(size)) <= limit


def small_side(df: DataFrame, *made_of: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast if every table it is made of is below the threshold.

    For lookups joined from a few dimension tables by their unique keys: such a lookup has at most
    the rows of the first table, but Spark estimates a join as the product of its sides and would
    move the fact instead. Beyond the threshold nothing is marked and Spark shuffles.
    """
    return F.broadcast(df) if all(broadcastable(part) for part in made_of) else df


def attach_by_key(
    rows: DataFrame, facts: DataFrame, on: list[str], spread: str, salts: int = SALTS
) -> DataFrame:
    """Inner join of ``rows`` with the one-row-per-key ``facts``.

    Facts below the broadcast threshold are joined plainly. Otherwise the rows of a key are dealt
    over ``salts`` parts by a hash of column ``spread`` and the facts are repeated once per part:
    a hot key then meets its facts in many tasks, and since the join key is finer than any later
    grouping by ``on``, adaptive execution may split a part further.
    """
    if broadcastable(facts):
        return rows.join(facts, on)
    salt = F.pmod(F.xxhash64(F.col(spread)), F.lit(salts)).cast("int")
    repeated = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(repeated, [*on, "_salt"]).drop("_salt")


def heavy_keys(rows: DataFrame, key: str, share: float = 1 / 64, tracked: int = 4096) -> list:
    """Values of ``key`` that may hold more than ``share`` of the rows, most of them for certain.

    Found by a sketch of frequent items of ``tracked`` entries, which tasks merge: nothing is shuffled but
    sketches. A sketch overrates a key by rows / ``tracked`` at most, so no key above ``share`` is missed, and at
    most 1 / ``share`` + 1 values are returned.
    """
    most = int(1 / share) + 1
    sketch = f"approx_top_k({key}, {most}, {tracked})"
    (row,) = rows.where(F.col(key).isNotNull()).agg(F.expr(sketch).alias("top"), F.count("*").alias("n")).collect()
    return [item["item"] for item in row["top"] or [] if item["count"] >= share * row["n"]]


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: list[str],
    spread: str,
    salts: int = SALTS,
    heavy: list = (),
) -> DataFrame:
    """Left join in which neither rows without a key (the first of ``on``) nor those of ``heavy`` keys meet in one task.

    Both are dealt over ``salts`` parts by a hash of column ``spread``. Rows without a key match nothing; the few rows
    of ``lookup`` that a heavy key has are repeated once per part. All others are joined as they are, in the same join.
    """
    key = F.col(on[0])
    hot = key.isin(list(heavy)) if len(heavy) else F.lit(False)
    dealt = F.pmod(F.xxhash64(spread), F.lit(salts)) + 1
    salt = F.when(key.isNull() | hot, dealt).otherwise(0).cast("long")
    there = F.when(key.isNull(), 1).otherwise(0).cast("long")  # the same for every row, but no literal
    if len(heavy):
        every = F.sequence(F.lit(1).cast("long"), F.lit(salts).cast("long"))
        there = F.explode(F.when(hot, every).otherwise(F.array(there)))
    return (
        rows.withColumn("_salt", salt)
        .join(lookup.withColumn("_salt", there), [*on, "_salt"], "left")
        .drop("_salt")
    )


def co_located_join(rows: DataFrame, lookup: DataFrame, on: list[str]) -> DataFrame:
    """Left join of tables that lie in equal buckets of the first of ``on``: neither side moves.

    The other columns of ``on`` (booleans) are compared row by row, since a join on more columns than those of the
    buckets would move both sides.
    """
    key, *flags = on
    theirs = {name: f"_right_{name}" for name in on}
    right = lookup.withColumnsRenamed(theirs).hint("merge")
    same = F.col(key) == F.col(theirs[key])
    for flag in flags:  # not an equality of two columns, so that it is no key of the join
        same &= (F.col(flag).cast("int") + F.col(theirs[flag]).cast("int")) % 2 == 0
    return rows.join(right, same, "left").drop(*theirs.values())


def left_join(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Left join whose fan-out may be split on either side.

    Adaptive execution splits an oversized partition of an outer join on the preserved side only.
    Written as inner join plus the rows without a match, a key with very many rows on the right is
    split too. ``left`` is read twice then: pass a stored table or a cheap plan. A ``right`` below the broadcast
    threshold is joined as it is.
    """
    if broadcastable(right):
        return left.join(right, on, "left")
    matched = left.join(right, on)
    unmatched = left.join(right.select(on).distinct(), on, "left_anti")
    return matched.unionByName(unmatched, allowMissingColumns=True)
