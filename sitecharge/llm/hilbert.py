"""Shards along a Hilbert curve over several metadata dimensions.

Each dimension (a column, or an expression of columns) is quantised to ``2 ** bits`` levels of about
equal mass, from the counts of all its values; null is level 0. The levels of a row give a cell, and
cells are numbered along the Hilbert curve, so rows that are near in all dimensions come close together and a
shard spans few levels of each dimension, which files written by shard can be pruned by. Rows are
sorted by curve index, ties by a hash of the row, and cut into runs of row counts that differ by one
at most (the law ``rows``).

Null texts have size 8 and the checksum of no bytes. Equal rows are interchangeable; a null doc_id is a
value like others. An empty table gives an empty result. Extra columns are ignored, except by
``write_shards``, which keeps them.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitecharge.llm.shared import in_tasks, ranked, stored

SHARDS = 24
BITS = 6
LAW = "rows"


def curve_index(levels: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of levels (rows x dimensions), each below ``2 ** bits``.

    Level by level from the top, a cell's part is read in the frame of the part entered before:
    where an axis' bit is set, the first axis is turned over, else it is swapped with that axis below this bit.
    The bits, as a Gray code, then count the parts in order.
    """
    axes = [column.astype(np.int64).copy() for column in levels.T]
    n = len(axes)
    for bit in reversed(range(1, bits)):
        below = (1 << bit) - 1
        for i in range(n):
            turn = (axes[i] >> bit) & 1 == 1
            swap = np.where(turn, 0, (axes[0] ^ axes[i]) & below)
            axes[0] ^= np.where(turn, below, swap)
            axes[i] ^= swap
    # Gray code to count, through the axes and down the bits
    for i in range(1, n):
        axes[i] ^= axes[i - 1]
    carry = np.zeros(len(levels), np.int64)
    for bit in reversed(range(1, bits)):
        carry ^= np.where((axes[-1] >> bit) & 1 == 1, (1 << bit) - 1, 0)
    out = np.zeros(len(levels), np.int64)
    for bit in reversed(range(bits)):
        for axis in axes:
            out = out << 1 | ((axis ^ carry) >> bit) & 1
    return out


def _indexed(batches: Iterator[pa.RecordBatch], dimensions: int, bits: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        levels = np.stack([batch.column(i).to_numpy() for i in range(dimensions)], axis=1)
        cells = pa.array(curve_index(levels, bits), pa.int64())
        names = [*batch.schema.names[dimensions:], "curve"]
        yield pa.RecordBatch.from_arrays([*batch.columns[dimensions:], cells], names=names)


def bounds(values: DataFrame, bits: int = BITS) -> list:
    """The least value of each level but 0 that has any, of a frame with one column, from all its rows.

    There are fewer than ``2 ** bits`` of them whatever the size.
    """
    (name,) = values.columns
    counts = values.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("_many"))
    spread = stored(ranked(counts, [F.col(name)], "_at", {"_many": "_before"}))
    total = spread.agg(F.sum("_many")).first()[0]
    if not total:
        return []
    most = (1 << bits) - 1
    level = F.floor((F.col("_before") + F.col("_many") / 2) * most / total)
    return [row[0] for row in spread.groupBy(level.alias("_level")).agg(F.min(name).alias("low")).orderBy("_level").select("low").collect()]


def dimensions_of() -> dict[str, Column]:
    """The dimensions of a table of documents: source, language, and size."""
    return {"source": F.col("source"), "lang": F.col("lang"), "size": text_size()}


def text_size() -> Column:
    return (F.octet_length(F.coalesce("text", F.lit(""))) + 8).cast("long")


def levels(docs: DataFrame, dimensions: dict[str, Column], bits: int = BITS) -> dict[str, Column]:
    """A column with the level of each dimension."""

    def level(column: Column) -> Column:
        low = bounds(docs.select(column.alias("value")), bits)
        count = F.size(F.filter(F.array(*map(F.lit, low)), lambda v: v <= column)) if low else F.lit(0)
        return F.coalesce(count, F.lit(0)).cast("int")

    return {name: level(column) for name, column in dimensions.items()}


def _tie() -> Column:
    return F.xxhash64("doc_id", "text")


def sharded(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, dimensions: dict[str, Column] | None = None) -> DataFrame:
    """(doc_id, size, text_crc32, curve, tie, shard, slot) per row; slots count from 0 in each shard."""
    by = levels(docs, dimensions or dimensions_of(), bits)
    crc = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    narrow = docs.select(*by.values(), "doc_id", text_size().alias("size"), crc.alias("text_crc32"), _tie().alias("tie"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, size long, text_crc32 long, tie long, curve long"
    named = [f"level_{i}" for i in range(len(by))] + ["doc_id", "size", "text_crc32", "tie"]
    indexed = in_tasks(narrow.toDF(*named), partial(_indexed, dimensions=len(by), bits=bits), schema)
    rows = stored(ranked(indexed, [F.col("curve"), F.col("tie"), F.col("doc_id")], "place"))
    n = max(1, rows.count())
    # in whole numbers: the first place of a shard is the least with place * shards >= shard * n
    shard = F.expr(f"(place * {shards}) div {n}")
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    out = rows.withColumn("shard", shard).withColumn("slot", F.col("place") - first)
    return out.select("doc_id", "size", "text_crc32", "curve", "tie", F.col("shard").cast("int").alias("shard"), "slot")


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS) -> None:
    """Writes ``docs`` with all columns as Parquet below ``path``, a folder per shard, sorted along the curve.

    A shard's cut is the (curve, tie) of its first row; rows are sent to shards by comparing with the cuts.
    """
    dimensions = dimensions_of()
    by = levels(docs, dimensions, bits)
    cuts = sharded(docs, shards, bits).where("slot = 0").orderBy("shard").select("curve", "tie").collect()
    kept = [F.col(f"`{c}`") for c in docs.columns]
    names = [f"level_{i}" for i in range(len(by))] + [f"c{i}" for i in range(len(kept))] + ["tie"]
    wide = docs.select(*by.values(), *kept, _tie()).toDF(*names)
    fields = [f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema)]
    schema = ", ".join([*fields, "tie long", "curve long"])
    placed = in_tasks(wide, partial(_indexed, dimensions=len(by), bits=bits), schema)
    listed = F.array(*(F.struct(F.lit(c).alias("curve"), F.lit(t).alias("tie")) for c, t in cuts))
    after = F.size(F.filter(listed, lambda cut: cut <= F.struct("curve", "tie"))) - 1
    placed = placed.withColumn("shard", after).repartitionByRange("shard", "curve", "tie").sortWithinPartitions("shard", "curve", "tie")
    placed.select("shard", *(F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns))).write.partitionBy("shard").parquet(path)
