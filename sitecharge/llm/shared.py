"""What several operators need: stored tables, global ranks, components, and texts as byte buffers."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Bytes of text that a task turns into 8-byte arrays at a time.
CHUNK_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset, a folder of the warehouse, which is shared too."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_staging").rstrip("/")


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a new table in the shared folder, which ends its lineage, and read again.

    The folder belongs to the session's owner, who deletes it after the result has been used.
    """
    path = f"{shared_folder(df.sparkSession)}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Sends this package's code to the executors, once per application, as ``--py-files`` would."""
    if (app := spark.sparkContext.applicationId) in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="code-")) / "sitecharge_llm.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for path in [root / "__init__.py", *sorted((root / "llm").glob("*.py"))]:
            out.write(path, path.relative_to(root.parent))
    spark.sparkContext.addPyFile(str(archive))
    _shipped.add(app)


def in_tasks(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """``df.mapInArrow`` with this package importable on the executors."""
    _ship(df.sparkSession)
    return df.mapInArrow(function, schema)


def ranked(df: DataFrame, order: list[Column], name: str = "rank", sums: dict[str, str] | None = None) -> DataFrame:
    """``df`` (narrow, as it is written once) with its row number from 0 in the given total order.

    ``sums`` maps a column to the name of its running sum over the rows before. Rows are dealt by
    range; a row's number is its place in its partition plus the sizes of the partitions before it,
    of which there are only as many as shuffle partitions.
    """
    sums = sums or {}
    row = F.monotonically_increasing_id()
    placed = stored(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_row", row))
    placed = placed.withColumn("_part", F.shiftright("_row", 33))
    totals = {"_n": F.count("*")} | {f"_n{i}": F.sum(c) for i, c in enumerate(sums)}
    sizes = placed.groupBy("_part").agg(*(total.alias(n) for n, total in totals.items()))
    parts_before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_part", *(F.coalesce(F.sum(n).over(parts_before), F.lit(0)).alias(n) for n in totals))
    local = F.col("_row").bitwiseAND(F.lit((1 << 33) - 1))
    earlier = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    for i, (column, out) in enumerate(sums.items()):
        placed = placed.withColumn(f"_s{i}", F.coalesce(F.sum(column).over(earlier), F.lit(0)))
    placed = placed.join(F.broadcast(starts), "_part").withColumn(name, local + F.col("_n"))
    for i, out in enumerate(sums.values()):
        placed = placed.withColumn(out, F.col(f"_s{i}") + F.col(f"_n{i}"))
    return placed.drop("_row", "_part", *totals, *(f"_s{i}" for i in range(len(sums))))


def _edges(df: DataFrame) -> DataFrame:
    """Distinct (a, b) with a > b."""
    return df.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a > b").distinct()


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, component) for the nodes of the undirected links (a, b); component is the least node.

    Alternates two steps until nothing changes: every node hands its larger neighbours its least
    neighbour, then its smaller ones. Links turn into stars in a number of rounds that grows with the
    logarithm of the size. Each round is stored, and only counts reach the driver.
    """
    edges = stored(_edges(links))
    state = _state(edges)
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = stored(_edges(large))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(
            F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")
        )
        edges = stored(_edges(small.select("e.a", "e.b")))
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts one after another, and where each starts (and the last ends)."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``size`` bytes; a longer text stands alone."""
    first, n = 0, len(offsets) - 1
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def whole_blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Tables of about ``size`` bytes from rows that are sorted by ``block``, each with whole blocks."""
    held: list[pa.RecordBatch] = []
    nbytes = 0
    for batch in batches:
        for first in range(0, batch.num_rows, 1000):
            held.append(batch.slice(first, 1000))
            nbytes += held[-1].nbytes
            if nbytes > size:
                rows = pa.Table.from_batches(held)
                block = rows.column("block").to_numpy()
                last = int(np.searchsorted(block, block[-1]))
                if last:
                    yield rows.slice(0, last)
                    held = rows.slice(last).to_batches()
                    nbytes = sum(b.nbytes for b in held)
    if held:
        yield pa.Table.from_batches(held)


def cuts_of(block: np.ndarray) -> np.ndarray:
    """Where runs of equal values begin, and the end."""
    if not len(block):
        return np.zeros(1, np.int64)
    return np.concatenate([[0], np.flatnonzero(block[1:] != block[:-1]) + 1, [len(block)]])


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit values spread over all bits (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Rolling:
    """Polynomial hashes modulo 2^64 of any ranges of one byte buffer, from one running sum."""

    BASE = 0x9E3779B97F4A7C15 | 1
    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)
    _letters = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))

    def __init__(self, data: np.ndarray, letters: np.ndarray | None = None):
        n = len(data) + 1
        if len(Rolling._powers) < n:
            size = 1 << (n - 1).bit_length()
            Rolling._powers = self._grown(size, self.BASE)
            Rolling._inverses = self._grown(size, pow(self.BASE, -1, 1 << 64))
        values = (Rolling._letters if letters is None else letters)[data]
        self.sums = np.zeros(n, np.uint64)
        np.cumsum(values * Rolling._powers[: n - 1], out=self.sums[1:])

    @staticmethod
    def _grown(size: int, base: int) -> np.ndarray:
        out = np.full(size, base, np.uint64)
        out[0] = 1
        return np.cumprod(out, dtype=np.uint64)

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mixed((self.sums[ends] - self.sums[starts]) * Rolling._inverses[starts])
