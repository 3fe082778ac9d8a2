"""Shards by best-fit-decreasing bin packing of indivisible groups.

Documents with equal texts form a group.  Groups are taken from the largest to
the smallest, and each enters the shard with the least remaining capacity that
still holds it, found in a balanced tree ordered by remaining capacity; a shard
is opened only where none fits, so the number of fixed-capacity shards is small.

Groups of equal size are interchangeable, so the packing needs only how many
groups there are of each size: a run of equal groups fills the tightest shard,
then the next one.  All groups together hold the sum of their sizes, so B bytes
have at most sqrt(2 B) distinct sizes; that table is what the driver packs (a
million sizes for terabytes).  Spark numbers the groups of each size and joins
them to the runs.
"""

from __future__ import annotations

import random

from pyspark.sql import DataFrame, Window, functions as F, types as T

from .common import stored

SALTS = 64              # parts in which the groups of one size are numbered
CHUNK_ROWS = 2_000      # rows of a shard that are numbered together
RUN_BLOCK = 4096         # ranks that a long run is joined by


class CapacityTree:
    """A treap of (remaining capacity, shard) with random priorities."""

    def __init__(self, seed: int = 0):
        self.root, self.random = None, random.Random(seed)

    def add(self, remaining: int, shard: int) -> None:
        left, right = self._split(self.root, (remaining, shard))
        node = [(remaining, shard), self.random.random(), None, None]
        self.root = self._merge(self._merge(left, node), right)

    def take_tightest(self, size: int) -> tuple[int, int] | None:
        """Remove and return the entry with the least remaining capacity >= size."""
        left, right = self._split(self.root, (size, -1))
        if right is None:
            self.root = left
            return None
        least = right
        while least[2] is not None:
            least = least[2]
        _, rest = self._split(right, (least[0][0], least[0][1] + 1))
        self.root = self._merge(left, rest)
        return least[0]

    def _split(self, node, key):
        if node is None:
            return None, None
        if node[0] < key:
            node[3], right = self._split(node[3], key)
            return node, right
        left, node[2] = self._split(node[2], key)
        return left, node

    def _merge(self, a, b):
        if a is None or b is None:
            return a or b
        if a[1] < b[1]:
            a[3] = self._merge(a[3], b)
            return a
        b[2] = self._merge(a, b[2])
        return b


def best_fit_decreasing(sizes: list[tuple[int, int]], capacity: int, limit: int | None = None,
                        first_shard: int = 0) -> tuple[list[tuple[int, int, int, int]], int] | None:
    """Pack (size, count) pairs into shards of ``capacity``.

    Returns ((size, first rank, count, shard) runs, number of shards), or None if
    more than ``limit`` shards are needed.  A size above the capacity is refused.
    """
    tree, shards, runs = CapacityTree(), 0, []
    for size, count in sorted(sizes, reverse=True):
        if size > capacity:
            raise ValueError(f"a group of {size} does not fit a shard of {capacity}")
        rank = 0
        while rank < count:
            found = tree.take_tightest(size)
            if found is None:
                if shards == limit:
                    return None
                found, shards = (capacity, first_shard + shards), shards + 1
            remaining, shard = found
            n = min(count - rank, remaining // size)
            runs.append((size, rank, n, shard))
            tree.add(remaining - n * size, shard)
            rank += n
    return runs, shards


def balanced_runs(sizes: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Runs over exactly ``shards`` shards of nearly equal size.

    A group at least as large as the mean of what is left has a shard of its own.
    The others are packed with the mean as capacity, and with 1, 2, 4, ... more
    until they need no more shards than there are."""
    left = sorted(sizes, reverse=True)
    total, runs, own = sum(s * n for s, n in left), [], 0
    while left and own < shards - 1 and left[0][0] * (shards - own) >= total:
        size, n = left[0]
        runs.append((size, sizes_taken(runs, size), 1, own))
        own, total = own + 1, total - size
        left = ([(size, n - 1)] if n > 1 else []) + left[1:]
    taken = {s: sizes_taken(runs, s) for s in {r[0] for r in runs}}
    mean, more = -(-total // (shards - own)), 0
    while left:
        if left[0][0] <= mean + more:
            packed = best_fit_decreasing(left, mean + more, shards - own, own)
            if packed is not None:
                return runs + [(s, r + taken.get(s, 0), n, b) for s, r, n, b in packed[0]]
        more = max(1, more * 2)
    return runs


def sizes_taken(runs: list[tuple[int, int, int, int]], size: int) -> int:
    return sum(n for s, _, n, _ in runs if s == size)


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, h1, h2): a group is known by its size and two
    64-bit hashes of the text.  A null text counts as empty."""
    t = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("doc_id"), (F.octet_length(t) + 1).cast("long").alias("size"),
                       F.crc32(t).alias("text_crc32"), F.xxhash64(t).alias("h1"),
                       F.xxhash64(F.lit(1), t).alias("h2"))


def ranked(groups: DataFrame) -> DataFrame:
    """Groups with ``rank``, their number among the groups of one total; numbered
    in SALTS parts, so that a frequent size is not one task's work."""
    salted = groups.withColumn("salt", F.pmod("h1", F.lit(SALTS)))
    counts = salted.groupBy("total", "salt").agg(F.count("*").alias("n"))
    before = Window.partitionBy("total").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("total", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = Window.partitionBy("total", "salt").orderBy("h1", "h2", "size")
    return (salted.withColumn("place", F.row_number().over(place)).join(bases, ["total", "salt"])
            .withColumn("rank", F.col("base") + F.col("place") - 1).drop("salt", "place", "base"))


def in_runs(groups: DataFrame, runs: DataFrame, block: int = RUN_BLOCK) -> DataFrame:
    """Each group with the shard of the run (total, first, count, shard) that its
    rank falls in.  Runs cover the ranks of a total once, so a group meets one row:
    the whole block of ranks that a long run takes, or the rank itself at the
    run's ends and in short runs."""
    end = F.col("first") + F.col("count")
    low, high = F.ceil(F.col("first") / block), F.floor(end / block)     # whole blocks are low ... high - 1
    upto = lambda a, b: F.when(a < b, F.sequence(a, b - 1)).otherwise(F.array().cast("array<bigint>"))
    whole = runs.select("total", F.explode(upto(low, high)).alias("block"), "shard")
    ends = F.when(low < high, F.concat(upto(F.col("first"), low * block), upto(high * block, end))).otherwise(upto(F.col("first"), end))
    single = runs.select("total", F.explode(ends).alias("rank"), "shard")
    in_blocks = groups.withColumn("block", F.floor(F.col("rank") / block)).join(whole, ["total", "block"]).drop("block")
    return in_blocks.unionByName(groups.join(single, ["total", "rank"]).select(in_blocks.columns))


def pack(docs: DataFrame, shards: int | None = None, capacity: int | None = None,
         key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row.

    With ``shards``, that many shards of nearly equal size; with ``capacity``, as
    many shards of that size as best fit needs.  Null and empty texts are one
    group; repeated rows belong to their text's group; ``slot`` numbers a shard's
    rows from 0.  An empty table has no rows.
    """
    spark = docs.sparkSession
    base = stored(measured(docs, key, text), "shard-sizes")
    groups = stored(base.groupBy("h1", "h2", "size").agg(F.count("*").alias("n"))
                    .withColumn("total", F.col("size") * F.col("n")), "shard-groups")
    sizes = [(r.total, r.n) for r in groups.groupBy("total").agg(F.count("*").alias("n")).collect()]
    runs = balanced_runs(sizes, shards) if shards else best_fit_decreasing(sizes, capacity)[0]
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("total", "first", "count", "shard")])
    table = spark.createDataFrame(runs, schema)
    placed = in_runs(ranked(groups), table).select("h1", "h2", "size", "shard")
    rows = stored(base.join(placed, ["h1", "h2", "size"]), "shard-rows")
    return numbered(rows)


def numbered(rows: DataFrame) -> DataFrame:
    """Rows with ``slot``: gapless from 0 in each shard, in parts by a hash of doc_id."""
    chunks = max(1, -(-rows.count() // (8 * CHUNK_ROWS)))
    cut = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id"), F.lit(chunks)))
    counts = cut.groupBy("shard", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("shard", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    place = Window.partitionBy("shard", "chunk").orderBy("doc_id", "h1", "h2")
    return (cut.withColumn("place", F.row_number().over(place)).join(bases, ["shard", "chunk"])
            .select("doc_id", "size", "text_crc32", F.col("shard").cast("int").alias("shard"),
                    (F.col("base") + F.col("place") - 1).cast("long").alias("slot")))
