"""Hard negatives by Fagin's threshold algorithm.

Candidates are dealt into blocks.  A block holds its integer vectors and, for
each dimension, the order of its rows by that component.  An anchor reads every
dimension's list from the end that its own sign favours (sorted access); rows
met for the first time are scored by their whole integer inner product (random
access).  No row that is still unmet can score more than the threshold, the sum
over the dimensions of the anchor's component times the value reached there.
An anchor stops in a block once the threshold is strictly below the kth score
of each of its windows, or below the least score that a window admits.

The best k of all rows are among the best k of the blocks, so each (block of
anchors, block of candidates) is a job of its own with bounded memory, and
their lists are merged by (score, id).  Two searches run: the first rows of the
anchor's label give the positives, their scores give the windows of the second.
The anchors of a block read their lists in step, and a row that one of them
meets is scored for all of them, as one matrix product.  Products of floats are
used where every partial sum stays below 2**53 and so is exact; else integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import parallelism
from .common import stored

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95          # a negative has this many hundredths of the positive's score
ANCHOR_EVERY = 50
SCALE = 256
LARGEST = 1 << 28           # scaled components; beyond them scores would leave 64 bits
BLOCK = 4096                # candidates per block
ANCHORS = 128               # anchors per block
FIRST_DEPTH = 8             # rows of each list read in the first round; doubled every round

NONE = np.iinfo(np.int64).min


def usable(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label") -> DataFrame:
    """(id, label, v array<int>): the rows that take part, labels and components as the search sees them."""
    x = F.col(vector)
    scaled = F.transform(x, lambda c: F.floor(SCALE * c.cast("double")))
    fine = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c.cast("double")) <= LARGEST / SCALE))
    moved = F.when(F.col(key) % 7 == 0, (F.col(label) + 1) % 10).otherwise(F.col(label))
    return (rows.filter(F.col(key).isNotNull() & F.col(label).isNotNull() & x.isNotNull()).filter(fine)
            .select(F.col(key).cast("long").alias("id"), moved.cast("long").alias("label"),
                    F.transform(scaled, lambda c: c.cast("int")).alias("v")))


def _matrix(lists: pa.Array, width: int) -> np.ndarray:
    """Rows of the list column, shorter ones filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    n = np.asarray(pa.compute.list_value_length(lists), dtype=np.int64)
    out = np.zeros((len(n), width), np.int32)
    out[np.repeat(np.arange(len(n)), n), np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)] = \
        lists.flatten().to_numpy(zero_copy_only=False)
    return out


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).to_numpy().astype(np.int64)


def candidate_blocks(rows: DataFrame, count: int, width: int, block: int) -> DataFrame:
    """(block, candidates binary): rows in the order of (id, row) with their sorted lists."""
    blocks = -(-count // block)

    def build(key, table):
        table = table.sort_by([("id", "ascending"), ("row", "ascending")])
        v = _matrix(table.column("v"), width)
        order = np.argsort(v, axis=0, kind="stable").astype("<i4")
        data = b"".join([_column(table, c).astype("<i8").tobytes() for c in ("id", "row", "label")]
                        + [v.astype("<i4").tobytes(), order.T.tobytes()])
        return pa.table({"block": pa.array([key[0].as_py()], pa.int64()), "candidates": pa.array([data], pa.binary())})

    dealt = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(max(blocks, 1))))
    return dealt.groupBy("block").applyInArrow(build, "block bigint, candidates binary")


class Block:
    """A block of candidates read back."""

    def __init__(self, data: bytes, width: int):
        n = len(data) // (24 + 8 * width)
        self.ids, self.rows, self.labels = (np.frombuffer(data, "<i8", n, 8 * n * i) for i in range(3))
        self.v = np.frombuffer(data, "<i4", n * width, 24 * n).reshape(n, width)
        self.order = np.frombuffer(data, "<i4", n * width, 24 * n + 4 * n * width).reshape(width, n)
        self.sorted = np.take_along_axis(self.v.T, self.order, axis=1)
        self.top = int(np.abs(self.v).max(initial=0))


class Search:
    """The threshold algorithm for a block of anchors over blocks of candidates."""

    def __init__(self, anchors: np.ndarray):
        self.a = anchors
        self.top = int(np.abs(anchors).max(initial=0))

    def scores(self, block: Block):
        """Yield (rows of the block, their scores per anchor, threshold per anchor):
        after each round of sorted access, what is newly met and what the rest can reach."""
        n, width = block.v.shape
        exact = self.top * block.top * width < 1 << 53
        kind = np.float64 if exact else np.int64
        a = self.a.astype(kind)
        up, down = np.maximum(a, 0), np.minimum(a, 0)
        met = np.zeros(n, bool)
        rising, falling = (a < 0).any(axis=0), (a > 0).any(axis=0)
        depth, to = 0, min(FIRST_DEPTH, n)
        while depth < n:
            new = np.zeros(n, bool)
            new[block.order[falling, n - to:n - depth].ravel()] = True
            new[block.order[rising, depth:to].ravel()] = True
            new &= ~met
            met |= new
            at = np.flatnonzero(new)
            last_high, last_low = block.sorted[:, n - to].astype(kind), block.sorted[:, to - 1].astype(kind)
            threshold = (up @ last_high + down @ last_low).astype(np.int64)
            if met.all() or to == n:
                threshold[:] = NONE          # nothing is left
                if not met.all():            # anchors of zeros only read no list
                    at = np.concatenate([at, np.flatnonzero(~met)])
                    met[:] = True
            yield at, (a @ block.v[at].T.astype(kind)).astype(np.int64), threshold
            if met.all():
                return
            depth, to = to, min(2 * to, n)


def _best(group: np.ndarray, score: np.ndarray, at: np.ndarray, k: int) -> np.ndarray:
    """Places of the first k entries of each group by (score falling, at rising)."""
    order = np.lexsort((at, -score, group))
    g = group[order]
    first = np.flatnonzero(np.append(True, g[1:] != g[:-1])) if len(g) else np.zeros(0, np.int64)
    nth = np.arange(len(g)) - np.repeat(first, np.diff(np.append(first, len(g))))
    return order[nth < k]


def _kth(group: np.ndarray, score: np.ndarray, groups: int, k: int, least: np.ndarray) -> np.ndarray:
    """The kth score of each group, from its best entries; ``least`` where there are fewer."""
    full = np.bincount(group, minlength=groups) >= k
    low = np.full(groups, np.iinfo(np.int64).max)
    np.minimum.at(low, group, score)
    return np.where(full, np.maximum(low, least), least)


def best_in_windows(block: Block, anchors: np.ndarray, owner: np.ndarray, low: np.ndarray, high: np.ndarray,
                    admit, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, place in the block, score) of each window's first k rows.

    Window w belongs to the anchor ``owner[w]`` and admits scores from low[w] to
    high[w]; ``admit(at)`` gives the rows each anchor may take as a matrix."""
    windows = len(owner)
    win = place = score = np.zeros(0, np.int64)
    widest_low = np.full(len(anchors), np.iinfo(np.int64).max)
    np.minimum.at(widest_low, owner, low)
    widest_high = np.full(len(anchors), NONE)
    np.maximum.at(widest_high, owner, high)
    by_owner = np.argsort(owner, kind="stable")
    first = np.searchsorted(owner[by_owner], np.arange(len(anchors) + 1))
    for at, s, threshold in Search(anchors).scores(block):
        fits = admit(at) & (s >= widest_low[:, None]) & (s <= widest_high[:, None])
        i, j = np.nonzero(fits)
        n = (first[i + 1] - first[i])                       # one entry for each window of the anchor
        e = np.repeat(np.arange(len(i)), n)
        w = by_owner[np.repeat(first[i] - (np.cumsum(n) - n), n) + np.arange(len(e))]
        value = s[i, j][e]
        inside = (value >= low[w]) & (value <= high[w])
        win = np.concatenate([win, w[inside]])
        place = np.concatenate([place, at[j][e][inside]])
        score = np.concatenate([score, value[inside]])
        keep = _best(win, score, place, k)
        win, place, score = win[keep], place[keep], score[keep]
        if (threshold[owner] < _kth(win, score, windows, k, low)).all():
            break
    return win, place, score


def _pairs(anchors: DataFrame, blocks: DataFrame, n_blocks: int, tasks: int) -> DataFrame:
    """Each block of anchors with each block of candidates, by an equi-join on the block."""
    spread = (anchors.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))))
              .repartition(tasks, "block"))
    return spread.join(blocks.repartition(tasks, "block"), "block")


def _anchor_blocks(anchors: DataFrame, count: int, size: int, *columns: str) -> DataFrame:
    """(group, lists of the columns): up to about ``size`` anchors in a row."""
    group = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(max(-(-count // size), 1)))
    return (anchors.withColumn("group", group).groupBy("group")
            .agg(F.collect_list(F.struct("row", *columns)).alias("anchors")))


def _run(pairs: DataFrame, width: int, find, schema: str) -> DataFrame:
    """Apply ``find(block, anchors as an Arrow struct array, their vectors)`` to each pair."""
    def run(batches):
        held, block = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column(0)[i].as_py()
                if number != held:
                    held, block = number, Block(batch.column(2)[i].as_buffer().to_pybytes(), width)
                own = batch.column(1)[i].values
                yield find(block, own, _matrix(own.field("v"), width))
    return pairs.select("block", "anchors", "candidates").mapInArrow(run, schema)


def _ints(a: pa.Array) -> np.ndarray:
    return a.to_numpy(zero_copy_only=False).astype(np.int64)


def _find_positives(k: int):
    def find(block: Block, own: pa.StructArray, vectors: np.ndarray) -> pa.RecordBatch:
        row, label = _ints(own.field("row")), _ints(own.field("label"))
        n = len(row)
        admit = lambda at: (block.labels[at] == label[:, None]) & (block.rows[at] != row[:, None])
        every = np.arange(n)
        w, at, s = best_in_windows(block, vectors, every, np.full(n, NONE + 1), np.full(n, np.iinfo(np.int64).max), admit, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (row[w], block.ids[at], block.rows[at], s)], ["row", "id", "other", "score"])
    return find


def _find_negatives(k: int, low: int, high: int):
    def find(block: Block, own: pa.StructArray, vectors: np.ndarray) -> pa.RecordBatch:
        row, label = _ints(own.field("row")), _ints(own.field("label"))
        scores = own.field("scores")
        n = np.asarray(pa.compute.list_value_length(scores), dtype=np.int64)
        owner = np.repeat(np.arange(len(n)), n)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
        p = _ints(scores.flatten())
        least, most = -(-low * p // 100), high * p // 100       # of the scores s with low p <= 100 s <= high p
        admit = lambda at: block.labels[at] != label[:, None]
        w, at, s = best_in_windows(block, vectors, owner, least, most, admit, k)
        return pa.RecordBatch.from_arrays(
            [pa.array(x) for x in (row[owner[w]], nth[w], block.ids[at], block.rows[at], s)],
            ["row", "nth", "id", "other", "score"])
    return find


def _first(rows: DataFrame, k: int, *by: str) -> DataFrame:
    """The first k of each group by (score falling, id, row), with their rank."""
    order: list[Column] = [F.col("score").desc(), F.col("id"), F.col("other")]
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


def mine(rows: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
         every: int = ANCHOR_EVERY, positives: int = POSITIVES, negatives: int = NEGATIVES,
         low: int = LOW, high: int = HIGH, block: int = BLOCK, anchors: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Anchors are the rows whose key is divisible by ``every``.  Rows with a null
    key, label or vector, a null or non-finite component or one beyond 2**20 in
    size take no part.  Rows that repeat a key are rows of their own, each an
    anchor or a candidate; an anchor is never its own positive.  Shorter vectors
    count as filled up with zeros, an empty vector scores 0 with every row.
    Ties of score go to the smaller key.  Nothing to return gives no rows.
    """
    spark = rows.sparkSession
    used = stored(usable(rows, key, vector, label).withColumn("row", F.monotonically_increasing_id()), "negatives-rows")
    is_anchor = F.col("id") % every == 0
    facts = used.agg(F.count("*").alias("rows"), F.max(F.size("v")).alias("width"), F.count_if(is_anchor).alias("anchors")).first()
    width = max(facts.width or 1, 1)
    n_blocks = max(-(-facts.rows // block), 1)
    tasks = min(max(n_blocks, parallelism(spark)), 4 * n_blocks)
    blocks = stored(candidate_blocks(used, facts.rows, width, block), "negatives-blocks")
    own = used.filter(is_anchor)

    first = _run(_pairs(_anchor_blocks(own, facts.anchors, anchors, "label", "v"), blocks, n_blocks, tasks), width,
                 _find_positives(positives), "row bigint, id bigint, other bigint, score bigint")
    found = _first(first, positives, "row").groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("found"))
    with_found = stored(own.join(found, "row").select(
        "row", F.col("id").alias("anchor_id"), "label", "v", F.col("found.id").alias("ids"),
        F.col("found.score").alias("scores")), "negatives-positives")

    second = _run(_pairs(_anchor_blocks(with_found, facts.anchors, anchors, "label", "v", "scores"), blocks, n_blocks, tasks),
                  width, _find_negatives(negatives, low, high),
                  "row bigint, nth bigint, id bigint, other bigint, score bigint")
    return (_first(second, negatives, "row", "nth").join(with_found.select("row", "anchor_id", "ids", "scores"), "row")
            .select("anchor_id", F.get("ids", F.col("nth").cast("int")).alias("positive_id"), "rank",
                    F.col("id").alias("negative_id"), F.get("scores", F.col("nth").cast("int")).alias("positive_score"),
                    F.col("score").alias("negative_score")))
