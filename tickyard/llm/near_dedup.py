"""MinHash near-duplicates by tensored banding.

Two collections of short MinHash groups are computed per set: LEFT groups of
LEFT_ROWS hashes and RIGHT groups of RIGHT_ROWS.  A table key is a pair of one
group from each, so LEFT x RIGHT tables of LEFT_ROWS + RIGHT_ROWS hashes need
only LEFT * LEFT_ROWS + RIGHT * RIGHT_ROWS hash functions.  Two sets of
similarity s share a key unless all left or all right groups differ:
miss = 1 - (1 - (1 - s**3)**12) * (1 - (1 - s**2)**10), 2e-4 at s = 0.8 and
4e-5 at 0.85; a document has that chance with each of its neighbours.

Equal sets are one class before any table is built.  Candidates are taken in two
steps.  First every member of a table's bucket with one member, the bucket's
leader; which member leads changes from table to table, so a document in a large
group meets TURNS leaders.  These links are verified and joined to components.
Then, for the documents of buckets that still hold more than one component, the
pairs across components, found by exact filters of set joins: what a set shares
with no other component counts against it, the rest is compared by pieces, by
its rarest shingles and by parity sketches (``_across``).  Pairs inside a component
add no information.  So a large group of copies costs rows in proportion to its
size, and heavily edited copies fall out by their own shingles.  Every link is
confirmed on the full sets.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from .common import by_slices, raw, stored
from .graph import components

LEFT, LEFT_ROWS = 12, 3
RIGHT, RIGHT_ROWS = 10, 2
TURNS = 2               # leaders that a member of a large group meets
PERCENT = 80            # similarity, in hundredths, from which sets are linked
PIECE = 16              # least shingles of a set for each piece that sets are compared by
SKETCH = 256            # bits of a set's parity sketch
BROADCAST_IDS = 1_000_000   # ids of 8 bytes; more of them are joined by a shuffle
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)


class Shingler:
    """Sorted distinct 64-bit hashes of a text's word shingles."""

    def __init__(self, width: int, memo: int = 100_000):
        self.width, self.memo_size, self.memo = width, memo, {}

    def _hash(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self.memo) < self.memo_size:
            self.memo[word] = h
        return h

    def of(self, text: bytes) -> np.ndarray:
        """No words: empty; fewer words than the width: the whole sequence is one shingle."""
        words = text.lower().split()   # of bytes: A-Z and the six ASCII white-space characters
        if not words:
            return np.zeros(0, np.uint64)
        get = self.memo.get
        codes = np.fromiter([get(w) or self._hash(w) for w in words], np.uint64, len(words))
        k = min(self.width, len(words))
        n = len(words) - k + 1
        with np.errstate(over="ignore"):
            h = np.full(n, k, np.uint64)
            for i in range(k):
                h = (h ^ codes[i:i + n]) * np.uint64(MIX[0])
                h ^= h >> np.uint64(29)
        h.sort()
        return h[np.append(True, h[1:] != h[:-1])]


class Tensor:
    """Table keys of a set from the two collections of MinHash groups."""

    def __init__(self, seed: int = 1):
        count = LEFT * LEFT_ROWS + RIGHT * RIGHT_ROWS
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = rng.integers(0, 1 << 63, count, dtype=np.uint64)

    def minhashes(self, values: np.ndarray) -> np.ndarray:
        """One minimum per hash function, over blocks of the set's values."""
        best = np.full((len(self.a), 1), np.iinfo(np.uint64).max, np.uint64)
        with np.errstate(over="ignore"):
            for at in range(0, len(values), 512):
                block = np.multiply.outer(self.a, values[at:at + 512])
                block += self.b[:, None]
                np.minimum(best, block.min(axis=1, keepdims=True), out=best)
        return best[:, 0]

    def signature(self, values: np.ndarray) -> bytes:
        """The upper halves of the minima: 4 bytes for each hash function."""
        return (self.minhashes(values) >> np.uint64(32)).astype("<u4").tobytes()


def keys_of(signatures: np.ndarray) -> np.ndarray:
    """The LEFT * RIGHT table keys of each row of ``signatures``."""
    m = signatures.astype(np.uint64)
    cut = LEFT * LEFT_ROWS
    with np.errstate(over="ignore"):
        left = _fold(m[:, :cut].reshape(len(m), LEFT, LEFT_ROWS))
        right = _fold(m[:, cut:].reshape(len(m), RIGHT, RIGHT_ROWS))
        table = np.arange(LEFT * RIGHT, dtype=np.uint64).reshape(LEFT, RIGHT) + np.uint64(1)
        key = (left[:, :, None] * np.uint64(MIX[0]) ^ right[:, None, :] * np.uint64(MIX[1])) + table
        key = (key ^ (key >> np.uint64(31))) * np.uint64(MIX[0])
        return key ^ (key >> np.uint64(29))


def _fold(groups: np.ndarray) -> np.ndarray:
    h = np.zeros(groups.shape[:-1], np.uint64)
    for i in range(groups.shape[-1]):
        h = (h ^ groups[..., i]) * np.uint64(MIX[1])
        h ^= h >> np.uint64(33)
    return h


def signatures(docs: DataFrame, width: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, set_hash, minima) for every row; minima and hash of an
    empty set are null.  ``minima`` has 4 bytes for each hash function."""
    rows = docs.select(F.col(key).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        s, tensor = Shingler(width), Tensor()

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            n, digest, minima = [], [], []
            for t in raw(b.column(1)):
                v = s.of(t)
                n.append(len(v))
                digest.append(xxhash.xxh3_128_digest(v.tobytes()) if len(v) else None)
                minima.append(tensor.signature(v) if len(v) else None)
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(minima, pa.binary())], ["doc_id", "n_shingles", "set_hash", "minima"])
        yield from by_slices(one)(batches)
    return rows.mapInArrow(run, "doc_id bigint, n_shingles bigint, set_hash binary, minima binary")


def table_keys(classes: DataFrame) -> DataFrame:
    """(key, id): one row per class and table."""
    def run(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                b = batch.slice(at, 4096)
                minima = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u4")
                flat = keys_of(minima.reshape(b.num_rows, -1)).ravel().view(np.int64)
                ids = np.repeat(b.column(0).to_numpy(zero_copy_only=False), LEFT * RIGHT)
                yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(ids)], ["key", "id"])
    return classes.select("id", "minima").mapInArrow(run, "key bigint, id bigint")


def sets_of(docs: DataFrame, ids: DataFrame, width: int, key: str = "doc_id",
            text: str = "text") -> DataFrame:
    """(id, set, shingles binary) of the documents whose id is in ``ids``, one row
    for each distinct set of an id; ``set`` is a hash that tells an id's sets apart."""
    rows = docs.select(F.col(key).cast("long").alias("id"), F.col(text).alias("text"))
    few = ids.count() <= BROADCAST_IDS
    rows = rows.filter("text is not null").join(F.broadcast(ids) if few else ids, "id", "left_semi")

    def run(batches):
        s = Shingler(width)

        def one(b: pa.RecordBatch) -> pa.RecordBatch:
            sets = [s.of(t).tobytes() for t in raw(b.column(1))]
            marks = np.fromiter(map(xxhash.xxh64_intdigest, sets), np.uint64, len(sets)).view(np.int64)
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(marks), pa.array(sets, pa.binary())], ["id", "set", "shingles"])
        yield from by_slices(one)(batches)
    sets = stored(rows.mapInArrow(run, "id bigint, set bigint, shingles binary"), "dedup-sets")
    if sets.select("id", "set").distinct().count() == sets.count():   # no row repeats: the sets need not be moved
        return sets
    return stored(sets.dropDuplicates(["id", "set"]), "dedup-sets")


def confirmed(pairs: DataFrame, docs: DataFrame, width: int, percent: int, key: str = "doc_id",
              text: str = "text") -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity."""
    ids = stored(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "dedup-ids")
    sets = sets_of(docs, ids, width, key, text).select("id", "shingles")
    both = (pairs.join(sets.withColumnsRenamed({"id": "a", "shingles": "x"}), "a")
            .join(sets.withColumnsRenamed({"id": "b", "shingles": "y"}), "b"))

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            good = []
            for i in range(batch.num_rows):
                s, t = (np.frombuffer(c[i].as_buffer(), np.uint64) for c in (x, y))
                inner = len(np.intersect1d(s, t, assume_unique=True))
                good.append(100 * inner >= percent * (len(s) + len(t) - inner))
            yield pa.RecordBatch.from_arrays([a, b], ["a", "b"]).filter(pa.array(good, pa.bool_()))
    return both.select("a", "b", "x", "y").mapInArrow(run, "a bigint, b bigint").distinct()


def near_duplicates(docs: DataFrame, width: int, percent: int = PERCENT, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    component_id is the smallest doc_id that links reach.  A document without
    words is linked with nothing.  A null doc_id can be no end of a link: its
    component_id is null and the row is kept.  Rows that repeat a doc_id are one
    document: links of any of them count, and all have its component.
    """
    signed = stored(signatures(docs, width, key, text), "dedup-signatures")
    sets = signed.filter("set_hash is not null and doc_id is not null")
    classes = stored(sets.groupBy("set_hash").agg(
        F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.first("minima").alias("minima")),
        "dedup-classes")
    copies = (sets.select("set_hash", "doc_id").join(classes.select("set_hash", "id"), "set_hash")
              .filter("doc_id <> id").select(F.col("id").alias("a"), F.col("doc_id").alias("b")))
    links = _links(docs, classes, width, percent, key, text)
    parts = components(copies.unionByName(links))
    return (signed.join(parts.withColumnsRenamed({"node": "doc_id"}), "doc_id", "left")
            .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))


def _links(docs: DataFrame, classes: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """Confirmed links between classes, enough of them for the components: those
    of the first step as stars already, then those across them."""
    keys = table_keys(classes)
    mixed_id = F.col("id").bitwiseXOR(_mask())
    buckets = (keys.groupBy("key").agg(F.min(mixed_id).alias("first"), F.max(mixed_id).alias("last"))
               .filter("first < last").select("key", F.col("first").bitwiseXOR(_mask()).alias("lead")))
    members = stored(keys.join(buckets, "key"), "dedup-buckets")
    pairs = (members.filter("id <> lead")
             .select(F.least("id", "lead").alias("a"), F.greatest("id", "lead").alias("b")).distinct())
    n = lambda c: classes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"))
    sized = (pairs.join(n("a"), "a").join(n("b"), "b")
             .filter(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")).select("a", "b"))
    first = stored(sized, "dedup-pairs")
    stars = stored(confirmed(first, docs, width, percent, key, text), "dedup-links")

    part = stored(components(stars), "dedup-parts")
    placed = members.join(part.withColumnsRenamed({"node": "id"}), "id", "left").select(
        "key", "id", F.coalesce("component", "id").alias("part"))
    several = (placed.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q"))
               .filter("p < q").select("key"))
    open_ids = stored(placed.join(several, "key").select("id", "part").distinct(), "dedup-open")
    second = _across(open_ids, docs, width, percent, key, text)
    second = stored(second.join(first, ["a", "b"], "left_anti"), "dedup-pairs")
    known = part.filter("node <> component").select(F.col("component").alias("a"), F.col("node").alias("b"))
    return known.unionByName(confirmed(second, docs, width, percent, key, text))


def _mask() -> Column:
    """A constant per turn of a table key; ids are compared after XOR with it."""
    return F.xxhash64(F.pmod("key", F.lit(TURNS)))


def _across(members: DataFrame, docs: DataFrame, width: int, percent: int, key: str, text: str) -> DataFrame:
    """Pairs (a, b) of ``members`` (id, part) in different parts that can reach the
    similarity.

    Every set of a member stands for itself: rows that repeat an id can have
    several, and copies count once.  Sets of n and m shingles reach the similarity
    if they differ in at most (100 - percent) / (100 + percent) of n + m shingles.
    A shingle that no other part has always differs, so it is paid from its own
    set's share of that sum; what both have left, the pair's slack, bounds the
    difference of the other, shareable shingles.  Three exact filters follow:

    * With a slack below P, sets dealt by hash into P pieces have a piece in
      common; pieces are compared by their hash.  This is used while a piece has
      PIECE shingles or more, so that empty ones do not decide.
    * Other pairs share one of their rarest shingles, at a place where enough of
      both sets is left (prefix and positional filter).
    * The parities of SKETCH buckets of the sets differ in at most as many bits as
      the sets differ in shingles.

    Copies with edits of their own lose their slack to these, so a group of them
    is compared by hashes that differ, and few pairs come out that are no links.
    """
    sets = sets_of(docs, members.select("id").distinct(), width, key, text)

    def spread(batches):
        for batch in batches:
            for i, mark, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                values = np.frombuffer(x.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(values), i)), pa.array(np.full(len(values), mark)),
                     pa.array(np.full(len(values), len(values))), pa.array(values)], ["id", "set", "n", "shingle"])

    rows = sets.mapInArrow(spread, "id bigint, set bigint, n bigint, shingle bigint").join(members, "id")
    common = (rows.groupBy("shingle").agg(F.count("*").alias("df"), F.min("part").alias("p"), F.max("part").alias("q"))
              .filter("p < q").select("shingle", "df"))
    own = F.col("n") - F.size("shared")
    slack = (100 - percent) * F.col("n") - (100 + percent) * own
    shared = stored(rows.join(common, "shingle").groupBy("id", "set", "part", "n")
                    .agg(F.sort_array(F.collect_list(F.struct("df", "shingle"))).alias("shared"))
                    .withColumn("slack", slack)
                    # a partner has at most 100 / percent times the shingles, and no more slack than their share
                    .filter(percent * F.col("slack") + 100 * (100 - percent) * F.col("n") >= 0)
                    .select("id", "set", "part", "n", "slack", F.col("shared.shingle").alias("shared")), "dedup-shared")

    places = stored(_places(shared, percent), "dedup-places")
    several = places.groupBy("key").agg(F.min("part").alias("p"), F.max("part").alias("q")).filter("p < q").select("key")
    sketches = [f"s{i}" for i in range(SKETCH // 64)]
    open_places = places.join(several, "key")
    x, y = (open_places.select("key", *[F.col(k).alias(f"{k}_{c}") for k in ("id", "set", "part", "n", "slack", "at", *sketches)])
            for c in "ab")
    share = 100 + percent
    both = F.col("slack_a") + F.col("slack_b")
    room = F.floor(both / share)                                    # shareable shingles in which they may differ
    pieces = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.when(room > 0, F.length(F.bin(room))).otherwise(0))
    fewest = F.least("n_a", "n_b")
    by_pieces = PIECE * pieces <= fewest
    left = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b")) + 1
    differ = sum((F.bit_count(F.col(f"{s}_a").bitwiseXOR(F.col(f"{s}_b"))) for s in sketches), F.lit(0))
    can = ((F.col("part_a") < F.col("part_b")) & (both >= 0) & (100 * fewest >= percent * F.greatest("n_a", "n_b"))
           & F.when(by_pieces, F.col("at_a") == -pieces)
              .otherwise((F.col("at_a") > 0) & (share * left >= percent * (F.col("n_a") + F.col("n_b"))))
           & (differ <= room))
    return (x.join(y, "key").filter(can)
            .select(F.least("id_a", "id_b").alias("a"), F.greatest("id_a", "id_b").alias("b")).distinct())


def _places(shared: DataFrame, percent: int) -> DataFrame:
    """(key, id, set, part, n, slack, at, s0...): what a set can meet others by.
    ``at`` is minus the number of pieces, or the place of one of the rarest shingles."""
    names = ["id", "set", "part", "n", "slack"]

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                n = batch.column(3)[i].as_py()
                v = batch.column(5)[i].values.to_numpy(zero_copy_only=False).view(np.uint64)
                bits = np.bincount((v % np.uint64(SKETCH)).astype(np.int64), minlength=SKETCH) & 1
                sketch = np.packbits(bits.astype(np.uint8)).view(np.int64)
                mixed = (v ^ (v >> np.uint64(31))) * np.uint64(MIX[1])
                keys, at, pieces = [], [], 1
                while PIECE * pieces <= n:
                    total = np.zeros(pieces, np.uint64)
                    piece = (mixed >> np.uint64(40)).astype(np.int64) % pieces
                    np.add.at(total, piece, mixed)
                    key = (total ^ np.uint64(pieces)) * np.uint64(MIX[0]) + np.arange(pieces, dtype=np.uint64)
                    keys.append((key ^ (key >> np.uint64(29))) * np.uint64(MIX[1]))
                    at.append(np.full(pieces, -pieces))
                    pieces *= 2
                own = n - len(v)                      # places of the shingles that no other part has
                head = n - -(-percent * n // 100) + 1 - own
                keys.append(v[:max(head, 0)])
                at.append(np.arange(max(head, 0)) + own + 1)
                at = np.concatenate(at)
                one = batch.slice(i, 1)
                cols = [pa.array(np.full(len(at), one.column(c)[0].as_py(), np.int64)) for c in range(5)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(keys).view(np.int64)), *cols, pa.array(at.astype(np.int64)),
                     *[pa.array(np.full(len(at), w)) for w in sketch]],
                    ["key", *names, "at", *[f"s{i}" for i in range(len(sketch))]])
    columns = ["key", *names, "at", *[f"s{i}" for i in range(SKETCH // 64)]]
    return shared.select(*names, "shared").mapInArrow(run, ", ".join(f"{c} bigint" for c in columns))


def survivors(docs: DataFrame, width: int, percent: int = PERCENT) -> DataFrame:
    """One row of ``docs`` for each component, all columns as they were: the one
    with the smallest doc_id.  Rows without a doc_id or without words all stay;
    of rows that repeat a kept doc_id the first by their text stays."""
    found = near_duplicates(docs, width, percent)
    dropped = found.filter("not kept").select("doc_id").distinct()
    single = docs.join(dropped, "doc_id", "left_anti")
    again = stored(single.filter("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n"))
                   .filter("n > 1").select("doc_id"), "dedup-repeats")
    if again.isEmpty():
        return single.select(docs.columns)
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = (single.join(again, "doc_id", "left_semi").groupBy("doc_id")
           .agg(F.min_by(whole, F.struct(F.col("text"))).alias("__row")).select("__row.*"))
    return single.join(again, "doc_id", "left_anti").select(docs.columns).unionByName(one)
