"""Benchmark decontamination: size-partitioned MinHash containment search.

A test item is short and a document may be long, so their Jaccard similarity
says little; what counts is how much of the item the document contains.  The
documents are partitioned by the size of their shingle list, in powers of two,
and every partition has its own number of MinHash bins (one-permutation
MinHash: the upper bits of a shingle's hash choose the bin, a bin keeps its
smallest hash).  The bins grow with the partition's upper size, so the chance
that a contained shingle is the minimum of its bin is the same for a document
of fifty words and one of a million.  A shared shingle is lost if it is no
minimum on either side; the item's own other shingles are at most a quarter of
the document's, so load is n / bins / 0.8.  The width is set from the smallest
item of two shingles or more: with m = 0.8 * q shared shingles the chance to
miss all of them is at most (1 - (1 - exp(-load)) / load) ** m, kept below
``MISS``.  No width does that for an item of one shingle: if there are such
items, every shingle of a document probes for them.

Items of fewer than WIDTH words are one shingle of their own length, searched
exactly among the documents' shingles of that length.

An item knows for each partition which of its shingles are minima there.  A
document and an item that agree in a bin are a candidate; each candidate is
then verified by exact containment over all shingles of the whole document.
Everything is DataFrame expressions: one pass over the texts without a shuffle
for the search, and the texts of the candidates again for the verification.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import WORD_SPLIT, stored

WIDTH = 5
CONTAINMENT = 80          # percent of an item's distinct shingles
MISS = 1e-4
CLASSES = 32              # size partitions; the last one has no upper size
BROADCAST_SHINGLES = 1_000_000   # item shingles of 24 bytes; more are joined by a shuffle
BROADCAST_IDS = 1_000_000


def words(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), WORD_SPLIT), lambda w: w != "")


def with_shingles(df: DataFrame, *keep: str, text: str = "text", width: int = WIDTH) -> DataFrame:
    """Columns ``keep`` and ``hashes``, one 64-bit hash per shingle in text
    order; empty for a null text and for one of fewer words than ``width``."""
    coded = df.select(*keep, F.transform(words(F.coalesce(F.col(text), F.lit(""))),
                                         lambda w: F.xxhash64(w)).alias("__w"))
    one = lambda i: F.xxhash64(*[F.get(F.col("__w"), i + k) for k in range(width)])
    n = F.size("__w")
    return coded.select(*keep, F.when(
        n >= width, F.transform(F.sequence(F.lit(0), n - width), one)
    ).otherwise(F.array().cast("array<bigint>")).alias("hashes"))


def size_class(n: Column) -> Column:
    """Number of binary digits of n, so that n < 2 ** class."""
    return F.least(F.length(F.bin(n)), F.lit(CLASSES - 1))


def extra_bits(smallest_item: int, percent: int = CONTAINMENT, miss: float = MISS) -> int:
    """Bins per partition are 2 ** (class + this), for items of two shingles or more."""
    shared = max(1, math.ceil(percent * smallest_item / 100))
    need = 1 - miss ** (1 / shared)      # the chance each shared shingle must have
    load, both = 4.0, 100 / percent      # both: shingles of document and item for one of the document
    while load > 1 / 64 and (1 - math.exp(-both * load)) / (both * load) < need:
        load /= 2
    return round(-math.log2(load))


def minima(sorted_hashes: Column, bits: Column) -> Column:
    """The first of each run of hashes with equal upper ``bits``, from sorted hashes."""
    return F.filter(sorted_hashes, _is_first(sorted_hashes, bits))


def _is_first(sorted_hashes: Column, bits: Column):
    bin_of = lambda h: F.call_function("shiftright", h, F.lit(64) - bits)
    return lambda h, i: (i == 0) | (bin_of(h) != bin_of(F.get(sorted_hashes, i - 1)))


def item_sets(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, hashes, n): distinct sorted shingles of the items that have any."""
    sets = with_shingles(benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("__t")),
                         "item_id", text="__t")
    sets = sets.select("item_id", F.sort_array(F.array_distinct("hashes")).alias("hashes"))
    return sets.withColumn("n", F.size("hashes")).filter("n > 0")


def item_minima(sets: DataFrame, extra: int) -> DataFrame:
    """(value, item_id, classes, alone): the classes in which the shingle is a
    minimum, as bits, and whether it is all of the item."""
    per_class = (sets.withColumn("class", F.explode(F.sequence(F.lit(1), F.lit(CLASSES - 1))))
                 .withColumn("value", F.explode(minima(F.col("hashes"), _bits(F.col("class"), extra)))))
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("class"))
    return per_class.groupBy("value", "item_id").agg(F.bit_or(mark).alias("classes"),
                                             F.max(F.col("n") == 1).alias("alone"))


def _bits(size_of: Column, extra: int) -> Column:
    return F.greatest(size_of + extra, F.lit(1))


def candidates(docs: DataFrame, sets: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, item_id) that agree in a bin of the document's partition,
    or at all if the item has one shingle."""
    facts = sets.agg(F.min(F.when(F.col("n") > 1, F.col("n"))).alias("least"), F.sum("n").alias("shingles"),
                     F.max(F.col("n") == 1).alias("alone")).first()
    extra = extra_bits(facts.least or WIDTH)
    index = item_minima(sets, extra)
    if (facts.shingles or 0) <= BROADCAST_SHINGLES:
        index = F.broadcast(index)
    hashed = with_shingles(docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__t")),
                           "doc_id", text="__t")
    ordered = hashed.select("doc_id", size_class(F.size("hashes")).alias("class"),
                            F.sort_array("hashes").alias("hashes"))
    in_class = F.call_function("shiftright", F.col("classes"), F.col("class")).bitwiseAND(F.lit(1)) == 1
    of_bits = _bits(F.col("class"), extra)
    # explode_outer: no filter on the minima is inferred and pushed below the sort
    if facts.alone:
        is_first = _is_first(F.col("hashes"), of_bits)
        probes = F.transform("hashes", lambda h, i: F.struct(h.alias("value"), is_first(h, i).alias("least")))
        bins = ordered.select("doc_id", "class", F.explode_outer(probes).alias("__p")).select("doc_id", "class", "__p.*")
        fits = F.col("alone") | (F.col("least") & in_class)
    else:
        bins = ordered.select("doc_id", "class", F.explode_outer(minima(F.col("hashes"), of_bits)).alias("value"))
        fits = in_class
    return bins.join(index, "value").filter(fits).select("doc_id", "item_id").distinct()


def short_items(benchmark: DataFrame, item: str = "item_id", text: str = "text") -> DataFrame:
    """(item_id, width, value) of the items of one to four words."""
    rows = benchmark.select(F.col(item).alias("item_id"), F.col(text).alias("__t"))
    per_width = [with_shingles(rows, "item_id", text="__t", width=k).filter(F.size("hashes") == 1)
                 .select("item_id", F.lit(k).alias("width"), F.col("hashes")[0].alias("value")) for k in range(1, WIDTH)]
    return reduce(DataFrame.unionByName, per_width).distinct()


def short_leaks(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Distinct (doc_id, item_id) of the documents that hold all words of a short
    item in a row; no pass over the documents where there is no such item."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__t"))
    found = [docs.sparkSession.createDataFrame([], T.StructType([rows.schema["doc_id"], items.schema["item_id"]]))]
    widths = items.groupBy("width").agg(F.count("*").alias("n")).collect()       # at most four rows
    for k, n in sorted(widths):
        own = items.filter(F.col("width") == k).select("item_id", "value")
        held = (with_shingles(rows, "doc_id", text="__t", width=k)
                .select("doc_id", F.explode(F.array_distinct("hashes")).alias("value")))
        found.append(held.join(F.broadcast(own) if n <= BROADCAST_SHINGLES else own, "value").select("doc_id", "item_id"))
    return reduce(DataFrame.unionByName, found).distinct()


def leaks(docs: DataFrame, benchmark: DataFrame, percent: int = CONTAINMENT, key: str = "doc_id",
          text: str = "text", item: str = "item_id") -> DataFrame:
    """(doc_id, item_id, n_shingles, n_shared) for every item found in a document.

    A document holds an item if it has at least ``percent`` of the item's
    distinct five-word shingles, wherever they stand.  An item of fewer than five
    words is held if its words stand in the document in a row; an item without
    words is held by none.  Texts of any length are searched whole; null texts
    hold nothing; a null
    doc_id or item_id is a value like others; rows that repeat an id count as one
    document (or item), and its best row counts.
    """
    sets = stored(item_sets(benchmark, item), "leak-items")
    found = stored(candidates(docs, sets, key, text), "leak-candidates")
    ids = found.select("doc_id").distinct().withColumnRenamed("doc_id", "__id")
    if found.count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = (docs.select(F.col(key).alias("doc_id"), F.col(text).alias("__t"))
            .join(ids, F.col("doc_id").eqNullSafe(F.col("__id")), "left_semi"))
    hashed = with_shingles(rows, "doc_id", text="__t").select("doc_id", F.col("hashes").alias("__have"))
    pairs = (found.withColumnsRenamed({"doc_id": "__doc", "item_id": "__item"})
             .join(hashed, F.col("__doc").eqNullSafe(F.col("doc_id")))
             .join(sets, F.col("__item").eqNullSafe(F.col("item_id"))))
    shared = F.size(F.array_intersect(F.col("hashes"), F.col("__have")))
    one = F.lit(1).cast("long")
    brief = short_leaks(docs, stored(short_items(benchmark, item), "leak-short-items"), key, text)
    return (pairs.select("doc_id", "item_id", F.col("n").cast("long").alias("n_shingles"),
                         shared.cast("long").alias("n_shared"))
            .unionByName(brief.select("doc_id", "item_id", one.alias("n_shingles"), one.alias("n_shared")))
            .filter(100 * F.col("n_shared") >= percent * F.col("n_shingles"))
            .groupBy("doc_id", "item_id").agg(F.max("n_shingles").alias("n_shingles"),
                                              F.max("n_shared").alias("n_shared")))


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no item, all columns as they were."""
    hit = stored(leaks(docs, benchmark).select(F.col("doc_id").alias("__hit")).distinct(), "leak-hits")
    return docs.join(hit, F.col("doc_id").eqNullSafe(F.col("__hit")), "left_anti")
