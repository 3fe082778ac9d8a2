"""Quality rules with thresholds learned from the corpus.

One pass measures every text.  Each measure of each (language, source) goes
into a quantile sketch: integer counts in log-linear buckets (64 exact values,
then 32 buckets per doubling, relative error under 1/32).  Sketches merge by
adding counts, so they combine map-side, a hot source costs no more than a
small one, and a language's or the corpus's sketch is the sum of its sources'.
Fences come from the sketches' own spread: a quartile plus ``spread`` times its
distance from the median, so junk up to a quarter of a group on one side does
not move them.  Most documents score 0 in some measures.  Where more than half of
a group does, the fence comes from the sketch of the values above 0, its tail.
A tail may be ordinary or junk, which its values alone don't tell; the sketch of
the word lengths of its documents does: where more than TAIL_JUNK of them lie
outside the word-length fences, the tail is junk and the fence is half its lower
quartile, else its upper quartile and spread.  The quartiles of a group are means
of its own and its language's, weighted by documents against ``SHRINK``; those
of a language likewise lean on the corpus.  So a small group follows its
language smoothly, without a least number of rows.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .common import by_slices, column_of, key_of, raw, stored, with_text

MIN_WORDS = 50            # the contract's base rule
MAX_REPEAT_PERCENT = 50   # the contract's base rule
SHRINK = 50               # documents that the wider sketch counts for beside a group's own
SPREAD = 8
TAIL_JUNK = 250           # of 1000 documents of a tail
BROADCAST_GROUPS = 100_000   # rows of some 100 bytes

SYMBOLS = b"#*$%&|<>"
STARTS = bytes(b for b in range(256) if not 0x80 <= b < 0xC0)   # first bytes of code points
COUNTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Measure:
    """An integer measure ``1000 * top / bottom``."""
    name: str
    top: str
    bottom: str


LENGTH = Measure("word_length", "word_chars", "n_words")     # has a fence on either side
RATES = (
    Measure("symbols", "n_symbols", "n_words"),
    Measure("dup_lines", "n_dup_lines", "n_lines"),
    Measure("repeats", "n_repeat_words", "n_words"),
)
MEASURES = (LENGTH, *RATES)


def counts_of(text: bytes) -> tuple[int, ...]:
    """The counts of COUNTS for one whole text in UTF-8.

    bytes.split() and strip() know exactly the six white-space characters of
    the word pattern; bytes 0x80-0xBF continue a code point."""
    words = text.split()
    lines = [x for x in text.split(b"\n") if x.strip()]
    inner = b"".join(words)
    chars = len(inner) - len(inner.translate(None, STARTS))
    return (len(words), chars, len(inner) - len(inner.translate(None, SYMBOLS)), len(lines),
            len(lines) - len(set(lines)), _repeat_words(words))


def _repeat_words(words: list[bytes]) -> int:
    """Words inside three-word windows that occur at least twice in the text."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    found = Counter(windows)
    covered, end = 0, 0   # windows start in order: count each word once
    for i, w in enumerate(windows):
        if found[w] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def measure(docs: DataFrame, *keep: str, text: str = "text") -> DataFrame:
    """Columns ``keep`` of ``docs`` plus the counts; a null text counts as empty.
    ``text`` may be a field of a struct in ``keep``, like ``row.text``."""
    rows, names, place = with_text(docs, keep, text)
    schema = T.StructType([rows.schema[n] for n in names]
                          + [T.StructField(c, T.LongType()) for c in COUNTS])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        cols = list(zip(*[counts_of(t or b"") for t in raw(column_of(b, place))], strict=True))
        return pa.RecordBatch.from_arrays(
            [*b.columns[:len(names)], *[pa.array(c, pa.int64()) for c in cols]], [*names, *COUNTS])

    out = rows.mapInArrow(by_slices(one, place), schema)
    return out.withColumnsRenamed(dict(zip(names, keep, strict=True)))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def value_of(m: Measure) -> Column:
    """The measure as a whole number; 0 where the denominator is 0."""
    return F.when(F.col(m.bottom) > 0,
                  F.expr(f"(1000 * {m.top}) div {m.bottom}")).otherwise(F.lit(0)).cast("long")


def bucket_of(value: Column) -> Column:
    """Lower end of the value's sketch bucket: the six leading binary digits."""
    drop = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketch(measured: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, measure, bucket, n): the mergeable sketches, as key strings.
    ``@symbols`` and so on are the word lengths of the documents in a tail."""
    pair = lambda name, value: F.struct(F.lit(name).alias("measure"), bucket_of(value).alias("bucket"))
    pairs = F.array(*[pair(m.name, value_of(m)) for m in MEASURES],
                    *[F.when(value_of(m) > 0, pair(f"@{m.name}", value_of(LENGTH))) for m in RATES])
    return (measured.filter(~base_failed())
            .select(key_of(lang).alias("lang"), key_of(source).alias("source"), F.inline(F.array_compact(pairs)))
            .groupBy("lang", "source", "measure", "bucket").agg(F.count("*").alias("n")))


def quantiles(sketches: DataFrame, *keys: str) -> DataFrame:
    """Quartiles per key and measure: the first bucket that reaches the rank."""
    merged = sketches.groupBy(*keys, "measure", "bucket").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "measure")
    upto = (merged.withColumn("upto", F.sum("n").over(w.orderBy("bucket")))
            .withColumn("total", F.sum("n").over(w)))
    first = lambda q: F.min(F.when(4 * F.col("upto") >= q * F.col("total"), F.col("bucket")))
    return upto.groupBy(*keys, "measure").agg(
        first(1).alias("q1"), first(2).alias("q2"), first(3).alias("q3"), F.max("total").alias("rows"))


def _width(outer: Column, middle: Column) -> Column:
    """``SPREAD`` times the distance, at least four buckets: it may vanish between equal quartiles."""
    return F.greatest(SPREAD * F.abs(outer - middle), F.floor(outer / 8) + 1)


def statistics(sketches: DataFrame, *keys: str) -> DataFrame:
    """One row per key: a struct (q1, q2, q3, rows) per measure, one per tail with
    ``out``, the share outside the word-length fences in thousandths."""
    tails = (sketches.filter(F.col("measure").isin([m.name for m in RATES]) & (F.col("bucket") > 0))
             .withColumn("measure", F.concat(F.lit("+"), F.col("measure"))))
    stat = F.struct("q1", "q2", "q3", "rows")
    wide = quantiles(sketches.filter(~F.col("measure").startswith("@")).unionByName(tails), *keys).groupBy(*keys).agg(
        *[F.max(F.when(F.col("measure") == name, stat)).alias(name)
          for name in [*[m.name for m in MEASURES], *[f"+{m.name}" for m in RATES]]])
    length = F.col(LENGTH.name)
    outside = ((F.col("bucket") > length["q3"] + _width(length["q3"], length["q2"]))
               | (F.col("bucket") < length["q1"] - _width(length["q1"], length["q2"])))
    company = (sketches.filter(F.col("measure").startswith("@")).join(wide.select(*keys, LENGTH.name), list(keys))
               .groupBy(*keys).agg(*[F.floor(
                   1000 * F.sum(F.when((F.col("measure") == f"@{m.name}") & outside, F.col("n")).otherwise(0))
                   / F.sum(F.when(F.col("measure") == f"@{m.name}", F.col("n")))).alias(f"out_{m.name}") for m in RATES]))
    return wide.join(company, list(keys), "left").select(*keys, *[F.col(m.name) for m in MEASURES], *[
        F.when(F.col(f"+{m.name}").isNotNull(), F.struct(F.col(f"+{m.name}.*"), F.col(f"out_{m.name}").alias("out"))
               ).alias(f"tail_{m.name}") for m in RATES])


def _lean(own: Column, wider: Column, *fields: str) -> Column:
    """The weighted mean of two structs' fields; one that is null counts for nothing."""
    both = F.struct(*[F.floor((own["rows"] * own[f] + SHRINK * wider[f]) / (own["rows"] + SHRINK)).alias(f) for f in fields],
                    own["rows"].alias("rows"))
    only = F.struct(*[wider[f].alias(f) for f in fields], F.lit(0).cast("long").alias("rows"))
    alone = F.struct(*[own[f].alias(f) for f in fields], own["rows"].alias("rows"))
    return F.when(own.isNull() & wider.isNotNull(), only).when(wider.isNull() & own.isNotNull(), alone).when(own.isNotNull(), both)


QUARTERS = ("q1", "q2", "q3")


def fences(sketches: DataFrame) -> DataFrame:
    """One row per (lang, source): struct columns of (low, high) per measure.

    The sketches and the statistics of each level are written once: they are
    small, and the texts behind them are not measured again for each use."""
    sketches = stored(sketches, "quality-sketches")
    names = [m.name for m in MEASURES] + [f"tail_{m.name}" for m in RATES]
    fields = {n: (*QUARTERS, "out") if n.startswith("tail_") else QUARTERS for n in names}
    level = lambda tag, *keys: stored(statistics(sketches, *keys), "quality-statistics").withColumnsRenamed(
        {n: f"{tag}_{n}" for n in names})
    corpus = statistics(sketches.withColumn("all", F.lit(1)), "all").first()

    def whole(n: str) -> Column:     # one row for the corpus: its statistics are constants
        got = corpus[n] if corpus else None
        kind = ", ".join(f"{f}: bigint" for f in (*fields[n], "rows"))
        if got is None:
            return F.lit(None).cast(f"struct<{kind}>")
        return F.struct(*[F.lit(got[f]).cast("long").alias(f) for f in (*fields[n], "rows")])
    by_lang = level("lang", "lang").select("lang", *[
        _lean(F.col(f"lang_{n}"), whole(n), *fields[n]).alias(f"lang_{n}") for n in names])
    own = level("own", "lang", "source").join(by_lang, "lang", "left").select("lang", "source", *[
        _lean(F.col(f"own_{n}"), F.col(f"lang_{n}"), *fields[n]).alias(n) for n in names])
    high = lambda q: q["q3"] + _width(q["q3"], q["q2"])

    def upper(m: Measure) -> Column:
        tail = F.col(f"tail_{m.name}")
        by_tail = F.when(tail["out"] > TAIL_JUNK, F.floor(tail["q1"] / 2)).otherwise(high(tail))
        return F.when(F.col(m.name)["q2"] > 0, high(F.col(m.name))).otherwise(F.coalesce(by_tail, F.lit(0)))
    q = F.col(LENGTH.name)
    length = F.struct((q["q1"] - _width(q["q1"], q["q2"])).alias("low"), high(q).alias("high"))
    return own.select("lang", "source", length.alias(f"fence_{LENGTH.name}"), *[
        F.struct(F.lit(None).cast("long").alias("low"), upper(m).alias("high")).alias(f"fence_{m.name}") for m in RATES])


def judge(measured: DataFrame, limits: DataFrame, lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with base_failed and kept, by a join on (lang, source).

    A group without fences has only documents that fail the base rules."""
    rows = (measured.withColumn("base_failed", base_failed())
            .withColumn("__lang", key_of(lang)).withColumn("__source", key_of(source)))
    limits = stored(limits, "quality-fences").withColumnsRenamed({"lang": "__lang", "source": "__source"})
    if limits.count() <= BROADCAST_GROUPS:   # else a shuffle join, whose hot keys are split
        limits = F.broadcast(limits)
    good = F.lit(True)
    for m in MEASURES:
        fence, v = F.col(f"fence_{m.name}"), value_of(m)
        good = good & (v <= fence["high"])
        if m is LENGTH:
            good = good & (v >= fence["low"])
    return (rows.join(limits, ["__lang", "__source"], "left")
            .withColumn("kept", ~F.col("base_failed") & F.coalesce(good, F.lit(False)))
            .drop("__lang", "__source", *[f"fence_{m.name}" for m in MEASURES]))


def rules(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every document's counts and verdict; texts are read once.

    Null and empty texts have no words and fail the base rules; null languages
    and sources form groups of their own; repeated rows are judged one by one.
    """
    measured = stored(measure(docs, key, "lang", "source"), "quality-counts")
    return judge(measured, fences(sketch(measured))).drop("lang", "source")


def accepted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that pass, all columns as they were.

    Texts are measured twice, once for the sketches and once with the rows:
    only counts by bucket are moved or stored, never the texts.  A row goes to
    Python whole and once, its text inside it.
    """
    limits = fences(sketch(measure(docs, "lang", "source")))
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    measured = measure(docs.select(whole.alias("__row")), "__row", text="__row.text")
    judged = judge(measured, limits, "__row.lang", "__row.source")
    return judged.filter("kept").select("__row.*")
