"""Data-quality rules as one column-expression pass.

``validate`` parses each raw JSON message once into a VARIANT and evaluates
every rule as a column expression; the result carries ``errors
ARRAY<STRING>`` (empty = valid) and the normalized typed fields.  No UDF, no
shuffle: a few projections over each row, nothing else.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..schemas import DLQ_ERROR_TYPES
from .parse import fill_event_id

# Rule constants (fixed values).
SYMBOL_PATTERN = r"^[A-Z0-9.\-:/]{1,32}\z"
REQUIRED_FIELDS = ("symbol", "price", "volume", "timestamp")
MAX_PAST = "1 day"
MAX_FUTURE = "5 minutes"

# Text accepted as a number by the producer's float(): optional sign, digit
# groups joined by single underscores, optional fraction and exponent, or
# nan / inf / infinity; surrounding whitespace allowed.
_DIGITS = r"[0-9](?:_?[0-9])*"
NUMBER_TEXT = (r"^\s*[+-]?(?:(?:(?:" + _DIGITS + r")(?:\.(?:" + _DIGITS + r")?)?|\.(?:" + _DIGITS
               + r"))(?:[eE][+-]?(?:" + _DIGITS + r"))?|(?i:nan|inf|infinity))\s*\z")
# Text accepted as a whole number by int().
INT_TEXT = r"^\s*[+-]?" + _DIGITS + r"\s*\z"
# ISO-8601 text, extended or basic: date, then optionally any separator, a time
# with up to microseconds and an offset.  Week dates are not accepted.
ISO_TEXT = (r"^(\d{4})(-?)(\d{2})\2(\d{2})"
            r"(?:[^0-9](\d{2})(?:(:?)(\d{2})(?:\6(\d{2})(?:[.,](\d{1,6})\d*)?)?)?"
            r"(Z|[+-]\d{2}(?::?\d{2})?)?)?\z")
# Error codes (fixed values).
MISSING = "missing_"
SYMBOL_INVALID, EVENT_ID_EMPTY, NOT_JSON = "symbol_invalid", "event_id_empty", "message_not_json"
PRICE_NOT_NUMBER, PRICE_NOT_POSITIVE = "price_not_number_or_invalid", "price_not_positive"
VOLUME_NOT_NUMBER, VOLUME_NEGATIVE = "volume_not_number_or_invalid", "volume_negative"
VOLUME_NOT_POSITIVE, VOLUME_NAN = "volume_not_positive", "volume_nan"
TIME_RANGE, TIME_PARSE, TIME_TYPE = "timestamp_out_of_range", "timestamp_parse_failed", "timestamp_invalid_type"
_INT_KINDS = ("BIGINT", "INT", "SMALLINT", "TINYINT")
_FLOAT_KINDS = ("DOUBLE", "FLOAT")


def _get(v: Column, name: str, typ: str = "variant") -> Column:
    return F.try_variant_get(v, f"$.{name}", typ)


def _blank(text: Column) -> Column:
    return text.rlike(r"^\s*\z")


def _numeric(kind: Column) -> Column:
    return kind.isin(*_INT_KINDS, *_FLOAT_KINDS) | kind.startswith("DECIMAL")


def _as_float(fv: Column, kind: Column, text: Column) -> Column:
    """float(x) semantics: JSON numbers, booleans (1.0/0.0) and numeric text."""
    clean = F.regexp_replace(text, r"^\s+|\s+\z|_", "")
    return (F.when(_numeric(kind), F.try_variant_get(fv, "$", "double"))
            .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))
            .when((kind == "STRING") & text.rlike(NUMBER_TEXT), clean.try_cast("double")))


def iso_millis(text: Column) -> Column:
    """Epoch ms of ISO-8601 text (naive = UTC), NULL for anything else.  The
    text is put into one canonical form first, since Spark's own parser also
    takes times without a date and other forms."""
    g = [F.regexp_extract(text, ISO_TEXT, k) for k in range(11)]
    two = lambda c: F.when(c == "", "00").otherwise(c)
    offset = (F.when(g[10] == "", "Z").when(F.length(g[10]) == 3, F.concat(g[10], F.lit(":00")))
              .when(F.length(g[10]) == 5, F.concat(F.substring(g[10], 1, 3), F.lit(":"), F.substring(g[10], 4, 2)))
              .otherwise(g[10]))
    canonical = F.concat(g[1], F.lit("-"), g[3], F.lit("-"), g[4], F.lit("T"), two(g[5]), F.lit(":"), two(g[7]),
                         F.lit(":"), two(g[8]), F.lit("."), F.rpad(g[9], 6, "0"), offset)
    return F.when(text.rlike(ISO_TEXT), F.unix_millis(F.try_to_timestamp(canonical)))


def _as_whole_ms(fv: Column, kind: Column, text: Column) -> tuple[Column, Column]:
    """int(x): numbers truncate, whole-number text; nothing else, no range."""
    whole = (kind == "STRING") & text.rlike(INT_TEXT)
    ms = (F.when(kind.isin(*_INT_KINDS), F.try_variant_get(fv, "$", "bigint"))
          .when(_numeric(kind), F.try_variant_get(fv, "$", "double").try_cast("bigint"))
          .when(kind == "BOOLEAN", F.when(text == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
          .when(whole, F.regexp_replace(text, r"\s|_", "").try_cast("bigint")))
    err = F.when(ms.isNull(), F.when((kind == "STRING") | _numeric(kind), F.lit(TIME_PARSE)).otherwise(F.lit(TIME_TYPE)))
    return ms, err


def _as_epoch_ms(fv: Column, kind: Column, text: Column) -> tuple[Column, Column]:
    """Timestamp rule: (epoch ms or NULL, error code or NULL).

    Integers are ms, fractional numbers truncate to ms, digit strings are ms,
    other text is parsed as ISO-8601 (naive = UTC); arrays/objects are the
    wrong type.
    """
    digits = (kind == "STRING") & text.rlike(r"^[0-9]+\z")
    ms = (F.when(kind.isin(*_INT_KINDS), F.try_variant_get(fv, "$", "bigint"))
          .when(_numeric(kind), F.try_variant_get(fv, "$", "double").try_cast("bigint"))
          .when(kind == "BOOLEAN", F.when(text == "true", F.lit(1)).otherwise(F.lit(0)).cast("bigint"))
          .when(digits, text.try_cast("bigint"))
          .when(kind == "STRING", iso_millis(text)))
    # a number too large for 64-bit ms is a valid number far out of range
    err = (F.when(_numeric(kind) | (kind == "BOOLEAN") | digits,
                  F.when(ms.isNull(), F.lit(TIME_RANGE)))
           .when(kind == "STRING", F.when(ms.isNull(), F.lit(TIME_PARSE)))
           .otherwise(F.lit(TIME_TYPE)))
    return ms, err


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(str(as_of)).cast("timestamp")


def parse_json_text(text: Column) -> Column:
    """Raw text -> VARIANT; bare NaN/Infinity (accepted by Python's json) are
    quoted first, so they reach the number rules instead of failing the parse."""
    quoted = F.regexp_replace(text, r"([:\[,]\s*)(-?Infinity|NaN)(\s*[,}\]])", '$1"$2"$3')
    return F.coalesce(F.try_parse_json(text), F.try_parse_json(quoted))


def _fence(df: DataFrame, cols: dict) -> DataFrame:
    """Add columns through a one-row-per-row ``inline``: the optimizer keeps
    them as computed values instead of copying their (large) defining
    expressions into every later reference or pushed-down filter, which
    would multiply the plan size with each nested rule."""
    packed = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select(*df.columns, F.inline(F.array(packed)))


def _codes(*rules: Column) -> Column:
    """Non-null codes in order as an array, without a lambda (so the whole
    projection keeps whole-stage codegen): concat_ws skips NULLs."""
    joined = F.concat_ws(";", *rules)
    return F.when(joined == "", F.array().cast("array<string>")).otherwise(F.split(joined, ";"))


def _symbol(mode: str, ok: Column, value: Column, text: Column) -> Column:
    """Upper case for a symbol that passed; strict mode turns any value into text."""
    if mode == "strict":
        return F.when(F.is_variant_null(value), F.lit("None")).otherwise(text)
    if mode == "types":
        return text
    return F.when(ok, F.upper(F.trim(text))).otherwise(text)


_FIELDS = ("event_id",) + REQUIRED_FIELDS


def validate(raw: DataFrame, value_col: str = "value", as_of=None, mode: str = "lenient",
             reject_nan_volume: bool = True) -> DataFrame:
    """Validate raw JSON trade messages in one pass.

    Adds ``errors ARRAY<STRING>``, ``is_valid BOOLEAN`` and ``norm``: the
    normalized event_id, symbol, price, volume and timestamp, the message's
    ``conditions`` and ``processed_at``, and all other fields as ``extra`` (a
    map of name to text, JSON for nested values).

    ``mode="lenient"`` rules, in order: missing_<field> (absent, null or blank;
    stops the other rules), symbol_invalid, price_not_number_or_invalid /
    price_not_positive (NaN is not positive), volume_not_number_or_invalid /
    volume_negative / volume_nan (unless ``reject_nan_volume=False``),
    timestamp_invalid_type / timestamp_parse_failed / timestamp_out_of_range
    ([as_of - 1 day, as_of + 5 minutes]), event_id_empty (present but null or
    blank).  ``mode="strict"`` is the second validator, a rule set of its own:
    the four fields are present (missing_<field> only when absent), price and
    volume are numbers above zero, the timestamp is a whole number; symbol, time
    range and id are not judged.  ``mode="types"`` is what the ingest job needs
    behind a producer that has validated: the lenient rules for missing fields
    and types (a NaN is no number), nothing about symbols, ranges or ids.

    Text that is not a JSON object gets ``message_not_json``; so does an object
    that repeats a key, since which of its values was meant is unknown.

    The message is parsed once; each field is extracted once into a column
    (value, JSON type, text) and every rule reads those columns.
    """
    if mode not in ("lenient", "strict", "types"):
        raise ValueError(f"unknown mode {mode!r}")
    keep = raw.columns
    df = _fence(raw, {"_v": parse_json_text(F.col(value_col).cast("string"))})
    df = df.withColumns({f"_{f}_v": _get(F.col("_v"), f) for f in _FIELDS})
    df = df.withColumns({**{f"_{f}_k": F.schema_of_variant(F.col(f"_{f}_v")) for f in _FIELDS},
                         **{f"_{f}_t": F.try_variant_get(F.col(f"_{f}_v"), "$", "string") for f in _FIELDS}})
    fv = {f: F.col(f"_{f}_v") for f in _FIELDS}
    kind = {f: F.col(f"_{f}_k") for f in _FIELDS}
    text = {f: F.col(f"_{f}_t") for f in _FIELDS}
    now = _as_of(as_of)

    df = df.withColumns({
        "_price": _as_float(fv["price"], kind["price"], text["price"]),
        "_volume": _as_float(fv["volume"], kind["volume"], text["volume"]),
        "_sym_ok": (kind["symbol"] == "STRING") & text["symbol"].rlike(SYMBOL_PATTERN),
    })
    strict = mode == "strict"
    read_time = _as_whole_ms if strict else _as_epoch_ms
    ts_ms, ts_err = read_time(fv["timestamp"], kind["timestamp"], text["timestamp"])
    df = df.withColumns({"_ts": ts_ms, "_ts_err": ts_err})
    price, volume, sym_ok = F.col("_price"), F.col("_volume"), F.col("_sym_ok")

    def absent(f: str) -> Column:
        if strict:
            return fv[f].isNull()
        return fv[f].isNull() | F.is_variant_null(fv[f]) | ((kind[f] == "STRING") & _blank(text[f]))
    missing = [F.when(absent(f), F.lit(MISSING + f)) for f in REQUIRED_FIELDS]
    price_rule = (F.when(price.isNull(), F.lit(PRICE_NOT_NUMBER))
                  .when(~(price > 0) | F.isnan(price), F.lit(PRICE_NOT_POSITIVE)))
    vol_number = F.when(volume.isNull(), F.lit(VOLUME_NOT_NUMBER))
    if strict:
        rules = [price_rule,
                 vol_number.when(~(volume > 0) | F.isnan(volume), F.lit(VOLUME_NOT_POSITIVE)),
                 F.col("_ts_err")]
    elif mode == "types":
        rules = [F.when(price.isNull() | F.isnan(price), F.lit(PRICE_NOT_NUMBER)),
                 vol_number.when(F.isnan(volume), F.lit(VOLUME_NAN)), F.col("_ts_err")]
    else:
        lo = F.unix_millis(now - F.expr(f"INTERVAL {MAX_PAST}"))
        hi = F.unix_millis(now + F.expr(f"INTERVAL {MAX_FUTURE}"))
        eid_empty = fv["event_id"].isNotNull() & (F.is_variant_null(fv["event_id"]) | (
            (kind["event_id"] == "STRING") & _blank(text["event_id"])))
        vol_rule = vol_number.when(volume < 0, F.lit(VOLUME_NEGATIVE))
        if reject_nan_volume:
            vol_rule = vol_rule.when(F.isnan(volume), F.lit(VOLUME_NAN))
        rules = [F.when(~sym_ok, F.lit(SYMBOL_INVALID)), price_rule, vol_rule,
                 F.coalesce(F.col("_ts_err"),
                            F.when((F.col("_ts") < lo) | (F.col("_ts") > hi), F.lit(TIME_RANGE))),
                 F.when(eid_empty, F.lit(EVENT_ID_EMPTY))]
    any_missing = F.greatest(*[F.when(m.isNotNull(), F.lit(1)).otherwise(F.lit(0)) for m in missing]) > 0
    errors = (F.when(F.col("_v").isNull(), F.array(F.lit(NOT_JSON)))
              .when(any_missing, _codes(*missing))
              .otherwise(_codes(*rules)))
    norm = F.struct(
        text["event_id"].alias("event_id"),
        _symbol(mode, sym_ok, fv["symbol"], text["symbol"]).alias("symbol"),
        price.alias("price"),
        volume.alias("volume"),
        F.col("_ts").alias("timestamp"),
        F.try_variant_get("_v", F.lit("$.conditions"), "array<string>").alias("conditions"),
        F.try_variant_get("_v", F.lit("$.processed_at"), "bigint").alias("processed_at"),
        F.map_filter(F.try_variant_get("_v", F.lit("$"), "map<string,string>"),
                     lambda k, _: ~k.isin(*_FIELDS, "conditions", "processed_at")).alias("extra"),
    )
    # Only the verdict is fenced: ``norm`` stays a plain projection, so a read of the errors does
    # not build it, and a filter on the verdict comes first.
    out = _fence(df.select(*keep, "_v", "_price", "_volume", "_sym_ok", "_ts", "_ts_err",
                           *[f"_{f}_{x}" for f in _FIELDS for x in "vkt"]), {"errors": errors})
    return out.select(*keep, "errors", norm.alias("norm")).withColumn("is_valid", F.size("errors") == 0)


def valid_trades(validated: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """D9 (main path): valid rows as typed trade columns with event_time; all
    fields of the message stay, and an absent event id is derived from the
    trade's content (P3).  ``carry`` names extra columns to keep."""
    broker = [c for c in ("kafka_timestamp", "topic", "partition", "offset") if c in validated.columns]
    return (fill_event_id(validated.filter("is_valid").select("norm.*", *broker, *carry))
            .withColumn("event_time", F.timestamp_millis("timestamp")))


def invalid_rows(validated: DataFrame) -> DataFrame:
    """D9 (dead-letter path): rows with at least one error."""
    return validated.filter(~F.col("is_valid"))


def dlq_records(invalid: DataFrame, source_topic: str = "market", value_col: str = "value",
                failed_at: Column | None = None, processor_id: str = "tickyard",
                carry: Sequence[str] = ()) -> DataFrame:
    """Dead-letter records with both the compact and the full schema.

    ``original``/``errors``/``dlq_timestamp``/``source_topic`` plus
    ``error_reasons`` (';'-joined), ``error_type`` (PARSING_ERROR for
    non-JSON input, else VALIDATION_ERROR), ``error_stacktrace`` (NULL: rules
    do not throw), ``failed_at``, ``retry_count`` and ``processor_id``.  Broker
    columns (topic, partition, offset, key) fill the ``original_*`` fields when
    present; ``carry`` names extra columns to keep.
    """
    stamp = F.unix_millis(F.current_timestamp()) if failed_at is None else failed_at
    cols = set(invalid.columns)
    opt = lambda c, t: (F.col(c).cast(t) if c in cols else F.lit(None).cast(t))
    etype = F.when(F.array_contains("errors", NOT_JSON), F.lit(DLQ_ERROR_TYPES[1])) \
             .otherwise(F.lit(DLQ_ERROR_TYPES[0]))
    return invalid.select(
        *carry,
        F.col(value_col).cast("string").alias("original"),
        "errors",
        F.array_join("errors", ";").alias("error_reasons"),
        stamp.alias("dlq_timestamp"),
        F.lit(source_topic).alias("source_topic"),
        F.coalesce(opt("topic", "string"), F.lit(source_topic)).alias("original_topic"),
        opt("partition", "int").alias("original_partition"),
        opt("offset", "bigint").alias("original_offset"),
        opt("key", "string").alias("original_key"),
        F.col(value_col).cast("string").alias("original_value"),
        F.array_join("errors", ";").alias("error_message"),
        etype.alias("error_type"),
        F.lit(None).cast("string").alias("error_stacktrace"),
        stamp.alias("failed_at"),
        F.lit(0).alias("retry_count"),
        F.lit(processor_id).alias("processor_id"),
    )


def write_routed(validated: DataFrame, main_path: str, dlq_path: str, source_topic: str = "market",
                 fmt: str = "parquet", batch_id: int | None = None, job: str | None = None) -> dict:
    """Valid rows to the main sink, rejected rows to the dead-letter sink,
    from one evaluation of the rule pass (persisted for the two writes, with
    disk spill; released afterwards).  With ``batch_id`` each sink has a folder
    per batch that a repeated batch overwrites, so a retry doubles nothing;
    ``job`` names the query that the batch number belongs to, since a job
    started anew counts from 0 again.  Without ``batch_id`` rows are appended.  Returns the two row counts, taken as side
    effects of the writes."""
    from pyspark import StorageLevel
    from pyspark.sql import Observation
    v = validated.persist(StorageLevel.MEMORY_AND_DISK)

    def save(df: DataFrame, path: str) -> None:
        if batch_id is None:
            df.write.mode("append").format(fmt).save(path)
        else:
            of = f"/job={job}" if job else ""
            df.write.mode("overwrite").format(fmt).save(f"{path.rstrip('/')}{of}/batch_id={batch_id}")
    try:
        ok, bad = Observation(), Observation()
        save(valid_trades(v).observe(ok, F.count(F.lit(1)).alias("n")), main_path)
        save(dlq_records(invalid_rows(v), source_topic=source_topic).observe(bad, F.count(F.lit(1)).alias("n")),
             dlq_path)
        return {"main": ok.get["n"], "dlq": bad.get["n"]}
    finally:
        v.unpersist()


def rejection_counts(validated: DataFrame) -> DataFrame:
    """Errors per reason (a message with two errors adds one to each).

    The separate dead-letter message counter is ``invalid_rows(...).count()``
    or ``bars.row_count``.  Partial aggregation keeps a hot reason map-side.
    """
    return (validated.filter(~F.col("is_valid"))
            .select(F.explode("errors").alias("reason"))
            .groupBy("reason")
            .agg(F.count(F.lit(1)).alias("n_errors")))


def rejection_totals(validated: DataFrame) -> DataFrame:
    """The message counters next to the per-reason error counter: all
    messages, rejected (dead-lettered) messages and errors, in one pass."""
    bad = ~F.col("is_valid")
    return validated.agg(F.count(F.lit(1)).alias("n_messages"),
                         F.count_if(bad).alias("n_rejected"),
                         F.sum(F.size("errors")).cast("bigint").alias("n_errors"))


def filter_outliers(df: DataFrame, price_col: str = "price", std_dev: float = 3.0) -> DataFrame:
    """Keep rows within mean +- k * sample stddev (inclusive), global stats.

    The two statistics come from a scalar subquery over the same frame, so
    there is no join and nothing is collected by hand; a NULL stddev (fewer
    than two rows) leaves the frame unchanged.  Batch only (or inside
    ``foreachBatch``): a stream cannot compute a global aggregate eagerly.
    """
    stats = df.agg(F.struct(F.avg(price_col).alias("m"), F.stddev_samp(price_col).alias("s")).alias("st"))
    st = stats.scalar()  # one scalar subquery; its repeated uses are reused, not re-run
    m, s = st.getField("m"), st.getField("s")
    p = F.col(price_col)
    return df.filter(s.isNull() | p.between(m - F.lit(std_dev) * s, m + F.lit(std_dev) * s))
