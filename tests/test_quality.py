"""Validation rules on hand-written messages, one per error code."""

import json

import pytest

from tickyard.functions import quality as Q

AS_OF = "2024-01-31 00:00:00"
NOW_MS = 1706659200000  # 2024-01-31 00:00:00 UTC
H = 3600 * 1000


def msg(**kw):
    base = {"symbol": "AAPL", "price": 150.5, "volume": 10, "timestamp": NOW_MS - H}
    for k, v in kw.items():
        if v is _DROP:
            base.pop(k, None)
        else:
            base[k] = v
    return json.dumps(base)


_DROP = object()

CASES = [
    ("valid", msg(), []),
    ("string numbers", msg(price="150.5", volume="10", timestamp=str(NOW_MS - H)), []),
    ("missing volume and timestamp", msg(volume=_DROP, timestamp=_DROP),
     ["missing_volume", "missing_timestamp"]),
    ("blank symbol", msg(symbol="   "), ["missing_symbol"]),
    ("null price", msg(price=None), ["missing_price"]),
    ("lower case symbol", msg(symbol="aapl"), ["symbol_invalid"]),
    ("symbol with newline", msg(symbol="AAPL\n"), ["symbol_invalid"]),
    ("33 character symbol", msg(symbol="A" * 33), ["symbol_invalid"]),
    ("exchange prefix symbol", msg(symbol="BINANCE:BTCUSDT"), []),
    ("price abc", msg(price="abc"), ["price_not_number_or_invalid"]),
    ("price NaN text", msg(price="NaN"), ["price_not_positive"]),
    ("price underscore", msg(price="1_000"), []),
    ("price java suffix", msg(price="150d"), ["price_not_number_or_invalid"]),
    ("price negative", msg(price=-1), ["price_not_positive"]),
    ("price zero", msg(price=0), ["price_not_positive"]),
    ("volume negative", msg(volume=-1), ["volume_negative"]),
    ("volume zero", msg(volume=0), []),
    ("volume NaN text", msg(volume="NaN"), ["volume_nan"]),
    ("timestamp x", msg(timestamp="x"), ["timestamp_parse_failed"]),
    ("timestamp list", msg(timestamp=[1]), ["timestamp_invalid_type"]),
    ("timestamp ISO naive", msg(timestamp="2024-01-30T12:00:00"), []),
    ("timestamp ISO offset", msg(timestamp="2024-01-30T12:00:00+02:00"), []),
    ("timestamp digits", msg(timestamp=str(NOW_MS)), []),
    ("timestamp huge number", msg(timestamp=1e30), ["timestamp_out_of_range"]),
    ("timestamp huge digits", msg(timestamp="9" * 30), ["timestamp_out_of_range"]),
    ("timestamp float", msg(timestamp=NOW_MS - 0.5), []),
    ("timestamp 25h old", msg(timestamp=NOW_MS - 25 * H), ["timestamp_out_of_range"]),
    ("timestamp 6min ahead", msg(timestamp=NOW_MS + 6 * 60 * 1000), ["timestamp_out_of_range"]),
    ("event id absent", msg(), []),
    ("event id null", msg(event_id=None), ["event_id_empty"]),
    ("event id blank", msg(event_id=" "), ["event_id_empty"]),
    ("event id number", msg(event_id=7), []),
    ("several errors", msg(symbol="aapl", price=-2, volume=-1),
     ["symbol_invalid", "price_not_positive", "volume_negative"]),
    ("malformed json", '{"symbol": "AAPL", ', ["message_not_json"]),
    ("empty message", "", ["message_not_json"]),
    ("bare NaN price", '{"symbol":"AAPL","price":NaN,"volume":1,"timestamp":%d}' % (NOW_MS - H),
     ["price_not_positive"]),
]


@pytest.fixture(scope="module")
def validated(spark):
    rows = [(i, c[1]) for i, c in enumerate(CASES)]
    df = spark.createDataFrame(rows, "i int, value string")
    return {r.i: r for r in Q.validate(df, as_of=AS_OF).collect()}


@pytest.mark.parametrize("i", range(len(CASES)), ids=[c[0] for c in CASES])
def test_rule(validated, i):
    r = validated[i]
    assert list(r.errors) == CASES[i][2]
    assert r.is_valid == (not CASES[i][2])


def test_normalized_values(validated):
    r = validated[1].norm
    assert (r.symbol, r.price, r.volume, r.timestamp) == ("AAPL", 150.5, 10.0, NOW_MS - H)
    assert validated[11].norm.price == 1000.0
    by_name = {c[0]: validated[i] for i, c in enumerate(CASES)}
    assert by_name["timestamp ISO offset"].norm.timestamp == NOW_MS - 12 * H - 2 * H
    assert by_name["timestamp float"].norm.timestamp == NOW_MS - 1


def test_strict_mode_rejects_zero_volume(spark):
    df = spark.createDataFrame([(msg(volume=0),), (msg(),)], "value string")
    got = [list(r.errors) for r in Q.validate(df, as_of=AS_OF, mode="strict").collect()]
    assert got == [["volume_not_positive"], []]


def test_batch_keeps_order(spark):
    rows = [(0, msg(symbol="AAPL")), (1, msg(symbol="GOOGL", price=-10)), (2, msg(symbol="MSFT"))]
    df = spark.createDataFrame(rows, "i int, value string")
    good = Q.valid_trades(Q.validate(df, as_of=AS_OF)).orderBy("timestamp", "symbol")
    assert [r.symbol for r in good.collect()] == ["AAPL", "MSFT"]


def test_dlq_and_counts(spark):
    df = spark.createDataFrame([(c[1],) for c in CASES], "value string")
    v = Q.validate(df, as_of=AS_OF)
    dlq = Q.dlq_records(Q.invalid_rows(v)).collect()
    n_bad = sum(1 for c in CASES if c[2])
    assert len(dlq) == n_bad
    types = {r.error_type for r in dlq}
    assert types == {"VALIDATION_ERROR", "PARSING_ERROR"}
    counts = {r.reason: r.n_errors for r in Q.rejection_counts(v).collect()}
    assert sum(counts.values()) == sum(len(c[2]) for c in CASES)


def test_outlier_filter_keeps_inside(spark):
    vals = [(float(x),) for x in [10, 11, 9, 10, 10, 11, 9, 10, 10, 1000]]
    df = spark.createDataFrame(vals, "price double")
    kept = [r.price for r in Q.filter_outliers(df, "price", 2.0).collect()]
    assert 1000.0 not in kept and len(kept) == 9
    one = spark.createDataFrame([(5.0,)], "price double")
    assert Q.filter_outliers(one).count() == 1


def test_write_routed_splits_once(spark):
    from tickyard.session import fresh_dir
    df = spark.createDataFrame([(c[1],) for c in CASES], "value string")
    main, dlq = fresh_dir(spark, "test-main"), fresh_dir(spark, "test-dlq")
    out = Q.write_routed(Q.validate(df, as_of=AS_OF), main, dlq)
    n_bad = sum(1 for c in CASES if c[2])
    assert out == {"main": len(CASES) - n_bad, "dlq": n_bad}
    assert spark.read.parquet(main).count() == len(CASES) - n_bad
    assert spark.read.parquet(dlq).filter("error_reasons <> ''").count() == n_bad
