"""Property test: fields are drawn together with the code that they must give."""

import json

from hypothesis import HealthCheck, Phase, given, settings, strategies as st

from tickyard.functions import quality as Q

AS_OF = "2024-01-31 00:00:00"
NOW = 1706659200000
DAY = 86_400_000
ABSENT = object()


def gives(code, values):
    return values.map(lambda v: (v, code))


blank = st.sampled_from(["", " ", "\t\n"])
gone = st.one_of(st.just(ABSENT), st.none(), blank)
padded = lambda s: st.builds(lambda a, t, b: a + t + b, st.sampled_from(["", " "]), s, st.sampled_from(["", "\n"]))
above = st.one_of(st.floats(1e-3, 1e6), st.integers(1, 10**6), st.just(True), padded(st.sampled_from(
    ["1_000", "1e3", ".5", "5.", "+7", "inf", "0012"])))
zero = st.sampled_from([0, 0.0, "0", "-0", False])
below = st.one_of(st.floats(-1e6, -1e-3), st.integers(-10**6, -1), st.sampled_from(["-1", "-Infinity"]))
no_number = st.sampled_from(["abc", "150d", "1__0", "_1", "0x10", "1,5", [1], {}])
price = st.one_of(gives("missing_price", gone), gives("", above), gives("price_not_positive", st.one_of(
    zero, below, st.sampled_from(["NaN", "nan"]))), gives("price_not_number_or_invalid", no_number))
volume = st.one_of(gives("missing_volume", gone), gives("", st.one_of(above, zero)), gives("volume_negative", below),
                   gives("volume_nan", st.sampled_from(["NaN", " nan"])), gives("volume_not_number_or_invalid", no_number))
symbol = st.one_of(gives("missing_symbol", gone), gives("", st.from_regex(r"[A-Z0-9.\-:/]{1,32}", fullmatch=True)),
                   gives("symbol_invalid", st.sampled_from(["aapl", "AAPL\n", " A", "A B", "A" * 33, "A_B", 7, [1]])))
near = st.integers(NOW - DAY, NOW + 300_000)
far = st.one_of(st.integers(NOW - 2 * DAY, NOW - DAY - 1), st.integers(NOW + 300_001, NOW + DAY),
                st.sampled_from([0, True, 10**30, -10**25, "9" * 25, 1e30]))
iso = st.sampled_from(["2024-01-30T12:00:00", "2024-01-30 12:00", "20240130T120000Z", "2024-01-30T12:00:00.5+02:00",
                       "2024-01-30T23:30-0100", "2024-01-31"])
old_iso = st.sampled_from(["2023-12-31", "2024-01-29T23:59:59", "2024-01-31T01:00+00:30"])
no_time = st.sampled_from(["x", "03:40", "T03:40:00", "2024-1-30", "2024-01-30 UTC", " 2024-01-30", "2024-02-30",
                           "2024-01-30T25:00", "30.01.2024"])
timestamp = st.one_of(gives("missing_timestamp", gone), gives("", st.one_of(near, near.map(str), iso)),
                      gives("timestamp_out_of_range", st.one_of(far, old_iso)), gives("timestamp_parse_failed", no_time),
                      gives("timestamp_invalid_type", st.sampled_from([[1], {}])))
event_id = st.one_of(gives("", st.sampled_from([ABSENT, "x", 7, "a b"])), gives("event_id_empty", st.one_of(st.none(), blank)))
FIELDS = {"symbol": symbol, "price": price, "volume": volume, "timestamp": timestamp, "event_id": event_id}


@settings(max_examples=6, deadline=None, phases=[Phase.explicit, Phase.generate], suppress_health_check=[HealthCheck.too_slow, HealthCheck.function_scoped_fixture])
@given(st.lists(st.fixed_dictionaries(FIELDS), min_size=40, max_size=80))
def test_codes_of_drawn_fields(spark, drawn):
    rows, want = [], []
    for i, rec in enumerate(drawn):
        rows.append((i, json.dumps({f: v for f, (v, _) in rec.items() if v is not ABSENT})))
        codes = [c for _, c in (rec[f] for f in FIELDS) if c]      # the order of the rules, not of the drawn record
        want.append([c for c in codes if c.startswith("missing_")] or codes)
    df = spark.createDataFrame(rows, "i int, value string")
    got = {r.i: list(r.errors) for r in Q.validate(df, as_of=AS_OF).collect()}
    for i, codes in enumerate(want):
        assert got[i] == codes, (rows[i], got[i])
