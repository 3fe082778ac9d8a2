"""Dead letters judged again: every message is in one place, whatever crashes."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tickyard.functions import quality as Q
from tickyard.operators import redrive as RD
from tickyard.session import fresh_dir

GOOD = '{"symbol":"%s","price":%s,"volume":1,"timestamp":1}'
ROWS = [("t", 0, 1, "k", GOOD % ("A", 1)), ("t", 0, 2, "k", GOOD % ("B", '"2d"')), ("t", 0, 3, None, GOOD % ("C", -1)),
        ("t", 1, 1, "k", "{"), ("t", 1, 2, "k", None), ("t", None, None, "k", GOOD % ("D", '"4d"')),
        ("t", None, None, "k", GOOD % ("D", '"4d"')), ("t", None, None, None, ""), ("t", 0, 2, "k", GOOD % ("B", '"2d"'))]
SCHEMA = "topic string, partition int, offset bigint, key string, value string"


def unit_off(text):
    return F.regexp_replace(text, r'"([0-9]+)d"', "$1")


@pytest.fixture
def routed(spark):
    main, dlq = fresh_dir(spark, "test-main"), fresh_dir(spark, "test-dlq")
    Q.write_routed(Q.validate(spark.createDataFrame(ROWS, SCHEMA), mode="types"), main, dlq, batch_id=0, job="feed")
    return main, dlq


def places(spark, routed, most=2):
    return Counter(r.place for r in RD.letter_places(spark, *routed, most).select("place").collect())


def trades(spark, main):
    return sorted((r.symbol, r.price) for r in spark.read.parquet(main).select("symbol", "price").collect())


def test_attempts_are_counted_and_accepted_messages_move_once(spark, routed):
    assert places(spark, routed) == {"waiting": 5}      # a repeated position and a repeated text are one message each
    before = len(trades(spark, routed[0]))
    assert RD.redrive(spark, *routed, mode="types", max_retries=2, repair=unit_off, run=1) == {"recovered": 2, "failed": 3}
    assert places(spark, routed) == {"recovered": 2, "waiting": 3}
    assert RD.redrive(spark, *routed, mode="types", max_retries=2, repair=unit_off, run=2) == {"recovered": 0, "failed": 3}
    assert places(spark, routed) == {"recovered": 2, "parked": 3}
    assert RD.redrive(spark, *routed, mode="types", max_retries=2, repair=unit_off) == {"recovered": 0, "failed": 0}
    got = trades(spark, routed[0])
    assert len(got) == before + 2 and got.count(("B", 2.0)) == 1 and got.count(("D", 4.0)) == 1
    last = RD.letter_places(spark, *routed, 2).filter("place = 'recovered'").collect()
    assert all("d" in r.original_value and r.retry_count == 0 for r in last)


def test_crash_between_the_writes(spark, routed, monkeypatch):
    def fail(*a, **k):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(RD, "dlq_records", fail)
        with pytest.raises(RuntimeError):
            RD.redrive(spark, *routed, mode="types", max_retries=2, repair=unit_off, run=1)
    moved = trades(spark, routed[0])
    assert places(spark, routed) == {"recovered": 2, "waiting": 3}
    assert RD.redrive(spark, *routed, mode="types", max_retries=2, repair=unit_off, run=1) == {"recovered": 0, "failed": 3}
    assert trades(spark, routed[0]) == moved and places(spark, routed) == {"recovered": 2, "waiting": 3}


def test_letters_keep_the_message_as_received(spark, routed):
    RD.redrive(spark, *routed, mode="types", repair=lambda t: F.concat(t, F.lit("?")), run=1)
    rows = RD.letter_places(spark, *routed).collect()
    assert len(rows) == 5 and all(r.retry_count == 1 and r.place == "waiting" for r in rows)
    assert not any("?" in (r.original_value or "") for r in rows)
    assert {r.original_topic for r in rows} == {"t"}


def test_no_letters(spark):
    main, dlq = fresh_dir(spark, "test-main"), fresh_dir(spark, "test-dlq")
    Q.write_routed(Q.validate(spark.createDataFrame(ROWS[:1], SCHEMA), mode="types"), main, dlq, batch_id=0, job="feed")
    assert RD.redrive(spark, main, dlq, mode="types") == {"recovered": 0, "failed": 0}
    assert places(spark, (main, dlq)) == {}
