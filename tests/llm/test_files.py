import base64
import hashlib
import io
import random
import zipfile
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from tickyard.llm import token_files as T, warc_zip as Z

PATH = public_tokenizers.path("byte_bpe_50k.json")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 300), st.integers(0, 2**32 - 1)), min_size=1, max_size=500))
def test_block_round_trip(values):
    values = np.array(values, np.uint32)
    assert T.unpack_block(T.pack_block(values)).tolist() == values.tolist()


def test_outliers_are_patched():
    values = np.full(T.BLOCK, 1000, np.uint32)
    values[::100] = 4_000_000_000
    values[5] = 999
    assert len(T.pack_block(values)) < T.BLOCK and T.unpack_block(T.pack_block(values)).tolist() == values.tolist()


def test_any_range_of_a_file():
    ids = np.random.default_rng(0).integers(0, 50_000, 3 * T.BLOCK + 17).astype(np.uint32)
    f = T.TokenFile(T.pack_file([7, None], np.array([5, len(ids)]), ids, 3, 1) + b"\n")
    for a, b in ((0, len(ids)), (0, 0), (4090, 4100), (T.BLOCK, 2 * T.BLOCK), (len(ids) - 1, len(ids))):
        assert f.ids(a, b).tolist() == ids[a:b].tolist()
    assert [(d, s, len(x)) for d, s, x in f.documents()] == [(7, 0, 5), (None, 5, len(ids) - 5)] and (f.part, f.number) == (3, 1)
    with pytest.raises(ValueError):
        T.TokenFile(b"PFOR0001 cut off")


@pytest.mark.parametrize("file_ids", [50, 8_000_000])
def test_files_of_a_table(spark, docs, tmp_path, file_ids):
    tok = Tokenizer.from_file(PATH)
    T.write_tokens(docs, str(tmp_path / "t"), PATH, 2, file_ids=file_ids)
    rows = T.with_starts(T.read_tokens(spark, str(tmp_path / "t"))).orderBy("start").collect()
    encoded = {(r.doc_id, r.text): tok.encode(r.text or "", add_special_tokens=False).ids + [2] for r in docs.collect()}
    assert [r.doc_id for r in rows] == sorted([r.doc_id for r in docs.collect()], key=lambda d: (d is not None, d or 0))
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens
    crc = lambda x: zlib.crc32(np.array(x, "<u4").tobytes())
    want = sorted((d is not None, d or 0, len(x), crc(x)) for d, x in
                  [(r.doc_id, encoded[(r.doc_id, r.text)]) for r in docs.collect()])
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.n_tokens, r.ids_crc32) for r in rows) == want


def test_no_documents(spark, no_docs, tmp_path):
    T.write_tokens(no_docs, str(tmp_path / "t"), PATH, 2)
    assert T.with_starts(T.read_tokens(spark, str(tmp_path / "t"))).collect() == []


@pytest.mark.parametrize("force64", [False, True])
def test_zip_members(force64):
    members = [("a.txt", b"hello"), ("dir/é.bin", bytes(range(256)) * 20), ("empty", b"")]
    data = Z.zip_stored(members, force64) + b"\n"
    read = lambda at, n: data[at:at + n]
    found = Z.zip_members(read, len(data))
    assert {k: read(*v) for k, v in found.items()} == dict(members)
    with zipfile.ZipFile(io.BytesIO(data)) as z:
        assert z.testzip() is None and {n: z.read(n) for n in z.namelist()} == dict(members) and z.comment == b"\n"


def test_archives_of_the_zipfile_module():
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        z.writestr(zipfile.ZipInfo("stored"), b"x" * 1000)
        z.writestr("packed", b"y" * 1000, zipfile.ZIP_DEFLATED)
        with z.open(zipfile.ZipInfo("large"), "w", force_zip64=True) as f:
            f.write(b"z" * 10)
        z.comment = b"PK\x05 a comment"
    data = out.getvalue()
    found = Z.zip_members(lambda at, n: data[at:at + n], len(data))
    assert sorted(found) == ["large", "stored"] and data[slice(found["large"][0], sum(found["large"]))] == b"z" * 10
    with pytest.raises(ValueError):
        Z.zip_members(lambda at, n: data[:100][at:at + n], 100)


PAGES = [(1, "http://a/", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://é/ \r\nX: y", "<p>x</p>"), (4, "u", None), (5, "u", ""),
         (6, "u", "é\r\n\r\n" * 500), (None, "u", "<p>x</p>"), (None, None, "only here"), (7, "u", "seven"), (7, "u", "seven")]


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(*p, "clash") for p in PAGES], "page_id bigint, url string, html string, payload string")
    for size in (1, 16 << 20):
        path = str(tmp_path / f"w{size}")
        Z.write_archives(pages, path, archive_bytes=size)
        rows = Z.read_archives(spark, path).collect()
        last = {}
        for i, _, h in PAGES:
            last[h or ""] = max((x for x in (last.get(h or ""), i) if x is not None), default=None)
        want = []
        for i, _, h in PAGES:
            p = (h or "").encode()
            main = i == last[h or ""]
            want.append((i is None, i or 0, len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(),
                         "response" if main else "revisit", None if main else last[h or ""], p if main else None))
        got = [(r.page_id is None, r.page_id or 0, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to,
                None if r.payload is None else bytes(r.payload)) for r in rows]
        assert sorted(got, key=str) == sorted(want, key=str)


def test_ranges_and_whole_files_read_alike(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id bigint, url string, html string")
    Z.write_archives(pages, str(tmp_path / "w"))
    for f in (tmp_path / "w").glob("part-*"):
        data, touched = f.read_bytes(), []

        def read(at, n, data=data, touched=touched):
            touched.append(n)
            return data[at:at + n]
        every = list(Z.records_of(read, len(data)))
        some = list(Z.records_of(read, len(data), wanted=lambda i: i == 6))
        assert some == [x for x in every if x[0]["warc-record-id"] == "<urn:page:6>"]


def test_archives_are_read_in_many_tasks(spark, tmp_path):
    pages = spark.range(32).selectExpr("id AS page_id", "'u' AS url", "repeat(cast(id AS string), 100) AS html").repartition(32)
    Z.write_archives(pages, str(tmp_path / "w"), archive_bytes=1)
    archives = len(list((tmp_path / "w").glob("part-*")))
    rows = Z.read_archives(spark, str(tmp_path / "w")).withColumn("task", F.spark_partition_id())
    assert rows.count() == 32 and rows.select("task").distinct().count() >= archives / 8 >= 2


def test_no_pages(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id bigint, url string, html string")
    Z.write_archives(pages, str(tmp_path / "w"))
    assert Z.read_archives(spark, str(tmp_path / "w")).collect() == []


def test_digest_is_checked(spark, tmp_path):
    bad = Z.warc_record(1, "u", b"x", "A" * 32, None, False)
    with pytest.raises(ValueError):
        list(Z._rows(iter([Z.parse_record(bad)])))
    r = random.Random(0)
    payload = bytes(r.randrange(256) for _ in range(1000))
    headers, http, body = Z.parse_record(Z.warc_record(1, "u", payload, "d", None, False))
    assert body == payload and http["content-length"] == "1000" and headers["warc-type"] == "response"
