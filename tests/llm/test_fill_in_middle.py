import hashlib
import random
import re
import tracemalloc

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tickyard.llm import fill_in_middle as M

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string"


def expected(key, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    digest = hashlib.sha256(f"42:{'' if key is None else key}".encode()).hexdigest()
    h = [int(digest[i:i + 8], 16) for i in (0, 8, 16, 24)]
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 50:
        return (key, n, "plain", None, None, text)
    a, z = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:z]), "".join(units[z:])
    spm = h[3] % 100 < 80
    return (key, n, "spm" if spm else "psm", len(p), len(m),
            f"<S>{s}<P>{p}<M>{m}" if spm else f"<P>{p}<S>{s}<M>{m}")


def texts():
    r = random.Random(3)
    word = lambda: "".join(r.choices("abcdeéß日本🙂<>PSM", k=r.randint(1, 12)))
    shared = " ".join(word() for _ in range(400))
    out = [None, "", " ", " \n\t ", "one", " one", "one ", "a\x0bb\x0c c\r\n", "x" * 40_000, "é" * 9_001 + " end",
           " " * 20_000, "日本 " * 5_000, "has <P> inside", "almost <P", " wide spaces\xa0stay\x85in\x1cwords"]
    for _ in range(80):
        out.append("".join(word() + r.choice([" ", "  ", "\n", " \t "]) for _ in range(r.randint(1, 300))).strip(r.choice(["x", " "])))
    out += [word() + " " + shared + r.choice(["", " ", word()]) for _ in range(40)]
    return out


def test_against_the_plain_rule(spark):
    rows = [(i, t) for i, t in enumerate(texts())] + [(None, "a null key"), (7, "again"), (7, "again")]
    rows += [(1000 + i, t) for i, t in enumerate(texts())]      # copies under other keys
    clash = [(*r, "x", 1, True) for r in rows]
    df = spark.createDataFrame(clash, SCHEMA + ", output string, n int, form boolean").repartition(3)
    out = M.transform(df).withColumn("back", M.restored()).collect()
    assert sorted((tuple(r)[:6] for r in out), key=str) == sorted((expected(*r) for r in rows), key=str)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    assert sorted(r.back for r in out) == sorted(t or "" for _, t in rows)
    assert M.transform(df.filter("false")).collect() == []


def test_every_cut_of_a_text():
    memo, chunker = M.Memo(), M.Chunker()
    for t in texts():
        data = (t or "").encode()
        ends = chunker.ends(np.frombuffer(data, np.uint8), np.array([0, len(data)])).tolist() if data else []
        assert not data or ends[-1] == len(data) and max(np.diff([0, *ends])) <= M.LONGEST
        doc, units = M.Text(data, ends, memo), UNIT.findall(t or "")
        assert doc.n == len(units)
        for k in {0, 1, len(units) // 2, max(len(units) - 1, 0), len(units)}:
            head = "".join(units[:k])
            if k <= doc.n:
                assert doc.after(k) == (len(head.encode()), len(head))


def test_shared_passages_share_chunks():
    """A passage has the same chunks wherever it stands, and whatever else is in the buffer."""
    r = random.Random(5)
    passage = " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(2000)).encode()
    chunker = M.Chunker()

    def chunks(*datas):
        starts = np.cumsum([0, *map(len, datas)])
        ends = chunker.ends(np.frombuffer(b"".join(datas), np.uint8), starts).tolist()
        buffer, begin = b"".join(datas), [0, *ends]
        return [buffer[a:b] for a, b in zip(begin, ends, strict=False)]
    alone, moved, second = chunks(passage), chunks(b"another start " + passage), chunks(b"x" * 777, passage)
    assert len(alone) > 20 and len(set(alone) & set(moved)) >= len(alone) - 2
    assert second[-len(alone):] == alone
    memo = M.Memo()
    for part in (alone, moved):
        for c in part:
            memo.of(c)
    assert memo.hits >= len(alone) - 2
    small = M.Memo(limit=2_000)                              # a full memo starts anew and stays right
    assert [small.of(c) for c in alone * 2] == [M.summarize(c) for c in alone * 2]


def test_percentages(spark):
    df = spark.range(400).select(F.col("id").alias("doc_id"), F.lit("a few words in a row").alias("text"))
    forms = {r.form for r in M.transform(df, fim_percent=100, spm_percent=0).select("form").distinct().collect()}
    assert forms == {"psm"}
    assert M.transform(df, fim_percent=0).filter("form <> 'plain'").isEmpty()


class Rows:
    """Stands for a DataFrame and keeps the function that its batches go through."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        self.run = run
        return self

    def withColumnRenamed(self, old, new):
        return self


def peak(spark, texts):
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts)], ["key", "text"])
    run = M.transform(Rows()).run
    tracemalloc.start()
    try:
        n = sum(b.num_rows for b in run(iter([batch])))
        return n, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_memory_of_a_batch(spark):
    """The hash takes several times the bytes it is made of: neither many texts nor one long text are hashed at once."""
    text = " ".join(f"word{i}" for i in range(250))
    n, most = peak(spark, [text] * 4000)            # 8 MB
    assert n == 4000 and most < 20 << 20
    n, most = peak(spark, [text * 4000])            # 8 MB in one text
    assert n == 1 and most < 60 << 20


def test_blocks_of_a_long_text_have_the_ends_of_the_whole(monkeypatch):
    r = random.Random(9)
    data = np.frombuffer(" ".join(f"wört{r.randrange(10 ** 6)}" for _ in range(9000)).encode(), np.uint8)
    starts = np.array([0, 50_001, 50_020, len(data)])
    whole = M.Chunker().ends(data, starts)
    assert len(whole) > 100
    for block in (1, 31, 32, 1000, 65_536, len(data)):
        monkeypatch.setattr(M, "SLICE_BYTES", block)
        assert M.Chunker().ends(data, starts).tolist() == whole.tolist()


def test_restored_splits_a_row_once(spark):
    rows = [("<P>a<S>c<M>b", "psm"), ("<S>c<P>a<M>b", "spm"), ("<P>a<S>c<M>b", "plain"), ("<P>a", None), (None, "psm"),
            ("no marks", "psm"), ("<S><P><M>", "spm")]
    df = spark.createDataFrame(rows, "output string, form string").select(M.restored().alias("text"))
    assert [r.text for r in df.collect()] == ["abc", "abc", "<P>a<S>c<M>b", "<P>a", None, None, ""]
    assert df._jdf.queryExecution().optimizedPlan().toString().count("split(") == 1
