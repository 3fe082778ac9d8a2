import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline as P
from tickyard.llm import quality_classifier as C, quality_rules as R
from tickyard.sources.tables import table

from .test_decontaminate import brute as leaks
from .test_near_dedup import brute as components

SF = "/root/testdata/sf0.001"


def test_registered():
    names = entry.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(k.startswith(f"op{n}_") for k in names) == 1


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage returns, on its predecessor's rows."""
    docs, out = table(spark, SF, "documents"), []
    for name, stage in P.STAGES:
        docs = P.stored(stage(spark, docs, SF), f"test-{name}")
        out.append(docs)
    return out


def test_stages_against_brute_force(spark, stages):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    assert all(s.columns == columns for s in stages[:-1])
    rows = lambda df: {r.doc_id: r.text for r in df.collect()}
    kept = [rows(s) for s in stages[:-1]]
    verdict = {r.doc_id for r in R.rules(docs).filter("kept").collect()}
    assert set(kept[0]) == verdict
    weights = C.train(docs, table(spark, SF, "labels"))
    assert set(kept[1]) == {r.doc_id for r in C.scores(stages[0], weights).filter("predicted = 1").collect()}
    assert set(kept[2]) == {c[3] for c in components(list(kept[1].items()), 5)}
    items = [(r.item_id, r.text) for r in table(spark, SF, "benchmark").collect()]
    assert set(kept[3]) == set(kept[2]) - {x[0] for x in leaks(list(kept[2].items()), items)}
    tok = Tokenizer.from_file(public_tokenizers.path(P.TOKENIZER))
    got = {r.doc_id: r for r in stages[4].collect()}
    assert set(got) == set(kept[3])
    for d, text in kept[3].items():
        ids = tok.encode(text, add_special_tokens=False).ids
        assert got[d].ids == ids and got[d].n_tokens == len(ids)


def test_run_equals_the_stages(spark, stages):
    a, b = P.run(spark, SF), stages[-1]
    assert a.columns == b.columns
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_clean_documents_stay(spark, stages):
    labels = table(spark, SF, "labels").filter("quality = 1")
    long = table(spark, SF, "documents").join(labels, "doc_id").filter(F.size(F.split("text", " ")) >= 60)
    lost = long.join(stages[1], "doc_id", "left_anti").count()
    assert lost <= 0.03 * long.count()


def test_stages_on_odd_rows(spark, docs, no_docs):
    for frame in (docs, no_docs):
        for name, stage in P.STAGES[:-1]:
            assert stage(spark, frame, SF).columns == frame.columns, name
            assert stage(spark, frame, SF).count() <= frame.count()
        assert P.STAGES[-1][1](spark, frame, SF).count() == frame.count()
