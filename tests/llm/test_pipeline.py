"""The corpus pipeline, stage by stage."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from signalmart.llm import queries
from tests.conftest import SF_SMALL
from tests.llm.fixtures import odd
from tests.llm.test_dedup import brute_groups


def test_every_operator_is_registered():
    names = E.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names if n.startswith("op")) == list(range(1, 14))
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)


@pytest.fixture(scope="module")
def stages(spark):
    docs = queries.table(spark, SF_SMALL, "documents")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_SMALL).cache()
        out.append((name, docs))
    return out


def test_stages_filter_and_keep_the_columns(spark, stages):
    for (_, before), (name, after) in zip(stages, stages[1:-1]):
        assert after.columns == before.columns, name
        assert after.exceptAll(before).count() == 0, name
    assert stages[-1][1].columns == [*stages[0][1].columns, "token_ids", "decodes", "n_tokens"]
    assert stages[-1][1].count() == stages[-2][1].count() > 0


def test_stages_do_what_their_operators_say(spark, stages):
    start, clean, once, apart, fresh, last = (d for _, d in stages)
    scores = queries.QUERIES["op8_toxicity"](spark, SF_SMALL)
    rejected = {r.doc_id for r in scores.filter("predicted = 1").collect()}
    ids = lambda d: {r.doc_id for r in d.select("doc_id").collect()}
    assert ids(start) - ids(clean) == rejected
    by_text = {}
    for r in clean.collect():
        by_text[r.text] = max(by_text.get(r.text, -1), r.doc_id)
    assert ids(once) == set(by_text.values())
    groups = brute_groups([(r.doc_id, r.text) for r in once.collect()], 80)
    assert ids(apart) == {i for i, _, c in groups if i == c}
    labelled = queries.QUERIES["op10_benchmark_decontamination"](spark, SF_SMALL)
    assert ids(apart) - ids(fresh) == ids(labelled.filter("contaminated")) & ids(apart)
    assert last.filter("NOT decodes").count() == 0
    assert last.filter(F.col("n_tokens") != F.size("token_ids")).count() == 0


def test_run_gives_the_last_stage(spark, stages):
    got = corpus_pipeline.run(spark, SF_SMALL)
    assert got.exceptAll(stages[-1][1]).count() == 0 and got.count() == stages[-1][1].count()


@pytest.mark.parametrize("k", range(5))
def test_stages_take_odd_and_empty_tables(spark, k):
    name, stage = corpus_pipeline.STAGES[k]
    df = odd(spark)
    out = stage(spark, df, SF_SMALL)
    assert out.columns[:len(df.columns)] == df.columns or k == 4
    assert 0 < out.count() <= df.count()
    assert stage(spark, df.limit(0), SF_SMALL).count() == 0
