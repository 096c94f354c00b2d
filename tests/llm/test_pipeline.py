import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from ledgerline.checks import compare
from ledgerline.llm import packing, pii, queries, quality_rules, simhash
from ledgerline.llm.common import materialise, read


@pytest.fixture(scope="module")
def stages(spark, sf_small):
    docs, out = read(spark, sf_small, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_small), name)
        out.append(docs)
    return out


def test_stages_keep_the_columns(spark, sf_small, stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_duplicates", "personal_data", "source_mixing", "packing"]
    want = read(spark, sf_small, "documents").columns
    assert [s.columns for s in stages[:-1]] == [want] * 4


def test_each_stage_does_what_its_operator_says(spark, sf_small, stages):
    docs, (good, single, clean, mixed, packed) = read(spark, sf_small, "documents"), stages
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    assert ids(good) == ids(quality_rules.quality_rules(docs, read(spark, sf_small, "labels")).filter("kept"))
    assert ids(single) == ids(simhash.near_duplicates(good).filter("doc_id = component_id"))
    assert ids(clean) == ids(single)
    n = [f"n_{k}" for k in pii.KINDS]
    found = {r.doc_id: sum(r[c] for c in n) for r in pii.find(single).collect()}
    marks = {r.doc_id: r.text.count("[EMAIL]") + r.text.count("[IP]") + r.text.count("[CARD]") + r.text.count("[PHONE]") for r in clean.collect()}
    assert all(marks[d] >= k for d, k in found.items()) and sum(found.values()) > 0
    assert all(r.n_chars == len(r.text) for r in clean.collect())
    copies = {r.doc_id: r.copies for r in queries.mixing.mix(clean).collect()}
    assert ids(mixed) == sorted(d for d, k in copies.items() for _ in range(k))
    whole = {}
    for r in packed.collect():
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    tokens = {r.doc_id: r.doc_tokens for r in packed.collect()}
    assert whole == {d: tokens[d] * copies[d] for d in tokens} and packing.buckets(packed).agg({"sequences": "sum"}).first()[0] == packed.count()


def test_run_gives_the_last_stage(spark, sf_small, stages):
    got = corpus_pipeline.run(spark, sf_small)
    assert sorted(got.select("doc_id", "start", "ids_crc32").collect()) == sorted(stages[-1].select("doc_id", "start", "ids_crc32").collect())


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)]])
def test_stages_on_next_to_nothing(spark, sf_small, rows):
    docs = spark.createDataFrame(rows, read(spark, sf_small, "documents").schema)
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, sf_small), "stage")
    assert docs.count() == 0


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_match_their_sql(spark, sf_dir, name):
    assert compare.difference(queries.queries()[name](spark, sf_dir), compare.connect(sf_dir), queries.oracle_sql()[name]) is None


def test_every_operator_is_registered():
    names = entry.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)) and "pipeline" in names
    assert set(queries.oracle_sql()) <= set(names)
    assert duckdb.__version__
