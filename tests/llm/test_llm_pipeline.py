"""The pipeline: its stages against brute force on the rows that each gets, and odd tables."""

import corpus_pipeline as pipeline
import pytest
from brute import SF, near_classes, odd_documents, rows_of
from test_llm_spans import plain_dedup
from tokenizers import Tokenizer

import __spark_entry__ as entry
from tallyward.llm import quality, queries
from tallyward.operators.staging import stage


def test_registered(spark):
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [n for n, _ in pipeline.STAGES] == ["quality rules", "near dedup", "substring dedup", "mix sources", "tokens"]


@pytest.fixture(scope="module")
def tables(spark):
    docs = queries.table(spark, SF, "documents")
    found = [docs]
    for name, step in pipeline.STAGES:
        found.append(stage(step(spark, found[-1], SF), name.replace(" ", "-")))
    return found


def test_columns(tables):
    for table in tables[:-1]:
        assert table.columns == tables[0].columns


def test_quality(spark, tables):
    judged = quality.quality_rules(tables[0], queries.table(spark, SF, "labels"))
    assert sorted(rows_of(tables[1], "doc_id")) == sorted(rows_of(judged.where("kept"), "doc_id"))


def test_near_dedup(tables):
    classes = near_classes(dict(rows_of(tables[1], "doc_id", "text")))
    assert sorted(k for (k,) in rows_of(tables[2], "doc_id")) == sorted(set(classes.values()))


def test_substring_dedup(tables):
    want = [(k, t, len(t)) for k, t, _, gone in plain_dedup(rows_of(tables[2], "doc_id", "text")) if not gone or t.strip()]
    assert sorted(rows_of(tables[3], "doc_id", "text", "n_chars")) == sorted(want)


def test_mix(tables):
    from collections import Counter

    from compare import connect

    con = connect(SF)
    con.register("documents", tables[3].toPandas())
    from tallyward.llm.curriculum import SQL

    want = Counter()
    for key, size, _, _, taken, _ in con.execute(SQL).fetchall():
        if taken:
            want[key] = taken // size
    assert Counter(k for (k,) in rows_of(tables[4], "doc_id")) == want


def test_tokens(spark, tables):
    reference = Tokenizer.from_file(queries.vocabulary())
    reference.no_truncation()
    texts = dict(rows_of(tables[4], "doc_id", "text"))
    assert tables[5].count() == tables[4].count()
    for key, ids, n in rows_of(tables[5], "doc_id", "ids", "n_tokens"):
        assert ids == reference.encode(texts[key], add_special_tokens=False).ids and n == len(ids)


def test_odd_documents(spark):
    docs = odd_documents(spark)
    for table in (docs, docs.limit(0)):
        for _, step in pipeline.STAGES[1:]:
            table = stage(step(spark, table, SF), "odd")
        assert "ids" in table.columns
    assert pipeline.quality_rules(spark, docs.limit(0), SF).count() == 0
