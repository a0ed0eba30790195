"""The registered queries and the pipeline, against brute force on the smallest tables."""
import os
import sys

import corpus
import pytest
from test_near_dedup import brute as near_brute
from test_near_dedup import shingles
from test_substring_dedup import brute as substring_brute

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from lendscope import llm
from lendscope.llm import common, near_dedup, quality

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(entry.__file__)), "tools"))
from check_oracle import compare, duck, schema_diff  # noqa: E402

OPERATORS = {f"op{n}" for n in range(1, 11)}


def test_every_operator_is_registered():
    assert {name.split("_")[0] for name in llm.queries()} == OPERATORS and len(llm.queries()) == 10
    assert set(llm.queries()) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_matches_sql(spark, name):
    df, rel = llm.queries()[name](spark, SF_SMALL), duck(SF_SMALL).sql(llm.oracle_sql()[name])
    assert (compare(df.toPandas(), rel.fetchdf()) or schema_diff(df, rel)) is None


@pytest.fixture(scope="module")
def stages(spark):
    """(name, rows in, rows out) of each stage."""
    docs, out = common.table(spark, SF_SMALL, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = common.stored(stage(spark, docs, SF_SMALL), f"test-{name}")
        out.append((name, [r.asDict() for r in docs.collect()], [r.asDict() for r in result.collect()], docs.columns))
        docs = result
    return out


def test_stages_return_document_columns(stages):
    assert [s[0] for s in stages] == ["quality", "exact_dedup", "near_dedup", "substring_dedup", "packing"]
    assert all(s[3] == ["doc_id", "text", "lang", "source", "n_chars"] for s in stages)


def test_quality_stage_keeps_what_the_classifier_accepts(spark, stages):
    _, before, after, _ = stages[0]
    docs = common.table(spark, SF_SMALL, "documents")
    model = quality.fit_on_sample(docs, common.table(spark, SF_SMALL, "labels"), "quality")
    good = {r["doc_id"] for r in quality.classify(docs, model).collect() if r["predicted"] == 1}
    assert {r["doc_id"] for r in after} == good and 0 < len(after) < len(before)
    labels = {r["doc_id"]: r["quality"] for r in common.table(spark, SF_SMALL, "labels").collect()}
    assert all(i in good for i, y in labels.items() if y == 1)


def test_exact_stage(stages):
    _, before, after, _ = stages[1]
    best = {}
    for r in before:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"] or "")
        best[low] = max(best.get(low, -1), r["doc_id"])
    assert sorted(r["doc_id"] for r in after) == sorted(best.values())


def test_near_stage(stages):
    _, before, after, _ = stages[2]
    want = near_brute([(r["doc_id"], r["text"]) for r in before], near_dedup.Rule())
    assert sorted(r["doc_id"] for r in after) == sorted(i for i, _, _, kept in want if kept)


def test_substring_stage(stages):
    _, before, after, _ = stages[3]
    want = {i: (gone, text) for i, _, gone, text in substring_brute([(r["doc_id"], r["text"]) for r in before], 35)}
    source = {r["doc_id"]: r["text"] for r in before}
    assert len(after) == len(before)
    for r in after:
        gone, text = want[r["doc_id"]]
        assert r["text"] == (text if gone else source[r["doc_id"]]) and r["n_chars"] == len(r["text"])


def test_packing_stage(stages):
    _, before, after, _ = stages[4]
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    used = {}
    for r in after:
        used[r["sequence_id"]] = used.get(r["sequence_id"], 0) + r["length"]
    assert max(used.values()) <= 2048 and len(used) <= -(-sum(used.values()) // 2048) + 2


def test_stages_take_odd_rows_and_empty_tables(spark):
    columns = "doc_id long, text string, lang string, source string, n_chars long, score string, h string"
    odd = [(i, t, "xx", "here", 0, "clash", "clash") for i, t in corpus.odd_rows()] + [(3, "one", "xx", "there", 0, "clash", "clash")] * 2
    for rows in ([], odd):
        docs = spark.createDataFrame(rows, columns)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_SMALL)
            assert rows or out.count() == 0
            if name != "packing":
                assert tuple(out.columns) == corpus_pipeline.COLUMNS
            out.collect()


def test_repeated_rows_are_one_document(spark):
    rows = [(3, "The same", "en", "a", 8)] * 5 + [(4, "the same", "en", "a", 8)] * 2 + [(5, "other", None, None, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted(map(tuple, corpus_pipeline.without_copies(spark, docs, SF_SMALL).collect()))
    assert got == [(4, "the same", "en", "a", 8), (5, "other", None, None, 5)]


def test_shingles_of_short_texts():
    assert shingles("One two", 5) == frozenset([(b"one", b"two")]) and shingles(" \n", 5) == frozenset()
