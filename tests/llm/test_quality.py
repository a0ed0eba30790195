import random
import tracemalloc
import zlib

import corpus
import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import quality


def clean(rnd):
    return ". ".join(" ".join(rnd.choice(corpus.WORDS[:20]) for _ in range(rnd.randint(4, 12))).capitalize() for _ in range(rnd.randint(2, 9)))


def junk(rnd):
    if rnd.random() < 0.5:
        return " ".join(rnd.choice(corpus.WORDS[:20]).upper() + "!!" for _ in range(rnd.randint(10, 60)))
    return " ".join([rnd.choice(corpus.WORDS)] * rnd.randint(10, 60))


def labelled(spark, n=600):
    rnd = random.Random(8)
    rows = [(i, clean(rnd) if i % 4 else junk(rnd), int(i % 4 > 0)) for i in range(n)]
    docs = corpus.table(spark, [r[:2] for r in rows])
    labels = spark.createDataFrame([(i, y, "clash") for i, _, y in rows], "doc_id long, quality int, text string")
    return rows, docs, labels


def test_held_out_accuracy(spark):
    rows, docs, labels = labelled(spark)
    model = quality.fit_on_sample(docs, labels, "quality")
    got = {r["doc_id"]: r for r in quality.classify(docs, model).withColumn("held", quality.held_out()).collect()}
    held = [(y, got[i]["predicted"]) for i, _, y in rows if got[i]["held"]]
    assert len(held) > 80 and np.mean([a == b for a, b in held]) > 0.97
    assert all(r["held"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in got.values())


def test_votes_equal_brute_force(spark):
    _, docs, labels = labelled(spark, 200)
    model = quality.fit_on_sample(docs, labels, "quality", sample=100, neighbours=5)
    assert len(model.labels) == 100
    texts = [t or "" for _, t in corpus.odd_rows()]
    rows = np.stack([quality.term_weights(quality.term_counts(t.encode())) for t in texts])
    for row, score in zip(rows, model.score(rows), strict=True):
        if not row.any():
            assert score == pytest.approx(model.labels.mean())
            continue
        cosine = np.round(model.latent(row[None])[0] @ model.vectors.T, 5)
        near = sorted(range(100), key=lambda i: (-cosine[i], i))[:5]
        weight = np.maximum(cosine[near], 0)
        assert score == pytest.approx((weight * model.labels[near]).sum() / weight.sum() if weight.sum() > 0 else model.labels.mean(), abs=1e-3)


def test_held_out_labels_and_ids_change_nothing(spark):
    _, docs, labels = labelled(spark, 200)
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (quality.fit_on_sample(docs, x, "quality") for x in (labels, flipped))
    assert (a.vectors == b.vectors).all() and (a.labels == b.labels).all()


def test_odd_rows_and_empty_tables(spark):
    _, docs, labels = labelled(spark, 120)
    model = quality.fit_on_sample(docs, labels.unionByName(labels.withColumn("quality", F.lit(None).cast("int"))), "quality")
    rows = corpus.odd_rows() + [(None, "no id"), (3, "one"), (3, "one")]
    out = quality.classify(corpus.table(spark, rows), model)
    assert out.count() == len(rows) and out.columns.count("score") == 1
    assert quality.classify(corpus.empty(spark), model).count() == 0
    none = quality.fit_on_sample(corpus.empty(spark), labels, "quality")
    assert {r["score"] for r in quality.classify(corpus.table(spark, rows), none).collect()} == {0.5}


def test_long_texts_are_counted_in_blocks(monkeypatch):
    text = ("A few words, then SOME more 123.\n" * 50).encode()
    whole = quality.term_counts(text)
    monkeypatch.setattr(quality, "BLOCK", 100)
    parts = quality.term_counts(text)
    assert whole[:2048].sum() == parts[:2048].sum() and (whole[:2048] == parts[:2048]).all()


def test_long_texts_count_as_in_one_piece(monkeypatch):
    """Blocks neither cut words nor forget the word before: any block size, the same counts."""
    rnd = random.Random(21)
    for text in (corpus.prose(rnd, 800), "same " * 300, "x" * 999 + " y", " \n a", "Ab cD\tAb", ""):
        whole = quality.term_counts(text.encode())
        for size in (1, 7, 64, 500):
            with monkeypatch.context() as m:
                m.setattr(quality, "BLOCK", size)
                assert (quality.term_counts(text.encode()) == whole).all()


def test_words_tell_texts_of_one_style_apart():
    """Two vocabularies of the same shape: only the words differ."""
    rnd = random.Random(22)
    letters = "abcdefghijklmnopqrstuvwxyz"
    kinds = [["".join(rnd.choice(letters) for _ in range(4)) for _ in range(30)] for _ in range(2)]
    texts = [(k, " ".join(rnd.choice(kinds[k]) for _ in range(60))) for k in (0, 1) for _ in range(80)]
    rnd.shuffle(texts)
    rows = np.stack([quality.term_weights(quality.term_counts(t.encode())) for _, t in texts])
    label = np.array([float(k) for k, _ in texts])
    model = quality.fit(rows[:100], label[:100], 16, 5)
    assert ((model.score(rows[100:]) > 0.5) == (label[100:] > 0.5)).mean() > 0.95
    assert (quality.term_counts(b"Word wORD") == quality.term_counts(b"Word wORD")).all()
    assert (quality.term_counts(b"no")[quality.STYLE:] == quality.term_counts(b"No")[quality.STYLE:]).all()
    assert (quality.term_counts(b"on")[quality.STYLE:] != quality.term_counts(b"no")[quality.STYLE:]).any()


def test_fitting_holds_two_matrices_of_the_sample_at_most():
    rows = np.random.default_rng(1).random((1500, quality.TERMS), np.float32) * (np.random.default_rng(2).random((1500, quality.TERMS)) < 0.1)
    rows = rows.astype(np.float32)
    tracemalloc.start()
    try:
        model = quality.fit(rows, np.arange(1500) % 2, 32, 7)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 1.6 * rows.nbytes                 # besides `rows`: one matrix, marks of a byte, axes
    z = rows * model.weight - model.mean            # the plain forms
    assert np.array_equal(model.mean, (rows * model.weight).mean(axis=0))
    want = z @ model.axes
    assert np.array_equal(model.vectors, want / np.maximum(np.linalg.norm(want, axis=1, keepdims=True), 1e-9))
