import zlib

import corpus
import numpy as np
from lendscope.llm.sharding import even_out, place, shard_documents


def run(df, **kw):
    return [r.asDict() for r in shard_documents(df, **kw).collect()]


def test_every_row_has_a_place_and_slots_have_no_gap(spark):
    rows = corpus.odd_rows() + [(None, "no id"), (3, "one"), (3, "one")]
    got = run(corpus.table(spark, rows), shards=5)
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in got) == sorted(
        (str(i), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    for s in {r["shard"] for r in got}:
        slots = sorted(r["slot"] for r in got if r["shard"] == s)
        assert slots == list(range(len(slots)))
    assert {r["law"] for r in got} == {"bytes"} and all(0 <= r["shard"] < 5 and r["grown_shard"] is None for r in got)


def test_sizes_near_equal_with_a_hot_text(spark):
    rows = [(i, "hot text that a third of all rows hold" if i % 3 == 0 else corpus.prose(__import__("random").Random(i), 20)) for i in range(3000)]
    got = run(corpus.table(spark, rows), shards=8)
    size = np.bincount([r["shard"] for r in got], weights=[r["size"] for r in got], minlength=8)
    assert size.max() / size.min() < 1.02


def test_small_groups_stay_together(spark):
    rows = [(i, f"text number {i // 3} of many") for i in range(3000)]
    got = run(corpus.table(spark, rows), shards=4)
    where = {}
    text = dict(rows)
    assert all(where.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"] for r in got)


def test_groups_within_half_a_shard_stay_whole_with_many_shards(spark):
    rnd = __import__("random").Random(3)
    rows, n = [], 0
    for copies in [12, 9, 7, 5, 4, 3, 3] + [2] * 60 + [1] * 837:               # 1,000 rows, 25 a shard
        text = corpus.prose(rnd, 20)
        rows += [(n + i, text) for i in range(copies)]
        n += copies
    got, text, where = run(corpus.table(spark, rows), shards=40), dict(rows), {}
    assert len(got) == 1000
    assert all(where.setdefault(text[r["doc_id"]], r["shard"]) == r["shard"] for r in got)
    size = np.bincount([r["shard"] for r in got], weights=[r["size"] for r in got], minlength=40)
    assert size.max() / size.min() < 1.05


def test_a_large_group_spreads_without_distinct_ids(spark):
    for same in (None, 7):
        rows = [(same, "the one hot text") if i % 3 == 0 else (i, corpus.prose(__import__("random").Random(i), 20)) for i in range(3000)]
        got = run(corpus.table(spark, rows), shards=8)
        size = np.bincount([r["shard"] for r in got], weights=[r["size"] for r in got], minlength=8)
        count = np.bincount([r["shard"] for r in got], minlength=8)
        assert len(got) == 3000 and size.max() / size.min() < 1.02 and count.max() / count.min() < 1.6


def test_empty_and_tiny_tables(spark):
    assert shard_documents(corpus.empty(spark)).count() == 0
    assert len(run(corpus.table(spark, [(1, None)]))) == 1


def test_placement_balances_every_measure():
    rnd = np.random.default_rng(1)
    loads = rnd.lognormal(0, 1, (2000, 3))
    loads /= loads.sum(axis=0)
    shard = even_out(loads[:, 0], place(loads, 10), 10)
    for j in range(3):
        total = np.bincount(shard, weights=loads[:, j], minlength=10)
        assert abs(total - 0.1).max() < 0.01


def test_exchanges_by_bytes_keep_the_other_measures():
    rnd = np.random.default_rng(2)
    size, rows = rnd.lognormal(0, 1.2, 400), rnd.integers(1, 9, 400).astype(float)
    loads = np.stack([size, rows], axis=1)
    before = place(loads / loads.sum(axis=0), 10)
    after = even_out(size, before.copy(), 10, others=rows[:, None])
    off = [abs(np.bincount(s, weights=rows, minlength=10) / rows.sum() * 10 - 1).max() for s in (before, after)]
    spread = [np.ptp(np.bincount(s, weights=size, minlength=10)) for s in (before, after)]
    assert off[1] <= max(0.02, off[0]) + 1e-9 and spread[1] <= spread[0]


def test_texts_without_blanks_weigh_by_their_bytes(spark):
    """Long texts without a blank are spread as their tokens are, not as one word each."""
    rows = [(i, ("日本語の文章" * 40) if i % 10 == 0 else "w " * 30) for i in range(2000)]
    got = run(corpus.table(spark, rows), shards=5)
    text = dict(rows)
    tokens = np.bincount([r["shard"] for r in got], weights=[max(len(text[r["doc_id"]].split()), len(text[r["doc_id"]].encode()) / 4) for r in got])
    assert tokens.max() / tokens.min() < 1.1


def test_a_third_of_the_rows_alike(spark):
    rows = [(7, "the same row")] * 400 + [(i, f"text {i}") for i in range(800)]
    got = run(corpus.table(spark, rows).repartition(5), shards=6, slot_rows=20)
    for s in range(6):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(sum(r["shard"] == s for r in got)))
