"""The registered queries themselves, on whole small tables, where no SQL checks them."""
import zlib
from collections import Counter

import corpus
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lendscope import llm
from lendscope.llm import token_counts
from lendscope.sources.tables import read_table

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    tokens = Tokenizer.from_file(JSON)
    tokens.encode_special_tokens = True
    return lambda t: tokens.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r["doc_id"], r["text"]) for r in read_table(spark, SF, "documents").select("doc_id", "text").collect())


def run(spark, name):
    return llm.queries()[name](spark, SF).collect()


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_every_operator_has_one_query():
    names = sorted(n.split("_")[0] for n in llm.queries())
    assert names == sorted(f"op{n}" for n in range(1, 14)) and set(llm.oracle_sql()) <= set(llm.queries())


def test_token_counts(spark, docs, library):
    """A line's tokens are those that start in it: in all, the document's."""
    got = Counter()
    for r in run(spark, "op2_token_counts"):
        got[r["doc_id"]] += r["n_tokens"]
    assert got == Counter({i: len(library(t)) for i, t in docs}) + Counter()
    assert set(got) == {i for i, _ in docs}


def test_token_counts_of_null_and_repeated_ids(spark, library):
    rows = [(None, "a line\nand one more"), (None, None), (3, "one"), (3, "one"), (3, "two\nlines"), *corpus.odd_rows()]
    want = Counter()
    for i, t in rows:
        for n, (a, b) in enumerate(token_counts.lines(t or "")):
            want[i, n, a, b] += 1
    got = token_counts.token_counts(corpus.table(spark, rows), JSON).collect()
    assert Counter((r["doc_id"], r["section"], r["begin"], r["end"]) for r in got) == want
    assert sum(r["n_tokens"] for r in got) == sum(len(library(t)) for _, t in rows)


def test_packing(spark, docs, library):
    got = run(spark, "op3_best_fit_packing")
    want = []
    for i, t in docs:
        ids = [*library(t), 0]
        first = len(ids) % 2048 if len(ids) > 2048 else len(ids)
        cuts = [0, *range(first or 2048, len(ids) + 1, 2048)] if len(ids) > 2048 else [0, len(ids)]
        want += [(i, n, a, b - a, crc(ids[a:b])) for n, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False))]
    lengths = Counter((r["doc_id"], sum(x["length"] for x in got if x["doc_id"] == r["doc_id"])) for r in got if r["piece"] == 0)
    assert lengths == Counter((i, len(library(t)) + 1) for i, t in docs)
    whole = {(r["doc_id"], r["piece"]): r for r in got}
    for i, t in docs:                                                    # pieces join to the document, whichever is shorter
        ids, at, n = [*library(t), 0], 0, 0
        while at < len(ids):
            r = whole[i, n]
            assert (r["start"], r["ids_crc32"]) == (at, crc(ids[at:at + r["length"]]))
            at, n = at + r["length"], n + 1
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= -(-sum(r["length"] for r in got) // 2048) + 2
    assert len(want) == len(got)


def test_classifier(spark, docs):
    got = {r["doc_id"]: r for r in run(spark, "op5_quality_classifier")}
    assert set(got) == {i for i, _ in docs}
    for i, r in got.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    labels = {r["doc_id"]: r["quality"] for r in read_table(spark, SF, "labels").collect()}
    judged = [(got[i]["predicted"], y) for i, y in labels.items() if y is not None and i in got and got[i]["held_out"]]
    assert judged and np.mean([a == b for a, b in judged]) >= 0.9


def test_sharding(spark, docs):
    got = run(spark, "op7_sharding")
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in docs)
    for s in {r["shard"] for r in got}:
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert 0 <= s < 40 and mine == list(range(len(mine)))


def test_token_output(spark, docs, library):
    want, at = [], 0
    for i, t in docs:
        ids = [*library(t), 2]
        want.append((i, at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(tuple(r[c] for c in ("doc_id", "start", "n_tokens", "ids_crc32")) for r in run(spark, "op8_token_output")) == want


def test_pipeline_stages_of_odd_rows(spark):
    """What the stages after the classifier make of null, empty, repeated and odd texts."""
    rows = [(i, t, "xx", "here", 0) for i, t in corpus.odd_rows()] + [(3, "one", "xx", "there", 0)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)
    single = stage["exact_dedup"](spark, docs, SF).collect()
    lowered = {}
    for i, t, *_ in rows:
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in t or "")
        lowered[low] = max(lowered.get(low, -1), i)
    assert sorted(r["doc_id"] for r in single) == sorted(lowered.values())
    cut = stage["substring_dedup"](spark, docs, SF).collect()
    assert len(cut) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in cut)
    packed = stage["packing"](spark, docs, SF).collect()
    assert Counter(r["doc_id"] for r in packed if r["piece"] == 0) == Counter(i for i, *_ in rows)
