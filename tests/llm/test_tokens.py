"""Encoding, counts, packing and token files against the libraries themselves."""
import base64
import hashlib
import random
import uuid
import zlib
from collections import Counter

import corpus
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lendscope.llm import bpe, encoder, packing, token_counts, token_output
from lendscope.llm.common import shared_dir

JSON, RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    tokens = Tokenizer.from_file(JSON)
    tokens.encode_special_tokens = True
    return lambda t: tokens.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def rank_library():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def ints(raw, dtype="<u4"):
    return np.frombuffer(raw, dtype).tolist()


def test_encoder_equals_the_library(library):
    enc = encoder.Encoder(JSON)
    rnd = random.Random(2)
    glyphs = "ab  \n\t\r.,'sé日🙂12\x1c\xa0 -"
    texts = [t or "" for _, t in corpus.odd_rows()] + ["".join(rnd.choice(glyphs) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    assert [ints(x, enc.dtype) for x in enc.encode(texts)] == [library(t) for t in texts]


def test_slices_keep_matches(monkeypatch, library):
    text = " ".join(t or "" for _, t in corpus.odd_rows())
    parts = list(encoder.slices(text, 100))
    assert "".join(parts) == text and len(parts) > 20
    monkeypatch.setattr(encoder, "SLICE_CHARS", 100)
    enc = encoder.Encoder(JSON)
    assert ints(enc.one(text), enc.dtype) == library(text)


def test_kept_words_are_bounded(monkeypatch, library):
    monkeypatch.setattr(encoder, "KEPT", 5)
    enc = encoder.Encoder(JSON)
    for _, t in corpus.odd_rows():
        assert ints(enc.one(t or ""), enc.dtype) == library(t)
    assert len(enc.matches) <= 5 and len(enc.parts) <= 5


@pytest.mark.parametrize("chunk_chars,bucket_bytes", [(1 << 23, 1 << 24), (500, 800)])
def test_bpe_round_trip(spark, rank_library, chunk_chars, bucket_bytes):
    rows = corpus.odd_rows() + [(None, "no id"), (3, "one"), (3, "one")]
    encoded = bpe.bpe_encode(corpus.table(spark, rows), RANKS, chunk_chars=chunk_chars, bucket_bytes=bucket_bytes)
    tokens = bpe.token_bytes(spark, RANKS)
    got = bpe.bpe_decode(encoded, tokens).collect()
    both = bpe.bpe_encode(corpus.table(spark, rows), RANKS, chunk_chars=chunk_chars, bucket_bytes=bucket_bytes, tokens=tokens)
    assert Counter(map(str, both.collect())) == Counter(map(str, got))
    want = Counter((i, tuple(rank_library(t or "")), (t or "").encode()) for i, t in rows)
    assert Counter((r["doc_id"], tuple(ints(r["ids"])), bytes(r["decoded"])) for r in got) == want
    assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got)


def test_bpe_empty_table_and_unknown_ids(spark):
    assert bpe.bpe_encode(corpus.empty(spark), RANKS).count() == 0
    tokens = spark.createDataFrame([(0, bytearray(b"a")), (2, bytearray(b"bc"))], "token int, bytes binary")
    ids = spark.createDataFrame([(bytearray(np.array([2, 0, 2], "<u4").tobytes()),), (None,)], "ids binary")
    assert [r["decoded"] and bytes(r["decoded"]) for r in bpe.bpe_decode(ids, tokens).collect()] == [b"bcabc", None]
    with pytest.raises(Exception, match="missing from the token-byte table"):
        bpe.bpe_decode(spark.createDataFrame([(bytearray(np.array([1], "<u4").tobytes()),)], "ids binary"), tokens).collect()


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_sections_add_up_to_the_document(spark, library, rule):
    rows = corpus.odd_rows()
    got = token_counts.token_counts(corpus.table(spark, rows), JSON, rule).groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in got} == pytest.approx({i: len(library(t)) for i, t in rows})


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_crossing_tokens_follow_the_rule(rule):
    rnd = random.Random(7)
    for _ in range(200):
        sizes = np.array([rnd.randint(1, 5) for _ in range(20)])
        ids = np.array([rnd.randrange(20) for _ in range(rnd.randint(0, 30))], int)
        n = int(sizes[ids].sum())
        spans = [tuple(sorted((rnd.randint(0, n), rnd.randint(0, n)))) for _ in range(6)]
        counts, cut = token_counts.section_counts(ids, b"x" * n, spans, sizes, rule)
        ends = np.cumsum(sizes[ids])
        for (a, b), got, across in zip(spans, counts, cut, strict=True):
            want = crossed = 0
            for e, s in zip(ends.tolist(), (ends - sizes[ids]).tolist(), strict=True):
                want += {"start": a <= s < b, "end": a < e <= b, "middle": a <= (s + e - 1) // 2 < b,
                         "split": max(0, min(e, b) - max(s, a)) / (e - s)}[rule]
                crossed += s < a < e or s < b < e
            assert got == pytest.approx(want) and across == crossed


def test_lines_and_empty_table(spark):
    assert token_counts.lines("") == [(0, 0)] and token_counts.lines("a\n\nb") == [(0, 2), (2, 3), (3, 4)]
    assert token_counts.lines("a\n") == [(0, 2)]
    assert token_counts.token_counts(corpus.empty(spark), JSON).count() == 0


def test_token_files_and_keyed_access(spark, library):
    rows = corpus.odd_rows() + [(None, "no id"), (3, "one"), (3, "one more"), (-5, "negative")]
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-tokens"
    token_output.write_segments(corpus.table(spark, rows), path, JSON, end_id=2, segment_ids=300)
    files = spark.read.parquet(path)
    got = sorted(token_output.read_documents(files, JSON).collect(), key=lambda r: r["start"])
    keys = [r["key"] for r in got]
    assert keys == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    want = Counter((i, len(library(t)) + 1, zlib.crc32(np.array([*library(t), 2], "<u4").tobytes())) for i, t in rows)
    assert Counter((r["key"], r["n_tokens"], r["ids_crc32"]) for r in got) == want
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    asked = spark.createDataFrame([(i,) for i in (7, 13, -5, 999, 100)], "key long")
    found = {r["key"]: r["ids"] for r in token_output.fetch(files, asked, JSON).collect()}
    text = dict(rows)
    assert found == {i: [*library(text[i]), 2] for i in (7, 13, -5, 100)}


def test_keyed_access_to_repeats_and_null_keys(spark, library):
    """A key and the missing key hold many documents over several segments and tasks: all are found."""
    rows = [(None if i % 3 == 0 else 5 if i % 3 == 1 else i, f"text number {i % 40} of many") for i in range(240)]
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-repeats"
    token_output.write_segments(corpus.table(spark, rows).repartition(4), path, JSON, segment_ids=60)
    files = spark.read.parquet(path)
    assert files.filter("array_contains(keys, 5)").count() > 3 and files.filter("nulls > 0").count() > 3
    for asked in ([None, 5, 8, 9999], [5], [None], [8, 11, -1], []):
        keys = spark.createDataFrame([(k,) for k in asked + asked], "key long")
        got = Counter((r["key"], tuple(r["ids"])) for r in token_output.fetch(files, keys, JSON).collect())
        assert got == Counter((k, tuple(library(t))) for k, t in rows if k in asked)


def test_token_files_of_an_empty_table(spark):
    path = f"{shared_dir(spark)}/{uuid.uuid4().hex}-empty"
    token_output.write_segments(corpus.empty(spark), path, JSON)
    files = spark.read.schema(token_output.SEGMENT).parquet(path)
    assert token_output.read_documents(files, JSON).count() == 0
    assert token_output.fetch(files, spark.createDataFrame([(1,), (None,)], "key long"), JSON).count() == 0


def test_perfect_hash_is_minimal_and_spots_foreign_keys():
    keys = np.random.default_rng(3).integers(-2**62, 2**62, 5000)
    codes = np.unique(token_output.key_codes(keys, np.zeros(5000, bool)))
    seeds, slots = token_output.build_hash(codes)
    assert sorted(slots.tolist()) == list(range(len(codes)))
    prints = np.zeros(len(codes), "<u4")
    prints[slots] = token_output.fingerprints(codes)
    assert (token_output.look_up(codes, seeds, prints) == slots).all()
    foreign = token_output.key_codes(np.arange(20000), np.zeros(20000, bool))
    assert (token_output.look_up(foreign, seeds, prints) >= 0).sum() <= 1


@pytest.mark.parametrize("capacity", [16, 64, 2048])
def test_packing(spark, library, capacity):
    rows = corpus.odd_rows() + [(None, "no id"), (3, "one"), (3, "one")]
    got = [r.asDict() for r in packing.pack_documents(corpus.table(spark, rows), JSON, capacity).collect()]
    want = []
    for i, t in rows:
        ids = np.array([*library(t), 0], "<u4")
        want += [(i, p, s, n, zlib.crc32(ids[s:s + n].tobytes())) for p, (s, n) in enumerate(packing.piece_bounds(len(ids), capacity))]
        if len(ids) <= capacity:
            assert packing.piece_bounds(len(ids), capacity) == [(0, len(ids))]
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == Counter(want)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    least = -(-sum(r["length"] for r in got) // capacity)
    assert len(sequences) <= least * 1.05 + 1


def test_a_third_of_the_rows_alike(spark):
    """Rows alike in every column are numbered in many buckets, and places stay gapless."""
    rows = [(7, "the same row again")] * 300 + [(i, f"another text {i}" + " word" * (i % 7)) for i in range(600)]
    got = packing.pack_documents(corpus.table(spark, rows).repartition(6), JSON, capacity=64).collect()
    assert len(got) == 900
    places = {}
    for r in got:
        places.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 64
    pieces = packing.cut_documents(corpus.table(spark, rows), JSON, 64, 0, "doc_id", "text", False).withColumn("row", F.monotonically_increasing_id())
    same = pieces.filter("id = 7").select(F.pmod(F.xxhash64(*[c for c in pieces.columns if c != "ids"]), F.lit(16)).alias("b"))
    assert same.groupBy("b").count().agg(F.max("count")).first()[0] < 60


def test_packing_of_an_empty_table(spark):
    assert packing.pack_documents(corpus.empty(spark), JSON).count() == 0


def optimum(lengths, capacity):
    """Fewest bins, by search over sorted lengths."""
    lengths = sorted(lengths, reverse=True)
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for room in sorted(set(bins)):
            if room >= lengths[i]:
                rest = list(bins)
                rest[rest.index(room)] -= lengths[i]
                go(i + 1, rest)
        go(i + 1, [*bins, capacity - lengths[i]])

    go(0, [])
    return best[0]


def test_dominance_never_costs_a_sequence():
    rnd = random.Random(6)
    for _ in range(150):
        capacity = rnd.randint(5, 30)
        lengths = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 10))]
        plan = packing.plan_packing(Counter(lengths), capacity)
        packed = Counter()
        for items, n in plan.patterns:
            assert sum(items) <= capacity
            packed.update({x: n * c for x, c in Counter(items).items()})
        assert packed == Counter(lengths)
        # What dominance fixed can be completed to an optimum.
        fixed, left = 0, Counter(lengths)
        for items, n in plan.patterns:
            if fixed >= plan.fixed:
                break
            fixed += n
            left.subtract({x: n * c for x, c in Counter(items).items()})
        assert plan.fixed + optimum(list(left.elements()), capacity) == optimum(lengths, capacity)


def test_digests_of_the_bpe_query(spark, rank_library):
    from conftest import SF_SMALL
    docs = dict(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect())
    for r in bpe.op1_bpe(spark, SF_SMALL).collect():
        ids = np.array(rank_library(docs[r["doc_id"]] or ""), "<u4")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((docs[r["doc_id"]] or "").encode()).hexdigest()
