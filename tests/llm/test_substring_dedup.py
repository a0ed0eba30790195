import random
import re
from collections import Counter

import corpus
import numpy as np
import pytest

from lendscope.llm import wordcodes
from lendscope.llm.substring_dedup import substring_dedup

SPLIT = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, window):
    words = [SPLIT.findall(t or "") for _, t in rows]
    seen = Counter(tuple(w[p:p + window]) for w in words for p in range(len(w) - window + 1))
    out = []
    for (i, _), w in zip(rows, words, strict=True):
        gone = set()
        for p in range(len(w) - window + 1):
            if seen[tuple(w[p:p + window])] > 1:
                gone.update(range(p, p + window))
        out.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    return Counter(out)


def run(df, **kw):
    return Counter(tuple(r[c] for c in ("doc_id", "n_words", "n_removed", "kept")) for r in substring_dedup(df, **kw).collect())


def planted(seed):
    """Passages that repeat across and inside documents, at any offset."""
    rnd = random.Random(seed)
    passages = [corpus.prose(rnd, rnd.randint(5, 60)) for _ in range(6)]
    rows = []
    for i in range(40):
        parts = [corpus.prose(rnd, rnd.randint(0, 30))]
        for _ in range(rnd.randint(0, 3)):
            parts += [rnd.choice(passages), corpus.prose(rnd, rnd.randint(0, 9))]
        rows.append((i, " ".join(parts)))
    return rows


@pytest.mark.parametrize("window", [5, 11, 35])
@pytest.mark.parametrize("chunk_bytes,bucket_bytes", [(1 << 23, 1 << 25), (600, 2000)])
def test_matches_brute_force(spark, window, chunk_bytes, bucket_bytes):
    rows = corpus.odd_rows() + planted(window) + [(None, "no id " * 9), (3, "one"), (7, corpus.odd_rows()[7][1])]
    assert run(corpus.table(spark, rows), window=window, chunk_bytes=chunk_bytes, bucket_bytes=bucket_bytes) == brute(rows, window)


def test_a_passage_in_a_third_of_all_rows(spark):
    rnd = random.Random(5)
    passage = corpus.prose(rnd, 50)
    rows = [(i, corpus.prose(rnd, 8) + " " + (passage if i % 3 == 0 else "") + " " + corpus.prose(rnd, 8)) for i in range(300)]
    assert run(corpus.table(spark, rows).repartition(6), chunk_bytes=2000, bucket_bytes=4000) == brute(rows, 35)


def test_whole_texts_stay_as_they_are(spark):
    rows = [(1, "a  b\nc"), (2, "x " * 80), (3, None)]
    got = {r["doc_id"]: r["kept"] for r in substring_dedup(corpus.table(spark, rows), whole_as_is=True).collect()}
    assert got == {1: "a  b\nc", 2: "", 3: ""}


def test_empty_table_and_even_window(spark):
    assert substring_dedup(corpus.empty(spark)).count() == 0
    with pytest.raises(ValueError):
        substring_dedup(corpus.empty(spark), window=4)


def test_the_texts_are_shuffled_once(spark):
    df = substring_dedup(corpus.table(spark, planted(1)))
    df._jdf.collectToPython()
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ReusedExchange") == 2


def test_word_codes():
    texts = [(t or "").encode() for _, t in corpus.odd_rows()] + [b"a", b"ab", b"ba", b"aab", b"\x00", b"\x00\x00"]
    data, starts, ends, first = wordcodes.texts_as_words(texts)
    words = [SPLIT.findall(t.decode()) for t in texts]
    flat = [w for ws in words for w in ws]
    assert [bytes(data[a:b]).decode() for a, b in zip(starts, ends, strict=True)] == flat
    assert first.tolist() == np.cumsum([0, *map(len, words)]).tolist()
    for codes in wordcodes.word_codes(data):
        assert len(set(codes.tolist())) == len(set(flat)) and len(codes) == len(flat)
        for size in (1, 2, 3, 4, 9, 18, 35):
            grams = [tuple(flat[i:i + size]) for i in range(len(flat) - size + 1)]
            got = wordcodes.window_codes(codes, size)
            assert len(set(zip(grams, got.tolist(), strict=True))) == len(set(grams)) == len(set(got.tolist()))
            assert (wordcodes.window_codes(codes, size, block=11) == got).all()
    small, whole = wordcodes.word_codes(data, block=7), wordcodes.word_codes(data)
    assert all((x == y).all() for x, y in zip(small, whole, strict=True))


def thue_morse(length, swap=False):
    return "".join("ab"[(bin(i).count("1") & 1) ^ swap] for i in range(length))


@pytest.mark.parametrize("length", [1024, 2048, 4096])
def test_words_that_polynomials_confuse(spark, length):
    """Words, and windows of two words in that order, which any polynomial mod 2^64 maps alike."""
    one, other = thue_morse(length), thue_morse(length, True)
    data = np.frombuffer(f"{one} {other}".encode(), np.uint8)
    for codes in wordcodes.word_codes(data):
        assert codes[0] != codes[1]
    a, b = ([int(x == "a") for x in w] for w in (one, other))
    letters = np.array([3, 5], np.uint64)
    assert (wordcodes.window_codes(letters[a], length) != wordcodes.window_codes(letters[b], length)).all()
    rest = " ".join(f"w{i}" for i in range(20))
    rows = [(1, f"{rest} {one} {rest}"), (2, f"{rest} {other} {rest}"), (3, f"{rest} {one} {rest[::-1]}")]
    assert run(corpus.table(spark, rows), window=21) == brute(rows, 21)
