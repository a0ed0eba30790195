"""Phrase collocations against counting every phrase."""
import random
import re
from collections import Counter

import corpus
import pytest

from lendscope.llm import collocations as co


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute(rows, top=2000, least=100, longest=5):
    counts, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for m in range(1, longest + 1):
                for i in range(len(words) - m + 1):
                    counts[lang, tuple(words[i:i + m])] += 1
    inside = Counter()
    for (lang, g), f in counts.items():
        if f >= least:
            for m in range(2, len(g)):
                for i in range(len(g) - m + 1):
                    inside[lang, g[i:i + m]] = max(inside[lang, g[i:i + m]], f)
    out = {}
    for (lang, g), a in counts.items():
        if len(g) > 1 and a >= least and inside[lang, g] < a:
            cuts = [(1000 * a * n[lang] // (counts[lang, g[:k]] * counts[lang, g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(g).encode(), counts[lang, g[:k]], counts[lang, g[k:]], n[lang]))
    return sorted((lang, rank, p.decode(), -a, l, r, size, -score) for lang, found in out.items()
                  for rank, (score, a, p, l, r, size) in enumerate(sorted(found)[:top], 1))


def table(spark, rows):
    extra = "".join(f", `{c}` string" for c in ("chunk", "level", "n", "rank", "phrase", "key", "score"))
    return spark.createDataFrame([(*r, *("clash",) * 7) for r in rows], f"doc_id long, text string, lang string{extra}")


def run(spark, rows, **options):
    got = co.collocations(table(spark, rows), **options)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in got.collect())


def text_of(rnd, words, n):
    """Frequent words between rarer ones, fixed phrases inside, punctuation and odd blanks."""
    fixed = ["Rosa of the Lux", "of the Lux", "in spite of it all", "é Über alles", "to be or not to be", "a a a a a a"]
    parts = [rnd.choice(fixed) if rnd.random() < 0.2 else words[min(int(rnd.expovariate(0.15)), len(words) - 1)] for _ in range(n)]
    return "".join(p + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".", "\n", " ; "]) for p in parts)


def documents(seed, n=60):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(30)] + ["the", "of", "日本", "x\x00y", "a\x1cb"]
    return [(i, text_of(rnd, words, rnd.randint(0, 120)), rnd.choice(["en", "fr", None, "de ch", "und", "", "en"])) for i in range(n)]


@pytest.mark.parametrize(("top", "least", "chunk"), [(2000, 4, 1 << 23), (7, 3, 900), (1, 5, 3000), (40, 1, 2000)])
def test_against_counting_every_phrase(spark, top, least, chunk):
    """Small chunks and buckets; few wanted phrases settle early, many need every wave."""
    rows = documents(top + least)
    options = {"top": top, "least": least}
    got = run(spark, rows, chunk_bytes=chunk, bucket_bytes=1500, shares=(0.02, 0.3, 1.0), **options)
    assert got == brute(rows, **options)


def test_other_lengths(spark):
    rows = documents(77, 30)
    for longest in (2, 4):
        assert run(spark, rows, top=25, least=3, longest=longest, chunk_bytes=1200) == brute(rows, top=25, least=3, longest=longest)


def test_ties_at_the_end_of_a_language(spark):
    """Phrases of equal score and count, more than wanted: the first by their bytes stay."""
    rows = [(i, f"p{j} q{j} . Z{j} é{j}", "en") for i in range(5) for j in range(40)]
    got = run(spark, rows, top=30, least=5, shares=(0.01, 1.0))
    assert got == brute(rows, top=30, least=5) and len({r[-1] for r in got}) == 1


def test_odd_rows(spark):
    rows = [(i, t, ("en", None)[i % 2]) for i, t in corpus.odd_rows()] + [(None, "two words here", "en"), (3, None, None)]
    rows += [(4, "hot text of copies", "en")] * 60
    assert run(spark, rows, least=3, chunk_bytes=4000) == brute(rows, least=3)
    assert run(spark, [], least=1) == []
    assert run(spark, [(1, None, "en"), (2, " \n", None), (3, "one", "en")], least=1) == []


def test_long_texts_are_cut_between_words(spark, monkeypatch):
    rnd = random.Random(9)
    text = " ".join(f"v{rnd.randrange(12)}" for _ in range(3000)) + "\n" + text_of(rnd, ["k", "l", "m"], 2000)
    for size in (50, 333):
        monkeypatch.setattr(co, "SLICE", size)
        parts = list(co._slices(text.lower().encode().translate(co._AS_SPLIT)))
        assert b"".join(p for p, _ in parts) == text.lower().encode().translate(co._AS_SPLIT) and len(parts) > 20
        whole = [w for p, _ in parts for w in p.split()]
        assert whole == text.lower().encode().translate(co._AS_SPLIT).split()


def test_products_beyond_64_bits():
    """Scores are Python integers: 1000 * a * n may pass 64 bits."""
    import numpy as np

    from lendscope.llm.packed import pack, pack_words
    chunk = co.Chunk({"chunk": 0, "langs": ["en"], "lang_of": pack(np.zeros(2, "<i4")), "words": pack_words([b"x", b"y"]),
                      "numbers": pack(np.array([1, 2, 0], "<i4"))})
    chunk.place(co.pa.table({c: [] for c in ("level", "places", "nodes", "counts", "owned")}),
                co.pa.table({"lang": ["en"], "n": [10**15], "most": [10**14], "floor": [0]}), 0)
    chunk.cur, chunk.node = [chunk.at, chunk.at, np.array([0, -1, -1])], [None, np.array([1, 2]), np.array([3])]
    chunk.count, chunk.owned = [None, np.array([10**13, 10**12]), np.array([10**12])], [None, np.zeros(2, bool), np.ones(1, bool)]
    chunk.first, chunk.frontier = [None, np.array([0])], np.ones(2, bool)
    assert chunk.best(5)["score"] == [1000 * 10**12 * 10**15 // 10**25]


def test_growing_needs_no_words_and_numbers_phrases_as_sorted():
    """Chunks are grown by word numbers alone, and each level looks at the places of the one before."""
    import numpy as np

    from lendscope.llm.packed import pack, pack_sorted
    rng = np.random.default_rng(3)
    numbers = rng.integers(0, 5, 300).astype("<i4")                            # 0 ends a piece
    chunk = co.Chunk({"chunk": 0, "langs": ["en"], "lang_of": pack(np.zeros(4, "<i4")), "numbers": pack(numbers)})
    rows = [{"level": 1, "places": pack_sorted(np.arange(3)), "nodes": pack(np.arange(1, 4)), "counts": pack(np.array([9, 9, 900])),
             "owned": pack(np.ones(3, bool))}]                                 # word 4 is too rare, word 3 no frontier word
    limits = co.pa.table({"lang": ["en"], "n": [300], "most": [9], "floor": [0]})
    for level in (2, 3, 4):
        chunk.place(co.pa.Table.from_pylist(rows), limits, level - 1)
        at, number, place, _, counts = chunk._grown(level)
        parts, sums = chunk.keys(level)
        found = {}
        for i in range(len(numbers) - level + 1):
            phrase = tuple(numbers[i:i + level].tolist())
            if all(1 <= x <= 3 for x in phrase) and (phrase[0] < 3 or phrase[-1] < 3):
                inner = [phrase[:-1]] * (phrase[0] < 3) + [phrase[1:]] * (phrase[-1] < 3)
                if level == 2 or kept.issuperset(inner):
                    found.setdefault(phrase, []).append(i)
        assert sorted(map(tuple, parts.tolist())) == sorted(set(map(tuple, parts.tolist())))
        assert {tuple(numbers[p:p + level].tolist()): c for p, c in zip(place.tolist(), sums.tolist(), strict=True)} == {k: len(v) for k, v in found.items()}
        assert sorted(at.tolist()) == sorted(i for v in found.values() for i in v) and (place == [at[number == k][0] for k in range(len(place))]).all()
        keep = np.flatnonzero(counts >= np.median(counts))                     # the others are answered as too rare
        kept = {tuple(numbers[p:p + level].tolist()) for p in place[keep].tolist()}
        rows.append({"level": level, "places": pack_sorted(keep), "nodes": pack(keep + 1000 * level), "counts": pack(counts[keep]), "owned": pack(np.ones(len(keep), bool))})


def test_distinct_codes_as_numpy_gives_them():
    import numpy as np
    rng = np.random.default_rng(5)
    for code in (np.zeros(0, np.int64), rng.integers(-40, 40, 999), rng.integers(-(2**62), 2**62, 50).repeat(3)):
        _, first, inverse, counts = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
        for got, want in zip(co._distinct(code), (first, inverse, counts), strict=True):
            assert got.tolist() == want.tolist()
