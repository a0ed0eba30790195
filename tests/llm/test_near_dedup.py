import random
import re

import corpus
import numpy as np
import pytest

from lendscope.llm import common, components, exact_dedup
from lendscope.llm import near_dedup as nd
from lendscope.llm.components import connected

SPLIT = re.compile(rb"[^\x20\x09-\x0D]+")


def shingles(text, k):
    words = SPLIT.findall((text or "").encode().lower())
    return frozenset(tuple(words[i:i + k]) for i in range(len(words) - k + 1)) if len(words) >= k else frozenset([tuple(words)] if words else [])


def brute(rows, rule):
    """Rows as (id, set size, component id, kept), sorted."""
    sets = [shingles(t, rule.shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= rule.percent * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((key, len(sets[i]), least, key == least))
    return sorted(out, key=str)


def run(df, rule):
    got = nd.near_dedup(df, rule).collect()
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in got), key=str), got


def families(seed, bases=12, size=12):
    """Texts with copies whose words are changed, dropped or moved more and more."""
    rnd = random.Random(seed)
    rows, i = [], 0
    for _ in range(bases):
        text = corpus.prose(rnd, rnd.randint(20, 150)).split()
        for step in range(size):
            words = list(text)
            for _ in range(step // 2):
                words[rnd.randrange(len(words))] = rnd.choice(corpus.WORDS)
            rows.append((i, " ".join(words)))
            i += 1
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("rule", [nd.Rule(3, 85, 180, 6), nd.Rule()])
def test_matches_brute_force(spark, rule):
    rows = corpus.odd_rows() + [(1000 + i, t) for i, t in families(rule.shingle)] + [(None, "no id at all here"), (3, "one"), (3, "one")]
    assert run(corpus.table(spark, rows), rule)[0] == brute(rows, rule)


def test_one_large_family_in_small_cells(spark, monkeypatch):
    monkeypatch.setattr(nd, "CELL", 16)
    rule = nd.Rule(3, 85, 180, 6)
    rows = families(9, bases=1, size=90) + [(500 + i, t) for i, t in families(10, bases=6, size=4)]
    assert run(corpus.table(spark, rows), rule)[0] == brute(rows, rule)


def test_a_third_without_ids(spark, monkeypatch):
    """Many rows without an id, copies and near copies among them, and ids that repeat."""
    monkeypatch.setattr(nd, "CELL_SHINGLES", 400)
    rule = nd.Rule(3, 85, 180, 6)
    rows = [(None if i % 3 == 0 else i // 2, t) for i, t in families(12, bases=5, size=8)]
    rows += [(None, corpus.prose(random.Random(3), 40))] * 30 + rows[:6]
    assert run(corpus.table(spark, rows), rule)[0] == brute(rows, rule)


def test_words_that_polynomials_confuse(spark):
    one = "".join("ab"[bin(i).count("1") & 1] for i in range(2048))
    other = one.translate(str.maketrans("ab", "ba"))
    rest = " ".join(f"w{i}" for i in range(3))
    rows = [(1, f"{rest} {one} x"), (2, f"{rest} {other} x"), (3, one), (4, other), (5, f"{rest} {one} x")]
    rule = nd.Rule(3, 85, 180, 6)
    assert run(corpus.table(spark, rows), rule)[0] == brute(rows, rule)


@pytest.mark.parametrize("band,percent", [(6, 85), (5, 80)])
def test_recall_at_the_limit(band, percent):
    """Pairs just at the limit share a band, and their sketches pass."""
    rng = np.random.default_rng(percent)
    met = passed = 0
    pairs, n = 3000, 400
    for at in range(0, pairs, 100):
        both = round(2 * n * percent / (100 + percent))
        codes = rng.integers(0, 2**64, (100, 2 * n - both), dtype=np.uint64)
        rows = [np.sort(c[:n]) for c in codes] + [np.sort(c[n - both:]) for c in codes]
        made = nd.register_values(np.concatenate(rows), np.arange(len(rows) + 1) * n, 180)
        bands = nd.band_codes(made, band)
        met += int((bands[:100] == bands[100:]).any(axis=1).sum())
        passed += int(nd.passing(made[:100], made[100:], n, n, percent)[0].sum())
    assert met >= pairs - 1 and passed >= pairs - 1


def test_one_of_each_component_stays_also_for_repeated_ids(spark):
    base = corpus.prose(random.Random(1), 80)
    rows = [(5, base), (5, base + " more"), (6, base), (9, "quite another text"), (None, "quite another text")]
    got = nd.near_dedup(corpus.table(spark, rows)).collect()
    assert sorted(r["doc_id"] for r in got if r["stays"]) == [5, 9]


def test_empty_and_blank_tables(spark):
    assert nd.near_dedup(corpus.empty(spark)).count() == 0
    got, _ = run(corpus.table(spark, [(1, None), (2, ""), (3, " \n")]), nd.Rule())
    assert got == [(1, 0, 1, True), (2, 0, 2, True), (3, 0, 3, True)]


def sketch(*sets):
    codes = [np.unique(np.array(s, np.uint64)) for s in sets]
    return nd.register_values(np.concatenate(codes), np.cumsum([0, *map(len, codes)]), 180)


def test_registers_merge_and_estimate():
    rnd = np.random.default_rng(5)
    pool = rnd.integers(0, 2**63, 3000).astype(np.uint64) * np.uint64(2)
    errors = []
    for shared in (0, 300, 700, 850, 950, 1000):
        a, b = pool[:1000], np.concatenate([pool[:shared], pool[1000:2000 - shared]])
        ra, rb, both = sketch(a, b, np.concatenate([a, b]))
        assert (np.maximum(ra, rb) == both).all()
        true = shared / (2000 - shared)
        ok, estimate = nd.passing(ra[None], rb[None], 1000, 1000, 85)
        errors.append(abs(estimate[0] - true) if estimate[0] else 0)
        assert estimate[0] or true < 0.6
        assert ok[0] or true < 0.85
        assert not ok[0] or true > 0.6
    assert max(errors) < 0.12
    assert (sketch([], pool[:5])[0] == 0).all()


def test_sizes_alone_rule_a_link_out():
    rnd = np.random.default_rng(6).integers(0, 2**63, 1000).astype(np.uint64)
    ra, rb = sketch(rnd, rnd[:800])
    assert not nd.passing(ra[None], rb[None], 1000, 800, 85)[0][0]


def test_a_hub(spark):
    """A hub of a third of all edges."""
    edges = [(3000, i) for i in range(1, 2500)] + [(i, i + 1) for i in range(3001, 8000)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(8)
    got = {r["node"]: r["component"] for r in connected(frame).collect()}
    assert got == {**dict.fromkeys(range(1, 2500), 1), 3000: 1, **dict.fromkeys(range(3001, 8001), 3001)}


@pytest.mark.parametrize("edges", [[], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 60)],
                                   [(5, 9), (9, 7), (2, 3), (3, 2), (7, 100), (50, 100)]])
def test_components(spark, edges):
    got = {r["node"]: r["component"] for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges if e[0] != e[1] for x in e}
    for _ in range(len(edges)):
        for a, b in edges:
            if a != b:
                root[a] = root[b] = min(root[a], root[b])
    assert got == root


def test_small_tables_are_written_by_few_tasks(spark, monkeypatch):
    """As many shuffle partitions as a large session has: a table of some rows is not a file for each of them."""
    files = {}

    def counted(df, name, **options):
        table = stored(df, name, **options)
        files[name] = max(files.get(name, 0), len(table.inputFiles()))
        return table

    stored = common.stored
    for module in (nd, components, exact_dedup):
        monkeypatch.setattr(module, "stored", counted)
    sets = {"spark.sql.shuffle.partitions": "60", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in sets}
    try:
        for k, v in sets.items():
            spark.conf.set(k, v)
        rows = families(3)
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert run(df, nd.Rule())[0] == brute(rows, nd.Rule())
        groups = exact_dedup.exact_dedup(spark.createDataFrame([(i, f"text {i // 2}") for i in range(400)], "doc_id long, text string"))
        assert groups.agg({"group_size": "sum"}).first()[0] == 800
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    cores = spark.sparkContext.defaultParallelism
    assert {"star", "near-nodes", "near-seats", "near-links", "dedup-groups"} <= set(files)
    assert all(n <= cores for n in files.values()), files
