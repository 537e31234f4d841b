"""Jaccard join and cap filters against brute force."""

import random
import re

import numpy as np
import pytest
from cases import SCHEMA, documents, frame

from riskloom.llm import caps, jaccard_tree
from riskloom.llm.components import components
from riskloom.llm.jaccard_tree import family_links, jaccard_components, named_groups, possible_links, bitmap


def grouped(nodes, links):
    root = {n: n for n in nodes}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, size):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if len(found) < size:
        return frozenset([tuple(found)]) if found else frozenset()
    return frozenset(tuple(found[i:i + size]) for i in range(len(found) - size + 1))


def expected(rows, size, percent):
    sets = {r[0]: shingles(r[1], size) for r in rows}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and
             100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return {(i, len(sets[i]), c) for i, c in grouped(sets, links).items()}


@pytest.mark.parametrize(("size", "percent", "rows", "tokens"), [(4, 85, 4096, 1 << 21), (5, 80, 2, 1 << 21), (1, 60, 3, 40)])
def test_jaccard_components(spark, size, percent, rows, tokens):
    docs = documents()
    got = jaccard_components(frame(spark), shingle=size, percent=percent, family_rows=rows, family_tokens=tokens)
    assert {tuple(r) for r in got.collect()} == expected(docs, size, percent)


def test_jaccard_odd_tables(spark):
    assert jaccard_components(frame(spark, [])).collect() == []
    twice = [(1, "a b c d e f", "", "", 0)] * 2 + [(None, "a b c d e f", "", "", 0), (4, "a b c d e f", "", "", 0), (4, "other words here", "", "", 0)]
    got = sorted(map(tuple, jaccard_components(frame(spark, twice)).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, None), (4, 2, 1), (4, 1, 4)], key=str)


def test_a_link_across_the_end_of_a_crowded_group(spark):
    """The last two texts link, and every key they share is shared by two of the others, none of which links."""
    lines = """
w2280 w1313 w1314 w2839 w1991 w1471 w266 w1660 w1889 w1350 w686 w2587 w25 w2059 w1382 w590
w744 w2280 w1313 w113 w1991 w1464 w266 w1889 w686 w1370 w2059 w418 w2660 w2001 w2575 w1529
w744 w1314 w2839 w113 w1464 w1471 w1660 w1350 w1370 w2587 w25 w1785 w1909 w2634 w2370 w1560
w2025 w744 w2280 w887 w1313 w1201 w1314 w2839 w113 w1991 w1464 w1471 w266 w1660 w1889 w1350 w686 w1370 w2587 w25 w2059 w2821
w2025 w744 w2280 w887 w1313 w1201 w1314 w2839 w113 w1991 w1464 w1471 w266 w1660 w1889 w1350 w686 w1370 w2587 w25 w2059 w375
""".strip().splitlines()
    docs = [(i, t, "", "", 0) for i, t in enumerate(lines)]
    want = expected(docs, 1, 80)
    assert sorted(c for _, _, c in want) == [0, 1, 2, 3, 3]
    assert {tuple(r) for r in jaccard_components(frame(spark, docs), shingle=1, percent=80, family_rows=3).collect()} == want


def test_a_common_passage_makes_no_family(spark, monkeypatch):
    """Texts with a passage in common are sent to no comparison; near copies among them are found."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(60)]
    texts = [passage + [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(90, 110))] for _ in range(60)]
    texts += [[*t[:-6], *(f"other{i}" for i in range(6))] for t in texts[:5]]
    docs = [(i, " ".join(t), "", "", 0) for i, t in enumerate(texts)]
    sent, write = [], jaccard_tree.materialise
    monkeypatch.setattr(jaccard_tree, "materialise", lambda df, name: (sent.append(df) if name == "jaccard-needed" else None, write(df, name))[1])
    got = jaccard_components(frame(spark, docs), shingle=5, percent=80, family_rows=8)
    assert {tuple(r) for r in got.collect()} == expected(docs, 5, 80)
    assert sum(len(r["to"]) for df in sent for r in df.collect()) <= 20


def test_links_share_a_key_beyond_those_to_spare():
    """Of the keys that a set has in a size class, any set that it links with has more than it can spare."""
    rng = np.random.default_rng(9)
    least, seen = 1 << 62, 0
    for _ in range(400):
        percent = int(rng.choice([50, 80, 90]))
        n = int(rng.integers(1, 500))
        gone, new = (int(x) for x in rng.integers(0, n // 2 + 1, 2))
        tokens = rng.integers(0, 1 << 64, n + new, dtype=np.uint64)
        two = [np.unique(tokens[:n]), np.unique(tokens[gone:])]
        shared, whole = len(np.intersect1d(*two)), len(np.union1d(*two))
        if 100 * shared < percent * whole or shared == whole:
            continue
        keys, spare = [{}, {}], [{}, {}]
        for who, found, sets, level, most in jaccard_tree.finer_keys(np.concatenate(two), np.array([0, len(two[0]), len(two[0]) + len(two[1])]), percent):
            for i, k in zip(who.tolist(), found.tolist(), strict=True):
                keys[i].setdefault(k & 127, set()).add(k)
            for i, l, m in zip(sets.tolist(), level.tolist(), most.tolist(), strict=True):
                spare[i][l] = m
        at = max(min(spare[0]), min(spare[1]))  # the class of the larger set
        common = len(keys[0].get(at, set()) & keys[1].get(at, set()))
        least, seen = min(least, common - max(spare[0][at], spare[1][at])), seen + 1
    assert seen > 50 and least >= 1


def test_sets_posted_twice_keep_their_groups_apart(spark):
    """Pairs of near copies, each text in both of two partitions: no group of one pair meets another's."""
    postings = [(k, sid) for k in range(20) for sid in (2 * (k // 2), 2 * (k // 2) + 1)] * 2 + [(99, 7), (99, 7)]
    got = named_groups(spark.createDataFrame(postings, "key long, sid long")).collect()
    assert len(got) == 20 and len({r["key"] for r in got}) == 10
    rng = random.Random(8)
    texts = []
    for i in range(24):
        one = [f"p{i}w{rng.randrange(10**6)}" for _ in range(30)]
        texts += [" ".join(one), " ".join([*one[:-1], "other"])]
    halves = [spark.createDataFrame([(i + start, t, "", "", 0) for i, t in enumerate(texts)], SCHEMA).coalesce(1) for start in (0, 1000)]
    docs = [(i + start, t, "", "", 0) for start in (0, 1000) for i, t in enumerate(texts)]
    got = {tuple(r) for r in jaccard_components(halves[0].union(halves[1]), shingle=4, percent=85, family_rows=4).collect()}
    assert got == expected(docs, 4, 85) and len({c for _, _, c in got}) == 24


def test_packed_postings_equal_plain_groups(spark):
    """Groups of random postings, one key with most of them, whatever the buckets and however few are held at a time."""
    rng = np.random.default_rng(6)
    keys = np.where(rng.random(6000) < 0.4, 5, rng.integers(0, 1 << 48, 2500)[rng.integers(0, 2500, 6000)])
    postings = sorted({(int(k), int(s)) for k, s in zip(keys, rng.integers(-2**62, 2**62, 400)[rng.integers(0, 400, 6000)])})
    sets = {}
    for k, s in postings:
        sets.setdefault(k, set()).add(s)
    want = sorted(sorted(s) for s in {frozenset(s) for s in sets.values() if len(s) > 1})
    frame_ = spark.createDataFrame(postings + postings[::3], "key long, sid long").repartition(5)
    for buckets, held in ((1, 1 << 22), (7, 1 << 22), (3, 100)):
        got = {}
        for r in named_groups(frame_, buckets, held).collect():
            got.setdefault(r["key"], []).append(r["sid"])
        assert sorted(map(sorted, got.values())) == want
    assert named_groups(spark.createDataFrame([], "key long, sid long")).collect() == []


def test_families_keep_every_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 200, dtype=np.uint64)
    sets = []
    for _ in range(150):
        one = base.copy()
        change = rng.choice(200, rng.integers(0, 40), replace=False)
        one[change] = rng.integers(0, 2**63, len(change), dtype=np.uint64)
        sets.append(np.unique(one[rng.random(200) < rng.uniform(0.8, 1)]))
    full = [(i, j) for i in range(150) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 85 * len(np.union1d(sets[i], sets[j]))]
    want = grouped(range(150), full)
    assert full and len(set(want.values())) > 1
    assert grouped(range(150), family_links(sets, None, 85)) == want
    possible = grouped(range(150), possible_links([bitmap(s) for s in sets], [len(s) for s in sets], 85))
    assert all(possible[i] == possible[j] for i, j in full)


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 440)] + [(7, 7), (None, 3)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    assert got == grouped({x for p in real for x in p}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_cap_filters(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((40, 24))
    vectors = [(int(i), (centres[i % 40] + rng.standard_normal(24) * rng.choice([0.02, 0.1, 0.3])).tolist()) for i in range(400)]
    vectors += [(1000, vectors[5][1]), (1001, vectors[5][1]), (1001, vectors[5][1]), (1002, [x * 1e-200 for x in vectors[6][1]])]
    good = np.array([v for _, v in vectors])
    unit = good / np.abs(good).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    odd = [(2000, None), (2001, []), (2002, [0.0] * 24), (2003, [float("nan")] + [1.0] * 23), (2004, [None] + [1.0] * 23), (2005, [1.0]), (None, vectors[5][1])]
    df = spark.createDataFrame(vectors + odd, "vec_id long, embedding array<double>").selectExpr("*", "1 as rep", "2 as data", "3 as filter")
    close = [(a, b) for a, b in zip(*np.nonzero(unit @ unit.T >= 0.95)) if a < b]
    for rows in (4096, 12):
        got = caps.near_duplicates(df, filter_rows=rows).collect()
        assert len(got) == len(vectors) + len(odd)
        found = sum(r["n_links"] for r in got) // 2
        assert 0.9 * len(close) <= found <= len(close)
        for r in got:
            if r["vec_id"] is None or r["vec_id"] >= 2000:
                assert (r["n_links"], r["component_id"], r["kept"]) == (0, r["vec_id"], True)
            else:
                assert r["kept"] == (r["vec_id"] == r["component_id"])
        assert {r["component_id"] for r in got if r["vec_id"] in (5, 1000, 1001)} == {min(r["component_id"] for r in got if r["vec_id"] == 5)}
    assert caps.near_duplicates(df.limit(0)).count() == 0


def test_cap_filter_recall_at_the_threshold():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((400, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((400, 64))
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * side
    threshold = caps.fit_threshold(x, 224, 7)
    lists = [[set() for _ in range(400)] for _ in range(2)]
    for sets, unit in zip(lists, (x, y), strict=True):
        for row, f in zip(*caps.list_decode(unit, 224, 7, threshold), strict=True):
            sets[row].add(int(f))
    assert np.mean([bool(a & b) for a, b in zip(*lists, strict=True)]) >= 0.95


@pytest.mark.parametrize("codes", [224, 1000, 3000])
def test_cap_filter_recall_of_lopsided_vectors(codes):
    """A minority of 5% whose norm lies in one half of the dimensions meets its near copies too."""
    rng = np.random.default_rng(6)
    x = rng.standard_normal((800, 64))
    x[:40, 32:] = 0
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.standard_normal((800, 64))
    side[:40, 32:] = 0
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    y = 0.951 * x + np.sqrt(1 - 0.951**2) * side
    threshold = caps.fit_threshold(x, codes, 7)
    lists = [[set() for _ in range(800)] for _ in range(2)]
    for sets, unit in zip(lists, (x, y), strict=True):
        for row, f in zip(*caps.list_decode(unit, codes, 7, threshold), strict=True):
            sets[row].add(int(f))
    assert min(len(one) for sets in lists for one in sets) >= caps.LIST
    met = np.array([bool(a & b) for a, b in zip(*lists, strict=True)])
    assert met.mean() >= 0.95 and met[:40].mean() >= 0.85


def test_narrowing_lets_no_key_go(spark):
    from riskloom.llm.narrowing import may_have

    from pyspark.sql import functions as F

    keys = spark.range(0, 5000, 7).selectExpr("case when id = 7 then null else id end as k")
    found = spark.range(20000).selectExpr("case when id = 1 then null else id end as id").withColumn("hit", may_have(keys, F.col("id")))
    hits = {r["id"] for r in found.where("hit").collect()}
    assert {i for i in range(0, 5000, 7) if i != 7} <= hits and len(hits) < 800 and None not in hits
    assert found.where("hit is null").count() == 0
    assert spark.range(5).where(may_have(keys.limit(0), F.col("id"))).count() == 0


def test_narrowing_of_hashes_lets_no_key_go(spark):
    from riskloom.llm.narrowing import may_have_hashes

    keys = spark.sql("select xxhash64(id) as gram from range(0, 4000, 4)")
    every = spark.sql("select id, xxhash64(id) as h from range(4000)").toPandas()
    hit = may_have_hashes(keys)(every["h"].to_numpy().view(np.uint64))
    assert hit[every["id"].to_numpy() % 4 == 0].all() and hit.sum() < 1020
    assert not may_have_hashes(keys.limit(0))(np.arange(5, dtype=np.uint64)).any()
