from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ratelens.llm import components, simhash, tiles


def plain_groups(n, linked):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if linked(i, j):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(n)]


def varied(seed=3):
    """Texts in families: each begins from a random one and is changed word by word."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(400)]
    out = []
    for _ in range(12):
        text = [rng.choice(words) for _ in range(rng.choice((3, 12, 60, 200)))]
        for _ in range(6):
            out.append(" ".join(text))
            text = list(text)
            for _ in range(max(1, len(text) // 60)):
                text[rng.randrange(len(text))] = rng.choice(words)
    rng.shuffle(out)
    return out


def test_hash_equals_the_definition():
    text = "One TWO thrée four  five"
    words = text.encode().lower().split()
    expected = [xxhash.xxh64_intdigest(b" ".join(words[k : k + 3]), 42) for k in range(3)]
    assert simhash.shingle_hashes(text, 3).tolist() == expected
    bits = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in expected) > 3)
    assert simhash.majority(np.array(expected, np.uint64)) == bits
    assert simhash.shingle_hashes("one two", 3).tolist() == [xxhash.xxh64_intdigest(b"one two", 42)]
    assert simhash.majority(simhash.shingle_hashes(" \n", 3)) == 0


def test_hash_equals_sparks(spark):
    row = spark.createDataFrame([("one two thrée",)], "t string").select(F.xxhash64("t")).first()
    assert np.uint64(simhash.shingle_hashes("one two thrée", 3)[0]).view(np.int64) == row[0]


def test_majority_of_many():
    hashes = np.random.default_rng(1).integers(0, 1 << 63, 1000, dtype=np.uint64)
    plain = sum(1 << b for b in range(64) if 2 * sum(int(h) >> b & 1 for h in hashes) > 1000)
    assert simhash.majority(hashes) == plain


def test_groups_equal_brute_force(spark):
    texts = varied()
    df = spark.createDataFrame([(k * 3, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    found = {r["id"]: r for r in simhash.near_duplicates(df, radius=4).collect()}
    prints = np.array([simhash.majority(simhash.shingle_hashes(t, 3)) for t in texts], np.uint64)
    roots = plain_groups(len(texts), lambda i, j: np.bitwise_count(prints[i] ^ prints[j]) <= 4)
    assert len(set(roots)) < len(texts)
    for k in range(len(texts)):
        assert found[3 * k]["component_id"] == 3 * roots[k]
        assert np.int64(found[3 * k]["fingerprint"]).view(np.uint64) == prints[k]


def test_dedup_equals_brute_force(spark):
    texts = varied(8)
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    roots = plain_groups(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()}
    assert kept == {k for k, root in enumerate(roots) if root == k}


@pytest.mark.parametrize("ratio", [None, 0.8])
def test_links_of_small_tiles_reach_the_same(spark, ratio):
    rng = np.random.default_rng(5)
    base = rng.integers(0, 1 << 62, 20)
    values = sorted({int(b) ^ (1 << int(k)) ^ (1 << int(j)) for b in base for k in rng.integers(0, 60, 8) for j in (k, k + 1)})
    sizes = [int(s) for s in rng.integers(50, 90, len(values))]
    df = spark.createDataFrame([(v, v, s) for v, s in zip(values, sizes)], "node bigint, w0 bigint, size bigint")
    links = tiles.tiled_links(df, ["w0"], 3, ratio, tile_rows=7)
    found = {r["node"]: r["root"] for r in components.components(links).collect()}

    def linked(i, j):
        near = bin(values[i] ^ values[j]).count("1") <= 3
        return near and (ratio is None or min(sizes[i], sizes[j]) >= ratio * max(sizes[i], sizes[j]))

    roots = plain_groups(len(values), linked)
    for k, value in enumerate(values):
        assert found.get(value, value) == values[roots[k]]


def test_components_of_a_chain(spark):
    n = 60
    links = [(k, k + 1) for k in range(n)] + [(200, 201), (5, 5)]
    df = spark.createDataFrame(links, "src bigint, dst bigint")
    found = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert found == {k: 0 for k in range(n + 1)} | {200: 200, 201: 200}


def below_the_likeness(seed=0):
    """Texts of one template that are just below the likeness to each other, and a few pairs just above it."""
    rng = random.Random(seed)
    template = [f"t{k}" for k in range(104)]
    out = []
    for pair in range(45):
        shared = [f"p{pair}w{k}" for k in range(4)] if pair % 3 == 0 else []
        for side in range(2):
            out.append(" ".join(template + shared + [f"o{pair}s{side}w{k}" for k in range(13 - len(shared))]))
    rng.shuffle(out)
    return out


def test_links_below_the_likeness_hide_none_above(spark):
    texts = below_the_likeness()
    sets = [set(simhash.shingle_hashes(t, 5).tolist()) for t in texts]
    pairs = [len(a & b) / len(a | b) for k, a in enumerate(sets) for b in sets[:k]]
    assert sum(x >= 0.8 for x in pairs) == 15 and sum(0.78 < x < 0.8 for x in pairs) == len(pairs) - 15
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id bigint, text string").repartition(4)
    roots = plain_groups(len(texts), lambda i, j: len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))
    kept = {r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()}
    assert kept == {k for k, root in enumerate(roots) if root == k}


@pytest.mark.parametrize("likeness", [0.3, 0.8])
def test_tile_pairs_confirm_a_forest(monkeypatch, likeness):
    """The links of a tile pair join what a comparison of all its sets joins, in blocks and tests of any size."""
    monkeypatch.setattr(tiles, "_BLOCK", 64)
    monkeypatch.setattr(tiles, "_TESTED", 50)
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 14, rng.integers(0, 12)).astype(np.uint64)) for _ in range(80)]
    side = [
        (np.arange(n, n + 40), rng.integers(0, 4, (40, 1)).astype(np.uint64), np.array([len(x) for x in sets[n : n + 40]]), sets[n : n + 40])
        for n in (0, 40)
    ]
    words = np.concatenate([side[0][1], side[1][1]])[:, 0].tolist()

    def linked(i, j):
        shared = len(np.intersect1d(sets[i], sets[j]))
        sizes = sorted((len(sets[i]), len(sets[j])))
        close = bin(words[i] ^ words[j]).count("1") <= 1 and sizes[0] >= likeness * sizes[1]
        return close and shared >= likeness * (sum(sizes) - shared)

    for right, same in ((side[1], False), (side[0], True)):
        src, dst = tiles.confirmed(side[0], right, 1, likeness, same)
        n = 40 if same else 80
        across = lambda i, j: linked(i, j) and (same or (i < 40) != (j < 40))
        assert all(across(i, j) for i, j in zip(src, dst))
        links = set(zip(src, dst)) | set(zip(dst, src))
        assert plain_groups(n, across) == plain_groups(n, lambda i, j: (i, j) in links)
        assert len(src) == n - len(set(plain_groups(n, across)))


def test_a_large_group_gives_a_forest(spark):
    """2,000 near copies: as many rows as nodes in each stored table, not as many as pairs."""
    rng = random.Random(1)
    base = [f"w{k}" for k in range(60)]
    texts = [" ".join([*base, f"x{k}", f"y{rng.random()}"]) for k in range(2000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    rows = {}
    stored = simhash.store

    def counting(frame, label):
        out = stored(frame, label)
        rows[label] = out.count()
        return out

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(simhash, "store", counting)
        assert [r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()] == [0]
    pairs = rows["near-sides"]
    assert rows["near-classes"] == 2000 and max(rows.values()) <= 2000 * (pairs + 1)
    assert rows["near-links"] < 2000 * (pairs + 1)


def test_layers_keep_the_nearest_links():
    a, b, d = np.array([1, 2, 1]), np.array([2, 3, 3]), np.array([2, 1, 1])
    kept, layer = tiles.layers(a, b, d, 1)
    assert sorted(kept.tolist()) == [1, 2] and layer.tolist() == [1, 1]
    kept, layer = tiles.layers(a, b, d, 2)
    assert kept.tolist()[2] == 0 and layer.tolist() == [1, 1, 2]
    nodes = [(i, j) for i in range(9) for j in range(i)]
    kept, _ = tiles.layers(*np.array(nodes).T, np.arange(len(nodes)), 8)
    assert len(kept) == len(nodes)


def test_edge_cases(documents, no_documents, clashing):
    found = simhash.near_duplicates(documents).collect()
    assert len(found) == 12
    by = {r["id"]: r for r in found}
    assert by[1]["component_id"] == by[2]["component_id"] == 1
    assert by[4]["fingerprint"] == by[5]["fingerprint"] == 0
    assert by[4]["component_id"] == by[5]["component_id"]
    assert simhash.near_duplicates(no_documents).collect() == []
    kept = simhash.drop_near_duplicates(documents)
    assert kept.columns == documents.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 6, 7, 8, 9, 10]
    assert simhash.drop_near_duplicates(no_documents).collect() == []
    again = simhash.drop_near_duplicates(clashing)
    assert again.columns == clashing.columns and again.count() == 8
