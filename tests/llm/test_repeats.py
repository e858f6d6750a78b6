from __future__ import annotations

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from ratelens.llm import repeats


def plain(texts, length):
    """For each text the bytes that stay, and the number of removed runs."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((bytes(b for b, g in zip(d, gone) if not g), runs))
    return out


def corpus(seed=1, n=60):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda k: " ".join(word() for _ in range(k))
    shared = [text(rng.randint(5, 120)) for _ in range(6)]
    out = [None, "", "short", "word " * 300, "a" * 900, "ab" * 700]
    for _ in range(n):
        parts = [text(rng.randint(0, 80))]
        for _ in range(rng.randint(0, 3)):
            s = rng.choice(shared)
            a = rng.randrange(len(s))
            parts += [s[a : a + rng.randint(20, 600)], text(rng.randint(0, 30))]
        out.append(" ".join(parts))
    out += [out[10], out[10], out[11] + " again", "x " + out[12][5:]]
    return out


def check(spark, texts, **kwargs):
    rows = list(enumerate(texts))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    length = kwargs.get("length", repeats.LENGTH)
    found = {r["id"]: r for r in repeats.remove_repeats(df, **kwargs).collect()}
    assert len(found) == len(rows)
    for k, (kept, runs) in enumerate(plain(texts, length)):
        r = found[k]
        size = len((texts[k] or "").encode())
        assert (r["n_bytes"], r["n_removed"], r["n_spans"]) == (size, size - len(kept), runs), k
        assert bytes(r["kept"]) == kept and r["kept_sha256"] == hashlib.sha256(kept).hexdigest()
    return found


def test_equals_brute_force(spark):
    found = check(spark, corpus())
    assert sum(r["n_removed"] > 0 for r in found.values()) > 20 and any(r["n_removed"] == 0 for r in found.values())


@pytest.mark.parametrize("run", [3, 2048])
def test_one_anchor_in_many_shards(spark, run):
    """A line that all texts share, among other words: its anchors need several shards, whose windows are merged."""
    rng = random.Random(4)
    line = "the same line in each of them and then some more of it"
    texts = []
    for k in range(80):
        around = ["".join(rng.choice("ab") for _ in range(rng.choice((3, 4)))) for _ in range(4)]
        texts.append(f"{k * 7919 % 1000:04d}{around[0]} {line} {around[1]} {k * 104729 % 10000:05d}")
    found = check(spark, texts, length=60, anchor=16, run=run, shard=1000)
    assert sum(r["n_removed"] > 0 for r in found.values()) > 5


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(3)
    for n, letters in ((1, 2), (7, 1), (300, 2), (5000, 3), (9000, 1)):
        data = rng.integers(97, 97 + letters, n).astype(np.uint8)
        data[n // 2 : n // 2 + n // 4] = data[: n // 4]
        order, rank = repeats.suffix_array(data, 64)
        text = data.tobytes()
        assert sorted(order.tolist()) == list(range(n))
        cut = [text[i : i + 64] for i in order.tolist()]
        assert cut == sorted(cut)
        shared = repeats.common_prefixes(data, order, 64)
        for k in range(1, n, max(1, n // 500)):
            a, b = cut[k - 1], cut[k]
            same = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert shared[k] == same


def test_runs_hold_every_window_once():
    rng = np.random.default_rng(5)
    for data in (rng.integers(0, 3, 4000), np.zeros(3000), np.tile(rng.integers(0, 9, 37), 90)):
        data = data.astype(np.uint8)
        anchors, starts, counts, places = repeats.anchor_runs(data, 100, 20, 64)
        assert counts.max() <= 64 and starts[0] == 0
        assert (starts[1:] == starts[:-1] + counts[:-1]).all() and starts[-1] + counts[-1] == len(data) - 99
        hashes = repeats.span_hashes(data, 20)
        for a, s, c, p in zip(anchors.tolist(), starts.tolist(), counts.tolist(), places.tolist()):
            left = set()
            for w in range(s, s + c):
                inside = hashes[w : w + 81]
                assert np.uint64(inside.min()).view(np.int64) == a
                left.add(w + int(inside.argmin()))
            assert p == len(left)


def test_edge_cases(spark, documents, no_documents, clashing):
    assert repeats.remove_repeats(no_documents).collect() == []
    found = repeats.remove_repeats(documents).collect()
    again = repeats.remove_repeats(clashing).collect()
    key = lambda r: (r["id"] or 0, r["kept_sha256"])
    assert len(found) == 12 and sorted(found, key=key) == sorted(again, key=key)
    by = {r["id"]: r for r in found}
    assert by[1]["n_removed"] == by[1]["n_bytes"] == by[2]["n_removed"] and by[1]["n_spans"] == 1
    assert by[4]["n_bytes"] == by[5]["n_bytes"] == by[6]["n_removed"] == 0
    assert by[8]["n_removed"] == by[8]["n_bytes"] and by[9]["n_removed"] == by[9]["n_bytes"]  # periodic in themselves


@pytest.mark.parametrize("letters", ["ab", "abcdefgh", "\0a"])
def test_classes_of_windows_equal_brute_force(letters):
    """Long repeats that go on differently, where suffixes tie in front of them, and zero bytes at the end of a shard."""
    for seed in range(40):
        rng = random.Random(seed)
        text = lambda n: "".join(rng.choice(letters) for _ in range(n)).encode()
        shared = [text(rng.randint(250, 420)) for _ in range(3)]
        pieces = [text(rng.randint(0, 60)) + rng.choice(shared)[rng.randrange(50) :] + text(rng.randint(0, 60)) for _ in range(12)]
        pieces.append(b"\0" * 300)
        found, known = {}, {}
        for p, s, k in zip(*(x.tolist() for x in repeats.equal_windows(pieces, 200))):
            found.setdefault(k, set()).add((p, s))
        for p, piece in enumerate(pieces):
            for s in range(len(piece) - 199):
                known.setdefault(piece[s : s + 200], set()).add((p, s))
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, known.values())), seed


def test_zero_bytes(spark):
    rng = random.Random(2)
    text = lambda n: "".join(rng.choice("\0a") for _ in range(n))
    shared = [text(400) for _ in range(3)]
    texts = [text(rng.randint(0, 60)) + rng.choice(shared)[rng.randrange(50) :] + text(rng.randint(0, 60)) for _ in range(30)]
    check(spark, [*texts, "\0" * 700, "b" + "\0" * 400, "\0" * 199, "c" * 199 + "\0"])
