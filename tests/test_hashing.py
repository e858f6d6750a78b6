from __future__ import annotations

import hashlib

import numpy as np

from ratelens.functions.hashing import ONE_BLOCK, md5_words, one_block
from ratelens.operators import bootstrap


def test_many_digests_at_once_are_md5():
    rng = np.random.default_rng(1)
    for size in (0, 1, 9, ONE_BLOCK):
        messages = rng.integers(0, 256, (20, size)).astype(np.uint8)
        found = np.stack(md5_words(one_block(messages)), axis=1)
        assert ["".join(f"{w:08x}" for w in row) for row in found.tolist()] == [hashlib.md5(m.tobytes()).hexdigest() for m in messages]


def test_keys_longer_than_a_block_and_sums_of_nothing(spark):
    """Replicates of long keys are drawn like those of short ones; a sum without any value is NULL."""
    rows = [("k" * 70 + str(i), float(i), None) for i in range(30)]
    df = spark.createDataFrame(rows, "key string, v double, none double")
    got = {r["replicate"]: r for r in bootstrap.replicate_sums(df, ["key"], {"v": df["v"], "none": df["none"]}, 6, 9).collect()}
    assert sorted(got) == list(range(7)) and (got[0]["n"], got[0]["v"], got[0]["none"]) == (30, 435.0, None)
    cuts = bootstrap.poisson_cuts()
    for replicate in range(1, 7):
        block, j = divmod(replicate - 1, 4)
        drawn = [int(hashlib.md5(f"9:{block}:{k}".encode()).hexdigest()[8 * j : 8 * j + 8], 16) for k, _, _ in rows]
        weights = [sum(d >= cut for cut in cuts) for d in drawn]
        assert got[replicate]["n"] == sum(weights) and got[replicate]["v"] == sum(w * v for w, (_, v, _) in zip(weights, rows))
        assert got[replicate]["none"] is None
