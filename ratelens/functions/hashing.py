"""Seeded, portable pseudo-random numbers derived from a row's id."""

from __future__ import annotations

import sys

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

# Functions that run in Python workers travel with the job.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

HASH_SPAN = 1 << 32
ONE_BLOCK = 55  # bytes of the longest message that fits one block of MD5


def seeded_hash(key: Column, seed: int = 42) -> Column:
    """Uniform bigint in [0, 2^32): the first eight hex digits of ``md5('seed:key')``."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


_SHIFTS = np.array([[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]).repeat(4, axis=0).ravel()
_SINES = np.floor(np.abs(np.sin(np.arange(1, 65))) * HASH_SPAN).astype(np.uint32)


def one_block(messages: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """Messages of at most ``ONE_BLOCK`` bytes, a row each, as blocks for :func:`md5_words`; zeros follow shorter ones."""
    count, size = messages.shape
    lengths = np.full(count, size) if lengths is None else lengths
    out = np.zeros((count, 64), np.uint8)
    out[:, :size] = messages
    out[np.arange(count), lengths] = 0x80
    out[:, 56:58] = (8 * lengths).astype("<u2").view(np.uint8).reshape(-1, 2)
    return out


def md5_words(blocks: np.ndarray) -> list[np.ndarray]:
    """The four runs of eight hex digits of many MD5 digests, as numbers."""
    words = np.ascontiguousarray(blocks.view("<u4").T)
    start = [np.full(len(blocks), v, np.uint32) for v in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)]
    a, b, c, d = start
    for i in range(64):
        if i < 16:
            f, g = d ^ (b & (c ^ d)), i
        elif i < 32:
            f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
        elif i < 48:
            f, g = b ^ c ^ d, (3 * i + 5) % 16
        else:
            f, g = c ^ (b | ~d), 7 * i % 16
        f = f + a + _SINES[i] + words[g]
        shift = np.uint32(_SHIFTS[i])
        a, d, c, b = d, c, b, b + ((f << shift) | (f >> (np.uint32(32) - shift)))
    return [(new + old).byteswap().astype(np.int64) for new, old in zip((a, b, c, d), start)]
