"""Prefix polynomial hashes of texts: span equality, common extensions and comparable fingerprints."""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ratelens.llm.common import id_and_text, slices, store

#: Two primes below 2^31: a sum of 2^32 terms below 2^31 stays below 2^63.
PRIMES = (2_147_483_647, 2_147_483_629)
BASES = (1_103_515_245, 1_664_525)
PLACES = 40  # a text's anchors are meant to be 1/PLACES of it apart, or down to half of that
WINDOW = 16  # code points before a place that decide whether it is an anchor
_BLOCK = 1 << 18  # places looked at together


class Powers:
    """Powers of the bases modulo the primes, extended as longer texts come."""

    def __init__(self, bases: tuple[int, ...]):
        self.bases = bases
        self.tables = [np.ones(1, np.uint64) for _ in PRIMES]

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            for k, (p, b) in enumerate(zip(PRIMES, self.bases)):
                table = self.tables[k]
                while len(table) < n:  # the powers so far, times the next power, are the following ones
                    ahead = np.uint64(pow(b, len(table), p))
                    table = np.concatenate([table, table * ahead % np.uint64(p)])
                self.tables[k] = table
        return self.tables


POWERS = Powers(BASES)
INVERSES = Powers(tuple(pow(b, -1, p) for p, b in zip(PRIMES, BASES)))


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHash:
    """Prefix sums of ``(c[i] + 1) * B^i`` modulo two primes; any span's hash is a difference of two of them."""

    def __init__(self, points: np.ndarray):
        self.n = len(points)
        values = points.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for p, table in zip(PRIMES, POWERS.upto(max(1, self.n))):
            sums = np.zeros(self.n + 1, np.uint64)
            np.cumsum(values * table[: self.n] % np.uint64(p), out=sums[1:])
            self.sums.append(sums)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """62-bit hashes of the spans, each shifted to the place 0, so that equal spans anywhere are equal."""
        out = np.zeros(len(start), np.uint64)
        for k, (p, back) in enumerate(zip(PRIMES, INVERSES.upto(self.n + 1))):
            raw = (self.sums[k][end] - self.sums[k][start]) % np.uint64(p) * back[start] % np.uint64(p)
            out |= raw << np.uint64(31 * k)
        return out

    def span(self, start: int, end: int) -> int:
        return int(self.spans(np.array([start]), np.array([end]))[0])

    def equal(self, start: int, other: PrefixHash, at: int, size: int) -> bool:
        return self.span(start, start + size) == other.span(at, at + size)

    def extension(self, start: int, other: PrefixHash, at: int) -> int:
        """Length of the longest common extension to the right of two places, by binary search."""
        low, high = 0, min(self.n - start, other.n - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low


def spacing(n: int) -> int:
    """Power of two that anchors of a text of ``n`` code points are about apart; 1 for short texts."""
    return 1 << max(0, (n // PLACES).bit_length() - 1)


def _candidates(hashed: PrefixHash, low: int, high: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Places from ``low`` to below ``high`` chosen by the WINDOW code points before them, and their grades."""
    p, back = np.uint64(PRIMES[0]), INVERSES.upto(hashed.n + 1)[0]
    end = np.arange(max(1, low - step // 4), high)  # repeats are looked for a quarter of the spacing back
    start = np.maximum(end - WINDOW, 0)
    mixed = (hashed.sums[0][end] - hashed.sums[0][start]) % p * back[start] % p * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(24)
    chosen = np.nonzero(mixed & np.uint64(step - 1) == 0)[0]
    places, mixed = end[chosen], mixed[chosen]
    order = np.argsort(mixed, kind="stable")
    again = (mixed[order][1:] == mixed[order][:-1]) & (np.diff(places[order]) <= step // 4)
    fresh = np.ones(len(places), bool)
    fresh[order[1:][again]] = False
    fresh &= places >= low
    rest = mixed[fresh] // np.uint64(step)
    grades = 1 + sum((rest & np.uint64((1 << k) - 1) == 0).astype(np.int64) for k in range(1, 8))
    return places[fresh], grades


def anchors(hashed: PrefixHash) -> tuple[np.ndarray, np.ndarray]:
    """Places within the text that its content chooses, ascending, and their grades.

    A place is an anchor if the hash of the WINDOW code points before it is divisible by the spacing, unless the same
    ones come a quarter of the spacing or less before it, as in texts that repeat themselves. Its grade is 1, and 1
    more for each further factor of two, up to 8, so a text's anchors at a coarser spacing are those of higher grades.
    Where none comes for two spacings there is one of grade 0. Anchors within a common prefix of two texts of one
    spacing are the same.
    """
    n, step = hashed.n, spacing(hashed.n)
    blocks = [_candidates(hashed, low, min(n, low + _BLOCK), step) for low in range(1, n, _BLOCK)]
    if not blocks:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    places, grades = (np.concatenate(parts) for parts in zip(*blocks))
    before = np.concatenate([[0], places])
    missing = (np.diff(before, append=n) - 1) // (2 * step)
    nth = np.arange(missing.sum()) - np.repeat(np.cumsum(missing) - missing, missing)
    filled = np.repeat(before, missing) + 2 * step * (nth + 1)
    places, grades = np.concatenate([places, filled]), np.concatenate([grades, np.zeros(len(filled), np.int64)])
    order = np.argsort(places)
    return places[order], grades[order]


class Print:
    """A text's fingerprint: its length and hash, and its prefix sums, modulo the first prime, at its anchors.

    Differences of the sums give the hash of any span between anchors, as in the whole prefix array.
    """

    __slots__ = ("n", "whole", "at", "grades", "sums")

    def __init__(self, points: np.ndarray):
        hashed = PrefixHash(points)
        self.n = len(points)
        self.whole = hashed.span(0, self.n)
        self.at, self.grades = anchors(hashed)
        self.sums = hashed.sums[0][self.at] % np.uint64(PRIMES[0])

    def data(self) -> bytes:
        """The fingerprint as bytes: length, hash, and of each anchor the sum, the step to it and its grade."""
        steps = np.diff(self.at, prepend=0) * 16 + self.grades
        width = ((2 * spacing(self.n) * 16 + 15).bit_length() + 7) // 8
        sums = self.sums.astype(">u4").view(np.uint8).reshape(-1, 4)
        steps = steps.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 8 - width :]
        return self.n.to_bytes(8, "big") + self.whole.to_bytes(8, "big") + np.hstack([sums, steps]).tobytes()

    def spans(self, bounds: np.ndarray, sums: np.ndarray) -> np.ndarray:
        """Hashes of the spans between successive bounds, each shifted to the place 0."""
        p = np.uint64(PRIMES[0])
        return (sums[1:] + p - sums[:-1]) % p * INVERSES.upto(int(bounds[-1]) + 1)[0][bounds[:-1]] % p

    def tails(self) -> np.ndarray:
        """Hashes of the spans from each anchor to the end, shifted to the place 0."""
        p = np.uint64(PRIMES[0])
        total = np.uint64(self.whole & ((1 << 31) - 1))
        return (total + p - self.sums) % p * INVERSES.upto(self.n + 1)[0][self.at] % p

    def chunks(self, low: int, high: int, grade: int) -> np.ndarray:
        """Hash and length, as one number, of each span between anchors of at least that grade, from low to high."""
        own = (self.grades >= grade) & (self.at >= low) & (self.at <= high)
        bounds = self.at[own]
        if len(bounds) < 2:
            return np.empty(0, np.uint64)
        return self.spans(bounds, self.sums[own]) << np.uint64(32) | np.diff(bounds).astype(np.uint64) & np.uint64((1 << 32) - 1)


_HEAD = 16


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many leading entries agree; they agree up to a length and no further, so it is a binary search."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[middle - 1] == b[middle - 1]:
            low = middle
        else:
            high = middle - 1
    return low


def _extension(places: np.ndarray, hashes: np.ndarray, others: np.ndarray, other_hashes: np.ndarray) -> int:
    """Longest common extension at places that both have, ascending: the last one at which the hashes agree."""
    common, own, far = np.intersect1d(places, others, assume_unique=True, return_indices=True)
    agreed = _agree(hashes[own], other_hashes[far])
    return int(common[agreed - 1]) if agreed else 0


def likeness(a: Print, b: Print) -> float:
    """Share of the longer text that spans between anchors have in common; 1 for equal texts.

    That is the longest common extension from both starts, that from both ends, and between them the spans from
    anchor to anchor that occur in both, wherever they are, as often as they do in both. Texts of other spacings
    are compared at the coarser one. One edit costs the span between the anchors beside it.
    """
    if a.n == b.n and a.whole == b.whole:
        return 1.0
    shorter, longer = min(a.n, b.n), max(a.n, b.n)
    if not shorter:
        return 0.0
    front = _extension(a.at, a.sums, b.at, b.sums)
    back = _extension((a.n - a.at)[::-1], a.tails()[::-1], (b.n - b.at)[::-1], b.tails()[::-1])
    shared = front + back
    if shared < shorter:
        steps = spacing(a.n), spacing(b.n)
        coarse = max(steps)
        grades = [coarse // step if len(set(steps)) > 1 else 0 for step in steps]
        spans = [
            Counter(p.chunks(front, p.n - back, g.bit_length()).tolist()) for p, g in zip((a, b), grades)
        ]
        shared += sum((span & (1 << 32) - 1) * times for span, times in (spans[0] & spans[1]).items())
    return min(shared, shorter) / longer


def edited(points: np.ndarray, following: np.ndarray) -> np.ndarray:
    """The last third of a text (rounded down) replaced by as many first code points of the next, or all it has."""
    cut = len(points) // 3
    return np.concatenate([points[: len(points) - cut], following[:cut]]) if cut else points


_OUT = (
    "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_head binary, edited_kept int, edited_rest binary, "
    "near_edited double, near_next double"
)
_WIDTH = len(_OUT.split(", "))


def _compared(points: np.ndarray, own: Print, following: np.ndarray, other: Print):
    if len(points) < 3:
        changed, changed_print = points, own
    else:
        changed = edited(points, following)
        changed_print = Print(changed)
    digest = hashlib.sha256(changed.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").encode("utf-8", "surrogatepass"))
    data, changed_data = own.data(), changed_print.data()
    # Both have the anchors up to the cut, which are stored once.
    size = min(len(data), len(changed_data)) - _HEAD
    differ = np.nonzero(np.frombuffer(data, np.uint8, size, _HEAD) != np.frombuffer(changed_data, np.uint8, size, _HEAD))[0] if size else []
    kept = int(differ[0]) if len(differ) else size
    return (
        own.n, digest.digest(), data, changed_data[:_HEAD], kept, changed_data[_HEAD + kept :], likeness(own, changed_print),
        likeness(own, other),
    )


def fingerprint_edits(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next)`` of every row.

    The next row is the one with the next smaller id, and after the smallest id the largest; equal ids follow
    their texts' digests, null ids come last. Rows are range-partitioned by id and stream through their partition
    once; a partition's last row waits for the first row of the next partition that has any. Only those two rows
    a partition meet in a join; the order of partitions is a window over one number a partition. A null text
    counts as empty; empty texts equal each other. A single row is its own next; an empty table stays empty.
    """
    source = id_and_text(df, id_col, text_col)
    kind = source.schema["id"].dataType.simpleString()
    order = [F.col("id").desc_nulls_last(), F.col("digest").asc()]
    placed = source.withColumn("digest", F.xxhash64("text")).repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        held = None
        for batch in (part for whole in batches for part in slices(whole)):
            rows = []
            for key, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
                points = code_points(text)
                own = Print(points)
                if held is None:
                    rows.append((key, *[None] * _WIDTH, "head", part, text))
                else:
                    rows.append((held[0], *_compared(*held[2:], points, own), "done", part, None))
                held = (key, text, points, own)
            yield _batch(rows, batch.schema.field("id").type)
        if held is not None:
            yield _batch([(held[0], *[None] * _WIDTH, "tail", part, held[1])], batch.schema.field("id").type)

    streamed = store(
        placed.select("id", "text").mapInArrow(run, f"id {kind}, {_OUT}, role string, part int, text string"), "print-rows"
    )
    tails = streamed.filter("role = 'tail'").select("id", "part", "text")
    # One number for each partition with rows, however many rows there are.
    parts = tails.select("part")
    following = parts.select(
        "part",
        F.coalesce(F.lead("part").over(Window.orderBy("part")), F.first("part").over(Window.orderBy("part"))).alias("next_part"),
    )
    heads = streamed.filter("role = 'head'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    waiting = tails.join(following, "part").join(heads, "next_part").select("id", "text", "next_text")

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, text, other in zip(*(batch.column(c).to_pylist() for c in ("id", "text", "next_text"))):
                points, other = code_points(text), code_points(other)
                own, far = Print(points), Print(other)
                rows.append((key, *_compared(points, own, other, far), None, None, None))
            yield _batch(rows, batch.schema.field("id").type).select(list(range(_WIDTH + 1)))

    columns = ["id", *[c.split()[0] for c in _OUT.split(", ")]]
    done = streamed.filter("role = 'done'").select(*columns)
    both = done.unionByName(waiting.mapInArrow(finish, f"id {kind}, {_OUT}"))
    kept = F.substring("fingerprint", F.lit(_HEAD + 1), F.col("edited_kept"))
    return both.select(
        "id", "n_chars", F.lower(F.hex("edited_sha256")).alias("edited_sha256"), F.lower(F.hex("fingerprint")).alias("fingerprint"),
        F.lower(F.hex(F.concat("edited_head", kept, "edited_rest"))).alias("edited_fingerprint"), "near_edited", "near_next",
    )


def _batch(rows: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
    names = ["id", *[c.split()[0] for c in _OUT.split(", ")], "role", "part", "text"]
    kinds = [kind, pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.float64(), pa.float64(), pa.string(), pa.int32(), pa.string()]
    columns = list(zip(*rows)) if rows else [[] for _ in names]
    return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)
