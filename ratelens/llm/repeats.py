"""Bytes of repeated strings: suffix arrays of shards that anchors fill, merged where one anchor needs several shards.

Two equal strings of 200 bytes hold the same anchor, the short run of bytes in them with the smallest hash. Texts are cut
into windows with the same anchor, and only windows whose anchor occurs more than once can repeat. These, and not whole
texts, are dealt to shards by their anchor, so that equal strings meet without comparing shards with each other. An
anchor with more text than a shard holds is spread over several shards, whose sorted strings are merged.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import slices, store

LENGTH = 200
ANCHOR = 64  # bytes of an anchor; a window of LENGTH bytes has LENGTH - ANCHOR + 1 places for one
RUN = 2_048  # starts of windows in a row at most; longer runs (of periodic texts) are cut into several
SHARD = 1 << 21  # bytes of text in a shard, about
_LANES = 4_096
_SCAN = 1 << 20  # bytes of one text that are hashed at once
_BASE = 0x9E3779B97F4A7C15  # odd, so that its powers can be divided by modulo 2^64


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _inverse(x: int) -> int:
    return pow(x, -1, 1 << 64)


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def span_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of each ``size`` bytes in a row, from prefix sums of a polynomial modulo 2^64."""
    n = len(data)
    powers = _powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[:n], out=prefix[1:])
    back = np.full(n - size + 1, _inverse(_BASE), np.uint64)
    back[0] = 1
    return _spread((prefix[size:] - prefix[: n - size + 1]) * np.multiply.accumulate(back))


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` values in a row: least of blocks to the left and of blocks to the right."""
    n = len(values)
    blocks = -(-n // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchor_runs(data: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR, run: int = RUN):
    """Arrays ``(anchor, start, count, places)``: ``count`` windows of ``length`` bytes from ``start`` on have that anchor.

    Every window of the text is in one run. A window's anchor is a function of its bytes alone. Two equal windows of
    one run have their leftmost anchors at different places; ``places`` counts these, so an anchor with one place in
    all texts has no equal windows.
    """
    if len(data) < length:
        return tuple(np.empty(0, kind) for kind in (np.int64, np.int64, np.int32, np.int32))
    width = length - anchor + 1
    parts = []
    for first in range(0, len(data) - length + 1, _SCAN):
        hashes = span_hashes(data[first : first + _SCAN + length - 1], anchor)
        low = _sliding_min(hashes, width)
        at = np.arange(len(low))
        change = np.nonzero(low[1:] != low[:-1])[0] + 1
        begins = np.concatenate([[0], change])
        ends = np.concatenate([change, [len(low)]])
        if (ends - begins).max() > run:
            cut = [np.arange(b, e, run) for b, e in zip(begins.tolist(), ends.tolist())]
            begins = np.concatenate(cut)
            ends = np.concatenate([begins[1:], ends[-1:]])
        # The leftmost place of a window's anchor: the first place from the window's start on that has its hash.
        places = np.ones(len(begins), np.int32)
        held = np.nonzero(np.isin(hashes, low[begins]))[0]
        if len(held) > len(begins) or (ends - begins).max() > width:
            run_of = np.searchsorted(begins, at, side="right") - 1
            order = held[np.lexsort((held, hashes[held]))]
            keys = hashes[order]
            group = np.searchsorted(np.unique(keys), keys) * np.int64(len(hashes) + 1)
            wanted = np.searchsorted(np.unique(keys), low) * np.int64(len(hashes) + 1) + at
            left = order[np.searchsorted(group + order, wanted)]
            new = np.ones(len(left), bool)
            new[1:] = (left[1:] != left[:-1]) | (run_of[1:] != run_of[:-1])
            places = np.bincount(run_of[new], minlength=len(begins)).astype(np.int32)
        parts.append((low[begins].view(np.int64), begins + first, (ends - begins).astype(np.int32), places))
    return tuple(np.concatenate(x) for x in zip(*parts))


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """``(order, rank)`` of the suffixes of ``data`` by their first ``depth`` bytes or more; equal ones share a rank.

    Larsson and Sadakane's refinement: suffixes sorted by their first h bytes are groups; those of more than one are
    sorted again by the rank of what follows after h bytes, which doubles h. A group of one is never touched again.
    """
    n = len(data)
    padded = np.zeros(n + 8, np.uint64)
    padded[:n] = data
    key = np.zeros(n, np.uint64)
    for k in range(8):
        key = (key << np.uint64(8)) | padded[k : n + k]
    order = np.argsort(key, kind="stable").astype(np.int32)
    # A suffix that ends within the 8 bytes looks like one that goes on with zeros; the shorter sorts first.
    order = order[np.lexsort((np.where(order > n - 8, n - order, 9), key[order]))]
    ranked, short = key[order], order > n - 8
    heads = np.ones(n, bool)
    heads[1:] = (ranked[1:] != ranked[:-1]) | short[1:] | short[:-1]
    del key, ranked
    rank = np.empty(n, np.int32)
    rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n, dtype=np.int32), 0))
    h = 8
    while h < depth:
        single = heads.copy()
        single[:-1] &= heads[1:]
        at = np.nonzero(~single)[0]
        if not len(at):
            break
        group = rank[order[at]].astype(np.int64)
        follows = order[at].astype(np.int64) + h
        then = np.where(follows < n, rank[np.minimum(follows, n - 1)], -1).astype(np.int64)
        both = group * (n + 1) + then + 1
        again = np.argsort(both, kind="stable")
        order[at] = order[at][again]
        both = both[again]
        heads[at[1:]] = both[1:] != both[:-1]
        heads[at[0]] = True
        rank[order] = np.maximum.accumulate(np.where(heads, np.arange(n, dtype=np.int32), 0))
        h *= 2
    return order, rank


def common_prefixes(data: np.ndarray, order: np.ndarray, depth: int) -> np.ndarray:
    """How many first bytes, up to ``depth``, each suffix of ``order`` shares with the one before it; the first: 0.

    Kasai's walk goes through the text from left to right, as the next suffix shares at most one byte less. It is done
    in lanes: as many places of the text as there are lanes go on together, in numpy. Suffixes that share ``depth`` bytes
    are in any order, and those one byte on may be in the other one: there the walk starts anew, unless it meets the
    same pair again.
    """
    n = len(data)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    shared = np.zeros(n, np.int32)
    lane = -(-n // _LANES)
    i = np.arange(0, n, lane, dtype=np.int64)
    ends = np.minimum(i + lane, n)
    j = before[i].astype(np.int64)
    h = np.zeros(len(i), np.int64)
    while len(i):
        far = np.maximum(i, j) + h
        more = (j >= 0) & (h < depth) & (far < n)
        more &= data[np.minimum(i + h, n - 1)] == data[np.clip(j + h, 0, n - 1)]
        h += more
        done = ~more
        shared[i[done]] = h[done]
        tied = done & (h == depth)
        i += done
        h = np.where(done, np.maximum(h - 1, 0), h)
        going = i < ends
        if not going.all():
            i, ends, h, j, done, tied = (x[going] for x in (i, ends, h, j, done, tied))
        after = j + 1
        j[done] = before[i[done]]
        h[tied & (j != after)] = 0
    return shared[order]


def equal_windows(pieces: list[bytes], length: int):
    """``(piece, start, class)`` of every window of ``length`` bytes in ``pieces``; equal windows have equal classes."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    begins = np.cumsum(sizes) - sizes
    order, _ = suffix_array(data, length)
    shared = common_prefixes(data, order, length)
    classes = np.cumsum(shared < length)
    piece = np.searchsorted(begins, order, side="right") - 1
    start = order - begins[piece]
    inside = start + length <= sizes[piece]
    return piece[inside], start[inside], classes[inside]


def _spans(starts: np.ndarray) -> tuple[list[int], list[int]]:
    """Sorted whole numbers as runs: first ones and those after the last ones."""
    if not len(starts):
        return [], []
    cut = np.nonzero(np.diff(starts) > 1)[0]
    return starts[np.r_[0, cut + 1]].tolist(), (starts[np.r_[cut, len(starts) - 1]] + 1).tolist()


def _shard(group: pa.Table, length: int, ranges: int) -> pa.Table:
    """Rows ``(anchor, hash, starts, ends)`` of the windows of a shard that repeat, for texts that occur once; and rows
    ``(range, digests, anchors, hashes, starts)`` of windows to be held against the other shards of their anchor."""
    pieces = group.column("piece").to_pylist()
    anchors, hashes, n, splits = (group.column(c).to_numpy() for c in ("anchor", "hash", "n", "splits"))
    piece, start, classes = equal_windows(pieces, length)
    total = np.bincount(classes, weights=np.where(n[piece] > 1, 2, 1), minlength=1)
    again = (total[classes] > 1) & (n[piece] == 1)
    by = np.lexsort((start[again], piece[again]))
    own, at = piece[again][by], start[again][by]
    edges = np.searchsorted(own, np.arange(len(pieces) + 1))
    rows = [
        {"anchor": anchors[k], "hash": hashes[k], "starts": spans[0], "ends": spans[1]}
        for k, (a, b) in enumerate(zip(edges, edges[1:])) if b > a and (spans := _spans(at[a:b]))
    ]
    # One window of a class stands for all. Those that repeat in this shard are asked for too: others may equal them.
    _, firsts = np.unique(classes, return_index=True)
    firsts = firsts[splits[piece[firsts]] > 1]
    asked = [
        (hashlib.blake2b(pieces[p][s : s + length], digest_size=16).digest(), p, s)
        for p, s in zip(piece[firsts].tolist(), start[firsts].tolist())
    ]
    asked.sort()
    of_range: dict[int, list] = {}
    for row in asked:
        of_range.setdefault(int.from_bytes(row[0][:4], "big") * ranges >> 32, []).append(row)
    for number, some in of_range.items():
        at = [p for _, p, _ in some]
        rows.append({
            "range": number, "digests": b"".join(d for d, _, _ in some), "anchors": anchors[at].tolist(),
            "hashes": hashes[at].tolist(), "starts": [s for _, _, s in some],
        })
    return pa.Table.from_pylist(rows, _FOUND)


_FOUND = pa.schema([
    ("anchor", pa.int64()), ("hash", pa.int64()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())),
    ("range", pa.int64()), ("digests", pa.binary()), ("anchors", pa.list_(pa.int64())), ("hashes", pa.list_(pa.int64())),
])
_FOUND_TYPE = (
    "anchor bigint, hash bigint, starts array<int>, ends array<int>, "
    "range bigint, digests binary, anchors array<bigint>, hashes array<bigint>"
)


def merged(group: pa.Table) -> pa.Table:
    """Windows of a range of digests that several shards hold: each shard's sorted digests are searched in all of them."""
    lists = [np.frombuffer(d, "S16") for d in group.column("digests").to_pylist()]
    union = np.sort(np.concatenate(lists), kind="stable")
    out = {"anchor": [], "hash": [], "start": []}
    columns = [group.column(c).to_pylist() for c in ("anchors", "hashes", "starts")]
    for own, *values in zip(lists, *columns):
        shared = np.searchsorted(union, own, "right") - np.searchsorted(union, own, "left") > 1
        for name, x in zip(out, values):
            out[name].append(np.array(x, np.int64)[shared])
    return pa.table({name: pa.array(np.concatenate(x), pa.int64()) for name, x in out.items()})


def _runs(documents: DataFrame, length: int, anchor: int, run: int) -> DataFrame:
    """``(id, key, anchor, hash, start, count, places)`` of all runs of windows; ``hash`` names the run's bytes."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["id", "key", "anchor", "start", "count", "places", "hash"]
        for whole in batches:
            for batch in slices(whole, "data"):
                at, columns = [], []
                for k, text in enumerate(batch.column("data").to_pylist()):
                    anchors, starts, counts, places = anchor_runs(np.frombuffer(text, np.uint8), length, anchor, run)
                    if len(anchors):
                        ends = (starts + counts + length - 1).tolist()
                        digest = xxhash.xxh3_64_intdigest
                        hashes = [digest(text[s:e]) for s, e in zip(starts.tolist(), ends)]
                        at.append(np.full(len(anchors), k))
                        columns.append((anchors, starts, counts, places, np.array(hashes, np.uint64).view(np.int64)))
                if at:
                    rows = pa.array(np.concatenate(at))
                    found = [pa.array(np.concatenate(x)) for x in zip(*columns)]
                    yield pa.record_batch([*(batch.column(c).take(rows) for c in ("id", "key")), *found], names=names)

    kind = documents.schema["id"].dataType.simpleString()
    schema = f"id {kind}, key binary, anchor bigint, start bigint, count int, places int, hash bigint"
    return documents.select("id", "key", "data").mapInArrow(scan, schema)


def repeated_windows(
    documents: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, run: int = RUN, shard: int = SHARD
) -> DataFrame:
    """``(id, key, start, end)``: starts of windows of ``documents(id, key, data)`` whose bytes start anywhere else too."""
    runs = store(_runs(documents, length, anchor, run), "repeat-runs")
    often = runs.groupBy("anchor").agg(F.sum("places").alias("all_places")).filter("all_places > 1").select("anchor")
    runs = store(runs.join(often, "anchor"), "repeat-candidates")
    # Runs with the same bytes (anchor and hash are 128 bits of them) repeat as a whole. One of them stands for all.
    one = F.first(F.struct("id", "key", "start", "count", "places")).alias("one")
    kinds = store(runs.groupBy("anchor", "hash").agg(F.count("*").alias("n"), one), "repeat-kinds")
    # Others are compared, if their anchor has other bytes around it or another place in the same run.
    size = (F.col("one.count") + F.lit(length - 1)).cast("bigint")
    alone, inner = F.min("n").alias("least"), F.max("one.places").alias("places")
    groups = kinds.groupBy("anchor").agg(F.count("*").alias("kinds"), alone, inner, F.sum(size).alias("bytes"))
    groups = groups.filter("least = 1 AND (kinds > 1 OR places > 1)")
    groups = store(
        groups.select("anchor", "bytes", F.ceil(F.col("bytes") * 4 / shard).alias("splits")), "repeat-groups"
    )
    sums = groups.agg(
        F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
        F.coalesce(F.sum(F.when(F.col("splits") > 1, F.col("bytes"))), F.lit(0)).alias("spread"),
    ).first()
    shards, ranges = sums["bytes"] // shard + 1, (sums["spread"] >> 18) + 1
    wanted = kinds.join(groups, "anchor").select("anchor", "hash", "n", "splits", "one.id", "one.key", "one.start", "one.count")
    wanted = wanted.withColumnsRenamed({"id": "of", "key": "of_key"})
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    # Binary values are cut by bytes. Repeated rows of one id and text give the same piece once.
    piece = F.substring("data", (F.col("start") + 1).cast("int"), F.col("count") + F.lit(length - 1)).alias("piece")
    cut = documents.join(wanted, same).select("anchor", "hash", "n", "splits", piece).dropDuplicates(["anchor", "hash"])
    part = F.when(F.col("splits") > 1, F.pmod(F.col("hash"), F.col("splits"))).otherwise(F.lit(0))
    dealt = cut.withColumn("shard", F.pmod(F.xxhash64("anchor", part), F.lit(shards)))
    found = store(
        dealt.groupBy("shard").applyInArrow(lambda group: _shard(group, length, ranges), _FOUND_TYPE), "repeat-shards"
    )
    asked = found.filter("digests IS NOT NULL").select("range", "digests", "anchors", "hashes", "starts")
    across = asked.groupBy("range").applyInArrow(merged, "anchor bigint, hash bigint, start bigint")
    inside = found.filter("digests IS NULL").select(
        "anchor", "hash", F.explode(F.arrays_zip("starts", "ends")).alias("span")
    )
    partly = inside.select("anchor", "hash", F.col("span.starts").cast("bigint").alias("from"), F.col("span.ends").cast("bigint").alias("to"))
    partly = partly.union(across.select("anchor", "hash", "start", F.col("start") + 1))
    once = kinds.filter("n = 1").select("anchor", "hash", "one")
    partly = partly.join(once, ["anchor", "hash"]).select(
        "one.id", "one.key", (F.col("one.start") + F.col("from")).alias("start"), (F.col("one.start") + F.col("to")).alias("end")
    )
    many = kinds.filter("n > 1").select("anchor", "hash")
    wholly = runs.join(many, ["anchor", "hash"]).select("id", "key", "start", (F.col("start") + F.col("count")).alias("end"))
    return wholly.union(partly)


def covered(starts: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Maximal runs of bytes that windows of ``length`` bytes with these starts (from, to before) cover."""
    order = np.argsort(starts, kind="stable")
    begins, over = starts[order], np.maximum.accumulate(ends[order] + length - 1)
    new = np.ones(len(begins), bool)
    new[1:] = begins[1:] > over[:-1]
    at = np.nonzero(new)[0]
    return begins[at], over[np.append(at[1:], len(begins)) - 1]


def remove_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    anchor: int = ANCHOR,
    run: int = RUN,
    shard: int = SHARD,
) -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept_sha256, kept)`` for every row of ``df``.

    Texts are their UTF-8 bytes, a null text none. A byte goes if a string of ``length`` bytes that covers it starts
    anywhere else too, in the same text or another row's; rows with equal ids are different texts, and repeated
    rows repeat each other. Strings are judged on the input. ``kept`` are the bytes that stay, which may cut a character.
    Texts shorter than ``length`` keep all; an empty table gives an empty result.
    """
    data = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).cast("binary")
    documents = df.select(F.col(f"`{id_col}`").alias("id"), data.alias("data"))
    documents = documents.withColumn("key", F.unhex(F.md5("data")))
    found = repeated_windows(documents, length, anchor, run, shard)
    # As many spans as a text has room for; repeated rows have the same ones.
    spans = found.groupBy(F.col("id").alias("of"), F.col("key").alias("of_key")).agg(
        F.collect_set(F.struct("start", "end")).alias("spans")
    )
    same = F.col("id").eqNullSafe(F.col("of")) & (F.col("key") == F.col("of_key"))
    joined = documents.join(spans, same, "left").select("id", "data", "spans")

    def run_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, "data"):
                rows = []
                for text, known in zip(batch.column("data"), batch.column("spans")):
                    text = text.as_py()
                    begins, ends = [], []
                    if known.is_valid:
                        starts, stops = (known.values.field(k).to_numpy() for k in range(2))
                        begins, ends = (x.tolist() for x in covered(starts, stops, length))
                    kept = b"".join(text[a:b] for a, b in zip([0, *ends], [*begins, len(text)]))
                    rows.append((len(text), len(text) - len(kept), len(begins), hashlib.sha256(kept).hexdigest(), kept))
                columns = [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()))]
                yield pa.record_batch(
                    [batch.column("id"), *columns], names=["id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"]
                )

    kind = documents.schema["id"].dataType.simpleString()
    schema = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"
    return joined.mapInArrow(run_batch, schema)
