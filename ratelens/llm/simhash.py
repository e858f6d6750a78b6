"""SimHash fingerprints, their links within a radius, and near-duplicate removal."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import id_and_text, lower_ascii, map_batches, one_per_key, row_keys, store, texts
from ratelens.llm.components import components
from ratelens.llm.tiles import confirmed_links, near_nodes, tile_pairs, tiled_links

SEED = 42
#: Near-duplicate removal: five-word shingles, likeness 0.8, four 64-bit words. At likeness 0.8 a bit differs with
#: probability acos(0.8 / 0.9) / pi = 0.151, so 38.8 of 256 with deviation 5.7; 64 is more than four deviations above,
#: which leaves room for short texts, where few shingles decide a bit and more bits differ.
SHINGLE, LIKENESS, WORDS, RADIUS = 5, 0.8, 4, 64
_SUMMED = 255  # rows whose bits add up in one byte


def shingle_hashes(text: str, size: int) -> np.ndarray:
    """XXH64 of each shingle of ``size`` lower-cased words joined by a space, repeats included.

    A text with fewer words has its whole sequence as the only shingle; one without words has none.
    """
    words = lower_ascii(text.encode("utf-8", "surrogatepass")).split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= size:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - size + 1].tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(joined[s:e], SEED) for s, e in zip(starts, ends[size - 1 :].tolist())], np.uint64)


def mixed(hashes: np.ndarray) -> np.ndarray:
    """A further 64-bit hash of each hash."""
    x = hashes ^ (hashes >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def majority(hashes: np.ndarray) -> int:
    """The word whose bits are set in over half the hashes; zero without hashes."""
    n = len(hashes)
    if not n:
        return 0
    bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    if n > _SUMMED:
        whole = n // _SUMMED * _SUMMED
        sums = bits[:whole].reshape(-1, _SUMMED, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        sums += bits[whole:].sum(axis=0, dtype=np.int64)
    else:
        sums = bits.sum(axis=0, dtype=np.uint8).astype(np.int64)
    return int(np.packbits(2 * sums > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3) -> DataFrame:
    """``(id, fingerprint)`` of every row; the 64 bits as a signed long. A null text counts as empty: zero."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        prints = np.array([majority(shingle_hashes(t, size)) for t in texts(batch)], np.uint64)
        return pa.record_batch({"id": batch.column("id"), "fingerprint": pa.array(prints.view(np.int64))})

    source = id_and_text(df, id_col, text_col)
    return map_batches(source, run, f"id {source.schema['id'].dataType.simpleString()}, fingerprint bigint")


def near_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = 3, radius: int = 2
) -> DataFrame:
    """``(id, fingerprint, component_id)`` for every row of ``df``.

    Fingerprints link at ``radius`` or fewer differing bits; component_id is the smallest id reachable. Equal
    fingerprints are one node from the start, so a group of copies is compared once. Rows with a null id keep
    a row, and count as the smallest id only where no other is there; repeated rows stay repeated; an empty
    table gives an empty result.
    """
    prints = store(fingerprints(df, id_col, text_col, size), "simhash")
    nodes = store(prints.groupBy("fingerprint").agg(F.min("id").alias("first")), "simhash-nodes")
    links = tiled_links(
        nodes.select(F.col("fingerprint").alias("node"), F.col("fingerprint").alias("w0"), F.lit(0).cast("bigint").alias("size")),
        ["w0"], radius,
    )
    roots = components(links)
    # Nodes without a link are components of their own. The smallest id of a component is a plain aggregate.
    rooted = nodes.join(roots, nodes["fingerprint"] == roots["node"], "left").select(
        "fingerprint", "first", F.coalesce("root", "fingerprint").alias("root")
    )
    rooted = store(rooted, "simhash-rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    named = store(rooted.join(smallest, "root").select("fingerprint", "component_id"), "simhash-components")
    return prints.join(named, "fingerprint").select("id", "fingerprint", "component_id")


def _profiles(df: DataFrame, size: int, words: int) -> DataFrame:
    """``(id, digest, shape, size, w0...)``; shape names the set of shingles, size is their number."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        shapes, sizes, prints = [], [], []
        for text in texts(batch):
            hashes = np.unique(shingle_hashes(text, size))
            shapes.append(xxhash.xxh128_digest(hashes.tobytes()))
            sizes.append(len(hashes))
            row = []
            for _ in range(words):
                row.append(majority(hashes))
                hashes = mixed(hashes)
            prints.append(row)
        columns = np.array(prints, np.uint64).reshape(-1, words).view(np.int64)
        out = {
            "id": batch.column("id"), "digest": batch.column("digest"),
            "shape": pa.array(shapes, pa.binary()), "size": pa.array(sizes, pa.int64()),
        }
        return pa.record_batch(out | {f"w{k}": pa.array(columns[:, k].copy()) for k in range(words)})

    kind = df.schema["id"].dataType.simpleString()
    schema = f"id {kind}, digest string, shape binary, size bigint, " + ", ".join(f"w{k} bigint" for k in range(words))
    return map_batches(df.select("id", "digest", "text"), run, schema)


def shingle_sets(members: DataFrame, size: int) -> DataFrame:
    """``members(node, text)`` with the sorted distinct hashes of the text's shingles, as bytes, in place of the text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes = [np.unique(shingle_hashes(text, size)).tobytes() for text in texts(batch)]
        return pa.record_batch({"node": batch.column("node"), "hashes": pa.array(hashes, pa.binary())})

    return map_batches(members.select("node", "text"), run, "node bigint, hashes binary")


def drop_near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE,
    likeness: float = LIKENESS,
    words: int = WORDS,
    radius: int = RADIUS,
) -> DataFrame:
    """Rows of ``df`` without near duplicates: of each group, the row with the smallest id stays.

    Texts with equal shingle sets are one class. Classes link if their fingerprints (``words`` times 64 bits)
    differ in at most ``radius`` bits, their numbers of shingles allow the likeness, and their shingle sets have
    it; a group is what links connect. Fingerprints are compared first, tile by tile; then the shingle sets of classes
    with a candidate go to the tile pairs in which they have one, where likeness is tested exactly unless two classes
    are in one group already, and only a forest of the links comes out. Texts without words are one group; so are
    repeated rows. A null id sorts before others. Columns are those of ``df``; an empty table stays empty.
    """
    keyed = row_keys(df, id_col, text_col)
    source = id_and_text(df, id_col, text_col).withColumn("digest", F.md5(F.encode("text", "utf-8")))
    rows = store(_profiles(source, size, words), "near-rows")
    prints = [f"w{k}" for k in range(words)]
    first = F.min(F.struct(F.col("id").isNotNull().alias("known"), "id", "digest")).alias("first")
    classes = store(
        rows.groupBy("shape")
        .agg(first, *[F.first(c).alias(c) for c in ("size", *prints)])
        .withColumn("node", F.monotonically_increasing_id()),
        "near-classes",
    )
    tiles, sides = tile_pairs(classes, prints, radius, likeness)
    sides = store(sides, "near-sides")
    near = store(near_nodes(tiles, sides, words, radius, likeness), "near-nodes")
    heads = near.select("node").distinct().join(classes, "node")
    heads = heads.select("node", "size", *prints, F.col("first.id").alias("id"), F.col("first.digest").alias("digest"))
    same = source["id"].eqNullSafe(heads["id"]) & (source["digest"] == heads["digest"])
    members = source.join(heads, same).select("node", "text").dropDuplicates(["node"])
    sets = store(shingle_sets(members, size), "near-sets").join(heads.drop("id", "digest"), "node")
    links = store(confirmed_links(near, sets, prints, radius, likeness), "near-links")
    roots = components(links)
    kept = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    kept = kept.groupBy("root").agg(F.min("first").alias("first"))
    kept = kept.select(F.col("first.id").alias("__kept_id"), F.col("first.digest").alias("__kept_digest"))
    same = F.col("__id").eqNullSafe(F.col("__kept_id")) & (F.col("__digest") == F.col("__kept_digest"))
    found = one_per_key(keyed).join(kept, same, "left_semi")
    return found.select(*[F.col(f"`{c}`") for c in df.columns])
