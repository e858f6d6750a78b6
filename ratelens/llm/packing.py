"""Best-fit packing of texts into bins, where documents that conflict never share a bin."""

from __future__ import annotations

from bisect import bisect_left, insort

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import store
from ratelens.llm.mixing import sizes

CAPACITY = 2048
SHARD_ROWS = 8192
_BINS = 32  # low bits of an entry of the residual order, for the bin's number


class Bins:
    """Open bins in order of residual space, each with a bitmap of its sources and of its duplicate clusters."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.order: list[int] = []  # residual << 32 | bin
        self.sources: list[int] = []
        self.clusters: list[int] = []
        self.filled: list[int] = []

    def place(self, size: int, source: int, cluster: int) -> tuple[int, int]:
        """Bin and offset for an item: the tightest bin with room that has neither its source nor its cluster.

        ``source`` and ``cluster`` are bitmaps with the item's bit, or 0 without a conflict. The search begins at
        the tightest bin with room and goes on to the next larger residual until a bin is compatible; if none
        is, a bin opens.
        """
        order, sources, clusters = self.order, self.sources, self.clusters
        at = bisect_left(order, size << _BINS)
        low = (1 << _BINS) - 1
        for place in range(at, len(order)):
            number = order[place] & low
            if not (sources[number] & source or clusters[number] & cluster):
                del order[place]
                break
        else:
            number = len(self.filled)
            sources.append(0)
            clusters.append(0)
            self.filled.append(0)
        offset = self.filled[number]
        self.filled[number] += size
        sources[number] |= source
        clusters[number] |= cluster
        if self.filled[number] < self.capacity:
            insort(order, (self.capacity - self.filled[number]) << _BINS | number)
        return number, offset


def pack_shard(rows: list[tuple[str, str | None, int]], capacity: int):
    """``(cluster, source, size)`` of each item: for each, its pieces as (start, size, bin, offset), and the bins' fill.

    Whole capacities of an item fill bins of their own, which are negative; what remains is packed, larger ones
    first. Items without size get no bin.
    """
    sources: dict[str | None, int] = {}
    seen: dict[str, int] = {}
    for cluster, source, _ in rows:
        sources.setdefault(source, len(sources))
        seen[cluster] = seen.get(cluster, 0) + 1
    repeated = {c: k for k, c in enumerate(c for c, n in seen.items() if n > 1)}
    bins, own = Bins(capacity), 0
    pieces: list[list[tuple]] = [[] for _ in rows]
    for i, (_, _, size) in enumerate(rows):
        for part in range(size // capacity):
            own -= 1
            pieces[i].append((part * capacity, capacity, own, 0))
    for i in sorted(range(len(rows)), key=lambda i: (-(rows[i][2] % capacity), i)):
        cluster, source, size = rows[i]
        rest = size % capacity
        if rest:
            bit = 1 << repeated[cluster] if cluster in repeated else 0
            number, offset = bins.place(rest, 1 << sources[source], bit)
            pieces[i].append((size - rest, rest, number, offset))
    return pieces, bins.filled


def pack(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    capacity: int = CAPACITY, shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """``(id, start, size, bin, offset, filled)``: where each piece of each row's text goes; lengths in words.

    A bin holds at most ``capacity`` words, at most one piece of each source beside full pieces, and at most one
    text of each duplicate cluster (equal texts). Longer texts fill bins of
    their own and leave one piece to pack. Rows are dealt by hash to shards of about ``shard_rows`` rows, in which
    pieces are placed larger first into the tightest compatible bin; a hot source or cluster is spread over all
    shards. Every row has at least one line: a text without words, null included, has size 0 and a null bin. A
    null source is a source of its own. Repeated rows are one cluster. An empty table stays empty.
    """
    rows = store(sizes(df, id_col, text_col, source_col), "pack-items")
    shards = -(-rows.count() // shard_rows) or 1
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "digest"), F.lit(shards)))

    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("digest", "ascending"), ("id", "ascending"), ("source", "ascending")])
        shard = group.column("shard")[0].as_py()
        items = list(zip(*(group.column(c).to_pylist() for c in ("digest", "source", "size"))))
        pieces, filled = pack_shard(items, capacity)
        ids = group.column("id").to_pylist()
        out: dict[str, list] = {name: [] for name in ("id", "start", "size", "bin", "offset", "filled")}
        for key, parts in zip(ids, pieces):
            for start, size, number, offset in parts or [(0, 0, None, None)]:
                full = number is not None and number < 0
                name = None if number is None else f"{shard}-full-{-number}" if full else f"{shard}-{number}"
                total = None if number is None else capacity if full else filled[number]
                for column, value in zip(out.values(), (key, start, size, name, offset, total)):
                    column.append(value)
        kinds = {"id": group.schema.field("id").type, "bin": pa.string()}
        return pa.table({name: pa.array(values, kinds.get(name, pa.int64())) for name, values in out.items()})

    kind = rows.schema["id"].dataType.simpleString()
    return dealt.groupBy("shard").applyInArrow(
        run, f"id {kind}, start bigint, size bigint, bin string, offset bigint, filled bigint"
    )
