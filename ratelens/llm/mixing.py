"""Mixing sources to target weights by pivotal dependent rounding."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import map_batches, one_per_key, row_keys, store
from ratelens.operators.ranking import dense_row_number

WEIGHTS = (5, 2, 1)
TOTAL_SHARE, MOST_COPIES = 1.5, 2
GROUP_ROWS, FAN_IN = 4096, 64
SEED = 17


def word_counts(batch: pa.RecordBatch, name: str = "text") -> np.ndarray:
    """Words of each text, counted over the bytes of the whole batch at once."""
    column = batch.column(name).cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)[: offsets[-1]]
    space = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.ones(len(data), bool)
    before[1:] = space[:-1]
    before[offsets[:-1][offsets[:-1] < len(data)]] = True
    starts = np.concatenate([[0], np.cumsum(before & ~space)])
    return starts[offsets[1:]] - starts[offsets[:-1]]


def sizes(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """``(id, digest, source, size)`` of every row; size is the number of words, 0 for a null text."""
    named = df.select(
        F.col(f"`{id_col}`").alias("id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{source_col}`").cast("string").alias("source"),
    ).withColumn("digest", F.md5(F.encode("text", "utf-8")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counted = pa.array(word_counts(batch).astype(np.int64))
        return pa.record_batch({n: batch.column(n) for n in ("id", "digest", "source")} | {"size": counted})

    kind = named.schema["id"].dataType.simpleString()
    return map_batches(named.select("id", "digest", "source", "text"), run, f"id {kind}, digest string, source string, size bigint")


def targets(
    items: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: float = MOST_COPIES
) -> DataFrame:
    """``(rank, source, source_size, rows, target)`` of each source of ``items(source, size)``.

    Sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all sizes. A target stops
    at ``most`` times its source's size; the excess goes to the others by weight until none is above. Each
    round of that is one aggregate over the sources, however many there are.
    """
    per = items.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    ranked = dense_row_number(per, [F.col("source").asc_nulls_last()], output="rank")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1).cast("int"))
    ranked = store(ranked.withColumn("weight", weight), "mix-sources")
    whole = ranked.agg(F.sum("source_size").alias("words")).first()["words"] or 0
    each, stopped = 0.0, -1
    while True:
        capped = F.col("source_size") * F.lit(float(most)) <= F.col("weight") * F.lit(each)
        if stopped < 0:
            capped = F.lit(False)
        row = ranked.agg(
            F.sum(F.when(capped, 1).otherwise(0)).alias("n"),
            F.coalesce(F.sum(F.when(capped, F.col("source_size"))), F.lit(0)).alias("held"),
            F.coalesce(F.sum(F.when(~capped, F.col("weight"))), F.lit(0.0)).alias("free"),
        ).first()
        if row["n"] is None or row["n"] == stopped:
            break
        stopped = row["n"]
        if not row["free"]:
            break
        each = max(0.0, share * whole - most * row["held"]) / row["free"]
    target = F.least(F.col("source_size") * F.lit(float(most)), F.col("weight") * F.lit(each))
    return ranked.select("rank", "source", "source_size", "rows", target.alias("target"))


def _draw(*key) -> float:
    """A number in [0, 1) that depends on the key alone."""
    return int.from_bytes(hashlib.blake2b(repr(key).encode(), digest_size=7).digest(), "big") / (1 << 56)


def pivot(rows: list[tuple], level: int, last: bool) -> tuple[list[float], int | None]:
    """Pivotal rounding of ``(key, size, share)`` in the given order: shares, all integral but at most one.

    Two fractional shares meet at a time. Mass moves from one to the other, in words, until one of them is 0 or
    1; which way is drawn so that each share keeps its expectation. What stays fractional meets the next. The
    words that the shares stand for add up to the same before and after. With ``last``, the one left is drawn.
    """
    shares = [r[2] for r in rows]
    held: int | None = None
    for i, (key, size, share) in enumerate(rows):
        if not 0 < share < 1:
            continue
        if not size:
            shares[i] = float(_draw(SEED, "empty", key) < share)  # no words to move
            continue
        if held is None:
            held = i
            continue
        a, b = shares[held], share
        size_a = rows[held][1]
        up, down = min((1 - a) * size_a, b * size), min(a * size_a, (1 - b) * size)
        if _draw(SEED, level, rows[held][0], key) * (up + down) < down:
            a, b = a + up / size_a, b - up / size
            done = (1 - shares[held]) * size_a <= share * size
            shares[held], shares[i] = (1.0, b) if done else (a, 0.0)
        else:
            a, b = a - down / size_a, b + down / size
            done = shares[held] * size_a <= (1 - share) * size
            shares[held], shares[i] = (0.0, b) if done else (a, 1.0)
        for k in (held, i):
            if shares[k] < 1e-12 or shares[k] > 1 - 1e-12:
                shares[k] = float(round(shares[k]))
        open_ones = [k for k in (held, i) if 0 < shares[k] < 1]
        held = open_ones[0] if open_ones else None
    if last and held is not None:
        shares[held] = float(_draw(SEED, "last", rows[held][0]) < shares[held])
        held = None
    return shares, held


def made_up(rows: list[tuple], shares: list[float]) -> list[float]:
    """Integral shares whose words are near those of the fractional shares in ``rows``.

    The draw of the last fractional row may miss by its whole size. Rows that were fractional here change in a drawn
    order until the words that are missing or too many are fewer than any that could change has; that gives up some of
    each row's own expectation.
    """
    left = sum(size * (share - shares[i]) for i, (_, size, share) in enumerate(rows))
    other = float(left < 0)
    shares = list(shares)
    for i in sorted(range(len(rows)), key=lambda k: _draw(SEED, "made up", rows[k][0], k)):
        size = rows[i][1]
        if 0 < rows[i][2] < 1 and shares[i] == other and 0 < size <= abs(left) + 1e-6:
            shares[i] = 1 - other
            left += size if left < 0 else -size
    return shares


def _rounding(level: int, last: bool):
    """The rounding of one group of rows, as a function of its table."""

    def run(group: pa.Table) -> pa.Table:
        # Largest first: a large share becomes integral against the many after it, and what is left over is small.
        group = group.sort_by([("size", "descending"), ("digest", "ascending"), ("id", "ascending")])
        keys = zip(group.column("id").to_pylist(), group.column("digest").to_pylist())
        rows = list(zip(keys, group.column("size").to_pylist(), group.column("share").to_pylist()))
        shares, held = pivot(rows, level, last)
        if last:
            shares = made_up(rows, shares)
        done = np.ones(len(rows), bool)
        if held is not None:
            done[held] = False
        names = group.schema.names
        group = group.set_column(names.index("share"), "share", pa.array(shares, pa.float64()))
        return group.set_column(names.index("settled"), "settled", pa.array(done))

    return run


def mix(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = TOTAL_SHARE, most: int = MOST_COPIES,
) -> DataFrame:
    """``(id, digest, size, source_size, target, copies)`` for every row of ``df``.

    Each row of a source is due target / source_size copies. The whole part is sure; the fractional parts are
    rounded by pivotal sampling over a tree: groups of some thousands rows of one source, dealt by the id's hash,
    leave one fractional row each, and those meet again, 64 groups at a time, up to one row in each source. What its
    draw leaves open is made up by smaller ones, so a source's words differ from its target by little more than its
    smallest document, and a hot source is many groups. Draws
    depend on ids, digests and a seed: reruns agree, whatever the partitions. Null sources are a source of
    their own; null texts have size 0; repeated rows are rounded each by itself; an empty table stays empty.
    """
    items = store(sizes(df, id_col, text_col, source_col), "mix-items")
    sources = store(targets(items, weights, share, most), "mix-targets")
    due = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most)))).otherwise(0.0)
    parts = F.ceil(F.col("rows") / GROUP_ROWS)
    named = sources.select(F.col("source").alias("of"), "rank", "source_size", "target", parts.alias("parts"), due.alias("due"))
    state = items.join(named, items["source"].eqNullSafe(named["of"])).select(
        "id", "digest", "size", "source_size", "target", "rank",
        F.floor("due").alias("whole"), (F.col("due") - F.floor("due")).alias("share"),
        F.pmod(F.xxhash64("id", "digest"), F.col("parts")).alias("node"), F.lit(False).alias("settled"),
    )
    groups = sources.agg(F.max(parts)).first()[0] or 1
    schema = ", ".join(f"{name} {kind}" for name, kind in state.dtypes)
    level, settled = 0, []
    while True:
        last = groups <= 1

        state = store(state.groupBy("rank", "node").applyInArrow(_rounding(level, last), schema), "mix-level")
        settled.append(state if last else state.filter("settled"))
        if last:
            break
        level += 1
        groups = -(-groups // FAN_IN)
        state = state.filter("NOT settled").withColumn("node", F.floor(F.col("node") / FAN_IN).cast("bigint"))
    rounded = settled[0]
    for more in settled[1:]:
        rounded = rounded.union(more)
    copies = (F.col("whole") + F.round("share")).cast("bigint")
    return rounded.select("id", "digest", "size", "source_size", "target", copies.alias("copies"))


def mixed_rows(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The rows of ``df`` as often as ``mix`` takes them, with its columns; a row taken 0 times goes.

    Rows with equal id and text are taken together: one of them stands for all, as often as they are due in sum.
    """
    taken = mix(df, id_col, text_col, source_col, **options)
    times = taken.groupBy(F.col("id").alias("__mix_id"), F.col("digest").alias("__mix_digest"))
    times = times.agg(F.sum("copies").alias("__times")).filter("__times > 0")
    same = F.col("__id").eqNullSafe(F.col("__mix_id")) & (F.col("__digest") == F.col("__mix_digest"))
    found = one_per_key(row_keys(df, id_col, text_col)).join(times, same)
    copied = found.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("__times"))))
    return copied.select(*[F.col(f"`{c}`") for c in df.columns])
