"""Hashed maximum-entropy language model with class-factored softmax, and unigram scores beside it."""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field, replace
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import id_and_text, lower_ascii, slices, store, texts

#: A token that no word can be: words have at least one byte.
END = b""
#: Listed tokens make up at least 1 / KNOWN of all tokens each, so there are at most KNOWN of them, of KNOWN_BYTES
#: bytes; that bounds what is broadcast. All others are looked up by a join, so no count is cut off.
KNOWN, KNOWN_BYTES = 1 << 20, 64
#: Classes: HEAD_CLASSES times MEMBERS most frequent tokens, and RARE_CLASSES for all others, by their last bytes.
HEAD_CLASSES, MEMBERS, RARE_CLASSES = 16, 32, 16
CLASSES = HEAD_CLASSES + RARE_CLASSES
BUCKETS = 1 << 13  # a power of two: remainders are taken by a mask
FEATURES = 3
ROUNDS = 2
STEP_TOKENS = 8192
RATE = 0.3
_FLUSH = 200_000
_BLOCK = 64  # rows of a weight table that travel together
TRAINER_TOKENS = 1 << 22  # about as many tokens of a round go to one trainer
_LN10 = math.log(10)
_LOW = 1e-20  # a sum of exponentials below this is too near the end of single precision


def tokens_of(text: str) -> list[bytes]:
    return [*lower_ascii(text.encode("utf-8", "surrogatepass")).split(), END]


def rare_class(token: bytes) -> int:
    return zlib.crc32(token[-2:]) % RARE_CLASSES


def with_split(df: DataFrame) -> DataFrame:
    """``held_out``: the CRC-32 of the id as text leaves the remainder 2 by 7; a null id counts as empty text."""
    code = F.crc32(F.encode(F.coalesce(F.col("id").cast("string"), F.lit("")), "utf-8"))
    return df.withColumn("held_out", F.pmod(code, F.lit(7)) == 2)


def count_tokens(source: DataFrame) -> DataFrame:
    """``(token, c)`` over all rows of ``source(text)``; tasks add up what they see before it is shuffled."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def out():
            return pa.record_batch({"token": pa.array(list(seen), pa.binary()), "c": pa.array(list(seen.values()), pa.int64())})

        for batch in (part for whole in batches for part in slices(whole)):
            for text in texts(batch):
                seen.update(tokens_of(text))
            if len(seen) > _FLUSH:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return source.select("text").mapInArrow(run, "token binary, c bigint").groupBy("token").agg(F.sum("c").alias("c"))


@dataclass
class Model:
    """What the tasks need: counts of the most frequent tokens, sums of the rest, and the weights."""

    known: dict[bytes, int]  # numbers by token, the most frequent first
    counts: np.ndarray
    tokens: int
    types: int
    rare_tokens: np.ndarray
    rare_types: np.ndarray
    class_weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, CLASSES), np.float32))
    class_bias: np.ndarray = field(default_factory=lambda: np.zeros(CLASSES, np.float32))
    word_weights: np.ndarray = field(default_factory=lambda: np.zeros((BUCKETS, MEMBERS), np.float32))
    word_bias: np.ndarray = field(default_factory=lambda: np.zeros((HEAD_CLASSES, MEMBERS), np.float32))

    def numbered(self, values: list[str]):
        """Of all texts' tokens, end to end: number (rare ones by class, after the known), text lengths, tokens."""
        lengths, flat = [], []
        for text in values:
            words = tokens_of(text)
            lengths.append(len(words))
            flat += words
        numbers = np.fromiter(map(self.known.get, flat, repeat(-1)), np.int64, len(flat))
        others = np.nonzero(numbers < 0)[0]
        numbers[others] = [KNOWN + rare_class(flat[k]) for k in others.tolist()]
        return numbers, np.array(lengths, np.int64), flat


HEAD = HEAD_CLASSES * MEMBERS
_START = KNOWN + RARE_CLASSES


def classes_of(numbers: np.ndarray, rare: np.ndarray) -> np.ndarray:
    """Class of each token; ``rare`` has the rare class of each known token."""
    return np.where(numbers < HEAD, numbers // MEMBERS, HEAD_CLASSES + np.where(numbers < KNOWN, rare[np.minimum(numbers, len(rare) - 1)], numbers - KNOWN))


def contexts(numbers: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Buckets (tokens, FEATURES) of the token before, the one before that, and both."""
    first = np.zeros(len(numbers), bool)
    first[np.cumsum(lengths)[:-1]] = True
    first[:1] = True
    before = np.roll(numbers, 1)
    before[first] = _START
    skip = np.roll(before, 1)
    skip[first] = _START

    def bucket(values, salt):
        x = (values.astype(np.uint64) + np.uint64(salt)) * np.uint64(0x9E3779B97F4A7C15)
        x ^= x >> np.uint64(29)
        x *= np.uint64(0xBF58476D1CE4E5B9)
        return (x >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)

    both = before * (_START + 1) + skip
    return np.stack([bucket(before, 1), bucket(skip, 1 << 20), bucket(both, 1 << 40)], axis=1)


def _word_rows(buckets: np.ndarray, classes: np.ndarray) -> np.ndarray:
    return (buckets * 31 + classes[:, None] * 7919) & (BUCKETS - 1)


def _softmax(values: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Value of column ``own`` of each row, and the exponentials of all in place, with their sums: log p is value - log(sum).

    All are taken less the largest value of the block, which is one pass; rows so far below it that their sum
    would lose digits are taken less their own largest.
    """
    shifted = values - values.max(initial=-np.inf)
    powers = np.exp(shifted, out=np.empty_like(shifted))
    sums = powers @ np.ones(values.shape[1], np.float32)
    picked = shifted[np.arange(len(own)), own]
    low = np.nonzero(sums < _LOW)[0]
    if len(low):
        again = values[low] - values[low].max(axis=1, keepdims=True)
        picked[low] = again[np.arange(len(low)), own[low]]
        powers[low] = np.exp(again)
        sums[low] = powers[low].sum(axis=1)
    return picked, powers, sums


def _masks(model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Minus infinity where no token is: members beyond the vocabulary, and head classes without members."""
    member = np.zeros((HEAD_CLASSES, MEMBERS), np.float32)
    member.reshape(-1)[min(len(model.known), HEAD) :] = -np.inf
    of_class = np.zeros(CLASSES, np.float32)
    empty = np.isinf(member).all(axis=1)
    of_class[:HEAD_CLASSES][empty] = -np.inf
    member[empty] = 0
    return of_class, member


def _logits(model: Model, masks, buckets, classes):
    """Logits of all classes, places of head tokens and their weights' rows, and logits of their class's members."""
    logits = model.class_weights.take(buckets[:, 0], axis=0)
    for k in range(1, FEATURES):
        logits += model.class_weights.take(buckets[:, k], axis=0)
    logits += model.class_bias + masks[0]
    head = np.nonzero(classes < HEAD_CLASSES)[0]
    own = classes[head]
    rows = _word_rows(buckets[head], own)
    words = (model.word_bias + masks[1]).take(own, axis=0)
    for k in range(FEATURES):
        words += model.word_weights.take(rows[:, k], axis=0)
    return logits, head, rows, words


def _softmaxes(model: Model, masks, buckets, numbers, classes):
    """Softmax over all classes, and over the members of each head token's class."""
    logits, head, rows, words = _logits(model, masks, buckets, classes)
    return _softmax(logits, classes), head, rows, _softmax(words, numbers[head] & (MEMBERS - 1))


def _outputs(model: Model, masks, buckets, classes):
    """Log probabilities of all classes, and of all members of each head token's class."""
    logits, head, rows, words = _logits(model, masks, buckets, classes)
    first = [np.zeros(len(v), np.int64) for v in (logits, words)]
    of_class, of_word = (np.log(p / sums[:, None]) for _, p, sums in map(_softmax, (logits, words), first))
    return of_class, head, rows, of_word


def _ascent(outputs, own: np.ndarray, scale: float) -> np.ndarray:
    """Gradient of the log probabilities of columns ``own``, times ``scale``."""
    _, powers, sums = outputs
    powers *= (-scale / sums)[:, None]
    powers[np.arange(len(own)), own] += scale
    return powers


def _descend(table: np.ndarray, seen: np.ndarray, touched: np.ndarray, rows: np.ndarray, grad: np.ndarray) -> None:
    """AdaGrad step on the rows that occur, with their gradients added up; ``rows`` has a column for each feature."""
    width = table.shape[1]
    added, places, flat = np.zeros(table.size, np.float32), np.arange(width), grad.reshape(-1)
    for column in rows.T:
        np.add.at(added, (column[:, None] * width + places).reshape(-1), flat)
    times = np.bincount(rows.reshape(-1), minlength=len(table))
    own = np.nonzero(times)[0]
    added = added.reshape(table.shape).take(own, axis=0)
    past = seen.take(own, axis=0) + added * added
    touched[own] += times[own]
    seen[own] = past
    table[own] += RATE * added / np.sqrt(past + 1e-6)


class Trainer:
    """One task's copy of the weights, updated with every step of its tokens."""

    def __init__(self, model: Model, rare: np.ndarray):
        self.before = {n: getattr(model, n) for n in ("class_weights", "class_bias", "word_weights", "word_bias")}
        # Unpickled arrays carry a type object of their own, for which numpy's add.at takes a path ten times as slow.
        self.tables = {n: table.astype(np.float32) for n, table in self.before.items()}
        self.model, self.rare, self.masks = replace(model, **self.tables), rare.astype(np.int64), _masks(model)
        self.seen = {n: np.full_like(t, 0.1) for n, t in self.tables.items()}
        self.touched = {n: np.zeros(len(np.atleast_2d(t)), np.float32) for n, t in self.tables.items()}

    def step(self, numbers: np.ndarray, buckets: np.ndarray) -> None:
        model = self.model
        classes = classes_of(numbers, self.rare)
        of_class, head, rows, of_word = _softmaxes(model, self.masks, buckets, numbers, classes)
        scale = 1.0 / math.sqrt(len(numbers))
        grad = _ascent(of_class, classes, scale)
        _descend(model.class_weights, self.seen["class_weights"], self.touched["class_weights"], buckets, grad)
        whole = grad.sum(axis=0)
        self.seen["class_bias"] += whole * whole
        model.class_bias += RATE * whole / np.sqrt(self.seen["class_bias"] + 1e-6)
        self.touched["class_bias"] += len(numbers)
        if len(head):
            grad = _ascent(of_word, numbers[head] % MEMBERS, scale)
            _descend(model.word_weights, self.seen["word_weights"], self.touched["word_weights"], rows, grad)
            _descend(model.word_bias, self.seen["word_bias"], self.touched["word_bias"], classes[head][:, None], grad)

    def updates(self) -> Iterator[tuple[str, int, bytes]]:
        """Blocks of rows: how far each has moved, weighted by how often it was touched, and that number."""
        for name, table in self.tables.items():
            moved = np.atleast_2d(table - self.before[name]).astype(np.float32)
            touched = self.touched[name]
            for at in range(0, len(moved), _BLOCK):
                times = touched[at : at + _BLOCK, None]
                if times.any():
                    yield name, at, np.hstack([moved[at : at + _BLOCK] * times, times]).astype(np.float32).tobytes()


def _added(group: pa.Table) -> pa.Table:
    """Sum of the blocks of one place, in the trainers' order."""
    group = group.sort_by("trainer")
    blocks = group.column("block").to_pylist()
    total = np.frombuffer(blocks[0], np.float32).astype(np.float64)
    for block in blocks[1:]:
        total += np.frombuffer(block, np.float32)
    first = group.slice(0, 1)
    return first.set_column(first.schema.names.index("block"), "block", pa.array([total.astype(np.float32).tobytes()], pa.binary()))


def _moves(trainer: Trainer, number: int, branches: int) -> pa.RecordBatch:
    rows = list(trainer.updates())  # each trainer has seen a row, and so an end, at least
    names, places, blocks = zip(*rows)
    return pa.record_batch({
        "name": list(names), "place": pa.array(places, pa.int32()),
        "branch": pa.array([number % branches] * len(rows), pa.int32()),
        "trainer": pa.array([number] * len(rows), pa.int32()), "block": pa.array(blocks, pa.binary()),
    })


def train(source: DataFrame, model: Model, rare: np.ndarray, rounds: int = ROUNDS) -> Model:
    """Rounds of distributed updates, each over its own part of the rows of ``source(id, text)``, all of them once.

    Rows are dealt by id and digest to a number of trainers that follows from the number of tokens, and sorted, so
    that neither cores nor files change the weights, and a trainer's share does not grow with the corpus (but for
    a row that is repeated many times, whose copies stream through one trainer). A trainer starts from the round's
    weights, steps through its tokens, and sends how far the rows it touched moved. Moves add up, weighted by
    touches, in a tree of tasks; the driver gets two tables of bounded size.
    """
    spark = source.sparkSession
    width = {"class_weights": CLASSES, "class_bias": CLASSES, "word_weights": MEMBERS, "word_bias": MEMBERS}
    schema = "name string, place int, branch int, trainer int, block binary"
    trainers = -(-max(1, model.tokens) // (rounds * TRAINER_TOKENS))
    branches = math.isqrt(trainers) + 1
    for turn in range(rounds):
        sent = spark.sparkContext.broadcast(vars(model))  # plain values: a broadcast is pickled by name

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trainer, number = None, -1
            for batch in (part for whole in batches for part in slices(whole)):
                marks = batch.column("trainer").to_numpy()
                cuts = [0, *(np.nonzero(np.diff(marks))[0] + 1).tolist(), len(marks)]
                for start, end in zip(cuts, cuts[1:]):
                    if trainer is None or marks[start] != number:
                        if trainer is not None:
                            yield _moves(trainer, number, branches)
                        trainer, number = Trainer(Model(**sent.value), rare), int(marks[start])
                    own, lengths, _ = trainer.model.numbered(texts(batch.slice(start, end - start)))
                    around = contexts(own, lengths)
                    for at in range(0, len(own), STEP_TOKENS):
                        trainer.step(own[at : at + STEP_TOKENS], around[at : at + STEP_TOKENS])
            if trainer is not None:
                yield _moves(trainer, number, branches)

        part = source.filter(F.pmod(F.xxhash64("id", "digest"), F.lit(rounds)) == turn)
        number = F.pmod(F.hash("id", "digest"), F.lit(trainers)).cast("int")
        dealt = part.select("id", "digest", "text", number.alias("trainer")).repartitionById(trainers, "trainer")
        dealt = dealt.sortWithinPartitions("trainer", "id", "digest")
        moves = dealt.select("trainer", "text").mapInArrow(run, schema)
        moves = moves.groupBy("name", "place", "branch").applyInArrow(_added, schema)
        moves = moves.groupBy("name", "place").applyInArrow(_added, schema)
        fresh = {n: getattr(model, n).copy() for n in width}
        for row in moves.collect():  # at most one row for each block of the two bounded tables
            block = np.frombuffer(row["block"], np.float32).reshape(-1, width[row["name"]] + 1)
            times = np.maximum(block[:, -1:], 1)
            table = np.atleast_2d(fresh[row["name"]])
            table[row["place"] : row["place"] + len(block)] += block[:, :-1] / times
        model = replace(model, **fresh)
        sent.unpersist()
    return model


def score_tokens(model: Model, rare: np.ndarray, masks, values: list[str]):
    """For each text: log10 of the model's factors but those of unlisted tokens, and the sums of listed counts.

    Returns rows of (tokens, known tokens, sum of log10(c + 1) over listed tokens, score so far, unlisted tokens with
    their frequencies).
    """
    numbers, lengths, flat = model.numbered(values)
    buckets = contexts(numbers, lengths)
    logs = np.empty(len(numbers))
    for at in range(0, len(numbers), STEP_TOKENS):
        some, around = numbers[at : at + STEP_TOKENS], buckets[at : at + STEP_TOKENS]
        classes = classes_of(some, rare)
        (of_class, _, class_sums), head, _, (of_word, _, word_sums) = _softmaxes(model, masks, around, some, classes)
        log = (of_class - np.log(class_sums)).astype(np.float64)
        log[head] += of_word - np.log(word_sums)
        scarce = np.nonzero(classes >= HEAD_CLASSES)[0]
        own = classes[scarce] - HEAD_CLASSES
        log[scarce] -= np.log(model.rare_tokens[own] + model.rare_types[own] + 1)
        logs[at : at + STEP_TOKENS] = log
    listed = np.log10(np.where(numbers < KNOWN, model.counts[np.minimum(numbers, len(model.counts) - 1)], 0) + 1)
    rare_listed = np.where((numbers >= HEAD) & (numbers < KNOWN), listed, 0.0)
    rows, at = [], 0
    for n in lengths.tolist():
        own = numbers[at : at + n]
        scarce = np.nonzero(own >= KNOWN)[0].tolist()
        tail = Counter(flat[at + k] for k in scarce)
        rows.append((
            n, n - len(scarce), float(listed[at : at + n].sum()),
            float(logs[at : at + n].sum() / _LN10 + rare_listed[at : at + n].sum()), list(tail.items()),
        ))
        at += n
    return rows


def fit(source: DataFrame, rounds: int = ROUNDS) -> tuple[Model, np.ndarray, DataFrame]:
    """Model, rare classes of its listed tokens, and the stored counts of ``source(id, digest, text)``."""
    counts = store(count_tokens(source), "lm-counts")
    sums = counts.agg(F.sum("c").alias("c"), F.count("*").alias("n")).first()
    # A filter and not a sort: each task sends only what it has of at most KNOWN tokens.
    listed_ones = (F.length("token") <= KNOWN_BYTES) & (F.col("c") * KNOWN >= F.lit(sums["c"] or 0))
    top = sorted(counts.filter(listed_ones).collect(), key=lambda r: (-r["c"], bytes(r["token"])))
    known = {bytes(r["token"]): k for k, r in enumerate(top)}
    listed, rare = np.zeros(len(top) + 1, np.int64), np.zeros(len(top) + 1, np.int64)
    for k, r in enumerate(top):
        listed[k], rare[k] = r["c"], rare_class(bytes(r["token"]))
    head = {w for w, k in known.items() if k < HEAD}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((RARE_CLASSES, 2), np.int64)
        for batch in batches:
            for w, c in zip(batch.column("token").to_pylist(), batch.column("c").to_pylist()):
                if w not in head:
                    sums[rare_class(w)] += (c, 1)
        yield pa.record_batch({"kind": pa.array(np.arange(RARE_CLASSES)), "c": pa.array(sums[:, 0].copy()), "n": pa.array(sums[:, 1].copy())})

    rest = counts.mapInArrow(run, "kind bigint, c bigint, n bigint").groupBy("kind").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))
    rare_tokens, rare_types = np.zeros(RARE_CLASSES), np.zeros(RARE_CLASSES)
    for row in rest.collect():  # one row for each rare class
        rare_tokens[row["kind"]], rare_types[row["kind"]] = row["c"], row["n"]
    model = Model(known, listed, sums["c"] or 0, sums["n"], rare_tokens, rare_types)
    return train(source, model, rare, rounds), rare, counts


def scores(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)`` of every row.

    Learns counts and weights from the rows that aren't held out, and scores all. A text is its words, A-Z
    lower-cased, and one end; a null text is its end alone. base_score is the add-one unigram score. score is the
    model's log10 probability: class given hashed features of the two tokens before, then the token within its
    class, by hashed features for frequent tokens and by add-one counts for all others. Tokens beyond the listed
    ones are looked up by a join on the token, so every count is used. Repeated rows are scored each by itself;
    with nothing to learn from all counts are 0. An empty table stays empty.
    """
    spark = df.sparkSession
    source = with_split(id_and_text(df, id_col, text_col)).withColumn("digest", F.md5(F.encode("text", "utf-8")))
    model, rare, counts = fit(source.filter("NOT held_out"), rounds)
    sent = spark.sparkContext.broadcast(vars(model))
    kind = source.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**sent.value)
        masks = _masks(model)
        for batch in (part for whole in batches for part in slices(whole)):
            n, known, listed, score, tails = zip(*score_tokens(model, rare, masks, texts(batch)))
            tail = pa.array(
                [[{"token": t, "tf": c} for t, c in row] for row in tails],
                pa.list_(pa.struct([("token", pa.binary()), ("tf", pa.int64())])),
            )
            yield pa.record_batch({
                "id": batch.column("id"), "held_out": batch.column("held_out"), "n_tokens": pa.array(n, pa.int64()),
                "n_listed": pa.array(known, pa.int64()), "listed": pa.array(listed), "so_far": pa.array(score), "tail": tail,
            })

    first = source.select("id", "held_out", "text").mapInArrow(
        run,
        f"id {kind}, held_out boolean, n_tokens bigint, n_listed bigint, listed double, so_far double, "
        "tail array<struct<token: binary, tf: bigint>>",
    )
    rows = store(first.withColumn("row", F.monotonically_increasing_id()), "lm-rows")
    tails = rows.select("row", F.explode("tail").alias("t")).select("row", "t.token", "t.tf")
    found = tails.join(counts, "token")  # a token without a count adds log10(0 + 1) = 0
    sums = found.groupBy("row").agg(F.sum(F.col("tf") * F.log10(F.col("c") + 1)).alias("more"), F.sum("tf").alias("n_more"))
    joined = rows.drop("tail").join(sums, "row", "left")
    more, n_more = F.coalesce("more", F.lit(0.0)), F.coalesce("n_more", F.lit(0).cast("bigint"))
    mass = math.log10(model.tokens + (model.types + 1))
    return joined.select(
        "id", "held_out", "n_tokens", (F.col("n_listed") + n_more).alias("n_known"),
        F.lit(model.tokens).cast("bigint").alias("train_tokens"),
        (F.col("listed") + more - F.col("n_tokens") * F.lit(mass)).alias("base_score"),
        (F.col("so_far") + more).alias("score"),
    )
