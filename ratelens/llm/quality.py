"""Line labelling of texts with a linear-chain conditional random field, and what it keeps."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import id_and_text, map_batches, texts
from ratelens.llm.crf import Chain, packed, train

CONTENT, BOILERPLATE = 0, 1
#: Bound of the labelled texts the field is fitted to, for each class; drawn by hash, whatever the corpus holds.
TRAIN_TEXTS = 500
TRAIN_LINES = 24  # longer texts give several training sequences
ROUNDS = 60
CONTENT_SHARE = 0.5
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
#: Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_SPACE = b" \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LOWER = bytes(range(97, 123))
_DIGIT = bytes(range(48, 58))
_BINS = (0.0, 0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.75, 1.01)
_SHARES = ("symbols", "marks", "upper", "digits", "fresh")
_WORDS = 10
N_FEATURES = len(_SHARES) * len(_BINS) + _WORDS + 12


def _without(data: bytes, characters: bytes) -> int:
    return len(data) - len(data.translate(None, characters))


def _bin(share: float) -> int:
    for k, edge in enumerate(_BINS):
        if share <= edge:
            return k
    return len(_BINS) - 1


def line_features(line: bytes, words: list[bytes], again: bool) -> tuple[int, ...]:
    """Numbers of the binary features of a line with words."""
    size = len(line)
    letters = len(words)
    shares = (
        _without(line, SYMBOLS) / size,
        _without(line, b"!?") / size,
        _without(line, _UPPER) / size,
        _without(line, _DIGIT) / size,
        1 - len(set(words)) / letters,
    )
    out = [k * len(_BINS) + _bin(share) for k, share in enumerate(shares)]
    base = len(_SHARES) * len(_BINS)
    out.append(base + min(_WORDS - 1, letters.bit_length()))
    base += _WORDS
    out.append(base + again)
    out.append(base + 2 + (line.rstrip()[-1:] in (b".", b"!", b"?")))
    out.append(base + 4 + min(7, int(_without(line, _SPACE) == 0) + 2 * min(3, (size // letters) // 5)))
    return tuple(out)


def base_counts(text: str):
    """(words, word characters, symbols, repeated lines, repeated words) and the lines as (line, words, again)."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    word_chars = len(text) - _without(data, _SPACE)
    seen: set[bytes] = set()
    lines, n_dup = [], 0
    for line in data.split(b"\n"):
        own = line.split()
        if own:
            again = line in seen
            n_dup += again
            seen.add(line)
            lines.append((line, own, again))
    return (len(words), word_chars, _without(data, SYMBOLS), n_dup, repeated_words(words)), lines


def repeated_words(words: list[bytes], width: int = WINDOW) -> int:
    """Words inside a window of ``width`` words that the text holds twice or more, its first place included."""
    if len(words) < 2 * 1 + width - 1:
        return 0
    windows = list(zip(*(words[k:] for k in range(width))))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple, int] = {}
    covered = np.zeros(len(words) + 1, np.int64)
    marked: set[int] = set()
    for at, window in enumerate(windows):
        start = first.setdefault(window, at)
        if start != at:
            for place in (start, at):
                if place not in marked:
                    marked.add(place)
                    covered[place] += 1
                    covered[place + width] -= 1
    return int(np.count_nonzero(np.cumsum(covered[:-1]) > 0))


def fit_lines(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
              per_class: int = TRAIN_TEXTS) -> Chain:
    """The field, fitted to lines of at most ``per_class`` labelled texts of each class.

    A text's label is taken for each of its lines; what good and bad texts share then counts for neither. So that
    labels also change inside a text, lines of each bad text are put into a good one, and the other way round, at
    places drawn by their ids. Texts are drawn by the hash of their ids, so the same table gives the same field. Labels that are null, or
    without a text, don't count; with one class missing the field calls every line content.
    """
    spread = F.xxhash64("id")
    named = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).dropna().distinct()
    chosen = [
        named.filter(F.col("label") == k).orderBy(spread, "id").limit(per_class) for k in (0, 1)
    ]
    # At most twice per_class rows of two numbers.
    drawn = F.broadcast(chosen[0].union(chosen[1]).withColumnRenamed("id", "drawn"))
    source = id_and_text(df, id_col, text_col)
    rows = source.join(drawn, source["id"] == drawn["drawn"]).select("id", "text", "label")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = []
        for text in texts(batch):
            found.append([list(line_features(*x)) for x in base_counts(text)[1]])
        kind = pa.list_(pa.list_(pa.int32()))
        return pa.record_batch({"id": batch.column("id").cast(pa.string()), "label": batch.column("label"), "lines": pa.array(found, kind)})

    sample = map_batches(rows, run, "id string, label int, lines array<array<int>>").collect()
    sample.sort(key=lambda r: (r["id"], r["label"]))
    sequences, truth = [], []
    for part, label in _training_texts([(r["id"], r["label"], [tuple(x) for x in r["lines"]]) for r in sample]):
        for at in range(0, len(part), TRAIN_LINES):
            sequences.append(part[at : at + TRAIN_LINES])
            truth.append(label[at : at + TRAIN_LINES])
    if len({row["label"] for row in sample}) < 2:
        sequences, truth = [], []
    return train(sequences, truth, N_FEATURES, 2, rounds=ROUNDS)


def _training_texts(sample: list[tuple[str, int, list]]) -> list[tuple[list, list[int]]]:
    """Lines and their labels of each text, and of texts in which a run of lines of the other class stands."""
    out = []
    kinds = [[(key, lines) for key, label, lines in sample if bool(label) == good and lines] for good in (False, True)]
    for (own, other), label in (((kinds[1], kinds[0]), CONTENT), ((kinds[0], kinds[1]), BOILERPLATE)):
        for k, (key, lines) in enumerate(own):
            out.append((lines, [label] * len(lines)))
            if not other:
                continue
            name, strange = other[k % len(other)]
            drawn = zlib.crc32(f"{key}:{name}".encode())
            size = 1 + drawn % min(len(strange), TRAIN_LINES // 2)
            begin = (drawn >> 8) % (len(strange) - size + 1)
            # Near the beginning, so that the change stands inside a training sequence.
            at = (drawn >> 16) % (min(len(lines), TRAIN_LINES // 2) + 1)
            out.append((
                lines[:at] + strange[begin : begin + size] + lines[at:],
                [label] * at + [1 - label] * size + [label] * (len(lines) - at),
            ))
    return out


def judge(chain: Chain, lines: list[list[tuple]]) -> list[float]:
    """Share of each text's words that stand in lines decoded as content; 0 without words."""
    cache: dict[tuple, np.ndarray] = {}
    runs, weights = [], []
    for text in lines:
        rows = []
        for x in text:
            features = line_features(*x)
            row = cache.get(features)
            if row is None:
                row = cache[features] = chain.weights[list(features)].sum(axis=0)
            rows.append(row)
        runs.append(np.array(rows).reshape(-1, 2))
        weights.append(np.array([len(x[1]) for x in text], np.int64))
    shares = [0.0] * len(lines)
    some = [i for i, run in enumerate(runs) if len(run)]
    for chosen, emissions, lengths in packed([runs[i] for i in some]):
        decoded = chain.viterbi(emissions, lengths)
        for row, k in enumerate(chosen):
            words = weights[some[k]]
            shares[some[k]] = float(words[decoded[row, : len(words)] == CONTENT].sum() / words.sum())
    return shares


def quality(
    df: DataFrame, chain: Chain, id_col: str = "doc_id", text_col: str = "text", keep: bool = False,
    content_share: float = CONTENT_SHARE,
) -> DataFrame:
    """Counts and verdict of every row, or with ``keep`` the rows of ``df`` that pass, as they are.

    A text fails with fewer than 10 words, or with over 20 % of its words in repeated windows of five; else it is
    kept if at least ``content_share`` of its words are in lines that Viterbi decoding marks as content. A null
    text has no words and fails. Rows are judged one by one, so repeated rows get equal results; an empty
    table gives an empty result.
    """

    def verdicts(values: list[str]):
        counted = [base_counts(t) for t in values]
        shares = judge(chain, [lines for _, lines in counted])
        out = []
        for (counts, _), share in zip(counted, shares):
            failed = counts[0] < MIN_WORDS or 100 * counts[4] > MAX_REPEAT_PERCENT * counts[0]
            out.append((*counts, failed, not failed and share >= content_share, share))
        return out

    if keep:
        def passing(batch: pa.RecordBatch) -> pa.RecordBatch:
            return batch.filter(pa.array([v[6] for v in verdicts([t or "" for t in texts(batch, text_col)])], pa.bool_()))

        return map_batches(df, passing, df.schema, text_col)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = list(zip(*verdicts(texts(batch))))
        kinds = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()]
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "content_share"]
        return pa.record_batch(
            {"id": batch.column("id")} | {n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)}
        )

    source = id_and_text(df, id_col, text_col)
    return map_batches(
        source, run,
        f"id {source.schema['id'].dataType.simpleString()}, n_words bigint, word_chars bigint, n_symbols bigint, "
        "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, content_share double",
    )
