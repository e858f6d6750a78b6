"""URL filter: rules by host and path, and naive Bayes over segmented words where no rule fits."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ratelens.llm.common import slices, store, texts

#: Rule and verdict. A rule is a host with its subdomains, and the beginning of a path.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
CLASSES = ("allow", "block")
#: A word of the unigram model has at most so many letters; a longer run of letters between tags is none.
WORD_LETTERS = 32
BUCKETS = 1 << 15  # tokens of the classifier are hashed
_UNIT = 1e9  # log likelihoods are added up as whole numbers, the same in any order
_FLUSH = 200_000
_TAG = re.compile(r"<[^>]*>")
_LETTERS = re.compile(r"[^\W\d_]+")
_PIECES = re.compile(r"[^\W\d_]+|[0-9]+")
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a URL; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    empty = F.lit("")
    return F.coalesce(F.translate(host, _UPPER, _LOWER), empty), F.coalesce(path, empty)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null where none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for name, decision in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rest = name.partition("/")
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(f"/{rest}")
        rule, verdict = F.when(fits, F.lit(name)).otherwise(rule), F.when(fits, F.lit(decision)).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame, text_col: str = "html") -> DataFrame:
    """``(word, c)`` of the runs of at most WORD_LETTERS letters between the tags of every page, lower-cased."""
    source = pages.select(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[str] = Counter()

        def out():
            some = [(w, c) for w, c in seen.items() if len(w) <= WORD_LETTERS]
            return pa.record_batch({"word": pa.array([w for w, _ in some], pa.string()), "c": pa.array([c for _, c in some], pa.int64())})

        for batch in (part for whole in batches for part in slices(whole)):
            for text in texts(batch):
                seen.update(_LETTERS.findall(_TAG.sub(" ", text).lower()))
            if len(seen) > _FLUSH:
                yield out()
                seen.clear()
        if seen:
            yield out()

    return source.mapInArrow(run, "word string, c bigint").groupBy("word").agg(F.sum("c").alias("c"))


class Segmenter:
    """Most probable words of a run of letters by Viterbi over a unigram model; ``total`` counts all its words."""

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1
        self.log = {w: math.log(c / total) for w, c in counts.items()}
        self.unknown = [math.log(1 / total) - n * math.log(26) for n in range(WORD_LETTERS + 1)]

    def split(self, run: str) -> list[str]:
        """Words of ``run``; of equally probable ones those with the shorter last word, and so on back."""
        best, back = [0.0], [0]
        for end in range(1, len(run) + 1):
            top, start = -math.inf, end - 1
            for size in range(1, min(end, WORD_LETTERS) + 1):
                score = self.log.get(run[end - size : end], self.unknown[size]) + best[end - size]
                if score > top:
                    top, start = score, end - size
            best.append(top)
            back.append(start)
        found, end = [], len(run)
        while end:
            found.append(run[back[end] : end])
            end = back[end]
        found.reverse()
        return found


def _parts(host: str, path: str) -> list[tuple[str, str]]:
    return [(mark, piece) for mark, text in (("h", host), ("p", path.lower())) for piece in _PIECES.findall(text)]


def pieces(named: DataFrame) -> DataFrame:
    """``(host, path, mark, piece)``: the runs of letters and of digits of each host (h) and path (p)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            found = [_parts(h, p) for h, p in zip(hosts, paths)]
            rows = pa.array(np.repeat(np.arange(len(found)), [len(f) for f in found]))
            marks, texts = ([x[k] for f in found for x in f] for k in range(2))
            yield pa.record_batch({
                "host": batch.column("host").take(rows), "path": batch.column("path").take(rows),
                "mark": pa.array(marks, pa.string()), "piece": pa.array(texts, pa.string()),
            })

    return named.mapInArrow(run, "host string, path string, mark string, piece string")


def segments(runs: DataFrame, counts: DataFrame) -> DataFrame:
    """``(piece, words)`` of distinct ``runs(piece)`` of letters, over the whole table ``counts(word, c)``.

    Every part of a run that may be a word meets its count by a join, so a run's task has the counts of its own words,
    and the number of all, however many words there are. A run has at most WORD_LETTERS parts a letter.
    """

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for run in batch.column("piece").to_pylist():
                own = sorted({run[a : a + n] for a in range(len(run)) for n in range(1, min(WORD_LETTERS, len(run) - a) + 1)})
                yield pa.record_batch({"piece": pa.array([run] * len(own), pa.string()), "word": pa.array(own, pa.string())})

    known = runs.mapInArrow(parts, "piece string, word string").join(counts, "word")
    known = known.groupBy("piece").agg(F.collect_list(F.struct("word", "c")).alias("known"))
    total = counts.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("total"))
    rows = runs.join(known, "piece", "left").withColumn("total", total.scalar())

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = []
            for run, known, total in zip(*(batch.column(c).to_pylist() for c in ("piece", "known", "total"))):
                words.append(Segmenter({k["word"]: k["c"] for k in known or ()}, total).split(run))
            yield pa.record_batch({"piece": batch.column("piece"), "words": pa.array(words, pa.list_(pa.string()))})

    return rows.mapInArrow(split, "piece string, words array<string>")


def url_tokens(named: DataFrame, counts: DataFrame) -> DataFrame:
    """``(host, path, bucket)``: a row for each token of each distinct ``named(host, path)``.

    Tokens are the words into which runs of letters are split, marked by where they stand, and numbers by their length.
    """
    found = store(pieces(named.select("host", "path").distinct()), "url-pieces")
    digits = F.col("piece").rlike("^[0-9]")
    words = store(segments(found.filter(~digits).select("piece").distinct(), counts), "url-segments")
    split = found.filter(~digits).join(words, "piece").select("host", "path", "mark", F.explode("words").alias("word"))
    numbers = found.filter(digits).select("host", "path", "mark", F.concat(F.lit("#"), F.length("piece").cast("string")).alias("word"))
    token = F.concat("mark", F.lit(":"), "word")
    return split.union(numbers).select("host", "path", F.pmod(F.crc32(F.encode(token, "utf-8")), F.lit(BUCKETS)).cast("int").alias("bucket"))


def fit(named: DataFrame, tokens: DataFrame) -> tuple[np.ndarray, float]:
    """Log odds of block against allow, in units of 1e-9, for each bucket, and those of the classes themselves.

    Every row of ``named(host, path, decision)`` that a rule decides is a labelled example; the driver gets at most
    two rows a bucket.
    """
    labelled = named.filter("decision IS NOT NULL").groupBy("host", "path", "decision").count()
    sums = tokens.join(labelled, ["host", "path"]).groupBy("decision", "bucket").agg(F.sum("count").alias("c"))
    table, prior = np.zeros((2, BUCKETS)), np.ones(2)
    for row in sums.collect():
        table[CLASSES.index(row["decision"]), row["bucket"]] = row["c"]
    for row in labelled.groupBy("decision").agg(F.sum("count").alias("c")).collect():
        prior[CLASSES.index(row["decision"])] += row["c"]
    likely = np.log((table + 1) / (table.sum(axis=1, keepdims=True) + BUCKETS))
    return np.rint((likely[1] - likely[0]) * _UNIT).astype(np.int64), round(float(np.log(prior[1] / prior[0])) * _UNIT)


def judge_urls(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", text_col: str = "html", rules=RULES) -> DataFrame:
    """``(id, host, path, rule, verdict)`` of every row.

    The longest rule that fits decides. Without one, multinomial naive Bayes does: it is trained on the rows that
    rules decide, over the words into which Viterbi splits hosts and paths, letters of any script. The unigram model
    has all words of all pages, none is too rare. A URL without words (null, or without ``://``) is allowed, and so are
    ties. Equal hosts and paths are split and scored once, so repeated rows get equal verdicts; an empty table stays
    empty.
    """
    url = F.col(f"`{url_col}`").cast("string")
    host, path = host_and_path(url)
    named = pages.select(F.col(f"`{id_col}`").alias("id"), host.alias("host"), path.alias("path"))
    rule, decision = rule_of(F.col("host"), F.col("path"), rules)
    named = store(named.withColumns({"rule": rule, "decision": decision}), "url-names")
    tokens = store(url_tokens(named, store(word_counts(pages, text_col), "url-words")), "url-tokens")
    odds, prior = fit(named, tokens)
    spark = pages.sparkSession
    # BUCKETS rows, whatever the table's size.
    weights = F.broadcast(spark.createDataFrame(list(enumerate(odds.tolist())), "bucket int, odds bigint"))
    open_ones = named.filter("decision IS NULL").select("host", "path").distinct()
    scored = tokens.join(open_ones, ["host", "path"]).join(weights, "bucket").groupBy("host", "path").agg(F.sum("odds").alias("odds"))
    blocked = scored.filter(F.col("odds") + F.lit(prior) > 0).select("host", "path", F.lit(CLASSES[1]).alias("judged"))
    verdict = F.coalesce("decision", "judged", F.lit(CLASSES[0])).alias("verdict")
    return named.join(blocked, ["host", "path"], "left").select("id", "host", "path", "rule", verdict)
