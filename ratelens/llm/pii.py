"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes."""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ratelens.llm.common import id_and_text, map_batches, texts
from ratelens.llm.crf import Chain, packed, train

KINDS = ("email", "ip", "card", "phone")
OTHER = len(KINDS)
#: The patterns of the base recognisers. The look-behind and possessive forms match the same
#: leftmost spans as ``[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)`` and so on, in time linear in the text.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
#: A word without any of these characters can't be personal data, neither in training nor in decoding.
_SIGNAL = re.compile(r"[0-9@+]")
_SPACES = " \t\n\x0b\x0c\r"
_EDGES = ".,;:!?\"'<>[]{}"

#: The labelled table: text with spans marked ``<kind>...</kind>``. Invented; no line stems from a corpus.
LABELLED = (
    "please call <phone>(456) 555-2186</phone> after nine",
    "phone <phone>(212) 555-0147</phone> or write",
    "her number is <phone>+1 (988) 555-2485</phone> and his is <phone>+44 20 7946 0958</phone>",
    "tel <phone>555-0199</phone> tel <phone>(303) 555-0112</phone>",
    "reach us at <phone>415-555-0133</phone> any time",
    "reach us at <phone>415.555.0134</phone> any time",
    "fax <phone>+49 30 5550 1234</phone> office",
    "mobile <phone>+33 6 55 50 12 34</phone> please",
    "dial <phone>+15550102233</phone> now",
    "call <phone>1-800-555-0150</phone> today",
    "write to <email>ann.lee@mail.example.com</email> soon",
    "<email>bob_17@example.org</email> and <email>kim.42@mail8.example.com</email>",
    "contact <email>info@example.net</email>, or come in",
    "mail <email>x.y-z@sub.domain.example</email> first",
    "sent from <email>root@localhost.localdomain</email>",
    "host <ip>192.168.10.24</ip> did not answer",
    "from <ip>42.144.35.254</ip> to <ip>10.0.0.1</ip>",
    "address <ip>8.8.4.4</ip>. and then",
    "server <ip>172.16.254.3</ip>, port 8080",
    "paid with <card>4944339490429605</card> in may",
    "card <card>4111 1111 1111 1111</card> expired",
    "card <card>5500-0000-0000-0004</card> expired",
    "number <card>378282246310005</card> on file",
    "visa <card>4279055890764913</card> was used",
    # Words with digits that are no personal data.
    "in 2024 there were 17 of them",
    "on 2023-11-05 at 10:30 we met",
    "between 1914 and 1918 or 1939 - 1945",
    "version 3.2.1 came after 3.2",
    "it costs 12.50 or 1,299.99 dollars",
    "order 00012345 has 3 items of 40 each",
    "page 12 and pages 100-120 of 300",
    "password=b7db7aa4a5fcc78305 was leaked",
    "token=7602ad27cf5550de1c st and",
    "about 95% of 1000000 people",
    "section 4.1 and figure 2 in chapter 11",
    "isbn 978-3-16-148410-0 is a book",
    "a + b = c and 1 + 1 = 2",
    "the c++ language and g++ 13",
    "meet @ noon @home",
    "id 1234567890 is not valid",
    "on 05/11/2023 or 11.05.2023 we left",
    "serial 9999999999999999 does not check",
    "the 3rd of 4 in 5th place at 6pm",
    "sha1 da39a3ee5e6b4b0d3255bfef95601890afd80709 of nothing",
    "x1 y2 z3 a4 b5",
    "room 101, floor 7, building 12b",
    "score 3-2 and 10-9 in 2019",
    "one two three four five",
    "the of and in with from by",
)


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _low_part(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or "0") <= 255


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def base_spans(text: str) -> list[list[tuple[int, int]]]:
    """Spans of each kind, leftmost and non-overlapping; a match that fails its check is dropped without a retry."""
    emails, done = [], 0
    if "@" in text:
        for m in _DOMAIN.finditer(text):
            start = m.start()
            while start > done and text[start - 1] in _LOCAL:
                start -= 1
            if start < m.start():
                emails.append((start, m.end()))
                done = m.end()
    if not _DIGIT.search(text):
        return [emails, [], [], []]
    ips = [m.span() for m in _IP.finditer(text) if all(map(_low_part, m.group().split(".")))]
    cards = []
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                cards.append(m.span())
    phones = []
    if "+" in text:
        phones = [m.span() for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m.group())) <= 15]
    return [emails, ips, cards, phones]


def shape(word: str) -> tuple[str, ...]:
    """Features of a word: its shape with runs collapsed, digit count, parts and marks."""
    core = word.strip(_EDGES)
    out, last = [], ""
    for c in core:
        kind = "d" if "0" <= c <= "9" else "x" if c.isalpha() else c
        if kind != last:
            out.append(kind)
            last = kind
    digits = _digits(core)
    n = len(digits)
    bucket = n if n <= 4 else 5 if n <= 6 else 7 if n <= 8 else 9 if n <= 12 else 13 if n <= 19 else 20
    features = [f"shape={''.join(out)}", f"digits={bucket}", f"only={len(core) == n}"]
    if "@" in core[1:]:
        features.append(f"at={'.' in core.partition('@')[2]}")
    if core[:1] in "+(":
        features.append(f"first={core[:1]}")
    if 13 <= n <= 19:
        features.append(f"luhn={luhn(digits) and not any(c.isalpha() for c in core)}")
    parts = core.split(".")
    if len(parts) == 4 and all(p.isascii() and p.isdigit() for p in parts):
        features.append(f"quad={all(map(_low_part, parts))}")
    if any(c.isalpha() for c in core):
        features.append("letters")
    groups = re.split(r"[-. ()]+", core.strip("()+"))
    if all(g.isascii() and g.isdigit() for g in groups):
        features.append("groups=" + "-".join(str(min(len(g), 5)) for g in groups))
    return tuple(features)


def item_features(words: list[str], at: int, before: str) -> list[str]:
    """A word's own features, with the shapes of the signal words beside it and the plain word before."""
    own = list(shape(words[at]))
    own.append("left=" + (shape(words[at - 1])[0] if at else "-"))
    own.append("right=" + (shape(words[at + 1])[0] if at + 1 < len(words) else "-"))
    if not at:
        own.append("cue=" + before)
    return own


def _words(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in re.finditer(r"[^ \t\n\x0b\x0c\r]+", text)]


def signal_runs(text: str) -> list[list[tuple[int, int]]]:
    """Runs of neighbouring words that hold a signal character, as lists of spans."""
    runs: list[list[tuple[int, int]]] = []
    end = -1
    size = len(text)
    for m in _SIGNAL.finditer(text):
        at = m.start()
        if at < end:
            continue
        start = at
        floor = max(end, 0)
        while start > floor and text[start - 1] not in _SPACES:
            start -= 1
        last = end
        end = at + 1
        while end < size and text[end] not in _SPACES:
            end += 1
        if runs and not text[last:start].strip(_SPACES):
            runs[-1].append((start, end))
        else:
            runs.append([(start, end)])
    return runs


def _before(text: str, start: int) -> str:
    end = start
    while end and text[end - 1] in _SPACES:
        end -= 1
    begin = end
    while begin and text[begin - 1] not in _SPACES:
        begin -= 1
    return text[begin:end].strip(_EDGES).lower()


class Tagger:
    """The fitted field with its feature numbers."""

    def __init__(self, numbers: dict[str, int], chain: Chain):
        self.numbers, self.chain = numbers, chain

    def spans(self, values: list[str]) -> list[list[list[tuple[int, int]]]]:
        """Spans that the field finds, by text and kind.

        A plain word is ``other`` whatever stands beside it, so the best labels of a text are those of its runs
        of signal words, each begun and ended by an ``other``; the runs are decoded in numpy batches.
        """
        runs, places = [], []
        chain, get = self.chain, self.numbers.get
        for k, text in enumerate(values):
            for run in signal_runs(text):
                words = [text[s:e] for s, e in run]
                cue = _before(text, run[0][0])
                rows = np.empty((len(words), OTHER + 1))
                for at in range(len(words)):
                    known = [n for n in map(get, item_features(words, at, cue)) if n is not None]
                    rows[at] = chain.weights[known].sum(axis=0)
                first = run[0][0] == 0 or not text[: run[0][0]].strip(_SPACES)
                rows[0] += 0 if first else chain.transitions[OTHER] - chain.start
                if text[run[-1][1] :].strip(_SPACES):
                    rows[-1] += chain.transitions[:, OTHER]
                runs.append(rows)
                places.append((k, run))
        out = [[[] for _ in KINDS] for _ in values]
        for chosen, emissions, lengths in packed(runs):
            decoded = chain.viterbi(emissions, lengths)
            for row, i in enumerate(chosen):
                k, run = places[i]
                labels = decoded[row, : len(run)].tolist()
                at = 0
                while at < len(run):
                    kind, stop = labels[at], at
                    while stop + 1 < len(run) and labels[stop + 1] == kind and kind == KINDS.index("phone"):
                        stop += 1
                    while stop + 1 < len(run) and labels[stop + 1] == kind and kind == KINDS.index("card"):
                        stop += 1
                    if kind != OTHER:
                        start, end = run[at][0], run[stop][1]
                        text = values[k]
                        while end > start and text[end - 1] in _EDGES:
                            end -= 1
                        while start < end and text[start] in _EDGES:
                            start += 1
                        if start < end:
                            out[k][kind].append((start, end))
                    at = stop + 1
        return out


def fit_tagger(labelled: tuple[str, ...] = LABELLED) -> Tagger:
    """The field fitted to a small labelled table; the same table gives the same weights."""
    numbers: dict[str, int] = {}
    sequences, labels, banned = [], [], []
    for line in labelled:
        text, spans, at = "", [], 0
        for m in re.finditer(r"<(\w+)>(.*?)</\1>", line):
            text += line[at : m.start()]
            spans.append((len(text), len(text) + len(m.group(2)), KINDS.index(m.group(1))))
            text += m.group(2)
            at = m.end()
        text += line[at:]
        words = _words(text)
        run_of = {span: (run, k) for run in signal_runs(text) for k, span in enumerate(run)}
        items, truth, never = [], [], []
        for s, e in words:
            kind = next((k for a, b, k in spans if s < b and e > a), OTHER)
            truth.append(kind)
            if (s, e) in run_of:
                run, k = run_of[(s, e)]
                features = item_features([text[a:b] for a, b in run], k, _before(text, run[0][0]))
                items.append(tuple(numbers.setdefault(f, len(numbers)) for f in features))
                never.append([])
            else:
                items.append(())
                never.append(list(range(OTHER)))
        sequences.append(items)
        labels.append(truth)
        banned.append(never)
    return Tagger(numbers, train(sequences, labels, len(numbers), OTHER + 1, rounds=120, penalty=2e-3, banned=banned))


def all_spans(values: list[str], tagger: Tagger):
    """(base spans, all spans) by text and kind: a span of the field is added where no base span overlaps it."""
    base = [base_spans(t) for t in values]
    added = tagger.spans(values)
    whole = []
    for own, more in zip(base, added):
        taken = sorted(s for spans in own for s in spans)
        found = []
        for kind, spans in enumerate(more):
            free = [x for x in spans if not any(a < x[1] and x[0] < b for a, b in taken)] if taken else spans
            found.append(sorted(own[kind] + free))
        whole.append(found)
    return base, whole


def joined(spans: list[list[tuple[int, int]]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, some in zip(KINDS, spans) for a, b in some)


def masked(text: str, spans: list[list[tuple[int, int]]]) -> str:
    """``text`` with each span, or what overlapping spans cover together, replaced by the first one's kind."""
    found = sorted((a, b, kind) for kind, some in zip(KINDS, spans) for a, b in some)
    out, done = [], 0
    for a, b, kind in found:
        if a >= done:
            out += [text[done:a], f"[{kind.upper()}]"]
        done = max(done, b)
    return "".join([*out, text[done:]]) if found else text


def personal_data(df: DataFrame, tagger: Tagger, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts of the base patterns' spans, their digest, and all spans of every row.

    Offsets are code points, ends exclusive. A null text counts as empty: no span, the digest of the empty
    string. Rows are judged one by one: repeated rows get equal results, an empty table an empty one.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, whole = all_spans(texts(batch), tagger)
        out = {"id": batch.column("id")}
        for k, kind in enumerate(KINDS):
            out[f"n_{kind}"] = pa.array([len(spans[k]) for spans in base], pa.int64())
        out["base_sha256"] = pa.array([hashlib.sha256(joined(s).encode()).hexdigest() for s in base], pa.string())
        out["spans"] = pa.array([joined(s) for s in whole], pa.string())
        return pa.record_batch(out)

    source = id_and_text(df, id_col, text_col)
    counts = ", ".join(f"n_{kind} bigint" for kind in KINDS)
    return map_batches(source, run, f"id {source.schema['id'].dataType.simpleString()}, {counts}, base_sha256 string, spans string")


def mask_personal_data(df: DataFrame, tagger: Tagger, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """``df`` with personal data in its texts replaced by ``[EMAIL]`` and so on; its number of characters follows.

    All rows and columns stay; a null text stays null and keeps its length as it is.
    """

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = texts(batch, text_col)
        whole = all_spans([t or "" for t in values], tagger)[1]
        clean = [None if t is None else masked(t, s) for t, s in zip(values, whole)]
        names = batch.schema.names
        columns = list(batch.columns)
        columns[names.index(text_col)] = pa.array(clean, batch.schema.field(text_col).type)
        if length_col in names:
            kind = batch.schema.field(length_col).type
            before = batch.column(length_col).to_pylist()
            columns[names.index(length_col)] = pa.array([b if t is None else len(t) for t, b in zip(clean, before)], kind)
        return pa.RecordBatch.from_arrays(columns, names=names)

    return map_batches(df, run, df.schema, text_col)
