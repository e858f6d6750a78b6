from __future__ import annotations

import difflib
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from ratelens.llm import crf, fingerprints, lm, pii, quality, tokens

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(df):
    return {r["id"]: r for r in df.collect()}


# Fingerprints


def test_any_span_and_extension():
    a = fingerprints.PrefixHash(fingerprints.code_points("xabcabcabdé"))
    b = fingerprints.PrefixHash(fingerprints.code_points("abcabz"))
    assert a.equal(1, b, 0, 5) and not a.equal(1, b, 0, 6)
    assert a.extension(1, b, 0) == 5
    assert a.extension(4, a, 1) == 5
    assert a.extension(10, b, 0) == 0
    assert a.span(3, 3) == 0


def test_likeness():
    def made(text):
        points = fingerprints.code_points(text)
        return fingerprints.Print(points)

    text = "".join(chr(97 + k * 7 % 26) for k in range(900))
    assert fingerprints.likeness(made(text), made(text)) == 1
    near = fingerprints.likeness(made(text), made(text[:600] + "Z" * 300))
    assert 0.58 <= near <= 2 / 3
    assert fingerprints.likeness(made(text), made("Z" * 10 + text[10:])) > 0.85
    assert fingerprints.likeness(made(text), made("Q" * 500)) == 0
    assert fingerprints.likeness(made(""), made("")) == 1
    assert fingerprints.likeness(made(""), made("a")) == 0


def _changed(text, *places):
    for at in places:
        text = text[:at] + ("#" if text[at] != "#" else "?") + text[at + 1 :]
    return text


def _made(text):
    return fingerprints.Print(fingerprints.code_points(text))


def test_likeness_of_texts_changed_at_both_ends():
    rng = random.Random(5)
    for size in (500, 5000, 5119, 5121, 40000):
        text = "".join(rng.choice("abcdefgh ") for _ in range(size))
        own = _made(text)
        for places in ((0, size - 1), (size // 100, size - size // 100), (size // 3, size // 2)):
            assert fingerprints.likeness(own, _made(_changed(text, *places))) > (0.9 if size == 5000 else 0.85)
        assert fingerprints.likeness(own, _made(_changed(text, size // 2))) > 0.9
        header = fingerprints.likeness(own, _made("A new header. " + text + " A new footer."))
        assert header > 0.75
        halves = _made(text[size // 2 :] + text[: size // 2])
        assert fingerprints.likeness(own, halves) > 0.85


@pytest.mark.parametrize("unit", ["a", "ab", "abcdefghijklmnop", "line\n"])
def test_likeness_of_texts_that_repeat_themselves(unit):
    text = (unit * 6000)[:6000]
    own = _made(text)
    assert len(own.at) <= 4 * 6000 / fingerprints.spacing(6000)
    assert fingerprints.likeness(own, _made(_changed(text, 5999))) > 0.85
    assert fingerprints.likeness(own, _made(text[:4000] + "Z" * 2000)) == pytest.approx(2 / 3, abs=0.06)


def test_likeness_counts_only_spans_that_both_texts_have():
    """Against the texts themselves: what is counted is in both, and no more than the shorter text has."""
    rng = random.Random(9)
    for turn in range(60):
        words = ["".join(rng.choice("abcd") for _ in range(rng.randint(1, 8))) for _ in range(400)]
        a = " ".join(words[: rng.randint(1, 400)])
        cut, other = rng.randint(0, len(a)), " ".join(rng.sample(words, rng.randint(0, 40)))
        b = a[:cut] + other + a[cut + rng.randint(0, 50) :]
        pa_, pb = _made(a), _made(b)
        found = fingerprints.likeness(pa_, pb)
        assert found == fingerprints.likeness(pb, pa_) and 0 <= found <= 1
        blocks = difflib.SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks()
        longest = sum(m.size for m in blocks) / max(len(a), len(b), 1)
        kept = (len(a) - 50) / max(len(b), 1)
        assert found <= max(longest, min(len(a), len(b)) / max(len(a), len(b), 1)) + 1e-9
        if len(a) > 400 and cut > 100 and len(a) - cut > 200 and kept > 0.9:
            assert found > 0.7


def test_anchors_of_a_common_prefix_are_the_same():
    rng = random.Random(2)
    text = "".join(rng.choice("abcdefgh") for _ in range(3000))
    own, other = _made(text), _made(text[:2000] + "".join(rng.choice("xyz") for _ in range(1000)))
    assert own.at[own.at < 1900].tolist() == other.at[other.at < 1900].tolist()
    sums = fingerprints.PrefixHash(fingerprints.code_points(text))
    for i, j in ((0, 3), (2, 7), (5, 6)):
        span = own.spans(own.at[[i, j]], own.sums[[i, j]])[0]
        assert int(span) == sums.span(int(own.at[i]), int(own.at[j])) & ((1 << 31) - 1)


def test_edits_equal_brute_force(spark):
    rows = [(k, ("text é %d " % (k % 5)) * (k * 7 % 23)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)
    found = by_id(fingerprints.fingerprint_edits(df))
    for at, (key, text) in enumerate(rows):
        following = rows[at - 1][1]
        cut = len(text) // 3
        edited = text[: len(text) - cut] + following[:cut]
        row = found[key]
        assert row["n_chars"] == len(text)
        assert row["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert (row["near_edited"] == 1) == (edited == text)
        assert (row["fingerprint"] == row["edited_fingerprint"]) == (edited == text)


def test_fingerprint_edges(documents, no_documents, clashing):
    rows = fingerprints.fingerprint_edits(documents).collect()
    assert len(rows) == 12
    found = {r["id"]: r for r in rows}
    assert found[1]["fingerprint"] == found[2]["fingerprint"] != found[3]["fingerprint"]
    assert found[4]["fingerprint"] == found[5]["fingerprint"] and found[4]["n_chars"] == 0
    assert found[None]["near_edited"] < 1
    assert fingerprints.fingerprint_edits(no_documents).collect() == []
    one = fingerprints.fingerprint_edits(documents.filter("doc_id = 7")).first()
    assert one["near_next"] == 1
    assert fingerprints.fingerprint_edits(clashing).count() == 12


# Quality


def plain_counts(text):
    text = text or ""
    words = WORDS.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORDS.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[k : k + 5]) for k in range(len(words) - 4))
    covered = set()
    for k in range(len(words) - 4):
        if windows[tuple(words[k : k + 5])] > 1:
            covered |= set(range(k, k + 5))
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, len(covered)


GOOD = "This is{k} line {k} of a{k} plain text. It{k} says a little{k} about many things{k}, and ends with{k} a mark."
BAD = "BUY!! NOW!! $$$ {k} | | | *** CLICK!! HERE!! %%% ### &&& WIN!!"


@pytest.fixture(scope="module")
def chain(spark):
    rows = [(k, "\n".join((GOOD if k % 2 else BAD).format(k=k * 10 + j) for j in range(6))) for k in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)] + [(1, None), (99, 1)], "doc_id bigint, quality int")
    return quality.fit_lines(df, labels)


def test_counts_equal_brute_force(documents, chain):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    for row in quality.quality(documents, chain).collect():
        n, chars, symbols, dup, repeat = plain_counts(texts[row["id"]])
        assert (row["n_words"], row["word_chars"], row["n_symbols"], row["n_dup_lines"], row["n_repeat_words"]) == (n, chars, symbols, dup, repeat)
        assert row["base_failed"] == (n < 10 or 100 * repeat > 20 * n)
        assert not (row["base_failed"] and row["kept"])


def test_lines_are_told_apart(spark, chain, no_documents, clashing):
    good, bad = ("\n".join(t.format(k=j) for j in range(900, 906)) for t in (GOOD, BAD))
    df = spark.createDataFrame([(1, good, 5), (2, bad, 5), (3, None, 5), (4, good + "\n" + bad, 5)], "doc_id bigint, text string, kept int")
    kept = quality.quality(df, chain, keep=True)
    assert kept.columns == df.columns
    assert {1} <= {r["doc_id"] for r in kept.collect()} <= {1, 4}
    assert quality.quality(no_documents, chain).collect() == []
    assert quality.quality(clashing, chain, keep=True).columns == clashing.columns


def test_one_class_keeps_everything(spark):
    df = spark.createDataFrame([(1, BAD)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id bigint, quality int")
    assert quality.judge(quality.fit_lines(df, labels), [quality.base_counts(BAD)[1]]) == [1.0]


def test_viterbi_equals_brute_force():
    import itertools

    rng = np.random.default_rng(2)
    field = crf.Chain(np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    runs = [rng.normal(size=(n, 3)) for n in (1, 4, 6, 2)]
    for chosen, emissions, lengths in crf.packed(runs):
        for row, i in enumerate(chosen):
            decoded = field.viterbi(emissions, lengths)[row, : len(runs[i])].tolist()

            def score(path, run=runs[i]):
                return field.start[path[0]] + sum(run[t, k] for t, k in enumerate(path)) + sum(
                    field.transitions[a, b] for a, b in zip(path, path[1:])
                )

            best = max(itertools.product(range(3), repeat=len(runs[i])), key=score)
            assert tuple(decoded) == best


# Personal data


def plain_spans(text):
    kinds = (
        (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
        (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= sum(c.isdigit() for c in m) <= 19 and pii.luhn(re.sub(r"\D", "", m))),
        (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= sum(c.isdigit() for c in m) <= 15),
    )
    return [[m.span() for m in re.finditer(p, text) if ok(m.group())] for p, ok in kinds]


TRICKY = [
    "a@b.c@d.e x@y..z p@q.r.s. @no.local a@b", "1.2.3.4.5.6.7.8 300.1.1.1 01.002.0003.4 1.2.3", "+1 (2) 3-4.5 6 7 8 9 0 +123456789 +1 2",
    "4111 1111 1111 1111 4111-1111-1111-1112 378282246310005", "x.y+z%w@h-1.i-2 +44 20 7946 0958. 10.0.0.256 10.0.0.25", "", "é@é.é a@1.2.3.4",
    "+1+2+3 12 345 6789012345 0000000000000000000000",
]


def test_patterns_equal_plain_ones():
    import random

    rng = random.Random(4)
    some = TRICKY + ["".join(rng.choice("a1 2.3@-+()4 5") for _ in range(60)) for _ in range(3000)]
    for text in some:
        assert pii.base_spans(text) == plain_spans(text), text


def test_held_out_accuracy():
    tagger = pii.fit_tagger(pii.LABELLED[::2] + pii.LABELLED[1::4])
    whole = pii.fit_tagger()
    right = total = 0
    for line in pii.LABELLED[3::4]:
        text = re.sub(r"</?(email|ip|card|phone)>", "", line)
        truth = [k for k in pii.KINDS for _ in re.findall(f"<{k}>", line)]
        found = [k for k, spans in zip(pii.KINDS, pii.all_spans([text], tagger)[1][0]) for _ in spans]
        right += sorted(truth) == sorted(found)
        total += 1
    assert right >= 0.8 * total
    base, spans = pii.all_spans(["please ring (313) 555-0175 before noon", "in 2022 there were 19 of them", "plain words only"], whole)
    assert [len(s[3]) for s in spans] == [1, 0, 0] and base[0][3] == []
    assert all(not any(s) for s in spans[1:])


def test_personal_data_rows(documents, no_documents, clashing):
    tagger = pii.fit_tagger()
    texts = {r["doc_id"]: r["text"] or "" for r in documents.collect()}
    for row in pii.personal_data(documents, tagger).collect():
        base = plain_spans(texts[row["id"]])
        assert [row[f"n_{k}"] for k in pii.KINDS] == [len(s) for s in base]
        joined = ",".join(f"{k}:{a}:{b}" for k, s in zip(pii.KINDS, base) for a, b in s)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    masked = pii.mask_personal_data(clashing, tagger)
    assert masked.columns == clashing.columns
    for row in masked.collect():
        assert row["text"] is None or (len(row["text"]) == row["n_chars"] and not any(plain_spans(row["text"])))
    assert pii.personal_data(no_documents, tagger).collect() == []


def test_mask_of_overlapping_spans():
    assert pii.masked("abcdefgh", [[(1, 3)], [(2, 5)], [], [(6, 7)]]) == "a[EMAIL]f[PHONE]h"


# Language model


def test_scores(spark, documents, no_documents):
    rows = [(k, " ".join(f"{'ab'[k % 2]}{j % 7} Common" for j in range(k % 13 + 3))) for k in range(120)] + [(500, None), (501, "Never seen")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    counts = Counter()
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k, _ in rows}
    split = {k: [*(w.lower() for w in WORDS.findall(t or "")), ""] for k, t in rows}
    for key, words in split.items():
        if not held[key]:
            counts.update(words)
    total, types = sum(counts.values()), len(counts)
    found = by_id(lm.scores(df))
    assert len(found) == len(rows)
    better = 0
    for key, words in split.items():
        row = found[key]
        assert row["held_out"] == held[key] and row["n_tokens"] == len(words) and row["train_tokens"] == total
        assert row["n_known"] == sum(counts[w] > 0 for w in words)
        base = sum(math.log10((counts[w] + 1) / (total + types + 1)) for w in words)
        assert row["base_score"] == pytest.approx(base)
        assert row["score"] < 0
        better += row["score"] > row["base_score"]
    assert better > 0.9 * len(rows)
    assert lm.scores(no_documents).collect() == []
    assert lm.scores(documents).count() == 12


def test_probabilities_add_up(spark):
    """Over all tokens that a place can hold, seen or not, the model's probabilities add up to one."""
    rows = [(k, f"a{k % 40} b{k % 40} c{k % 700} a{(k + 1) % 40}") for k in range(900)]
    df = spark.createDataFrame(rows, "id bigint, text string").selectExpr("*", "md5(text) AS digest")
    model, rare, counts = lm.fit(df)
    count = {bytes(r["token"]): r["c"] for r in counts.collect()}
    masks = lm._masks(model)
    sums = 0.0
    logs = {}
    for token in count:
        text = f"a1 {token.decode()}" if token else "a1"
        logs[token] = lm.score_tokens(model, rare, masks, [text])[0]
    first = lm.score_tokens(model, rare, masks, ["a1"])[0]
    numbers, lengths, _ = model.numbered(["a1 x"])
    of_class, head, _, of_word = lm._outputs(model, masks, lm.contexts(numbers, lengths), lm.classes_of(numbers, rare))
    assert np.exp(of_class).sum(axis=1) == pytest.approx(1, abs=1e-4)
    assert np.exp(of_word).sum(axis=1) == pytest.approx(1, abs=1e-4)
    head_tokens = {w for w, k in model.known.items() if k < lm.HEAD}
    for kind in range(lm.RARE_CLASSES):
        own = [c for w, c in count.items() if w not in head_tokens and lm.rare_class(w) == kind]
        mass = model.rare_tokens[kind] + model.rare_types[kind] + 1
        sums += (sum(c + 1 for c in own) + 1) / mass
    assert sums == pytest.approx(lm.RARE_CLASSES)
    assert first[0] == 2 and len(logs) == len(count)


def _training_rows(spark):
    rows = [(k, f"a{k % 40} b{k % 40} c{k % 700} a{(k + 1) % 40}") for k in range(900)]
    return spark.createDataFrame(rows, "id bigint, text string").selectExpr("*", "md5(text) AS digest")


_WEIGHTS = ("class_weights", "class_bias", "word_weights", "word_bias")


def test_weights_do_not_depend_on_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm, "TRAINER_TOKENS", 300)  # eight trainers a round
    df = _training_rows(spark)
    one, many = (lm.fit(df.repartition(parts))[0] for parts in (1, 7))
    for name in _WEIGHTS:
        assert np.array_equal(getattr(one, name), getattr(many, name))


def test_weights_equal_a_plain_trainer(spark):
    df = _training_rows(spark)
    model, rare, _ = lm.fit(df, rounds=1)
    plain = lm.Trainer(lm.replace(model, **{n: np.zeros_like(getattr(model, n)) for n in _WEIGHTS}), rare)
    rows = sorted(df.collect(), key=lambda r: (r["id"], r["digest"]))
    numbers, lengths, _ = model.numbered([r["text"] for r in rows])
    around = lm.contexts(numbers, lengths)
    for at in range(0, len(numbers), lm.STEP_TOKENS):
        plain.step(numbers[at : at + lm.STEP_TOKENS], around[at : at + lm.STEP_TOKENS])
    for name in _WEIGHTS:
        assert getattr(model, name) == pytest.approx(plain.tables[name], rel=1e-4, abs=1e-6)


# Tokens


def test_counts_of_pieces_equal_greedy_search(documents, no_documents):
    pieces = tokens.load_vocabulary()
    known = set(pieces)

    def greedy(word):
        symbols = [*word[:-1], word[-1] + 256]
        n = at = 0
        while at < len(symbols):
            size = next((s for s in range(len(symbols) - at, 0, -1) if tuple(symbols[at : at + s]) in known), 0)
            if not size:
                return 1
            n, at = n + 1, at + size
        return n

    for row, text in zip(*(sorted(x, key=lambda r: (r[0] is None, r[0], r[1])) for x in (
        tokens.token_counts(documents).select("id", "n_words", "n_tokens", "longest").collect(),
        [(r["doc_id"], len(WORDS.findall(r["text"] or "")), r["text"]) for r in documents.collect()],
    ))):
        counts = [greedy(w.encode()) for w in (text[2] or "").lower().split()] if text[0] != 9 else None
        assert row["n_words"] == text[1]
        if counts is not None:
            assert (row["n_tokens"], row["longest"]) == (sum(counts), max(counts, default=0))
    assert tokens.token_counts(no_documents).collect() == []


def test_automaton_on_a_small_vocabulary():
    import itertools

    def piece(text):
        ends = text.endswith("$")
        symbols = [ord(c) for c in text.rstrip("$")]
        symbols[-1] += 256 * ends
        return tuple(symbols)

    names = ["a", "b", "ab", "aba", "b$", "ba$", "abab$", "c", "ca", "aab$"]
    known = {piece(n) for n in names}
    automaton = tokens.Automaton([piece(n) for n in names])

    def greedy(word):
        symbols = [*word[:-1], word[-1] + 256]
        n = at = 0
        while at < len(symbols):
            size = next((s for s in range(len(symbols) - at, 0, -1) if tuple(symbols[at : at + s]) in known), 0)
            if not size:
                return 1
            n, at = n + 1, at + size
        return n

    for size in range(1, 8):
        for letters in itertools.product(b"abc", repeat=size):
            assert automaton.count(bytes(letters)) == greedy(bytes(letters)), bytes(letters)


def test_lines_of_a_mixed_text_are_told_apart(spark):
    """Half content, half boilerplate: each line is decoded by itself, and the share of content words decides."""
    import random

    rng = random.Random(2)
    word = lambda: "".join(rng.choice("aeioulnrst") for _ in range(rng.randint(2, 8)))
    plain = lambda: " ".join(word() for _ in range(rng.randint(8, 14))).capitalize() + "."
    junk = lambda: " ".join(rng.choice(("BUY NOW", "$$$", "CLICK|HERE", "***", "100%", "WIN!!!")) for _ in range(rng.randint(3, 6)))
    rows, marks = [], []
    for k in range(120):
        rows.append((k, "\n".join((plain if k % 2 else junk)() for _ in range(rng.randint(4, 12)))))
        marks.append((k, k % 2))
    expected = {}
    for k, (good, bad) in enumerate([(6, 4), (4, 6), (3, 9), (9, 3), (8, 8)], 1000):
        lines = [plain() for _ in range(good)] + [junk() for _ in range(bad)]
        rows.append((k, "\n".join(lines)))
        words = [len(line.split()) for line in lines]
        expected[k] = sum(words[:good]) / sum(words)
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    labels = spark.createDataFrame(marks, "doc_id bigint, quality int")
    chain = quality.fit_lines(documents, labels)
    found = {r["id"]: r for r in quality.quality(documents, chain).collect()}
    for k, share in expected.items():
        assert 0 < found[k]["content_share"] < 1 and found[k]["content_share"] == pytest.approx(share, abs=0.12)
        assert found[k]["kept"] == (not found[k]["base_failed"] and found[k]["content_share"] >= quality.CONTENT_SHARE)


def test_softmax_keeps_digits_of_rows_far_below_the_largest_value():
    values = np.array([[0.0, 1.0, -np.inf], [-200.0, -201.0, -200.5], [-3e4, -np.inf, -3e4]], np.float32)
    own = np.array([1, 0, 2])
    picked, powers, sums = lm._softmax(values, own)
    plain = values.astype(np.float64) - values.max(axis=1, keepdims=True)
    plain = plain - np.log(np.exp(plain).sum(axis=1, keepdims=True))
    assert np.allclose(picked - np.log(sums), plain[np.arange(3), own], atol=1e-6)
    assert np.allclose(powers / sums[:, None], np.exp(plain), atol=1e-6)
    assert [v.shape for v in lm._softmax(values[:0], own[:0])] == [(0,), (0, 3), (0,)]
