"""Token counts by a linear longest-match automaton over a vocabulary."""

from __future__ import annotations

import json

import pyarrow as pa
from pyspark.sql import DataFrame

from ratelens.llm.common import id_and_text, lower_ascii, map_batches, texts

VOCABULARY = "/opt/tokenizers/word_bpe_49k.json"
WORD_END = "</w>"
_CACHED = 200_000  # words remembered by a task; what is forgotten is counted again


def byte_names() -> dict[str, int]:
    """Characters of byte-level vocabularies: printable Latin-1 names itself, the rest follow from U+0100 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


def load_vocabulary(path: str = VOCABULARY) -> list[tuple[int, ...]]:
    """Pieces as symbols: a byte, plus 256 for the last byte of a piece that ends a word. Read on the driver."""
    with open(path, encoding="utf-8") as file:
        names = json.load(file)["model"]["vocab"]
    known = byte_names()
    out = []
    for name in names:
        ends = name.endswith(WORD_END) and name != WORD_END
        core = name.removesuffix(WORD_END) if ends else name
        if core and all(c in known for c in core):
            symbols = [known[c] for c in core]
            symbols[-1] += 256 * ends
            out.append(tuple(symbols))
    return out


class Automaton:
    """Trie of the pieces, where a node's failure link says what remains once its longest pieces are popped.

    ``fail[v]`` is the node for the rest of ``v``'s string after the pieces that greedy longest matching is
    bound to take from it, and ``pops[v]`` is how many those are. A word is one pass over its symbols.
    """

    def __init__(self, pieces: list[tuple[int, ...]]):
        children: list[dict[int, int]] = [{}]
        final = [False]
        for piece in pieces:
            node = 0
            for symbol in piece:
                following = children[node].get(symbol)
                if following is None:
                    following = children[node][symbol] = len(children)
                    children.append({})
                    final.append(False)
                node = following
            final[node] = True
        fail: list[int] = [-1] * len(children)
        pops = [0] * len(children)
        level = [0]
        while level:
            below = []
            for node in level:
                for symbol, child in children[node].items():
                    below.append(child)
                    if final[child]:
                        fail[child], pops[child] = 0, 1
                        continue
                    rest, count = fail[node], pops[node]
                    while rest >= 0 and symbol not in children[rest]:
                        count += pops[rest]
                        rest = fail[rest]
                    if rest >= 0:
                        fail[child], pops[child] = children[rest][symbol], count
            level = below
        self.children, self.fail, self.pops = children, fail, pops

    def count(self, word: bytes) -> int:
        """Pieces of a word; 1 if longest matching finds no way through it (a piece for unknown words)."""
        children, fail, pops = self.children, self.fail, self.pops
        node = total = 0
        last = len(word) - 1
        for at, symbol in enumerate(word):
            if at == last:
                symbol += 256
            while (following := children[node].get(symbol)) is None:
                total += pops[node]
                node = fail[node]
                if node < 0:
                    return 1
            node = following
        while node:
            total += pops[node]
            node = fail[node]
            if node < 0:
                return 1
        return total


def token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", vocabulary: str = VOCABULARY
) -> DataFrame:
    """``(id, n_words, n_tokens, longest)``: words, pieces, and the most pieces of one word, of every row.

    A-Z is lower-cased, words are cut at white space, and each is split greedily into the longest pieces of the
    vocabulary, the last of which must end a word. Null and empty texts have none. The vocabulary, a file of
    bounded size, goes to the tasks as a broadcast. Repeated rows get equal counts; an empty table stays empty.
    """
    pieces = df.sparkSession.sparkContext.broadcast(load_vocabulary(vocabulary))
    held: list = []

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not held:
            held.append((Automaton(pieces.value), {}))
        automaton, known = held[0]
        rows = []
        for text in texts(batch):
            words = lower_ascii(text.encode("utf-8", "surrogatepass")).split()
            total = longest = 0
            for word in words:
                n = known.get(word)
                if n is None:
                    if len(known) >= _CACHED:
                        known.clear()
                    n = known[word] = automaton.count(word)
                total += n
                if n > longest:
                    longest = n
            rows.append((len(words), total, longest))
        columns = list(zip(*rows))
        names = ("n_words", "n_tokens", "longest")
        return pa.record_batch({"id": batch.column("id")} | {n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})

    source = id_and_text(df, id_col, text_col)
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(source, run, f"id {kind}, n_words bigint, n_tokens bigint, longest bigint")
