"""Token counts: greedy longest-match word pieces, counted by a linear automaton.

The vocabulary is a trie. Every node knows where to go on when no edge fits (its failure link) and
how many pieces are finished by going there (its pops), so a word is counted in one pass over its
bytes, without restarting and without building a piece.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import CACHE_WORDS, raw_texts

END = -1  # the symbol behind the last byte of a word
ROOT, NONE = 0, -1


class PieceCounter:
    """Counts the pieces that greedy longest match cuts a word into.

    tokens are sequences of symbols: bytes, and END where a piece must end a word. A word that
    cannot be cut counts `unknown` pieces.
    """

    def __init__(self, tokens, unknown: int = 1):
        self.unknown = unknown
        edges: list[dict[int, int]] = [{}]
        final = {ROOT: False}
        for token in tokens:
            node = ROOT
            for symbol in token:
                nxt = edges[node].get(symbol)
                if nxt is None:
                    nxt = edges[node][symbol] = len(edges)
                    edges.append({})
                node = nxt
            final[node] = node != ROOT
        link, pops = [NONE] * len(edges), [0] * len(edges)
        level = [ROOT]
        while level:
            below = []
            for node in level:
                for symbol, child in edges[node].items():
                    below.append(child)
                    if final.get(child):
                        link[child], pops[child] = ROOT, 1
                        continue
                    at, done = link[node], pops[node]
                    while at != NONE and symbol not in edges[at]:
                        done, at = done + pops[at], link[at]
                    if at != NONE:
                        link[child], pops[child] = edges[at][symbol], done
            level = below
        self.edges, self.link, self.pops = edges, link, pops

    def count(self, word: bytes) -> int:
        edges, link, pops = self.edges, self.link, self.pops
        node = total = 0
        for symbol in (*word, END):
            while symbol not in edges[node]:
                if link[node] == NONE:
                    # Only END may be missing from a vocabulary: then the word simply ends here.
                    if symbol == END and node == ROOT:
                        return total
                    return self.unknown
                total, node = total + pops[node], link[node]
            node = edges[node][symbol]
        while node != ROOT:
            if link[node] == NONE:
                return self.unknown
            total, node = total + pops[node], link[node]
        return total


def byte_symbols() -> dict[str, int]:
    """The printable characters that stand for the 256 bytes in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


def read_vocabulary(path: str, word_end: str = "</w>") -> list[tuple[int, ...]]:
    """Symbol sequences of a vocabulary file of byte-level pieces whose word ends are marked."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    symbols, tokens = byte_symbols(), []
    special = {t["content"] for t in data.get("added_tokens", [])}
    for token in data["model"]["vocab"]:
        if token in special:
            continue
        ends = token.endswith(word_end)
        body = token.removesuffix(word_end) if ends else token
        if all(c in symbols for c in body):
            tokens.append((*(symbols[c] for c in body), *((END,) if ends else ())))
    return tokens


_counters: dict[str, PieceCounter] = {}


def counter_for(path: str) -> PieceCounter:
    """The automaton of a vocabulary file, built once per worker."""
    if path not in _counters:
        _counters[path] = PieceCounter(read_vocabulary(path))
    return _counters[path]


class _Lengths(dict):
    def __init__(self, counter: PieceCounter):
        self.counter = counter

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.counter.count(word)
        return value


def count_tokens(docs: DataFrame, vocabulary: str) -> DataFrame:
    """(doc_id, n_words, n_tokens, longest_word_tokens), a row for each row of docs.

    Words are maximal runs without ASCII white space, A-Z lower-cased. Null and empty texts have
    no words and no tokens. Repeated rows and null ids are counted like any other; other columns are
    not read. `vocabulary` is a file that every machine has. No shuffle; a row is read once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = _Lengths(counter_for(vocabulary))
        for batch in batches:
            n_words, n_tokens, longest = [], [], []
            for text in raw_texts(batch):
                counts = list(map(lengths.__getitem__, text.lower().split()))
                n_words.append(len(counts))
                n_tokens.append(sum(counts))
                longest.append(max(counts, default=0))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array(longest, pa.int64())],
                ["doc_id", "n_words", "n_tokens", "longest_word_tokens"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, n_words long, n_tokens long, longest_word_tokens long"
    )
