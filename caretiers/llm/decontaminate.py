"""Benchmark decontamination: documents that hold a benchmark item, up to some edits.

A random walk (CGK) copies a sequence symbol by symbol into a longer one and at every step stays or
moves on, by a random bit that depends on the step and the symbol alone. Sequences at a small edit
distance mostly walk in step, so their images are at a small Hamming distance. Locality-sensitive
hashing samples a few places of the images; a window that agrees with an item on one of many samples
is a candidate, and candidates are verified by exact edit distance.

Windows have the size of an item. They are laid only where a document can hold that item at all: an
item of n words with at most k edits leaves n - q + 1 - q*k of its q-grams intact, within k places of
one alignment (the q-gram lemma), so nothing is lost by looking at such places only. On long items
with many edits walks part too often; there all such places are verified, without sampling. Items of
fewer than five words allow no edit and are looked up as they are.

The benchmark is the query set: it is taken in blocks of a bounded number of words, and every block
is held against all documents in one pass without a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix

#: One edit for each started EDIT_EVERY words beyond the first.
EDIT_EVERY = 5
#: Items of fewer words are looked up exactly.
MIN_WORDS = 5
#: Items of more words are verified at every place that the q-gram lemma leaves.
WALK_WORDS = 64
GRAM = 3
#: Independent walks, samples of each image, and places per sample, for items up to WALK_WORDS. The
#: tests in tests/llm/test_operators.py ask for a recall of 0.99 at the largest number of edits allowed.
WALKS, SAMPLES, PLACES = 12, 6, 2
#: Benchmark words that are broadcast at a time.
BLOCK_WORDS = 1_000_000

#: Characters of scripts written without spaces: Thai, Lao, Burmese, Khmer, kana and Han.
UNSPACED = (
    "\u0e01-\u0e3a\u0e40-\u0e4e\u0e81-\u0ece\u1000-\u103f\u1780-\u17d3\u3005-\u3007\u3041-\u3096\u309d-\u309f"
    "\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U0003ffff"
)
_WORD = re.compile(r"\w+")
_UNSPACED = re.compile(f"[{UNSPACED}]")
_WORD_OR_SIGN = re.compile(rf"[{UNSPACED}]|(?:(?![{UNSPACED}])\w)+")


def normalized_words(text: str | None) -> list[str]:
    """Lower-cased runs of letters, digits and underscores: case, punctuation and spacing don't count.

    In scripts written without spaces every character is a word.
    """
    text = (text or "").lower()
    if text.isascii() or not _UNSPACED.search(text):
        return _WORD.findall(text)
    return _WORD_OR_SIGN.findall(text)


def allowed_edits(n: int) -> int:
    return (n - 1) // EDIT_EVERY


def substring_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance between item and any part of text, and where the part ends."""
    steps = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for k, symbol in enumerate(item.tolist()):
        new = np.empty_like(row)
        new[0] = k + 1
        new[1:] = np.minimum(row[1:] + 1, row[:-1] + (text != symbol))
        row = np.minimum.accumulate(new - steps) + steps
    end = int(np.argmin(row))
    return int(row[end]), end


def walk_samples(ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Hashes (rows x WALKS*SAMPLES) of sampled places of the images of sequences.

    ids holds one sequence per row, filled up on the right; sizes their lengths.
    """
    count, width = ids.shape
    walks = np.arange(WALKS, dtype=np.uint64)
    # Places lie among the first 2n steps, in which a walk passes over the whole sequence on average.
    share = mix(np.arange(1, WALKS * SAMPLES * PLACES + 1, dtype=np.uint64)).reshape(WALKS, SAMPLES * PLACES)
    places = ((share >> np.uint64(11)).astype(np.float64) / 2**53 * 2 * sizes[:, None, None]).astype(np.int64)
    image = np.zeros((count, WALKS, SAMPLES * PLACES), np.uint64)
    at = np.zeros((count, WALKS), np.int64)
    rows = np.arange(count)[:, None]
    for step in range(int(2 * sizes.max(initial=0))):
        symbol = ids[rows, np.minimum(at, width - 1)].astype(np.int64) + 1
        symbol[at >= sizes[:, None]] = 0
        here = symbol.astype(np.uint64)
        hit = places == step
        if hit.any():
            image += np.where(hit, here[:, :, None] + np.uint64(1), np.uint64(0))
        bit = mix(here * np.uint64(0x9E3779B97F4A7C15) + np.uint64(step * 0xC2B2AE3D27D4EB4F & (1 << 64) - 1) + walks)
        at += ((bit >> np.uint64(17)) & np.uint64(1)).astype(np.int64)
    image = image.reshape(count, WALKS, SAMPLES, PLACES)
    hashed = np.zeros((count, WALKS, SAMPLES), np.uint64)
    for k in range(PLACES):
        hashed = mix(hashed + image[..., k] * np.uint64(0xA24BAED4963EE407))
    table = np.arange(WALKS * SAMPLES, dtype=np.uint64).reshape(WALKS, SAMPLES)
    return mix(hashed ^ mix(table + sizes.astype(np.uint64)[:, None, None] * np.uint64(1 << 20))).reshape(count, WALKS * SAMPLES)


@dataclass
class Match:
    item: int | None
    first: int
    distance: int


class Matcher:
    """A block of benchmark items, ready to be looked for."""

    def __init__(self, items: list[tuple[int, str]]):
        self.vocabulary: dict[str, int] = {}
        self.names: list[int] = []
        self.words: list[np.ndarray] = []
        #: Short items: by number of words, their numbers to the items.
        self.short: dict[int, dict[tuple[int, ...], list[int]]] = {}
        self.short_names: list[int] = []
        for name, text in items:
            words = normalized_words(text)
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            if len(words) >= MIN_WORDS:
                self.names.append(name)
                self.words.append(np.array(ids, np.int64))
            elif words:
                self.short.setdefault(len(ids), {}).setdefault(tuple(ids), []).append(len(self.short_names))
                self.short_names.append(name)
        self.short_codes = {n: np.unique(self._codes(np.array(list(found), np.int64).T)) for n, found in self.short.items()}
        self.sizes = np.array([len(w) for w in self.words], np.int64)
        self.edits = (self.sizes - 1) // EDIT_EVERY
        self.least = self.sizes - GRAM + 1 - GRAM * self.edits
        grams = [self._grams(w) for w in self.words]
        owner = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        offset = np.concatenate([np.arange(len(g)) for g in grams]) if grams else np.empty(0, np.int64)
        codes = np.concatenate(grams) if grams else np.empty(0, np.int64)
        order = np.argsort(codes, kind="stable")
        self.codes, self.owner, self.offset = codes[order], owner[order], offset[order]
        self.seen = np.zeros(1 << 20, bool)
        self.seen[self._slot(self.codes)] = True
        if self.words:
            walked = np.flatnonzero(self.sizes <= WALK_WORDS)
            hashes = walk_samples(self._filled([self.words[k] for k in walked.tolist()]), self.sizes[walked])
            order = np.argsort(hashes.ravel(), kind="stable")
            self.hashes, self.hashed_item = hashes.ravel()[order], walked[order // hashes.shape[1]]

    @staticmethod
    def _codes(columns: list[np.ndarray] | np.ndarray) -> np.ndarray:
        """One number per row of words given as columns; a clash is told apart by the words themselves."""
        code = np.zeros(len(columns[0]), np.int64)
        for part in columns:
            code = code * np.int64(1_000_003) + part
        return code

    def short_items(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """(short item, first): where each of the short items stands first."""
        found: dict[int, int] = {}
        for n, items in self.short.items():
            count = len(ids) - n + 1
            if count <= 0:
                continue
            code = self._codes([ids[k : k + count] for k in range(n)])
            known = self.short_codes[n]
            at = np.minimum(np.searchsorted(known, code), len(known) - 1)
            for first in np.flatnonzero(known[at] == code).tolist():
                for item in items.get(tuple(ids[first : first + n].tolist()), ()):
                    found.setdefault(item, first)
        return sorted(found.items())

    def _grams(self, words: np.ndarray) -> np.ndarray:
        """Numbers of the GRAM-grams; -1 where a word is in no item."""
        count = max(0, len(words) - GRAM + 1)
        code, known = np.zeros(count, np.int64), np.ones(count, bool)
        for k in range(GRAM):
            part = words[k : k + count]
            # Numbers wrap around; a clash costs a window more, and windows are verified.
            code = code * np.int64(1_000_003) + part
            known &= part > 0
        return np.where(known, code, -1)

    @staticmethod
    def _slot(codes: np.ndarray) -> np.ndarray:
        return (mix(codes.astype(np.uint64)) & np.uint64((1 << 20) - 1)).astype(np.int64)

    @staticmethod
    def _filled(rows: list[np.ndarray]) -> np.ndarray:
        out = np.zeros((len(rows), max(map(len, rows), default=1)), np.int64)
        for k, row in enumerate(rows):
            out[k, : len(row)] = row
        return out

    def windows(self, ids: np.ndarray) -> tuple[set[tuple[int, int]], list[tuple[int, int, int]]]:
        """(first, size) of the item-sized windows that can hold an item of that size, and for long items
        (item, first, last) of the places that can hold it."""
        grams = self._grams(ids)
        at = np.flatnonzero(grams >= 0)
        at = at[self.seen[self._slot(grams[at])]]
        low = np.searchsorted(self.codes, grams[at])
        count = np.searchsorted(self.codes, grams[at], side="right") - low
        if not count.any():
            return set(), []
        where = np.repeat(at, count)
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        item = self.owner[entry]
        line = where - self.offset[entry]
        order = np.lexsort((line, item))
        item, line = item[order], line[order]
        # Hits of one item within 2k alignments of each other.
        span = 1 << 40
        key = item * span + line
        upto = np.searchsorted(key, key + 2 * self.edits[item], side="right")
        good = np.flatnonzero(upto - np.arange(len(key)) >= self.least[item])
        found, whole = set(), []
        for k in good.tolist():
            if (size := int(self.sizes[item[k]])) > WALK_WORDS:
                # A part that holds the item begins within k places of any hit, and ends so too.
                edits, at = int(self.edits[item[k]]), int(line[k])
                first, last = max(0, at - edits), at + size + 2 * edits
                if whole and whole[-1][0] == item[k] and whole[-1][2] >= first:
                    whole[-1] = (whole[-1][0], whole[-1][1], last)
                else:
                    whole.append((int(item[k]), first, last))
                continue
            lines = line[k : upto[k]]
            # The window starts at the alignment that most hits agree on.
            values, times = np.unique(lines, return_counts=True)
            found.add((max(0, int(values[np.argmax(times)])), int(self.sizes[item[k]])))
        return found, whole

    def find(self, texts: list[str | None]) -> list[list[Match]]:
        """For each text its items, with the best place of each."""
        out: list[dict[int, Match]] = [{} for _ in texts]
        short: list[list[Match]] = [[] for _ in texts]
        rows, laid = [], []
        kept: dict[int, np.ndarray] = {}
        for k, text in enumerate(texts):
            words = normalized_words(text)
            ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
            short[k] = [Match(self.short_names[item], first, 0) for item, first in self.short_items(ids)]
            if not self.words:
                continue
            places, whole = self.windows(ids)
            for item, first, last in whole:
                self._verify(item, ids, first, last, out[k])
            for first, size in sorted(places):
                kept[k] = ids
                laid.append((k, first, size))
                rows.append(ids[first : first + size])
        for at in range(0, len(rows), 256):
            self._probe(rows[at : at + 256], laid[at : at + 256], kept, out)
        return [[o[item] for item in sorted(o)] + s for o, s in zip(out, short, strict=True)]

    def _verify(self, item: int, ids: np.ndarray, first: int, last: int, out: dict[int, Match]) -> None:
        distance, end = substring_distance(self.words[item], ids[first:last])
        if distance <= int(self.edits[item]) and (item not in out or distance < out[item].distance):
            out[item] = Match(self.names[item], max(0, first + end - int(self.sizes[item])), distance)

    def _probe(self, rows: list[np.ndarray], laid: list[tuple[int, int, int]], texts: dict[int, np.ndarray], out: list[dict[int, Match]]) -> None:
        sizes = np.array([size for _, _, size in laid], np.int64)
        hashes = walk_samples(self._filled(rows), sizes)
        flat = hashes.ravel()
        low = np.searchsorted(self.hashes, flat)
        count = np.searchsorted(self.hashes, flat, side="right") - low
        hit = np.repeat(np.arange(len(flat)) // hashes.shape[1], count)
        entry = np.repeat(low - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
        pairs = np.unique(hit * len(self.words) + self.hashed_item[entry])
        for pair in pairs.tolist():
            window, item = divmod(pair, len(self.words))
            doc, first, size = laid[window]
            edits = int(self.edits[item])
            self._verify(item, texts[doc], max(0, first - edits), first + size + edits, out[doc])


def _blocks(benchmark: DataFrame) -> Iterator[Matcher]:
    items = benchmark.filter(F.col("text").isNotNull()).select("item_id", "text")
    signs = F.length(F.regexp_replace("text", f"[^{UNSPACED}]", ""))
    words = items.agg(F.sum(F.size(F.split("text", r"\s+")) + signs)).first()[0] or 0
    blocks = max(1, -(-words // BLOCK_WORDS))
    for k in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k)
        yield Matcher([(r["item_id"], r["text"]) for r in part.collect()])


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, first_word, distance): documents and the benchmark items that they hold.

    A document holds an item if a part of it is within one word edit for each started five words of
    the item beyond the first, where words are lower-cased runs of letters and digits, or characters
    of a script without spaces; an item of one to five words is held by texts that have it without edits.
    Null and empty texts hold nothing and items without words are held by nothing; an id may be null; repeated rows
    give repeated results; other columns are not read.
    """
    spark, found = docs.sparkSession, None
    for matcher in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(matcher)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = shared.value.find(batch.column("text").to_pylist())
                rows = [(k, m) for k, ms in enumerate(hits) for m in ms]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(pa.array([k for k, _ in rows], pa.int64())),
                        pa.array([m.item for _, m in rows], pa.int64()),
                        pa.array([m.first for _, m in rows], pa.int64()),
                        pa.array([m.distance for _, m in rows], pa.int64()),
                    ],
                    ["doc_id", "item_id", "first_word", "distance"],
                )

        part = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, item_id long, first_word long, distance long")
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item, with all their columns, in one pass per block."""
    spark = docs.sparkSession
    for matcher in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(matcher)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hits = shared.value.find(batch.column("text").to_pylist())
                yield batch.filter(pa.array([not h for h in hits], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
    return docs
