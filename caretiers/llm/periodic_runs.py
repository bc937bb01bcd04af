"""Periodic runs: stretches of words that repeat with a period, found by a dictionary of basic factors.

The dictionary names every factor of 2, 4, 8, ... words, so that equal factors of one text have equal
names: a name is the rank of the pair of names of its halves. Per length, each occurrence looks for its
successor within twice that length. Successors at one distance form arithmetic progressions, and their
difference is proposed as a period; it is the smallest one of the stretch it was found in, as a
smaller one would have made a nearer successor. Proposals are extended word by word to both sides,
and each stretch is extended once per period.

Factors of `length` words with length >= period find every run of at least length + period words. A
run of three periods has such a power of two below its length, whatever its period.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from fractions import Fraction
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import raw_texts

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, LEAST_PERIODS = 24, 3
#: Words whose factors are named at a time; a longer text is taken alone.
CHUNK_WORDS = 500_000

Run = tuple[int, int, int]  # first word, words, period

_OUT = (
    "doc_id long, n_words long, runs array<struct<start:long,length:long,period:long>>, "
    "start long, length long, period long, exponent_milli long, collapsed string"
)
_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _ranks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rank of each key among the different ones, and whether another key is equal to it."""
    order = np.argsort(keys)
    new = np.empty(len(keys), bool)
    new[:1] = True
    np.not_equal(keys[order[1:]], keys[order[:-1]], out=new[1:])
    rank_in_order = np.cumsum(new) - 1
    rank = np.empty(len(keys), np.int64)
    rank[order] = rank_in_order
    return rank, (np.bincount(rank_in_order) > 1)[rank]


def _successors(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places (ascending) with a later place of the same name, and the distance to the next of them."""
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    here = places[order[:-1]][same]
    return here, places[order[1:]][same] - here


def _proposals(words: np.ndarray, begins: np.ndarray, base: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(factor length, places, distances) for lengths from `base` on, by distance and place.

    words holds the word ids of texts that begin at `begins`; no factor crosses a text's end.
    """
    n = len(words)
    ends = np.append(begins[1:], n)
    sizes = ends - begins
    text = np.repeat(np.arange(len(begins)), sizes)
    end = np.repeat(ends, sizes)
    different = int(words.max(initial=0)) + 1
    name = text * different + words
    places, length, many = np.arange(n), 1, len(begins) * different
    longest = int(sizes.max(initial=0))
    while len(places) and length < longest:
        halves = places[places + 2 * length <= end[places]]
        second = name[halves + length]
        halves, second = halves[second >= 0], second[second >= 0]
        first = name[halves]
        if length == 1:
            # The text is in the first half's name already.
            second, many = second % different, different
        rank, repeated = _ranks(first * many + second)
        length *= 2
        places, rank = halves[repeated], rank[repeated]
        name = np.full(n, -1)
        name[places] = rank
        many = n
        if length >= base:
            here, distance = _successors(rank, places)
            near = distance <= 2 * length
            here, distance = here[near], distance[near]
            order = np.lexsort((here, distance))
            yield length, here[order], distance[order]


def _matching(words: np.ndarray, at: int, stop: int, period: int) -> int:
    """The first place from `at` on, below `stop`, whose word differs from that one period later."""
    step = 64
    while at < stop:
        ahead = min(step, stop - at)
        differs = words[at : at + ahead] != words[at + period : at + period + ahead]
        k = int(differs.argmax())
        if differs[k]:
            return at + k
        at, step = at + ahead, step * 2
    return stop


def _matching_back(words: np.ndarray, at: int, begin: int, period: int) -> int:
    """The first place of the stretch up to `at` whose words equal those one period later."""
    step = 64
    while at > begin:
        back = min(step, at - begin)
        differs = (words[at - back : at] != words[at - back + period : at + period])[::-1]
        k = int(differs.argmax())
        if differs[k]:
            return at - k
        at, step = at - back, step * 2
    return begin


def periodic_runs(words: np.ndarray, begins: np.ndarray, least: int = LEAST_WORDS, periods: int = LEAST_PERIODS) -> list[list[Run]]:
    """The runs of each text, by start and period: maximal stretches of at least `least` words and of
    at least `periods` (three or more) times their smallest period. Starts count from the text's
    beginning. Memory is in proportion to the words."""
    if periods < 3:
        raise ValueError("runs of less than three periods need shorter factors")
    found: list[dict[tuple[int, int], int]] = [{} for _ in begins]
    base = 2
    while 2 * base <= 2 * least // 3:
        base *= 2
    ends = np.append(begins[1:], len(words))
    for length, places, distances in _proposals(words, begins, base):
        # Neighbouring places with one distance lie in one stretch.
        first = np.ones(len(places), bool)
        first[1:] = (np.diff(places) != 1) | (np.diff(distances) != 0)
        texts = np.searchsorted(begins, places[first], "right") - 1
        reached, with_period = 0, 0
        for place, period, text in zip(places[first].tolist(), distances[first].tolist(), texts.tolist()):
            begin, end = int(begins[text]), int(ends[text])
            if periods * period > end - begin or (period == with_period and place < reached):
                continue
            start = _matching_back(words, place, begin, period)
            reached = _matching(words, place + length, end - period, period)
            with_period = period
            size = reached + period - start
            if size >= max(least, periods * period):
                found[text][start - begin, period] = size
    return [[(start, size, period) for (start, period), size in sorted(runs.items())] for runs in found]


def strongest(runs: list[Run]) -> Run | None:
    """The run of the greatest length in periods; among equals the first, then that of the least period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapsed(words: list[bytes], runs: list[Run]) -> list[bytes]:
    """The words without those that any run contains after its first period."""
    if not runs:
        return words
    stays = np.ones(len(words), bool)
    for start, size, period in runs:
        stays[start + period : start + size] = False
    return [words[k] for k in np.flatnonzero(stays).tolist()]


def _chunks(texts: list[list[bytes]]) -> Iterator[list[list[bytes]]]:
    chunk, size = [], 0
    for words in texts:
        if chunk and size + len(words) > CHUNK_WORDS:
            yield chunk
            chunk, size = [], 0
        chunk.append(words)
        size += len(words)
    if chunk:
        yield chunk


def _runs_of(texts: list[list[bytes]], least: int, periods: int) -> list[list[Run]]:
    number: defaultdict[bytes, int] = defaultdict()
    number.default_factory = number.__len__
    words = np.array([number[w] for w in chain.from_iterable(texts)], np.int64)
    sizes = [len(t) for t in texts]
    filled = [k for k, size in enumerate(sizes) if size]
    begins = np.cumsum([0, *(sizes[k] for k in filled)])[:-1]
    runs: list[list[Run]] = [[] for _ in texts]
    for k, found in zip(filled, periodic_runs(words, begins, least, periods)):
        runs[k] = found
    return runs


def collapse(
    docs: DataFrame,
    least: int = LEAST_WORDS,
    periods: int = LEAST_PERIODS,
    prepare: Callable[[int | None, list[bytes]], list[bytes]] | None = None,
) -> DataFrame:
    """A row for each row of docs: doc_id, n_words, its runs by start and period, the strongest one (its
    start, length, period and floor(1000 * length / period), null where there is none), and the text
    without the words that runs repeat, joined by one space.

    Words are maximal runs without ASCII white space and compared as they are. Null and empty texts have
    no words, no runs and an empty collapsed text. Repeated rows and null ids are taken like any others;
    other columns are not read. `prepare` may change the words of a text first. Nothing is shuffled: a
    text lies in one row, and a task holds the factor names of `CHUNK_WORDS` words or of one longer text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            texts = [t.split() for t in raw_texts(batch)]
            if prepare:
                texts = [prepare(d, t) for d, t in zip(ids, texts)]
            runs = list(chain.from_iterable(_runs_of(c, least, periods) for c in _chunks(texts)))
            best = [strongest(r) for r in runs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(t) for t in texts], pa.int64()),
                    pa.array([[{"start": s, "length": n, "period": p} for s, n, p in r] for r in runs], _RUNS),
                    *(pa.array([b and b[k] for b in best], pa.int64()) for k in range(3)),
                    pa.array([b and 1000 * b[1] // b[2] for b in best], pa.int64()),
                    pa.array([b" ".join(collapsed(t, r)) for t, r in zip(texts, runs)], pa.binary()).cast(pa.string()),
                ],
                ["doc_id", "n_words", "runs", "start", "length", "period", "exponent_milli", "collapsed"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, _OUT)
