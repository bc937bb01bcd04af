"""Packing: token sequences of one length, filled with lexically related documents.

Documents are tokenized once. Their tokens are the terms of a BM25 index whose statistics are those of
the whole corpus. A document is dealt into a shard by its rarest terms that others have too, so that
related documents meet, however many shards there are. Within a shard a seed document retrieves
unused neighbours, best first, which fill the window that it leaves open. A neighbour that does not
fit is cut and seeds the next window, so windows are full; what a shard has over at its end is cut
into powers of two, which need no padding either.

The vocabulary bounds what the driver sees: a row per term. Shards are of bounded size: a term with too
many documents has several shards, into which the next rarest terms deal its documents, and what
cannot be told apart by terms (copies of one text) is split by row.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, mix, remove, scratch
from .token_counts import byte_symbols

WINDOW = 2048
END_ID = 1
#: Tokens that a shard aims at; a shard of twice as many is split.
SHARD_TOKENS = 250_000
#: So many of a document's rarest shared terms deal it.
KEY_TERMS = 3
K1, B = 1.2, 0.75

_PIECES = pa.schema(
    [("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")]]
)


#: Words with one of these characters (an apostrophe, say) need the tokenizer's own rules. All others
#: are lower-cased and cut by the next pattern just as the tokenizer does it.
_ODD = re.compile("[^!-&(-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff\n]|<\\|")
_PARTS = re.compile("[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\\n|[^\\n0-9a-z\u00df-\u00f6\u00f8-\u00ff]+")
#: Runs that a generation remembers.
REMEMBERED = 250_000
#: Text bytes whose words are numbered together. What a worker holds for them is many times as much.
GROUP_BYTES = 4_000_000


def _kind(vocabulary: int) -> str:
    return "<u2" if vocabulary < 1 << 16 else "<u4"


class _Runs(dict):
    """run of letters, digits or signs (lower-cased) -> its token ids. Two generations are remembered:
    when the newer one is full it becomes the older one, and what is met again moves on to the next."""

    def __init__(self, model, kind: str, between: bytes):
        self.model, self.kind, self.between = model, kind, between
        self.signs = {b: c for c, b in byte_symbols().items()}
        self.older: dict[str, bytes] = {}
        self["\n"] = between

    def __missing__(self, run: str) -> bytes:
        value = self.older.get(run)
        if value is None:
            written = run if run.isascii() else "".join(self.signs[b] for b in run.encode())
            value = array(self.kind, [t.id for t in self.model.tokenize(written)]).tobytes()
        self[run] = value
        return value

    def age(self) -> None:
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
            self["\n"] = self.between


class WordIds:
    """Token ids of texts, as numbers of two bytes, or four for a large vocabulary.

    The tokenizer never joins text across white space, so a text has the ids of its words in a row. The
    different words of many texts are cut once, into runs of letters, digits and signs whose merges are
    looked up directly; runs repeat far more often than words.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.size = max(self.tokenizer.get_vocab(with_added_tokens=True).values()) + 1
        kind = "H" if _kind(self.size) == "<u2" else "I"
        # No id: stands between words that are cut together.
        self.between = (1 << 8 * array(kind).itemsize) - 1
        self.runs = _Runs(self.tokenizer.model, kind, array(kind, [self.between]).tobytes())

    def _cut(self, words: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of words, given one per line: all ids, where each word's begin, and how many it has."""
        odd: dict[int, str] = {}
        places = [m.start() for m in _ODD.finditer(words)]
        if places:
            breaks = np.flatnonzero(np.frombuffer(words.encode("utf-32-le", "replace"), "<u4") == 10)
            listed = words.split("\n")
            for k in np.unique(np.searchsorted(breaks, places)).tolist():
                odd[k], listed[k] = listed[k], ""
            words = "\n".join(listed)
        self.runs.age()
        ids = np.frombuffer(b"".join(map(self.runs.__getitem__, _PARTS.findall(words.lower()))), _kind(self.size))
        cuts = np.flatnonzero(ids == self.between)
        first = np.concatenate(([0], cuts + 1))
        count = np.append(cuts, len(ids)) - first
        if odd:
            encoded = [self.tokenizer.encode(w, add_special_tokens=False).ids for w in odd.values()]
            at = list(odd)
            count[at] = [len(e) for e in encoded]
            first[at] = len(ids) + np.cumsum(count[at]) - count[at]
            ids = np.concatenate([ids, np.fromiter(chain.from_iterable(encoded), ids.dtype)])
        return ids, first, count

    def of(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text; a null text has none."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = split.flatten().dictionary_encode()
        if not len(words):
            return [np.empty(0, _kind(self.size))] * len(texts)
        listed = pa.ListArray.from_arrays([0, len(words.dictionary)], words.dictionary)
        together = pc.binary_join(listed, "\n")[0].as_buffer().to_pybytes().decode("utf-8", "replace")
        ids, first, count = self._cut(together)
        # The ids of all words of all texts are fetched at once.
        word = words.indices.to_numpy()
        own = count[word]
        ends = np.cumsum(own)
        whole = ids[np.repeat(first[word] - (ends - own), own) + np.arange(ends[-1])]
        stops = np.concatenate(([0], ends))[np.cumsum(split.value_lengths().to_numpy())].tolist()
        return [whole[a:b] for a, b in zip([0, *stops], stops)]


_word_ids: dict[str, WordIds] = {}


def word_ids(path: str) -> WordIds:
    """The remembered ids of a tokenizer file, shared by the tasks of a worker."""
    if path not in _word_ids:
        _word_ids[path] = WordIds(path)
    return _word_ids[path]


def _terms(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different terms of a document, and how often each occurs."""
    ordered = np.sort(ids)
    first = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ids) else np.empty(0, np.int64)
    return ordered[first], np.diff(first, append=len(ids))


class Statistics:
    """What BM25 needs to know of the whole corpus: documents, their mean length, and per term the number
    of documents that have it."""

    def __init__(self, documents: int, tokens: int, frequency: np.ndarray):
        self.mean = max(tokens / max(documents, 1), 1.0)
        self.idf = np.log(1 + np.maximum(documents - frequency + 0.5, 0.5) / (frequency + 0.5))
        # Terms by rising frequency; those of no or one document, which tell nothing, are last.
        order = np.lexsort((np.arange(len(frequency)), np.where(frequency > 1, frequency, np.iinfo(np.int64).max)))
        self.rarity = np.empty(len(frequency), np.int64)
        self.rarity[order] = np.arange(len(frequency))
        self.shared = int((frequency > 1).sum())

    def keys(self, ids: np.ndarray) -> list[int]:
        """The rarest shared terms of a document, by their rank; `shared` stands for none."""
        found, ranks = [], self.rarity[ids]
        for _ in range(KEY_TERMS):
            found.append(int(ranks.min(initial=self.shared)))
            ranks = ranks[ranks > found[-1]]
        return found


class Bm25:
    """Inverted index over the documents of a shard, given as arrays of term numbers."""

    def __init__(self, docs: Iterable[np.ndarray], corpus: Statistics):
        found = [_terms(d) for d in docs]
        self.terms = [terms for terms, _ in found]
        self.size = len(found)
        size = np.array([len(t) for t in self.terms], np.int64)
        length = np.array([c.sum() for _, c in found], float)
        owner = np.repeat(np.arange(self.size, dtype=np.int32), size)
        term = np.concatenate(self.terms) if found else np.empty(0, np.uint16)
        count = np.concatenate([c for _, c in found]) if found else np.empty(0)
        norm = K1 * (1 - B + B * length / corpus.mean)
        weight = corpus.idf[term] * count * (K1 + 1) / (count + norm[owner])
        order = np.argsort(term, kind="stable")
        self.term, self.doc, self.weight = term[order], owner[order], weight[order]
        self.vocabulary = np.arange(len(corpus.idf) + 1)
        self.begin = np.searchsorted(self.term, self.vocabulary)
        self.indexed = self.size

    def _forget(self, free: np.ndarray) -> None:
        """Leaves out the postings of used documents, each time half of them are."""
        left = int(free.sum())
        if 2 * left <= self.indexed:
            stays = free[self.doc]
            self.term, self.doc, self.weight = self.term[stays], self.doc[stays], self.weight[stays]
            self.begin = np.searchsorted(self.term, self.vocabulary)
            self.indexed = left

    def neighbours(self, seed: int, free: np.ndarray) -> list[int]:
        """All free documents that share a term with a seed, best first; ties go to the earlier one."""
        self._forget(free)
        terms = self.terms[seed]
        begin = self.begin[terms]
        count = self.begin[terms.astype(np.int64) + 1] - begin
        ends = np.cumsum(count)
        if not len(ends) or not ends[-1]:
            return []
        postings = np.repeat(begin - (ends - count), count) + np.arange(ends[-1])
        score = np.bincount(self.doc[postings], self.weight[postings], self.size)
        score[~free] = 0
        best = np.argsort(-score, kind="stable")
        return best[: int((score > 0).sum())].tolist()


class _Windows:
    """Fills windows with documents one after another and notes the pieces."""

    def __init__(self, lengths: list[int], window: int):
        self.lengths, self.window = lengths, window
        self.pieces: list[tuple[int, int, int, int, int]] = []  # document, start, length, sequence, offset
        self.sequence, self.used = 0, 0

    def add(self, doc: int) -> None:
        start = 0
        while start < self.lengths[doc]:
            take = min(self.window - self.used, self.lengths[doc] - start)
            self.pieces.append((doc, start, take, self.sequence, self.used))
            start, self.used = start + take, self.used + take
            if self.used == self.window:
                self.sequence, self.used = self.sequence + 1, 0

    def close(self) -> None:
        """Cuts the last, partly filled window into powers of two."""
        tail = []
        while self.pieces and self.pieces[-1][3] == self.sequence and self.used:
            tail.append(self.pieces.pop())
        left = self.used
        room = offset = 0
        for doc, start, length, _, _ in reversed(tail):
            while length:
                if not room:
                    room, offset = 1 << (left.bit_length() - 1), 0
                take = min(room, length)
                self.pieces.append((doc, start, take, self.sequence, offset))
                start, length, left = start + take, length - take, left - take
                room, offset = room - take, offset + take
                if not room:
                    self.sequence += 1


def pack_shard(terms: list[np.ndarray], window: int, corpus: Statistics) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """The pieces that fill windows with documents, of which each has an end id behind its terms.

    Besides, how often a window's open rest was given to a neighbour, and to a document that shares
    nothing with the seed, because no free one did.
    """
    index = Bm25(terms, corpus)
    windows = _Windows([len(t) + 1 for t in terms], window)
    free = np.ones(len(terms), bool)
    cursor = related = unrelated = 0
    seed = None
    while True:
        if seed is None:
            while cursor < len(terms) and not free[cursor]:
                cursor += 1
            if cursor == len(terms):
                break
            seed = cursor
            free[seed] = False
            unrelated += windows.used > 0
            windows.add(seed)
        at, nxt = windows.sequence, None
        if windows.used:
            for other in index.neighbours(seed, free):
                free[other] = False
                related += 1
                windows.add(other)
                if windows.sequence != at:
                    # The window is full: what is left of the last neighbour seeds the next one.
                    nxt = other if windows.used else None
                    break
        seed = nxt
    windows.close()
    return windows.pieces, related, unrelated


def _parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in halves of halves, until each is of GROUP_BYTES or a single row."""
    if batch.num_rows < 2 or batch.nbytes <= GROUP_BYTES:
        yield batch
    else:
        half = batch.num_rows // 2
        yield from _parts(batch.slice(0, half))
        yield from _parts(batch.slice(half))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together up to a number of bytes."""
    group, size = [], 0
    for batch in batches:
        for part in _parts(batch):
            if group and size + part.nbytes > GROUP_BYTES:
                yield pa.Table.from_batches(group)
                group, size = [], 0
            group.append(part)
            size += part.nbytes
    if group:
        yield pa.Table.from_batches(group)


def tokenized(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, row, ids, n): the token ids of each row of docs without an end id, in as few bytes as the
    vocabulary allows, and their number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = word_ids(tokenizer)
        for group in _groups(batches):
            ids = words.of(group.column("text").combine_chunks())
            yield from pa.table(
                {
                    "doc_id": group.column("doc_id"),
                    "row": group.column("row"),
                    "ids": pa.array([i.tobytes() for i in ids], pa.binary()),
                    "n": pa.array([len(i) for i in ids], pa.int64()),
                }
            ).to_batches()
        # The worker lives on for other tasks: what Arrow holds for later goes back.
        pa.default_memory_pool().release_unused()

    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInArrow(run, "doc_id long, row long, ids binary, n long")


def _arrays(column: pa.Array, vocabulary: int) -> list[np.ndarray]:
    kind = _kind(vocabulary)
    return [np.frombuffer(b, kind) for b in column.to_pylist()]


def corpus_statistics(tokens: DataFrame, vocabulary: int) -> Statistics:
    """Document frequencies of all terms; the driver gets one row per term of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(vocabulary, np.int64)
        for batch in batches:
            for ids in _arrays(batch.column("ids"), vocabulary):
                count[_terms(ids)[0]] += 1
        terms = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.int32()), pa.array(count[terms])], ["term", "n"])

    frequency = np.zeros(vocabulary, np.int64)
    for row in tokens.select("ids").mapInArrow(run, "term int, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        frequency[row["term"]] = row["n"]
    whole = tokens.agg(F.count(F.lit(1)).alias("documents"), F.coalesce(F.sum("n"), F.lit(0)).alias("tokens")).first()
    return Statistics(whole["documents"], whole["tokens"], frequency)


def keyed(tokens: DataFrame, corpus: Statistics) -> DataFrame:
    """Adds the rank `key` of each document's rarest shared term, and a hash `more` of the next ones."""
    vocabulary = len(corpus.idf)
    spread = np.arange(1, KEY_TERMS, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array([corpus.keys(i) for i in _arrays(batch.column("ids"), vocabulary)], np.int64)
            keys = keys.reshape(-1, KEY_TERMS)
            with np.errstate(over="ignore"):
                more = mix(keys[:, 1:].astype(np.uint64) * KEY_TERMS + spread).sum(axis=1) >> np.uint64(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys[:, 0]), pa.array(more.astype(np.int64))], [*batch.schema.names, "key", "more"]
            )

    return tokens.mapInArrow(run, "doc_id long, row long, ids binary, n long, key long, more long")


def dealt(keys: DataFrame, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Adds the number of each document's shard.

    Terms with few tokens share a shard, in the order of their frequency; terms with many have several.
    A shard that is still too large holds documents with the same rarest terms: they are split by row.
    """
    spark = keys.sparkSession
    cost = F.col("n") + 1
    # The driver sees one row per term of the vocabulary.
    sizes = keys.groupBy("key").agg(F.sum(cost).alias("size")).orderBy("key").collect()
    base = used = 0
    plan = []
    for row in sizes:
        own = -(-row["size"] // shard_tokens)
        if own > 1 or used + row["size"] > shard_tokens:
            base, used = base + (used > 0), 0
        plan.append((row["key"], base, own))
        base, used = (base + own, 0) if own > 1 else (base, used + row["size"])
    places = spark.createDataFrame(plan, "key long, base long, own long")
    placed = keys.join(F.broadcast(places), "key").withColumn("shard", F.col("base") + F.col("more") % F.col("own"))
    heavy = (
        placed.groupBy("shard")
        .agg(F.sum(cost).alias("size"))
        .filter(F.col("size") > 2 * shard_tokens)
        .withColumn("parts", F.ceil(F.col("size") / shard_tokens))
    )
    # Numbers behind all others: as many rows here as there are shards that are split.
    first = F.sum("parts").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    heavy = materialize(heavy.select("shard", "parts", (F.coalesce(first, F.lit(0)) + base + 1).alias("first")), "heavy")
    split = F.col("first") + F.pmod(F.xxhash64("row"), F.col("parts"))
    return placed.join(heavy, "shard", "left").withColumn("shard", F.coalesce(split, F.col("shard")))


def pack_documents(docs: DataFrame, tokenizer: str, window: int = WINDOW, shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset), a row per piece.

    Every row of docs is tokenized whole and ended by id 1; each of its ids lies in one piece. A
    sequence has `window` ids or a power of two. Null and empty texts are the end id alone. Repeated
    rows and null ids are packed like others. Columns other than doc_id and text are not read.
    `tokenizer` is a file that every machine has.
    """
    spark = docs.sparkSession
    path = scratch(spark, "tokens")
    found = tokenized(docs, tokenizer)
    found.write.parquet(path)
    tokens = spark.read.schema(found.schema).parquet(path)
    corpus = corpus_statistics(tokens, word_ids(tokenizer).size)
    keys = materialize(keyed(tokens, corpus), "keyed-tokens")
    # The keyed tokens are written: nothing reads the others again.
    remove(spark, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches)).sort_by("row")
        number = table.column("shard")[0].as_py()
        names = table.column("doc_id").to_pylist()
        terms = _arrays(table.column("ids").combine_chunks(), len(corpus.idf))
        pieces, _, _ = pack_shard(terms, window, corpus)
        doc, start, length, sequence, offset = list(zip(*pieces, strict=True)) or [()] * 5
        ids = [memoryview(np.append(t, END_ID).astype("<u4").tobytes()) for t in terms]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([names[d] for d in doc], pa.int64()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array([zlib.crc32(ids[d][4 * s : 4 * (s + n)]) for d, s, n in zip(doc, start, length, strict=True)], pa.int64()),
                pa.array([len(terms[d]) + 1 for d in doc], pa.int64()),
                pa.array([(number << 32) + s for s in sequence], pa.int64()),
                pa.array(offset, pa.int64()),
            ],
            schema=_PIECES,
        )

    return dealt(keys, shard_tokens).select("doc_id", "row", "ids", "shard").groupBy("shard").applyInArrow(
        run, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    )
