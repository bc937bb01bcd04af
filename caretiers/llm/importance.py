"""Importance resampling: a sample of the documents that is distributed like a target corpus.

Runs of one to three words are features, dealt into buckets by the CRC-32 of their bytes. A bucket's
gain is the log ratio of its shares in the target and in all documents; a document's weight is the
sum of its gains, and the highest weights, each with Gumbel noise of its own, are the sample.

CRC-32 is linear: the CRC of a span is that of as many zero bytes, XOR what each byte adds by its
distance from the span's end. A table holds what every byte adds at every distance, so all spans of a
batch are one look-up per byte and one `bitwise_xor.reduceat`. Spans longer than the table's reach
are cut into blocks of its size: what was found so far is folded into the next block's first bytes.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dense_rank, materialize, raw_texts

#: Features are dealt into so many buckets, and have one to so many words.
BUCKETS, LONGEST = 10_000, 3
#: Distances from a span's end that the table knows.
REACH = 256
#: Bytes looked up at a time.
SLICE_BYTES = 1_000_000

# What words consist of after lower-casing A-Z: digits, a-z and all bytes beyond ASCII.
_FOLDED = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256)
)
_SPACE = 0x20


def _position_table(reach: int) -> np.ndarray:
    """[d, b]: what byte b adds to the CRC of a span that ends d bytes from it, itself counted; 0 for d = 0."""
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = np.where(single & 1, (single >> 1) ^ np.uint32(0xEDB88320), single >> 1).astype(np.uint32)
    table = np.zeros((reach + 1, 256), np.uint32)
    table[1] = single
    for d in range(2, reach + 1):
        # One more zero byte behind it.
        table[d] = single[table[d - 1] & 0xFF] ^ (table[d - 1] >> 8)
    return table


_TABLE = _position_table(REACH)
_ADDED = _TABLE.ravel()
#: The CRC of so many zero bytes.
_ZEROS = np.array([zlib.crc32(bytes(n)) for n in range(REACH + 1)], np.uint32)


def _folded(span: np.ndarray) -> int:
    """The CRC of one span of any length, block by block."""
    state = 0xFFFFFFFF
    head = len(span) % REACH
    for block in (span[:head], *span[head:].reshape(-1, REACH)):
        size = len(block)
        added = int(np.bitwise_xor.reduce(_TABLE[np.arange(size, 0, -1), block])) if size else 0
        carried = state >> (8 * size) if size < 4 else 0
        for k in range(min(size, 4)):
            carried ^= int(_TABLE[size - k, (state >> (8 * k)) & 0xFF])
        state = carried ^ added
    return state ^ 0xFFFFFFFF


def span_crcs(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of the bytes data[begin:end] of each span; spans are ascending, apart and not empty."""
    out = np.empty(len(begins), np.uint32)
    cuts = np.flatnonzero(np.diff(begins // SLICE_BYTES)) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), len(begins)]):
        if low == high:
            continue
        b, e = begins[low:high], ends[low:high]
        start, stop = int(b[0]), int(e[-1])
        # Bytes between two spans are at distance 0 of the end before them, or less: they add nothing.
        distance = np.repeat((e - start).astype(np.int32), np.diff(np.append(b, stop)))
        distance -= np.arange(stop - start, dtype=np.int32)
        np.clip(distance, 0, REACH, out=distance)
        distance <<= 8
        distance |= data[start:stop]
        size = e - b
        out[low:high] = np.bitwise_xor.reduceat(_ADDED[distance], b - start) ^ _ZEROS[np.minimum(size, REACH)]
        for k in np.flatnonzero(size > REACH).tolist():
            out[low + k] = _folded(data[b[k] : e[k]])
    return out


def feature_crcs(texts: list[bytes], longest: int = LONGEST) -> tuple[np.ndarray, Iterator[tuple[np.ndarray, np.ndarray]]]:
    """The number of words of each text, and for 1, 2, ... words the texts and CRCs of the features."""
    words = [t.translate(_FOLDED).split() for t in texts]
    counts = np.array([len(w) for w in words], np.int64)
    data = np.frombuffer(b" ".join(chain.from_iterable(words)), np.uint8)
    text = np.repeat(np.arange(len(texts)), counts)

    def features() -> Iterator[tuple[np.ndarray, np.ndarray]]:
        gaps = np.flatnonzero(data == _SPACE)
        begins = np.concatenate(([0], gaps + 1)) if len(data) else gaps
        ends = np.append(gaps, len(data)) if len(data) else gaps
        for n in range(1, longest + 1):
            count = max(len(begins) - n + 1, 0)
            crcs = np.empty(count, np.uint32)
            # Every n-th feature is apart from the others of its kind.
            for first in range(min(n, count)):
                crcs[first::n] = span_crcs(data, begins[first:count:n], ends[first + n - 1 :: n])
            within = text[:count] == text[n - 1 :]
            yield text[:count][within], crcs[within]

    return counts, features()


def _groups(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts) of a batch, in groups of bounded size but for one longer text."""
    texts, first, size = raw_texts(batch), 0, 0
    for k, text in enumerate(texts):
        if k > first and size + len(text) > 4 * SLICE_BYTES:
            yield first, texts[first:k]
            first, size = k, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): how many features of all rows of `text` fall into each bucket that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, group in _groups(batch):
                for _, crcs in feature_crcs(group)[1]:
                    total += np.bincount(crcs % np.uint32(buckets), minlength=buckets)
        filled = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(filled, pa.int32()), pa.array(total[filled], pa.int64())], ["bucket", "n"])

    counted = texts.select("text").mapInArrow(run, "bucket int, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """Per bucket, floor(1000 * ln) of the ratio of its smoothed shares in target and docs. The driver
    gets one row per bucket and side."""

    def counts(texts: DataFrame) -> list[int]:
        found = {r["bucket"]: r["n"] for r in bucket_counts(texts, buckets).collect()}
        return [found.get(b, 0) for b in range(buckets)]

    source, wanted = counts(docs), counts(target)
    S, T = sum(source), sum(wanted)
    return np.array(
        [math.floor(1000 * math.log((t + 1) * (S + buckets) / ((s + 1) * (T + buckets)))) for s, t in zip(source, wanted)],
        np.int64,
    )


def weigh(docs: DataFrame, gains: np.ndarray) -> DataFrame:
    """(doc_id, n_words, n_features, weight), a row for each row of docs."""
    buckets = np.uint32(len(gains))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_features, weight = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for first, group in _groups(batch):
                rows = slice(first, first + len(group))
                n_words[rows], features = feature_crcs(group)
                for text, crcs in features:
                    n_features[rows] += np.bincount(text, minlength=len(group))
                    # Sums of integers: exact as doubles.
                    weight[rows] += np.bincount(text, gains[crcs % buckets], len(group)).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in (n_words, n_features, weight))],
                ["doc_id", "n_words", "n_features", "weight"],
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_words long, n_features long, weight long")


def gumbel(seed: int, doc_id: Column) -> Column:
    """floor(1000 * Gumbel noise) that only the seed and the document's id decide."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named, 256), 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, buckets: int = BUCKETS
) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank), a row for each row of docs.

    Of the rows with at least `least_words` words, `percent` in a hundred (rounded down) with the highest
    scores are drawn; rank counts them from 1 and is null elsewhere. Ties go to the smaller id, null
    ids last, and among equal rows to any. Words are runs of digits, a-z and characters beyond ASCII
    after lower-casing A-Z. Null and empty texts have no words, no features and weight 0, and are never
    drawn; they do not change the shares. Repeated rows count and are ranked like any others. An empty
    target or an empty table is smoothed like any other. Other columns are not read.

    All texts are read twice: for the buckets' counts (one row per bucket and task is shuffled) and for
    the weights. What is ordered are rows of numbers, in a range shuffle.
    """
    gains = bucket_gains(docs, target, buckets)
    weighed = weigh(docs, gains).withColumn("score", F.col("weight") + gumbel(seed, F.col("doc_id")))
    # The last key parts repeated rows, so that no range has more of them than the others.
    scored = materialize(weighed.withColumn("__row", F.monotonically_increasing_id()), "scores")
    eligible = F.col("n_words") >= least_words
    drawn = scored.filter(eligible).count() * percent // 100
    columns = ["doc_id", "n_words", "n_features", "weight", "score"]
    keyed = scored.select(
        *columns, (~eligible).alias("__out"), (-F.col("score")).alias("__low"),
        F.col("doc_id").isNull().alias("__null"), "__row",
    )
    ranked = dense_rank(keyed, ["__out", "__low", "__null", "doc_id", "__row"], "__rank")
    return ranked.select(*columns, F.when(~F.col("__out") & (F.col("__rank") <= drawn), F.col("__rank")).alias("rank"))
