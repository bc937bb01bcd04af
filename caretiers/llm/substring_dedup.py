"""Substring dedup: words covered by a window of words that starts anywhere else are removed.

Super-k-mer partitioning. The minimiser of a window is the least hash among its short word groups.
Consecutive windows mostly share it, so the stretch they span travels once, as one packed string, to
the bucket of the minimiser. Equal windows have equal minimisers and meet in one bucket, where
sorting counts them. A word group that many windows with different words share, such as those of a
footer, would gather them all in one bucket: groups found often in a sample are minimisers only of
windows that have no other, and such windows go by a hash of all their words. The sample decides about
the sizes of buckets alone, never about the result. A stretch that repeats within a chunk of documents is known to be repeated: it
travels once and its places do not travel at all, so a passage found in a third of all documents is
at most one string per chunk in its bucket.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WordHashes, digest, gram_hashes, materialize, mix, partitions_for, raw_texts, text_key

WINDOW = 35
#: Words in the groups among which the minimiser is chosen.
GROUP = 6
#: Words per chunk: what a task holds at a time, whatever the size of its partition.
CHUNK_WORDS = 3_000_000
#: Text bytes per bucket.
BUCKET_BYTES = 5_000_000
#: A word group is common if its windows alone could fill a bucket: occurrences, each with a stretch of
#: about 400 bytes. Common groups are told by a sample of so many words, or this share if that is more.
COMMON = BUCKET_BYTES // 400
SAMPLE_WORDS, SAMPLE_SHARE, LEAST_SEEN = 4_000_000, 0.002, 8

_BLOBS = "bucket int, doc binary, first int, last int, blob binary"
_BLOB_SCHEMA = pa.schema([("bucket", pa.int32()), ("doc", pa.binary()), ("first", pa.int32()), ("last", pa.int32()), ("blob", pa.binary())])
_RANGE_SCHEMA = pa.schema([("doc", pa.binary()), ("first", pa.int32()), ("last", pa.int32())])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every `width` consecutive values."""
    out, span = values, 1
    while span * 2 <= width:
        out = np.minimum(out[:-span], out[span:])
        span *= 2
    rest = width - span
    return np.minimum(out[: len(out) - rest], out[rest:]) if rest else out


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edge[::2], edge[1::2]


class _Chunk:
    """Documents of one chunk: their words, their keys and where each starts."""

    def __init__(self) -> None:
        self.words: list[bytes] = []
        self.keys: list[bytes] = []
        self.starts: list[int] = []


def _stretches(
    chunk: _Chunk, hashes: np.ndarray, window: int, common: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Super-k-mers: document, first window, last window + 1 (positions in the chunk), minimiser.

    common: hashes of common groups, sorted.
    """
    n = len(hashes)
    starts = np.asarray(chunk.starts, np.int64)
    ends = np.append(starts[1:], n)
    groups = gram_hashes(hashes, GROUP)
    if len(common):
        # Common groups come after all others.
        at = np.minimum(np.searchsorted(common, groups), len(common) - 1)
        groups = (groups >> np.uint64(1)) | ((common[at] == groups).astype(np.uint64) << np.uint64(63))
    least = sliding_min(groups, window - GROUP + 1)
    if len(common):
        alone = np.flatnonzero(least >> np.uint64(63))
        whole = np.zeros(len(alone), np.uint64)
        for k in range(window if len(alone) else 0):
            whole = whole * np.uint64(0x9E3779B97F4A7C15) + hashes[alone + k]
        least[alone] = mix(whole)
    doc = np.repeat(np.arange(len(starts)), ends - starts)[: len(least)]
    valid = np.arange(len(least)) + window <= ends[doc]
    new = np.ones(len(least), bool)
    new[1:] = (least[1:] != least[:-1]) | (doc[1:] != doc[:-1]) | ~valid[:-1]
    begin = np.flatnonzero(new & valid)
    stop = np.flatnonzero(valid & np.append(new[1:] | ~valid[1:], True)) + 1
    return doc[begin], begin, stop, least[begin]


def _pack(chunk: _Chunk, hashes: WordHashes, window: int, buckets: int, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    words = chunk.words
    if len(words) < window:
        return
    ids: dict[bytes, int] = {}
    local = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int32, len(words))
    doc, begin, stop, least = _stretches(chunk, hashes.array(list(ids))[local], window, common)
    raw, width = local.tobytes(), window - 1
    order = np.argsort(least, kind="stable")
    first: dict[bytes, int] = {}
    kind = np.zeros(len(order), np.int8)  # 1: the only one of its string here, 2: the first of several
    again = np.zeros(len(order), bool)
    begins, stops = begin.tolist(), stop.tolist()
    for k in order.tolist():
        string = raw[4 * begins[k] : 4 * (stops[k] + width)]
        seen = first.setdefault(string, k)
        if seen == k:
            kind[k] = 1
        else:
            kind[seen], again[seen], again[k] = 2, True, True
    del first
    starts = np.asarray(chunk.starts, np.int64)
    place = begin - starts[doc]
    # Every occurrence of a string that repeats in the chunk is covered as a whole.
    known = np.flatnonzero(again)
    if len(known):
        # Stretches stand in the order of the text: those that touch are one range.
        last = (place + (stop - begin) + width)[known]
        new = np.ones(len(known), bool)
        new[1:] = (doc[known[1:]] != doc[known[:-1]]) | (place[known[1:]] > last[:-1])
        last, known = last[np.append(new[1:], True)], known[new]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((known % buckets).astype(np.int32)),
                pa.array([chunk.keys[d] for d in doc[known].tolist()], pa.binary()),
                pa.array(place[known].astype(np.int32)),
                pa.array(last.astype(np.int32)),
                pa.nulls(len(known), pa.binary()),
            ],
            schema=_BLOB_SCHEMA,
        )
    bucket = (mix(least) % np.uint64(buckets)).astype(np.int64)
    sent = order[kind[order] > 0]
    sent = sent[np.argsort(bucket[sent], kind="stable")]
    # Only buckets that occur: there may be far more of them than strings in a chunk.
    occurring, cuts = np.unique(bucket[sent], return_index=True)
    packer = zstandard.ZstdCompressor(level=3)
    for b, part in zip(occurring.tolist(), np.split(sent, cuts[1:]), strict=False):
        text = b"\n".join([b" ".join(words[begins[k] : stops[k] + width]) for k in part.tolist()])
        single = kind[part] == 1
        keys = b"".join([chunk.keys[d] for d in doc[part[single]].tolist()])
        body = packer.compress(text)
        places = packer.compress(place[part[single]].astype(np.int32).tobytes())
        head = np.array([len(part), len(body), len(places), len(text)], np.int64).tobytes()
        blob = head + np.packbits(single).tobytes() + body + places + keys
        yield pa.RecordBatch.from_arrays(
            [pa.array([b], pa.int32()), pa.nulls(1, pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int32()), pa.array([blob], pa.binary())],
            schema=_BLOB_SCHEMA,
        )


def _unpack(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, bytes]:
    count, body, places, size = np.frombuffer(blob, np.int64, 4).tolist()
    at = 32 + -(-count // 8)
    single = np.unpackbits(np.frombuffer(blob, np.uint8, at - 32, 32), count=count).astype(bool)
    opener = zstandard.ZstdDecompressor()
    text = opener.decompress(blob[at : at + body], max_output_size=max(size, 1))
    place = np.frombuffer(opener.decompress(blob[at + body : at + body + places], max_output_size=4 * count + 8), np.int32)
    return text.split(b"\n"), single, place, blob[at + body + places :]


def _equal_windows(ids: np.ndarray, starts: np.ndarray, window: int) -> np.ndarray:
    """Class numbers of windows: equal exactly when all their words are."""
    mixed = mix(ids.astype(np.uint64) + np.uint64(1))
    odd = np.uint64(0xD6E8FEB86659FD93)
    inverse = np.uint64(pow(int(odd), -1, 1 << 64))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(ids), odd, np.uint64))
        back = np.cumprod(np.full(len(ids), inverse, np.uint64))
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed * power)))
        hashed = (sums[starts + window] - sums[starts]) * back[starts]
    order = np.argsort(hashed, kind="stable")
    ordered = hashed[order]
    same = ordered[1:] == ordered[:-1]
    near, steps = np.flatnonzero(same), np.arange(window)
    for at in range(0, len(near), 100_000):
        part = near[at : at + 100_000]
        left, right = starts[order[part]], starts[order[part + 1]]
        if not np.array_equal(ids[left[:, None] + steps], ids[right[:, None] + steps]):
            # Two different windows with one hash: compare whole windows instead.
            table = np.ascontiguousarray(ids[starts[:, None] + steps])
            return np.unique(table.view(f"V{4 * window}").ravel(), return_inverse=True)[1]
    number = np.empty(len(starts), np.int64)
    number[order] = np.concatenate(([0], np.cumsum(~same)))
    return number


def _count(blobs: list[bytes], window: int) -> Iterator[pa.RecordBatch]:
    """Covered ranges of the places whose windows are found twice or more in the bucket."""
    vocabulary: dict[bytes, int] = {}
    ids, lengths, singles, places, keys = [], [], [], [], []
    for blob in blobs:
        strings, single, place, key = _unpack(blob)
        for string in strings:
            row = [vocabulary.setdefault(w, len(vocabulary)) for w in string.split(b" ")]
            lengths.append(len(row))
            ids.append(np.array(row, np.int32))
        singles.append(single)
        places.append(place)
        keys.append(key)
    if not ids:
        return
    flat, size, single = np.concatenate(ids), np.asarray(lengths), np.concatenate(singles)
    begin = np.concatenate(([0], np.cumsum(size)))[:-1]
    windows = size - window + 1
    owner = np.repeat(np.arange(len(size)), windows)
    offset = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(windows)))[:-1], windows)
    number = _equal_windows(flat, begin[owner] + offset, window)
    weight = np.bincount(number, np.where(single[owner], 1, 2))
    found = (weight[number] >= 2) & single[owner]
    if not found.any():
        return
    place, key = np.concatenate(places), b"".join(keys)
    index = np.cumsum(single) - 1
    # A break between strings keeps runs of windows apart.
    spread = np.zeros(len(found) + len(size), bool)
    spread[np.arange(len(found)) + owner] = found
    left, right = _runs(spread)
    string = owner[left - np.searchsorted(np.cumsum(windows) + np.arange(len(size)), left, side="right")]
    shift = np.concatenate(([0], np.cumsum(windows + 1)))[:-1][string]
    row = index[string]
    start = place[row] + (left - shift)
    end = place[row] + (right - shift) + window - 1
    yield pa.RecordBatch.from_arrays(
        [pa.array([key[16 * r : 16 * r + 16] for r in row.tolist()], pa.binary()), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
        schema=_RANGE_SCHEMA,
    )


def common_groups(docs: DataFrame, size: int, most: int = COMMON) -> np.ndarray:
    """Sorted hashes of word groups found more than about `most` times in texts of `size` bytes in all."""
    share = min(1.0, max(SAMPLE_WORDS * 6 / max(size, 1), SAMPLE_SHARE))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            found = [gram_hashes(hashes.array(text.split()), GROUP) for text in raw_texts(batch)]
            group, times = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(group.view(np.int64)), pa.array(times.astype(np.int64))], ["g", "n"])

    sample = docs.select("text") if share == 1.0 else docs.select("text").sample(share, 17)
    counted = sample.mapInArrow(count, "g long, n long").groupBy("g").agg(F.sum("n").alias("n"))
    rows = counted.filter(F.col("n") > max(most * share, min(most, LEAST_SEEN))).select("g").collect()
    return np.sort(np.array([r["g"] for r in rows], np.int64).view(np.uint64))


def covered_ranges(docs: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS, most: int = COMMON) -> DataFrame:
    """(key, ranges): word ranges to remove for each text (by its key) that has any.

    Equal texts have equal ranges, so a text is named by a digest of itself and not by its id.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = partitions_for(spark, size, BUCKET_BYTES)
    shared = spark.sparkContext.broadcast(common_groups(docs, size, most))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk, hashes = _Chunk(), WordHashes()
        for batch in batches:
            for text in raw_texts(batch):
                words = text.split()
                if len(words) < window:
                    continue
                chunk.keys.append(digest(text))
                chunk.starts.append(len(chunk.words))
                chunk.words.extend(words)
                if len(chunk.words) >= chunk_words:
                    yield from _pack(chunk, hashes, window, buckets, shared.value)
                    chunk = _Chunk()
        yield from _pack(chunk, hashes, window, buckets, shared.value)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blobs: list[bytes] = []
        for batch in batches:
            known = batch.filter(pa.compute.is_null(batch.column("blob")))
            if known.num_rows:
                yield known.select(["doc", "first", "last"])
            blobs += [b for b in batch.column("blob").to_pylist() if b is not None]
        yield from _count(blobs, window)

    packed = docs.select("text").mapInArrow(cut, _BLOBS)
    ranges = packed.groupBy("bucket").applyInArrow(count, "doc binary, first int, last int")
    joined = ranges.groupBy(F.col("doc").alias("key")).agg(F.collect_set(F.struct("first", "last")).alias("ranges"))
    return materialize(joined, "ranges")


def remove_repeated(docs: DataFrame, window: int = WINDOW, chunk_words: int = CHUNK_WORDS, most: int = COMMON) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256), a row per row of docs.

    Every word inside a window of `window` words that starts anywhere else as well, in the same text
    or another, is removed; `kept` joins the other words by one space. Windows are judged on the
    input. Null and empty texts have no words; texts shorter than a window lose none; repeated rows
    cover each other. Null ids are kept as they are, other columns are not read.
    """
    ranges = covered_ranges(docs, window, chunk_words, most)
    keyed = docs.select("doc_id", "text", text_key(F.col("text")).alias("key"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, left, sums = [], [], [], []
            for text, cover in zip(raw_texts(batch), batch.column("ranges").to_pylist(), strict=True):
                words = text.split()
                total.append(len(words))
                if cover:
                    drop = np.zeros(len(words) + 1, np.int32)
                    for r in cover:
                        drop[r["first"]] += 1
                        drop[r["last"]] -= 1
                    keep = np.cumsum(drop[:-1]) == 0
                    words = [words[k] for k in np.flatnonzero(keep).tolist()]
                gone.append(total[-1] - len(words))
                body = b" ".join(words)
                left.append(body.decode("utf-8", "replace"))
                sums.append(hashlib.sha256(body).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(left, pa.string()), pa.array(sums, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    return (
        keyed.join(ranges, "key", "left")
        .select("doc_id", "text", "ranges")
        .mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string, kept_sha256 string")
    )
