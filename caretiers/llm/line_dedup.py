"""Line dedup: runs of lines that stand earlier in the corpus are deleted.

Suffix array over the sequences of line ids, by distributed prefix doubling. Lines found once get no
id and end a sequence. Round k ranks every place by its next 2^k lines: the rank of a place and that
of the place 2^k lines further on make a pair, distinct pairs are ordered by a range shuffle, and
their numbers are the ranks of the next round. Places whose block is found once drop out.

Places that agree on m lines are an interval of the suffix array with a longest common prefix of at
least m; two overlapping blocks of 2^k lines name it. A run matters if it has `min_words` words, so
the shortest such run from every place and to every place is looked up: the first place of its
interval stays, the lines of all others are deleted. Together these runs cover exactly the later
copies of all maximal repeated runs of that many words. As a line has a word at least, runs of
min_words lines decide everything and deeper rounds are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import dense_rank, digest, materialize, raw_texts, text_key

MIN_WORDS = 10


def _lines(text: bytes) -> tuple[list[bytes], list[int]]:
    """Lines with a word, and their word counts."""
    lines, counts = [], []
    for line in text.split(b"\n"):
        n = len(line.split())
        if n:
            lines.append(line)
            counts.append(n)
    return lines, counts


def shortest_runs(counts: list[int], min_words: int) -> tuple[list[int | None], list[int | None]]:
    """For every line the least number of lines with min_words words from it on, and up to it."""
    sums = np.concatenate(([0], np.cumsum(counts)))
    at = np.arange(len(counts))
    ahead = np.searchsorted(sums, sums[:-1] + min_words) - at
    back = at + 2 - np.searchsorted(sums, sums[1:] - min_words, side="right")
    ahead = [int(m) if i + m <= len(counts) else None for i, m in enumerate(ahead)]
    back = [int(m) if sums[i + 1] >= min_words else None for i, m in enumerate(back)]
    return ahead, back


def _sequences(docs: DataFrame, min_words: int) -> DataFrame:
    """(ord, key, lines): per document its lines as digest, run ahead, run back."""
    line = pa.struct([("h", pa.binary()), ("ahead", pa.int32()), ("back", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, rows = [], []
            for text in raw_texts(batch):
                lines, counts = _lines(text)
                ahead, back = shortest_runs(counts, min_words) if counts else ([], [])
                keys.append(digest(text))
                rows.append([{"h": digest(x), "ahead": a, "back": b} for x, a, b in zip(lines, ahead, back, strict=True)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(rows, pa.list_(line))], ["doc_id", "key", "lines"]
            )

    read = docs.select("doc_id", "text").mapInArrow(
        run, "doc_id long, key binary, lines array<struct<h: binary, ahead: int, back: int>>"
    )
    # Rows with one id and one text are one document; a missing id comes last.
    return read.groupBy(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("ord"), "key").agg(F.first("lines").alias("lines"))


def _next_round(ranks: DataFrame, shift: int) -> DataFrame:
    """Ranks of blocks twice as long, of the places whose block is found more than once."""
    ahead = Window.partitionBy("doc").orderBy("seq").rangeBetween(shift, shift)
    pairs = ranks.withColumn("r2", F.max("r").over(ahead)).filter(F.col("r2").isNotNull())
    pairs = materialize(pairs, "pairs")
    distinct = pairs.groupBy("r", "r2").count().filter("count > 1").select("r", "r2")
    ranked = dense_rank(distinct, ["r", "r2"], "rank")
    return materialize(pairs.join(ranked, ["r", "r2"]).select("doc", "seq", F.col("rank").alias("r")), "ranks")


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(ord, key, gone): ranges (first, count) of lines with words to delete from each document."""
    numbered = materialize(dense_rank(_sequences(docs, min_words), ["ord", "key"], "doc"), "numbered")
    lines = numbered.select("doc", F.posexplode("lines").alias("seq", "line")).select("doc", "seq", "line.*")
    repeated = lines.groupBy("h").count().filter("count > 1").select("h")
    places = materialize(
        lines.join(dense_rank(repeated, ["h"], "r"), "h").select("doc", F.col("seq").cast("int").alias("seq"), "r", "ahead", "back"),
        "places",
    )
    blocks = (
        places.select("doc", F.col("seq").alias("first"), F.col("ahead").alias("m"))
        .unionByName(places.select("doc", (F.col("seq") - F.col("back") + 1).alias("first"), F.col("back").alias("m")))
        .filter("m is not null")
        .distinct()
    )
    blocks = materialize(blocks, "blocks")
    ranks, length, named = places.select("doc", "seq", "r"), 1, None
    while True:
        here = blocks.filter(F.col("m").between(length, 2 * length - 1))
        one = ranks.select("doc", F.col("seq").alias("first"), F.col("r").alias("x"))
        part = here.join(one, ["doc", "first"])
        if length == 1:
            part = part.withColumn("y", F.col("x"))
        else:
            two = ranks.select("doc", (F.col("seq") + length).alias("end"), F.col("r").alias("y"))
            part = part.withColumn("end", F.col("first") + F.col("m")).join(two, ["doc", "end"]).drop("end")
        part = part.select("doc", "first", "m", "x", "y")
        named = part if named is None else named.unionByName(part)
        length *= 2
        if length > min_words:
            break
        ranks = _next_round(ranks, length // 2)
        if ranks.isEmpty():
            break
    named = materialize(named, "named")
    # All places of an interval but the first. Minima are made before the shuffle.
    kept = named.groupBy("m", "x", "y").agg(F.min(F.struct("doc", "first")).alias("kept"))
    later = named.join(materialize(kept, "kept"), ["m", "x", "y"]).filter(
        (F.col("doc") != F.col("kept.doc")) | (F.col("first") != F.col("kept.first"))
    )
    gone = later.groupBy("doc").agg(F.collect_set(F.struct("first", F.col("m").alias("count"))).alias("gone"))
    return materialize(numbered.select("doc", "ord", "key").join(gone, "doc").select("ord", "key", "gone"), "gone")


def remove_later_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """docs with the lines of later copies deleted, and n_lines and n_removed (lines with a word).

    Documents come in the order of doc_id (null last), then of a digest of the text. A line belongs to
    a later copy if it lies in a run of lines with at least min_words words that also starts at an
    earlier place. Lines count as equal when they are so byte by byte; lines without a word are
    passed over and stay. Rows with the same id and text are one document and are cut alike. Null and
    empty texts stay as they are. n_chars, where docs has it, is that of the new text. Columns named
    n_lines or n_removed are replaced; all others are passed on.
    """
    gone = repeated_lines(docs, min_words)
    names = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    own = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"),
        F.coalesce("doc_id", F.lit(2**63 - 1)).alias("ord"),
        text_key(F.col("text")).alias("key"),
    )
    joined = own.join(gone, ["ord", "key"], "left").select("doc", "gone")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in names)
    at = names.index("text")
    chars = names.index("n_chars") if "n_chars" in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, totals, removed, sizes = [], [], [], []
            columns = batch.column("doc").flatten()
            old = columns[at].cast("binary").to_pylist()
            for text, ranges in zip(old, batch.column("gone").to_pylist(), strict=True):
                lines, n = [], 0
                drop = {k for r in ranges or () for k in range(r["first"], r["first"] + r["count"])}
                for line in (text or b"").split(b"\n"):
                    if line.split(None, 1):
                        n += 1
                        if n - 1 in drop:
                            continue
                    lines.append(line)
                new = text if text is None or not drop else b"\n".join(lines)
                texts.append(None if new is None else new.decode("utf-8", "replace"))
                totals.append(n)
                removed.append(len(drop))
                sizes.append(len(texts[-1]) if drop else None)
            columns[at] = pa.array(texts, columns[at].type)
            if chars is not None:
                before = columns[chars].to_pylist()
                columns[chars] = pa.array([b if s is None else s for b, s in zip(before, sizes, strict=True)], columns[chars].type)
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(totals, pa.int64()), pa.array(removed, pa.int64())], [*names, "n_lines", "n_removed"]
            )

    return joined.mapInArrow(run, f"{schema}, n_lines long, n_removed long")
