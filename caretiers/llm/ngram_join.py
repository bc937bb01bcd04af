"""N-gram Jaccard join: documents whose shingle sets overlap by a given share, and their components.

Prefix filtering under several global orders. If two sets overlap enough, their first few tokens
under any order of all tokens have one in common. The orders here differ but all put rare tokens
first, so few documents share a token by chance. Candidates come from the first order and must share
a token under the others too before the whole sets are compared.

Equal sets are one class from the start. Classes that share a prefix token are first compared with
one of them, then with the best connected; the components found so far make most other pairs of a
large group unnecessary. What shares a token and is still in different components is compared in
blocks of bounded size, which give links and never pairs. No link between components is lost.

Sets are large, so few of them move. Pairs are first tested on 16 bits of each token, which tells
nearly all that do not overlap; tokens with the least member in common are compared as one, so that a
set does not move once for each of its tokens; and what moves at once is bounded, by slices.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import CACHE_WORDS, WordHashes, components, digest, discard, gram_hashes, materialize, mix, raw_texts, scratch, tidy

#: Words whose counts order the tokens: the most frequent ones, a fixed number at any scale (8 MB).
#: Others count as rarer than these. The counts only decide which tokens come first; the result
#: does not depend on them.
COUNTED_WORDS = 500_000
ORDERS = 3


class Shingles:
    """Sets of word n-grams of texts, as sorted distinct 64-bit hashes."""

    def __init__(self, n: int):
        self.n, self.words = n, WordHashes()

    def __call__(self, text: bytes) -> np.ndarray:
        return np.unique(self.sequence(text)[0])

    def sequence(self, text: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the shingles in order, and of the words."""
        words = text.lower().split()
        if not words:
            return np.empty(0, np.uint64), np.empty(0, np.uint64)
        hashes = self.words.array(words)
        # A text shorter than n is one shingle, which differs from all those of n words.
        return gram_hashes(hashes, min(self.n, len(words))) + np.uint64(max(0, self.n - len(words))), hashes


def least_overlap(size: np.ndarray | int, num: int, den: int):
    """Tokens that a set must share with any set it is linked to: the least k with den*k >= num*size."""
    return -(-num * size // den)


def word_counts(docs: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (sorted) and counts of the most frequent words of all documents."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[bytes] = Counter()

        def out() -> pa.RecordBatch:
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, counts), np.uint64, len(counts)).view(np.int64)
            batch = pa.RecordBatch.from_arrays([pa.array(hashes), pa.array(list(counts.values()), pa.int64())], ["word", "n"])
            counts.clear()
            return batch

        for batch in batches:
            for text in raw_texts(batch):
                counts.update(text.lower().split())
            if len(counts) >= CACHE_WORDS:
                yield out()
        yield out()

    total = docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    total = materialize(total.filter("n > 1"), "words")
    words = total.count()
    if words > COUNTED_WORDS:
        least = total.select(F.percentile_approx("n", 1 - COUNTED_WORDS / words, 100_000)).first()[0]
        # All words of one count are in or out, so that the table cannot exceed its size.
        total = total.filter(F.col("n") > least)
    found = total.toArrow()
    keys = found.column("word").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return keys[order], np.minimum(found.column("n").to_numpy()[order], 2**31 - 1).astype(np.int32)


def classes(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """(doc_id, set, size, p0, p1, p2) per document: set digest, set size, prefixes under three orders.

    The first prefix has 64-bit tokens; the others only filter and have 32 bits.
    """
    spark = docs.sparkSession
    counted = spark.sparkContext.broadcast(word_counts(docs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles, (keys, counts) = Shingles(n), counted.value
        keys, counts = np.append(keys, np.uint64(2**64 - 1)), np.append(counts, 1)
        for batch in batches:
            names, sizes, prefixes = [], [], [[] for _ in range(ORDERS)]
            for text in raw_texts(batch):
                sequence, words = shingles.sequence(text)
                found, first = np.unique(sequence, return_index=True)
                size = len(found)
                sizes.append(size)
                names.append(digest(found.tobytes()) if size else None)
                length = size - int(least_overlap(size, num, den)) + 1 if size else 0
                # No token is in more documents than its rarest word has occurrences.
                slot = np.searchsorted(keys, words)
                often = np.where(keys[slot] == words, counts[slot], 1)
                span = min(n, len(words))
                rarest = np.minimum.reduce([often[k : len(often) - span + 1 + k] for k in range(span)]) if size else often
                rarest = rarest[first]
                rough = np.log2(rarest).astype(np.uint64)
                for k in range(ORDERS):
                    if k == 0:
                        order = np.lexsort((found, rarest))[:length]
                        prefixes[k].append(found[order].view(np.int64))
                    else:
                        # Rare classes of tokens first, each class in an order of its own.
                        value = (rough << np.uint64(58)) | (mix(found + np.uint64(k)) >> np.uint64(6))
                        part = np.argpartition(value, length - 1)[:length] if length < size else slice(None)
                        prefixes[k].append((found[part] >> np.uint64(20)).astype(np.uint32).view(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(names, pa.binary()),
                    pa.array(sizes, pa.int64()),
                    *[pa.array(p, pa.list_(pa.int64() if k == 0 else pa.int32())) for k, p in enumerate(prefixes)],
                ],
                ["doc_id", "set", "size", "p0", "p1", "p2"],
            )

    return materialize(
        docs.select("doc_id", "text").mapInArrow(
            run, "doc_id long, set binary, size long, p0 array<long>, p1 array<int>, p2 array<int>"
        ),
        "sets",
    )


def _fits(a: Column, b: Column, num: int, den: int) -> Column:
    """Whether two set sizes allow the overlap at all."""
    return (F.least(a, b) * den) >= (F.greatest(a, b) * num)


#: Ids up to this number are broadcast to pick rows; more are joined by shuffle.
BROADCAST_IDS = 500_000


def _picked(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id is among ids (distinct, materialized). Texts are not shuffled for few ids."""
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids, "id", "left_semi")


def _ends(pairs: DataFrame) -> DataFrame:
    return materialize(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "ends")


#: What is shuffled at once to bring rows to pairs, as a part of the bytes of all whole sets, and at least.
SLICE_PART = 4
SLICE_BYTES = 64 << 20


def _in_turn(parts: Iterable[DataFrame], name: str) -> DataFrame:
    """Writes the parts one after the other to one scratch table; shuffle files of one go before the next."""
    spark = path = None
    for part in parts:
        if path is None:
            spark = part.sparkSession
            path = scratch(spark, name)
        else:
            tidy(spark)
        part.write.mode("append").parquet(path)
        schema = part.schema
    return spark.read.schema(schema).parquet(path)


def _turn(column: Column, parts: int, k: int) -> Column:
    return F.pmod(column, F.lit(parts)) == k


def _at_ends(pairs: DataFrame, rows: DataFrame, size: Column, most: int) -> Iterator[DataFrame]:
    """pairs (materialized) with the columns of rows (materialized, with an id) of both ends: x_ and y_ before
    their names. In as many frames as it takes for the shuffles of each to stay near `most` bytes."""
    total, count = rows.agg(F.sum(size), F.count(F.lit(1))).first()
    each = (total or 0) / max(count, 1)
    number = pairs.count()
    parts = max(1, -(-int(2 * each * number + (total or 0)) // most))
    if parts > 1:
        # So few in each slice that the ids of its other ends can be broadcast.
        parts = max(parts, -(-2 * number // BROADCAST_IDS))
    for k in range(parts):
        own, left, right = pairs, rows, rows
        if parts > 1:
            own = pairs.filter(_turn(F.xxhash64("a"), parts, k))
            left = _picked(rows.filter(_turn(F.xxhash64("id"), parts, k)), own.select(F.col("a").alias("id")).distinct())
            right = _picked(rows, own.select(F.col("b").alias("id")).distinct())
        left = left.withColumnsRenamed({c: "a" if c == "id" else f"x_{c}" for c in rows.columns})
        right = right.withColumnsRenamed({c: "b" if c == "id" else f"y_{c}" for c in rows.columns})
        yield own.join(left, "a").join(right, "b")


def _filtered(pairs: DataFrame, ends: DataFrame, found: DataFrame, num: int, den: int, most: int) -> DataFrame:
    """Pairs (a, b) of fitting sizes that share prefix tokens under the other orders as well."""
    heads = _picked(found.select(F.col("doc_id").alias("id"), "size", "p1", "p2"), ends).distinct()
    heads = materialize(heads, "heads")

    def fits(joined: DataFrame) -> DataFrame:
        shared = F.arrays_overlap("x_p1", "y_p1") & F.arrays_overlap("x_p2", "y_p2")
        return joined.filter(_fits(F.col("x_size"), F.col("y_size"), num, den) & shared).select("a", "b").distinct()

    tried = _in_turn(map(fits, _at_ends(pairs, heads, 4 * (F.size("p1") + F.size("p2")) + 24, most)), "tried")
    discard(heads, ends)
    return tried


def sketch(found: np.ndarray) -> np.ndarray:
    """The first 16 bits of sorted hashes, each value once: what two sets share, theirs do too."""
    return np.unique((found >> np.uint64(48)).astype(np.uint16))


def _sets_of(docs: DataFrame, ends: DataFrame, n: int, repeated: bool, whole: bool = True) -> DataFrame:
    """(id, size, tokens): whole sets, or sketches of them, of the documents with the given ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(n)
        for batch in batches:
            found = [shingles(t) for t in raw_texts(batch)]
            sizes = pa.array([len(x) for x in found], pa.int64())
            tokens = pa.array([(x if whole else sketch(x)).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column("id"), sizes, tokens], ["id", "size", "tokens"])

    rows = _picked(docs.select(F.col("doc_id").alias("id"), "text"), ends)
    sets = rows.mapInArrow(run, "id long, size long, tokens binary")
    # Only where ids stand on several rows do equal sets have to be thrown together.
    return materialize(sets.distinct() if repeated else sets, "tokens" if whole else "sketches")


def most_shared(a: np.ndarray, b: np.ndarray, size_a: int, size_b: int) -> int:
    """How many tokens two sets of the given sizes share at most, by their tokens or sketches.

    Tokens that fall on one value of a sketch may all be shared: each value counts once, and besides as
    many as have no value of their own in both. For whole sets there are none and the number is exact.
    """
    return len(np.intersect1d(a, b, assume_unique=True)) + min(size_a - len(a), size_b - len(b))


def _overlapping(pairs: DataFrame, sets: DataFrame, kind: type, num: int, den: int, most: int, name: str) -> DataFrame:
    """Pairs (materialized) whose sets (tokens of the given kind) may overlap enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            columns = (batch.column(c).to_pylist() for c in ("x_tokens", "y_tokens", "x_size", "y_size"))
            for k, (x, y, size_x, size_y) in enumerate(zip(*columns, strict=True)):
                both = most_shared(np.frombuffer(x, kind), np.frombuffer(y, kind), size_x, size_y)
                if den * both >= num * (size_x + size_y - both):
                    keep.append(k)
            yield batch.select(["a", "b"]).take(pa.array(keep, pa.int64()))

    found = _at_ends(pairs, sets, F.octet_length("tokens") + 24, most)
    return _in_turn((x.mapInArrow(run, "a long, b long").distinct() for x in found), name)


def _verified(docs: DataFrame, pairs: DataFrame, n: int, num: int, den: int, repeated: bool, most: int) -> DataFrame:
    """Pairs (materialized) whose whole sets overlap enough. Only those whose sketches allow it are compared."""
    for whole, kind, name in ((False, np.uint16, "close"), (True, np.uint64, "links")):
        ends = _ends(pairs)
        sets = _sets_of(docs, ends, n, repeated, whole)
        pairs = _overlapping(pairs, sets, kind, num, den, most, name)
        discard(sets, ends)
    return pairs


#: Members that a group of classes is compared with in the first phase.
CENTRES = 4


#: Times that the best connected class of each token is taken for its centre.
HUB_ROUNDS = 2


def _open_tokens(shared: DataFrame, heads: DataFrame, found: DataFrame) -> DataFrame:
    """(token, id, size, c): members of the tokens whose members are in several components c."""
    placed = shared.select("token", "id").join(found.withColumnRenamed("node", "id"), "id", "left")
    placed = placed.join(heads.select("id", "size"), "id").select("token", "id", "size", F.coalesce("component", "id").alias("c"))
    placed = materialize(placed, "placed")
    several = placed.groupBy("token").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).filter("lo < hi").select("token")
    open_ = materialize(placed.join(several, "token"), "open")
    discard(placed)
    return open_


def linked(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their class, links between classes, and components of the classes.

    Classes are named by their least doc_id. Sets a and b are linked when den * |a & b| is at least
    num * |a | b|. The links have the components of all links: the first phase compares every class
    with a few members of each group that shares a prefix token, the second all pairs that share one
    and are still in different components.
    """
    found = classes(docs, n, num, den)
    named = found.filter(F.col("set").isNotNull() & F.col("doc_id").isNotNull())
    repeated = not named.groupBy("doc_id").count().filter("count > 1").isEmpty()
    heads = named.groupBy("set").agg(F.min("doc_id").alias("id"), F.first("size").alias("size"), F.first("p0").alias("p0"))
    heads = materialize(heads, "classes")
    tidy(docs.sparkSession)
    most = max(SLICE_BYTES, 8 * (found.agg(F.sum("size")).first()[0] or 0) // SLICE_PART)
    entries = heads.select("id", F.explode("p0").alias("token"))
    # Every token draws a class by one of a few orders of the ids: the least id after flipping some
    # bits. Large groups thus have a few centres, and two numbers per token and task are shuffled.
    flips = [int(x) for x in mix(np.arange(1, CENTRES + 1, dtype=np.uint64)) >> np.uint64(1)]
    flip = F.element_at(F.array(*[F.lit(x) for x in flips]), (F.pmod("token", F.lit(CENTRES)) + 1).cast("int"))
    drawn = (
        entries.withColumn("x", F.col("id").bitwiseXOR(flip))
        .groupBy("token")
        .agg(F.min("x").alias("lo"), F.max("x").alias("hi"))
        .filter("lo < hi")
        .select("token", F.col("lo").bitwiseXOR(flip).alias("centre"))
    )
    shared = materialize(entries.join(drawn, "token"), "shared")
    tidy(docs.sparkSession)
    stars = shared.filter(F.col("id") != F.col("centre")).select(F.least("id", "centre").alias("a"), F.greatest("id", "centre").alias("b"))
    stars = materialize(stars.distinct(), "stars")
    tried = _filtered(stars, _ends(stars), found, num, den, most)
    links = _verified(docs, tried, n, num, den, repeated, most)
    for _ in range(HUB_ROUNDS):
        # A class that many others are linked to is the likely origin of its group: next, all that
        # share a token with it and are not connected to it yet are compared with it.
        open_ = _open_tokens(shared, heads, components(links))
        degree = links.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").count()
        ranked = open_.join(degree, "id", "left").withColumn("count", F.coalesce("count", F.lit(0)))
        hubs = ranked.groupBy("token").agg(F.max(F.struct("count", "id", "c")).alias("hub")).filter("hub.count > 1")
        more = (
            open_.join(hubs.select("token", F.col("hub.id").alias("hub"), F.col("hub.c").alias("hc")), "token")
            .filter("c <> hc")
            .select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b"))
            .distinct()
            .join(stars, ["a", "b"], "left_anti")
        )
        more = materialize(more, "stars")
        discard(open_)
        if more.isEmpty():
            break
        stars = materialize(stars.unionByName(more), "stars")
        tried = _filtered(more, _ends(more), found, num, den, most)
        links = materialize(links.unionByName(_verified(docs, tried, n, num, den, repeated, most)), "links")
    # Second phase: only under tokens whose members are in several components. A token of few members
    # gives pairs, a bounded number for each member; members of a larger one are compared block by
    # block, so that a token of any size is spread over tasks of bounded size.
    open_ = _open_tokens(shared, heads, components(links))
    discard(shared)
    # Tokens with the same least member, by a hash, are one bundle. The more members two tokens have in
    # common, the likelier that is: those of a group of near copies make a few bundles.
    sizes = open_.groupBy("token").agg(F.count(F.lit(1)).alias("m"), F.min(F.xxhash64("id")).alias("bundle"))
    sizes = materialize(sizes, "sizes")
    few = open_.join(sizes.filter(F.col("m") <= FEW), "token").select("token", "id", "c")
    right = few.select("token", F.col("id").alias("b"), F.col("c").alias("cb"))
    pairs = few.withColumnsRenamed({"id": "a", "c": "ca"}).join(right, "token").filter("a < b and ca <> cb").select("a", "b")
    pairs = materialize(pairs.distinct().join(stars, ["a", "b"], "left_anti"), "pairs")
    tried = _filtered(pairs, _ends(pairs), found, num, den, most)
    links = materialize(links.unionByName(_verified(docs, tried, n, num, den, repeated, most)), "links")
    many = sizes.filter(F.col("m") > FEW).select("token", "bundle")
    placed = open_.join(many, "token").groupBy("bundle", "id", "c").agg(F.max("size").alias("size"))
    placed = materialize(placed, "placed")
    discard(open_, sizes)
    links = materialize(links.unionByName(_linked_in_bundles(docs, placed, n, num, den, repeated, most)), "links")
    return found.join(heads.select("set", "id"), "set", "left").select("doc_id", "size", "id"), links, components(links)


#: Tokens of so many members give pairs.
FEW = 24
#: Members of a bundle that are compared in one task, with as many others at most.
BLOCK = 400


def _linked_in_bundles(
    docs: DataFrame, placed: DataFrame, n: int, num: int, den: int, repeated: bool, most: int
) -> DataFrame:
    """Links that connect different components c among the members (bundle, id, c, size) of each bundle."""
    ends = materialize(placed.select("id").distinct(), "ends")
    sets = _sets_of(docs, ends, n, repeated)
    bundles = placed.groupBy("bundle").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("k"), (8 * F.sum("size")).alias("bytes"))
    bundles = materialize(bundles, "bundles")
    copied = bundles.agg(F.sum(F.col("k") * F.col("bytes"))).first()[0] or 0
    parts = max(1, -(-copied // most))
    blocks = placed.join(bundles.select("bundle", "k"), "bundle").withColumn("own", F.pmod(F.xxhash64("id"), "k").cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("k") - 1))
    blocks = blocks.select("bundle", "id", "c", "own", other.alias("other")).select(
        "bundle", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id", "c"
    )
    found = (
        blocks.filter(_turn(F.xxhash64("bundle", "x", "y"), parts, k))
        .join(sets.select("id", "tokens"), "id")
        .groupBy("bundle", "x", "y")
        .applyInArrow(_compare_blocks(num, den), "a long, b long")
        .distinct()
        for k in range(parts)
    )
    links = _in_turn(found, "links")
    discard(sets, ends, bundles)
    return links


def _compare_blocks(num: int, den: int):
    """Links that connect different components among the members of a block (bundle, x, y)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, components_, sets = [], [], []
        for batch in batches:
            ids += batch.column("id").to_pylist()
            components_ += batch.column("c").to_pylist()
            sets += [np.frombuffer(t, np.uint64) for t in batch.column("tokens").to_pylist()]
        order = np.argsort(np.asarray(ids, np.int64), kind="stable")
        links = [(ids[order[i]], ids[order[j]]) for i, j in close_pairs([sets[k] for k in order], [components_[k] for k in order], num, den)]
        if links:
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return run


def close_pairs(sets: list[np.ndarray], groups: list[int], num: int, den: int) -> Iterator[tuple[int, int]]:
    """Pairs (i, j), i < j, of sets that overlap enough, as far as they connect what is not yet connected."""
    count = len(sets)
    sizes = np.array([len(s) for s in sets], np.int64)
    tokens, column = np.unique(np.concatenate(sets), return_inverse=True)
    row = np.repeat(np.arange(count), sizes)
    # Tokens of one set only add nothing to an overlap.
    often = np.bincount(column, minlength=len(tokens)) > 1
    number = np.cumsum(often) - 1
    row, column = row[often[column]], number[column[often[column]]]
    both = np.zeros((count, count), np.float32)
    width = 4096
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    for start in range(0, int(often.sum()), width):
        low, high = np.searchsorted(column, [start, start + width])
        part = np.zeros((count, min(width, int(often.sum()) - start)), np.float32)
        part[row[low:high], column[low:high] - start] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    enough = den * both >= num * (sizes[:, None] + sizes[None, :] - both)
    root = {g: g for g in groups}

    def find(g: int) -> int:
        while root[g] != g:
            root[g] = root[root[g]]
            g = root[g]
        return g

    for i, j in zip(*np.nonzero(np.triu(enough, 1)), strict=True):
        x, y = find(groups[i]), find(groups[j])
        if x != y:
            root[max(x, y)] = min(x, y)
            yield int(i), int(j)


def join_components(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """(doc_id, n_shingles, class_id, component_id), a row per row of docs.

    Words are runs without ASCII white space, A-Z lower-cased. Shorter texts are one shingle, texts
    without words (or null) have none and are alone. component_id is the least doc_id that links
    reach, class_id the least with an equal set. A null doc_id takes no part and has null ids.
    Repeated rows share a class; rows with one id and different texts are one node of the graph. Other columns are not read.
    """
    members, _, found = linked(docs, n, num, den)
    return members.join(found.withColumnRenamed("node", "id"), "id", "left").select(
        "doc_id",
        F.col("size").alias("n_shingles"),
        F.coalesce("id", "doc_id").alias("class_id"),
        F.coalesce("component", "id", "doc_id").alias("component_id"),
    )


def keep_one(docs: DataFrame, n: int = 5, num: int = 80, den: int = 100) -> DataFrame:
    """The rows of docs without near duplicates: of each component the row with the least doc_id.

    Of repeated rows with that id one stays. Rows without an id or without words all stay.
    """
    members = join_components(docs, n, num, den)
    gone = members.filter(F.col("component_id") < F.col("doc_id")).select("doc_id").distinct()
    left = docs.join(gone, "doc_id", "left_anti")
    plain = F.col("doc_id").isNull() | ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^ \t\n\x0B\f\r]")
    return left.filter(~plain).dropDuplicates(["doc_id"]).unionByName(left.filter(plain))
