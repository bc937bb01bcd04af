"""Periodic runs, virtual slots and importance resampling against plain versions, on odd rows and an empty table."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from helpers import SCHEMA, documents, odd_rows, shipped  # noqa: F401
from pyspark.sql import functions as F

from caretiers.llm import importance, periodic_runs, sharding
from caretiers.llm.queries import repeat_some


def same(got, expected):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)


# --- periodic runs --------------------------------------------------------------------------


def plain_runs(words, least, periods):
    """All maximal stretches of every period; the least period of equal stretches."""
    found = {}
    for p in range(1, len(words) // periods + 1):
        i = 0
        while i + p < len(words):
            j = i
            while j + p < len(words) and words[j] == words[j + p]:
                j += 1
            size = j + p - i
            if j > i and size >= max(least, periods * p):
                found.setdefault((i, size), p)
            i = j + 1
    return sorted((s, n, p) for (s, n), p in found.items())


def repetitive(rng):
    words = [rng.randrange(rng.choice([1, 2, 3, 60])) for _ in range(rng.choice([1, 5, 24, 30, 100, 200]))]
    if rng.random() < 0.7:
        p, s = rng.randint(1, max(1, len(words) // 3)), rng.randrange(len(words))
        for i in range(s, len(words)):
            words[i] = words[s + (i - s) % p]
        for _ in range(rng.choice([0, 0, 1, 3])):
            words[rng.randrange(len(words))] = rng.randrange(3)
    return words


@pytest.mark.parametrize(("least", "periods"), [(24, 3), (6, 3), (3, 3), (40, 5)])
def test_runs_are_all_found_and_in_their_own_text(least, periods):
    rng = random.Random(least)
    for _ in range(400):
        texts = [repetitive(rng) for _ in range(rng.randint(1, 5))]
        begins = np.cumsum([0, *map(len, texts)])[:-1]
        got = periodic_runs.periodic_runs(np.array(sum(texts, []), np.int64), begins, least, periods)
        assert got == [plain_runs(t, least, periods) for t in texts]


def test_fewer_than_three_periods_are_refused():
    with pytest.raises(ValueError, match="three"):
        periodic_runs.periodic_runs(np.arange(3), np.array([0]), 24, 2)


def test_the_strongest_run_is_the_first_of_equals():
    assert periodic_runs.strongest([]) is None
    assert periodic_runs.strongest([(0, 30, 10), (50, 31, 10), (90, 62, 20)]) == (50, 31, 10)


def plain_collapse(words, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("chunk", [500_000, 100])
def test_collapse(spark, odd_rows, chunk, monkeypatch):
    # Tasks get the package's own setting, so the chunk is tried on the driver.
    monkeypatch.setattr(periodic_runs, "CHUNK_WORDS", chunk)
    rng = random.Random(4)
    rows = odd_rows + [(300 + k, " ".join(f"v{w}" for w in repetitive(rng)), "en", "s") for k in range(60)]
    rows.append((500, "a b\n" * 50_000, "en", "s"))
    words = {k: [w for w in re.split(r"[ \t-\r]+", t or "") if w] for k, (_, t, _, _) in enumerate(rows)}
    local = [r for c in periodic_runs._chunks([[w.encode() for w in words[k]] for k in words]) for r in periodic_runs._runs_of(c, 24, 3)]
    expected = []
    for k, (d, _, _, _) in enumerate(rows):
        long = len(words[k]) > 10_000
        runs = local[k] if long else plain_runs(words[k], 24, 3)
        assert local[k] == runs
        best = periodic_runs.strongest(runs)
        expected.append((d, len(words[k]), len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2], plain_collapse(words[k], runs)))
    assert (500, 100_000, 1, 0, 100_000, 2, 50_000_000, "a b") in expected
    got = periodic_runs.collapse(documents(spark, rows)).withColumn("runs", F.size("runs").cast("long"))
    assert same(got.collect(), expected)


def test_the_periodic_tail_of_the_query():
    ids = [d for d in range(300) if zlib.crc32(str(d).encode()) % 10 == 0]
    assert ids
    for d in ids:
        g, n = zlib.crc32(str(d).encode()) // 10, 200
        words = [b"%d" % k for k in range(n)]
        a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
        assert repeat_some(d, words) == [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert repeat_some(d, []) == []
    assert repeat_some(None, [b"x"]) == [b"x"]


# --- virtual slots --------------------------------------------------------------------------


def sizes_of(placed):
    return {r["shard"]: r["b"] for r in placed.groupBy("shard").agg(F.sum("size").alias("b")).collect()}


def assert_places(placed):
    """Every shard's places run from 0 without gaps."""
    places = collections.defaultdict(list)
    for r in placed.select("shard", "place").collect():
        places[r["shard"]].append(r["place"])
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_records_keep_their_slot_and_bytes_are_near_equal(spark, odd_rows, tmp_path):
    rng = random.Random(9)
    rows = odd_rows + [(1000 + k, "é" * rng.randint(0, 400), "en", "s") for k in range(600)]
    rows += [(7, "copy " * 30, "en", "s")] * 500 + [(None, None, None, None)] * 50
    docs = documents(spark, rows)
    placed = sharding.shard(docs, f"{tmp_path}/map", shards=4, slots=256).cache()
    expected = [(d, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for d, t, _, _ in rows]
    assert same(placed.select("doc_id", "size", "text_crc32").collect(), expected)
    assert_places(placed)
    held = sizes_of(placed)
    # One text is longer than a fair share: its slot is alone in its shard, and the other shards are even.
    slots = placed.groupBy("virtual_slot").agg(F.sum("size").alias("b")).agg(F.max("b")).first()[0]
    assert max(held.values()) == slots
    rest = sorted(held.values())[:3]
    assert rest[-1] - rest[0] <= 600
    # The copies of one record do not meet in one slot.
    copies = placed.filter("doc_id = 7").groupBy("virtual_slot").count()
    assert copies.count() > 100
    again = sharding.shard(docs.repartition(7), f"{tmp_path}/map", shards=4).cache()
    assert same(again.drop("place").collect(), placed.drop("place").collect())
    assert again.select("map_version").distinct().collect()[0][0] == 2


def test_a_new_shard_takes_only_into_itself_and_old_maps_stay(spark, tmp_path):
    rng = random.Random(11)
    docs = documents(spark, [(k, "x" * rng.randint(0, 300), "en", "s") for k in range(3000)])
    folder = f"{tmp_path}/map"
    old = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, folder, shards=8).collect()}
    grown = sharding.shard(docs, folder, shards=9).cache()
    new = {r["doc_id"]: r["shard"] for r in grown.collect()}
    moved = {d for d in old if old[d] != new[d]}
    assert 0 < len(moved) < 0.15 * len(old) and {new[d] for d in moved} == {8}
    held = sizes_of(grown)
    assert max(held.values()) - min(held.values()) <= 0.01 * max(held.values())
    assert_places(grown)
    # Shard 8 goes again, and every version can still be read.
    shrunk = {r["doc_id"]: r["shard"] for r in sharding.shard(docs, folder, shards=8).collect()}
    assert max(shrunk.values()) == 7
    assert sum(new[d] != shrunk[d] for d in new) < 0.15 * len(new)
    found = sharding.records(docs)
    first = {r["doc_id"]: r["shard"] for r in sharding.placed(found, sharding.load_map(spark, folder, 2)).collect()}
    assert first == old
    assert sharding.load_map(spark, folder).first()["version"] == 4


@pytest.mark.parametrize("seed", range(30))
def test_edits_end_even_and_move_little(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([0, 1, rng.randint(1, 1000), 50_000 if rng.random() < 0.02 else 7]) for _ in range(300)]
    before = sharding.even_map(300, 6)
    shards = rng.choice([4, 6, 7])
    after = sharding.edited(before, sizes, shards)
    load = [sum(n for n, s in zip(sizes, after) if s == k) for k in range(shards)]
    assert sorted(set(after)) == list(range(shards)) and sum(load) == sum(sizes)
    for k in range(shards):
        held = [n for n, s in zip(sizes, after) if s == k and n]
        assert load[k] - min(load if shards <= 6 else load[6:]) <= min(held, default=0)
    if shards == 7:
        assert {new for old, new in zip(before, after) if old != new} == {6}
    else:
        assert sharding.edited(after, sizes, shards) == after


# --- importance resampling ------------------------------------------------------------------


def test_crcs_of_features_are_those_of_their_bytes(monkeypatch):
    rng = random.Random(3)
    for _ in range(150):
        monkeypatch.setattr(importance, "SLICE_BYTES", rng.choice([50, 1000, 10**6]))
        texts = []
        for _ in range(rng.randint(1, 6)):
            pieces = []
            for _ in range(rng.choice([0, 1, 2, 3, 20])):
                size = rng.choice([1, 3, 8, 255, 256, 257, 511, 512, 513, 515, 3000]) if rng.random() < 0.3 else rng.randint(1, 9)
                pieces.append(rng.choice([b" ", b".", b"  ", b"X "]) + bytes(rng.choices(b"aAzZ09\xc3\xa9", k=size)))
            texts.append(b"".join(pieces))
        counts, features = importance.feature_crcs(texts)
        got = [(int(t), int(c)) for text, crcs in features for t, c in zip(text, crcs)]
        split = [plain_words(t) for t in texts]
        assert counts.tolist() == [len(w) for w in split]
        assert got == [
            (k, zlib.crc32(b" ".join(w[i : i + n]))) for n in (1, 2, 3) for k, w in enumerate(split) for i in range(len(w) - n + 1)
        ]


def plain_words(text):
    return re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())


def plain_resample(rows, target, percent, least, seed, buckets):
    def features(text):
        w = plain_words((text or "").encode())
        return len(w), [zlib.crc32(b" ".join(w[i : i + n])) % buckets for n in (1, 2, 3) for i in range(len(w) - n + 1)]

    docs = [(d, *features(t)) for d, t in rows]
    s = collections.Counter(b for _, _, f in docs for b in f)
    t = collections.Counter(b for text in target for b in features(text)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (S + buckets) / ((s[b] + 1) * (T + buckets)))) for b in range(buckets)]
    out = []
    for d, n, f in docs:
        h = int(hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        out.append([d, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    eligible = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0]))
    ranks = collections.defaultdict(list)
    for k, r in enumerate(eligible[: len(eligible) * percent // 100]):
        ranks[tuple(r)].append(k + 1)
    return [(*r, ranks[tuple(r)].pop() if ranks[tuple(r)] else None) for r in out]


@pytest.mark.parametrize("percent", [0, 5, 50, 100])
def test_resample(spark, odd_rows, percent):
    rng = random.Random(6)
    rows = odd_rows + [(100 + k, " ".join(rng.choices(["tea", "Tea!", "né", "x1", "and-so"], k=rng.choice([5, 19, 20, 60]))), "en", "s") for k in range(200)]
    rows += [rows[-1]] * 30 + [(400, "no.spaces" + "語" * 5000, "ja", "s")]
    wanted = ["Tea and tea", "x1 né", None, ""]
    got = importance.resample(documents(spark, rows), documents(spark, [(k, t, "en", "s") for k, t in enumerate(wanted)]), percent, buckets=50)
    expected = plain_resample([r[:2] for r in rows], wanted, percent, 20, 42, 50)
    assert same(got.collect(), expected)


def test_empty_tables(spark, tmp_path):
    none, some = spark.createDataFrame([], SCHEMA), documents(spark, [(1, "a b c " * 10, "en", "s")])
    assert periodic_runs.collapse(none).collect() == []
    assert importance.resample(none, some).collect() == []
    assert importance.resample(none, none).collect() == []
    assert [r["rank"] for r in importance.resample(some, none, 100).collect()] == [1]
    assert sharding.shard(none, f"{tmp_path}/map", 8).collect() == []
    assert sharding.load_map(spark, f"{tmp_path}/map").select("version").first()[0] == 1
