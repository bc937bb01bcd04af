"""Each operator against a plain version, on odd rows, on an empty table, and whole after all."""

import collections
import hashlib
import itertools
import random
import zlib

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from helpers import documents, odd_rows, shipped  # noqa: F401
from pyspark.sql import functions as F

from caretiers.llm import (
    decontaminate,
    line_dedup,
    ngram_join,
    packing,
    page_text,
    personal_data,
    quality_rules,
    secret_scan,
    substring_dedup,
    token_counts,
)

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def same(got, expected):
    return sorted(map(tuple, got), key=repr) == sorted(map(tuple, expected), key=repr)


def pairs(rows):
    return [(d, t) for d, t, _, _ in rows]


@pytest.mark.parametrize("chunk", [3_000_000, 400])
def test_substring_dedup(spark, odd_rows, chunk):
    got = substring_dedup.remove_repeated(documents(spark, odd_rows), 8, chunk)
    assert same(got.select("doc_id", "n_words", "n_removed", "kept").collect(), brute.repeated_windows(pairs(odd_rows), 8))


@pytest.mark.parametrize("most", [0, 3])
def test_substring_dedup_with_common_groups(spark, odd_rows, most):
    got = substring_dedup.remove_repeated(documents(spark, odd_rows), 8, 400, most)
    assert same(got.select("doc_id", "n_words", "n_removed", "kept").collect(), brute.repeated_windows(pairs(odd_rows), 8))


@pytest.mark.parametrize("size", [8, 20, 34, 60])
def test_a_footer_among_different_words_is_dealt_out(spark, size):
    rng = random.Random(3)
    footer = [f"foot{k}" for k in range(size)]
    texts = [[*(f"a{rng.randrange(10**9)}" for _ in range(60)), *footer, *(f"b{rng.randrange(10**9)}" for _ in range(60))] for _ in range(300)]
    docs = documents(spark, [(k, " ".join(t), "en", "s") for k, t in enumerate(texts)])
    common = substring_dedup.common_groups(docs, 1000, 20)
    assert len(common) == size - substring_dedup.GROUP + 1
    chunk = substring_dedup._Chunk()
    for text in texts:
        chunk.keys.append(b"k" * 16)
        chunk.starts.append(len(chunk.words))
        chunk.words += [w.encode() for w in text]
    doc, begin, stop, least = substring_dedup._stretches(chunk, substring_dedup.WordHashes().array(chunk.words), 35, common)
    different = {}
    for b, s, key in zip(begin.tolist(), stop.tolist(), least.tolist()):
        different.setdefault(key, set()).add(tuple(chunk.words[b : s + 34]))
    assert max(map(len, different.values())) <= 2
    assert sum((stop - begin).tolist()) == sum(len(t) - 34 for t in texts)


def test_equal_hashes_do_not_make_windows_equal(monkeypatch):
    monkeypatch.setattr(substring_dedup, "mix", lambda x: x * np.uint64(0))
    ids = np.array([0, 1, 2, 0, 1, 3, 0, 1, 2], np.int32)
    number = substring_dedup._equal_windows(ids, np.array([0, 3, 6]), 3)
    assert number[0] == number[2] != number[1]


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80), (2, 50)])
def test_ngram_join(spark, odd_rows, n, num):
    got = ngram_join.join_components(documents(spark, odd_rows), n, num, 100).select("doc_id", "n_shingles", "component_id")
    assert same(got.collect(), brute.jaccard_components(pairs(odd_rows), n, num, 100))


def test_one_of_each_group_stays(spark, odd_rows):
    docs = documents(spark, odd_rows)
    kept = ngram_join.keep_one(docs, 3, 80, 100)
    assert kept.columns == docs.columns
    component = {d: c for d, n, c in brute.jaccard_components(pairs(odd_rows), 3, 80, 100) if n and d is not None}
    left = [r["doc_id"] for r in kept.filter("text rlike '[^ \\t\\n]' and doc_id is not null").collect()]
    assert sorted(left) == sorted(set(component.values()))


def test_line_dedup(spark, odd_rows):
    rng = random.Random(5)
    lines = ["a", "b c", "the quick brown fox jumps", "x " * 12, "y y y y y y", "", " ", "p q r s t u"]
    rows = odd_rows + [(100 + k, "\n".join(rng.choices(lines, k=rng.choice([0, 1, 2, 5, 9, 17]))), "en", "s") for k in range(60)]
    got = line_dedup.remove_later_lines(documents(spark, rows))
    assert same(got.select("doc_id", "text", "n_lines", "n_removed").collect(), brute.later_lines(pairs(rows), 10))
    assert got.filter("text is not null and n_chars <> length(text)").isEmpty()


def test_personal_data(spark, odd_rows):
    rng = random.Random(2)
    made = [(200 + k, "".join(rng.choices("aB1029.@-+ ()%_é4", k=rng.randint(0, 60))), "en", "s") for k in range(1500)]
    made.append((9000, "Mail a.b@c.example.org or +1 (415) 555-2671, 4111 1111 1111 1111 from 10.0.0.1; ssn 123-45-6789", "en", "s"))
    rows = odd_rows + made
    got = {(r["doc_id"], r["base_spans"], r["base_sha256"]) for r in personal_data.find(documents(spark, rows)).collect()}
    expected = set()
    for d, t in pairs(rows):
        spans = ",".join(f"{k}:{s}:{e}" for s, _, e, k in brute.base_spans(t or ""))
        expected.add((d, spans, hashlib.sha256(spans.encode()).hexdigest()))
    assert got == expected
    row = personal_data.find(documents(spark, made)).filter("doc_id = 9000").first()
    assert (row["n_email"], row["n_ip"], row["n_card"], row["n_phone"]) == (1, 1, 1, 1)


def test_labelers_are_told_apart():
    code = lambda kind, cast: personal_data.pattern(kind, cast, 3)
    counts = {code("card", [0, 1, 1, 0, 0]): 900, code("card", [0, -1, -1, 0, 0]): 800, code("id_number", [1, 1, 0, 1, 0]): 60, code("id_number", [1, -1, 0, -1, 0]): 40}
    chance = personal_data.estimate(counts)
    assert chance[code("card", [0, 1, 1, 0, 0])] > 0.9 > 0.1 > chance[code("card", [0, -1, -1, 0, 0])]
    assert personal_data.accepted(counts) == {code("id_number", [1, 1, 0, 1, 0])}


def test_token_counts_are_those_of_greedy_longest_match(spark, odd_rows):
    tokens = set(token_counts.read_vocabulary(TOKENIZER))
    longest = max(map(len, tokens))
    counter = token_counts.counter_for(TOKENIZER)

    def greedy(word):
        left, n = (*word, token_counts.END), 0
        while left and left != (token_counts.END,):
            size = next((k for k in range(min(longest, len(left)), 0, -1) if left[:k] in tokens), 0)
            if not size:
                return 1
            left, n = left[size:], n + 1
        return n

    rng = random.Random(1)
    for _ in range(2000):
        word = bytes(rng.choices(b"abcdetionthe!\xc3\xa9", k=rng.randint(1, 30)))
        assert counter.count(word) == greedy(word)
    small = token_counts.PieceCounter([(97,), (97, 98), (97, 98, 99, 100), (99,)])
    assert [small.count(w) for w in (b"abc", b"abcd", b"abcabcd", b"abd", b"")] == [2, 1, 3, 1, 0]
    got = token_counts.count_tokens(documents(spark, odd_rows), TOKENIZER).select("doc_id", "n_words", "n_tokens").collect()
    expected = [(d, len(brute.words(t)), sum(greedy(w.encode().lower()) for w in brute.words(t))) for d, t in pairs(odd_rows)]
    assert same(got, expected)


def test_packing_tokenizes_few_bytes_at_a_time():
    texts = [None, "", "x" * packing.GROUP_BYTES, *["two words " * 50_000] * 20, *["a b"] * 2000, None]
    whole = pa.RecordBatch.from_pydict({"row": list(range(len(texts))), "text": texts})
    groups = list(packing._groups(iter([whole, whole.slice(0, 0), whole.slice(5)])))
    assert all(g.nbytes <= packing.GROUP_BYTES or g.num_rows == 1 for g in groups)
    assert [r for g in groups for r in g.column("row").to_pylist()] == [*range(len(texts)), *range(5, len(texts))]


def test_packing(spark, odd_rows):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(TOKENIZER)
    odd = ["a\x0bb c\x0cd", "x\x00y \x1c z", "É é ́a", "don't I'LL we've", "ΑΣ Σ", "<|endoftext|> a<|startoftext|>b", "a b \x85d", "İ ǅ 日本 12３"]
    rows = odd_rows + [(300 + k, t, "fr", "s") for k, t in enumerate(odd)]
    got = packing.pack_documents(documents(spark, rows), TOKENIZER).collect()
    want = collections.Counter()
    for d, t in pairs(rows):
        want[(d, np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4").tobytes())] += 1
    texts = collections.defaultdict(list)
    for (d, ids), n in want.items():
        texts[d] += [(ids, n)]
    covered = collections.Counter()
    for r in got:
        fit = [
            (i, n) for i, n in texts[r["doc_id"]]
            if len(i) == 4 * r["doc_tokens"] and zlib.crc32(i[4 * r["start"] : 4 * (r["start"] + r["length"])]) == r["ids_crc32"]
        ]
        assert fit
        for p in range(r["start"], r["start"] + r["length"]):
            covered[(r["doc_id"], fit[0][0], p)] += 1
    assert covered == collections.Counter({(d, i, p): n for d, ids in texts.items() for i, n in ids for p in range(len(i) // 4)})
    sequences = collections.defaultdict(list)
    for r in got:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    padding = 0
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        padding += 0 if at & (at - 1) == 0 else 2048 - at
        assert at <= 2048
    assert padding == 0


def corpus_of(docs, vocabulary):
    frequency = np.bincount(np.concatenate([np.unique(d) for d in docs]), minlength=vocabulary)
    return packing.Statistics(len(docs), sum(map(len, docs)), frequency)


def test_neighbours_are_those_of_plain_bm25():
    rng = random.Random(4)
    docs = [np.array([rng.randrange(40) for _ in range(rng.randint(0, 30))], np.uint16) for _ in range(60)]
    # The shard holds a third of the corpus, whose statistics count.
    corpus, shard = corpus_of(docs, 50), docs[:20]
    index = packing.Bm25(shard, corpus)
    mean = sum(map(len, docs)) / len(docs)
    df = collections.Counter(w for d in docs for w in set(d.tolist()))
    free = np.ones(len(shard), bool)
    for seed in range(19):
        free[seed] = False
        score = []
        for k, d in enumerate(shard):
            tf, norm = collections.Counter(d.tolist()), packing.K1 * (1 - packing.B + packing.B * len(d) / mean)
            idf = lambda w: np.log(1 + (len(docs) - df[w] + 0.5) / (df[w] + 0.5))
            score.append(sum(idf(w) * tf[w] * (packing.K1 + 1) / (tf[w] + norm) for w in set(shard[seed].tolist())))
        best = [k for k in sorted(range(20), key=lambda k: (-round(score[k], 9), k)) if free[k] and score[k] > 0]
        got = index.neighbours(seed, free)
        assert [round(score[k], 9) for k in got] == [round(score[k], 9) for k in best] and set(got) == set(best)


def topical(rng, topics, each, size=400):
    """(topic, text) of documents of many topics, which have some words of their own besides common ones."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(TOKENIZER).get_vocab()
    known = sorted(w[:-4] for w in vocabulary if w.endswith("</w>") and w[:-4].isascii() and w[:-4].isalpha() and len(w) > 9)
    rng.shuffle(known)
    docs = []
    for t in range(topics):
        own = known[300 + 30 * t : 330 + 30 * t]
        docs += [(t, " ".join(rng.choice(own) if rng.random() < 0.4 else rng.choice(known[:300]) for _ in range(size))) for _ in range(each)]
    rng.shuffle(docs)
    return docs


def test_windows_hold_related_documents_however_many_there_are(spark):
    """The share of neighbouring pieces of one topic does not fall when the documents double."""
    shares = []
    for topics in (40, 80):
        made = topical(random.Random(topics), topics, 6)
        topic = {k: t for k, (t, _) in enumerate(made)}
        docs = documents(spark, [(k, text, "en", "s") for k, (_, text) in enumerate(made)])
        got = packing.pack_documents(docs, TOKENIZER, shard_tokens=20_000)
        assert got.select((F.col("sequence_id") / (1 << 32)).cast("int")).distinct().count() > 5
        windows = collections.defaultdict(list)
        for r in got.collect():
            windows[r["sequence_id"]].append((r["offset"], topic[r["doc_id"]]))
        pairs_ = [(a[1], b[1]) for w in windows.values() for a, b in zip(sorted(w), sorted(w)[1:])]
        shares.append(sum(a == b for a, b in pairs_) / len(pairs_))
    assert shares[0] > 0.5 and shares[1] > shares[0] - 0.05


def test_open_windows_go_to_documents_that_share_something():
    rng = random.Random(8)
    docs = [np.array([k % 7 * 50 + rng.randrange(50) for _ in range(rng.randint(5, 60))], np.uint16) for k in range(200)]
    pieces, related, unrelated = packing.pack_shard(docs, 64, corpus_of(docs, 400))
    assert sum(p[2] for p in pieces) == sum(len(d) + 1 for d in docs)
    assert related > 10 * unrelated and unrelated <= 7


def test_copies_and_common_terms_are_dealt_into_bounded_shards(spark):
    rng = random.Random(5)
    texts = ["same words here again " * 20] * 400 + [" ".join(f"w{rng.randrange(40)}" for _ in range(60)) for _ in range(300)] + ["", None]
    docs = documents(spark, [(k, t, "en", "s") for k, t in enumerate(texts)])
    tokens = packing.tokenized(docs, TOKENIZER).cache()
    corpus = packing.corpus_statistics(tokens, packing.word_ids(TOKENIZER).size)
    shards = packing.dealt(packing.keyed(tokens, corpus), 3000)
    sizes = {r["shard"]: r["size"] for r in shards.groupBy("shard").agg(F.sum(F.col("n") + 1).alias("size")).collect()}
    assert shards.count() == len(texts) and max(sizes.values()) < 9000 and len(sizes) > 10


def test_quality_counts_and_verdict(spark, odd_rows):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(400)]
    good = [(1000 + k, " ".join(rng.choices(vocabulary, k=rng.randint(60, 200))), "en", f"s{k % 2}") for k in range(400)]
    junk = [(5000 + k, " ".join(w.upper() + "!!" for w in rng.choices(vocabulary, k=120)), "en", "s0") for k in range(40)]
    junk += [(6000 + k, " | ".join(rng.choices(vocabulary, k=120)), "en", "s1") for k in range(40)]
    rows = odd_rows + good + junk
    got = quality_rules.judge(documents(spark, rows)).collect()
    assert same([(r["doc_id"], *[r[c] for c in quality_rules.BASE]) for r in got], [(d, *brute.quality_counts(t)) for d, t in pairs(rows)])
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    kept = {r["doc_id"]: r["kept"] for r in got}
    assert not any(kept[d] for d, *_ in junk)
    assert sum(kept[d] for d, *_ in good) >= 395
    docs = documents(spark, rows)
    left = quality_rules.keep_good(docs)
    assert left.columns == docs.columns and left.count() == sum(r["kept"] for r in got)


def test_repeated_lines_within_the_base_rules_are_rejected(spark):
    rng = random.Random(12)
    vocabulary = ["".join(rng.choices("abcdefgh", k=rng.randint(2, 9))) for _ in range(3000)]

    def lines(n, size=8):
        return [" ".join(rng.choices(vocabulary, k=size)) for _ in range(n)]

    good = [(k, "\n".join(lines(rng.randint(10, 20))), "en", f"s{k % 40}") for k in range(240)]
    good += [(1000 + k, "\n".join([*(found := lines(16)), found[3]]), "en", "s1") for k in range(20)]
    # Half of the lines stand earlier, but they are short: few words are in repeated windows.
    junk = [(5000 + k, "\n".join([*lines(16, 12), *["ab cd"] * 17]), "en", f"s{k}") for k in range(10)]
    got = {r["doc_id"]: r for r in quality_rules.judge(documents(spark, good + junk)).collect()}
    assert not any(got[d]["base_failed"] for d in got)
    assert not any(got[d]["kept"] for d, *_ in junk)
    assert sum(got[d]["kept"] for d, *_ in good) >= 255


def test_estimates_are_those_of_the_best_half(spark):
    """Every half of small groups is tried: the steps end at, or close to, the least determinant."""
    rng = np.random.default_rng(5)
    floors, d = np.array(quality_rules.FLOORS), quality_rules.D
    rows, groups, clouds = [], [], {}
    for g in range(6):
        cloud = rng.normal(0, 1, (10, d)) * floors * rng.uniform(1, 6, d)
        cloud[7:] += 30 * floors
        clouds[f"g{g}"] = cloud
        rows += [(f"g{g}", *map(float, v)) for v in cloud]
        groups.append((f"g{g}", None))
    names = ", ".join(f"{f} double" for f in quality_rules.FEATURES)
    frame = spark.createDataFrame(rows, f"g string, {names}")
    over = spark.createDataFrame(groups, "g string, g0 string")
    close = 0
    for r in quality_rules.least_determinant(frame, over).collect():
        cloud = clouds[r["g"]]

        def estimate(part):
            cov = np.cov(part.T, bias=True) * quality_rules.HALF_FACTOR
            return quality_rules.regularised(len(part), part.mean(0), cov, None, floors)

        best = min((estimate(cloud[list(half)]) for half in itertools.combinations(range(10), 5)), key=lambda e: np.linalg.slogdet(e[1])[1])
        scatter = np.array(r["c"]).reshape(d, d)
        gaps = [float((v - r["m"]) @ np.linalg.inv(scatter) @ (v - r["m"])) for v in cloud]
        # Up to the scale that is estimated afterwards.
        scale = (scatter / best[1])[0, 0]
        close += np.allclose(scatter / scale, best[1], rtol=1e-6) and np.allclose(r["m"], best[0])
        assert np.linalg.slogdet(scatter / max(scale, 1))[1] <= np.linalg.slogdet(best[1])[1] + 1.0 or min(gaps[7:]) > max(gaps[:7])
    assert close >= 3


def test_small_sources_are_judged_as_their_language_is():
    floors = np.array(quality_rules.FLOORS)
    above = (np.zeros(7), np.diag(np.square(3 * floors)))
    one = quality_rules.regularised(1, np.ones(7), np.zeros((7, 7)), above, floors)
    many = quality_rules.regularised(10**6, np.ones(7), np.diag(np.square(2 * floors)), above, floors)
    assert np.allclose(one[0], 1 / 51) and np.allclose(np.diag(one[1]), (np.square(floors) + 50 * np.square(3 * floors)) / 51)
    assert np.allclose(many[0], 1, atol=1e-3) and np.allclose(np.diag(many[1]), np.square(2 * floors), rtol=1e-3)


def test_floors_raise_deviations_and_leave_correlations():
    cov = np.array([[4.0, 1.0], [1.0, 1.0]])
    assert np.allclose(quality_rules.floored(cov, np.array([1.0, 3.0])), [[4.0, 3.0], [3.0, 9.0]])
    assert np.allclose(quality_rules.floored(np.zeros((2, 2)), np.array([1.0, 2.0])), [[1.0, 0.0], [0.0, 4.0]])


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(900)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.randint(12, 60)))) for k in range(60)]
    rows, planted = [], {}
    for k in range(400):
        text = rng.choices(vocabulary, k=rng.randint(0, 300))
        if k % 2:
            item, body = rng.choice(items)
            body = decontaminate.normalized_words(body)
            for _ in range(decontaminate.allowed_edits(len(body))):
                at, kind = rng.randrange(len(body)), rng.choice("sid")
                body[at : at + (kind != "i")] = [] if kind == "d" else [f"new{rng.randrange(10**6)}"]
            at = rng.randint(0, len(text))
            text[at:at] = [w.upper() + rng.choice(["", ",", "."]) for w in body]
            planted[k] = item
        rows.append((k, "  ".join(text), "en", "s"))
    rows += [(None, None, None, None), (900, "", "en", "s"), (901, items[0][1], "en", "s"), (901, items[0][1], "en", "s")]
    benchmark = spark.createDataFrame([*items, (None, items[1][1]), (98, None), (99, "the of")], "item_id long, text string")
    docs = documents(spark, rows)
    got = decontaminate.leaks(docs, benchmark).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert sum((d, i) in found for d, i in planted.items()) >= 0.99 * len(planted)
    assert all(planted.get(r["doc_id"]) == r["item_id"] or r["doc_id"] == 901 or r["item_id"] is None for r in got)
    assert sum(r["doc_id"] == 901 for r in got) == 2
    clean = decontaminate.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns
    assert clean.count() == len(rows) - len({d for d, _ in found}) - 1


@pytest.mark.parametrize("size", [24, 64, 65, 256, 512, 1000])
def test_long_items_with_all_edits_are_found(size):
    rng = random.Random(size)
    vocabulary = [f"v{k}" for k in range(3000)]
    items = [(k, " ".join(rng.choices(vocabulary, k=size))) for k in range(20)]
    texts = []
    for _, text in items:
        body, edits = text.split(), decontaminate.allowed_edits(size)
        for at in sorted(rng.sample(range(size), edits), reverse=True):
            kind = rng.choice("sid")
            body[at : at + (kind != "i")] = [] if kind == "d" else [f"new{rng.randrange(10**6)}"]
        texts.append(" ".join([*rng.choices(vocabulary, k=300), *body, *rng.choices(vocabulary, k=300)]))
    found = decontaminate.Matcher(items).find(texts)
    assert [[m.item for m in ms] for ms in found] == [[k] for k, _ in items]


def test_short_items_and_scripts_without_spaces():
    items = [(1, "Yes"), (2, "two words"), (3, "a b c d"), (4, "今日は良い天気ですね"), (5, "ประเทศไทยอยู่ในเอเชีย"), (6, "!?"), (7, "two words")]
    texts = ["a b c D yes, two  words", "two more words yesterday", "彼は「今日は良い天気ですよ」と言った", "คนในประเทศไทยอยู่ในเอเชียแน่นอน", "", None]
    found = decontaminate.Matcher(items).find(texts)
    assert [sorted((m.item, m.first, m.distance) for m in ms) for ms in found[:2]] == [[(1, 4, 0), (2, 5, 0), (3, 0, 0), (7, 5, 0)], []]
    assert [[(m.item, m.distance) for m in ms] for ms in found[2:]] == [[(4, 1)], [(5, 0)], [], []]


def test_substring_distance():
    def plain(item, text):
        row = [0] * (len(text) + 1)
        for k, a in enumerate(item):
            new = [k + 1]
            for j, b in enumerate(text):
                new.append(min(row[j + 1] + 1, new[j] + 1, row[j] + (a != b)))
            row = new
        return min(row)

    rng = random.Random(6)
    for _ in range(200):
        item, text = (np.array(rng.choices(range(3), k=rng.randint(1, 9))) for _ in range(2))
        assert decontaminate.substring_distance(item, text)[0] == plain(item.tolist(), text.tolist())


PAGE = """<!DOCTYPE html><html><head><title>t &amp; t</title><style>p{{}}</style><script>x="</p>";</script></head><body>
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies</div><nav><ul><li><a href="/a">menu</a></li></ul></nav>
<div class="wrap"><{main}><h1>Title {k} &eacute;</h1><p>One<br>two <b>bold</b> <a href=x>link</a>&nbsp;y<p>Three {k} <!-- no -->
<aside>side</aside><form>mail <input></form><ul><li>a<li>b</ul><div class="ad">buy</div></{end}>
<section class="comments"><p>Nice {k}!</p></section></div><footer>&copy; foot {k}</footer>"""


CONTAINERS = '<div class="container">top strip text</div><div class="container">{}</div><div class="container">bottom strip</div>'


@pytest.mark.parametrize(
    ("page", "text"),
    [
        ("<article><p>Story {k}</p><p>second</p><p hidden>x</p></article>", "Story {k} second"),
        ('<article><div>story {k}</div><div class="ad-1">buy</div><div>more</div></article>', "story {k} more"),
        ("<div>head</div>" + "<div>" * 30 + "<article><p>deep {k}</p></article>" + "</div>" * 30 + "<div>foot</div>", "deep {k}"),
        (CONTAINERS.format("<article><p>Real body {k}</p></article>"), "Real body {k}"),
        ("<div>one</div><main><p>Text {k}</p><nav>menu</nav></main>", "Text {k}"),
    ],
)
def test_slots_are_paths_with_a_role(spark, page, text):
    """Siblings of frame elements stay, at any depth and beside others on the same path."""
    rows = [(k, f"http://h.org/{k}", f"<html><body>{page}</body></html>".replace("{k}", str(k))) for k in range(6)]
    # Another page of the host is without the frame element, one without any template.
    rows.append((6, "http://h.org/6", "<html><body><article><p>Story 6</p><p>second</p></article></body></html>"))
    got = {r["page_id"]: r["text"] for r in page_text.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {**{k: text.replace("{k}", str(k)) for k in range(6)}, 6: "Story 6 second"}


@pytest.mark.parametrize("main", ["article", "main", 'div class="post-content"'])
def test_page_text(spark, main):
    rows = [(k, f"http://h{k % 2}.example.com/{k}", PAGE.format(k=k, main=main, end=main.split()[0])) for k in range(8)]
    rows += [(50, None, None), (51, "http://h1.example.com/x", ""), (52, "nonsense", "<p>just text &lt;b&gt;"), rows[0]]
    pages = spark.createDataFrame([(*r, 1, "x") for r in rows], "page_id long, url string, html string, row long, article string")
    got = page_text.extract(pages).collect()
    assert len(got) == len(rows)
    for r in got:
        if r["page_id"] < 50:
            assert r["text"] == f"Title {r['page_id']} é One two bold link y Three {r['page_id']} a b"
        assert r["n_chars"] == len(r["text"])
    assert {r["page_id"]: r["text"] for r in got if r["page_id"] >= 50} == {50: "", 51: "", 52: "just text <b>"}


def test_secret_scan(spark, odd_rows):
    rng = random.Random(8)
    capital, hexadecimal = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", "0123456789abcdef"
    rows, secret = list(odd_rows), {}
    for k in range(300):
        word = ["".join(rng.choices("aeioulmnrst", k=rng.randint(2, 8))) for _ in range(30)]
        kind = k % 5
        value = None
        if kind == 0:
            value = "AKIA" + "".join(rng.choices(capital, k=16))
            word[10] = value
        elif kind == 1:
            value = "".join(rng.choices(hexadecimal, k=18))
            word[10] = "password=" + value
        elif kind == 2:
            value = "".join(rng.choices(hexadecimal, k=40))
            word[10:10] = ["token", "=", f'"{value}"']
        elif kind == 3:
            word[10] = "".join(rng.choices("0123456789", k=16))
        rows.append((400 + k, " ".join(word), "en", f"s{k % 3}"))
        secret[400 + k] = value
    got = secret_scan.scan(documents(spark, rows)).collect()
    kept = {r["doc_id"]: r["value"] for r in got if r["is_secret"]}
    assert all(kept.get(d) == v for d, v in secret.items())
    plan = secret_scan.scan(documents(spark, rows))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize(
    ("text", "expected"),
    [
        ("my password: hunter22 ok", [(2, "hunter22", 1)]),
        ('"api_key": "abcdefghijklmnop", x', [(1, "abcdefghijklmnop", 1)]),
        ("token :q7x then", [(1, "q7x", 1)]),
        ("pwd=ab1", [(0, "ab1", 1)]),
        ("secret = zz", [(2, "zz", 1)]),
        ("password\n:=\nabc", [(2, "abc", 1)]),
        ("see https://h.org/?token=abc9", [(1, "abc9", 1)]),
        ("auth: password: x1", [(2, "x1", 1)]),
        ("the password: ", []),
        ("no AWSSECRETACCESSKEY: ", []),
        ("short a1b2", []),
    ],
)
def test_values_given_to_names(spark, text, expected):
    found = secret_scan.candidates(documents(spark, [(1, text, "en", "s")]))
    assert sorted(map(tuple, found.select("word_no", "value", "assigned").collect())) == expected


def test_forms_of_values_given_to_names_and_of_harmless_words(spark):
    rng = random.Random(31)
    letters, mixed = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHJKabcdefghjk0123456789"
    rows, hidden, plain = [], set(), set()
    prose = "the release of a build for every patient is kept in its folder".split()
    for k in range(240):
        words, kind = [rng.choice(prose) for _ in range(40)], k % 6
        value = "".join(rng.choices(letters if kind == 0 else mixed, k=rng.choice([6, 9, 16])))
        if kind < 3:
            words[20] = rng.choice(["password: ", "api_key=", "secret = "]) + value
            hidden.add(k)
        elif kind == 3:
            words[20] = rng.choice([f"{k % 7}.{k % 5}.3-build2024{k:04d}x", f"release-2024-north-build{k}", f"data/2024/part-{k:05d}-final.csv"])
            plain.add(k)
        elif kind == 4:
            words[20] = rng.choice(["the secret: patient", "password: ********", "token: https://a.example/b1", "auth: 12"])
            plain.add(k)
        rows.append((k, " ".join(words), "en", f"s{k % 3}"))
    found = secret_scan.scan(documents(spark, rows)).collect()
    said = {r["doc_id"] for r in found if r["is_secret"]}
    assert len(said & hidden) >= 0.97 * len(hidden)
    assert len(said & plain) <= 0.03 * len(plain) and plain & {r["doc_id"] for r in found}
    for text, secret in [("password: hunter22", True), ("pwd: letmein", True), ("my secret: correcthorsebattery", True),
                         ("password=Tr0ub4dor", True), ("see 1.2.3-build20240101x", False), ("release-2024-north-build17", False)]:
        one = secret_scan.scan(documents(spark, [*rows, (999, text, "en", "s1")])).filter("doc_id = 999").collect()
        assert [r["is_secret"] for r in one] == [secret], text


def test_rates_see_other_folds_only(spark):
    fold = "pmod(xxhash64(value), 5)"
    values = spark.range(60).selectExpr("cast(id as string) AS value")
    rows = values.selectExpr("value", "concat('k', cast(value AS int) % 2) AS before", "CASE WHEN cast(value AS int) % 3 = 0 THEN NULL ELSE cast(value AS int) % 3 - 1.0D END AS label")
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([("a", None, 1.0), ("b", "only", 1.0), ("c", "none", None)], rows.schema))
    got = {(r["value"], r["before_rate"]) for r in secret_scan.with_rate(rows, "before").collect()}
    plain = [(r["value"], r["before"], r["label"], r["fold"]) for r in rows.selectExpr("*", f"{fold} AS fold").collect()]
    expected = set()
    for value, before, label, own in plain:
        seen = [y for _, b, y, f in plain if b == before and b is not None and y is not None and (label is None or f != own)]
        expected.add((value, (sum(seen) + 1) / (len(seen) + 2)))
    assert got == expected


def test_without_secrets_among_the_labels_unknown_findings_are_none(spark):
    rows = spark.createDataFrame([("a", 0.0), ("b", 0.0), ("c", None)], "value string, label double")
    scored = {r["value"]: (r["probability"], r["is_secret"]) for r in secret_scan.score(rows, None).collect()}
    assert scored == {"a": (0.0, False), "b": (0.0, False), "c": (0.25, False)}


def test_forest_on_held_out_findings(spark):
    rng = random.Random(9)
    found = []
    for k in range(600):
        good = k % 2 == 0
        value = "".join(rng.choices("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789abcdefghijklmnopqrstuvwxyz", k=32)) if good else f"release-{rng.choice(['north', 'south'])}-build-{rng.randrange(999)}"
        found.append((k, "s", k, value, 0, "the", "see the build", 1.0 if good else 0.0))
    rows = spark.createDataFrame(found, "doc_id long, source string, word_no long, value string, assigned int, before string, around string, label double")
    words = spark.createDataFrame([(w,) for w in ("release", "north", "south", "build")], "part string")
    known = secret_scan.with_features(rows, words)
    model = secret_scan.train(known.filter("doc_id < 400"))
    held = secret_scan.score(known.filter("doc_id >= 400"), model)
    assert held.filter((F.col("label") == 1.0) == F.col("is_secret")).count() >= 0.97 * held.count()


@pytest.mark.parametrize(
    "operator",
    [
        substring_dedup.remove_repeated,
        ngram_join.join_components,
        ngram_join.keep_one,
        line_dedup.remove_later_lines,
        personal_data.find,
        quality_rules.judge,
        quality_rules.keep_good,
        secret_scan.scan,
        lambda d: token_counts.count_tokens(d, TOKENIZER),
        lambda d: packing.pack_documents(d, TOKENIZER),
        lambda d: page_text.extract(d.select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.col("text").alias("html"))),
        lambda d: decontaminate.leaks(d, d.select(F.col("doc_id").alias("item_id"), "text")),
    ],
)
def test_empty_table(spark, operator):
    assert operator(documents(spark, [])).collect() == []


def test_odd_rows_pass_everywhere(spark, odd_rows):
    docs = documents(spark, odd_rows)
    assert secret_scan.scan(docs).count() == secret_scan.candidates(docs).count()
    assert decontaminate.leaks(docs, docs.select(F.col("doc_id").alias("item_id"), "text").filter("doc_id < 30")).count() > 0
