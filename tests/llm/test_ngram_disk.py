import random

import brute
import numpy as np
from caretiers.llm import ngram_join
from helpers import documents, shipped  # noqa: F401


def family(members, sentences, kept):
    """Texts that share many of the same rare sentences, no two near enough, and a near copy of some."""
    rng = random.Random(21)
    parts = [" ".join(f"s{k}w{j}" for j in range(6)) for k in range(sentences)]
    rows = []
    for k in range(members):
        tail = " ".join(rng.choice("abcdefgh") for _ in range(20))
        rows.append((k, " . ".join([*sorted(rng.sample(parts, kept)), tail]), "en", "s"))
    rows += [(1000 + k, rows[k][1] + " end", "en", "s") for k in range(0, members, 7)]
    return rows


def test_a_set_is_not_copied_for_each_of_its_tokens_and_moves_in_slices(spark, monkeypatch):
    rows = family(70, 30, 18)
    placed, slices = [], []
    write, turn = ngram_join.materialize, getattr(ngram_join, "_turn", None)

    def noted(df, name):
        out = write(df, name)
        if name == "placed":
            placed.append(out.count())
        return out

    monkeypatch.setattr(ngram_join, "materialize", noted)
    # Far less at once than these sets have.
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", 400_000, raising=False)
    monkeypatch.setattr(ngram_join, "SLICE_PART", 1000, raising=False)
    monkeypatch.setattr(ngram_join, "_turn", lambda c, parts, k: slices.append(parts) or turn(c, parts, k), raising=False)
    got = ngram_join.join_components(documents(spark, rows), 5, 80, 100).select("doc_id", "component_id").collect()
    wanted = brute.jaccard_components([(d, t) for d, t, *_ in rows], 5, 80, 100)
    assert sorted((r["doc_id"], r["component_id"]) for r in got) == sorted((d, c) for d, _, c in wanted)
    assert len({c for _, _, c in wanted}) > 50
    # What is placed last are the members of what is compared block by block.
    assert 0 < placed[-1] < 8 * len(rows)
    assert max(slices) > 1


def test_sketches_never_tell_less_than_sets_share():
    rng = np.random.default_rng(3)
    for size in (1, 50, 3000, 40_000):
        a = np.unique(rng.integers(0, 2**64, size, np.uint64))
        b = np.unique(np.concatenate([a[: size // 2], rng.integers(0, 2**64, size, np.uint64)]))
        both = len(np.intersect1d(a, b))
        assert ngram_join.most_shared(a, b, len(a), len(b)) == both
        assert ngram_join.most_shared(ngram_join.sketch(a), ngram_join.sketch(b), len(a), len(b)) >= both
