"""Classes of near copies against all pairs."""

import random

import numpy as np
import pytest

from tablewright.llm import near_dedup


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(4)) for _ in range(n)]


def changed(base, rng, count):
    out = list(base)
    for i in rng.sample(range(len(out)), count):
        out[i] = "".join(rng.choice("klmnopqr") for _ in range(5))
    return " ".join(out)


def all_pairs(texts, similarity, weighted=False):
    """Linked pairs and classes, by comparing all."""
    shingles = near_dedup.Shingles()
    sets = [shingles.set_of(t, weighted) for t in texts]
    both = near_dedup.shared_counts(sets, len(sets))
    sizes = np.asarray([len(s) for s in sets], float)
    near = (both > 0) & (both >= similarity * (sizes[:, None] + sizes[None, :] - both))
    np.fill_diagonal(near, True)
    label = np.arange(len(texts))
    for i in range(len(texts)):
        label[np.isin(label, np.unique(label[near[i]]))] = label[near[i]].min()
    return np.argwhere(np.triu(near, 1)), label


def classes(spark, texts, **how):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(6)
    got = {r.doc_id: r.class_id for r in near_dedup.near_classes(table, **how).collect()}
    return np.asarray([got[i] for i in range(len(texts))])


def same_classes(a, b):
    return len(set(zip(a.tolist(), b.tolist()))) == len(set(a.tolist())) == len(set(b.tolist()))


def test_shared_counts_equal_set_intersections():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 3000, n)).astype(np.uint64) for n in (0, 1, 5, 900, 2500, 40, 40, 3000)]
    for some in (sets, sets[:3], sets * 3):
        for probes in (1, len(some)):
            got = near_dedup.shared_counts(some, probes)
            want = [[len(set(a.tolist()) & set(b.tolist())) for b in some] for a in some[:probes]]
            apart = ~np.eye(len(some), dtype=bool)[:probes]  # what a set shares with itself alone is not asked
            assert (got[apart] == np.asarray(want)[apart]).all()


def test_bands_follow_the_similarity():
    assert near_dedup.plan_bands(0.8) == (26, 5)
    for similarity in (0.3, 0.5, 0.6, 0.7, 0.8, 0.9, 0.95, 1.0):
        bands, rows = near_dedup.plan_bands(similarity)
        assert (1 - similarity ** rows) ** bands <= near_dedup.MISSED


@pytest.mark.parametrize("block", [1024, 24])
@pytest.mark.parametrize("count", [2, 3, 4])
def test_groups_around_the_similarity(spark, monkeypatch, block, count):
    """One base text, some words changed in each: with 3 of 200 most pairs lie a little below 0.8."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", block)
    rng = random.Random(count)
    base = words(rng, 200)
    texts = [changed(base, rng, count) for _ in range(300)] + [" ".join(words(rng, 60)) for _ in range(40)]
    links, label = all_pairs(texts, 0.8)
    got = classes(spark, texts)
    assert same_classes(got, label)
    assert sum(got[a] == got[b] for a, b in links) == len(links)


def test_two_thousand_documents(spark, monkeypatch):
    """Recall over all pairs of 0.8 or more, and no class that all pairs do not make."""
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 64)
    rng, texts = random.Random(11), []
    for g in range(250):
        base = words(rng, rng.randint(4, 150))
        texts += [changed(base, rng, min(rng.randint(0, 5), len(base))) for _ in range(rng.choice([1, 2, 5, 24]))]
    texts = texts[:2000]
    links, label = all_pairs(texts, 0.8)
    got = classes(spark, texts)
    assert len(links) > 1500 and len(texts) > 1500
    assert sum(got[a] == got[b] for a, b in links) >= 0.999 * len(links)
    assert len(set(zip(got, label))) == len(set(got))  # no class joins two true ones
    assert same_classes(got, label)


@pytest.mark.parametrize("similarity", [0.5, 0.9])
def test_other_similarities(spark, similarity):
    rng = random.Random(5)
    base = words(rng, 120)
    texts = [changed(base, rng, k % 12) for k in range(120)]
    assert same_classes(classes(spark, texts, similarity=similarity), all_pairs(texts, similarity)[1])


def test_weights_count(spark):
    verse = "one two three four five six seven eight nine ten "
    texts = [verse * 20, verse * 19, verse * 2, verse + "other words stand here now", " ".join(["x y z"] * 30), "", None]
    plain, heavy = classes(spark, texts), classes(spark, texts, weighted=True)
    assert plain[0] == plain[1] == plain[2]  # the same set of shingles
    assert heavy[0] == heavy[1] != heavy[2]
    assert same_classes(heavy[:5], all_pairs(texts[:5], 0.8, True)[1])


def test_a_bucket_of_many_near_copies_stays_linear(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "BLOCK_NODES", 32)
    rows = []
    monkeypatch.setattr(near_dedup, "compared", lambda df, s, f=near_dedup.compared: rows.append(df.count()) or f(df, s))
    rng = random.Random(2)
    base = words(rng, 300)
    texts = [changed(base, rng, 2) for _ in range(600)]
    assert len(set(classes(spark, texts))) == 1
    assert len(rows) == 1  # heads join them all, nothing is left for blocks
    assert rows[0] < 600 * near_dedup.MOST_BANDS * 1.2
