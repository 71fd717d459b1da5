"""The n-gram join when very common passages are left out of its keys: every link of brute force, in smaller clusters."""

import numpy as np
import pytest

from spendlake.llm import ngram_join
from spendlake.llm.words import mix


def texts(draw):
    """Texts that share passages (some are little else), with near copies of many."""
    passages = [[f"p{k}w{i}" for i in range(30)] for k in range(3)]
    out = []
    for c in range(60):
        own = [f"c{c}w{i}" for i in range(int(draw.integers(0, 60)))]
        for k in range(3):
            if draw.random() < 0.6:
                at = int(draw.integers(0, len(own) + 1))
                own[at:at] = passages[k]
        for _ in range(int(draw.integers(1, 6))):
            copy = [f"z{draw.integers(1 << 30)}" if draw.random() < 0.02 else w for w in own]
            out.append(" ".join(copy))
    return out


@pytest.mark.parametrize("common, words, percent", [(2, 4, 85), (10, 5, 80), (1 << 40, 5, 80)])
def test_links_stay_whatever_is_left_out(spark, monkeypatch, common, words, percent):
    monkeypatch.setattr(ngram_join, "COMMON", common)
    rows = list(enumerate(texts(np.random.default_rng(11))))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.ngram_components(df, words=words, percent=percent).collect()}
    sets = []
    for _, t in rows:
        w = t.split()
        sets.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    least = {}
    for i, g in enumerate(group):
        least.setdefault(g, i)
    assert got == {i: (len(sets[i]), least[group[i]]) for i in range(len(sets))}


def test_similar_sets_share_a_key_for_any_common_ngrams():
    draw = np.random.default_rng(4)
    bands = ngram_join.Bands(80)
    for trial in range(300):
        size = int(draw.integers(1, 400))
        a = np.unique(mix(draw.integers(0, 1 << 40, size).astype(np.uint64)))
        drop = draw.random(len(a)) < draw.random() * 0.11
        b = np.unique(np.concatenate([a[~drop], mix(draw.integers(0, 1 << 40, int(len(a) * draw.random() * 0.1)).astype(np.uint64))]))
        if not len(b) or 100 * len(np.intersect1d(a, b)) < 80 * len(np.union1d(a, b)):
            continue
        every = np.union1d(a, b)
        for share in (0, 0.2, 0.7, 1):
            common = np.sort(every[draw.random(len(every)) < share])
            keys = [ngram_join.range_keys(x, bands, common) for x in (a, b)]
            assert len(np.intersect1d(*keys)) or np.array_equal(a, b) or bands.ranges(bands.band(min(len(a), len(b))))[0] == 0


def test_bitmaps_of_many_sets_and_one_long_one(monkeypatch):
    monkeypatch.setattr(ngram_join, "BITMAP_BYTES", 1 << 16)
    monkeypatch.setattr(ngram_join, "SLICE_BYTES", 1 << 10)
    draw = np.random.default_rng(6)
    sets = [np.unique(draw.integers(0, 1 << 63, 100).astype(np.uint64)) for _ in range(300)]
    sets += [np.unique(np.concatenate([s[:95], draw.integers(0, 1 << 63, 3).astype(np.uint64)])) for s in sets[:50]] + [np.unique(draw.integers(0, 1 << 63, 20_000).astype(np.uint64))]
    assert ngram_join.bitmaps(sets).nbytes <= 1 << 16
    found = {frozenset(x) for x in ngram_join.tile_links(np.arange(len(sets)), sets, 80)}
    assert found == {frozenset((i, 300 + i)) for i in range(50)}
