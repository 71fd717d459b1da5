"""Phrases against a plain count of all n-grams, with tries of one and of many shards."""

import random
import re
from collections import Counter
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlake.llm import collocations as c
from spendlake.session import shared_dir

FIELDS = "doc_id bigint, text string, lang string"


def brute(rows, least, longest, top, percent=100):
    total, f = Counter(), Counter()
    for _, text, lang in rows:
        lang, text = "und" if lang is None else lang, re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            total[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    out = {}
    for (lang, p), a in frequent.items():
        if any(
            x == lang and len(q) > len(p) and 100 * b >= percent * a and any(q[i : i + len(p)] == p for i in range(len(q)))
            for (x, q), b in frequent.items()
        ):
            continue
        score, k = min((1000 * a * total[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((x, i, p.decode(), -a, left, r, total[x], -s) for x, v in out.items() for i, (s, a, p, left, r) in enumerate(sorted(v)[:top], 1))


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(7)
    words = ["the", "The", "of", "New", "york", "times", "é", "ß", "a", "b", "c", "x-y", "東京", "tower"]
    out = []
    for i in range(120):
        text = []
        while len(text) < draw.randint(0, 80):
            text += draw.choice([["New", "York", "Times"], ["in", "the", "middle", "of", "the"], ["a"] * draw.randint(1, 8), [draw.choice(words)], [f"rare{draw.random()}"]])
            if draw.random() < 0.15:
                text[-1] += draw.choice(".,;:!?\n\x0b\x0c\r")
        out.append((i, draw.choice([" ", "  ", "\t", " \t "]).join(text), draw.choice(["en", "en", "en", "de", None, "und", ""])))
    return [*out, (1, None, "en"), (2, "", "fr"), (3, " \t ", "fr"), (None, "new york times " * 3000, "en"), (5, out[5][1], out[5][2]), (5, out[5][1], out[5][2])]


@pytest.mark.parametrize("shard, block", [(500_000, 8 << 20), (5, 500), (1, 8 << 20)])
def test_collocations(spark, rows, monkeypatch, shard, block):
    monkeypatch.setattr(c, "SHARD", shard)
    monkeypatch.setattr(c, "BLOCK_BYTES", block)
    if shard == 1:  # a trie per phrase: fewer of them
        rows = rows[:40]
    df = spark.createDataFrame(rows, FIELDS).repartition(3).withColumn("n", F.lit(1)).withColumn("key", F.lit(1))
    got = sorted(tuple(r) for r in c.collocations(df, least=12, longest=4 if shard == 1 else 5, top=30).collect())
    assert got == brute(rows, 12, 4 if shard == 1 else 5, 30) and len(got) > 5


def test_parameters(spark, rows):
    df = spark.createDataFrame(rows, FIELDS)
    got = sorted(tuple(r) for r in c.collocations(df, least=8, longest=3, top=7, percent=60).collect())
    assert got == brute(rows, 8, 3, 7, 60)
    with pytest.raises(ValueError):
        c.collocations(df, longest=1)


def test_large_scratch_tables_go_once_read(spark, rows):
    """What candidates and counts were made of is removed as soon as they are stored."""
    folder = Path(shared_dir(spark))
    before = set(folder.iterdir())
    found = c.collocations(spark.createDataFrame(rows, FIELDS), least=12, top=30)
    left = {p.name.split("-")[0] for p in set(folder.iterdir()) - before}
    assert not left & {"blocks", "coded", "windows", "occurrences"} and "phrases" in left
    assert found.count() > 0


def test_tasks_hand_on_few_rows_at_a_time(monkeypatch):
    """Windows and occurrences leave a task in small batches, however many phrases there are."""
    monkeypatch.setattr(c, "FOUND", 4, raising=False)
    ids = np.arange(1, 12)
    body = pa.RecordBatch.from_pydict({"body": [c.pack(ids)]})
    windows = list(c._grow(2)([body]))
    trie = SimpleNamespace(value=c.DoubleArray(np.stack([ids[:-1], ids[1:]], 1)))
    found = list(c._occurrences(trie)([body]))
    for out in (windows, found):
        assert [b.num_rows for b in out] == [4, 4, 2]
        assert sorted((k, a) for b in out for k, a in zip(*(x.to_pylist() for x in b.columns))) == sorted((np.array([i, i + 1], ">i8").tobytes(), 1) for i in range(1, 11))


def test_many_lexicons_and_slots(spark, rows, monkeypatch):
    """Words, slots and what tasks hold in many small portions: the same rows."""
    for name, value in (("LEXICON", 6), ("SLOTS", 40), ("PART_BITS", 6), ("HELD", 50)):
        monkeypatch.setattr(c, name, value)
    df = spark.createDataFrame(rows[:60], FIELDS).repartition(3)
    got = sorted(tuple(r) for r in c.collocations(df, least=12, longest=3, top=30).collect())
    assert got == brute(rows[:60], 12, 3, 30) and len(got) > 5


def test_blocks_are_coded_without_a_shuffle(spark, rows, monkeypatch):
    """Neither blocks nor all their words go through a shuffle to get ids."""
    plans, own = {}, c.stored

    def seen(df, name, **kw):
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        return own(df, name, **kw)

    monkeypatch.setattr(c, "stored", seen)
    c.collocations(spark.createDataFrame(rows, FIELDS), least=12, top=30)
    assert "MapInArrow" in plans["coded"] and "Exchange" not in plans["coded"]


def test_rare_windows_are_shuffled_as_few_bytes():
    """Of windows that occur once only slots are handed on, in 3 bytes each at most; only frequent ones as ids."""
    draw, bits = np.random.default_rng(3), 21
    ids = np.concatenate([draw.integers(1, 5000, 100_000), [0], np.tile([7, 8, 0], 50)])
    body = pa.RecordBatch.from_pydict({"body": [c.pack(ids)]})
    windows = Counter(zip(ids[:-1].tolist(), ids[1:].tolist()))
    windows = {w: a for w, a in windows.items() if min(w) > 0}
    sums = list(c._slot_counts(2, None, True, bits, 40)([body]))
    assert sum(len(x.as_py()) for b in sums for x in b.column(1)) < 3 * len(windows)
    (key,) = {x.as_py() for b in sums for x in b.column(0)}
    slots = c._frequent_slots(40)([pa.scalar(key)], pa.Table.from_batches(sums)).column("slot").to_numpy()
    found = [b for b in c._grow(2, slots=SimpleNamespace(value=slots), bits=bits)([body])]
    got = {tuple(np.frombuffer(k, ">i8").tolist()): a for b in found for k, a in zip(*(x.to_pylist() for x in b.columns))}
    assert got[7, 8] == windows[7, 8] and len(got) < 5


def test_tasks_hand_on_sums_of_their_blocks(monkeypatch):
    """A phrase of many blocks leaves a task once, packed by part; parts add up what tasks handed on."""
    ids = np.array([4, 5, 6, 0, 4, 5])
    blocks = pa.RecordBatch.from_pydict({"body": [c.pack(ids)] * 30})
    whole = list(c._task_sums(c._grow(2), 2, c.PART_BITS)([blocks]))
    assert [b.num_rows for b in whole] == [1]
    monkeypatch.setattr(c, "HELD", 6)
    some = list(c._task_sums(c._grow(2), 2, c.PART_BITS)([blocks]))
    assert len(some) == 10
    for batches in (whole, some):
        out = c._part_sums(2, 40)([pa.scalar(0)], pa.Table.from_batches(batches)).to_pydict()
        assert out == {"key": [np.array([4, 5], ">i8").tobytes()], "a": [60]}


@pytest.mark.parametrize("numbers", [[], [5], [0, 1, 70_000, 2**40]])
def test_packed_numbers(numbers):
    for kind in (np.int64, np.uint64):
        assert c.unpack(c.pack(np.array(numbers, kind)), kind).tolist() == numbers
    assert len(c.pack(np.arange(100_000) % 200)) < 0.2 * 100_000


def test_words_of_blocks_are_no_python_numbers():
    """Ids go to blocks as arrays: a list of numbers takes ten times the memory of a block."""
    columns = {"body": [c.pack(np.array([1, 2, 0, 3, 1], np.uint32)), c.pack(np.array([2, 1], np.uint32))], "size": [3, 2]}
    b = pa.RecordBatch.from_pydict(columns | {"place": [[0, 2], [1]], "id": [[7, 9], [5]]}, schema=pa.schema([("body", pa.binary()), ("size", pa.int32()), ("place", pa.list_(pa.int32())), ("id", pa.list_(pa.int64()))]))
    whole = SimpleNamespace(columns=[*b.columns[:2], *(Guarded(x) for x in b.columns[2:])])
    (out,) = c._coded([whole])
    assert [c.unpack(x.as_py(), np.int64).tolist() for x in out.column(0)] == [[7, 0, 9, 7], [5, 0]]


class Guarded:
    """A column that can be read by row, but not as a list of numbers."""

    def __init__(self, column):
        self.column = column

    def __iter__(self):
        return iter(self.column)

    def to_pylist(self):
        raise AssertionError("all numbers of a batch as Python objects")


def test_nothing_frequent(spark):
    assert c.collocations(spark.createDataFrame([], FIELDS)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, "a b c", "en"), (2, None, None)], FIELDS)).count() == 0
    assert c.collocations(spark.createDataFrame([(1, "a, " * 500, "en")], FIELDS)).count() == 0


def test_large_numbers(spark):
    """Products beyond 64 bits, as counts of a large corpus would give them."""
    df = spark.createDataFrame([(10**12, 10**14, 10**12, 10**12)], "a bigint, n bigint, l bigint, r bigint")
    r = df.select(F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)").alias("s")).first()
    assert r.s == 10**29 // 10**24


@pytest.mark.parametrize("count, words", [(1, 2), (300, 40), (4000, 30), (3000, 2000)])
def test_double_array(count, words):
    draw = np.random.default_rng(count)
    ids = draw.choice(10**12, words, replace=False) + 1
    phrases = {tuple(draw.choice(ids, draw.integers(1, 6)).tolist()) for _ in range(count)}
    rows = np.zeros((len(phrases), 5), np.int64)
    for i, p in enumerate(sorted(phrases)):
        rows[i, : len(p)] = p
    trie = c.DoubleArray(rows)
    text = np.where(draw.random(6000) < 0.1, 0, draw.choice(np.r_[ids, 5], 6000))
    got = Counter()
    for level, places, states in trie.walk(text):
        for place, s in zip(places, states):
            if trie.accept[s] >= 0:
                assert tuple(rows[trie.accept[s]][:level]) == tuple(text[place : place + level])
                got[tuple(text[place : place + level].tolist())] += 1
    want = Counter(tuple(text[i : i + k].tolist()) for k in range(2, 6) for i in range(len(text) - k + 1))
    assert got == {p: n for p, n in want.items() if p in phrases}


def test_tries_stay_small():
    """States with many children of a large vocabulary: a trie takes memory by its phrases, not by how children are spread."""
    draw = np.random.default_rng(5)
    rows = np.unique(np.stack([draw.integers(1, 100, 60_000), draw.integers(1, 40_000, 60_000)], 1), axis=0)
    trie = c.DoubleArray(rows)
    assert sum(x.nbytes for x in vars(trie).values() if isinstance(x, np.ndarray)) < 60 * len(rows)
    (words, places, states), = trie.walk(rows.reshape(-1))
    at = places % 2 == 0
    assert words == 2 and trie.accept[states[at]].tolist() == list(range(len(rows)))
