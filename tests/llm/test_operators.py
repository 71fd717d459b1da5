"""The operators of the llm subpackage against brute force, and on awkward rows."""

import hashlib
import math
import re
import sys
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from spendlake.llm import bpe, embed_join, html_text, lm, mixing, ngram_join, quality, rans, rollups, sharding, token_files
from spendlake.llm.components import components

DOCS = "doc_id bigint, text string, lang string, source string, size int, cls string, target string"
WORD = re.compile(r"[^\x20\x09-\x0d]+")
LINE = "the quick brown fox jumps over the lazy dog while many small birds sing loudly in the old green tree "


def lower(text):
    return re.sub("[A-Z]+", lambda m: m[0].lower(), text)


def near(text, at):
    words = text.split()
    words[at] = f"other{at}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    long = " ".join(f"w{i % 977}x{i % 13}" for i in range(9000))
    base = " ".join(f"b{i}" for i in range(150))
    out = [(1, LINE * 3, "en", "a"), (2, LINE.upper() * 3, "en", "a"), (2, LINE.upper() * 3, "en", "a"), (3, "", "en", "b"), (4, None, None, None), (5, " \n\t ", "de", "b")]
    out += [(6, "one two", "en", "b"), (7, "ONE  two", "en", "c"), (8, long, "en", "a"), (9, long + " end", "en", "a"), (None, "no id here at all my friend", "en", None)]
    out += [(None, "no id here at all my friend", "en", None), (20, base, "fr", "c")] + [(20 + i, near(base, i * 3), "fr", "c") for i in range(1, 12)]
    out += [(40 + i, "é–“ß” 東京 ½ don't we'LL 12345 !!?? \U0001f600 ΑΣ\n\nx" * (i + 1), "xx", "d") for i in range(4)]
    return [(*r, 7, "c", "t") for r in out]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def brute_components(rows, size, percent):
    sets = []
    for i, text, *_ in rows:
        w = WORD.findall(lower(text or ""))
        sets.append(frozenset(zip(*(w[k:] for k in range(size)))) if len(w) >= size else frozenset([tuple(w)] if w else []))
    group = list(range(len(sets)))
    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and 100 * both >= percent * len(sets[a] | sets[b]) and group[a] != group[b]:
                old, new = group[a], group[b]
                group = [new if g == old else g for g in group]
    out = []
    for k, (i, *_) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if group[j] == group[k] and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return sorted(out, key=repr), group


@pytest.mark.parametrize("size, percent", [(4, 85), (5, 80)])
def test_ngram_join(docs, rows, size, percent):
    want, _ = brute_components(rows, size, percent)
    got = ngram_join.ngram_components(docs, words=size, percent=percent)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == want


def test_ngram_join_of_blocks(spark, monkeypatch):
    """Clusters cut into tiles give the same components as whole ones."""
    draw = np.random.default_rng(5)
    texts = []
    for c in range(4):
        base = [f"c{c}w{i}" for i in range(int(draw.integers(20, 90)))]
        for _ in range(40):
            own = [f"z{draw.integers(1 << 30)}" if draw.random() < 0.02 else w for w in base]
            texts.append(" ".join(own[: len(own) - int(draw.integers(0, 4))]))
    rows = [(i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(ngram_join, "BLOCK", 300)
    monkeypatch.setattr(ngram_join, "WAVE", 1)
    got = sorted((tuple(r) for r in ngram_join.ngram_components(df, words=4, percent=85).collect()), key=repr)
    assert got == brute_components(rows, 4, 85)[0]


def test_plans_of_the_join_stay_small(docs, monkeypatch):
    """No table is made by a plan of very many shuffles, which the driver would track all at once."""
    sizes, write = {}, ngram_join.stored

    def counted(df, name, *args):
        # Without adaptive execution's notes; a shuffle is an exchange of the plan.
        sizes[name] = max(sizes.get(name, 0), df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return write(df, name, *args)

    monkeypatch.setattr(ngram_join, "stored", counted)
    monkeypatch.setattr(sys.modules[components.__module__], "stored", counted)
    assert ngram_join.ngram_components(docs, words=4, percent=85).count() == docs.count()
    assert "tiles" in sizes and max(sizes.values()) <= 12, sizes


def test_one_per_component(docs, rows):
    _, group = brute_components(rows, 5, 80)
    kept = ngram_join.one_per_component(docs, words=5, percent=80)
    assert kept.columns == docs.columns
    got = sorted((r.doc_id for r in kept.collect()), key=repr)
    want = []
    for g in set(group):
        members = [r for r, x in zip(rows, group) if x == g]
        if WORD.search(members[0][1] or ""):
            members = [min(members, key=lambda r: (r[0] is None, r[0] or 0))]
        want += [r[0] for r in members]
    assert got == sorted(want, key=repr)


def test_components(spark):
    chain = [(i, i + 1) for i in range(30)] + [(100, 200), (200, 300), (5, 5), (None, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(chain, "x bigint, y bigint"), "x", "y").collect()}
    assert got == {**{i: 0 for i in range(31)}, 100: 100, 200: 100, 300: 100}
    assert components(spark.createDataFrame([], "x bigint, y bigint"), "x", "y").count() == 0


def test_mix(spark):
    draw = np.random.default_rng(1)
    rows = [(i, "w " * int(draw.integers(0, 60)), s) for i, s in enumerate(["a"] * 300 + ["b"] * 40 + ["c"] * 90 + [None] * 50 + ["z"] * 3)]
    rows += [(None, "w w", "a")] * 3 + [(1, None, "e")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    got = mixing.mix_report(df).collect()
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    assert len(got) == len(rows) and sum(r.target for r in got if r.size) > 0
    targets = {}
    for r in got:
        targets.setdefault((r.source_size, r.target), 0)
        targets[r.source_size, r.target] += r.taken
        assert r.taken % max(r.size, 1) == 0 and r.taken <= 2 * r.size
    assert all(abs(taken - target) <= 60 and target <= 2 * size for (size, target), taken in targets.items())
    total = sum(sizes.values())
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, open_, left = {}, set(order), 1.5 * total
    while open_:
        level = left / sum(weight[s] for s in open_)
        capped = {s for s in open_ if weight[s] * level >= 2 * sizes[s]}
        if not capped:
            want |= {s: weight[s] * level for s in open_}
            break
        want |= {s: 2.0 * sizes[s] for s in capped}
        left -= sum(2 * sizes[s] for s in capped)
        open_ -= capped
    by_size = {sizes[s]: t for s, t in want.items()}
    assert all(math.isclose(by_size[r.source_size], r.target, abs_tol=1e-6) for r in got)
    again = mixing.mix_report(df.repartition(5)).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))
    mixed = mixing.mix_rows(df)
    assert mixed.columns == df.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)


def test_smaller_budgets_are_subsets(spark):
    df = spark.range(500).selectExpr("id AS doc_id", "repeat('w ', 1 + cast(id % 17 AS int)) AS text", "'s' AS source")
    small, large = ({r.doc_id: r.taken for r in mixing.mix_report(df, share=s).collect()} for s in (0.4, 1.3))
    assert all(small[i] <= large[i] for i in small)


def test_jump_hash():
    keys = np.random.default_rng(3).integers(0, 1 << 63, 50_000).astype(np.uint64)
    before = sharding.jump(keys, 16)
    after = sharding.jump(keys, 17)
    moved = before != after
    assert set(after[moved]) == {16} and abs(moved.mean() - 1 / 17) < 0.01
    assert np.bincount(before, minlength=16).min() > 2800

    def plain(key, shards):
        b, j = -1, 0
        while j < shards:
            b = j
            key = (key * 2862933555777941757 + 1) & (2**64 - 1)
            j = int((b + 1) * ((1 << 31) / ((key >> 33) + 1)))
        return b

    assert [plain(int(k), 16) for k in keys[:300]] == before[:300].tolist()


def test_shards(docs, rows):
    got = sharding.shard_report(docs, 4).collect()
    assert len(got) == len(rows) and {r.law for r in got} == {"key"}
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 4) for r in got)
    assert len({r.shard for r in got if r.doc_id is None}) == 1


def test_written_shards(spark, docs, rows, folder):
    sharding.write_shards(docs.withColumn("shard", F.lit("x")), f"{folder}/s", 4)
    assert spark.read.parquet(f"{folder}/s").count() == len(rows)


def test_lm(docs, rows):
    got = lm.score_texts(docs).collect()
    held = lambda i: zlib.crc32(("" if i is None else str(i)).encode()) % 5 == 1
    counts, total = Counter(), 0
    for i, t, *_ in rows:
        if not held(i):
            counts.update([*WORD.findall(lower(t or "")), None])
    total = sum(counts.values())
    base = lambda w: math.log10((counts[w] + 0.5) / (total + 0.5 * (len(counts) + 1)))
    want = []
    for i, t, *_ in rows:
        words = [*WORD.findall(lower(t or "")), None]
        want.append((i, held(i), len(words), sum(counts[w] > 0 for w in words), total, round(sum(map(base, words)), 4)))
    assert sorted(((*tuple(r)[:5], round(r.base_score, 4)) for r in got), key=repr) == sorted(want, key=repr)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)


def test_lm_counts_beyond_32_bits():
    ask = lambda n: {"part": 0, "block": n, "keys": lm.low48(np.array([5, 9], np.uint64)).tobytes(), "counts": lm.pack(np.array([3_000_000_000, n], np.uint32)), "codes": b""}
    answers = [r for r in lm._answer(0)(pa.Table.from_pylist([ask(1), ask(2)])).to_pylist() if r["block"] is not None]
    assert [lm._word_counts([r]).tolist() for r in answers] == [[6_000_000_000, 3]] * 2


def test_lm_beats_its_base_on_held_out_texts(spark, monkeypatch):
    draw = np.random.default_rng(2)
    follow = {w: draw.permutation(200)[:6] for w in range(200)}
    texts = []
    for i in range(300):
        w, out = int(draw.integers(200)), []
        for _ in range(80):
            out.append(f"v{w}")
            w = int(draw.choice(follow[w]))
        texts.append((i, " ".join(out)))
    df = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(2)
    monkeypatch.setattr(lm, "BLOCK_TOKENS", 3000)
    held = [r for r in lm.score_texts(df).collect() if r.held_out]
    assert sum(r.score for r in held) > 0.6 * sum(r.base_score for r in held)


def test_lm_weights_are_a_distribution():
    classes = np.array([(lm.quarter(np.array([c]))[0] << 15) | (lm.quarter(np.array([w]))[0] << 8) | lm.quarter(np.array([p]))[0] for c, w, p in [(9, 4, 3), (1, 1, 1), (500, 30, 20)]])
    weights = lm.learn(classes, np.array([9.0, 1.0, 500.0]), 1000, 50)
    assert np.allclose(weights.sum(1), 1) and (weights > 0).all()


@pytest.fixture(scope="module")
def tiktoken_ids():
    import base64

    import public_tokenizers as public
    import tiktoken

    with open(public.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.mark.parametrize("chunk, overlap", [(1 << 15, 512), (300, 40), (64, 9)])
def test_byte_bpe(docs, rows, tiktoken_ids, chunk, overlap):
    got = bpe.digests(bpe.encode(docs, chunk=chunk, overlap=overlap)).collect()
    at_once = bpe.encode_digests(docs, chunk=chunk, overlap=overlap)
    assert sorted(at_once.collect(), key=str) == sorted(got, key=str)
    want = []
    for i, t, *_ in rows:
        ids = tiktoken_ids(t or "")
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_byte_bpe_without_boundaries(spark, tiktoken_ids):
    """A run longer than chunk and overlap stays whole; the round trip is exact."""
    texts = ["a" * 1000, " " * 700 + "x", "ab\n" * 300 + "\n\n", "ü" * 400 + " y " * 90, "1 " * 300 + "\x1c\x85 \xa0z" * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    encoded = bpe.encode(df, chunk=100, overlap=20)
    got = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in encoded.collect()}
    assert got == {i: tiktoken_ids(t) for i, t in enumerate(texts)}
    assert {r.doc_id: bytes(r.text).decode() for r in bpe.decode(encoded).collect()} == dict(enumerate(texts))


def test_byte_bpe_takes_few_texts_at_a_time(spark, tiktoken_ids):
    """However large a batch is, its texts are encoded and handed on in slices; the digests go to Python slim."""
    texts = ["ab c " * 200_000, None, "x y " * 300_000, "z"]
    b = pa.RecordBatch.from_pydict({"doc_id": [1, 2, 3, 4], "text": texts})
    out = list(bpe._encode(bpe.Vocabulary(spark))([b]))
    assert [x.num_rows for x in out] == [2, 2]
    got = [np.frombuffer(i.as_py(), "<u4").tolist() for x in out for i in x.column("ids")]
    assert got == [tiktoken_ids(t or "") for t in texts]
    rows = bpe.encode_digests(spark.createDataFrame([(1, "a b")], "doc_id bigint, text string"))
    assert hasattr(rows, "stored_at") and rows.count() == 1


def test_rans_round_trip():
    draw = np.random.default_rng(4)
    for size in (0, 1, rans.BLOCK, 3 * rans.BLOCK + 17):
        symbols = (draw.zipf(1.3, size) % 49_408).astype(np.uint16)
        table = rans.Frequencies(np.bincount(symbols, minlength=1 << 16))
        stream, firsts, states, sums = rans.encode(symbols, table)
        assert (rans.decode(stream, firsts, states, sums, size, table) == symbols).all()
        if size > rans.BLOCK:
            assert len(stream) < 2 * size
            second = rans.decode(stream, firsts[4:8], states[8 * rans.LANES : 16 * rans.LANES], sums[4:8], rans.BLOCK, table)
            assert (second == symbols[rans.BLOCK : 2 * rans.BLOCK]).all()
            with pytest.raises(ValueError, match="checksum"):
                rans.decode(bytes([stream[0] ^ 1]) + stream[1:], firsts, states, sums, size, table)


def test_token_files(spark, docs, rows, folder):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(token_files.tokenizer_path())
    got = token_files.token_file_report(docs, f"{folder}/t").collect()
    ids = {}
    for i, t, *_ in rows:
        ids.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    at, want = 0, []
    for i in sorted(ids, key=lambda i: (i is not None, i or 0)):
        for own in ids[i]:  # equal ids have equal texts here
            want.append((i, at, len(own), zlib.crc32(np.array(own, "<u4").tobytes())))
            at += len(own)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    whole = {r.start: np.frombuffer(r.ids, "<u4").tolist() for r in token_files.read_files(spark, f"{folder}/t").collect()}
    assert [len(whole[r[1]]) for r in want] == [r[2] for r in want]


def test_pieces_as_the_library_does():
    import random

    with open(token_files.tokenizer_path()) as f:
        spec = f.read()
    own = token_files.WordIds(spec)
    draw = random.Random(9)
    signs = [*"aBcé'sStdl ,!?–\n\t 0129٣東ΑΣς́İßK\x1c\x85\xa0\x00<>|#ﬁ½", "'s", "'ll", "don't", "<|endoftext|>"]
    for _ in range(60):
        texts = ["".join(draw.choices(signs, k=draw.randint(0, 40))) for _ in range(20)]
        ids, counts = own(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [own.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_rollup(spark, folder):
    rollup = rollups.Rollup(spark, f"{folder}/r")
    texts = [(1, "a b c", "en", "s"), (2, "d e", "en", None), (3, None, "de", "s"), (3, None, "de", "s"), (None, "x", None, "s")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")
    only = ("words-1",)
    total = lambda n: sorted((tuple(r) for r in rollup.totals(n).collect()), key=repr)
    first = [(None, "en", "words-1", 1, 2), ("s", None, "words-1", 1, 1), ("s", "de", "words-1", 1, 0), ("s", "en", "words-1", 1, 3)]
    for _ in range(2):
        rollup.commit(1, rollups.counted(df, only))
        assert total(1) == sorted(first, key=repr)
    revised = spark.createDataFrame([(1, "a b c d e", "en", "t")], df.schema)
    gone = spark.createDataFrame([(2,), (77,)], "doc_id bigint")
    for _ in range(2):
        rollup.commit(2, rollups.counted(revised, only), gone)
        assert total(2) == sorted([first[1], first[2], ("t", "en", "words-1", 1, 5)], key=repr)
    rollup.commit(3, deletes=gone)
    assert total(3) == total(2) and total(1) == sorted(first, key=repr)
    rollup.commit(4, rollups.counted(df.where("doc_id = 2"), only))
    assert (None, "en", "words-1", 1, 2) in total(4)


def test_rollup_of_tokenizer_counts(spark, folder, tiktoken_ids):
    from tokenizers import Tokenizer

    words = Tokenizer.from_file(token_files.tokenizer_path())
    texts = [(1, "It's a test, isn't it? 12345", "en", "s"), (2, "gar  nicht so \u00fcbel \u2014 \u4e2d\u6587", "de", "s"), (3, "word and more " * 4000, "en", "s"), (4, None, "en", "t"), (None, "", None, None)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string, lang string, source string")
    want = Counter()
    for _, t, lang, source in texts:
        want[source, lang, "byte-bpe"] += len(tiktoken_ids(t or ""))
        want[source, lang, "word-bpe"] += len(words.encode(t or "", add_special_tokens=False).ids)
    rollup = rollups.Rollup(spark, f"{folder}/r")
    for _ in range(2):
        rollup.commit(1, rollups.counted_ids(df))
    got = {(r.source, r.lang, r.version): (r.docs, r.tokens) for r in rollup.totals(1).collect()}
    assert got == {k: (2 if k[:2] == ("s", "en") else 1, n) for k, n in want.items()}


def brute_stats(text):
    words = WORD.findall(text or "")
    seen = Counter(zip(words, words[1:], words[2:]))
    covered = {i + k for i in range(len(words) - 2) if seen[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    signs = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), signs, len(lines) - len(set(lines)), len(covered)


def test_quality_statistics(docs, rows, spark):
    more = [(90, "a b a b a b a", "en", "a"), (91, "x\nx\n \nx y\n\nx y", "en", "a"), (92, "p q r p q r s p q r" * 2, "en", "a"), (93, "\U0001f600# <b>|$$", "en", "a")]
    df = docs.select("doc_id", "text", "lang", "source").union(spark.createDataFrame(more, "doc_id bigint, text string, lang string, source string"))
    got = quality.quality_report(df).collect()
    want = []
    for i, t, *_ in [*rows, *more]:
        s = brute_stats(t)
        want.append((i, *s, s[0] < 50 or 100 * s[4] > 50 * s[0]))
    assert sorted((tuple(r)[:7] for r in got), key=repr) == sorted(want, key=repr)
    assert not any(r.kept for r in got if r.base_failed)


def test_quality_outliers(spark):
    draw = np.random.default_rng(6)
    clean = lambda i: " ".join("".join(draw.choice(list("abcdefg"), int(draw.integers(2, 9)))) + str(k) for k in range(60 + i % 40))
    rows = [(i, clean(i), "en", "s") for i in range(200)] + [(1000 + i, " ".join(f"{w}$$$" for w in clean(i).split()), "en", "s") for i in range(60)]
    rows += [(2000 + i, clean(i), "de", f"small{i % 9}") for i in range(30)] + [(3000, " ".join(f"#{w}%%" for w in clean(1).split()), "de", "small1")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in quality.quality_report(df).collect()}
    assert all(kept[i] == (i < 1000 or 2000 <= i < 3000) for i in kept)
    clashing = df.withColumn("words", F.lit(1)).withColumn("g", F.lit(2)).withColumn("kept", F.lit("k"))
    good = quality.keep_good(clashing)
    assert good.columns == clashing.columns and {r.doc_id for r in good.collect()} == {i for i, k in kept.items() if k}


def test_quality_rejects_by_each_coordinate(spark):
    """One text that is odd in a single coordinate is rejected, ordinary texts with some boilerplate are kept."""
    draw = np.random.default_rng(8)
    words = lambda n, low=3, high=8: ["".join(draw.choice(list("abcdefghijklmnop"), int(draw.integers(low, high)))) for _ in range(n)]
    lines = lambda n: [" ".join(words(10)) for _ in range(n)]
    clean = {i: "\n".join(lines(10 + i % 9)) for i in range(120)}
    notice, phrase = " ".join(words(4)), " ".join(words(3))
    clean |= {200 + i: "\n".join([notice, *lines(12), notice]) for i in range(5)}
    clean |= {300 + i: "\n".join([f"{phrase} {x}" if k % 6 == 0 else x for k, x in enumerate(lines(14))]) for i in range(5)}
    clean |= {400 + i: "\n".join([*lines(9), "5% & more"]) for i in range(5)}
    odd = {1000: "\n".join(" ".join(words(10, 18, 24)) for _ in range(12)), 1001: "\n".join(x.replace(" ", " # ") for x in lines(12))}
    # 10 of 24 lines are duplicates, of one word each, so no three words in a row occur twice.
    odd[1002] = "\n".join(x for pair in zip(lines(12), [["oh"], ["ah"]] * 6) for x in (pair[0], pair[1][0]))
    odd[1003] = "\n".join(lines(11)) + " " + " ".join([" ".join(words(10))] * 9)
    df = spark.createDataFrame([(i, t, "en", "s") for i, t in (clean | odd).items()], "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in quality.quality_report(df).collect()}
    assert not any(r.base_failed for r in got.values())
    assert got[1002].n_repeat_words == 0 and 0.4 < got[1003].n_repeat_words / got[1003].n_words <= 0.5
    assert {i for i, r in got.items() if not r.kept} == set(odd)


def test_quality_judges_small_sources_by_their_own_rows(spark):
    """30 texts of one kind are judged by their own estimate beside a hot source of another; verdicts hold from 19 rows to 20."""
    draw = np.random.default_rng(9)
    words = lambda n, low, high: ["".join(draw.choice(list("abcdefghijklmnop"), int(draw.integers(low, high)))) for _ in range(n)]
    text = lambda low, high: " ".join(words(150, low, high))
    hot = [(i, text(3, 8), "en", "hot") for i in range(300)]
    long = [(1000 + i, text(14, 22), "en", "long") for i in range(30)] + [(2000, text(3, 8), "en", "long")]
    few = [(3000 + i, text(3, 8), "en", "few") for i in range(18)] + [(4000, text(14, 22), "en", "few")]
    one = [(5000, text(14, 22), "en", "one"), (5001, text(3, 8), "en", "two")]
    verdicts = []
    for more in ([], [(3900, text(3, 8), "en", "few")]):
        df = spark.createDataFrame([*hot, *long, *few, *one, *more], "doc_id bigint, text string, lang string, source string")
        kept = {r.doc_id: r.kept for r in quality.quality_report(df).collect()}
        assert {i for i, k in kept.items() if not k} == {2000, 4000, 5000}
        verdicts.append({i: k for i, k in kept.items() if i != 3900})
    assert verdicts[0] == verdicts[1]


def test_quality_without_python(docs):
    plan = quality.quality_report(docs)._jdf.queryExecution().toString() + mixing.mix_report(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


PAGE = """<!DOCTYPE html><html><head><title>No</title><script>var a="</p>";</script><style>p{}</style></head><body>
<header class="site-header"><div>Site name</div><nav><ul><li><a href="/">Home</a></li><li><a href="/b">News</a></li></ul></nav></header>
<div class="cookie-notice"><p>We use cookies.</p></div>%s
<aside class="sidebar"><h3>Related</h3><ul><li><a href=x>Other one</a></li></ul></aside><form><label>Mail</label><button>Subscribe</button></form>
<footer>&copy; Site &middot; All rights.</footer></body></html>"""
BODY = "<h1>A title  of it</h1><p>First words,\n with <b>bold</b> &amp; <a href='y'>a link</a> in them. And then some more of it.<p>Second part&nbsp;here, which goes on for a while, too.</p>"
TEXT = "A title of it\nFirst words, with bold & a link in them. And then some more of it.\nSecond part here, which goes on for a while, too."


@pytest.fixture(scope="module")
def model(spark):
    return html_text.train(spark.read.parquet("/root/testdata/sf0.001/pages.parquet"))


@pytest.mark.parametrize("wrap", ["<article>%s</article>", '<main id="main"><div class="post">%s</div></main>', '<div class="content">%s<div class="comments"><h3>Comments</h3><div class="comment"><p>I, a reader, think so too, and say it at length.</p></div></div></div>'])
def test_main_text(model, wrap):
    assert html_text.main_text(PAGE % (wrap % BODY), model) == TEXT


@pytest.mark.parametrize("tag", "select svg iframe noscript template math object".split())
def test_unclosed_elements_do_not_end_the_page(tag):
    assert [t for t in html_text.Page(f"<p>One</p><{tag} a=b><p>Two</p><p>Three</p>").text if t] == ["One", "Two", "Three"]


def test_raw_elements_and_embedded_content():
    texts = lambda source: [t for t in html_text.Page(source).text if t]
    for tag in "script style title textarea".split():
        assert texts(f"<p>One</p><{tag}><p>Two</p>") == ["One"]
    for tag in "select svg iframe noscript template script".split():
        assert texts(f"<p>One<{tag}>two</{tag}> three</p>") == ["One three"]
    assert texts("<p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds</p>") == ["As x=2 holds"]
    assert texts("<p>A <object data=x><b>fallback</b></object> here</p>") == ["A fallback here"]


def test_main_text_of_pages(spark, model):
    odd = [(1, "u", None, 1), (2, "u", "", 1), (None, None, "<p", 1), (4, "u", "&amp; <<>> </div></p><b", 1), (5, "u", PAGE % f"<article>{BODY * 300}</article>", 1)]
    df = spark.createDataFrame(odd, "page_id bigint, url string, html string, text int")
    got = {r.page_id: r for r in html_text.extract(df, model).collect()}
    assert got[1].text == got[2].text == "" and got[5].text == "\n".join([TEXT] * 300)
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert html_text.extract(df.where("page_id = -1")).count() == 0


def test_main_text_of_the_small_table(spark):
    import html as library

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")

    def want(page):
        inside = page[page.index("<article>") + 9 : page.index("</article>")]
        blocks = (" ".join(library.unescape(re.sub("<[^>]+>", " ", b)).split()) for b in re.split("</?(?:h1|p)>", inside))
        return "\n".join(b for b in blocks if b)

    got = {r.page_id: r.text for r in html_text.extract(pages).collect()}
    assert got == {r.page_id: want(r.html) for r in pages.collect()}


def brute_vectors(rows, cosine):
    links = {k: set() for k in range(len(rows))}
    ok = [v is not None and len(v) > 0 and None not in v and np.isfinite(v).all() and any(v) and label is not None for _, v, label in rows]
    for a in range(len(rows)):
        for b in range(a):
            (_, x, l1), (_, y, l2) = rows[a], rows[b]
            if ok[a] and ok[b] and l1 == l2 and len(x) == len(y) and np.dot(x, y) / math.sqrt(np.dot(x, x) * np.dot(y, y)) >= cosine:
                links[a].add(b)
                links[b].add(a)
    out = []
    for k, (i, *_) in enumerate(rows):
        seen, queue = {k}, [k]
        while queue:
            new = links[queue.pop()] - seen
            seen |= new
            queue += new
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        least = min(ids) if ids else None
        out.append((i, len(links[k]), least, i == least))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block, fan", [(1024, 8), (7, 2)])
def test_near_vectors(spark, monkeypatch, block, fan):
    draw = np.random.default_rng(8)
    rows = []
    for c in range(6):
        centre = draw.normal(size=12)
        rows += [(len(rows) + k, (centre + draw.normal(size=12) * 0.25).tolist(), c % 2) for k in range(15)]
    same = draw.normal(size=12).tolist()
    rows += [(500 + k, same, 1) for k in range(9)] + [(600, [2 * x for x in same], 1), (601, same, 0), (602, same, None), (500, same, 1)]
    rows += [(700, None, 1), (701, [], 1), (702, [0.0] * 12, 1), (703, [float("nan")] * 12, 1), (704, [1.0, None], 1), (705, [1.0, 0.0], 1), (706, [1.0, 0.1], 1), (None, same, 1), (None, None, 0)]
    rows = [(i, v, label) for i, v, label in rows]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3).withColumn("cls", F.lit(1))
    monkeypatch.setattr(embed_join, "BLOCK", block)
    monkeypatch.setattr(embed_join, "FAN", fan)
    got = embed_join.near_vectors(df, 0.93)
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute_vectors(rows, 0.93)


def test_empty_tables(spark, empty, folder):
    assert ngram_join.ngram_components(empty).count() == ngram_join.one_per_component(empty).count() == 0
    assert mixing.mix_report(empty).count() == mixing.mix_rows(empty).count() == 0
    assert sharding.shard_report(empty).count() == lm.score_texts(empty).count() == 0
    assert bpe.digests(bpe.encode(empty)).count() == 0
    assert bpe.encode_digests(empty).count() == 0
    assert token_files.token_file_report(empty, f"{folder}/e").count() == 0
    assert quality.quality_report(empty).count() == quality.keep_good(empty).count() == 0
    assert embed_join.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_pipeline_by_its_parts(spark):
    """Each stage on what the one before kept, against the parts' own brute-force versions."""
    import corpus_pipeline

    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["quality rules"](spark, docs, sf)
    verdict = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == verdict
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    one = stages["n-gram Jaccard join"](spark, kept, sf)
    want = {i for i, _, c in brute_components(rows, 5, 80)[0] if i == c}
    assert one.columns == docs.columns and {r.doc_id for r in one.collect()} == want and one.count() == len(want)
    mixed = stages["source mix"](spark, one, sf)
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in mixing.mix_report(one).collect()}
    assert Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in taken.items() if n})
    done = corpus_pipeline.run(spark, sf)
    assert Counter(r.doc_id for r in done.collect()) == Counter({i: n for i, n in taken.items() if n})
