"""Scores of texts by a bigram model with deleted interpolation.

``P(w | h) = a(h) c(hw) / c(h) + b(h) c(w) / N + g(h) / (V + 1)``: maximum-likelihood estimates of two orders and a floor
for the unknown, mixed by weights that depend on how often the context was seen. The weights of each bucket of context
counts are learned by expectation-maximisation on held-out counts: every training token in turn is deleted from the
counts that predict it.

Counts are gathered by exchange. Texts become blocks of tokens (numbers of a vocabulary of the block), stored in buckets
by block. A block sends its different words, then its different bigrams, once each, as sorted hashes to the parts of the
hash space; a part adds up all blocks' counts and answers every block in the order asked. So a frequent word or bigram is
one entry per block, wherever it is counted, and what is sent grows with the corpus's different bigrams per block. Blocks
themselves are never shuffled. Words are told apart by 64-bit hashes, bigrams within a part by 48 bits.
"""

from __future__ import annotations

import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import by_part, row_slices, shuffle_parts, stored
from spendlake.llm.words import mix, seeds, word_hashes
from spendlake.session import scratch_path

#: Tokens of a block, in whole documents; a longer document is a block of its own.
BLOCK_TOKENS, TEXT_BYTES = 1_500_000, 1 << 21
#: Buckets of context counts are powers of two; counts are told apart by quarters of a power for learning weights.
QUARTERS, BUCKETS, ROUNDS = 4, 32, 40
#: Takes the place of a word at the end of a text, and before its first word.
END = np.uint64(0xE0F0E0F0E0F0E0F1)
_PAIR = seeds(2, 41)


def pack(x: np.ndarray) -> bytes:
    """An array's bytes, compressed behind their count."""
    raw = np.ascontiguousarray(x).tobytes()
    return struct.pack("<q", len(raw)) + (pa.compress(raw, codec="zstd", asbytes=True) if raw else b"")


def unpack(x: bytes, dtype) -> np.ndarray:
    size = struct.unpack_from("<q", x)[0]
    return np.frombuffer(pa.decompress(x[8:], size, codec="zstd", asbytes=True) if size else b"", dtype)


def low48(x: np.ndarray) -> np.ndarray:
    """The lower six bytes of each hash, one after the other."""
    return x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]


def from48(x: bytes) -> np.ndarray:
    out = np.zeros((len(x) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(x, np.uint8).reshape(-1, 6)
    return out.view("<u8").reshape(-1)


BLOCK = "block bigint, ids binary, nulls binary, held binary, lengths binary, tokens binary, vocab binary, counts binary"
_BLOCK = pa.schema([("block", pa.int64()), *((c, pa.binary()) for c in ("ids", "nulls", "held", "lengths", "tokens", "vocab", "counts"))])


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    task, number = TaskContext.get().partitionId(), 0
    words, lengths, ids, held, size = [], [], [], [], 0

    def block():
        length = np.concatenate(lengths)
        away = np.array(held, bool)
        vocab, tokens = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(tokens[np.repeat(~away, length)], minlength=len(vocab))
        known = np.array([0 if i is None else i for i in ids], np.int64)
        nulls = np.array([i is None for i in ids], bool)
        parts = [known, nulls, away, length.astype(np.uint32), tokens.astype(np.uint32), vocab, counts.astype(np.uint32)]
        return pa.RecordBatch.from_arrays([pa.array([(task << 32) + number]), *(pa.array([pack(x)], pa.binary()) for x in parts)], schema=_BLOCK)

    for b in batches:
        for low, high in row_slices(b.column(2), TEXT_BYTES):
            own, ranges = word_hashes(b.column(2).slice(low, high - low))
            words.append(np.insert(own, ranges[1:], END))
            lengths.append(np.diff(ranges) + 1)
            ids += b.column(0).slice(low, high - low).to_pylist()
            held += b.column(1).slice(low, high - low).to_pylist()
            size += len(words[-1])
            if size >= BLOCK_TOKENS:
                yield block()
                words, lengths, ids, held, size, number = [], [], [], [], 0, number + 1
    if ids:
        yield block()


def _segments(part: np.ndarray) -> list[tuple[int, slice]]:
    """Parts that occur, with their range in the (ascending) array."""
    names, first = np.unique(part, return_index=True)
    return [(int(p), slice(a, z)) for p, a, z in zip(names, first, np.append(first[1:], len(part)))]


ASKED = "part bigint, block bigint, keys binary, counts binary, codes binary"
ANSWER = "block bigint, part bigint, kind int, counts binary, key bigint, n bigint"
_ANSWER = pa.schema([("block", pa.int64()), ("part", pa.int64()), ("kind", pa.int32()), ("counts", pa.binary()), ("key", pa.int64()), ("n", pa.int64())])


def _ask_words(parts: int):
    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                vocab, counts = unpack(r["vocab"], np.uint64), unpack(r["counts"], np.uint32)
                for p, own in _segments(by_part(vocab, parts)):
                    yield pa.RecordBatch.from_pydict({"part": [p], "block": [r["block"]], "keys": [low48(vocab[own]).tobytes()], "counts": [pack(counts[own])], "codes": [b""]})

    return run


def _answer(kind: int):
    """Sums of the counts of equal keys, for every block in its order; and for learning, totals by class of count.

    Kind 0, words: rows (key 0: tokens, key 1: different tokens of the training texts). Kind 1, bigrams: rows (key: class
    of the context's, the word's and the bigram's count; n: training tokens).
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [from48(x) for x in table["keys"].to_pylist()]
        counts = np.concatenate([unpack(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
        _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        sums = np.bincount(inverse, counts).astype(np.int64)
        found, borders = sums[inverse], np.cumsum([len(x) for x in keys])[:-1]
        if kind == 0:
            names, totals = np.array([0, 1]), np.array([sums.sum(), (sums > 0).sum()])
        else:
            codes = np.concatenate([unpack(x, np.uint16) for x in table["codes"].to_pylist()]).astype(np.int64)
            seen = counts > 0
            names, at = np.unique(codes[seen] << 8 | quarter(found[seen]), return_inverse=True)
            totals = np.bincount(at, counts[seen], len(names)).astype(np.int64)
        n, more = len(keys), len(names)
        part = table["part"].to_pylist()[0]
        answers = [pack(x) for x in np.split(found, borders)]
        return pa.Table.from_arrays([
            pa.array([*table["block"].to_pylist(), *[None] * more], pa.int64()), pa.array([part] * (n + more), pa.int64()),
            pa.array([kind] * (n + more), pa.int32()), pa.array([*answers, *[None] * more], pa.binary()),
            pa.array([*[None] * n, *names.tolist()], pa.int64()), pa.array([*[None] * n, *totals.tolist()], pa.int64()),
        ], schema=_ANSWER)

    return run


def quarter(counts: np.ndarray) -> np.ndarray:
    """Class of a count: 0 for 0, else 1 and a step for each quarter of a power of two; at most 127."""
    return np.where(counts > 0, 1 + np.floor(QUARTERS * np.log2(np.maximum(counts, 1)) + 1e-9), 0).astype(np.int64)


def of_quarter(classes: np.ndarray) -> np.ndarray:
    """Middle count of a class, the count itself for small ones."""
    low = np.ceil(2.0 ** ((classes - 1) / QUARTERS) - 1e-9)
    high = np.maximum(low, np.ceil(2.0 ** (classes / QUARTERS) - 1e-9) - 1)
    return np.where(classes > 0, (low + high) / 2, 0)


def _pairs(block: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Contexts, words, and training flags of all tokens, and the bigram hash of each. The first word follows the end."""
    tokens, lengths = unpack(block["tokens"], np.uint32), unpack(block["lengths"], np.uint32)
    vocab = unpack(block["vocab"], np.uint64)
    # Every text ends with the end, so what comes before a first word is one, too: also before the very first.
    end = np.uint32(np.searchsorted(vocab, END))
    context = np.concatenate([[end], tokens[:-1]]).astype(np.uint32)
    training = np.repeat(~unpack(block["held"], bool), lengths)
    return context, tokens, training, mix(vocab[context] * _PAIR[0] + vocab[tokens] * _PAIR[1])


def _word_counts(answers: list[dict]) -> np.ndarray:
    own = sorted((r for r in answers if r["kind"] == 0), key=lambda r: r["part"])
    return np.concatenate([unpack(r["counts"], np.int64) for r in own])


def _ask_bigrams(parts: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, counts = left.to_pylist()[0], _word_counts(right.to_pylist())
        context, word, training, pair = _pairs(block)
        keys, first, inverse = np.unique(pair, return_index=True, return_inverse=True)
        times = np.bincount(inverse[training], minlength=len(keys)).astype(np.uint32)
        codes = (quarter(counts[context[first]]) << 7 | quarter(counts[word[first]])).astype(np.uint16)
        own = _segments(by_part(keys, parts))
        return pa.table({
            "part": pa.array([p for p, _ in own], pa.int64()), "block": pa.array([block["block"]] * len(own), pa.int64()),
            "keys": pa.array([low48(keys[s]).tobytes() for _, s in own], pa.binary()),
            "counts": pa.array([pack(times[s]) for _, s in own], pa.binary()), "codes": pa.array([pack(codes[s]) for _, s in own], pa.binary()),
        })

    return run


def learn(classes: np.ndarray, times: np.ndarray, tokens: int, types: int) -> np.ndarray:
    """Weights (bigram, unigram, floor) per bucket of context counts, by EM over classes of training tokens.

    A class is (context, word, bigram) by their counts' quarters; each token's own occurrence is deleted from them.
    """
    weights = np.tile([0.4, 0.5, 0.1], (BUCKETS, 1))
    context, word, pair = of_quarter(classes >> 15 & 127), of_quarter(classes >> 8 & 127), of_quarter(classes & 255)
    bucket = np.minimum(((classes >> 15 & 127) - 1) // QUARTERS, BUCKETS - 1)
    p = np.stack([
        np.where(context > 1, np.maximum(np.minimum(pair, context) - 1, 0) / np.maximum(context - 1, 1), 0),
        np.maximum(word - 1, 0) / max(tokens - 1, 1), np.full(len(word), 1 / (types + 1)),
    ], 1)
    for _ in range(ROUNDS):
        share = weights[bucket] * p
        share *= (times / share.sum(1))[:, None]
        sums = np.stack([np.bincount(bucket, s, BUCKETS) for s in share.T], 1) + 1e-3
        weights = sums / sums.sum(1, keepdims=True)
    return weights


def _score(weights: np.ndarray, tokens: int, types: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        block, answers = left.to_pylist()[0], right.to_pylist()
        counts = _word_counts(answers)
        context, word, _, pair = _pairs(block)
        _, inverse = np.unique(pair, return_inverse=True)
        both = np.concatenate([unpack(r["counts"], np.int64) for r in sorted((r for r in answers if r["kind"] == 1), key=lambda r: r["part"])])
        c_h, c_w, c_hw = counts[context], counts[word], both[inverse]
        w = weights[np.minimum(np.maximum(quarter(counts) - 1, 0) // QUARTERS, BUCKETS - 1)][context]
        known = c_h > 0
        # A context never seen says nothing: the other two share its weight.
        scale = np.where(known, 1.0, 1.0 / np.maximum(w[:, 1] + w[:, 2], 1e-12))
        p = w[:, 0] * np.where(known, c_hw / np.maximum(c_h, 1), 0) + scale * (w[:, 1] * c_w / max(tokens, 1) + w[:, 2] / (types + 1))
        base = np.log10((counts + 0.5) / (tokens + 0.5 * (types + 1)))[word]
        lengths = unpack(block["lengths"], np.uint32).astype(np.int64)
        starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        ids = pa.array(unpack(block["ids"], np.int64), mask=unpack(block["nulls"], bool))
        return pa.table({
            "doc_id": ids, "held_out": unpack(block["held"], bool), "n_tokens": lengths, "n_known": np.add.reduceat((c_w > 0).astype(np.int64), starts),
            "train_tokens": np.full(len(lengths), tokens), "base_score": np.add.reduceat(base, starts), "score": np.add.reduceat(np.log10(p), starts),
        })

    return run


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Texts whose id's CRC-32 (as text; a null id as the empty text) leaves 1 when divided by 5 are held out; counts and
    weights come from the others. Tokens are the lower-cased (A-Z) words and one end; a null or empty text has the end
    only. Base: unigrams with 0.5 added. Score: base-10 logarithm of the model's probability of the text. Without
    training texts every token has the floor. Repeated rows count as often as they occur. Empty table: no rows. Columns
    other than the two named are not read.
    """
    spark = docs.sparkSession
    parts = shuffle_parts(spark)
    held = F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % 5 == 1
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), held.alias("held"), F.col(text).alias("text"))
    name = f"lm_blocks_{uuid.uuid4().hex[:12]}"
    made = rows.mapInArrow(_blocks, BLOCK)
    made.write.bucketBy(parts, "block").sortBy("block").option("path", scratch_path(spark, "blocks")).saveAsTable(name)
    blocks = spark.table(name)
    asked = blocks.select("block", "vocab", "counts").mapInArrow(_ask_words(parts), ASKED)
    words = stored(asked.groupBy("part").applyInArrow(_answer(0), ANSWER), "word-counts")
    totals = {r.key: r.n for r in words.where("block is null").groupBy("key").agg(F.sum("n").alias("n")).collect()}
    tokens, types = totals.get(0, 0), totals.get(1, 0)
    of_words = words.where("block is not null")
    by_block = lambda right: blocks.groupBy("block").cogroup(right.groupBy("block"))
    asked = by_block(of_words).applyInArrow(_ask_bigrams(parts), ASKED)
    pairs = stored(asked.groupBy("part").applyInArrow(_answer(1), ANSWER), "bigram-counts")
    # Classes of counts: fewer than 2 ** 21, however large the corpus.
    found = pairs.where("block is null").groupBy("key").agg(F.sum("n").alias("n")).collect()
    weights = learn(np.array([r.key for r in found], np.int64), np.array([r.n for r in found], np.float64), tokens, types)
    schema = "doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    return by_block(of_words.union(pairs.where("block is not null"))).applyInArrow(_score(weights, tokens, types), schema)
