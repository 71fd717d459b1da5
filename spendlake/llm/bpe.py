"""Byte-level BPE with the ranks of a public vocabulary: encoding by overlapping chunks, decoding by joining bytes.

A text longer than a chunk is cut into chunks that overlap. Every chunk is split into pre-tokens by itself, in any task;
two chunks agree on a boundary in their overlap where a white-space run begins (no pre-token of the pattern holds a sign
followed by white space, so that boundary does not depend on where splitting began), and the text is cut there. The
pieces are then encoded in parallel: no merge crosses a pre-token, and a piece ends before white space, so nothing in it
depends on what follows. Chunks that share no boundary (one run longer than the overlap) stay in one piece.
"""

from __future__ import annotations

import base64
import functools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.common import free_name, row_slices, stored

#: Code points of a chunk and of the overlap with the next one; longer texts are cut.
CHUNK, OVERLAP = 1 << 15, 512
#: Bytes of texts encoded and digested at a time.
TEXT_BYTES = 1 << 21


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


@functools.lru_cache(maxsize=2)
def _codec(ranks: bytes, pattern: str):
    """Encoder, bytes of every id and decimal text of every id, once per worker."""
    import tiktoken

    table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
    ids = [b""] * (max(table.values()) + 1)
    for piece, i in table.items():
        ids[i] = piece
    codec = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=table, special_tokens={})
    return codec, ids, [str(i) for i in range(len(ids))]


class Vocabulary:
    """Ranks and pattern, sent once to every executor and not with every task (the file's size is fixed)."""

    def __init__(self, spark, path: str | None = None, pattern: str | None = None):
        with open(path or vocabulary_path(), "rb") as f:
            self.ranks = spark.sparkContext.broadcast(f.read())
        self.pattern = pattern or default_pattern()

    def __getstate__(self):
        return {"ranks": self.ranks, "pattern": self.pattern}

    @property
    def codec(self):
        return _codec(self.ranks.value, self.pattern)


def cut_points(text: str, begin: int, low: int, high: int, pattern: str) -> list[int]:
    """Boundaries before white space in [low, high) of the pre-tokens of a window that begins at ``begin`` of its text."""
    import regex

    out = []
    for m in regex.finditer(pattern, text):
        p = m.start()
        if begin + p >= high:
            break
        if begin + p >= low and p and text[p] in " \n" and not text[p - 1].isspace():
            out.append(begin + p)
    return out


CHUNKS = pa.schema([("uid", pa.int64()), ("k", pa.int64()), ("window", pa.string())])


def _chunks(chunk: int, overlap: int):
    def run(batches):
        for b in batches:
            for uid, text in zip(b.column(0), b.column(1)):
                text, uid = text.as_py(), uid.as_py()
                for k, begin in enumerate(range(0, len(text), chunk)):
                    yield pa.RecordBatch.from_pydict({"uid": [uid], "k": [k], "window": [text[begin : begin + chunk + overlap]]}, schema=CHUNKS)

    return run


BORDERS = "uid bigint, k bigint, heads array<bigint>, tails array<bigint>"


def _borders(chunk: int, overlap: int, pattern: str):
    def run(batches):
        for b in batches:
            uids, ks = b.column(0).to_pylist(), b.column(1).to_pylist()
            heads, tails = [], []
            for k, window in zip(ks, b.column(2)):
                window, begin = window.as_py(), k * chunk
                points = cut_points(window, begin, begin, begin + chunk + overlap, pattern)
                heads.append([p for p in points if p < begin + overlap])
                tails.append([p for p in points if p >= begin + chunk])
            yield pa.RecordBatch.from_pydict({"uid": uids, "k": ks, "heads": heads, "tails": tails}, schema=pa.schema(
                [("uid", pa.int64()), ("k", pa.int64()), ("heads", pa.list_(pa.int64())), ("tails", pa.list_(pa.int64()))]))

    return run


def _encode(vocabulary: Vocabulary):
    """Ids of the texts in the last column, as little-endian 32-bit numbers in its place."""

    def run(batches):
        codec = vocabulary.codec[0]
        for whole in batches:
            for begin, end in row_slices(whole.column(whole.num_columns - 1), TEXT_BYTES):
                b = whole.slice(begin, end - begin)
                ids = [np.array(codec.encode_ordinary(x.as_py() or ""), np.uint32).tobytes() for x in b.column(b.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(ids, pa.binary())], names=[*b.schema.names[:-1], "ids"])

    return run


def _joined(table: pa.Table) -> pa.Table:
    table = table.sort_by("piece")
    return pa.table({"uid": table["uid"].slice(0, 1), "ids": pa.array([b"".join(table["ids"].to_pylist())], pa.binary())})


def _joined_digests(vocabulary: Vocabulary):
    def run(table: pa.Table) -> pa.Table:
        whole = _joined(table).combine_chunks().to_batches()
        return pa.Table.from_batches(_with_digests(vocabulary, "ids")(whole))

    return run


def _pieces(longs: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """``uid, piece, body`` of the long texts (``uid, text``): what is encoded on its own."""
    windows = stored(longs.mapInArrow(_chunks(chunk, overlap), "uid bigint, k bigint, window string").repartition("uid", "k"), "chunks", slim=True)
    borders = stored(windows.mapInArrow(_borders(chunk, overlap, pattern), BORDERS), "borders", slim=True)
    before = borders.select("uid", (F.col("k") + 1).alias("k"), F.col("tails").alias("known"))
    cuts = borders.join(before, ["uid", "k"], "left").select("uid", "k", F.array_min(F.array_intersect("heads", "known")).alias("cut"))
    ends = cuts.select("uid", (F.col("k") - 1).alias("k"), F.col("cut").alias("end"))
    cuts = cuts.join(ends, ["uid", "k"], "left")
    upto = "sum(if(cut is null, 0, 1)) over (partition by uid order by k)"
    cuts = cuts.withColumn("piece", F.expr(upto))
    begin = F.coalesce("cut", F.col("k") * chunk)
    end = F.coalesce("end", (F.col("k") + 1) * chunk)
    parts = windows.join(cuts, ["uid", "k"]).select(
        "uid", "piece", "k", F.substring("window", begin - F.col("k") * chunk + 1, end - begin).alias("own")
    )
    ordered = F.array_sort(F.collect_list(F.struct("k", "own")))
    return parts.groupBy("uid", "piece").agg(F.concat_ws("", F.transform(ordered, lambda x: x.own)).alias("body"))


def encode(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``doc_id, ids`` of every row: the ids of the whole text, as little-endian 32-bit numbers.

    No special tokens: their spellings are ordinary text. Null and empty texts have no ids. Repeated rows come back as
    often. Only the two named columns are read; an empty table gives no rows.
    """
    vocabulary = vocabulary or Vocabulary(docs.sparkSession)
    return _whole_texts(docs, key, text, vocabulary, chunk, overlap, _encode(vocabulary), _joined, "ids binary")


def encode_digests(
    docs: DataFrame, key: str = "doc_id", text: str = "text", vocabulary: Vocabulary | None = None,
    chunk: int = CHUNK, overlap: int = OVERLAP,
) -> DataFrame:
    """``digests(encode(...))`` with one Python worker a task: ids are digested where they arise and go nowhere else.

    Stored, so that texts go to Python a few megabytes at a time, whatever the session's batches are.
    """
    vocabulary = vocabulary or Vocabulary(docs.sparkSession)
    ids, digest = _encode(vocabulary), _with_digests(vocabulary, "ids")
    rows = _whole_texts(docs, key, text, vocabulary, chunk, overlap, lambda b: digest(ids(b)), _joined_digests(vocabulary), DIGESTS)
    return stored(rows, "digests", slim=True)


def _whole_texts(
    docs: DataFrame, key: str, text: str, vocabulary: Vocabulary, chunk: int, overlap: int, of_short, of_pieces, columns: str
) -> DataFrame:
    """``doc_id`` and the columns that ``of_short`` gives for texts and ``of_pieces`` for the encoded pieces of one long text."""
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    fields = T.StructType.fromDDL(columns).fields
    short = rows.where(F.length("text") <= chunk).mapInArrow(of_short, T.StructType([rows.schema["doc_id"], *fields]))
    # Long rows are named by a number that is fixed once written.
    longs = stored(rows.where(F.length("text") > chunk).withColumn("uid", F.monotonically_increasing_id()), "long-texts")
    pieces = _pieces(longs.select("uid", "text"), vocabulary.pattern, chunk, overlap)
    ids = pieces.mapInArrow(_encode(vocabulary), "uid bigint, piece bigint, ids binary")
    whole = ids.groupBy("uid").applyInArrow(of_pieces, f"uid bigint, {columns}")
    return short.union(longs.select("uid", "doc_id").join(whole, "uid").select("doc_id", *(f.name for f in fields)))


DIGESTS = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"


def _with_digests(vocabulary: Vocabulary, column: str):
    import hashlib

    sha = lambda x: hashlib.sha256(x).hexdigest()

    def run(batches):
        _, pieces, decimals = vocabulary.codec
        for b in batches:
            counts, spelled, decoded = [], [], []
            for x in b.column(column):
                ids = np.frombuffer(x.as_py(), "<u4").tolist()
                counts.append(len(ids))
                spelled.append(sha(" ".join([decimals[i] for i in ids]).encode()))
                decoded.append(sha(b"".join([pieces[i] for i in ids])))
            rest = [c for c in b.schema.names if c != column]
            columns = [b.column(c) for c in rest]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(spelled), pa.array(decoded)], names=[*rest, "n_tokens", "ids_sha256", "decoded_sha256"])

    return run


def decode(rows: DataFrame, vocabulary: Vocabulary | None = None, ids: str = "ids", column: str = "text") -> DataFrame:
    """``rows`` with the bytes of their ids, joined, in a column of their own (a free name if it would clash)."""
    vocabulary = vocabulary or Vocabulary(rows.sparkSession)
    name = free_name(rows, column)

    def run(batches):
        pieces = vocabulary.codec[1]
        for b in batches:
            whole = [b"".join([pieces[i] for i in np.frombuffer(x.as_py() or b"", "<u4").tolist()]) for x in b.column(ids)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(whole, pa.binary())], names=[*b.schema.names, name])

    return rows.mapInArrow(run, T.StructType([*rows.schema.fields, T.StructField(name, T.BinaryType())]))


def digests(encoded: DataFrame, vocabulary: Vocabulary | None = None) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: of the ids in decimal, and of the bytes they decode to."""
    vocabulary = vocabulary or Vocabulary(encoded.sparkSession)
    fields = [encoded.schema["doc_id"], *T.StructType.fromDDL(DIGESTS).fields]
    return encoded.select("doc_id", "ids").mapInArrow(_with_digests(vocabulary, "ids"), T.StructType(fields))
