"""Token ids in files: text to ids with a public tokenizer, ids to entropy-coded blocks in document order, and back.

A file is a Parquet table with one row per group of documents: their ids and token counts, and the tokens as independent
interleaved blocks (``rans``) with checkpoints and checksums. All files share one frequency table, stored with them; it
is bounded by the vocabulary. Files follow each other in ascending document id, and so do the rows of a file, so where
a document starts follows from token counts alone.
"""

from __future__ import annotations

import functools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm import rans
from spendlake.llm.common import row_slices, shuffle_parts, small_side, stored
from spendlake.llm.words import LOWER, hashes, spans, text_bytes

#: Tokens of a row of a file, in whole documents; a longer document is a row of its own.
ROW_TOKENS, TEXT_BYTES = 1 << 18, 1 << 21
#: Different pieces a worker remembers the ids of.
REMEMBERED = 1 << 20


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Kinds of printable ASCII between which the tokenizer always cuts: letters, digits, signs. All else may depend on what
#: stands beside it: an apostrophe (contractions), and whatever is not ASCII or not printable.
KINDS = np.zeros(256, np.uint8)
KINDS[0x21:0x7F] = 3
KINDS[ord("0") : ord("9") + 1] = 2
KINDS[ord("a") : ord("z") + 1] = KINDS[ord("A") : ord("Z") + 1] = 1
KINDS[ord("'")] = 0


class WordIds:
    """Ids of texts by a tokenizer that drops white space, ignores case and cuts letters, digits and signs apart.

    It then treats each such piece by itself, so each piece is encoded once and remembered. Pieces are told apart by
    64-bit hashes of their bytes. Where a special token may be spelled out, whole words are encoded as they are.
    """

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self._forget()

    def _forget(self):
        self.keys, self.first, self.length, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)

    def _learn(self, keys: np.ndarray, pieces: list[str]) -> None:
        # One call for all: tokens belong to the piece they begin in, as white space has none.
        found = self.tokenizer.encode(" ".join(pieces), add_special_tokens=False)
        starts = np.cumsum([0, *(len(x) + 1 for x in pieces[:-1])])
        begins = np.array([a for a, _ in found.offsets], np.int64)
        length = np.bincount(np.searchsorted(starts, begins, "right") - 1, minlength=len(pieces))
        first = len(self.ids) + np.concatenate([[0], np.cumsum(length)[:-1]])
        self.ids = np.concatenate([self.ids, np.array(found.ids, np.uint16)])
        keys = np.concatenate([self.keys, keys])
        order = np.argsort(keys)
        self.keys = keys[order]
        self.first, self.length = np.concatenate([self.first, first])[order], np.concatenate([self.length, length])[order]

    def _known(self, keys: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.keys, keys), max(0, len(self.keys) - 1))
        return self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        data, offsets = text_bytes(texts)
        raw = data.tobytes()
        if b"<|" in raw:
            found = [self.tokenizer.encode(x or "", add_special_tokens=False).ids for x in texts.to_pylist()]
            return np.array([i for x in found for i in x], np.uint16), np.array([len(x) for x in found], np.int64)
        data = LOWER[data]
        raw = data.tobytes()
        starts, ends, ranges = spans(data, offsets, KINDS)
        keys, first, inverse = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > REMEMBERED:
            self._forget()
        new = ~self._known(keys)
        if new.any():
            self._learn(keys[new], [raw[starts[i] : ends[i]].decode() for i in first[new]])
        at = np.searchsorted(self.keys, keys)[inverse]
        length = self.length[at]
        upto = np.concatenate([[0], np.cumsum(length)])
        gather = np.arange(upto[-1]) + np.repeat(self.first[at] - upto[:-1], length)
        return self.ids[gather], np.diff(upto[ranges])


@functools.lru_cache(maxsize=2)
def _word_ids(spec: str) -> WordIds:
    return WordIds(spec)


def _tokenize(spec, end: int):
    def run(batches):
        word_ids = _word_ids(spec.value)
        for b in batches:
            for low, high in row_slices(b.column(1), TEXT_BYTES):
                ids, counts = word_ids(b.column(1).slice(low, high - low))
                borders = np.cumsum(counts)
                ids = np.insert(ids, borders, end)
                parts = np.split(ids, borders[:-1] + np.arange(1, len(borders)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(low, high - low), pa.array([x.tobytes() for x in parts], pa.binary())], names=["doc_id", "ids"])

    return run


def tokenize(docs: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, end: int = 2) -> DataFrame:
    """``doc_id, ids`` of every row: the ids of the whole text and the end id, as little-endian 16-bit numbers.

    A key that is a struct comes back as it is, any other as a long.
    """
    with open(path or tokenizer_path()) as f:
        spec = docs.sparkSession.sparkContext.broadcast(f.read())
    whole = isinstance(docs.schema[key].dataType, T.StructType)
    rows = docs.select((F.col(key) if whole else F.col(key).cast("long")).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(_tokenize(spec, end), T.StructType([rows.schema["doc_id"], T.StructField("ids", T.BinaryType())]))


def _count(batches):
    total = np.zeros(1 << 16, np.int64)
    for b in batches:
        for ids in b.column(0):
            total += np.bincount(np.frombuffer(ids.as_py(), "<u2"), minlength=1 << 16)
    known = np.flatnonzero(total)
    yield pa.RecordBatch.from_pydict({"id": known.astype(np.int64), "n": total[known]})


#: A row of a file: numbers, then bytes.
NUMBERS = ("file", "row", "docs", "tokens")
BYTES = ("ids", "nulls", "counts", "words", "firsts", "states", "sums")
ROW = ", ".join([*(f"{c} bigint" for c in NUMBERS), *(f"{c} binary" for c in BYTES)])
_ROW = pa.schema([*((c, pa.int64()) for c in NUMBERS), *((c, pa.binary()) for c in BYTES)])


def _write_rows(counts):
    def row(table, file, number, ids, bodies):
        lengths = np.array([len(x) // 2 for x in bodies], np.int64)
        symbols = np.frombuffer(b"".join(bodies), "<u2")
        nulls = np.array([i is None for i in ids], bool)
        known = np.array([0 if i is None else i for i in ids], np.int64)
        head = [file, number, len(ids), len(symbols), known.astype("<i8").tobytes(), nulls.tobytes(), lengths.astype("<u4").tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip([*head, *rans.encode(symbols, table)], _ROW)], schema=_ROW)

    def run(batches) -> Iterator[pa.RecordBatch]:
        table, file, number = rans.Frequencies(counts.value), TaskContext.get().partitionId(), 0
        ids, bodies, held = [], [], 0
        for b in batches:
            for i, body in zip(b.column(0).to_pylist(), b.column(1)):
                body = body.as_py()
                if ids and held + len(body) // 2 > ROW_TOKENS:
                    yield row(table, file, number, ids, bodies)
                    ids, bodies, held, number = [], [], 0, number + 1
                ids.append(i)
                bodies.append(body)
                held += len(body) // 2
        if ids:
            yield row(table, file, number, ids, bodies)

    return run


def write_files(tokens: DataFrame, path: str) -> None:
    """Write ``doc_id, ids`` (a stored table) to files under a new folder, in ascending id, null ids first.

    Rows with equal ids follow each other in the order of their tokens.
    """
    spark = tokens.sparkSession
    counts = np.zeros(1 << 16, np.int64)
    per_id = tokens.select("ids").mapInArrow(_count, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    for r in per_id.collect():  # at most as many rows as 16-bit ids
        counts[r.id] = r.n
    frame = spark.createDataFrame([(counts.astype("<i8").tobytes(),)], "counts binary")
    frame.coalesce(1).write.parquet(f"{path}/frequencies")
    ordered = tokens.repartitionByRange(shuffle_parts(spark), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(_write_rows(spark.sparkContext.broadcast(counts)), ROW).write.option("compression", "none").parquet(f"{path}/files")


def _read_rows(counts, digest: bool):
    def run(batches):
        table = rans.Frequencies(counts.value)
        for b in batches:
            for r in b.to_pylist():
                symbols = rans.decode(r["words"], r["firsts"], r["states"], r["sums"], r["tokens"], table)
                lengths = np.frombuffer(r["counts"], "<u4").astype(np.int64)
                upto = np.concatenate([[0], np.cumsum(lengths)])
                if upto[-1] != r["tokens"]:
                    raise ValueError("token counts of a row do not add up: the file is damaged")
                ids = pa.array(np.frombuffer(r["ids"], "<i8"), mask=np.frombuffer(r["nulls"], bool))
                bodies = [symbols[a:z].astype("<u4").tobytes() for a, z in zip(upto[:-1], upto[1:])]
                last = pa.array([zlib.crc32(x) for x in bodies], pa.int64()) if digest else pa.array(bodies, pa.binary())
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array([r["file"]] * n, pa.int64()), pa.array([r["row"]] * n, pa.int64()), pa.array(upto[:-1]), pa.array(lengths), last],
                    names=["doc_id", "file", "row", "inside", "n_tokens", "last"],
                )

    return run


def read_files(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """``doc_id, start, n_tokens, ids`` (little-endian 32-bit numbers) of every document; with ``digest`` ``ids_crc32`` for ``ids``.

    Starts are sums of token counts: of the files before, and of the rows before in the file.
    """
    counts = np.frombuffer(spark.read.parquet(f"{path}/frequencies").first().counts, "<i8")
    files = spark.read.schema(ROW).parquet(f"{path}/files")
    rows = stored(files.select("file", "row", "tokens"), "rows")
    earlier = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    of_file = rows.groupBy("file").agg(F.sum("tokens").alias("tokens"))
    of_file = of_file.select("file", F.coalesce(F.sum("tokens").over(earlier().orderBy("file")), F.lit(0)).alias("base"))
    in_file = rows.select("file", "row", F.coalesce(F.sum("tokens").over(earlier("file").orderBy("row")), F.lit(0)).alias("before"))
    starts = stored(in_file.join(of_file, "file").select("file", "row", (F.col("base") + F.col("before")).alias("start")), "starts")
    kind = "bigint" if digest else "binary"
    found = files.mapInArrow(_read_rows(spark.sparkContext.broadcast(counts), digest), f"doc_id bigint, file bigint, row bigint, inside bigint, n_tokens bigint, last {kind}")
    placed = found.join(small_side(starts), ["file", "row"])
    name = "ids_crc32" if digest else "ids"
    return placed.select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", F.col("last").alias(name))


def token_file_report(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Tokenize ``docs`` into files under ``path``, read them back: ``doc_id, start, n_tokens, ids_crc32`` per document.

    Null and empty texts have the end id only. Null ids come first; repeated rows come back as often. An empty table
    makes empty files and gives no rows. Only the two named columns are read.
    """
    write_files(stored(tokenize(docs, key, text), "tokens"), path)
    return read_files(docs.sparkSession, path, digest=True)
