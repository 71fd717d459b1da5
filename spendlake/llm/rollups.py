"""Token totals by source, language and tokenizer version, kept up to date by signed changes.

A batch of changes is turned into deltas: an insert adds a document and its tokens, a delete takes them away, a revised
count does both. Deltas are combined before they are shuffled and stored under the batch's id; so are the changed
entries, from which later batches read what a document counted for. A batch is committed by overwriting its own folders,
with the entries last: committing it again, after a crash or twice, changes nothing. Totals are the sum of the deltas.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendlake.llm import bpe, token_files
from spendlake.llm.common import small_side, stored

GROUP = ("source", "lang", "version")
ENTRY = "doc_id bigint, version string, source string, lang string, tokens bigint, live boolean, seq bigint"
DELTA = "source string, lang string, version string, docs bigint, tokens bigint, seq bigint"

#: Tokenizer versions that are patterns: words between white space; runs of letters, runs of digits, single signs.
VERSIONS = {"words-1": r"[^\x20\x09-\x0D]+", "pieces-1": r"\p{L}+|\p{N}+|[^\p{L}\p{N}\x20\x09-\x0D]"}


def token_count(text: Column, version: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(VERSIONS[version])), F.lit(0)).cast("long")


def counted(docs: DataFrame, versions: tuple[str, ...] = tuple(VERSIONS), key: str = "doc_id", text: str = "text") -> DataFrame:
    """Entries to insert: one row per document and version. The text is read once for all versions."""
    each = F.array(*(F.struct(F.lit(v).alias("version"), token_count(F.col(text), v).alias("tokens")) for v in versions))
    return docs.select(F.col(key).alias("doc_id"), "source", "lang", F.explode(each).alias("e")).select("doc_id", "e.version", "source", "lang", "e.tokens")


def counted_ids(docs: DataFrame, vocabulary: bpe.Vocabulary | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Entries as from ``counted``, with the number of ids that each of the two tokenizers gives, its end id not counted."""
    rows = docs.select(F.struct(F.col(key).alias("doc_id"), "source", "lang").alias("row"), F.col(text).alias("text"))
    ids = [("byte-bpe", bpe.encode(rows, "row", "text", vocabulary), 4, 0), ("word-bpe", token_files.tokenize(rows, "row", "text"), 2, 1)]
    number = lambda width, ends: (F.octet_length("ids") / width).cast("long") - ends
    each = (x.select("doc_id.doc_id", F.lit(v).alias("version"), "doc_id.source", "doc_id.lang", number(w, e).alias("tokens")) for v, x, w, e in ids)
    return reduce(DataFrame.union, each)


@dataclass
class Rollup:
    """Totals under ``root``, a folder every executor reaches. One writer at a time; batches are numbered from 1."""

    spark: SparkSession
    root: str

    def _read(self, kind: str, batches: range, schema: str) -> DataFrame:
        """Named folders only: what another batch has left half-written is never read."""
        parts = [self.spark.read.schema(schema).parquet(f"{self.root}/{kind}/{b}") for b in batches]
        return reduce(DataFrame.union, parts, self.spark.createDataFrame([], schema))

    def _current(self, upto: int, changed: DataFrame) -> DataFrame:
        """Newest entry before a batch, per version of the changed documents; others are not shuffled."""
        entries = self._read("entries", range(1, upto), ENTRY)
        if upto > 1:
            wanted = small_side(changed.select(F.col("doc_id").alias("changed_id")).distinct())
            entries = entries.join(wanted, F.col("doc_id").eqNullSafe(F.col("changed_id")), "left_semi")
        newest = F.max_by(F.struct("source", "lang", "tokens", "live"), "seq").alias("e")
        return entries.groupBy("doc_id", "version").agg(newest).select("doc_id", "version", "e.*")

    def commit(self, batch: int, upserts: DataFrame | None = None, deletes: DataFrame | None = None) -> None:
        """Commit batch number ``batch``: entries inserted or revised (as from ``counted``), and ids deleted in all versions.

        An entry for a known document and version replaces it, whatever its source and language. Deleting an unknown id,
        or one deleted before, changes nothing; an id both deleted and given is replaced. Of entries repeated within a
        batch the one with most tokens counts (ties: least source, then language). Null ids, sources and languages are
        values like others.
        """
        if batch < 1:
            raise ValueError("batches are numbered from 1")
        none = self.spark.createDataFrame([], "doc_id bigint, version string, source string, lang string, tokens bigint")
        best = F.min(F.struct((-F.col("tokens")).alias("t"), "source", "lang")).alias("e")
        new = (none if upserts is None else upserts).groupBy("doc_id", "version").agg(best)
        new = new.select("doc_id", "version", F.struct("e.source", "e.lang", (-F.col("e.t")).alias("tokens"), F.lit(True).alias("live")).alias("e"), F.lit(1).alias("rank"))
        # Both are read more than once below: what they came from, whole texts perhaps, is not.
        new = stored(new, "upserts")
        deletes = None if deletes is None else stored(deletes.select("doc_id").distinct(), "deletes")
        changed = new.select("doc_id") if deletes is None else new.select("doc_id").union(deletes.select("doc_id"))
        old = self._current(batch, changed).select("doc_id", "version", F.struct("source", "lang", "tokens", "live").alias("e"), F.lit(0).alias("rank"))
        pick = lambda rank: F.max_by(F.col("e"), F.when(F.col("rank") == rank, 1))
        both = old.union(new).groupBy("doc_id", "version").agg(pick(0).alias("old"), pick(1).alias("new"))
        if deletes is not None:
            gone = deletes.select(F.col("doc_id").alias("gone_id")).withColumn("gone", F.lit(True))
            both = both.join(gone, F.col("doc_id").eqNullSafe(F.col("gone_id")), "left")
        else:
            both = both.withColumn("gone", F.lit(False))
        was = F.coalesce(F.col("old.live"), F.lit(False))
        moved = both.where(F.col("new").isNotNull() | (F.coalesce("gone", F.lit(False)) & was)).withColumn("was", was)
        entry = F.coalesce("new", "old")
        entries = moved.select(
            "doc_id", "version", entry.source.alias("source"), entry.lang.alias("lang"), entry.tokens.alias("tokens"),
            F.col("new").isNotNull().alias("live"), F.lit(batch).cast("long").alias("seq"),
        )
        sign = lambda side, n: F.struct(F.col(f"{side}.source").alias("source"), F.col(f"{side}.lang").alias("lang"), "version", F.lit(n).alias("docs"), (F.col(f"{side}.tokens") * n).alias("tokens"))
        signed = F.array_compact(F.array(F.when(F.col("was"), sign("old", -1)), F.when(F.col("new").isNotNull(), sign("new", 1))))
        deltas = moved.select(F.explode(signed).alias("d")).select("d.*").groupBy(*GROUP)
        deltas = deltas.agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens")).withColumn("seq", F.lit(batch).cast("long"))
        deltas.write.mode("overwrite").parquet(f"{self.root}/deltas/{batch}")
        entries.write.mode("overwrite").parquet(f"{self.root}/entries/{batch}")

    def totals(self, upto: int) -> DataFrame:
        """``source, lang, version, docs, tokens`` after the given batch; groups without documents are left out."""
        summed = self._read("deltas", range(1, upto + 1), DELTA).groupBy(*GROUP).agg(F.sum("docs").alias("docs"), F.sum("tokens").alias("tokens"))
        return summed.where("docs <> 0 or tokens <> 0")
