"""Toxicity of texts by a weighted lexicon, learned from labels and matched by Aho-Corasick.

Texts are folded first: case, accents, look-alike letters of other scripts, invisible characters, digits and signs in place
of letters. What is left of l, i, 1, | and ! is one letter. The lexicon holds the folded words that labelled toxic texts
have much more often than clean ones, weighted by the lower bound of their log odds ratio; exception phrases are the
neighbours of such a word with which it is found in clean texts. Copies would make any word look toxic, so texts are told
apart by the least hash of their windows of five words and counted once each. One automaton finds words and exceptions in a single pass; the
weights found, as a sum and per word of the text, go into a logistic curve, fitted on training texts whose own label was
taken out of the counts behind their weights.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.llm.common import free_name, small_side, stored

#: Labelled rows that the lexicon is fitted on, about; of more, those of the smallest hashes.
FIT_ROWS = 900_000
#: Words and exception phrases kept at most: what is broadcast.
TERMS = 100_000
#: Standard errors taken off a log odds ratio; least texts that a word or phrase counts from.
BOUND, LEAST = 2.0, 3
#: Least weight of a word or phrase: it has to be twice as frequent in texts of one label.
WEIGHT = math.log(2)
#: Width of the cells that training texts are counted in.
CELL = 0.1
#: Score from which a text is called toxic.
THRESHOLD = 0.7

# Letters that look like a Latin one, and signs and digits written for letters.
ALIKE = str.maketrans(
    "авсԁеһіјкӏмногрԛѕтуѵԝхьαβγεηικνορτυχωςøłđħıŧƅɑɡɩʀ",
    "abcdehijklmhorpqstyvwxbabyenikvoptuxwsoldhitbagir",
)
DIGITS = dict(zip(map(ord, "0123456789l"), "oizeasgtbgi"))
SIGNS = dict(zip(map(ord, "@$!|+"), "asiit"))

_HIDDEN = re.compile("[\u0300-\u036f\u00ad\u200b-\u200f\u2060-\u2064\ufeff]+")
_FAR = re.compile(r"[^\w\x00-\x7f]+")
_NUMBER = re.compile(r"(?<![^\W_])[0-9]+(?![^\W_])")
_CUT = {c: " " for c in range(128) if not chr(c).isalnum()}
_CUT_BUT_SIGNS = {c: x for c, x in _CUT.items() if c not in SIGNS}
_LETTERS = DIGITS | SIGNS


def fold(text: str) -> str:
    """Letters in their plainest form; lengths may change."""
    if not text.isascii():
        text = _HIDDEN.sub("", unicodedata.normalize("NFKD", text))
    text = text.casefold()
    return text if text.isascii() else _FAR.sub(" ", text.translate(ALIKE))


def folded_words(text: str) -> tuple[str, str]:
    """Words of a text with digits as letters, numbers left out; and those that signs for letters are part of. Both are
    joined by single blanks."""
    plain = fold(text)
    words = " ".join(_NUMBER.sub(" ", plain).translate(_CUT | DIGITS).split())
    if not any(chr(s) in plain for s in SIGNS):
        return words, ""
    signed = (w.rstrip("!|+@") for w in plain.translate(_CUT_BUT_SIGNS).split() if not w.isalnum())
    return words, " ".join(w for w in signed if w and not w.isalnum()).translate(_LETTERS)


def word_weight(toxic: float, clean: float, toxic_all: float, clean_all: float) -> float:
    """Lower bound of the log odds ratio of a word that so many toxic and clean texts of all have; 0 if below."""
    toxic, clean = max(toxic, 0.0) + 0.5, max(clean, 0.0) + 0.5
    ratio = math.log(toxic / (toxic_all + 1)) - math.log(clean / (clean_all + 1))
    return max(0.0, ratio - BOUND * math.sqrt(1 / toxic + 1 / clean))


@dataclass
class Lexicon:
    """Folded words with the toxic and clean texts that have them, given weights, exceptions, and the curve."""

    toxic: int = 0
    clean: int = 0
    counts: dict[str, tuple[int, int]] = field(default_factory=dict)
    given: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    curve: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def __post_init__(self):
        self._automaton = None

    def __getstate__(self):
        return {**self.__dict__, "_automaton": None}

    def weight(self, word: str, label: int | None = None) -> float:
        """Of a word; ``label``: as if a text with this label, that has the word, were not among the counted ones."""
        if word in self.given:
            return self.given[word]
        a, b = self.counts[word]
        if label is None:
            return word_weight(a, b, self.toxic, self.clean)
        return word_weight(a - label, b - 1 + label, self.toxic - label, self.clean - 1 + label)

    def automaton(self):
        if self._automaton is None:
            words = {*self.counts, *self.given}
            a = ahocorasick.Automaton()
            for w in words:
                a.add_word(f" {w} ", (w, None))
            for phrase in self.exceptions:
                parts = phrase.split()
                # Where in the phrase its words of the lexicon end, counted from its last character.
                ends = [len(" ".join(parts[i + 1 :])) + (i + 1 < len(parts)) for i, w in enumerate(parts) if w in words]
                if len(parts) > 1 and ends:
                    a.add_word(f" {' '.join(parts)} ", (None, ends))
            a.make_automaton()
            self._automaton = a
        return self._automaton

    def hits(self, words: str) -> list[tuple[str, int]]:
        """Words of the lexicon outside exceptions, and where the blank behind them is, counted from one before the first."""
        if not words or not len(self.automaton()):
            return []
        found, excepted = {}, set()
        for end, (word, ends) in self.automaton().iter(f" {words} "):
            if ends is None:
                found[end] = word
            else:
                excepted.update(end - e for e in ends)
        return [(w, end) for end, w in found.items() if end not in excepted]

    def places(self, text: str | None, label: int | None = None) -> tuple[float, float]:
        """Weights found in a text, as a sum and per 100 words, both as logarithms."""
        words, signed = folded_words(text or "")
        total = sum(self.weight(w, label) for part in (words, signed) for w, _ in self.hits(part))
        return math.log1p(total), math.log1p(100 * total / (words.count(" ") + 1))

    def score(self, text: str | None) -> float:
        x, y = self.places(text)
        start, per_sum, per_word = self.curve
        z = start + per_sum * x + per_word * y
        return 1 / (1 + math.exp(-z)) if z >= 0 else math.exp(z) / (1 + math.exp(z))


def fitted_curve(cells: Iterable[tuple[float, float, int, int]]) -> tuple[float, float, float]:
    """Logistic regression on cells (sum, per word, toxic texts, clean texts) with a slight pull to 0; slopes of a wrong
    sign are left out. Without cells: a score of 0.5."""
    cells = np.array(sorted(cells), np.float64).reshape(-1, 4)
    use = [True, True, True]
    while True:
        x = np.column_stack([np.ones(len(cells)), cells[:, 0], cells[:, 1]])[:, use]
        toxic, all_ = cells[:, 2], cells[:, 2] + cells[:, 3]
        b = np.zeros(x.shape[1])
        pull = np.full(len(b), 0.01)
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(x @ b, -40, 40)))
            down = x.T @ (all_ * p - toxic) + pull * b
            step = np.linalg.solve(x.T @ (x * (all_ * p * (1 - p))[:, None]) + np.diag(pull), down)
            b -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-300))
            if np.abs(step).max() < 1e-10:
                break
        out = np.zeros(3)
        out[use] = b
        if (out[1:] >= 0).all():
            return tuple(map(float, out))
        use[1 + int(np.argmin(out[1:]))] = False


ITEMS = "row bigint, toxic int, mark bigint, items array<string>"


def _mark(line: str) -> int:
    """The least hash of a text's windows of five words: equal for copies, and mostly for near copies."""
    words = line.split()
    return min(xxhash.xxh64_intdigest(" ".join(words[i : i + 5])) >> 1 for i in range(max(1, len(words) - 4)))


def _words(batches) -> Iterator[pa.RecordBatch]:
    for b in batches:
        folded = [folded_words(x or "") for x in b.column(2).to_pylist()]
        every = [sorted({w for part in f for w in part.split()}) for f in folded]
        columns = [pa.array([_mark(f[0]) for f in folded], pa.int64()), pa.array(every, pa.list_(pa.string()))]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), *columns], names=["row", "toxic", "mark", "items"])


def _neighbours(lexicon):
    """Phrases of a lexicon word and the word before or behind it, of each text once."""

    def run(batches):
        for b in batches:
            every = []
            for x in b.column(1).to_pylist():
                words, _ = folded_words(x or "")
                line, found = f" {words} ", set()
                for w, end in lexicon.value.hits(words):
                    # Blanks in front of the word, in front of the word before it, and behind the one after it.
                    begin = end - len(w) - 1
                    if begin > 0:
                        found.add(line[line.rfind(" ", 0, begin) + 1 : end])
                    if end < len(line) - 1:
                        found.add(line[begin + 1 : line.find(" ", end + 1)])
                every.append(sorted(found))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(every, pa.list_(pa.string()))], names=["toxic", "items"])

    return run


def _cells(lexicon):
    def run(batches):
        for b in batches:
            rows = [(t, *lexicon.value.places(x, t)) for t, x in zip(*(c.to_pylist() for c in b.columns))]
            cells = [pa.array([round(r[k] / CELL) for r in rows], pa.int64()) for k in (1, 2)]
            yield pa.RecordBatch.from_arrays([b.column(0), *cells], names=["toxic", "x", "y"])

    return run


def _scores(lexicon):
    def run(batches):
        for b in batches:
            scores = [lexicon.value.score(x) for x in b.column(2).to_pylist()]
            called = [int(s >= THRESHOLD) for s in scores]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64()), pa.array(called, pa.int32())], names=["doc_id", "held_out", "score", "predicted"])

    return run


def _texts_with(df: DataFrame) -> DataFrame:
    """Per item the toxic (``a``) and clean (``b``) texts that have it."""
    each = df.select(F.explode("items").alias("item"), "toxic")
    return each.groupBy("item").agg(F.count_if(F.col("toxic") == 1).alias("a"), F.count_if(F.col("toxic") == 0).alias("b"))


def _bound(more: str, less: str, more_all: int, less_all: int):
    """``word_weight`` as a column, before what is below 0 is cut off."""
    x, y = F.col(more) + 0.5, F.col(less) + 0.5
    return F.log(x / (more_all + 1.0)) - F.log(y / (less_all + 1.0)) - BOUND * F.sqrt(1 / x + 1 / y)


def learn(train: DataFrame, given: dict[str, float] | None = None, exceptions: Iterable[str] = ()) -> Lexicon:
    """Lexicon and curve from ``row`` (a number of its own), ``toxic`` (0 or 1) and ``text``, a stored table."""
    spark = train.sparkSession
    worded = stored(train.select("row", "toxic", "text").mapInArrow(_words, ITEMS), "toxic-words")
    # One text of each mark; as many rows as training texts at most.
    own = stored(worded.groupBy("toxic", "mark").agg(F.min("row").alias("row")), "toxic-texts")
    sizes = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    own = small_side(own.select("row"), sum(sizes.values()))
    folded = {folded_words(w)[0]: float(x) for w, x in (given or {}).items()}
    # Words of a given lexicon are matched one by one; phrases of it are not.
    lexicon = Lexicon(sizes.get(1, 0), sizes.get(0, 0), given={w: x for w, x in folded.items() if w and " " not in w})
    counts = _texts_with(worded.join(own, "row")).withColumn("w", _bound("a", "b", lexicon.toxic, lexicon.clean))
    counts = counts.where((F.col("a") >= LEAST) & (F.col("w") >= WEIGHT)).orderBy(F.desc("w"), "item").limit(TERMS)
    lexicon.counts = {r.item: (r.a, r.b) for r in counts.collect()}
    if lexicon.counts or lexicon.given:
        first = spark.sparkContext.broadcast(lexicon)
        near = train.join(own, "row").select("toxic", "text").mapInArrow(_neighbours(first), "toxic int, items array<string>")
        found = _texts_with(near).withColumn("w", _bound("b", "a", lexicon.clean, lexicon.toxic))
        found = found.where((F.col("b") >= LEAST) & (F.col("w") >= WEIGHT)).orderBy(F.desc("w"), "item").limit(TERMS)
        lexicon.exceptions = [r.item for r in found.select("item").collect()]
    lexicon.exceptions += [folded_words(e)[0] for e in exceptions]
    lexicon = Lexicon(lexicon.toxic, lexicon.clean, lexicon.counts, lexicon.given, lexicon.exceptions)
    cells = train.select("toxic", "text").mapInArrow(_cells(spark.sparkContext.broadcast(lexicon)), "toxic int, x bigint, y bigint")
    # Logarithms in steps of CELL: a few thousand cells, whatever the number of texts.
    cells = cells.groupBy("x", "y").agg(F.count_if(F.col("toxic") == 1).alias("t"), F.count_if(F.col("toxic") == 0).alias("c")).collect()
    lexicon.curve = fitted_curve((r.x * CELL, r.y * CELL, r.t, r.c) for r in cells)
    return lexicon


def held_out(key: str):
    """Rows that labels are never learned from: crc32 of the id as text leaves 1 when divided by 3; a null id does not."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic") -> DataFrame:
    """``row, toxic, text`` of labelled rows that are not held out, about ``FIT_ROWS`` of them at most.

    Labels other than 0 and 1 and null ids are ignored; an id with both labels is left out, one labelled twice alike is
    taken once for every row of that id.
    """
    known = labels.select(F.col(key).cast("long").alias("id"), F.col(label).cast("int").alias("toxic")).where("toxic in (0, 1) and id is not null")
    known = known.where(~held_out("id")).groupBy("id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other"))
    known = stored(known.where("toxic = other").select("id", "toxic"), "labels")
    rows = known.count()
    if rows > FIT_ROWS:
        known = stored(known.where(F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < F.lit(FIT_ROWS * (1 << 20) // rows)), "labels")
        rows = known.count()
    own = docs.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    return stored(own.join(small_side(known, rows), "id").select(F.monotonically_increasing_id().alias("row"), "toxic", "text"), "training")


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "toxic",
    given: dict[str, float] | None = None, exceptions: Iterable[str] = (),
) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    ``score`` is the probability of label 1 and depends on the text alone; ``predicted`` is 1 from ``THRESHOLD`` on. Null and
    empty texts have the score of a text without any word of the lexicon. ``given`` weighs further words, ``exceptions`` are
    phrases in which no word counts. Without labels of either kind no word is learned. Repeated rows are scored alike, a
    null id is never held out. Empty tables: no rows, or no labels. Other columns are not read.
    """
    lexicon = learn(training_rows(docs, labels, key, text, label), given, exceptions)
    mark = free_name(docs, "held_out")
    rows = docs.withColumn(mark, held_out(key)).select(F.col(key).cast("long").alias("doc_id"), F.col(mark).alias("held_out"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_scores(docs.sparkSession.sparkContext.broadcast(lexicon)), "doc_id bigint, held_out boolean, score double, predicted int")
