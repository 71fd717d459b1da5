"""Phrases whose words occur together far more often than their parts would by chance, per language.

Texts become blocks of one language: words as numbers of the block's own vocabulary, 0 between pieces. Words are counted
as strings; every word that is frequent in its language gets an id, and blocks are written once more with these ids, all
other words as breaks, for no frequent phrase contains them (Apriori). Ids reach the blocks as broadcast lexicons of a
bounded size, one after the other, so neither blocks nor their words are shuffled. From then on only numbers are read.

Candidates grow a word at a time: a window of k words is looked at only if both its parts of k - 1 words are frequent,
which tries of the level before tell. Most windows are rare, so they are summed by slots first, at least as many as the
table has words: a task sends gaps between its slots and counts, a byte or two a window. A frequent window is in a frequent
slot, and only windows in these are summed by their ids, in each task first. All candidates go to tries in two arrays, whose size is bounded by
that of shards of the candidates (by hash), broadcast one after the other. A task moves all positions of a block through a trie at once, a
word a level, and counts accepting states; the sums over tasks and shards are the occurrences that scores are made of.

Within a block words are told apart by 64-bit hashes, elsewhere by their strings and ids.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm import lm
from spendlake.llm.common import discard, row_slices, stored
from spendlake.llm.words import LOWER, hashes, mix, seeds, text_bytes

#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 1 << 20
#: Rows of texts or blocks that a task takes into memory at a time, and Spark's setting for it.
ROWS, ROWS_AT_A_TIME = 1000, "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Phrases of a trie, which is what is broadcast: at most some 100 MB with all its arrays, for phrases of 5 words.
SHARD = 500_000
#: Windows or phrases that a task hands on at a time.
FOUND = 50_000
#: Words of a lexicon and frequent slots that are broadcast at a time: some 20 and 30 MB.
LEXICON, SLOTS = 500_000, 4_000_000
#: Bits of a slot within its part, whose counts lie in a task's memory, and slots or phrases that a task holds before it
#: hands them on.
PART_BITS, HELD = 21, 1_000_000
#: Bytes that separate words, and bytes that end a piece.
BLANKS, BREAKS = b" \t", b".,;:!?\n\x0b\x0c\r"

#: Odd, so that products with it spread over all slots.
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_IN_WORD, _BREAK = np.ones(256, bool), np.zeros(256, bool)
_BREAK[list(BREAKS)] = True
_IN_WORD[list(BLANKS + BREAKS)] = False

BLOCK = "lang string, n bigint, body binary, words array<string>, counts array<bigint>"
#: Blocks with the places in ``words`` whose ids are known, and the ids.
KNOWN = "lang string, words array<string>, body binary, size int, place array<int>, id array<bigint>"
#: What tasks hand on of the slots or phrases of a part, and sums of phrases.
PART, SUMS = "part bigint, body binary", "key binary, a bigint"


def pack(x: np.ndarray) -> bytes:
    """An array compressed with its bytes of equal weight side by side: those of small numbers are mostly 0."""
    return lm.pack(np.ascontiguousarray(x).view(np.uint8).reshape(-1, x.itemsize).T)


def unpack(x: bytes, dtype) -> np.ndarray:
    width = np.dtype(dtype).itemsize
    return np.ascontiguousarray(lm.unpack(x, np.uint8).reshape(width, -1).T).reshape(-1).view(dtype)


def _strings(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[str]:
    body = data.tobytes()
    return [body[a:z].decode() for a, z in zip(starts.tolist(), ends.tolist())]


def _numbered(data: np.ndarray) -> tuple[np.ndarray, list[str], np.ndarray]:
    """Words of the bytes as numbers from 1 with 0 between pieces, the words, and how often each occurs, most frequent first."""
    data = LOWER[data]
    edges = np.diff(_IN_WORD[data].astype(np.int8), prepend=np.int8(0), append=np.int8(0))
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    if not len(starts):
        return np.zeros(0, np.uint32), [], np.zeros(0, np.int64)
    piece = np.cumsum(_BREAK[data], dtype=np.uint32)[starts]
    _, first, number, counts = np.unique(hashes(data, starts, ends), return_index=True, return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    first, number, counts = first[order], np.argsort(order)[number], counts[order]
    new = np.diff(piece, prepend=piece[0]) != 0
    out = np.zeros(len(starts) + int(new.sum()), np.uint32)
    out[np.arange(len(starts)) + np.cumsum(new)] = number + 1
    return out, _strings(data, starts[first], ends[first]), counts


def _blocks(batches) -> Iterator[pa.RecordBatch]:
    held: dict[str, list[np.ndarray]] = {}
    sizes: dict[str, int] = {}

    def block(lang):
        body, words, counts = _numbered(np.concatenate(held.pop(lang)))
        del sizes[lang]
        pa.default_memory_pool().release_unused()
        columns = [[lang], [int(counts.sum())], [pack(body)], [words], [counts]]
        kinds = [pa.string(), pa.int64(), pa.binary(), pa.list_(pa.string()), pa.list_(pa.int64())]
        names = ["lang", "n", "body", "words", "counts"]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    for b in batches:
        langs = b.column(0).dictionary_encode()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            rows = np.flatnonzero(langs.indices.to_numpy(zero_copy_only=False) == k)
            own = b.column(1).take(pa.array(rows))
            for begin, end in row_slices(own, BLOCK_BYTES):
                data, offsets = text_bytes(own.slice(begin, end - begin))
                # A line feed ends each text, so no piece goes on in the next one.
                data = np.insert(data, offsets[1:], 10)
                held.setdefault(lang, []).append(data)
                sizes[lang] = sizes.get(lang, 0) + len(data)
                while sizes and (sizes.get(lang, 0) >= BLOCK_BYTES or sum(sizes.values()) >= 4 * BLOCK_BYTES):
                    yield block(max(sizes, key=sizes.get))
    for lang in list(held):
        yield block(lang)


def _known(lexicon):
    """Blocks with the ids of those of their words that are in the lexicon, besides the ids they have."""

    def run(batches):
        for b in batches:
            places, ids = [], []
            for lang, words, place, own in zip(b["lang"], b["words"], b["place"], b["id"]):
                known, numbers = lexicon.value.get(lang.as_py(), (pa.array([], words.values.type), np.zeros(0, np.int64)))
                found = pa.compute.fill_null(pa.compute.index_in(words.values, value_set=known), -1).to_numpy()
                at = np.flatnonzero(found >= 0)
                places.append(np.concatenate([place.values.to_numpy(), at]))
                ids.append(np.concatenate([own.values.to_numpy(), numbers[found[at]]]))
            columns = [*(b[name] for name in ("lang", "words", "body", "size")), pa.array(places, pa.list_(pa.int32())), pa.array(ids, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["lang", "words", "body", "size", "place", "id"])

    return run


def _known_coded(lexicon):
    def run(batches):
        return _coded(b.select(["body", "size", "place", "id"]) for b in _known(lexicon)(batches))

    return run


def _coded(batches) -> Iterator[pa.RecordBatch]:
    """Blocks with the ids of frequent words, runs of other words and breaks as one 0."""
    for b in batches:
        bodies = []
        for body, size, places, ids in zip(*b.columns):
            table = np.zeros(size.as_py() + 1, np.int64)
            table[places.values.to_numpy() + 1] = ids.values.to_numpy()
            out = table[unpack(body.as_py(), np.uint32)]
            keep = out != 0
            keep[1:] |= out[:-1] != 0
            bodies.append(pack(out[keep]))
        yield pa.RecordBatch.from_arrays([pa.array(bodies, pa.binary())], names=["body"])


class DoubleArray:
    """Trie of phrases (rows of ids, 0 behind the last word) in two arrays of twice to four times as many slots as it has
    edges, however many children a state has: the child of state s by symbol c is ``size`` and the first slot from the hash of
    both on where ``check`` has them, unless a free slot comes first; ``accept`` has the phrase that ends in a state. Symbols
    are the numbers of the ids among those of the phrases, and the states of first words."""

    def __init__(self, phrases: np.ndarray):
        self.phrases = phrases
        self.symbols = np.unique(phrases[phrases > 0])
        self.size = len(self.symbols) + 1
        symbols = np.where(phrases > 0, np.searchsorted(self.symbols, phrases) + 1, 0)
        self.bits = (2 * max(1, self._edges(symbols)) - 1).bit_length()
        self.check = np.full(1 << self.bits, -1, np.int64)
        state = symbols[:, 0].copy()
        for level in range(1, phrases.shape[1]):
            rows = np.flatnonzero(symbols[:, level])
            edges, number = np.unique(state[rows] * self.size + symbols[rows, level], return_inverse=True)
            state[rows] = self._place(edges)[number]
        self.accept = np.full(self.size + len(self.check), -1, np.int32)
        self.accept[state] = np.arange(len(phrases))

    @staticmethod
    def _edges(symbols: np.ndarray) -> int:
        """Different beginnings of two words or more."""
        rows = symbols[np.lexsort(symbols.T[::-1])]
        new = np.ones(rows.shape, bool)
        new[1:] = np.logical_or.accumulate(rows[1:] != rows[:-1], axis=1)
        return int((new & (rows > 0))[:, 1:].sum())

    def _slot(self, edges: np.ndarray) -> np.ndarray:
        return ((edges.astype(np.uint64) * _SPREAD) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _place(self, edges: np.ndarray) -> np.ndarray:
        """States that new edges lead to: of those that meet in a free slot one takes it, the others go on."""
        slots, left = self._slot(edges), np.arange(len(edges))
        while len(left):
            free = left[self.check[slots[left]] == -1]
            self.check[slots[free]] = edges[free]
            left = left[self.check[slots[left]] != edges[left]]
            slots[left] = (slots[left] + 1) & (len(self.check) - 1)
        return slots + self.size

    def _follow(self, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of the edges there are, and the states they lead to."""
        slots = self._slot(edges)
        there = self.check[slots]
        left = np.flatnonzero((there != edges) & (there != -1))
        while len(left):
            slots[left] = (slots[left] + 1) & (len(self.check) - 1)
            there[left] = self.check[slots[left]]
            left = left[(there[left] != edges[left]) & (there[left] != -1)]
        on = np.flatnonzero(there == edges)
        return on, slots[on] + self.size

    def walk(self, ids: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Level by level: how many words were read, at which positions a path goes on, and the states there."""
        found = np.searchsorted(self.symbols, ids)
        found[found == len(self.symbols)] = 0
        symbols = np.where(self.symbols[found] == ids, found + 1, 0) if len(self.symbols) else np.zeros(len(ids), np.int64)
        places = np.flatnonzero(symbols)
        state = symbols[places]
        for level in range(1, self.phrases.shape[1]):
            inside = places + level < len(ids)
            places, state = places[inside], state[inside]
            symbol = symbols[places + level]
            known = np.flatnonzero(symbol)
            on, state = self._follow(state[known] * self.size + symbol[known])
            places = places[known[on]]
            yield level + 1, places, state


def _keys(windows: np.ndarray) -> pa.Array:
    """Rows of ids as binary values, 8 bytes an id; ids of 0 only behind the last are left out."""
    lengths = (windows > 0).sum(1) * 8
    body = windows[windows > 0].astype(">i8").tobytes()
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(windows), [None, pa.py_buffer(offsets), pa.py_buffer(body)])


def _phrases(keys: pa.Array, words: int) -> np.ndarray:
    """Rows of ids, 0 behind the last word, from what ``_keys`` made of them."""
    lengths = pa.compute.binary_length(keys).to_numpy(zero_copy_only=False) // 8
    out = np.zeros((len(keys), words), np.int64)
    if len(keys):
        out[np.arange(words) < lengths[:, None]] = np.frombuffer(keys.buffers()[2], ">i8", int(lengths.sum()))
    return out


def _counted(windows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([_keys(windows), pa.array(counts, pa.int64())], names=["key", "a"])


def _windows(words: int, trie=None, alone: bool = True):
    """Each block's ids, where its windows of ``words`` words begin (once for equal ones) and how often each occurs: those
    whose part without the last word is in the trie, and (``alone``: it holds all) the other part."""

    def run(batches):
        for b in batches:
            for body in b.column(0):
                ids = unpack(body.as_py(), np.int64)
                names, number = np.unique(ids, return_inverse=True)
                left, right = np.where(ids > 0, number, -1), np.where(ids > 0, number, -1)
                step = 1
                if trie is not None:
                    left = np.full(len(ids), -1, np.int64)
                    for level, places, states in trie.value.walk(ids):
                        if level == words - 1:
                            left[places] = trie.value.accept[states]
                    right, step = (left, 1) if alone else (right, words - 1)
                at = np.flatnonzero((left[: len(ids) - step] >= 0) & (right[step:] >= 0))
                pairs = left[at] * (int(right.max(initial=0)) + 1) + right[at + step]
                _, first, counts = np.unique(pairs, return_index=True, return_counts=True)
                yield ids, at[first], counts

    return run


def _slots(windows: np.ndarray, bits: int) -> np.ndarray:
    """The slot, of 2 ** ``bits``, of each row of ids."""
    factors = seeds(windows.shape[1], 31)
    return (mix(sum(windows[:, i].astype(np.uint64) * f for i, f in enumerate(factors))) >> np.uint64(64 - bits)).astype(np.int64)


def _grow(words: int, trie=None, alone: bool = True, slots=None, bits: int = 0):
    """Windows (see ``_windows``) and how often they occur; with ``slots``, sorted, those in one of these."""

    def run(batches):
        for ids, at, counts in _windows(words, trie, alone)(batches):
            if slots is not None:
                own = _slots(ids[at[:, None] + np.arange(words)], bits)
                place = np.searchsorted(slots.value, own)
                place[place == len(slots.value)] = 0
                inside = slots.value[place] == own
                at, counts = at[inside], counts[inside]
            for begin in range(0, len(at), FOUND):
                own = at[begin : begin + FOUND]
                yield _counted(ids[own[:, None] + np.arange(words)], counts[begin : begin + FOUND])

    return run


def _by_part(parts: np.ndarray, begins: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """A row a part, with its range of all columns packed."""
    bodies = [pack(np.concatenate([x[begin:end] for x in columns])) for begin, end in zip(begins, [*begins[1:], len(columns[0])])]
    return pa.RecordBatch.from_arrays([pa.array(parts, pa.int64()), pa.array(bodies, pa.binary())], names=["part", "body"])


def _slot_counts(words: int, trie, alone: bool, bits: int, least: int):
    """How often windows fall into slots: by part of the slots, the gaps between them and the counts (``least`` at most, for
    sums are only compared with it)."""

    def handed_on(held):
        slots, number = np.unique(np.concatenate([s for s, _ in held]), return_inverse=True)
        counts = np.bincount(number, np.concatenate([c for _, c in held])).astype(np.int64)
        parts, begins = np.unique(slots >> PART_BITS, return_index=True)
        gaps = np.diff(slots, prepend=0)
        gaps[begins] = slots[begins] - (parts << PART_BITS)
        return _by_part(parts, begins, [gaps, np.minimum(counts, least)])

    def run(batches):
        held, size = [], 0
        for ids, at, counts in _windows(words, trie, alone)(batches):
            held.append((_slots(ids[at[:, None] + np.arange(words)], bits), counts))
            size += len(at)
            if size >= HELD:
                yield handed_on(held)
                held, size = [], 0
        if size:
            yield handed_on(held)

    return run


def _frequent_slots(least: int):
    """Slots of a part into which ``least`` windows or more fall."""

    def run(key, table):
        total = np.zeros(1 << PART_BITS, np.int64)
        for body in table.column("body"):
            gaps, counts = unpack(body.as_py(), np.int64).reshape(2, -1)
            total[np.cumsum(gaps)] += counts
        return pa.table({"slot": (key[0].as_py() << PART_BITS) + np.flatnonzero(total >= least)})

    return run


def _summed(phrases: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal rows once, with the sum of their counts."""
    order = np.lexsort(phrases.T)
    phrases = phrases[order]
    first = np.flatnonzero(np.append(True, (phrases[1:] != phrases[:-1]).any(1)))
    return phrases[first], np.add.reduceat(counts[order], first)


def _task_sums(job, words: int, bits: int):
    """What ``job`` counts, summed in the task: by part of the phrases' slots, their ids, word after word, and the counts."""

    def handed_on(held):
        phrases, counts = _summed(np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held]))
        part = _slots(phrases, bits) >> PART_BITS
        order = np.argsort(part, kind="stable")
        parts, begins = np.unique(part[order], return_index=True)
        return _by_part(parts, begins, [*phrases[order].T, counts[order]])

    def run(batches):
        held, size = [], 0
        for b in job(batches):
            held.append((_phrases(b.column(0), words), b.column(1).to_numpy()))
            size += b.num_rows
            if size >= HELD:
                yield handed_on(held)
                held, size = [], 0
        if size:
            yield handed_on(held)

    return run


def _part_sums(words: int, least: int):
    """Phrases of a part that occur ``least`` times or more in all tasks."""

    def run(key, table):
        bodies = [unpack(x.as_py(), np.int64).reshape(words + 1, -1) for x in table.column("body")]
        phrases, counts = _summed(np.concatenate([x[:words].T for x in bodies]), np.concatenate([x[words] for x in bodies]))
        often = counts >= least
        return pa.Table.from_batches([_counted(phrases[often], counts[often])])

    return run


def _occurrences(trie):
    """How often each phrase of the trie occurs in the blocks of a task."""

    def run(batches):
        t = trie.value
        counts = np.zeros(len(t.phrases), np.int64)
        for b in batches:
            for body in b.column(0):
                for _, _, states in t.walk(unpack(body.as_py(), np.int64)):
                    ended = t.accept[states]
                    counts += np.bincount(ended[ended >= 0], minlength=len(counts))
        some = np.flatnonzero(counts)
        for begin in range(0, len(some), FOUND):
            own = some[begin : begin + FOUND]
            yield _counted(t.phrases[own], counts[own])

    return run


def _lexicons(frequent: DataFrame) -> Iterator[tuple[object, bool]]:
    """Broadcast lexicons of shards of the frequent words (of each language the words and their ids), one at a time, and
    whether it is the last."""
    spark = frequent.sparkSession
    shards = max(1, -(-frequent.count() // LEXICON))
    for shard in range(shards):
        part = frequent if shards == 1 else frequent.where(F.pmod(F.xxhash64("lang", "word"), F.lit(shards)) == shard)
        # About LEXICON words.
        rows = part.select("lang", "word", "id").toArrow().combine_chunks()
        own = {x: rows.filter(pa.compute.equal(rows["lang"], x)) for x in rows["lang"].unique().to_pylist()}
        lexicon = spark.sparkContext.broadcast({x: (t["word"].combine_chunks(), t["id"].to_numpy()) for x, t in own.items()})
        yield lexicon, shard == shards - 1
        lexicon.destroy()


def _tries(candidates: DataFrame, words: int) -> Iterator[tuple[object, bool]]:
    """Broadcast tries of shards of the candidates, one at a time, and whether there is just one."""
    spark = candidates.sparkSession
    shards = -(-candidates.count() // SHARD)
    for shard in range(shards):
        part = candidates if shards == 1 else candidates.where(F.pmod(F.xxhash64("key"), F.lit(shards)) == shard)
        # About SHARD keys of at most 40 bytes.
        trie = spark.sparkContext.broadcast(DoubleArray(_phrases(part.select("key").toArrow().column(0).combine_chunks(), words)))
        yield trie, shards == 1
        trie.destroy()


def _sums(blocks: DataFrame, job, words: int, bits: int, least: int, name: str) -> DataFrame:
    """Stored sums over all blocks of what ``job`` counts: phrases that occur ``least`` times or more."""
    return stored(blocks.mapInArrow(_task_sums(job, words, bits), PART).groupBy("part").applyInArrow(_part_sums(words, least), SUMS), name, slim=True)


def _frequent_windows(blocks: DataFrame, words: int, least: int, bits: int, trie=None, alone: bool = True) -> list[DataFrame]:
    """Stored windows that occur ``least`` times or more; each window's first part is in one trie only."""
    spark = blocks.sparkSession
    sums = blocks.mapInArrow(_slot_counts(words, trie, alone, bits, least), PART)
    slots = stored(sums.groupBy("part").applyInArrow(_frequent_slots(least), "slot bigint"), "slots", slim=True)
    shards, found = -(-slots.count() // SLOTS), []
    for shard in range(shards):
        part = slots if shards == 1 else slots.where(F.pmod("slot", F.lit(shards)) == shard)
        # About SLOTS numbers.
        own = spark.sparkContext.broadcast(np.sort(part.toArrow().column(0).to_numpy()))
        found.append(_sums(blocks, _grow(words, trie, alone, own, bits), words, bits, least, "candidates"))
        own.destroy()
    discard(slots)
    return found


def _stored(df: DataFrame, name: str) -> DataFrame:
    """``stored``, with few rows at a time going to Python; the session's own setting is put back."""
    conf = df.sparkSession.conf
    before = conf.get(ROWS_AT_A_TIME, None)
    conf.set(ROWS_AT_A_TIME, str(ROWS))
    try:
        return stored(df, name, slim=True)
    finally:
        conf.unset(ROWS_AT_A_TIME) if before is None else conf.set(ROWS_AT_A_TIME, before)


def _key(column: str):
    return F.unhex(F.lpad(F.hex(column), 16, "0"))


def collocations(docs: DataFrame, least: int = 100, longest: int = 5, top: int = 2000, percent: int = 100, text: str = "text", lang: str = "lang") -> DataFrame:
    """The ``top`` phrases of each language: ``lang, rank, phrase, a, l, r, n, score``.

    A-Z is lower-cased; pieces end at ``[.,;:!?\\x0A-\\x0D]`` and at the end of a text, words are ``[^\\x20\\x09]+`` in a piece. A
    null language is ``und`` (and counts with texts whose language has that name), a null text is empty; texts without
    words and an empty table give no rows. Repeated rows count as often as they occur. ``n``: words of the language;
    ``a``: occurrences of the phrase (2 to ``longest`` words, at least ``least``); it is cut where
    ``floor(1000 a n / (l r))`` is least (ties: first such cut), ``l`` and ``r`` being the occurrences of the two parts. A phrase
    inside a longer one that occurs at least ``percent`` per cent as often is left out. Rows are ranked by score, then ``a``
    (both descending), then phrase in the order of its bytes. Products are exact up to 38 digits; beyond, it raises.
    Only the two named columns are read.
    """
    if least < 1 or longest < 2:
        raise ValueError("phrases need at least 1 occurrence and 2 words")
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).cast("string").alias("text"))
    blocks = _stored(rows.mapInArrow(_blocks, BLOCK), "blocks")
    totals = stored(blocks.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    each = blocks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).select("lang", F.col("w.words").alias("word"), F.col("w.counts").alias("f"))
    frequent = stored(each.groupBy("lang", "word").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "frequent")
    # Stored with the words, so the ids stay; frequent words have small ones.
    frequent = stored(frequent.orderBy(F.desc("f")).withColumn("id", F.monotonically_increasing_id() + 1), "words")
    none = [F.array().cast(f"array<{kind}>").alias(name) for name, kind in (("place", "int"), ("id", "bigint"))]
    known, held = blocks.select("lang", "words", "body", F.size("words").alias("size"), *none), blocks
    for lexicon, last in _lexicons(frequent):
        if last:
            coded = stored(known.mapInArrow(_known_coded(lexicon), "body binary"), "coded", slim=True)
        else:
            known = stored(known.mapInArrow(_known(lexicon), KNOWN), "known", slim=True)
        discard(held)
        held = known
    # At least a slot for each word of the table.
    bits = max(PART_BITS, int(totals.agg(F.sum("n")).first()[0] or 0).bit_length())

    def union(found: list[DataFrame]) -> DataFrame:
        return reduce(DataFrame.union, found, spark.createDataFrame([], SUMS))

    levels = [union(_frequent_windows(coded, 2, least, bits))]
    for words in range(3, longest + 1):
        levels.append(union([x for t, alone in _tries(levels[-1], words - 1) for x in _frequent_windows(coded, words, least, bits, t, alone)]))
    found = [_sums(coded, _occurrences(t), longest, bits, 1, "occurrences") for t, _ in _tries(union(levels), longest)]
    counted = stored(union(found), "phrases")
    discard(*found, coded)
    parts = counted.union(frequent.select(_key("id").alias("key"), F.col("f").alias("a")))
    length = F.octet_length("key") / 8
    cuts = counted.select("key", "a", F.explode(F.sequence(F.lit(1), length.cast("int") - 1)).alias("k"))
    cuts = cuts.withColumn("first", F.expr("substring(key, 1, 8 * k)")).withColumn("rest", F.expr("substring(key, 8 * k + 1)"))
    cuts = cuts.join(parts.select(F.col("key").alias("first"), F.col("a").alias("l")), "first").join(parts.select(F.col("key").alias("rest"), F.col("a").alias("r")), "rest")
    # All langs' totals: as many rows as languages. The first word's id tells the language.
    heads = frequent.join(totals, "lang").select(_key("id").alias("head"), "lang", "n")
    cuts = cuts.withColumn("head", F.expr("substring(key, 1, 8)")).join(heads, "head")
    score = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    best = cuts.withColumn("score", score).groupBy("key", "a", "lang", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    # A longer phrase that occurs as often contains one a word longer than this that does, too.
    longer = counted.where(length > 2).select(F.explode(F.array(F.expr("substring(key, 1, octet_length(key) - 8)"), F.expr("substring(key, 9)"))).alias("key"), F.col("a").alias("longer"))
    longer = longer.groupBy("key").agg(F.max("longer").alias("longer"))
    best = best.join(longer, "key", "left").where(F.col("longer").isNull() | (100 * F.col("longer") < percent * F.col("a")))
    at = F.sequence(F.lit(0), length.cast("int") - 1)
    words = best.select("key", F.explode(at).alias("i")).select("key", "i", F.expr("substring(key, 8 * i + 1, 8)").alias("one"))
    words = words.join(frequent.select(_key("id").alias("one"), "word"), "one").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("i", "word"))).alias("w"))
    named = best.join(words, "key").withColumn("phrase", F.array_join("w.word", " "))
    ranked = named.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")).cast("long"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")


#: The same for ``least`` 100, ``longest`` 5, ``top`` 2000 and ``percent`` 100.
COLLOCATION_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents WHERE text IS NOT NULL
),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM worded GROUP BY lang),
placed AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
grams AS (SELECT lang, list_slice(w, i, i + k - 1) AS p, k FROM placed, (SELECT unnest(range(1, 6)) AS k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, p, k, CAST(count(*) AS HUGEINT) AS a FROM grams GROUP BY ALL HAVING count(*) >= 100),
cuts AS (SELECT lang, p, k, a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
scored AS (
  SELECT c.lang, c.p, c.k, c.a, c.c, x.a AS l, y.a AS r, t.n, (1000 * c.a * t.n) // (x.a * y.a) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, c.c)
  JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, c.c + 1, c.k) JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, c) = 1),
inside AS (
  SELECT lang, list_slice(p, s, s + m - 1) AS p, max(a) AS longer
  FROM f, (SELECT unnest(range(2, 5)) AS m), (SELECT unnest(range(1, 5)) AS s) WHERE m < k AND s + m - 1 <= k GROUP BY ALL
),
kept AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.p = b.p WHERE i.longer IS NULL OR 100 * i.longer < 100 * b.a
),
ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' ')) AS rank,
    array_to_string(p, ' ') AS phrase, a, l, r, n, score
  FROM kept
)
SELECT lang, CAST(rank AS BIGINT) AS rank, phrase, CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r,
  CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM ranked WHERE rank <= 2000
"""
