"""Jaccard self-join of texts on word n-grams: size-banded tiles, bitmap bounds, exact intersection.

1. Every text becomes the sorted distinct 64-bit hashes of its n-grams. Equal sets are one class, so exact copies are
   handled once.
2. Candidates. Sets whose similarity reaches the threshold have sizes in one band or in two that adjoin (the ratio of a
   band is the threshold), and differ in at most ``k`` n-grams, ``k`` known per band. The hash space is cut into more
   than ``k`` ranges; two such sets then hold exactly the same n-grams in some range. Band, range and a hash of the
   content make a key, and classes that share a key are tied to the smallest of them. No pair is listed; a class goes
   into a batch once per key, and batches are merged as sorted arrays.
3. Tied classes form clusters. A cluster is compared in tiles: whole if it is small, else in pairs of blocks of one size
   band or two that adjoin. In a tile, hashed bitmaps bound every overlap from above by their bit counts, and only sets
   that pass the bound are intersected exactly. A set already reached in the tile is not compared again, so a tile yields
   fewer links than it has members, however many pairs are similar. A set is sent once to each of its tiles; tiles are
   worked off in waves that send about as many n-grams as all sets have, so the disk in use does not grow with the number
   of tiles a set is in.
4. Components of the links, over classes; their smallest document id goes to every document.

Exact but for collisions of 64-bit hashes. Empty sets link with nothing.
"""

from __future__ import annotations

import bisect
import functools
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendlake.llm.common import batch, by_part, discard, free_name, longs, row_slices, shuffle_parts, small_side, stored
from spendlake.llm.components import components
from spendlake.llm.words import mix, shingle_sets

#: Bytes of text turned into sets at a time, and keys gathered before they are handed on.
TEXT_BYTES, KEYS = 1 << 21, 1 << 20
#: N-grams of the sets that a tile's block may hold on average; a block is sent once for each of its tiles.
BLOCK = 2_000_000
#: N-grams whose repeats are counted together, and repeats from which an n-gram is left out of the keys; such n-grams at most.
CHUNK, COMMON, MOST_COMMON = 2_000_000, 50, 1_000_000
#: Bytes of a tile's bitmaps, and of what is compared of them at a time.
BITMAP_BYTES, SLICE_BYTES = 64 << 20, 8 << 20
#: N-grams that a wave of tiles may be sent at least, however few all sets have.
WAVE = 8_000_000


class Bands:
    """Size bands for a threshold in per cent: band t holds sizes ``low[t]`` to ``low[t + 1] - 1``."""

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("the threshold is a percentage from 50 to 100")
        self.percent, self.low = percent, [1]

    def _reach(self, band: int) -> None:
        while len(self.low) < band + 2:
            self.low.append(max(self.low[-1] + 1, -(-self.low[-1] * 100 // self.percent)))

    def band(self, size: int) -> int:
        while self.low[-1] <= size:
            self._reach(len(self.low) - 1)
        return bisect.bisect_right(self.low, size) - 1

    @functools.cache
    def ranges(self, band: int) -> tuple[int, int]:
        """Ranges of the hash space for the band, and how many n-grams two similar sets may differ in."""
        self._reach(band)
        differ = 2 * (self.low[band + 1] - 1) * (100 - self.percent) // (100 + self.percent)
        if differ == 0:
            return 0, 0
        # A range without n-grams says nothing: as many more ranges as will hardly ever be empty.
        empty = (differ + 1) * math.exp(-self.low[band] * self.percent / 100 / (differ + 1))
        return differ + 1 + math.ceil(empty + 4 * math.sqrt(empty) + 1), differ

    def of(self, size: int) -> list[int]:
        """Bands in which a set of this size can be the smaller or the larger of a similar pair."""
        own = self.band(size)
        self._reach(own)
        return [own, own + 1] if size * 100 >= self.low[own + 1] * self.percent else [own]


def class_of(grams: np.ndarray) -> np.int64:
    """Hash of a set, for any order of its members."""
    total = mix(grams ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) + np.uint64(len(grams))
    return mix(np.array([total], np.uint64)).view(np.int64)[0]


def without(grams: np.ndarray, common: np.ndarray) -> np.ndarray:
    """A sorted set less the n-grams of another one."""
    if not len(common) or not len(grams):
        return grams
    return grams[common[np.minimum(np.searchsorted(common, grams), len(common) - 1)] != grams]


def range_keys(grams: np.ndarray, bands: Bands, common: np.ndarray = np.zeros(0, np.uint64)) -> np.ndarray:
    """Keys of a sorted set: one for each range of its bands that holds n-grams, those of ``common`` left out.

    Only a set with more empty ranges than a similar pair is sure to share gets keys for those too.
    """
    out, size = [], len(grams)
    grams = without(grams, common)
    content = np.concatenate([[np.uint64(0)], np.cumsum(mix(grams + np.uint64(0x2545F4914F6CDD1D)), dtype=np.uint64)])
    for band in bands.of(size):
        count, differ = bands.ranges(band)
        if not count:
            continue
        width = (1 << 64) // count
        borders = np.searchsorted(grams, np.arange(1, count, dtype=np.uint64) * np.uint64(width))
        place = np.concatenate([[0], borders, [len(grams)]])
        names = mix(np.arange(count, dtype=np.uint64) + np.uint64(band << 32))
        keys = mix((content[place[1:]] - content[place[:-1]]) ^ names)
        empty = place[1:] == place[:-1]
        out.append(keys if empty.sum() >= count - differ else keys[~empty])
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


SETS = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("cls", pa.int64()), ("gram", pa.int64()), ("times", pa.int64())])
KEY_BATCH = pa.schema([("part", pa.int64()), ("keys", pa.binary()), ("classes", pa.binary()), ("tied", pa.binary())])
SET_ROWS = "id bigint, n bigint, cls bigint, gram bigint, times bigint"


def _sets(words: int):
    """Rows of two kinds: each text's id, size and class; and n-grams that several different sets of a chunk share."""

    def repeated(sets) -> pa.RecordBatch:
        grams, times = np.unique(np.concatenate(list(sets)), return_counts=True)
        grams, times = grams[times > 1].view(np.int64), times[times > 1]
        none = [None] * len(grams)
        return batch(SETS, none, none, none, grams, times)

    def run(batches):
        chunk: dict[int, np.ndarray] = {}
        held = 0
        for b in batches:
            for begin, end in row_slices(b.column(1), TEXT_BYTES):
                sets = shingle_sets(b.column(1).slice(begin, end - begin), words)
                classes = [class_of(s) if len(s) else None for s in sets]
                none = [None] * len(sets)
                yield batch(SETS, b.column(0).slice(begin, end - begin), [len(s) for s in sets], classes, none, none)
                for c, s in zip(classes, sets):
                    if c is not None and int(c) not in chunk:
                        chunk[int(c)] = s
                        held += len(s)
                if held >= CHUNK:
                    yield repeated(chunk.values())
                    chunk, held = {}, 0
        if chunk:
            yield repeated(chunk.values())

    return run


def _common(counted: DataFrame):
    """Broadcast sorted n-grams that are repeated most. Whichever they are, no similar pair loses its key; the fewest
    repeats go up until they are few enough."""
    totals = counted.where("gram is not null").groupBy("gram").agg(F.sum("times").alias("times")).where(F.col("times") >= COMMON)
    grams = totals.orderBy(F.desc("times"), "gram").limit(MOST_COMMON).select("gram").toArrow().column(0).to_numpy()
    return counted.sparkSession.sparkContext.broadcast(np.sort(grams.view(np.uint64)))


def _tie(keys: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys with their smallest class, and (class, smallest class) for the other classes of a key."""
    if not len(keys):
        none = np.zeros(0, np.int64)
        return keys, none, none, none
    order = np.lexsort((classes, keys))
    keys, classes = keys[order], classes[order]
    first = np.append(True, keys[1:] != keys[:-1])
    heads = classes[np.flatnonzero(first)[np.cumsum(first) - 1]]
    other = classes != heads
    pairs = np.unique(np.stack([classes[other], heads[other]], 1), axis=0)
    return keys[first], classes[first], pairs[:, 0], pairs[:, 1]


def _key_batches(words: int, percent: int, parts: int, common):
    def flush(keys, classes):
        keys, classes, tied, heads = _tie(np.concatenate(keys), np.concatenate(classes))
        part = by_part(keys, parts)  # ascending, as the keys are
        ties = by_part(mix(tied.astype(np.uint64)), parts)
        for p in np.unique(np.concatenate([part, ties])):
            own = slice(*np.searchsorted(part, [p, p + np.uint64(1)]))
            here = ties == p
            tie = np.concatenate([tied[here], heads[here]])
            yield batch(KEY_BATCH, [int(p)], [keys[own].tobytes()], [classes[own].tobytes()], [tie.tobytes()])

    def run(batches):
        bands, keys, classes, held = Bands(percent), [], [], 0
        for b in batches:
            for begin, end in row_slices(b.column(0), TEXT_BYTES):
                for grams in shingle_sets(b.column(0).slice(begin, end - begin), words):
                    if len(grams):
                        own = range_keys(grams, bands, common.value)
                        keys.append(own)
                        classes.append(np.full(len(own), class_of(grams)))
                        held += len(own)
                if held >= KEYS:
                    yield from flush(keys, classes)
                    keys, classes, held = [], [], 0
        if held:
            yield from flush(keys, classes)

    return run


def _merge_keys(table: pa.Table) -> pa.Table:
    """Ties of one part of the key space."""
    keys = np.concatenate(longs(table["keys"]))
    _, _, tied, heads = _tie(keys, np.concatenate(longs(table["classes"], np.int64)))
    known = [x.reshape(2, -1) for x in longs(table["tied"], np.int64)]
    return pa.table({"a": np.concatenate([tied, *(x[0] for x in known)]), "b": np.concatenate([heads, *(x[1] for x in known)])})


def _with_class(text_col: str, words: int, column: str):
    def run(batches):
        for b in batches:
            for begin, end in row_slices(b.column(text_col), TEXT_BYTES):
                rows = b.slice(begin, end - begin)
                classes = [class_of(s) if len(s) else None for s in shingle_sets(rows.column(text_col), words)]
                names = [*rows.schema.names, column]
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(classes, pa.int64())], names=names)

    return run


GRAM_ROWS = pa.schema([("id", pa.int64()), ("cls", pa.int64()), ("grams", pa.binary())])


def _grams(words: int):
    """One row for each different set of a slice, with the id of the text it came from."""

    def run(batches):
        for b in batches:
            for begin, end in row_slices(b.column(1), TEXT_BYTES):
                seen: dict[tuple, bytes] = {}
                ids = b.column(0).slice(begin, end - begin).to_pylist()
                for i, grams in zip(ids, shingle_sets(b.column(1).slice(begin, end - begin), words)):
                    if len(grams):
                        seen.setdefault((i, int(class_of(grams))), grams.tobytes())
                yield batch(GRAM_ROWS, [k[0] for k in seen], [k[1] for k in seen], list(seen.values()))

    return run


def bitmaps(sets: list[np.ndarray]) -> np.ndarray:
    """One hashed bitmap per set, as rows of 64-bit words, wide enough that few bits of the largest set coincide."""
    bits = 1 << max(8, math.ceil(math.log2(4 * max(map(len, sets)))))
    # A bound from narrower ones is still a bound; many sets beside a few large ones must not fill the memory.
    bits = max(256, min(bits, 1 << 16, 1 << int(math.log2(8 * BITMAP_BYTES / len(sets)))))
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for row, grams in zip(out, sets):
        bit = grams & np.uint64(bits - 1)
        np.bitwise_or.at(row, (bit >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit & np.uint64(63)))
    return out


def tile_links(classes: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect whatever the tile's similar pairs connect: at most one per member.

    From each unvisited set, breadth first: the rest is bounded by bitmaps (bits that only one of the two has are
    n-grams that only one has), what passes is intersected, and what is similar leaves the rest.
    """
    order = np.argsort([len(s) for s in sets], kind="stable")
    classes, sets = classes[order], [sets[i] for i in order]
    sizes, marks, links = np.array([len(s) for s in sets]), bitmaps(sets), []
    rest = np.ones(len(sets), bool)
    for start in range(len(sets)):
        if not rest[start]:
            continue
        rest[start], queue = False, [start]
        while queue:
            x = queue.pop()
            low = int(np.searchsorted(sizes, -(-int(sizes[x]) * percent // 100)))
            high = int(np.searchsorted(sizes, int(sizes[x]) * 100 // percent, "right"))
            other = low + np.flatnonzero(rest[low:high])
            if not len(other):
                continue
            step = max(1, SLICE_BYTES // marks[0].nbytes)
            differ = np.concatenate([np.bitwise_count(marks[other[i : i + step]] ^ marks[x]).sum(1, dtype=np.int64) for i in range(0, len(other), step)])
            both = sizes[other] + sizes[x]
            other = other[200 * ((both - differ) // 2) >= percent * 2 * (both - (both - differ) // 2)]
            if not len(other):
                continue
            found = np.concatenate([sets[i] for i in other])
            place = np.minimum(np.searchsorted(sets[x], found), len(sets[x]) - 1)
            starts = np.concatenate([[0], np.cumsum(sizes[other])[:-1]])
            common = np.add.reduceat((sets[x][place] == found).astype(np.int64), starts)
            alike = other[100 * common >= percent * (sizes[other] + sizes[x] - common)]
            links += [(int(classes[x]), int(classes[i])) for i in alike]
            rest[alike] = False
            queue += alike.tolist()
    return links


def _tile(percent: int):
    def run(table: pa.Table) -> pa.Table:
        classes, first = np.unique(table["cls"].to_numpy(), return_index=True)
        links = tile_links(classes, longs(table["grams"].take(pa.array(first))), percent)
        return pa.table({"a": pa.array([x[0] for x in links], pa.int64()), "b": pa.array([x[1] for x in links], pa.int64())})

    return run


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """Tiles of the clusters: ``cls``, ``id`` of a text that has the set, ``tile``. Members: cluster, cls, n, id. Stored.

    What several steps read is stored too, else the plan would repeat it in each of them, with hundreds of stages that the
    driver plans and keeps track of at once.
    """
    # A little wider than the ratio of sizes, so that rounding never puts similar sizes two bands apart.
    width = math.log(100 / percent) * 1.001 if percent < 100 else 1e-9
    banded = members.withColumn("band", F.floor(F.log("n") / F.lit(width)).cast("long"))
    totals = banded.groupBy("cluster", "band").agg(F.sum("n").alias("own"))
    whole = totals.groupBy("cluster").agg(F.sum("own").alias("all"))
    blocks = (
        totals.join(whole, "cluster")
        .withColumn("small", F.col("all") <= 3 * BLOCK)
        .withColumn("blocks", F.when(F.col("small"), 1).otherwise(F.ceil(F.col("own") / BLOCK)))
    )
    blocks = stored(blocks, "blocks")
    small = blocks.where("small").select("cluster", "band")
    large = blocks.where("not small").select("cluster", "band", "blocks")
    one = large.select("cluster", "band", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    two = one.select(F.col("cluster"), F.col("band").alias("band2"), F.col("block").alias("block2"))
    beside = one.join(two.withColumn("band", F.col("band2") - 1), ["cluster", "band"])
    pairs = beside.union(one.join(two.withColumn("band", F.col("band2")), ["cluster", "band"]).where("block2 > block"))
    named = pairs.withColumn("tile", F.xxhash64("cluster", "band", "block", "band2", "block2"))
    place = lambda band, block: F.struct("cluster", F.col(band).alias("band"), F.col(block).alias("block"), "tile")
    ends = named.select(F.explode(F.array(place("band", "block"), place("band2", "block2"))).alias("end")).select("end.*")
    ends = paired = stored(ends.distinct(), "ends")
    # A tile compares each of its blocks with itself too; only a block without a partner needs a tile of its own.
    lone = one.join(ends, ["cluster", "band", "block"], "left_anti")
    ends = ends.union(lone.select("cluster", "band", "block", F.xxhash64("cluster", "band", "block").alias("tile")))
    of_small = banded.join(small, ["cluster", "band"]).select("cls", "id", F.xxhash64("cluster").alias("tile"))
    in_blocks = banded.join(large, ["cluster", "band"]).withColumn("block", F.pmod(F.xxhash64("cls"), F.col("blocks")))
    of_large = in_blocks.join(ends, ["cluster", "band", "block"]).select("cls", "id", "tile")
    tiles = stored(of_small.union(of_large), "tiles")
    discard(blocks, paired)
    return tiles


def _links(texts: DataFrame, members: DataFrame, words: int, percent: int) -> list[DataFrame]:
    """Links ``a, b`` found in all tiles, a stored table for each wave of tiles; its shuffle goes once they are stored."""
    tiles = _tiles(members, percent)
    sizes = members.select("cls", "n")
    own = members.agg(F.sum("n")).first()[0] or 0
    sent = tiles.join(small_side(sizes), "cls").agg(F.sum("n")).first()[0] or 0
    waves = max(1, math.ceil(sent / max(own, WAVE)))
    found = []
    for wave in range(waves):
        mine = tiles.where(F.pmod(F.xxhash64("tile"), F.lit(waves)) == wave) if waves > 1 else tiles
        owner = small_side(mine.withColumnsRenamed({"cls": "cls2", "id": "id2"}))
        grams = texts.where("text is not null").mapInArrow(_grams(words), "id bigint, cls bigint, grams binary")
        rows = grams.join(owner, (F.col("cls") == F.col("cls2")) & F.col("id").eqNullSafe(F.col("id2")))
        links = rows.select("tile", "cls", "grams").groupBy("tile").applyInArrow(_tile(percent), "a bigint, b bigint")
        found.append(stored(links, "tile-links"))
    discard(tiles)
    return found


def classes_and_components(docs: DataFrame, id_col: str, text_col: str, words: int = 5, percent: int = 80) -> DataFrame:
    """``id, n, cls`` of every row, and ``grp``: the class that names the row's component (its own if it has no links).

    Stored; the tables it was made of are removed.
    """
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    counted = stored(texts.mapInArrow(_sets(words), SET_ROWS), "sets")
    sets, common = counted.where("n is not null").select("id", "n", "cls"), _common(counted)
    parts = shuffle_parts(docs.sparkSession)
    keys = texts.select("text").where("text is not null").mapInArrow(
        _key_batches(words, percent, parts, common), "part bigint, keys binary, classes binary, tied binary"
    )
    ties = keys.groupBy("part").applyInArrow(_merge_keys, "a bigint, b bigint")
    clusters = stored(components(ties, "a", "b").withColumnRenamed("node", "cls"), "clusters")
    owners = sets.where("cls is not null").groupBy("cls", "n").agg(F.min("id").alias("id"))
    members = owners.join(clusters, "cls").withColumnRenamed("component", "cluster")
    members = stored(members, "members")
    links = _links(texts, members, words, percent)
    joined = stored(components(functools.reduce(DataFrame.union, links), "a", "b"), "components")
    named = joined.select(F.col("node").alias("cls"), F.col("component").alias("grp"))
    rows = sets.join(small_side(named), "cls", "left").select("id", "n", "cls", F.coalesce("grp", "cls").alias("grp"))
    rows = stored(rows, "grouped")
    discard(counted, clusters, members, joined, *links)
    return rows


def ngram_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """Links texts whose sets of ``words``-word n-grams have ``100 * intersection >= percent * union``.

    One row per input row: ``doc_id``, ``n_shingles``, ``component_id`` (smallest id reachable by links, the row's own
    included). A text with fewer words has its whole sequence as one n-gram; a null, empty or wordless text has none,
    links with nothing and keeps its own id. Repeated rows come back as often. Null ids never become a component's id
    unless all ids of the component are null. Only the two named columns are read. No rows: no rows.
    """
    rows = classes_and_components(docs, id_col, text_col, words, percent)
    least = rows.where("grp is not null").groupBy("grp").agg(F.min("id").alias("least"))
    linked = rows.join(least, "grp", "left")
    return linked.select(
        F.col("id").alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.when(F.col("grp").isNull(), F.col("id")).otherwise(F.col("least")).alias("component_id"),
    )


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, one for each component: the one with its smallest id (null last); all columns as they are.

    Rows without n-grams link with nothing and all stay. Where an id occurs once, a row is known by its id; only rows
    with repeated or null ids are told apart by their set as well.
    """
    rows = classes_and_components(docs, id_col, text_col, words, percent)
    best = F.min(F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("cls"))).alias("k")
    keepers = stored(rows.where("grp is not null").groupBy("grp").agg(best).select("k.id", "k.cls"), "keepers")
    repeated = stored(rows.groupBy("id").count().where("count > 1 or id is null").select("id"), "repeated")
    others = repeated.count()
    gone = rows.where("cls is not null").join(keepers, "cls", "left_anti").select("id").where("id is not null")
    copies = rows.join(keepers.withColumnRenamed("id", "kept"), "cls").where("id <> kept").select("id")
    gone = stored(gone.union(copies).distinct(), "gone").withColumnRenamed("id", free_name(docs, "gone"))
    own = docs[id_col]
    if not others:
        return docs.join(small_side(gone), own == gone[gone.columns[0]], "left_anti")
    again = repeated.withColumnRenamed("id", free_name(docs, "again"))
    held = own.eqNullSafe(again[again.columns[0]])
    once = docs.join(small_side(again, others), held, "left_anti").join(small_side(gone), own == gone[gone.columns[0]], "left_anti")
    name = free_name(docs, "cls")
    more = docs.join(small_side(again, others), held, "left_semi")
    more = more.mapInArrow(_with_class(text_col, words, name), T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))
    first = keepers.withColumnsRenamed({"id": "k_id", "cls": "k_cls"})
    named = more.where(F.col(name).isNotNull())
    named = named.join(first, (named[name] == first.k_cls) & named[id_col].eqNullSafe(first.k_id), "left_semi")
    empty = more.where(F.col(name).isNull())
    return once.unionByName(named.dropDuplicates([name]).drop(name)).unionByName(empty.drop(name))
