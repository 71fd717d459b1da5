"""Near-duplicate vectors by an epsilon grid order join.

Unit vectors of a label are put in the order of the cells of a grid of width epsilon on their leading principal
components, epsilon being the Euclidean distance that belongs to the least cosine. The sequence is cut into blocks; a
block knows the box its vectors span on those components. Intervals of the sequence are joined recursively: of two
intervals whose boxes are further apart than epsilon nothing can match, else their halves, quarters, ... are looked at,
down to pairs of blocks. Only vectors of such pairs meet, as matrices of doubles.

Equal vectors are one class first, so a vector that occurs any number of times is compared once. Counts of links are
exact; links themselves are kept only as far as components need them, less than one per vector and pair of blocks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import small_side, stored
from spendlake.llm.components import components

#: Principal components of the grid, classes of a block, and intervals an interval splits into at a level.
LEADING, BLOCK, FAN = 6, 1024, 8
#: Distance by which boxes have to be further apart than epsilon to be skipped: more than rounding can amount to.
MARGIN = 1e-6


def _unit(vectors: np.ndarray) -> np.ndarray:
    # The largest component is 1 first, so squares neither overflow nor vanish, whatever the scale of a vector.
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def _usable(x: list | None) -> bool:
    if not x or any(v is None for v in x):
        return False
    a = np.asarray(x, np.float64)
    return bool(np.isfinite(a).all() and (a != 0).any())


def _clean(batches):
    """Vectors as bytes of doubles with a hash as class; null where a vector can link with nothing."""
    from spendlake.llm.words import mix

    for b in batches:
        bodies, classes = [], []
        for x in b.column(2).to_pylist():
            if not _usable(x):
                bodies.append(None)
                classes.append(None)
                continue
            a = np.asarray(x, np.float64) + 0.0
            place = np.arange(len(a), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
            bodies.append(a.tobytes())
            classes.append(int(mix((mix(a.view(np.uint64) + place)).sum(keepdims=True, dtype=np.uint64)).view(np.int64)[0]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bodies, pa.binary()), pa.array(classes, pa.int64())], names=["vec_id", "label", "body", "cls"])


def _moments(batches):
    """Per length: count, sum and products of the unit vectors of a batch."""
    for b in batches:
        groups: dict[int, list] = {}
        for body in b.column(0).to_pylist():
            groups.setdefault(len(body) // 8, []).append(np.frombuffer(body))
        for dim, rows in groups.items():
            u = _unit(np.array(rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array([dim], pa.int64()), pa.array([len(u)], pa.int64()), pa.array([u.sum(0).tobytes()], pa.binary()), pa.array([(u.T @ u).tobytes()], pa.binary())],
                names=["dim", "n", "s", "q"],
            )


def _basis(table: pa.Table) -> pa.Table:
    """Leading principal components over all labels for vectors of one length."""
    dim, n = table["dim"][0].as_py(), sum(table["n"].to_pylist())
    mean = sum(np.frombuffer(x) for x in table["s"].to_pylist()) / n
    cov = sum(np.frombuffer(x).reshape(dim, dim) for x in table["q"].to_pylist()) / n - np.outer(mean, mean)
    _, axes = np.linalg.eigh(cov)
    return pa.table({"dim": pa.array([dim], pa.int64()), "axes": pa.array([np.ascontiguousarray(axes[:, ::-1][:, :LEADING].T).tobytes()], pa.binary())})


def _cells(epsilon: float):
    def run(batches):
        for b in batches:
            cells, places = [], []
            for body, axes in zip(b.column("body").to_pylist(), b.column("axes").to_pylist()):
                v = np.frombuffer(body)
                place = np.frombuffer(axes).reshape(-1, len(v)) @ _unit(v[None])[0]
                cells.append(np.floor(place / epsilon).astype(np.int64).tolist())
                places.append(place.tolist())
            kept = [c for c in b.schema.names if c != "axes"]
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in kept), pa.array(cells, pa.list_(pa.int64())), pa.array(places, pa.list_(pa.float64()))], names=[*kept, "cell", "place"]
            )

    return run


def _near(a: str, b: str, epsilon: float):
    """Boxes no further apart than epsilon: per component the gap between them, squared and summed."""
    expr = f"""aggregate(zip_with(zip_with({a}.low, {b}.high, (x, y) -> x - y), zip_with({b}.low, {a}.high, (x, y) -> x - y),
        (x, y) -> greatest(x, y, 0D)), 0D, (s, g) -> s + g * g)"""
    return F.expr(expr) <= (epsilon + MARGIN) ** 2


def block_pairs(blocks: DataFrame, epsilon: float) -> DataFrame:
    """Pairs ``label, dim, a, b`` (a <= b) of blocks that may hold a match. Blocks: ``label, dim, block, low, high``.

    From the coarsest intervals down, each a row with its box; a level joins only the children of pairs that were near.
    """
    most = blocks.agg(F.max("block")).first()[0]
    depth = 0
    while most is not None and most // FAN**depth >= FAN:
        depth += 1
    pairs = None
    for level in range(depth, -1, -1):
        own = blocks.withColumn("at", F.floor(F.col("block") / FAN**level))
        size = range(LEADING)
        ends = lambda f, c: F.array(*(f(F.get(c, F.lit(i))) for i in size))
        box = F.struct(ends(F.min, "low").alias("low"), ends(F.max, "high").alias("high")).alias("box")
        boxes = own.groupBy("label", "dim", "at").agg(box).withColumn("parent", F.floor(F.col("at") / FAN))
        left = boxes.select("label", "dim", F.col("at").alias("a"), F.col("parent").alias("pa"), F.col("box").alias("x"))
        right = boxes.select("label", "dim", F.col("at").alias("b"), F.col("parent").alias("pb"), F.col("box").alias("y"))
        if pairs is None:
            both = left.join(right, ["label", "dim"])
        else:
            up = pairs.select("label", "dim", F.col("a").alias("pa"), F.col("b").alias("pb"))
            both = up.join(left, ["label", "dim", "pa"]).join(right, ["label", "dim", "pb"])
        pairs = stored(both.where("a <= b").where(_near("x", "y", epsilon)).select("label", "dim", "a", "b"), "pairs")
    return pairs


def _join_blocks(cosine: float):
    def run(left: pa.Table) -> pa.Table:
        side = np.array(left["side"].to_pylist())
        classes, times = left["cls"].to_numpy(), left["times"].to_numpy()
        vectors = _unit(np.array([np.frombuffer(x) for x in left["body"].to_pylist()]))
        one, two = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        same = bool((side == 0).all())
        alike = vectors[one] @ vectors[two].T >= cosine
        if same:
            np.fill_diagonal(alike, False)
        counts = np.zeros(len(classes), np.int64)
        counts[one] += alike @ times[two]
        if not same:
            counts[two] += alike.T @ times[one]
        links = _spanning(alike, classes[one], classes[two], same)
        n = len(classes)
        return pa.table({
            "cls": np.concatenate([classes, links[:, 0]]),
            "other": pa.array(np.concatenate([np.zeros(n, np.int64), links[:, 1]]), mask=np.arange(n + len(links)) < n),
            "links": np.concatenate([counts, np.zeros(len(links), np.int64)]),
        })

    return run


def _spanning(alike: np.ndarray, left: np.ndarray, right: np.ndarray, same: bool) -> np.ndarray:
    """Links that connect what ``alike`` connects: a breadth-first forest over rows and columns."""
    rest = np.ones(len(right), bool)
    row_open, out = np.ones(len(left), bool), []
    for start in range(len(left)):
        if not row_open[start]:
            continue
        row_open[start], queue = False, [start]
        if same:
            rest[start] = False
        while queue:
            r = queue.pop()
            new = np.flatnonzero(alike[r] & rest)
            rest[new] = False
            out += [(left[r], right[c]) for c in new]
            if same:
                row_open[new] = False
                queue += new.tolist()
            else:
                for c in new:
                    rows = np.flatnonzero(alike[:, c] & row_open)
                    row_open[rows] = False
                    out += [(left[x], right[c]) for x in rows]
                    queue += rows.tolist()
    return np.array(out, np.int64).reshape(-1, 2)


def near_vectors(
    vectors: DataFrame, cosine: float = 0.93, key: str = "vec_id", column: str = "embedding", label: str = "label"
) -> DataFrame:
    """One row per input row: ``vec_id, n_links, component_id, kept``.

    Vectors with equal labels and a cosine of at least ``cosine`` (double precision) are linked. A null label, and a
    vector that is null, empty, zero, or holds a null or non-finite component links with nothing; so do vectors of
    different lengths. Repeated rows (the same id and vector) link with each other and all count. A component's id is
    its smallest id, nulls aside; a row without links keeps its own. Empty table: no rows. Other columns are not read.
    """
    if not 0 < cosine <= 1:
        raise ValueError("the cosine has to be above 0 and at most 1")
    epsilon = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("string").alias("label"), F.col(column).cast("array<double>").alias("v"))
    clean = stored(rows.mapInArrow(_clean, "vec_id bigint, label string, body binary, cls bigint"), "vectors")
    usable = clean.where("cls is not null and label is not null").withColumn("dim", (F.octet_length("body") / 8).cast("long"))
    # Equal vectors; the hash groups them, the bytes are carried along as one of them.
    classes = usable.groupBy("label", "dim", "cls").agg(F.count(F.lit(1)).alias("times"), F.min("vec_id").alias("least"), F.first("body").alias("body"))
    classes = stored(classes, "classes")
    moments = classes.select("body").mapInArrow(_moments, "dim bigint, n bigint, s binary, q binary")
    axes = moments.groupBy("dim").applyInArrow(_basis, "dim bigint, axes binary")
    axes = stored(axes, "axes")  # one row per length of vectors
    fields = "label string, dim bigint, cls bigint, times bigint, least bigint, body binary, cell array<bigint>, place array<double>"
    placed = classes.join(small_side(axes), "dim").select("label", "dim", "cls", "times", "least", "body", "axes").mapInArrow(_cells(epsilon), fields)
    # The sequence: ranges of it are sorted side by side, and numbered on from the rows of the ranges before.
    order = ["label", "dim", "cell", "cls"]
    ranges = placed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("rank", F.monotonically_increasing_id())
    ranges = stored(ranges, "sequence")
    per = ranges.groupBy("label", "dim", F.shiftright("rank", 33).alias("part")).agg(F.count(F.lit(1)).alias("n"), F.min("rank").alias("first"))
    before = Window.partitionBy("label", "dim").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    per = stored(per.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).select("label", "dim", "part", "base"), "ranges")
    numbered = ranges.withColumn("part", F.shiftright("rank", 33)).join(small_side(per), ["label", "dim", "part"])
    numbered = stored(numbered.withColumn("block", F.floor((F.col("rank") + F.col("base")) / BLOCK)).drop("rank", "base", "part", "cell"), "blocks")
    ends = lambda f: F.array(*(f(F.get("place", F.lit(i))) for i in range(LEADING)))
    fill = lambda c: F.transform(c, lambda x: F.coalesce(x, F.lit(0.0)))  # noqa: E731  vectors shorter than that
    boxes = numbered.groupBy("label", "dim", "block").agg(fill(ends(F.min)).alias("low"), fill(ends(F.max)).alias("high"))
    pairs = block_pairs(stored(boxes, "boxes"), epsilon)
    ones = pairs.where("a = b").select("label", "dim", F.col("a").alias("block"), F.lit(0).alias("side"), "a", "b")
    twos = pairs.where("a < b")
    twos = [twos.select("label", "dim", F.col(c).alias("block"), F.lit(s).alias("side"), "a", "b") for c, s in (("a", 1), ("b", 2))]
    sent = numbered.join(ones.union(twos[0]).union(twos[1]), ["label", "dim", "block"])
    sent = sent.select(F.xxhash64("label", "dim", "a", "b").alias("tile"), "side", "cls", "times", "body", F.xxhash64("label", "dim", "cls").alias("node"))
    sent = sent.drop("cls").withColumnRenamed("node", "cls")
    found = stored(sent.groupBy("tile").applyInArrow(_join_blocks(cosine), "cls bigint, other bigint, links bigint"), "found")
    named = stored(components(found.where("other is not null").select("cls", "other"), "cls", "other"), "components")
    counts = found.where("other is null").groupBy("cls").agg(F.sum("links").alias("links"))
    classes = classes.drop("body").withColumn("node", F.xxhash64("label", "dim", "cls"))
    grouped = classes.join(named, "node", "left").withColumn("grp", F.coalesce("component", "node"))
    least = grouped.groupBy("grp").agg(F.min("least").alias("component_id"))
    known = grouped.join(least, "grp").join(counts.withColumnRenamed("cls", "node"), "node", "left")
    known = known.select(F.col("label").alias("l2"), F.col("dim").alias("d2"), F.col("cls").alias("c2"), (F.col("times") - 1 + F.coalesce("links", F.lit(0))).alias("n"), "component_id")
    every = clean.withColumn("dim", (F.octet_length("body") / 8).cast("long"))
    same = (every["cls"] == F.col("c2")) & (every["label"] == F.col("l2")) & (every["dim"] == F.col("d2"))
    out = every.join(known, same, "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select(
        "vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept")
    )
