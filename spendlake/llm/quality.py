"""Quality rules: statistics of whole texts, and robust outliers of their transformed vectors. DataFrame functions only.

The statistics of a text are computed in its row with array functions. Their transformed vectors are compared within a
language and source, or one of few rows blended with its language. The minimum covariance determinant estimate of a group
is searched from three deterministic starts (medians and quartile ranges; mean and covariance of all rows; covariance of
the vectors bent by tanh, which pulls far rows in). Concentration steps (keep the half of the rows nearest in Mahalanobis
distance; mean and covariance of that half) go on from each until its determinant falls no further, and the least of the
determinants wins. Rows beyond a cutoff are rejected. A step is one scan of the vectors of groups still falling: distances
are ranked by a histogram whose bins also carry the sums for mean and covariance, so a hot group is combined before it is
shuffled and never gathered. Vectors are whole multiples of a step, so sums are exact and reruns agree.
"""

from __future__ import annotations

from itertools import combinations_with_replacement

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendlake.llm.common import discard, small_side, stored

SPACE = r"\x20\x09-\x0D"
#: The step coordinates are rounded to, and the least standard deviation assumed of each, in steps: about a third of what
#: one sign, line or window more makes in a text of 50 words, and the spread of such a text's mean word length.
STEP, FLOORS = 1e-4, (600, 1000, 400, 300)
#: Rows from which a language and source is judged by its own estimate alone, five a dimension. With n fewer, its own
#: counts n parts and the language's the rest (that of a small language likewise blended with all rows'), so no verdict
#: hangs on one row more or less. What is missing of all rows below that number is made up by a model that knows
#: nothing: standard deviations of WIDE floors.
FULL_ROWS, WIDE = 20, 10
#: Median and 0.9999 quantile of chi square with four degrees of freedom. Distances are scaled to the median; the margin
#: for heavier tails than normal is twice the quantile's distance. In floors that is 9.7, within the range of each
#: coordinate: 0.58 of mean word length's logarithm, 0.97 of signs', 0.39 of duplicate lines, 0.29 of repeated words.
CHI_MEDIAN, CHI_HIGH, MARGIN = 3.35669, 23.5127, 2.0
CUTOFF = CHI_HIGH * MARGIN**2
BINS_PER_UNIT = 32
#: A determinant counts as fallen if its logarithm fell by more than this, so the steps end: a group has finitely many halves.
FALL = 1e-9
#: Scale of the values bent by tanh, rounded to whole numbers.
BENT = 10_000
P = len(FLOORS)
PAIRS = list(combinations_with_replacement(range(P), 2))

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
VECTOR = tuple(f"v{i}" for i in range(P))


def text_stats(docs: DataFrame, text: Column, keep: list[Column]) -> DataFrame:
    """``keep``, the five statistics, ``base_failed`` and the vector ``v0..v3`` of every row; a null text is an empty one."""
    names = [docs.select(c).columns[0] for c in keep]
    own = [F.col(f"`{c}`") for c in names]
    rows = docs.select(*keep, F.coalesce(text, F.lit("")).alias("body"))
    rows = rows.select(
        *own,
        F.filter(F.split("body", f"[{SPACE}]+"), lambda x: x != "").alias("words"),
        F.length(F.regexp_replace("body", f"[{SPACE}]+", "")).cast("long").alias("word_chars"),
        F.regexp_count("body", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.filter(F.split("body", "\n"), lambda x: x.rlike(f"[^{SPACE}]")).alias("lines"),
    )
    # The hash of each window above its place, in one number: sorted, equal windows are neighbours.
    rows = rows.select(
        *own, "words", "word_chars", "n_symbols", F.size("words").cast("long").alias("n_words"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.when(F.size("words") < (1 << 20), 20).otherwise(31).alias("bits"),
    )
    window = """array_sort(transform(slice(words, 1, greatest(size(words) - 2, 0)), (w, i) ->
        shiftleft(shiftright(xxhash64(w, get(words, i + 1), get(words, i + 2)), bits), bits) + i))"""
    rows = rows.withColumn("hashed", F.expr(window))
    # Places whose hash has an equal neighbour; then the same by the words themselves, as hashes may coincide.
    alike = """transform(filter(hashed, (x, j) -> shiftright(x, bits) = shiftright(get(hashed, j - 1), bits)
            OR shiftright(x, bits) = shiftright(get(hashed, j + 1), bits)),
        x -> cast(x - shiftleft(shiftright(x, bits), bits) as int))"""
    rows = rows.withColumn("maybe", F.expr(alike)).drop("hashed")
    spelled = "array_sort(transform(maybe, i -> struct(concat_ws(' ', words[i], words[i + 1], words[i + 2]) AS k, i AS i)))"
    rows = rows.withColumn("spelled", F.expr(spelled)).drop("maybe", "words")
    places = "array_sort(transform(filter(spelled, (x, j) -> x.k = get(spelled, j - 1).k OR x.k = get(spelled, j + 1).k), x -> x.i))"
    rows = rows.withColumn("places", F.expr(places)).drop("spelled")
    covered = "aggregate(transform(places, (p, j) -> least(3, coalesce(get(places, j + 1) - p, 3))), 0L, (s, x) -> s + x)"
    rows = rows.withColumn("n_repeat_words", F.expr(covered)).drop("places")
    n, chars = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    vector = (
        F.log(chars / n),
        F.log1p(100 * F.col("n_symbols") / chars),
        F.col("n_dup_lines") / F.greatest("n_lines", F.lit(1)),
        F.col("n_repeat_words") / n,
    )
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    coordinates = (F.round(x / STEP).cast("long").alias(v) for x, v in zip(vector, VECTOR, strict=True))
    return rows.select(*own, *STATS, failed.alias("base_failed"), *coordinates)


def _level(n: int, *columns: str) -> Column:
    return F.to_json(F.struct(F.lit(n).alias("level"), *columns))


def _grouped(rows: DataFrame) -> DataFrame:
    """Languages and sources, the groups whose estimates make up their model, and the parts that the first two have."""
    counts = rows.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    of_lang = F.sum("n").over(Window.partitionBy("lang"))
    part = lambda n: F.least(F.lit(1.0), n / FULL_ROWS)
    groups = counts.select("lang", "source", part(F.col("n")).alias("own"), part(of_lang).alias("of_lang"))
    return groups.select(
        F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "own", "of_lang", _level(2, "lang", "source").alias("g"),
        F.when(F.col("own") < 1, _level(1, "lang")).alias("g1"), F.when((F.col("own") < 1) & (F.col("of_lang") < 1), _level(0)).alias("g0"),
    )


def _of_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    same = rows["lang"].eqNullSafe(groups["g_lang"]) & rows["source"].eqNullSafe(groups["g_source"])
    return rows.join(small_side(groups.select("g_lang", "g_source", "g")), same, "left").drop("g_lang", "g_source")


def _blended(groups: DataFrame, model: DataFrame) -> DataFrame:
    """Model of each language and source: its own estimate, and with few rows its language's and that of all rows."""
    parts = {"g": F.col("own"), "g1": (1 - F.col("own")) * F.col("of_lang"), "g0": (1 - F.col("own")) * (1 - F.col("of_lang"))}
    numbers = [c for c in model.columns if c != "g"]
    out = groups.withColumns({f"{g}_part": p for g, p in parts.items()})
    for g in parts:
        own = model.select(F.col("g").alias("of"), *(F.col(c).alias(f"{g}_{c}") for c in numbers))
        out = out.join(small_side(own), F.col(g) == F.col("of"), "left").drop("of")
    mixed = (sum((F.coalesce(F.col(f"{g}_part") * F.col(f"{g}_{c}"), F.lit(0.0)) for g in parts), F.lit(0.0)).alias(c) for c in numbers)
    return out.select("g", *mixed)


def _moments(n: Column, total, product, i: int, j: int | None = None) -> Column:
    """Mean of a coordinate, or covariance of two, from a count and sums."""
    mean = lambda k: total(k) / n
    return mean(i) if j is None else product(i, j) / n - mean(i) * mean(j)


def _wide(c: Column) -> Column:
    return F.sum(c.cast("decimal(20,0)"))


def _starts(rows: DataFrame) -> DataFrame:
    """Three models of each group to start from, numbered ``s``."""
    each = rows.select("g", F.posexplode(F.array(*VECTOR)).alias("i", "v"))
    bins = each.groupBy("g", "i", F.floor(F.col("v") / 10).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    upto, whole = Window.partitionBy("g", "i").orderBy("bin"), Window.partitionBy("g", "i")
    bins = bins.withColumn("upto", F.sum("n").over(upto)).withColumn("all", F.sum("n").over(whole))
    at = lambda q: F.min(F.when(F.col("upto") >= F.col("all") * q, F.col("bin"))) * 10 + 5
    marks = bins.groupBy("g", "i").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) * 0.7413).alias("sd"))
    pick = lambda c, i: F.max(F.when(F.col("i") == i, F.col(c))).cast("double").alias(f"{c}{i}")
    marks = stored(marks.groupBy("g").agg(*(pick(c, i) for c in ("mid", "sd") for i in range(P))), "marks")
    unit = [F.greatest(F.col(f"sd{i}"), F.lit(float(floor))) for i, floor in enumerate(FLOORS)]
    bent = (F.round(BENT * F.tanh((F.col(f"v{i}") - F.col(f"mid{i}")) / unit[i])).cast("long").alias(f"t{i}") for i in range(P))
    near = rows.join(small_side(marks), "g").select("g", *VECTOR, *bent)
    sums = near.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"),
        *(_wide(F.col(f"{c}{i}")).cast("double").alias(f"s{c}{i}") for c in "vt" for i in range(P)),
        *(_wide(F.col(f"{c}{i}") * F.col(f"{c}{j}")).cast("double").alias(f"q{c}{i}{j}") for c in "vt" for i, j in PAIRS),
    )
    moment = lambda c, *at: _moments(F.col("n"), lambda i: F.col(f"s{c}{i}"), lambda i, j: F.col(f"q{c}{i}{j}"), *at)

    def model(number: int, mean, covariance) -> Column:
        means, pairs = (mean(i).alias(f"m{i}") for i in range(P)), (covariance(i, j).alias(f"c{i}{j}") for i, j in PAIRS)
        return F.struct(F.lit(number).alias("s"), *means, *pairs)

    middle = lambda i: F.col(f"mid{i}")
    models = F.array(
        model(0, middle, lambda i, j: F.col(f"sd{i}") * F.col(f"sd{i}") if i == j else F.lit(0.0)),
        model(1, lambda i: moment("v", i), lambda i, j: moment("v", i, j)),
        model(2, middle, lambda i, j: moment("t", i, j) * unit[i] * unit[j] / float(BENT * BENT)),
    )
    return marks.join(sums, "g").select("g", F.explode(models).alias("model")).select("g", "model.*")


def _factored(model: DataFrame) -> DataFrame:
    """Mean and covariance turned into mean and the lower triangle of the covariance's square root, floors included.

    ``logdet`` is the logarithm of that covariance's determinant; columns that are named ``new_...`` stay as they are.
    """
    for i, floor in enumerate(FLOORS):
        model = model.withColumn(f"c{i}{i}", F.col(f"c{i}{i}") + float(floor * floor))
    for j in range(P):
        inner = sum((F.col(f"l{j}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
        # Not below the floor's own share: the covariance is positive definite, but rounding may say otherwise.
        model = model.withColumn(f"l{j}{j}", F.sqrt(F.greatest(F.col(f"c{j}{j}") - inner, F.lit(float(FLOORS[j] ** 2) / 4))))
        for i in range(j + 1, P):
            inner = sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            model = model.withColumn(f"l{i}{j}", (F.col(f"c{j}{i}") - inner) / F.col(f"l{j}{j}"))
    logdet = 2 * sum((F.log(F.col(f"l{j}{j}")) for j in range(1, P)), F.log(F.col("l00")))
    kept = [c for c in model.columns if c in ("g", "s", "scale") or c.startswith("new_")]
    return model.select(*kept, *(f"m{i}" for i in range(P)), *(f"l{j}{i}" for i, j in PAIRS), logdet.alias("logdet"))


def _distance() -> Column:
    """Squared Mahalanobis distance of a row joined with its group's model."""
    solved: list[Column] = []
    for i in range(P):
        rest = F.col(f"v{i}") - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * solved[k]
        solved.append(rest / F.col(f"l{i}{i}"))
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _concentrate(rows: DataFrame, model: DataFrame, models: int | None = None) -> DataFrame:
    """Per group and start: mean and covariance of the nearer half, and the scale that brings the median distance to chi square's.

    ``models``: how many there are, if they are counted already.
    """
    near = rows.join(small_side(model, models), "g")
    d2 = F.greatest(_distance(), F.lit(1e-6))
    near = near.select("g", "s", *VECTOR, F.floor(F.log(d2) * BINS_PER_UNIT).alias("bin"))
    bins = near.groupBy("g", "s", "bin").agg(
        F.count(F.lit(1)).alias("n"),
        *(_wide(F.col(v)).alias(f"s{i}") for i, v in enumerate(VECTOR)),
        *(_wide(F.col(VECTOR[i]) * F.col(VECTOR[j])).alias(f"q{i}{j}") for i, j in PAIRS),
    )
    upto = Window.partitionBy("g", "s").orderBy("bin")
    sums = ["n", *(f"s{i}" for i in range(P)), *(f"q{i}{j}" for i, j in PAIRS)]
    bins = bins.select(
        "g", "s", "bin", F.sum("n").over(Window.partitionBy("g", "s")).alias("all"),
        *(F.sum(c).over(upto).cast("double" if c != "n" else "long").alias(c) for c in sums),
    )
    half = bins.where(2 * F.col("n") >= F.col("all")).groupBy("g", "s").agg(F.min_by(F.struct("bin", *sums), "bin").alias("h"))
    half = half.select("g", "s", "h.*")
    moment = lambda *at: _moments(F.col("n"), lambda i: F.col(f"s{i}"), lambda i, j: F.col(f"q{i}{j}"), *at)
    return half.select(
        "g", "s",
        *(moment(i).alias(f"m{i}") for i in range(P)),
        *(moment(i, j).alias(f"c{i}{j}") for i, j in PAIRS),
        F.greatest(F.lit(1.0), F.exp((F.col("bin") + 1) / BINS_PER_UNIT) / CHI_MEDIAN).alias("scale"),
    )


def least_determinants(rows: DataFrame) -> DataFrame:
    """The model of least determinant of each group ``g``, stored: mean, covariance, scale, and ``logdet``. Rows: ``g`` and the vector."""
    numbers = [*(f"m{i}" for i in range(P)), *(f"c{i}{j}" for i, j in PAIRS)]
    # A start is no half's covariance, so whatever the first step gives is taken.
    state = stored(_starts(rows).select("g", "s", *numbers, F.lit(float("inf")).alias("logdet"), F.lit(True).alias("falls")), "model")
    while falling := state.where("falls").count():
        step = _concentrate(rows, _factored(state.where("falls")), falling)
        step = _factored(step.withColumns({f"new_{c}": F.col(c) for c in numbers})).withColumnRenamed("logdet", "new_logdet")
        step = step.select("g", "s", "new_logdet", *(f"new_{c}" for c in numbers))
        falls = F.coalesce(F.col("new_logdet") < F.col("logdet") - FALL, F.lit(False))
        # A step that does not fall is thrown away, with it the start is done.
        pick = [F.when(falls, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in (*numbers, "logdet")]
        last, state = state, stored(state.join(step, ["g", "s"], "left").select("g", "s", *pick, falls.alias("falls")), "model")
        discard(last)
    best = state.groupBy("g").agg(F.min_by(F.struct("s", *numbers, "logdet"), F.struct("logdet", "s")).alias("best")).select("g", "best.*")
    # The scale is that of the distances under the final model.
    scale = _concentrate(rows, _factored(best)).select("g", "scale")
    return stored(best.drop("s").join(scale, "g"), "model")


def robust_models(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Groups of (language, source) and the models of the groups. Rows: ``lang, source`` and the vector."""
    groups = stored(_grouped(rows), "groups")
    # A row counts in every group it belongs to that judges some language and source.
    every = F.explode(F.array(_level(2, "lang", "source"), _level(1, "lang"), _level(0))).alias("g")
    used = groups.select(F.explode(F.array("g", "g1", "g0")).alias("g")).where("g is not null").distinct()
    of_all = min(1.0, rows.count() / FULL_ROWS)
    model = least_determinants(rows.select(every, *VECTOR).join(small_side(used), "g", "left_semi")).drop("logdet")
    if of_all < 1:
        # Few rows in all: what is missing comes from the model that knows nothing, centred where the rows are.
        nothing = {f"c{i}{j}": float((WIDE * FLOORS[i]) ** 2) if i == j else 0.0 for i, j in PAIRS} | {"scale": 1.0}
        of_none = {c: F.col(c) * of_all + (1 - of_all) * x for c, x in nothing.items()}
        whole = F.col("g") == _level(0)
        model = model.withColumns({c: F.when(whole, mixed).otherwise(F.col(c)) for c, mixed in of_none.items()})
    return groups, stored(_factored(_blended(groups, model)), "model")


def with_verdict(rows: DataFrame, groups: DataFrame, models: DataFrame) -> DataFrame:
    """``rows`` with ``distance`` (null if the base rule failed) and ``kept``."""
    judged = _of_group(rows, groups).join(small_side(models), "g", "left")
    distance = F.when(~F.col("base_failed"), _distance() / F.col("scale"))
    kept = ~F.col("base_failed") & F.coalesce(distance <= CUTOFF, F.lit(True))
    return judged.select(*(F.col(f"`{c}`") for c in rows.columns), distance.alias("distance"), kept.alias("kept"))


def quality_report(docs: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """One row per input row: ``doc_id``, the statistics, ``base_failed``, ``distance``, ``kept``.

    Null or empty text: all statistics 0, so the base rule fails. Models are estimated from rows that pass it. A null
    language or source is a value of its own. Repeated rows count as often as they occur; equal vectors get equal
    verdicts. Empty table: no rows. Columns other than the four named are not read.
    """
    keep = [F.col(key).alias("doc_id"), F.col(lang).alias("lang"), F.col(source).alias("source")]
    rows = stored(text_stats(docs, F.col(text), keep), "stats")
    judged = with_verdict(rows, *robust_models(rows.where("not base_failed")))
    return judged.select("doc_id", *STATS, "base_failed", "distance", "kept")


def keep_good(docs: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are. Verdicts need no key: rows are judged in place.

    Rows are stored with their statistics first, so a filter on the verdict cannot be pushed below them, which would
    compute every statistic again for each time the filter names it.
    """
    keep = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"), F.col(lang).alias("lang"), F.col(source).alias("source")]
    rows = stored(text_stats(docs, F.col(text), keep), "judged")
    slim = rows.where("not base_failed").select("lang", "source", *VECTOR)
    return with_verdict(rows, *robust_models(slim)).where("kept").select("doc.*")
