"""Reach that rolls up: sketches of people stored with the facts, merged to any coarser grain.

Distinct people cannot be summed, and counting them anew takes a second pass over delivery. A HyperLogLog sketch is a few
kilobytes at most, combines before the shuffle, and merged sketches have the registers of one over all rows, whatever the
order; estimates differ by less than their error, as a merged sketch cannot use the estimator of one fed in order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Sketches have 2 ** PRECISION registers; the relative standard error of an estimate is 1.04 / sqrt of that.
PRECISION = 13
SKETCH = "reach_sketch"


def relative_error(precision: int = PRECISION, deviations: float = 5.0) -> float:
    """How far an estimate may be off at so many standard deviations, as a share of the true count."""
    return deviations * 1.04 / (1 << precision) ** 0.5


def with_sketch(delivery: DataFrame, grain: tuple[str, ...], person: str = "person_id", precision: int = PRECISION) -> DataFrame:
    """A sketch of the people per grain, to be stored beside the sums. A null person is nobody; a grain without anybody has
    an empty sketch."""
    return delivery.groupBy(*grain).agg(F.hll_sketch_agg(person, F.lit(precision)).alias(SKETCH))


def merge_reach(facts: DataFrame, grain: tuple[str, ...], sketch: str = SKETCH) -> DataFrame:
    """Sketches of a coarser grain; facts without one (null) add nobody, a grain of such facts alone has a null sketch.

    No delivery row is read. All sketches have to be of one precision.
    """
    return facts.groupBy(*grain).agg(F.hll_union_agg(F.when(F.octet_length(sketch) > 0, F.col(sketch))).alias(sketch))


def reach_of(sketch: str = SKETCH):
    """Estimated people of a sketch; null for none."""
    return F.hll_sketch_estimate(sketch)
