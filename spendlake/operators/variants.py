"""JSON kept as VARIANT: values by their paths, and an audit of the keys that landed objects hold."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendlake.plans.spec import TableSpec


def at_paths(
    rows: DataFrame, keep: Sequence[str], paths: dict[str, tuple[str, str, str]], lenient: bool = False
) -> DataFrame:
    """The columns ``keep``, and per name the value of a VARIANT column at a path: ``(column, path, type)``.

    Spark hands path and type to the scan of a stored table. NULL where the column is NULL or has no such path; a
    value that is not of the type raises, or is NULL if ``lenient``.
    """
    get = F.try_variant_get if lenient else F.variant_get
    return rows.select(*keep, *(get(column, path, kind).alias(name) for name, (column, path, kind) in paths.items()))


def key_audit(items: DataFrame, spec: TableSpec, by: Sequence[str] = (), item: str = "item") -> DataFrame:
    """One row per key of the objects' first level: does the table declare it, how many objects have it, in what shape.

    ``items`` are unrolled pages with each object as JSON text, as ``scan_pages`` gives without a schema. Columns: those
    of ``by``, ``key``, ``declared``, ``objects``, ``nulls`` (objects where it is a JSON null) and ``shape``, the type
    that fits all its values, VARIANT where they have none in common. Declared keys that no object has are not listed.
    Entries that are not objects, and NULL entries, have no keys. Malformed text raises.
    """
    parsed = items.select(*by, F.parse_json(item).alias("object"))
    keys = parsed.lateralJoin(items.sparkSession.tvf.variant_explode(F.col("object").outer())).where("key IS NOT NULL")
    declared = F.col("key").isin(*dict.fromkeys(f.api for f in spec.fields))
    # A key may occur twice in one object's text; parsing keeps its last value, so objects are counted, not places.
    return keys.groupBy(*by, "key").agg(
        F.first(declared).alias("declared"),
        F.count("*").alias("objects"),
        F.count_if(F.is_variant_null("value")).alias("nulls"),
        F.schema_of_variant_agg("value").alias("shape"),
    )


def undeclared_keys(items: DataFrame, spec: TableSpec, by: Sequence[str] = (), item: str = "item") -> DataFrame:
    """The rows of ``key_audit`` that the table does not declare: what the service sends and the lake throws away."""
    return key_audit(items, spec, by, item).where("NOT declared").drop("declared")
