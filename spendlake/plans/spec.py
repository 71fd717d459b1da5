"""Table declarations: one ordered field list per table, everything else derived from it."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# Type a column has in the finished table, per kind.
TABLE_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "double": T.DoubleType(),
    "bigint": T.LongType(),
    "boolean": T.BooleanType(),
    "date": T.DateType(),
    "timestamp": T.TimestampType(),
    "json": T.StringType(),
    "variant": T.VariantType(),
}

# Type the field is read with from the JSON text. Scalars come in as text so the
# casts can be strict; VARIANT keeps what text would lose, namely whether a
# value was quoted (booleans) and the shape of nested values (json, variant).
INPUT_TYPES: dict[str, T.DataType] = {
    kind: T.VariantType() if kind in ("boolean", "json", "variant") else T.StringType() for kind in TABLE_TYPES
}

ACCOUNT = "ad_account_id"
INGESTED = "ingested_at"


@dataclass(frozen=True)
class FieldSpec:
    """One table column: the key it has in the JSON object, its column name and its kind."""

    api: str
    column: str
    kind: str

    def __post_init__(self) -> None:
        if self.kind not in TABLE_TYPES:
            raise ValueError(f"column {self.column}: unknown kind {self.kind!r}, expected one of {sorted(TABLE_TYPES)}")


@dataclass(frozen=True)
class TableSpec:
    """A table: its fields in column order, merge key, day the table is cut by, and report grain."""

    name: str
    fields: tuple[FieldSpec, ...]
    keys: tuple[str, ...]
    day_of: str
    level: str | None = None
    breakdowns: tuple[str, ...] = ()
    id_column: str = ACCOUNT

    def __post_init__(self) -> None:
        names = self.columns
        repeated = sorted({n for n in names if names.count(n) > 1})
        if repeated:
            raise ValueError(f"{self.name}: columns declared twice: {repeated}")
        unknown = [c for c in (*self.keys, self.day_of) if c not in names]
        if unknown:
            raise ValueError(f"{self.name}: key or day columns not declared: {unknown}")

    @classmethod
    def of(cls, name: str, fields, keys, day_of: str, **options) -> TableSpec:
        """Build from plain ``(api, column, kind)`` triples."""
        return cls(name, tuple(FieldSpec(*f) for f in fields), tuple(keys), day_of, **options)

    @property
    def columns(self) -> list[str]:
        return [self.id_column, *(f.column for f in self.fields), INGESTED]

    @property
    def schema(self) -> T.StructType:
        """Schema of the finished table."""
        out = T.StructType().add(self.id_column, T.StringType(), False)
        for f in self.fields:
            out = out.add(f.column, TABLE_TYPES[f.kind], True)
        return out.add(INGESTED, T.TimestampType(), False)

    @property
    def ddl(self) -> str:
        """Column list for CREATE TABLE."""
        return self.schema.toDDL()

    @property
    def input_schema(self) -> T.StructType:
        """Schema one JSON object is parsed with; keys that are not declared are never materialised."""
        out = T.StructType()
        for api in dict.fromkeys(f.api for f in self.fields):
            kinds = {f.kind for f in self.fields if f.api == api}
            if len({INPUT_TYPES[k] for k in kinds}) > 1:
                raise ValueError(f"{self.name}: field {api} is read with conflicting kinds {sorted(kinds)}")
            out = out.add(api, INPUT_TYPES[kinds.pop()], True)
        return out

    @property
    def requested_fields(self) -> list[str]:
        """Fields to ask the reporting service for; breakdown values arrive unasked."""
        return [f.api for f in self.fields if f.api not in self.breakdowns]

    def with_field(self, api: str, column: str, kind: str) -> TableSpec:
        """The same table with one more column before ``ingested_at``."""
        return replace(self, fields=(*self.fields, FieldSpec(api, column, kind)))

    def with_variants(self) -> TableSpec:
        """The same table with its JSON columns stored as VARIANT instead of text, so paths are read without a parse."""
        stored = (replace(f, kind="variant") if f.kind == "json" else f for f in self.fields)
        return replace(self, fields=tuple(stored))
