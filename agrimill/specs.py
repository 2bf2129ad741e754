"""Declared shape of a normalised table: types, keys, references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

# Geometry layouts used in every spec. Coordinates are longitude (x), latitude (y).
POINT = "struct<x:double,y:double>"
LINE = f"array<{POINT}>"
MULTILINE = f"array<{LINE}>"
POLYGON = f"array<array<{POINT}>>"
MULTIPOLYGON = f"array<{POLYGON}>"
LABEL = "map<string,string>"


@dataclass(frozen=True)
class TableSpec:
    """Table name, source it belongs to, Spark DDL and constraints.

    ``fks`` maps a column to the (table, column) it points at.
    """

    source: str
    name: str
    ddl: str
    pk: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    fks: dict[str, tuple[str, str]] = field(default_factory=dict)

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that may not be NULL: declared ones and the key."""
        return tuple(dict.fromkeys((*self.pk, *self.not_null)))

    def align(self, df: DataFrame) -> DataFrame:
        """Project onto the declared columns; missing ones become typed NULLs.

        Columns the spec does not know are an error, so that a misspelt name
        never silently turns into an empty column.
        """
        unknown = [c for c in df.columns if c not in self.schema.fieldNames()]
        if unknown:
            raise ValueError(f"{self.name}: columns not in the spec: {unknown}")
        have = {f.name: f.dataType for f in df.schema.fields}
        projected = []
        for f in self.schema.fields:
            if f.name not in have:
                projected.append(F.lit(None).cast(f.dataType).alias(f.name))
            elif have[f.name] == f.dataType:
                projected.append(F.col(f.name))
            else:
                projected.append(F.col(f.name).cast(f.dataType).alias(f.name))
        return df.select(*projected)
