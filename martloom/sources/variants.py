"""Documents of open shape: which fields there are, and their values by path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, StructType, VariantType


@dataclass(frozen=True)
class Field:
    """A path into a VARIANT and the type that holds all its values; VARIANT where no
    other one does."""

    path: str
    kind: DataType


def _step(name: str) -> str | None:
    """One segment of a path; there is none for a name with both kinds of quotes."""
    if "'" not in name:
        return f"['{name}']"
    return f'["{name}"]' if '"' not in name else None


def _leaves(kind: StructType, path: str) -> list[Field]:
    out = []
    for field in kind.fields:
        step = _step(field.name)
        if step and isinstance(field.dataType, StructType):
            out += _leaves(field.dataType, path + step)
        elif step:
            out.append(Field(path + step, field.dataType))
    return out


def fields(df: DataFrame, col: str) -> list[Field]:
    """All fields of the documents in a VARIANT column, found in one pass.

    Types are merged map-side; one schema comes to the driver. Lists are fields as a whole.
    """
    text = df.agg(F.schema_of_variant_agg(col)).first()[0]
    if text is None or not text.startswith("OBJECT<"):
        return []
    return _leaves(StructType.fromDDL(text[len("OBJECT<"):-1].replace("OBJECT<", "STRUCT<")), "$")


def value(col: str, field: Field) -> Column:
    """The value at a path, null where it is missing or has another type. Fields of mixed
    types come as text."""
    kind = "string" if isinstance(field.kind, VariantType) or field.kind.typeName() == "void" else field.kind.simpleString()
    return F.try_variant_get(F.col(col), field.path, kind)


def kinds(df: DataFrame, col: str, found: list[Field]) -> DataFrame:
    """(path, kind, docs): how many documents have which type at each path; missing ones
    are not counted, and a null is of type VOID."""
    at = [F.struct(F.lit(f.path).alias("path"), F.schema_of_variant(F.try_variant_get(F.col(col), f.path, "variant")).alias("kind"))
          for f in found]
    entries = F.array(*at) if at else F.expr("CAST(array() AS array<struct<path:string,kind:string>>)")
    return (df.select(F.explode(entries).alias("e")).filter("e.kind IS NOT NULL")
            .groupBy("e.path", "e.kind").agg(F.count(F.lit(1)).alias("docs")))
