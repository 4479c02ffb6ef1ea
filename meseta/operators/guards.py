"""Schema guards; they look at the plan's schema only and never start a job."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import types as T


def _resolve(schema: T.DataType, path: str) -> T.DataType | None:
    """Type below a dotted path; arrays are entered through their element."""
    current = schema
    for step in path.split("."):
        if isinstance(current, T.ArrayType):
            current = current.elementType
        if not isinstance(current, T.StructType) or step not in current.fieldNames():
            return None
        current = current[step].dataType
    return current


def require_fields(df: DataFrame, paths: Iterable[str], what: str = "input") -> DataFrame:
    """Raise ``ValueError`` naming every dotted path the frame does not have."""
    missing = [path for path in paths if _resolve(df.schema, path) is None]
    if missing:
        raise ValueError(f"Missing required fields in {what}: {missing}")
    return df


def require_struct(df: DataFrame, column: str, fields: Iterable[str], what: str = "input") -> DataFrame:
    """Raise unless ``column`` is a struct that holds every named field."""
    kind = _resolve(df.schema, column)
    if not isinstance(kind, T.StructType):
        raise ValueError(f"{what}: {column} must be a struct, found {kind}")
    return require_fields(df, [f"{column}.{field}" for field in fields], what)


def has_struct_elements(df: DataFrame, path: str) -> bool:
    kind = _resolve(df.schema, path)
    return isinstance(kind, T.ArrayType) and isinstance(kind.elementType, T.StructType)


def same_columns(built: DataFrame, stored: DataFrame) -> bool:
    """Column names and order agree."""
    return built.columns == stored.columns
