"""Small helpers for schemas."""

from pyspark.sql import types as T


def plus(schema: T.StructType, **fields: str) -> T.StructType:
    """A new schema with further nullable fields; ``schema`` isn't changed (a DataFrame's own is shared)."""
    more = [T.StructField(n, T.StructType.fromDDL(f"x {kind}")[0].dataType) for n, kind in fields.items()]
    return T.StructType([*schema.fields, *more])
