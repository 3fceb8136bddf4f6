"""Schema-drift repair and null policy."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from veleta.functions.values import dirty_bigint, dirty_double
from veleta.schemas import RENAMES, SENTINEL_COLUMNS

# When files disagree on a column, the first of these types present wins;
# with none of them present the column becomes text.
PRIORITY = (T.StringType(), T.DoubleType(), T.LongType(), T.BooleanType())


def resolve_types(schemas: list[T.StructType]) -> dict[str, T.DataType]:
    """Target type of every column over a list of schemas (metadata only)."""
    seen: dict[str, list[T.DataType]] = {}
    for schema in schemas:
        for field in schema.fields:
            kinds = seen.setdefault(field.name, [])
            if field.dataType not in kinds:
                kinds.append(field.dataType)
    return {
        name: kinds[0] if len(kinds) == 1
        else next((t for t in PRIORITY if t in kinds), T.StringType())
        for name, kinds in seen.items()
    }


def to_target(c: Column, source: T.DataType, target: T.DataType) -> Column:
    """Cast a conflicting column; dirty numbers are cleaned, nulls become 0 or ''."""
    if source == target:
        return c
    if target == T.DoubleType():
        return dirty_double(c)
    if target == T.LongType():
        return dirty_bigint(c)
    text = F.to_json(c) if isinstance(source, (T.MapType, T.StructType, T.ArrayType)) else c
    return F.coalesce(text.try_cast(target), F.lit("").try_cast(target))


def harmonize(frames: list[DataFrame]) -> DataFrame:
    """Union frames whose schemas drift: one projection per frame, missing columns are null."""
    target = resolve_types([f.schema for f in frames])
    cast = [
        f.select(*[to_target(F.col(f"`{x.name}`"), x.dataType, target[x.name]).alias(x.name)
                   for x in f.schema.fields])
        for f in frames
    ]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)


def fill_nulls(df: DataFrame) -> DataFrame:
    """Untyped columns become text, numbers 0 and text ''; flags and nested columns stay."""
    def filled(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.NullType, T.StringType)):
            c = F.coalesce(c.cast("string"), F.lit(""))
        elif isinstance(field.dataType, (T.DoubleType, T.LongType)):
            c = F.coalesce(c, F.lit(0).cast(field.dataType))
        return c.alias(field.name)

    return df.select(*[filled(f) for f in df.schema.fields])


def fill_sentinel(df: DataFrame, columns=SENTINEL_COLUMNS, value: str = "NA") -> DataFrame:
    """Nulls of the named columns become a text marker; run it before ``fill_nulls``."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("string"), F.lit(value)) for c in columns if c in df.columns
    })


def rename_fields(df: DataFrame) -> DataFrame:
    """Bronze names to silver names, for the columns that exist."""
    return df.withColumnsRenamed({k: v for k, v in RENAMES.items() if k in df.columns})


def require(df: DataFrame, every: list[str], any_of: list[str] = ()) -> DataFrame:
    """Fail early when required columns are missing (schema check only)."""
    missing = [c for c in every if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if any_of and not set(any_of) & set(df.columns):
        raise ValueError(f"need at least one of {list(any_of)}")
    return df
