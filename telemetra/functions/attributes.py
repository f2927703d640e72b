"""Attribute-level Column functions: typed items, null removal, flattening, tagging.

A *typed item* is a row stored as ``attribute -> {tag: text}`` with exactly
one of the tags ``S`` (string), ``N`` (number as decimal text) or ``BOOL``.
Everything here is a Column expression (JVM-side, whole-stage codegen where
Spark supports it); nothing calls back into Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
)

TAG_STRING, TAG_NUMBER, TAG_BOOL = "S", "N", "BOOL"
TYPED_VALUE = "struct<S:string,N:string,BOOL:boolean>"
ITEM_TYPE = f"map<string,{TYPED_VALUE}>"

_NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


def _typed_value(c: Column, dtype: DataType) -> Column:
    """One column value as a typed attribute struct (NULL when the value is NULL)."""
    null_s = F.lit(None).cast("string")
    null_b = F.lit(None).cast("boolean")
    if isinstance(dtype, BooleanType):
        s = F.struct(null_s.alias("S"), null_s.alias("N"), c.alias("BOOL"))
    elif isinstance(dtype, _NUMERIC):
        s = F.struct(null_s.alias("S"), c.cast("string").alias("N"), null_b.alias("BOOL"))
    else:
        s = F.struct(c.cast("string").alias("S"), null_s.alias("N"), null_b.alias("BOOL"))
    return F.when(c.isNotNull(), s)


def to_item(df: DataFrame, attributes: Sequence[str] | None = None) -> Column:
    """Row -> typed item map; NULL attributes are absent from the item."""
    names = list(attributes) if attributes is not None else df.columns
    fields = {f.name: f.dataType for f in df.schema.fields}
    pairs: list[Column] = []
    for n in names:
        pairs += [F.lit(n), _typed_value(F.col(n), fields[n])]
    return drop_null_attrs(F.create_map(*pairs))


def unwrap_item(item: Column) -> Column:
    """S3: ``{'temperature': {'N': '21.5'}}`` -> ``{'temperature': '21.5'}``.

    The one set tag of each attribute gives its value as text.
    """
    return F.transform_values(
        item, lambda _k, v: F.coalesce(v["S"], v["N"], v["BOOL"].cast("string"))
    )


def unwrap_attribute(item: Column, name: str) -> Column:
    """S3 for one attribute: its text whatever its tag (NULL when absent).

    Three map lookups, no lambda: stays inside whole-stage codegen.
    """
    v = item[name]
    return F.coalesce(v["S"], v["N"], v["BOOL"].cast("string"))


def drop_null_attrs(attrs: Column) -> Column:
    """Remove attributes whose value is NULL."""
    return F.map_filter(attrs, lambda _k, v: v.isNotNull())


def flatten_attrs(attrs: Column, known: Iterable[str], dtype: str = "double") -> list[Column]:
    """P5: known attributes become top-level typed columns, the rest stays in ``extras``.

    Unknown attributes are not turned into new columns (that would change the
    schema per batch); they are kept as a ``map<string,string>``, and so is a
    known attribute whose value does not cast.
    """
    known = list(known)
    cols = [attrs[k].try_cast(dtype).alias(k) for k in known]
    keep = F.array(*[F.lit(k) for k in known])
    extras = F.map_filter(attrs, lambda k, v: ~F.array_contains(keep, k) | (v.isNotNull() & v.try_cast(dtype).isNull()))
    return cols + [extras.alias("extras")]


def long_attrs(df: DataFrame, id_cols: Sequence[str], attrs: Column) -> DataFrame:
    """Long form of a map column: one row per (ids, attribute, value)."""
    return df.select(*id_cols, F.explode(attrs).alias("attribute", "value"))


def object_fields(df: DataFrame, id_cols: Sequence[str], variant: Column) -> DataFrame:
    """(ids, attribute, v): one row per field of a JSON object held as VARIANT.

    Uses Spark's ``variant_explode`` generator (whole-stage codegen, no
    intermediate map).  Arrays, scalars and NULL produce no rows.
    """
    base = df.select(*id_cols, variant.alias("__j"))
    fields = base.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("__j").outer()))
    return fields.where(F.col("key").isNotNull()).select(
        *id_cols, F.col("key").alias("attribute"), F.col("value").alias("v")
    )


def tag_of_type(t: Column) -> Column:
    """The tag of a value by its type as ``schema_of_variant`` names it; NULL for JSON null."""
    return (
        F.when(t == "VOID", F.lit(None).cast("string"))
        .when(t == "BOOLEAN", F.lit(TAG_BOOL))
        .when(
            t.isin("BIGINT", "INT", "SMALLINT", "TINYINT", "DOUBLE", "FLOAT") | t.startswith("DECIMAL"),
            F.lit(TAG_NUMBER),
        )
        .otherwise(F.lit(TAG_STRING))
    )


def tag_of_variant(v: Column) -> Column:
    """The type tag of a JSON value, as the stream consumer assigns it.

    ``BOOL`` for booleans (tested first: a boolean is not a number), ``N`` for
    integers, decimals and floats, ``S`` for everything else (strings, nested
    objects and arrays, which are stringified).  JSON null gives NULL: such
    attributes are dropped.
    """
    return tag_of_type(F.schema_of_variant(v))


def _text_of_type(v: Column, t: Column) -> Column:
    fractional = t.startswith("DECIMAL") | t.isin("DOUBLE", "FLOAT")
    return F.when(fractional, F.try_variant_get(v, "$", "double").cast("string")).otherwise(v.cast("string"))


def stringify_variant(v: Column) -> Column:
    """Text of a JSON value, like ``str()`` of the parsed value.

    Integers print as integers; fractional numbers print as a float does
    (``28.0`` keeps its ``.0`` — VARIANT stores it as a decimal and would
    print ``28``); strings print bare; nested objects and arrays as JSON.
    """
    return _text_of_type(v, F.schema_of_variant(v))


def typed_attrs(values: Column) -> Column:
    """P6 + P7: a map of JSON values as a typed item; JSON nulls must be gone.

    Three steps, each over the result of the one before, so that the type, the
    tag and the text of a value are computed once.
    """
    typed = F.transform_values(values, lambda _k, v: F.struct(v.alias("v"), F.schema_of_variant(v).alias("t")))
    tagged = F.transform_values(typed, lambda _k, x: F.struct(tag_of_type(x["t"]).alias("tag"), _text_of_type(x["v"], x["t"]).alias("text")))
    tag_is = lambda x, tag: F.when(x["tag"] == tag, x["text"])
    return F.transform_values(
        tagged,
        lambda _k, x: F.struct(tag_is(x, TAG_STRING).alias("S"), tag_is(x, TAG_NUMBER).alias("N"), tag_is(x, TAG_BOOL).try_cast("boolean").alias("BOOL")),
    )


def tagged_long_attrs(df: DataFrame, id_cols: Sequence[str], json_object: Column) -> DataFrame:
    """P6 + P7 on a JSON object column: (ids, attribute, tag, value), nulls dropped.

    JSON nulls are dropped first with the cheap ``is_variant_null`` test, so
    the value's type is computed once per kept attribute (a filter on the tag
    itself would be pushed below the projection and recompute the type in
    every branch).
    """
    exploded = object_fields(df, id_cols, json_object)
    present = exploded.where(~F.is_variant_null(F.col("v")))
    typed = present.select(*id_cols, "attribute", "v", F.schema_of_variant("v").alias("_t"))
    return typed.select(
        *id_cols,
        "attribute",
        tag_of_type(F.col("_t")).alias("tag"),
        _text_of_type(F.col("v"), F.col("_t")).alias("value"),
    )
