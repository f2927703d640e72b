"""Every attribute a column (P5): a flatten whose columns are discovered first."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.attributes import TAG_BOOL, TAG_NUMBER, TAG_STRING, object_fields, stringify_variant, tag_of_type

#: More attributes than this fail: each is a column of the plan.
MAX_COLUMNS = 1000


def attribute_types(df: DataFrame, json_object: Column, max_columns: int = MAX_COLUMNS) -> dict[str, str]:
    """The attributes of all objects and the column type of each, by name.

    The tags of an attribute's values decide (P6): only booleans give BOOLEAN,
    only whole numbers BIGINT, only numbers DOUBLE, anything else STRING.  An
    attribute that is null wherever it occurs is none (P4).  Tags are combined
    map-side: a task sends one row per attribute, not one per value.
    """
    present = object_fields(df, [], json_object).where(~F.is_variant_null("v"))
    typed = present.select("attribute", F.schema_of_variant("v").alias("t")).select("attribute", tag_of_type(F.col("t")).alias("tag"), (F.col("t") != "BIGINT").alias("fraction"))
    only = lambda tag: F.bool_and(F.col("tag") == tag)
    kind = F.when(only(TAG_BOOL), "boolean").when(only(TAG_NUMBER), F.when(F.bool_or("fraction"), "double").otherwise("bigint")).otherwise("string")
    rows = typed.groupBy("attribute").agg(kind.alias("kind"), only(TAG_STRING).alias("text")).limit(max_columns + 1).collect()
    if len(rows) > max_columns:
        raise ValueError(f"more than {max_columns} attributes")
    return {r.attribute: "text" if r.text else r.kind for r in sorted(rows, key=lambda r: r.attribute)}


def _field(parsed: Column, name: str, kind: str) -> Column:
    quote = "'" if '"' in name else '"'
    if quote in name:  # no path can hold it
        value = F.try_variant_get(parsed, "$", "map<string,variant>")[name]
    else:
        value = F.try_variant_get(parsed, f"$[{quote}{name}{quote}]", "variant" if kind == "string" else "string" if kind == "text" else kind)
        if kind != "string":
            return value
    return F.try_variant_get(value, "$", kind) if kind not in ("string", "text") else stringify_variant(value)


def flatten_all(df: DataFrame, json_col: str, keep: Sequence[str], max_columns: int = MAX_COLUMNS, prefix: str = "") -> DataFrame:
    """P5: ``keep`` and one column for each attribute of the JSON objects in ``json_col``.

    Two passes: the first finds the attributes and their types
    (:func:`attribute_types`), the second is one projection of them, in the
    order of their names.  Text of nested values is JSON; a mixed attribute is
    text.  Bodies that hold no object give NULL attributes.  Nothing is
    dropped: too many attributes, or one whose name (with ``prefix``) is that
    of another column, fail.
    """
    types = attribute_types(df, F.try_parse_json(F.col(json_col)), max_columns)
    names = [*keep, *[prefix + a for a in types]]
    if len({n.lower() for n in names}) < len(names):
        raise ValueError(f"attributes clash with other columns, give a prefix: {sorted(names)}")
    parsed = df.select(*keep, F.try_parse_json(F.col(json_col)).alias("__json"))
    return parsed.select(*keep, *[_field(F.col("__json"), a, kind).alias(prefix + a) for a, kind in types.items()])
