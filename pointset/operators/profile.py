"""Profiling of labelled feature tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.durable import discard, materialize, measured

VECTOR = "vector"
TEXT = "text"


def type_class(data_type: T.DataType) -> str:
    """Coarse class of a column type; type names differ between engines."""
    if isinstance(data_type, T.BooleanType):
        return "boolean"
    if isinstance(data_type, T.IntegralType):
        return "integer"
    if isinstance(data_type, (T.FractionalType, T.DecimalType)):
        return "float"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "time"
    if isinstance(data_type, T.ArrayType):
        return VECTOR
    return TEXT


def shape(df: DataFrame) -> DataFrame:
    """Record count and dimensionality of a point table."""
    return df.agg(F.count("*").alias("n_rows"), F.max(F.size("x")).cast("int").alias("dim"))


def table_shape(df: DataFrame) -> DataFrame:
    """Record count and attribute count of a raw table."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("dim"))


def _per_attribute(df: DataFrame, columns: list[str], aggregates: dict[str, Column], fields) -> DataFrame:
    """One wide aggregate over the table, turned into a row per attribute."""
    wide = df.agg(*[value.alias(name) for name, value in aggregates.items()])
    rows = F.array(*[F.struct(F.lit(c).alias("attribute"), *fields(c)) for c in columns])
    return wide.select(F.inline(rows))


def type_profile(df: DataFrame) -> DataFrame:
    """The classes of values seen in each attribute; nulls count as a class."""
    columns = df.columns
    kinds = {f.name: type_class(f.dataType) for f in df.schema.fields}
    filled = {f"n_{c}": F.count(F.col(c)) for c in columns}

    def fields(c):
        n = F.col(f"n_{c}")
        seen = F.array_compact(
            F.array(
                F.when(n > 0, F.lit(kinds[c])),
                F.when(n < F.col("n_all"), F.lit("null")),
            )
        )
        return [F.array_join(seen, ",").alias("types")]

    return _per_attribute(df, columns, {"n_all": F.count("*"), **filled}, fields)


def distinct_counts(df: DataFrame, columns: list[str] | None = None, approx: bool = False) -> DataFrame:
    """Distinct values per attribute, exact or from sketches.

    Exact: attributes of one class are unpivoted together, so that there is one
    narrow ``(attribute, value)`` shuffle per class instead of one job per
    attribute.  Repeated values are merged before that shuffle.
    """
    columns = columns or df.columns
    if approx:
        sketches = {f"d_{c}": F.approx_count_distinct(F.col(c)) for c in columns}
        return _per_attribute(df, columns, sketches, lambda c: [F.col(f"d_{c}").alias("n_distinct")])
    groups: dict[str, list[str]] = {}
    for c in columns:
        groups.setdefault(_common_type(df.schema[c].dataType), []).append(c)
    parts = [_distinct_of_type(df, names, common) for common, names in groups.items()]
    return reduce(DataFrame.unionByName, parts)


def _common_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "bigint"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "double"
    return data_type.simpleString()


def _distinct_of_type(df: DataFrame, columns: list[str], common: str) -> DataFrame:
    typed = df.select(*[F.col(c).cast(common).alias(c) for c in columns])
    rows = typed.unpivot([], columns, "attribute", "value")
    return rows.groupBy("attribute").agg(F.countDistinct("value").alias("n_distinct"))


def true_k(df: DataFrame, label: str = "y") -> DataFrame:
    """Number of distinct labels."""
    return df.agg(F.countDistinct(label).alias("k"))


def label_counts(df: DataFrame, label: str = "y", order: str | None = None) -> DataFrame:
    """Rows per label; ``order="desc"`` puts the largest label first."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), label) if order == "desc" else counts


def numeric_dim(df: DataFrame) -> DataFrame:
    """What ``drop_categorical`` leaves: ``dim`` attributes, ``n_filled`` of which hold a
    value in some of the ``n_rows`` rows."""
    kept = [f.name for f in df.schema.fields if type_class(f.dataType) != TEXT]
    filled = [F.coalesce(F.max(F.col(f"`{c}`").isNotNull().cast("bigint")), F.lit(0)) for c in kept]
    return df.agg(
        F.lit(len(kept)).cast("bigint").alias("dim"),
        reduce(Column.__add__, filled, F.lit(0)).cast("bigint").alias("n_filled"),
        F.count("*").alias("n_rows"),
    )


# Types found in values, as classes; containers go by name.
VALUE_CLASSES = [
    ("BOOLEAN", "boolean"), ("BIGINT", "integer"), ("DECIMAL", "float"), ("DOUBLE", "float"), ("FLOAT", "float"),
    ("STRING", TEXT), ("DATE", "time"), ("TIMESTAMP", "time"), ("OBJECT", "object"), ("ARRAY", "array"), ("VOID", "null"),
]


def value_types(df: DataFrame, column: str) -> DataFrame:
    """The types found in the values of a JSON text or VARIANT column, at every path.

    A row per path: ``path, types, n_values, n_nulls``.  ``$`` is the value itself,
    ``.name`` a member and ``[*]`` the elements of an array.  ``types`` joins the classes
    seen, null included; a text that is no JSON counts as ``malformed`` at ``$``, a null
    in the column as null.  ``n_values`` counts the values that are not null.

    Every level of nesting is one pass over the containers of the level before, which
    are written to the shared folder; the sets of types are merged inside the tasks.
    """
    source = df.select(F.col(column).alias("raw"))
    parsed = F.col("raw") if isinstance(source.schema["raw"].dataType, T.VariantType) else F.try_parse_json("raw")
    broken = F.col("raw").isNotNull() & parsed.isNull()
    level = source.select(F.lit("$").alias("path"), parsed.alias("v"), broken.alias("broken"))
    counts, owned = [], None
    while True:
        kind = F.schema_of_variant("v")
        named = F.when(F.col("broken"), "malformed").when(F.col("v").isNull(), "null")
        for sign, name in VALUE_CLASSES:
            named = named.when(kind.startswith(sign), name)
        typed = level.withColumn("type", named.otherwise(F.lower(kind)))
        counts.append(materialize(typed.groupBy("path", "type").agg(F.count("*").alias("n")), "types"))
        inner, seen = measured(
            typed.where(F.col("type").isin("object", "array")).select("path", "type", "v"), "containers", n=F.count("*")
        )
        if owned is not None:
            discard(owned)
        owned = inner
        if not seen["n"]:
            break
        below = inner.withColumnRenamed("v", "of").withColumnRenamed("type", "in")
        members = below.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("of").outer()))
        path = F.when(F.col("in") == "array", F.concat("path", F.lit("[*]"))).otherwise(F.concat("path", F.lit("."), F.col("key")))
        level = members.select(path.alias("path"), F.col("value").alias("v"), F.lit(False).alias("broken"))
    discard(owned)
    every = reduce(DataFrame.unionByName, counts)
    return every.groupBy("path").agg(
        F.array_join(F.array_sort(F.collect_set("type")), ",").alias("types"),
        F.sum(F.when(F.col("type") != "null", F.col("n")).otherwise(0)).alias("n_values"),
        F.sum(F.when(F.col("type") == "null", F.col("n")).otherwise(0)).alias("n_nulls"),
    )
