"""Edge, node and vector tables: from any DataFrame into the model and back.

Column selection and casts stay Catalyst expressions, so a Parquet scan below reads only the
columns named here and takes the filters above.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from edgeloom.functions.values import SPARK_TYPES
from edgeloom.model import EdgeMap, EdgeSet, NodeMap, NodeSet, Vector


def _id(df: DataFrame, column: str) -> Column:
    """The column as an id. A number with a fraction is none: reading it raises an error."""
    value, kind = F.col(column), df.schema[column].dataType
    if isinstance(kind, T.FractionalType):
        fail = F.raise_error(F.concat(F.lit(f"{column} is no whole number: "), value.cast("string"))).cast("bigint")
        return F.when(value == F.floor(value), value.cast("bigint")).when(value.isNull(), F.lit(None)).otherwise(fail)
    return value.cast("bigint")


def edges_from_table(
    df: DataFrame, src: str = "source", dst: str = "target", weight: str | None = None,
    directed: bool = True,
) -> EdgeSet | EdgeMap:
    missing = [c for c in (src, dst, weight) if c is not None and c not in df.columns]
    if missing:
        raise ValueError(f"missing columns {missing}; there are {df.columns}")
    ends = [_id(df, src).alias("src"), _id(df, dst).alias("dst")]
    if weight is None:
        return EdgeSet(df.select(*ends), directed)
    return EdgeMap(df.select(*ends, F.col(weight).alias("weight")), directed)


def edges_to_table(
    edges: EdgeSet | EdgeMap, src: str = "src", dst: str = "dst", weight: str = "weight"
) -> DataFrame:
    columns = [F.col("src").alias(src), F.col("dst").alias(dst)]
    if isinstance(edges, EdgeMap):
        columns.append(F.col("weight").alias(weight))
    return edges.df.select(*columns)


def node_map_from_table(df: DataFrame, key: str, value: str) -> NodeMap:
    return NodeMap(df.select(_id(df, key).alias("id"), F.col(value).alias("weight")))


def node_map_to_table(
    nodes: NodeMap, key: str = "id", value: str = "weight", typed: bool = False
) -> DataFrame:
    """Columns ``key`` and ``value``; ``typed`` widens the value to its simple type."""
    column = F.col("weight").cast(SPARK_TYPES[nodes.dtype]) if typed else F.col("weight")
    return nodes.df.select(F.col("id").alias(key), column.alias(value))


def node_set_from_table(df: DataFrame, column: str) -> NodeSet:
    return NodeSet(df.select(_id(df, column).alias("id")))


def node_set_to_table(nodes: NodeSet, column: str = "id") -> DataFrame:
    return nodes.df.select(F.col("id").alias(column))


def vector_from_table(df: DataFrame, pos: str, value: str) -> Vector:
    return Vector(df.select(_id(df, pos).alias("pos"), F.col(value).alias("value")))


def vector_from_array(df: DataFrame, array: str, keep: list[str] | None = None) -> DataFrame:
    """Open an array column into ``pos, value`` rows, one vector per input row.

    ``keep`` names the columns that tell the vectors apart; without it a one-row table
    gives the columns of a single :class:`Vector`.
    """
    opened = df.select(*(keep or []), F.posexplode(array).alias("pos", "value"))
    return opened.withColumn("pos", F.col("pos").cast("bigint"))


def vector_to_table(vector: Vector, pos: str = "pos", value: str = "value") -> DataFrame:
    return vector.df.select(F.col("pos").alias(pos), F.col("value").alias(value))
