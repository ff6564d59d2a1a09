"""Column-level helpers on edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def symmetrize(edges: DataFrame) -> DataFrame:
    """Both directions of every edge; a self-loop stays one row.

    One pass over the input: each row explodes into itself and, unless it is a loop, its mirror.
    """
    here = F.struct(F.col("src").alias("s"), F.col("dst").alias("d"))
    back = F.struct(F.col("dst").alias("s"), F.col("src").alias("d"))
    ends = F.when(F.col("src") == F.col("dst"), F.array(here)).otherwise(F.array(here, back))
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    opened = edges.select(F.explode(ends).alias("_e"), *rest)
    return opened.select(F.col("_e.s").alias("src"), F.col("_e.d").alias("dst"), *rest)


def canonicalize(edges: DataFrame) -> DataFrame:
    """Undirected form: the smaller id first, a missing end last."""
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    turned = (F.col("src") > F.col("dst")) | F.col("src").isNull()
    src = F.when(turned, F.col("dst")).otherwise(F.col("src"))
    dst = F.when(turned, F.col("src")).otherwise(F.col("dst"))
    return edges.select(src.alias("src"), dst.alias("dst"), *rest)


def whole_edges(edges: DataFrame) -> DataFrame:
    """The edges as they are; reading one with a missing end raises an error.

    The check is part of the plan that reads the edges, so it costs no pass of its own.
    """
    missing = F.col("src").isNull() | F.col("dst").isNull()
    fail = F.raise_error(F.lit("an edge has no src or no dst; see operators.checks.violations")).cast("bigint")
    rest = [c for c in edges.columns if c not in ("src", "dst")]
    return edges.select(F.when(missing, fail).otherwise(F.col("src")).alias("src"), "dst", *rest)


def endpoints(edges: DataFrame) -> DataFrame:
    """All ids an edge touches, each once, from one pass over the edges."""
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def neighbour_pairs(edges: DataFrame) -> DataFrame:
    """Distinct undirected edges without self-loops, smaller id first."""
    plain = edges.select("src", "dst").where(F.col("src") != F.col("dst"))
    return canonicalize(plain).distinct()
