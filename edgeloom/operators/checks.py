"""Data-quality checks: which ids break the rules of the model."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from edgeloom.functions.edges import endpoints
from edgeloom.model import BipartiteGraph, EdgeMap, EdgeSet, Graph, NodeMap, NodeSet, Vector
from edgeloom.plans.rounds import written
from edgeloom.plans.skew import lookup, measured_hot_keys

Checked = Vector | NodeSet | NodeMap | EdgeSet | EdgeMap | Graph | BipartiteGraph


def _rule(rule: str, ids: DataFrame) -> DataFrame:
    return ids.select(F.lit(rule).alias("rule"), F.col("id"))


def _null_ends(edges: DataFrame) -> DataFrame:
    broken = edges.where(F.col("src").isNull() | F.col("dst").isNull())
    return _rule("null_endpoint", broken.select(F.coalesce("src", "dst").alias("id")).distinct())


def _key_rules(ids: DataFrame) -> list[DataFrame]:
    repeated = ids.groupBy("id").agg(F.count("*").alias("n")).where("n > 1")
    return [
        _rule("null_id", ids.where(F.col("id").isNull()).distinct()),
        _rule("duplicate_id", repeated.where(F.col("id").isNotNull())),
    ]


def _absent(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    ends = endpoints(edges).where(F.col("id").isNotNull())
    return ends.join(nodes.select("id"), "id", "left_anti")


def _inside_one_side(graph: BipartiteGraph, pairs: DataFrame, rows: int) -> DataFrame:
    sides = (
        graph.nodes0.select("id", F.lit(True).alias("in0"), F.lit(False).alias("in1"))
        .union(graph.nodes1.select("id", F.lit(False), F.lit(True)))
        .groupBy("id").agg(F.max("in0").alias("in0"), F.max("in1").alias("in1"))
    )
    by_src = measured_hot_keys(pairs, "src", rows)
    by_dst = measured_hot_keys(pairs, "dst", rows)
    src = sides.select("id", F.col("in0").alias("src0"), F.col("in1").alias("src1"))
    dst = sides.select("id", F.col("in0").alias("dst0"), F.col("in1").alias("dst1"))
    both = lookup(lookup(pairs, "src", src, by_src, "dst"), "dst", dst, by_dst, "src")
    return endpoints(both.where("(src0 and dst0) or (src1 and dst1)"))


def violations(x: Checked) -> DataFrame:
    """Every offending id with the rule it breaks: ``rule, id``; empty when ``x`` is sound.

    An edge with one null end is listed by its other end.
    """
    if isinstance(x, Vector):
        rules = _key_rules(x.df.select(F.col("pos").alias("id")))
    elif isinstance(x, (NodeSet, NodeMap)):
        rules = _key_rules(x.df.select("id"))
    elif isinstance(x, (EdgeSet, EdgeMap)):
        rules = [_null_ends(x.df)]
    elif isinstance(x, Graph):
        rules = [_null_ends(x.edges), *_key_rules(x.nodes.select("id"))]
        rules.append(_rule("endpoint_not_in_nodes", _absent(x.edges, x.nodes)))
    elif isinstance(x, BipartiteGraph):
        ids0, ids1 = x.nodes0.select("id"), x.nodes1.select("id")
        # Written once for the three rules that read them.
        pairs, facts = written(x.edges.select("src", "dst").distinct(), rows=F.count("*"))
        rules = [_null_ends(pairs), *_key_rules(ids0), *_key_rules(ids1)]
        rules.append(_rule("in_both_sides", ids0.distinct().join(ids1, "id", "left_semi")))
        rules.append(_rule("endpoint_in_no_side", _absent(pairs, ids0.union(ids1))))
        rules.append(_rule("edge_inside_side", _inside_one_side(x, pairs, facts["rows"])))
    else:
        raise TypeError(f"no rules for {type(x).__name__}")
    return reduce(DataFrame.union, rules)


class BrokenRules(ValueError):
    """``violations`` is the table of all offending ids, ``counts`` their number per rule."""

    def __init__(self, name: str, counts: dict[str, int], violations: DataFrame):
        listed = ", ".join(f"{rule}: {n}" for rule, n in sorted(counts.items()))
        super().__init__(f"{name} breaks its rules ({listed}); the attribute violations lists all ids")
        self.counts, self.violations = counts, violations


def require_valid(x: Checked) -> Checked:
    """Return ``x``, or raise with the number of offending ids per rule and a table of all."""
    found = violations(x)
    counts = {row["rule"]: row["n"] for row in found.groupBy("rule").agg(F.count("*").alias("n")).collect()}
    if counts:
        raise BrokenRules(type(x).__name__, counts, found)
    return x
