"""Mixing sources to target weights by iterative proportional fitting.

Tokens are added up per cell of source, language and topic. The cells' weights are raked: in
turn each dimension is scaled to its target shares, until all of them hold at once. The raked
weights become probabilities: a document of cell ``c`` is drawn with ``min(1, k * weight / tokens)``,
where ``k`` makes the expected number of tokens the budget. The draw is a keyed hash of the
document's id, so it is the same in every run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from edgeloom.llm.common import column_of, free_name, table
from edgeloom.plans.rounds import Rounds, written
from edgeloom.plans.skew import hot_keys, lookup

DIMENSIONS = ("source", "lang", "topic")
NONE = "\u0000"  # stands for a null source or language
SWEEPS = 50
TOLERANCE = 1e-9

_DROP = {  # characters that each count is of
    "digits": "0123456789",
    "marks": "%$#&*|!<>{}=_",
    "capitals": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
}


def topic_of(text: Column) -> Column:
    """Kind of a whole text, by its shares of capitals, marks and digits, and its length."""
    n = F.greatest(F.lit(1), F.length(text))

    def share(kind: str) -> Column:
        return (F.length(text) - F.length(F.translate(text, _DROP[kind], ""))) / n

    return (
        F.when(text.isNull() | (F.length(text) == 0), "empty")
        .when(share("capitals") > 0.3, "shouted").when(share("marks") > 0.02, "marked")
        .when(share("digits") > 0.01, "numeric").when(F.length(text) > 5000, "long").otherwise("prose")
    )


def tokens_of(text: Column) -> Column:
    """Words between ASCII white space; a text without any counts one token."""
    return F.greatest(F.lit(1), F.coalesce(F.regexp_count(text, F.lit("[^ \\t\\n\\r]+")), F.lit(0))).cast("bigint")


def draw_of(doc_id: Column, seed: str) -> Column:
    """A number from 0 up to 1 that depends on the id and the seed."""
    digest = F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / F.lit(float(1 << 48))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS,
         tolerance: float = TOLERANCE) -> DataFrame:
    """``cells(<dimensions>, tokens)`` with ``weight``, whose shares follow ``targets(value, share)``.

    A value without a target gets weight 0. Shares of values that no cell has are dealt out
    in proportion. Where targets contradict each other on empty cells it ends after ``sweeps``.
    """
    with Rounds(cells.sparkSession) as rounds:
        state = cells.withColumn("weight", F.col("tokens").cast("double"))
        for name, target in targets.items():
            wanted = target.groupBy(F.col("value").alias(name)).agg(F.sum("share").alias("_share")).where("_share > 0")
            there = wanted.join(cells.select(name).distinct(), name, "left_semi")
            total = there.agg(F.sum("_share")).first()[0] or 1.0
            wanted = there.select(name, (F.col("_share") / F.lit(total)).alias(f"_target_{name}"))
            state = state.join(wanted, name, "left")
        state, _ = rounds.written(state)
        for _ in range(sweeps):
            furthest = 0.0
            for name in targets:
                sums = state.groupBy(name).agg(F.sum("weight").alias("_sum"), F.first(f"_target_{name}").alias("_share"))
                factor = F.when(F.col("_sum") > 0, F.coalesce("_share", F.lit(0.0)) / F.col("_sum")).otherwise(F.lit(0.0))
                joined = state.join(sums.select(name, factor.alias("_factor")), name)
                scaled = joined.withColumn("weight", F.col("weight") * F.col("_factor"))
                scaled, facts = rounds.written(scaled, off=F.max(F.abs(F.col("_factor") - 1)))
                state = scaled.select(*state.columns)
                furthest = max(furthest, facts["off"] or 0.0)
            if furthest <= tolerance:
                break
        return written(state.select(*cells.columns, "weight"))[0]


def calibrate(raked: DataFrame, budget: float) -> tuple[DataFrame, float]:
    """``raked`` with ``p``, so that ``sum(p * tokens)`` is ``budget``, or all tokens with weight if fewer."""
    level, full = -1.0, F.lit(False)
    while True:
        sums = raked.agg(
            F.sum(F.when(full, F.col("tokens")).otherwise(0)).alias("full"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0.0)).alias("open"),
        ).first()
        if not sums["open"]:
            level = float("inf")
            break
        new = (budget - (sums["full"] or 0)) / sums["open"]
        if new <= level * (1 + 1e-12):  # a further cell at its limit would raise it
            break
        level = new
        full = F.col("weight") * F.lit(level) >= F.col("tokens")
    p = F.when(F.col("weight") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.lit(level) * F.col("weight") / F.col("tokens")))
    return raked.withColumn("p", p), level


def mixed(docs: DataFrame, targets: dict[str, DataFrame] | None, share: float, seed: str = "mix",
          doc_id: str = "doc_id", text: str = "text", source: str = "source", lang: str = "lang",
          name: str = "mix") -> DataFrame:
    """``docs`` with a struct ``name``: ``source, lang, topic, tokens, weight, p, drawn``.

    ``targets`` has a table ``value, share`` for any of source, lang and topic; without it,
    :func:`even_targets` holds. ``share`` is the budget as a share of all tokens. Null sources and languages are a value of their own,
    written as :data:`NONE`; texts without words count one token. Repeated rows of one id are
    drawn or left together.
    """
    content = column_of(docs, text).cast("string")
    cell = F.struct(
        F.coalesce(column_of(docs, source).cast("string"), F.lit(NONE)).alias("source"),
        F.coalesce(column_of(docs, lang).cast("string"), F.lit(NONE)).alias("lang"),
        topic_of(content).alias("topic"), tokens_of(content).alias("tokens"),
    )
    marked, _ = written(docs.withColumn(name, cell))  # texts are counted once
    of_cell = marked.select(F.col(f"{name}.*"))
    cells, facts = written(
        of_cell.groupBy(*DIMENSIONS).agg(F.sum("tokens").alias("tokens"), F.count("*").alias("n")),
        cells=F.count("*"), rows=F.sum("n"), tokens=F.sum("tokens"),
    )
    raked = rake(cells.select(*DIMENSIONS, "tokens"), even_targets(cells) if targets is None else targets)
    tabled, _ = calibrate(raked, share * (facts["tokens"] or 0))
    key = free_name(marked, "_cell")
    # A few cells go to the documents; many are shuffled, and rows of a popular cell are spread.
    known, _ = written(tabled.select(_key("").alias("id"), F.struct("weight", "p").alias(key + "_found")))
    hot = hot_keys(cells.select(_key("").alias(key), "n"), key, facts["rows"] or 0)
    joined = lookup(marked.withColumn(key, _key(name + ".")), key, known, hot,
                    by=draw_of(column_of(docs, doc_id), "spread"), rows=facts["cells"])
    found = column_of(joined, key + "_found")
    drawn = draw_of(column_of(docs, doc_id), seed) < found["p"]
    fields = [F.col(f"{name}.{c}") for c in (*DIMENSIONS, "tokens")]
    out = F.struct(*fields, found["weight"].alias("weight"), found["p"].alias("p"), drawn.alias("drawn"))
    return joined.withColumn(name, out).drop(key, key + "_found")


def _key(prefix: str) -> Column:
    return F.to_json(F.array(*[F.col(prefix + c) for c in DIMENSIONS]))


def even_targets(cells: DataFrame, power: float = 0.5) -> dict[str, DataFrame]:
    """Targets in proportion to the ``power`` of the tokens that each value has in ``cells``."""
    return {
        name: cells.groupBy(F.col(name).alias("value")).agg(F.pow(F.sum("tokens"), F.lit(power)).alias("share"))
        for name in DIMENSIONS
    }


def sample(docs: DataFrame, targets: dict[str, DataFrame] | None = None, share: float = 0.5, **options) -> DataFrame:
    """The rows of ``docs`` that are drawn; see :func:`mixed`."""
    name = free_name(docs, "_mix")
    marked = mixed(docs, targets, share, name=name, **options)
    return marked.where(column_of(marked, name)["drawn"]).drop(name)


def op3_mixing(spark, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "source", "lang")
    return mixed(docs, None, 0.5).select(
        "doc_id", "mix.source", "mix.lang", "mix.topic", "mix.tokens",
        F.round("mix.weight", 9).alias("weight"), F.round("mix.p", 7).alias("p"), "mix.drawn",
    )
