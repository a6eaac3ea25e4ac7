"""Mixing sources to target weights by Poisson replication.

A source's mean repetition rate is its share of the row budget over its
rows. Each document's number of copies is the inverse of the Poisson
distribution of that mean at a uniform number hashed from (seed, doc_id):
the same on every run and machine, and independent of the partitioning. The
copies are ordered globally by another hash.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of the rate table up to which it is broadcast; beyond, a shuffled join takes its place.
BROADCAST_SOURCES = 10_000


def uniform(*parts: str | Column) -> Column:
    """Number in [0, 1) from the first 52 bits of the MD5 of the parts."""
    cells = [F.coalesce(F.col(p).cast("string") if isinstance(p, str) else p.cast("string"), F.lit("")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws(":", *cells)), 1, 13), 16, 10).cast("double") / F.lit(float(2 ** 52))


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5,
          budget: float | None = None, source_col: str = "source") -> DataFrame:
    """(source, n, rate): mean copies of each document of a source.

    ``weights`` are relative target shares; sources not named in them get
    none. Without weights the share follows the source's size to ``power``.
    ``budget`` is the expected number of rows of the mixture (default: as
    many as there are documents). A null source is a source of its own.
    """
    sizes = docs.groupBy(F.col(source_col).cast("string").alias("source")).agg(F.count("*").alias("n"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow("n", F.lit(float(power))))
    else:
        pairs = [x for k, v in weights.items() for x in (F.lit(k), F.lit(float(v)))]
        given = F.create_map(*pairs)[F.col("source")] if pairs else F.lit(None).cast("double")
        sizes = sizes.withColumn("w", F.coalesce(given, F.lit(0.0)))
    total, every = sizes.agg(F.sum("w"), F.sum("n")).first()
    rows = float(every or 0) if budget is None else float(budget)
    return sizes.select("source", "n", (F.col("w") * F.lit(rows) / F.lit(float(total or 1.0)) / F.col("n")).alias("rate"))


def with_cdf(rate: DataFrame) -> DataFrame:
    """Add the cumulative Poisson probabilities of 0, 1, ... copies, up to where the tail is below double precision."""
    step = """aggregate(
        sequence(1, cast(ceil(rate + 12 * sqrt(rate) + 30) AS int)),
        named_struct('cdf', array(exp(-rate)), 'logp', -rate),
        (s, k) -> named_struct(
            'cdf', concat(s.cdf, array(element_at(s.cdf, -1) + exp(s.logp + ln(rate) - ln(k)))),
            'logp', s.logp + ln(rate) - ln(k)),
        s -> s.cdf)"""
    return rate.withColumn("cdf", F.expr(f"CASE WHEN rate > 0 THEN {step} ELSE array(1D) END"))


def mix(docs: DataFrame, weights: Mapping[str, float] | None = None, power: float = 0.5,
        budget: float | None = None, seed: int = 42, id_col: str = "doc_id", source_col: str = "source",
        copy_col: str = "mix_copy", order_col: str = "mix_order") -> DataFrame:
    """The rows of ``docs``, each as often as drawn, in a global random order.

    Adds as its last two columns ``copy_col`` (1, 2, ...) and ``order_col``
    (the MD5 the rows are ordered by), with underscores after the names where
    ``docs`` has such columns; columns of any names pass unchanged. Null and
    empty texts are kept like others, and very long ones pass whole. Rows
    without a doc_id share one draw; repeated rows get equal numbers of copies
    each; rows with equal doc_id and copy are ordered by it together, in any
    order among themselves. A source with target 0 gets no rows; an empty
    table gives an empty result.
    """
    names = docs.columns
    while copy_col in names:
        copy_col += "_"
    while order_col in [*names, copy_col]:
        order_col += "_"
    own = [f"d_{i}" for i in range(len(names))]
    at = lambda c: own[[n.lower() for n in names].index(c.lower())]
    docs = docs.toDF(*own)
    id_col, source_col = at(id_col), at(source_col)
    key, cdf, src, n = "mix_key", "mix_cdf", "mix_source", "mix_n"
    rate = with_cdf(rates(docs, weights, power, budget, source_col)).select(F.col("source").alias(src), F.col("cdf").alias(cdf))
    if rate.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rate = F.broadcast(rate)
    drawn = (docs.join(rate, F.col(source_col).cast("string").eqNullSafe(F.col(src)))
             .withColumn(key, uniform(F.lit(seed), id_col))
             .withColumn(n, F.expr(f"size(filter({cdf}, c -> c <= {key}))"))
             .where(F.col(n) > 0)
             .withColumn(n, F.explode(F.sequence(F.lit(1), F.col(n)))))
    order = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit("")), F.col(n).cast("string")))
    return drawn.select(*own, n, order.alias(key)).orderBy(key, id_col).toDF(*names, copy_col, order_col)
