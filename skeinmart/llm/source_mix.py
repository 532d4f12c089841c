"""Mixing sources to target weights by Poisson replication; DataFrame functions only.

Every document is repeated a random number of times with mean rate(source), so that a
source's expected share of the output is its weight. The number comes from inverting
the Poisson distribution at a uniform value hashed from the seed and the document, so
any task, and any later run, draws the same one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .tables import quoted, unused_name, whole_text

TEMPERATURE = 0.5
SEED = "mix-1"
# A mean above this is drawn as a sum of parts, since exp(-mean) would vanish.
PART_MEAN = 32.0


def uniform(*parts: Column | str) -> Column:
    """A value in (0, 1) from the MD5 of the parts, on 48 bits."""
    digest = F.md5(F.concat_ws("|", *parts).cast("binary"))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def inverse_poisson(mean: Column, u: Column) -> Column:
    """Least n whose cumulative probability exceeds u; the means here are at most PART_MEAN."""
    # u < 1 - 2**-49 is reached long before this bound.
    bound = F.ceil(mean + 12 * F.sqrt(mean) + 24).cast("int")
    zero = F.struct(F.exp(-mean).alias("p"), F.exp(-mean).alias("sum"), F.lit(0).alias("n"))

    def step(acc, k):
        p = acc["p"] * mean / k
        more = F.struct(p.alias("p"), (acc["sum"] + p).alias("sum"), k.alias("n"))
        return F.when(acc["sum"] > u, acc).otherwise(more)

    return F.reduce(F.sequence(F.lit(1), bound), zero, step, lambda acc: acc["n"])


def source_rates(docs: DataFrame, source_col: str, text_col: str, weights: dict[str, float] | None, temperature: float, budget: float | None) -> DataFrame:
    """source, rate: the mean number of repeats that gives each source its weight in an output of ``budget`` bytes."""
    size = docs.groupBy(F.col(source_col).alias("source")).agg(F.sum(F.octet_length(whole_text(text_col))).cast("double").alias("bytes"))
    if weights is None:
        weight = F.pow("bytes", F.lit(temperature))
    else:
        weight = F.lit(0.0)
        for name, w in weights.items():
            weight = F.when(F.col("source") == name, F.lit(float(w))).otherwise(weight)
    # Written: a row a source, so that the size of the file decides how the rates meet the texts, before any text is shuffled.
    size = materialize(size.withColumn("weight", F.when(F.col("bytes") > 0, weight).otherwise(0.0)), "source-sizes")
    total = size.agg(F.sum("bytes").alias("all_bytes"), F.sum("weight").alias("all_weights")).first()
    want = float(budget if budget is not None else total.all_bytes or 0.0)
    share = F.col("weight") / F.lit(float(total.all_weights or 1.0))
    return size.select("source", F.when(F.col("bytes") > 0, F.lit(want) * share / F.col("bytes")).otherwise(1.0).alias("rate"))


def mix(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weights: dict[str, float] | None = None, temperature: float = TEMPERATURE, budget: float | None = None, seed: str = SEED,
    names: tuple[str, str] = ("copy_no", "shuffle_key"),
) -> DataFrame:
    """Every row of ``docs`` as often as drawn, with copy_no (from 1) and shuffle_key added, in globally random order.

    Target shares of the output's text bytes are ``weights`` by source (a source that
    has none gets none) or, without them, the sources' bytes to the power
    ``temperature``; the output has about ``budget`` bytes, by default as many as the
    input. Null is a source of its own. A source without any text has the rate 1. Rows
    with the same id draw the same number; null ids count as one id. The added columns,
    called ``names``, replace columns of those names. Each partition is a random share of
    the copies, sorted by shuffle_key, an MD5 of seed, id and copy.
    """
    rates = source_rates(docs, source_col, text_col, weights, temperature, budget)
    base = docs.drop(*names)
    s, r, n = (unused_name(base, x) for x in ("mix_source", "mix_rate", "mix_times"))
    rates = rates.select(F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias(s), F.col("rate").alias(r))
    rows = base.withColumn(s, F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))).join(rates, s)
    key = F.coalesce(F.col(id_col).cast("string"), F.lit("null"))
    parts = F.greatest(F.ceil(F.col(r) / PART_MEAN), F.lit(1))
    drawn = F.reduce(
        F.sequence(F.lit(1).cast("long"), parts), F.lit(0),
        lambda acc, i: acc + inverse_poisson(F.col(r) / parts, uniform(F.lit(seed), key, i.cast("string"))),
    )
    times = rows.withColumn(n, drawn).where(F.col(n) > 0)
    copies = times.withColumn(names[0], F.explode(F.sequence(F.lit(1), F.col(n))))
    order = F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), key, F.col(names[0]).cast("string")).cast("binary"))
    out = copies.withColumn(names[1], order).select(*quoted(base), *names)
    return out.repartition(names[1]).sortWithinPartitions(names[1])


MIX_SQL = f"""
WITH RECURSIVE size AS (
  SELECT source, CAST(SUM(strlen(COALESCE(text, ''))) AS DOUBLE) AS bytes FROM {{docs}} GROUP BY source
), total AS (
  SELECT SUM(bytes) AS all_bytes, SUM(CASE WHEN bytes > 0 THEN pow(bytes, {TEMPERATURE}) ELSE 0 END) AS all_weights FROM size
), rates AS (
  SELECT source, CASE WHEN bytes > 0 THEN all_bytes * (pow(bytes, {TEMPERATURE}) / all_weights) / bytes ELSE 1.0 END AS rate FROM size, total
), parts AS (
  SELECT source, rate, GREATEST(CAST(CEIL(rate / {PART_MEAN}) AS BIGINT), 1) AS parts FROM rates
), chance AS (
  SELECT source, parts, rate / parts AS mean, 0 AS n, exp(-(rate / parts)) AS p, exp(-(rate / parts)) AS below FROM parts
  UNION ALL
  SELECT source, parts, mean, n + 1, p * mean / (n + 1), below + p * mean / (n + 1) FROM chance WHERE n < CEIL(mean + 12 * sqrt(mean) + 24)
), draws AS (
  SELECT d.*, COALESCE(CAST(d.doc_id AS VARCHAR), 'null') AS id, i.i
  FROM {{docs}} d JOIN parts ON d.source IS NOT DISTINCT FROM parts.source, LATERAL (SELECT UNNEST(range(1, parts.parts + 1)) AS i) i
), drawn AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.id, d.i,
    (CAST('0x' || substr(md5('{SEED}|' || d.id || '|' || d.i), 1, 12) AS BIGINT) + 0.5) / {float(1 << 48)!r} AS u FROM draws d
), counted AS (
  SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, d.id, SUM(d.times) AS times FROM (
    SELECT drawn.*, (SELECT COUNT(*) FROM chance c WHERE c.source IS NOT DISTINCT FROM drawn.source AND c.below <= drawn.u) AS times FROM drawn
  ) d GROUP BY ALL
), copies AS (
  SELECT c.*, UNNEST(range(1, CAST(times AS BIGINT) + 1)) AS copy_no FROM counted c
)
SELECT doc_id, text, lang, source, n_chars, CAST(copy_no AS INTEGER) AS copy_no,
  md5('{SEED}|order|' || id || '|' || copy_no) AS shuffle_key FROM copies
"""
