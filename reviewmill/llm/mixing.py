"""Mixing sources to target weights by Poisson replication, with DataFrame functions only.

Every source has a repetition rate: its share of the wanted mixture divided by its share of the
corpus. A document occurs as often as a Poisson draw with that mean says. The draw inverts the
distribution at a uniform number taken from a hash of seed and id, so a retry draws the same.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewmill.llm.common import let, table, text_of, without
from reviewmill.operators.joins import lookup_join

SEED = 17
# Weight of a source: its size to this power. 1 keeps the mixture as it is, 0 makes it even.
TEMPER = 0.5
# A larger mean is the sum of several draws, so that exp(-mean) does not underflow.
MEAN_PER_DRAW = 64.0

ADDED = ["copy", "n_copies"]


def source_key(source_col: str) -> Column:
    """A text that is never null; rows without a source are a source of their own."""
    name = F.col(source_col).cast("string")
    return F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), name))


def source_rates(docs: DataFrame, text_col: str, source_col: str, temper: float,
                 weights: DataFrame | None) -> DataFrame:
    """The repetition rate of each source (``_source``, ``_rate``).

    ``weights`` has a row per source (source, weight); without it a source weighs its size in
    characters to the power of ``temper``. The mixture is as large as the corpus. A source with
    empty texts only cannot reach a share, and its rate is 1.
    """
    sizes = docs.groupBy(source_key(source_col).alias("_source")).agg(
        F.sum(F.length(text_of(text_col))).alias("_size")
    )
    if weights is None:
        weighed = sizes.withColumn("_weight", F.pow(F.col("_size").cast("double"), F.lit(temper)))
    else:
        wanted = weights.select(source_key("source").alias("_source"),
                                F.col("weight").cast("double").alias("_weight"))
        weighed = sizes.join(wanted, "_source", "left").fillna(0.0, ["_weight"])
    sums = sizes.agg(F.sum("_size")).scalar().cast("double")
    total = weighed.agg(F.sum("_weight")).scalar()
    rate = F.coalesce(F.try_divide(F.col("_weight"), total), F.lit(0.0)) * sums / F.col("_size")
    return weighed.select(
        "_source", F.when(F.col("_size") > 0, rate).otherwise(F.lit(1.0)).alias("_rate")
    )


def uniform(key: Column, draw: Column, seed: int) -> Column:
    """A number between 0 and 1 from the first 52 bits of a digest."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key, F.lit(":"), draw.cast("string")))
    bits = F.conv(F.substring(digest, 1, 13), 16, 10).cast("double")
    return (bits + F.lit(0.5)) / F.lit(float(1 << 52))


def poisson_at(u: Column, mean: Column) -> Column:
    """The smallest count whose cumulative probability exceeds ``u``.

    The steps go so far that the rest of the distribution is below the step of ``u``.
    """
    last = F.ceil(mean + 12 * F.sqrt(mean) + 40).cast("int")

    def step(state: Column, k: Column) -> Column:
        probability = state["p"] * mean / k
        return F.when(state["upto"] > u, state).otherwise(
            F.struct(k.alias("k"), probability.alias("p"),
                     (state["upto"] + probability).alias("upto"))
        )

    start = F.struct(F.lit(0).alias("k"), F.exp(-mean).alias("p"), F.exp(-mean).alias("upto"))
    return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda state: state["k"])


def poisson_count(key: Column, rate: Column, seed: int) -> Column:
    draws = F.greatest(F.ceil(rate / MEAN_PER_DRAW).cast("int"), F.lit(1))

    def total(mean: Column) -> Column:
        return F.aggregate(
            F.sequence(F.lit(1), draws), F.lit(0),
            lambda count, draw: count
            + let(uniform(key, draw, seed), lambda u: poisson_at(u, mean)),
        )

    return let(rate / draws, total)


def mix_sources(
    docs: DataFrame,
    weights: DataFrame | None = None,
    temper: float = TEMPER,
    seed: int = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Repeat the documents of each source to its target share and shuffle them globally.

    The result has all columns of the input plus ``copy`` (from 1) and ``n_copies``; columns of
    these names are replaced. Documents whose draw is 0 do not occur. A source that is missing in
    ``weights`` weighs nothing. Null and empty texts have no size but occur like other documents of
    their source. A row without an id draws by its text; repeated rows draw the same count. An
    empty table gives an empty result.
    """
    rows = without(docs, ADDED)
    packed = rows.select(
        F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"),
        source_key(source_col).alias("_source"),
        F.coalesce(F.col(id_col).cast("string"), F.md5(text_of(text_col))).alias("_key"),
    )
    rates = source_rates(docs, text_col, source_col, temper, weights)
    drawn = lookup_join(packed, rates, "_source", "_key").withColumn(
        "n_copies", poisson_count(F.col("_key"), F.col("_rate"), seed)
    )
    copies = drawn.where("n_copies > 0").withColumn(
        "copy", F.explode(F.sequence(F.lit(1), F.col("n_copies")))
    )
    place = F.xxhash64(F.lit(seed), "_key", "copy")
    shuffled = copies.withColumn("_place", place).repartition("_place").sortWithinPartitions("_place")
    return shuffled.select("_row.*", "copy", "n_copies")


def op3_mix_sources(spark, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


ORACLE = """
WITH RECURSIVE sizes AS (
  SELECT source, sum(length(coalesce(text, '')))::double AS size FROM documents GROUP BY source
), rates AS (
  SELECT source,
         CASE WHEN size > 0 THEN sqrt(size) / (SELECT sum(sqrt(size)) FROM sizes)
              * (SELECT sum(size) FROM sizes) / size ELSE 1.0 END AS rate
  FROM sizes
), parts AS (
  SELECT source, rate, greatest(ceil(rate / 64.0), 1)::int AS draws,
         rate / greatest(ceil(rate / 64.0), 1) AS mean
  FROM rates
), levels AS (
  SELECT source, mean, 0 AS k, exp(-mean) AS p, exp(-mean) AS upto FROM parts
  UNION ALL
  SELECT source, mean, k + 1, p * mean / (k + 1), upto + p * mean / (k + 1) FROM levels
  WHERE k < mean + 12 * sqrt(mean) + 40
), cuts AS (
  SELECT source, list(upto ORDER BY k) AS upto FROM levels GROUP BY source
), draws AS (
  SELECT d.doc_id, c.upto,
         (('0x' || substr(md5('17:' || d.doc_id || ':' || i), 1, 13))::bigint + 0.5)
           / 4503599627370496.0 AS u
  FROM documents d JOIN parts USING (source) JOIN cuts c USING (source),
       unnest(generate_series(1, parts.draws)) AS s(i)
), counts AS (
  SELECT doc_id, sum(len(list_filter(upto, lambda x: x <= u)))::int AS n_copies
  FROM draws GROUP BY doc_id
)
SELECT d.*, unnest(generate_series(1, n_copies))::int AS copy, n_copies
FROM documents d JOIN counts USING (doc_id) WHERE n_copies > 0
"""

QUERIES = {"op3_mix_sources": op3_mix_sources}
ORACLES = {"op3_mix_sources": ORACLE}
