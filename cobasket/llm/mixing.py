"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

Each source gets a mean repetition rate: its target share of the total size over its own size. A row's
number of copies inverts the Poisson distribution of that mean at a uniform number hashed from its key,
so it depends on neither partitioning nor run. Rows are repeated by their count and dealt out globally
by hashes of key, copy and text, and lie in the order of the first two within every partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cobasket.llm.names import unused
from cobasket.llm.storage import written
from cobasket.operators.lookup import look_up

# Up to so many numbers (8 MB) in all sources' distribution tables together, these are broadcast.
BROADCAST_NUMBERS = 1_000_000
# Uniform numbers have 52 bits: 13 hex digits.
HEX_DIGITS = 13


def _digest(*parts: Column) -> Column:
    return F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts]).cast("binary"))


def uniform(key: Column, seed: int) -> Column:
    """A number in [0, 1) for every key."""
    digits = F.substring(_digest(F.lit(seed), key), 1, HEX_DIGITS)
    return F.conv(digits, 16, 10).cast("double") / F.lit(float(16**HEX_DIGITS))


def rates(sizes: DataFrame, weights: DataFrame | None, temperature: float, epochs: float) -> DataFrame:
    """(``_source``, ``_rate``) from (``_source``, ``_size``).

    ``weights`` has (source, weight); sources without one get 0. Without ``weights`` the weight is the size to
    the power ``temperature``. ``epochs`` scales the expected total size.
    """
    if weights is None:
        weighted = sizes.withColumn("_weight", F.pow(F.col("_size").cast("double"), F.lit(float(temperature))))
    else:
        given = weights.toDF("_name", "_given").groupBy("_name").agg(F.sum("_given").cast("double").alias("_given"))
        weighted = sizes.join(given, F.col("_source").eqNullSafe(F.col("_name")), "left")
        weighted = weighted.withColumn("_weight", F.coalesce("_given", F.lit(0.0)))
    total = weighted.agg(F.sum("_size").cast("double").alias("sizes"), F.sum("_weight").alias("weights")).first()
    expected = F.lit((total["sizes"] or 0.0) * float(epochs))
    rate = F.try_divide(F.try_divide(F.col("_weight"), F.lit(total["weights"])) * expected, F.col("_size").cast("double"))
    return weighted.select("_source", F.coalesce(rate, F.lit(0.0)).alias("_rate"))


def table_length(rate: Column) -> Column:
    """The last number of copies in a source's table."""
    return F.ceil(rate + 12 * F.sqrt(rate) + 30)


def poisson_tables(of_source: DataFrame) -> DataFrame:
    """(``_source``, ``_cdf``): the cumulative Poisson probabilities of 0, 1, 2, ... copies, as an ascending array.

    It reaches so far into the tail that the rest is below the uniform numbers' resolution.
    """
    rate = F.col("_rate")
    longest = table_length(rate)
    steps = of_source.select("_source", "_rate", F.explode(F.sequence(F.lit(0).cast("long"), longest)).alias("_k"))
    upto = Window.partitionBy("_source").orderBy("_k")
    steps = steps.withColumn("_log_factorial", F.sum(F.ln(F.greatest("_k", F.lit(1)))).over(upto))
    chance = F.when(rate > 0, F.exp(F.col("_k") * F.ln(rate) - rate - F.col("_log_factorial")))
    chance = F.coalesce(chance, F.when(F.col("_k") == 0, 1.0).otherwise(0.0))
    summed = steps.withColumn("_below", F.sum(chance).over(upto))
    return summed.groupBy("_source").agg(F.array_sort(F.collect_list("_below")).alias("_cdf"))


def mix(
    rows: DataFrame,
    weights: DataFrame | None = None,
    temperature: float = 0.5,
    epochs: float = 1.0,
    seed: int = 5,
    key: str = "doc_id",
    source: str = "source",
    text: str = "text",
    copy: str = "copy",
    shuffle_key: str = "shuffle_key",
) -> DataFrame:
    """``rows``, each as often as drawn, with ``copy`` (from 1) and ``shuffle_key``, globally shuffled.

    Size is code points of the text. A null source is a source of its own, null texts and empty ones have no size,
    and a source without any size gets no copies, having no rate. Repeated rows, and rows of equal or null
    keys and one source, draw the same count. Columns of ``rows`` that are named like the two new ones are replaced; the names
    of these are arguments. Long texts move whole, once. An empty table stays empty. ``rows`` is read twice, first for the sizes of
    the sources, which are written.
    """
    rows = rows.drop(copy, shuffle_key)
    sizes = rows.groupBy(F.col(source).alias("_source")).agg(
        F.coalesce(F.sum(F.char_length(text)), F.lit(0)).cast("long").alias("_size")
    )
    sizes = written(sizes, "sizes")
    of_source = written(rates(sizes, weights, temperature, epochs), "rates")
    numbers = of_source.agg(F.sum(table_length(F.col("_rate")))).first()[0] or 0
    tables = poisson_tables(of_source)
    name, cdf, draw, count = (unused(rows, n) for n in ("_name", "_cdf", "_draw", "_count"))
    # Sources and the missing one as texts that can't be mistaken for each other.
    marked = rows.withColumn(name, F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("null")))
    named = F.coalesce(F.concat(F.lit("="), "_source"), F.lit("null"))
    tables = tables.select(named.alias(name), F.col("_cdf").alias(cdf))
    if numbers <= BROADCAST_NUMBERS:
        with_table = marked.join(F.broadcast(tables), name)
    else:
        with_table = look_up(marked, tables, [name])
    # The count is the number of probabilities that the uniform number reaches.
    with_table = with_table.withColumn(draw, uniform(F.col(key), seed))
    repeated = (
        with_table.withColumn(count, F.size(F.filter(cdf, lambda p: p <= F.col(draw))))
        .where(F.col(count) > 0)
        .withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(count))))
        .withColumn(shuffle_key, _digest(F.lit(seed + 1), F.col(key), F.col(copy)))
        .select(*rows.columns, copy, shuffle_key)
    )
    # Rows without a key, or of one key, have equal shuffle keys; their texts tell them apart.
    return repeated.repartition(shuffle_key, F.xxhash64(F.col(source), F.col(text))).sortWithinPartitions(shuffle_key)
