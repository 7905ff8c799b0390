"""Mix sources to target weights, in words, by prefix sums over a random order.

Sources, by code point and null last, weigh 5, 2, 1, 5, ... and share the words of all documents.
No target exceeds ``most`` times its source's words; what is above is shared again among the
others by weight. This is a water level: every source gets its weight times the level, or its cap.

Each source's documents are put in the order of a hash of their id, cut into ranges of that hash
of about ``RANGE_ROWS`` rows, and summed: ranges first, then rows within a range, so no source is
in one task. The whole epochs that fit a target take every document; what is left takes documents
in order up to the exact word, so the last one is taken in part. Only DataFrame functions are used.

Null and empty texts have size 0 and take nothing; sources of size 0 have target 0. A null id
sorts as an empty one; of rows with one id the shorter comes first. Reruns agree.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from epochloom.llm.shared import saved

#: Fixed value: what words are made of.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
RANGE_ROWS = 100_000
#: Up to so many sources are broadcast to their documents; more are joined by a shuffle.
FEW_SOURCES = 10_000


def source_targets(sources: DataFrame, weights=WEIGHTS, most: int = 3) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source."""
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = (F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (place + 1).cast("int"))
    weighed = sources.withColumn("weight", weight.cast("double")).withColumn(
        "cap", F.col("source_size") * float(most)
    )
    # sources reach their caps in the order of cap to weight
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    rest = by_cap.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.sum("cap").over(
        by_cap.rowsBetween(Window.unboundedPreceding, 0)
    ) + F.col("cap")
    # the level if exactly the sources before this one are at their caps; the true one is highest
    level = weighed.withColumn("level", left / F.sum("weight").over(rest))
    level = level.withColumn("level", F.max("level").over(everything))
    target = F.least(F.col("cap"), F.col("level") * F.col("weight"))
    return level.select("source", "source_size", F.coalesce(target, F.lit(0.0)).alias("target"))


def mix_sources(
    docs: DataFrame, weights=WEIGHTS, most: int = 3, carried: tuple[str, ...] = ()
) -> DataFrame:
    """doc_id, size, source_size, target, taken for every row of (doc_id, text, source), and the
    named columns, by which rows of one id and size are ordered."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    # sources as keys of joins, which null is not
    name = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("name")
    sized = saved(
        docs.select("doc_id", "source", name, size.alias("size"), key.alias("key"), *carried)
    )
    sources = saved(
        sized.groupBy("name").agg(
            F.first("source").alias("source"),
            F.sum("size").alias("source_size"),
            F.count("*").alias("rows"),
        )
    )
    targets = source_targets(sources.select("source", "source_size"), weights, most)
    plan = targets.select(
        F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("")).alias("name"),
        "source_size",
        "target",
    ).join(sources.select("name", "rows"), "name")
    if sources.count() <= FEW_SOURCES:
        plan = F.broadcast(plan)
    ranges = F.ceil(F.col("rows") / RANGE_ROWS)
    part = F.conv(F.substring("key", 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    rows = sized.drop("source").join(plan, "name").withColumn(
        "range", F.floor(part * ranges).cast("long")
    )
    before = Window.partitionBy("name").orderBy("range")
    bases = (
        rows.groupBy("name", "range")
        .agg(F.sum("size").alias("all"))
        .select(
            "name",
            "range",
            (F.sum("all").over(before) - F.col("all")).alias("base"),
        )
    )
    inside = (
        Window.partitionBy("name", "range")
        .orderBy("key", "doc_id", "size", *carried)
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    ahead = F.col("base") + F.sum("size").over(inside) - F.col("size")
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    last = budget - F.col("epochs") * F.col("source_size") - F.col("ahead")
    return (
        rows.join(bases, ["name", "range"])
        .withColumns({"ahead": ahead, "epochs": epochs.cast("long")})
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            (
                F.col("epochs") * F.col("size")
                + F.greatest(F.lit(0), F.least(F.col("size"), last))
            )
            .cast("long")
            .alias("taken"),
            *carried,
        )
    )


#: The same in DuckDB SQL.
MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           md5(coalesce(doc_id::VARCHAR, '')) AS key
    FROM documents
), sources AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM sized GROUP BY source
), levels AS (
    SELECT *, 3.0 * source_size AS cap,
           ((SELECT sum(source_size) FROM sources)
             - coalesce(sum(3.0 * source_size) OVER before_it, 0))
             / sum(weight) OVER from_it AS level
    FROM sources
    WINDOW before_it AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
           from_it AS (ORDER BY 3.0 * source_size / weight, source NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
), targets AS (
    SELECT source, source_size,
           least(cap, weight * (SELECT max(level) FROM levels))::DOUBLE AS target
    FROM levels
), placed AS (
    SELECT doc_id, size, source_size, target, floor(target)::BIGINT AS budget,
           sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS ahead
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0
             THEN ((budget // source_size) * size)
               + greatest(0, least(size, (budget % source_size) - ahead))
             ELSE 0 END)::BIGINT AS taken
FROM placed
"""
