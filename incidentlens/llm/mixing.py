"""Mixing sources to target weights by hash thresholds.

Every document has a fixed hash.  A source that is to give q times itself and a
fraction more takes all its documents q times, and once more those whose hash is
under a threshold.  The threshold is found without sorting documents: sizes are
summed by source and by the leading bits of the hash, the bucket in which the
budget runs out is the only one looked into more closely, and so on until one
hash is left there.  What the first threshold leaves over is spent by a second one
on documents beyond it that are small enough to fit.

Cases: a null or blank text has size 0; a null source is a source of its own, last
in order; rows of the same id have the same hash and are taken together; a source
without words has target 0; an empty table gives an empty result."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import word_count

WEIGHTS = (1, 2, 3)
CAP = 3
HASH_BITS = 60
LEVEL_BITS = 12
ROUNDS = 2


def hash_of(column: str):
    """60 bits of the MD5 digest of the id as text (null: empty text)."""
    digest = F.md5(F.coalesce(F.col(column).cast("string"), F.lit("")))
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP
) -> DataFrame:
    """Target of each source (`source`, `source_size`), one narrow row per source.

    In the order of cap * size / weight, a source is capped if what is left of the
    total, shared by the weights left, would still give it more than its cap.  This
    is where resharing the excess again and again ends.  The windows run over one
    row per source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), place + 1).cast("long")
    by_ratio = Window.orderBy(
        F.col("source_size") * cap / F.col("weight"), F.col("source").asc_nulls_last()
    )
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    every = Window.partitionBy(F.lit(0))
    limit = F.col("source_size") * cap
    left = F.sum("source_size").over(every) - F.coalesce(F.sum(limit).over(before), F.lit(0))
    judged = (
        sizes.withColumn("weight", weight)
        .withColumns({"_left": left, "_weights": F.sum("weight").over(after)})
        .withColumn("_level", F.col("_left").cast("double") / F.col("_weights"))
        .withColumn("_capped", F.col("weight") * F.col("_level") >= limit)
    )
    # the level falls over the sources that are not capped; the first one's holds
    level = F.max(F.when(~F.col("_capped"), F.col("_level"))).over(every)
    target = F.when(F.col("_capped"), limit.cast("double")).otherwise(
        F.least(limit.cast("double"), F.col("weight") * F.col("_shared"))
    )
    return judged.withColumn("_shared", level).select(
        "source", "source_size", "weight", target.alias("target")
    )


def _cut(docs: DataFrame, budgets: DataFrame) -> DataFrame:
    """For each source the hash at which its `budget` runs out: documents below
    `cut` fit, `left` is what they leave over.  `docs` has source, size, hash."""
    bounds = budgets.select(
        "source",
        F.col("budget").alias("left"),
        F.lit(0).cast("long").alias("prefix"),
        F.lit(1 << HASH_BITS).alias("cut"),
        F.lit(True).alias("open"),
    )
    shift = HASH_BITS
    while shift > 0:
        shift -= LEVEL_BITS
        state = bounds.filter("open").withColumnRenamed("source", "_source")
        histogram = (
            docs.join(state, F.col("source").eqNullSafe(F.col("_source")))
            .filter(F.shiftright("hash", shift + LEVEL_BITS) == F.col("prefix"))
            .groupBy("source", "left", F.shiftright("hash", shift).alias("bucket"))
            .agg(F.sum("size").alias("s"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        )
        running = F.sum("s").over(Window.partitionBy("source").orderBy("bucket"))
        crossed = (
            histogram.withColumn("through", running)
            .filter(F.col("through") > F.col("left"))
            .groupBy(F.col("source").alias("_source"))
            .agg(F.min(F.struct("bucket", "through", "s", "lo", "hi")).alias("x"))
        )
        one = F.col("x.lo") == F.col("x.hi")
        found = F.col("x").isNotNull()
        bounds = materialize(
            bounds.join(crossed, F.col("source").eqNullSafe(F.col("_source")), "left").select(
                "source",
                F.when(found, F.col("left") - (F.col("x.through") - F.col("x.s")))
                .otherwise(F.col("left"))
                .alias("left"),
                F.coalesce("x.bucket", "prefix").alias("prefix"),
                F.when(found & one, F.col("x.lo")).otherwise(F.col("cut")).alias("cut"),
                (F.col("open") & found & ~one).alias("open"),
            )
        )
        if bounds.filter("open").isEmpty():
            break
    return bounds.select("source", "cut", "left")


def _with_decision(docs: DataFrame, text: str, source: str, doc_id: str) -> DataFrame:
    return docs.select(
        F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
        F.col(source).alias("source"),
        word_count(F.col(text)).alias("size"),
        hash_of(doc_id).alias("hash"),
    )


def mix(
    docs: DataFrame,
    text: str = "text",
    source: str = "source",
    doc_id: str = "doc_id",
    weights: tuple[int, ...] = WEIGHTS,
    cap: int = CAP,
) -> DataFrame:
    """Every row as struct `row`, with its size, its source's size and target, and
    `copies`, the number of times the mix takes it (0 to `cap`)."""
    marked = _with_decision(docs, text, source, doc_id)
    narrow = materialize(marked.select("source", "size", "hash"))
    sizes = narrow.groupBy("source").agg(F.sum("size").alias("source_size"))
    whole = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    plan = targets(sizes, weights, cap).withColumn("whole", whole.cast("int"))
    budget = F.col("target") - F.col("whole") * F.col("source_size")
    plan = materialize(plan.withColumn("budget", budget))
    spent = plan
    open_docs = narrow
    for k in range(ROUNDS):
        cuts = _cut(open_docs, spent).withColumnsRenamed(
            {"source": "_source", "cut": f"cut{k}", "left": f"left{k}"}
        )
        plan = plan.join(cuts, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        spent = plan.select("source", F.col(f"left{k}").alias("budget"))
        rest = plan.withColumnRenamed("source", "_source")
        open_docs = (
            narrow.join(rest, F.col("source").eqNullSafe(F.col("_source")))
            .filter(_beyond(k))
            .select("source", "size", "hash")
        )
    plan = materialize(plan.drop("budget"))
    extra = F.lit(False)
    for k in range(ROUNDS):
        fits = F.col("hash") < F.col(f"cut{k}")
        extra = extra | ((_beyond(k - 1) & fits) if k else fits)
    copies = F.col("whole") + (extra & (F.col("whole") < cap)).cast("int")
    return marked.join(
        plan.withColumnRenamed("source", "_source"),
        F.col("source").eqNullSafe(F.col("_source")),
    ).select("row", "size", "source_size", "target", copies.alias("copies"))


def _beyond(k: int):
    """Not taken by rounds 0 to k, and small enough for what they left."""
    out = F.col("hash") >= F.col("cut0")
    for j in range(1, k + 1):
        out = out & ~((F.col("hash") < F.col(f"cut{j}")) & (F.col("size") <= F.col(f"left{j - 1}")))
    return out & (F.col("size") <= F.col(f"left{k}"))


def mixed(docs: DataFrame, **names) -> DataFrame:
    """The mix itself: the columns of `docs`, each row as often as it is taken."""
    taken = mix(docs, **names).filter("copies > 0")
    return taken.withColumn("_copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    from .common import read

    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mix(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT *, 1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight FROM sources),
levels AS (
  SELECT *,
    CAST((SELECT sum(source_size) FROM sources) - coalesce(sum(3 * source_size) OVER w, 0) AS DOUBLE)
      / CAST(sum(weight) OVER v AS DOUBLE) AS level
  FROM weighed
  WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         v AS (ORDER BY 3 * source_size / weight, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
judged AS (SELECT *, weight * level >= 3 * source_size AS capped FROM levels),
final AS (
  SELECT source, source_size,
    CASE WHEN capped THEN CAST(3 * source_size AS DOUBLE)
         ELSE least(CAST(3 * source_size AS DOUBLE), weight * (
           SELECT max(level) FROM judged WHERE NOT capped)) END AS target
  FROM judged),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM final),
first AS (
  SELECT d.doc_id, d.source, d.size, d.h, p.source_size, p.target, p.whole,
    p.target - p.whole * p.source_size AS budget,
    sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h
      RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through
  FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source),
cut AS (
  SELECT *, min(CASE WHEN through > budget THEN h END) OVER (PARTITION BY source) AS cut0,
    budget - coalesce(max(CASE WHEN through <= budget THEN through END) OVER (PARTITION BY source), 0) AS left0
  FROM first),
second AS (
  SELECT *, h < coalesce(cut0, 1152921504606846976) AS one,
    h >= coalesce(cut0, 1152921504606846976) AND size <= left0 AS may,
    sum(CASE WHEN h >= coalesce(cut0, 1152921504606846976) AND size <= left0 THEN size ELSE 0 END)
      OVER (PARTITION BY source ORDER BY h RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS through1
  FROM cut)
SELECT doc_id, size, source_size, target,
  CAST(size * (whole + CASE WHEN whole < 3 AND (one OR (may AND through1 <= left0)) THEN 1 ELSE 0 END)
    AS BIGINT) AS taken
FROM second
"""
