"""Mixing sources to target weights by nested hash thresholds.

Every document has a hash. A source's part of the mix is every document whose
hash lies below the source's threshold (a second copy of it, if the source is
wanted more than once). The threshold is found by histograms: sizes are summed by
source and hash bucket, running sums find the bucket in which the budget ends,
and only that bucket is looked at again by the next bits of the hash. Nothing is
sorted but the at most 2^BITS buckets of a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from txnlens.llm.common import hash60, materialize, positions

WEIGHTS = (5, 2, 1)
#: Words of the mix per word of the corpus, and most copies of a document.
SHARE = 1.5
MOST = 2
#: Bits of the hash per histogram; five histograms use up its 60 bits.
BITS, HASH_BITS = 12, 60
#: Thresholds of up to so many sources are broadcast.
BROADCAST_SOURCES = 100_000

PLAN_COLUMNS = ["_source", "_total", "_target", "_base", "_budget", "_edge", "_spent", "_edge_size", "_edge_rows"]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def row_hash(df: DataFrame, key: str = "doc_id", text: str = "text") -> Column:
    """Differs for all rows but repeated ones."""
    parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (key, text)]
    return hash60(F.concat_ws("\x1f", *parts))


def measured(docs: DataFrame, source: str = "source") -> DataFrame:
    """The documents with ``_source``, ``_size`` and ``_hash``."""
    return docs.withColumns({"_source": F.col(source), "_size": n_words(F.col("text")), "_hash": row_hash(docs)})


def targets(rows: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(_source, _total, _target), a row per source.

    Weights go round the sources in code-point order, null last. Raising all
    sources evenly by weight until they are full ends where resharing the excess
    round by round ends: sources are full in order of cap over weight. The windows
    without a key see one row per source.
    """
    totals = rows.groupBy("_source").agg(F.sum("_size").alias("_total"))
    order = Window.orderBy(F.asc_nulls_last("_source"))
    listed = F.array(*[F.lit(float(w)) for w in weights])
    weight = F.element_at(listed, (F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))) + 1).cast("int"))
    caps = totals.withColumns({"_w": weight, "_cap": F.lit(float(most)) * F.col("_total")})
    full = Window.orderBy(F.col("_cap") / F.col("_w"), F.asc_nulls_last("_source"))
    before = full.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("_w").over(full.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    all_words = F.sum("_total").over(Window.partitionBy())
    rate = (F.lit(share) * all_words - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / left
    rated = caps.withColumns({"_rate": rate, "_position": F.row_number().over(full)})
    open_ = rated.filter(F.col("_cap") / F.col("_w") > F.col("_rate"))
    level = open_.agg(F.min_by("_rate", "_position").alias("_level"))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_w") * F.col("_level"), F.col("_cap")))
    return caps.crossJoin(F.broadcast(level)).select("_source", "_total", target.alias("_target"))


def same_source(a: str = "_source", b: str = "_source_of") -> Column:
    return F.col(a).eqNullSafe(F.col(b))


def per_source(df: DataFrame, n_sources: int) -> DataFrame:
    """Broadcast if there are few sources; else a join whose skewed sides are split at run time."""
    return F.broadcast(df) if n_sources <= BROADCAST_SOURCES else df


def thresholds(rows: DataFrame, **params) -> DataFrame:
    """A row per source: its copies for all, the budget beyond them, and the hash where that ends.

    ``rows`` has _source, _size and _hash, and is read once per histogram;
    the second one and later see only rows of the boundary buckets.
    """
    spark = rows.sparkSession
    base = F.when(F.col("_total") > 0, F.floor(F.col("_target") / F.col("_total"))).otherwise(F.lit(0)).cast("long")
    plan = targets(rows, **params).withColumn("_base", base)
    plan = plan.withColumn("_budget", F.col("_target") - F.col("_base") * F.col("_total"))
    plan = materialize(spark, plan, "mix-targets")
    n_sources = plan.count()
    edges = plan.select(
        F.col("_source").alias("_source_of"), "_budget", F.lit(0).cast("long").alias("_prefix"),
        F.lit(0).cast("long").alias("_spent"),
    )
    found = []
    for level in range(HASH_BITS // BITS):
        shift = HASH_BITS - BITS * (level + 1)
        inside = F.shiftright(F.col("_hash"), shift + BITS) == F.col("_prefix")
        hits = rows.join(per_source(edges, n_sources), same_source() & inside)
        bucket = F.shiftright(F.col("_hash"), shift)
        sums = hits.groupBy("_source", "_budget", "_spent", bucket.alias("_bucket")).agg(
            F.sum("_size").alias("_edge_size"),
            F.count(F.lit(1)).alias("_edge_rows"),
            F.min("_hash").alias("_low"),
            F.max("_hash").alias("_edge"),
        )
        running = F.sum("_edge_size").over(Window.partitionBy("_source").orderBy("_bucket"))
        over = sums.withColumn("_upto", F.col("_spent") + running).filter(F.col("_upto") > F.col("_budget"))
        first = F.row_number().over(Window.partitionBy("_source").orderBy("_bucket"))
        edge = over.withColumn("_n", first).filter("_n = 1")
        edge = edge.withColumn("_spent", F.col("_upto") - F.col("_edge_size"))
        edge = materialize(spark, edge.select(
            F.col("_source").alias("_source_of"), "_budget", F.col("_bucket").alias("_prefix"), "_spent",
            "_edge_size", "_edge_rows", "_low", "_edge"), "mix-edges")
        done = F.col("_low") == F.col("_edge")
        found.append(edge.filter(done).select("_source_of", "_edge", "_spent", "_edge_size", "_edge_rows"))
        edges = edge.filter(~done).select("_source_of", "_budget", "_prefix", "_spent")
        if edges.isEmpty():
            break
    ends = found[0]
    for df in found[1:]:
        ends = ends.unionByName(df)
    joined = plan.join(ends, same_source(), "left").select(*PLAN_COLUMNS)
    return materialize(spark, joined.withColumnRenamed("_source", "_source_of"), "mix-plan")


def left_over() -> Column:
    """What the budget has left for the rows at the threshold."""
    return F.col("_budget") - F.col("_spent")


def nearer() -> Column:
    """Whether the budget is met more nearly with the one document at the threshold than without."""
    return F.col("_edge_size") - left_over() < left_over()


def with_plan(rows: DataFrame, plan: DataFrame) -> DataFrame:
    return rows.join(per_source(plan, plan.count()), same_source())


def taken(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows with ``_target``, ``_total`` and ``_taken``: words the mix takes of each.

    The document at the threshold is taken if that comes nearer to the budget.
    Repeated rows share one hash; if the threshold falls on them, each gives an
    even part of what is left.
    """
    even = F.floor(F.col("_size") * left_over() / F.col("_edge_size"))
    single = F.when(nearer(), F.col("_size")).otherwise(0)
    extra = (
        F.when(F.col("_hash") < F.col("_edge"), F.col("_size"))
        .when(F.col("_hash") == F.col("_edge"), F.when(F.col("_edge_rows") == 1, single).otherwise(even))
        .otherwise(0)
    )
    words = (F.col("_base") * F.col("_size") + F.coalesce(extra, F.lit(0))).cast("long")
    return with_plan(rows, plan).withColumn("_taken", words).drop(*({*plan.columns} - {"_target", "_total"}))


def plan_mix(docs: DataFrame, **params) -> DataFrame:
    """Thresholds of the documents' sources."""
    rows = measured(docs).select("_source", "_size", "_hash")
    return thresholds(materialize(docs.sparkSession, rows, "mix-rows"), **params)


def mix(docs: DataFrame, **params) -> DataFrame:
    """The documents, each as often as the mix takes it; the columns of ``docs``, of any name.

    A null text has no words. Empty documents have size 0 and are never taken.
    Null sources are one source, the last. Of repeated rows at a threshold as many are
    taken once more as come nearest to the budget: they are numbered, and the first so many
    are. An empty table gives an empty result.
    """
    plan = plan_mix(docs, **params)
    rows = docs.select(F.struct("*").alias("_doc"), F.col("source").alias("_source"), n_words(F.col("text")).alias("_size"), row_hash(docs).alias("_hash"))
    joined = with_plan(rows.filter("_size > 0"), plan)
    at_edge = F.coalesce(F.col("_hash") == F.col("_edge"), F.lit(False))
    tied = at_edge & (F.col("_edge_rows") > 1)
    once_more = F.coalesce((F.col("_hash") < F.col("_edge")) | (at_edge & nearer()), F.lit(False))
    copies = joined.filter(~tied).select("_doc", (F.col("_base") + once_more.cast("int")).alias("_copies"))
    if not plan.filter("_edge_rows > 1").isEmpty():
        group = F.coalesce(F.concat(F.lit("="), F.col("_source").cast("string")), F.lit("")).alias("_group")
        quota = F.round(left_over() / F.col("_size")).alias("_quota")
        numbered = positions(joined.filter(tied).select("_doc", "_base", group, quota), ["_group"], [])
        more = (F.col("at") < F.col("_quota")).cast("int")
        copies = copies.unionByName(numbered.select("_doc", (F.col("_base") + more).alias("_copies")))
    each = F.explode(F.array_repeat(F.lit(1), F.col("_copies").cast("int")))
    return copies.filter("_copies > 0").withColumn("_copy", each).select("_doc.*")


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    rows = materialize(spark, measured(docs).select("doc_id", "_source", "_size", "_hash"), "mix-rows")
    return taken(rows, thresholds(rows)).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_total").alias("source_size"),
        F.col("_target").alias("target"),
        F.col("_taken").alias("taken"),
    )


def oracle() -> str:
    weight = f"CAST([{', '.join(map(str, WEIGHTS))}][(rank - 1) % {len(WEIGHTS)} + 1] AS DOUBLE)"
    digest = "md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(31) || coalesce(text, ''))"
    return f"""
WITH docs AS (
  SELECT doc_id, source, CAST(('0x' || substr({digest}, 1, 15)) AS UBIGINT) AS h,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents),
totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS total, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM docs GROUP BY 1),
caps AS (SELECT *, {weight} AS w, {MOST}.0::DOUBLE * total AS cap FROM totals),
rates AS (
  SELECT *, row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS position,
         ({SHARE}::DOUBLE * (sum(total) OVER ())
          - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM caps),
level AS (SELECT min_by(rate, position) AS level FROM rates WHERE cap / w > rate),
targets AS (SELECT source, total, least(cap, coalesce(w * level, cap)) AS target FROM rates, level),
budgets AS (
  SELECT *, CASE WHEN total > 0 THEN CAST(floor(target / total) AS BIGINT) ELSE 0 END AS base,
         target - base * total AS budget FROM targets),
sums AS (
  SELECT d.*, b.* EXCLUDE (source), sum(size) OVER (PARTITION BY d.source ORDER BY h) AS upto,
         sum(size) OVER (PARTITION BY d.source, h) AS g, count(*) OVER (PARTITION BY d.source, h) AS n
  FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, total AS source_size, target, CAST(base * size + CASE
         WHEN upto <= budget THEN size
         WHEN upto - g > budget THEN 0
         WHEN n > 1 THEN floor(size * (budget - (upto - g)) / g)
         WHEN upto - budget < budget - (upto - g) THEN size ELSE 0 END AS BIGINT) AS taken
FROM sums"""
