"""Mix sources to target weights by Efraimidis-Spirakis sampling.

Each document draws a key Exp(1) / weight from a hash of its id; the smallest keys of a
source are a weighted sample without replacement. A source whose target exceeds its size
first gives complete epochs, then the documents whose sizes, added up in key order, fill the
rest. Keys are binned on a monotone scale: bin sums find the bin in which a source's target
is reached, and only the documents of that one bin are sorted, so no source is ever sorted
or added up in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fieldlake.llm.common import Scratch

WORD = r"[^\x20\x09-\x0D]+"
_HASH_RANGE = float(16**13)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def exponential_key(key: Column, weight: Column, seed: str) -> Column:
    """Exp(1) / weight, the same on every run; equal ids draw equal keys."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null"))))
    uniform = (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 1) / (_HASH_RANGE + 1)
    return -F.log(uniform) / weight


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """Target of each source: (source, source_size, target).

    `sizes` has one row per source. Weights repeat over sources by code point, null last.
    The targets add up to `share` of all sizes; a target stops at `most` times its source's
    size, and the excess is shared again by weight, which ends at one water level.
    """
    everything = Window.partitionBy()
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    by_limit = Window.orderBy("_limit", F.col("source").asc_nulls_last())
    before = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    nth = (F.row_number().over(by_name) - 1) % len(weights) + 1
    levels = (
        sizes.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), nth).cast("double"))
        .withColumn("_cap", F.col("source_size") * F.lit(float(most)))
        .withColumn("_limit", F.col("_cap") / F.col("_weight"))
        .withColumn("_budget", F.sum("source_size").over(everything) * F.lit(float(share)))
        .withColumn("_left", F.col("_budget") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0)))
        .withColumn(
            "_open",
            F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(before), F.lit(0.0)),
        )
        .withColumn("_level", F.col("_left") / F.col("_open"))
    )
    # The first source, by limit, that its level does not fill; later levels only fall.
    level = F.max(F.when(F.col("_level") <= F.col("_limit"), F.col("_level"))).over(everything)
    shared = F.coalesce(F.least(F.col("_weight") * level, F.col("_cap")), F.col("_cap"))
    return levels.select("source", "source_size", shared.alias("target"))


def mix(
    docs: DataFrame,
    quality: DataFrame | None = None,
    *,
    seed: str = "mix",
    quality_weights: tuple[float, float, float] = (1.0, 0.25, 0.5),
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    bins: int = 4096,
) -> DataFrame:
    """What the mix takes of each document: doc_id, source, size, source_size, target, copies, taken.

    `quality` (doc_id, quality) scales a document's chance: `quality_weights` are those of
    quality 1, quality 0 and no label; of several labels the highest counts. The document at
    a source's end is taken if that brings the sum nearer to the target.

    Null text: size 0. Null source: a source of its own, last in order. Null id: a document
    like others, with one fixed key. Equal ids draw equal keys and are ordered by size; equal
    rows stay separate rows. An empty table gives no rows. Other columns are ignored.
    """
    scratch = Scratch(docs.sparkSession, "mix")
    thin = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"))
    good, poor, unknown = map(F.lit, quality_weights)
    if quality is not None:
        labels = quality.groupBy("doc_id").agg(F.max("quality").alias("_quality"))
        thin = thin.join(labels, "doc_id", "left")
    else:
        thin = thin.withColumn("_quality", F.lit(None).cast("int"))
    weight = F.when(F.col("_quality") == 1, good).when(F.col("_quality") == 0, poor).otherwise(unknown)
    key = exponential_key(F.col("doc_id"), weight, seed)
    thin = scratch.put(
        thin.withColumn("_key", key).withColumn(
            "_bin", F.least(F.floor(bins * (1 - F.exp(-F.col("_key") * good))), F.lit(bins - 1)).cast("int")
        ).drop("_quality"),
        "sizes",
    )
    binned = scratch.put(thin.groupBy("source", "_bin").agg(F.sum("size").alias("_size")), "bins")
    targets = source_targets(
        binned.groupBy("source").agg(F.sum("_size").alias("source_size")), weights, share, most
    )
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = targets.withColumn("_epochs", epochs.cast("long")).withColumn(
        "_rest", F.col("target") - F.col("_epochs") * F.col("source_size")
    )
    running = Window.partitionBy("source").orderBy("_bin")
    filled = binned.withColumn("_end", F.sum("_size").over(running)).alias("b")
    crossing = (
        filled.join(targets.alias("t"), F.col("b.source").eqNullSafe(F.col("t.source")))
        .where(F.col("_end") > F.col("_rest"))
        .groupBy(F.col("b.source").alias("source"))
        .agg(
            F.min("_bin").alias("_cross"),
            F.min_by(F.col("_end") - F.col("_size"), F.col("_bin")).alias("_before"),
        )
        .alias("c")
    )
    plan = scratch.put(
        targets.alias("t")
        .join(crossing, F.col("t.source").eqNullSafe(F.col("c.source")), "left")
        .select("t.*", F.coalesce("_cross", F.lit(bins)).alias("_cross"), F.coalesce("_before", F.lit(0)).alias("_before")),
        "plan",
    )
    placed = (
        thin.alias("d")
        .join(plan.alias("p"), F.col("d.source").eqNullSafe(F.col("p.source")))
        .select("d.*", "source_size", "target", "_epochs", "_rest", "_cross", "_before")
    )
    order = Window.partitionBy("source").orderBy("_key", "doc_id", "size")
    ahead = F.coalesce(F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    edge = placed.where(F.col("_bin") == F.col("_cross")).withColumn("_ahead", F.col("_before") + ahead)
    edge = edge.withColumn("_more", 2 * F.col("_ahead") + F.col("size") <= 2 * F.col("_rest")).drop("_ahead")
    rest = placed.where(F.col("_bin") != F.col("_cross")).withColumn("_more", F.col("_bin") < F.col("_cross"))
    copies = F.col("_epochs") + F.when(F.col("_more"), 1).otherwise(0)
    return rest.unionByName(edge).select(
        "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )


def take(docs: DataFrame, quality: DataFrame | None = None, **options) -> DataFrame:
    """The mixed documents: every document as often as the mix takes it, its columns unchanged.

    Documents with equal id, source and size are alike to the mix and are each repeated as
    often as `mix` says for one of them; null ids match each other.
    """
    chosen = (
        mix(docs, quality, **options)
        .groupBy("doc_id", "source", "size").agg(F.max("copies").alias("_copies"))
        .where(F.col("_copies") > 0)
        .alias("m")
    )
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"))
    sized = whole.withColumn("size", word_count(F.col("doc.text"))).alias("d")
    same = (
        F.col("d.doc.doc_id").eqNullSafe(F.col("m.doc_id"))
        & F.col("d.doc.source").eqNullSafe(F.col("m.source"))
        & (F.col("d.size") == F.col("m.size"))
    )
    repeated = sized.join(chosen, same).select(
        "doc", F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int"))).alias("again")
    )
    return repeated.select("doc.*")


#: DuckDB SQL for the mix of `documents` with the labels' quality.
MIX_SQL = r"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels GROUP BY doc_id),
d AS (
  SELECT documents.doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    -ln((('0x' || substr(md5('mix:' || coalesce(documents.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE + 1)
        / (4503599627370496.0::DOUBLE + 1))
      / CASE WHEN quality = 1 THEN 1.0::DOUBLE WHEN quality = 0 THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END AS k
  FROM documents LEFT JOIN q USING (doc_id)
),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT]::DOUBLE AS w
  FROM d GROUP BY source
),
l AS (
  SELECT *, 2.0 * source_size / w AS lim,
    1.5 * sum(source_size) OVER () - coalesce(sum(2.0 * source_size) OVER b, 0) AS left_over,
    sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS open_w
  FROM s WINDOW b AS (ORDER BY 2.0 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
v AS (SELECT max(left_over / open_w) AS level FROM l WHERE left_over / open_w <= lim),
t AS (
  SELECT source, source_size, coalesce(least(w * level, 2.0 * source_size), 2.0 * source_size)::DOUBLE AS target
  FROM l, v
),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t
),
p AS (
  SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS rest,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.doc_id, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
  FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source
)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN 2 * ahead + size <= 2 * rest THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM p
"""
