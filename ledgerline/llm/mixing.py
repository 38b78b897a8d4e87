"""Mixing sources to target weights by systematic sampling.

Each document of a source is expected ``target / source size`` times. Along the source's documents, ordered by size,
the expected copies are summed up from one random offset, and a document is emitted once per integer that its share of
the sum crosses. Neighbours have like sizes, so the words taken come near the target.

The running sum never lies in one task: a source is cut into blocks by size class and by a hash of the document id, the
sum within a block is a window, and the blocks of a source (at most 90 classes per power of ten times 256) are summed
before that.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import inner_name, null_last

CYCLE = (5, 2, 1)
MOST_COPIES = 3


def offset(seed: int) -> float:
    """The one random offset of a run, between 0 and 1."""
    return random.Random(seed).random()


def targets(sources: DataFrame, cycle: tuple[int, ...] = CYCLE, most: int = MOST_COPIES) -> DataFrame:
    """``sources`` (key, source_size; one row per source) with ``target`` and ``share``, the expected copies.

    Weights repeat along the keys. All sources together get the sum of all sizes by weight; where that is above
    ``most`` times a source's size the target stops there and the rest shares the excess by weight. The level at which
    that ends is found at once: sources are ordered by the level at which they are full, and the first that the level
    left over for it and its successors does not fill decides. A source without words gets none.
    """
    rank = F.row_number().over(Window.orderBy("key"))
    weight = F.element_at(F.array(*[F.lit(w) for w in cycle]), (F.pmod(rank - 1, F.lit(len(cycle))) + 1).cast("int"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    full = F.col("source_size").cast("double") * most / F.col("weight")
    before = Window.orderBy("full", "key").rowsBetween(Window.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) - most * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast(
        "double"
    ) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    leveled = (
        sources.withColumn("weight", weight.cast("long"))
        .withColumn("full", full)
        .withColumn("level", level)
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("full"), F.struct("full", "key", "level"))).over(every))
        .withColumn("level", F.col("level.level"))
    )
    capped = F.col("level").isNull() | (F.col("full") < F.col("level"))
    target = F.when(capped, F.col("source_size").cast("double") * most).otherwise(F.col("level") * F.col("weight"))
    share = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(most))))
    return leveled.select("key", "source_size", target.alias("target")).withColumn("share", F.coalesce(share, F.lit(0.0)))


def size_class(size: Column) -> Column:
    """Number of digits and the first two of them: 90 classes for each power of ten, in the order of the sizes."""
    digits = size.cast("string")
    return F.concat(F.lpad(F.length(digits).cast("string"), 2, "0"), F.substring(digits, 1, 2))


def mix(
    docs: DataFrame,
    size: Column,
    seed: int = 0,
    sized: DataFrame | None = None,
    cycle: tuple[int, ...] = CYCLE,
    most: int = MOST_COPIES,
) -> DataFrame:
    """All rows of ``docs`` (doc_id, source, more) as ``row`` with ``size``, ``source_size``, ``target`` and ``copies``.

    ``size`` is an expression over ``docs``; ``sized`` may hold the sizes already (source, size, doc_id), else they are
    computed twice, once for the totals. A null source is a source of its own, the last; a null document id sorts as
    the empty text. Rows that repeat are documents of their own; rows of equal id and size are in the order of the hashes of
    their columns. An empty table gives an empty result. The rows have the same copies on each run, whatever their order
    and partitioning.
    """
    inner = inner_name(docs.columns, "row")
    digest = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    keys = ("key", "class", "bucket")

    def keyed(frame: DataFrame, measure: Column, *more: Column) -> DataFrame:
        return frame.select(
            null_last("source").alias("key"), measure.cast("long").alias("size"), digest.alias("digest"), *more
        ).select("*", size_class(F.col("size")).alias("class"), F.substring("digest", 1, 2).alias("bucket"))

    slim = keyed(docs, size) if sized is None else keyed(sized, F.col("size"))
    blocks = slim.groupBy(*keys).agg(F.count("*").alias("rows"), F.sum("size").alias("words"))
    sources = targets(blocks.groupBy("key").agg(F.sum("words").alias("source_size")), cycle, most)
    earlier = Window.partitionBy("key").orderBy("class", "bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0))).drop("rows", "words")
    starts = starts.join(sources, "key")
    # Documents of equal size and id are in the order of the hashes of all that they hold.
    tie = inner_name([*keys, "size", "digest", inner], "tie")
    whole = F.xxhash64(*[c for c, kind in docs.dtypes if "map<" not in kind and "variant" not in kind])
    within = Window.partitionBy(*keys).orderBy("size", "digest", tie)
    ranked = keyed(docs, size, F.struct("*").alias(inner), whole.alias(tie)).withColumn("rank", F.row_number().over(within))
    end = (F.col("start") + F.col("rank")) * F.col("share") + F.lit(offset(seed))
    begin = (F.col("start") + F.col("rank") - 1) * F.col("share") + F.lit(offset(seed))
    copies = (F.floor(end) - F.floor(begin)).cast("int")
    return ranked.join(starts, list(keys)).select(
        F.col(inner).alias("row"), "size", "source_size", "target", copies.alias("copies")
    )


def mixed(docs: DataFrame, size: Column, seed: int = 0) -> DataFrame:
    """The mix itself: the columns of ``docs``, each row as often as the sample takes it. For nulls, ties, repeated rows and
    empty tables see :func:`mix`; a row of size zero is taken like any other."""
    taken = mix(docs, size, seed)
    return taken.select("row", F.explode(F.array_repeat(F.lit(1), F.col("copies")))).select("row.*")


# The same rule as DuckDB SQL, for comparison only.
SQL = f"""
with sized as (
  select doc_id, coalesce('a' || source, 'b') as key,
         case when text is null then 0
              else len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) end::bigint as size,
         md5(coalesce(doc_id::varchar, '')) as digest
  from documents),
per_source as (select key, sum(size)::bigint as source_size from sized group by key),
weighted as (
  select *, [{", ".join(map(str, CYCLE))}][((row_number() over (order by key) - 1) % {len(CYCLE)} + 1)::int]::bigint as weight
  from per_source),
filled as (select *, source_size::double * {MOST_COPIES} / weight as full_at from weighted),
leveled as (
  select *, (sum(source_size) over () - {MOST_COPIES} * coalesce(sum(source_size) over before, 0))::double
            / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from filled window before as (order by full_at, key rows between unbounded preceding and 1 preceding)),
ended as (select level as found from leveled where level <= full_at order by full_at, key limit 1),
aimed as (
  select key, source_size,
         case when found is null or full_at < found then source_size::double * {MOST_COPIES} else found * weight end as target
  from filled left join ended on true),
ranked as (
  select doc_id, size, source_size, target,
         case when source_size > 0 then least(target / source_size, {float(MOST_COPIES)}) else 0.0 end as share,
         row_number() over (partition by key order by
           lpad(length(size::varchar)::varchar, 2, '0') || substr(size::varchar, 1, 2), substr(digest, 1, 2), size, digest) as place
  from sized join aimed using (key))
select doc_id, size, source_size, target,
       ((floor(place * share + {{offset}}) - floor((place - 1) * share + {{offset}})) * size)::bigint as taken
from ranked
"""
