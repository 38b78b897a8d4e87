"""Document fingerprints from closed syncmers of words.

A window of ``WINDOW`` words is an anchor if the least of its inner pieces (``INNER`` words each, compared by hash) lies
at its beginning or its end. That depends on the words of the window alone, not on what is around it, so that a passage
keeps its anchors wherever it stands, and an edit changes only the anchors that touch it. A fingerprint lists the
document's anchors with their position in words. Two fingerprints are as alike as the share of different anchors that
they have in common (Dice).

Everything runs as DataFrame expressions: whole arrays are shifted and combined, no element is looked up by position.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import WORD, inner_name

WINDOW = 8
INNER = 2
# Text that one block of neighbouring documents holds on average.
BLOCK_CHARS = 2 << 20
# Blocks grow beyond this number; their bounds reach the driver, 8 bytes each.
MOST_BLOCKS = 1 << 16


def _shift(values: Column, by: int) -> Column:
    """The array without its first ``by`` elements."""
    return F.when(F.size(values) > by, F.slice(values, F.lit(by + 1), F.size(values))).otherwise(F.slice(values, 1, 0))


def with_anchors(frame: DataFrame, text: str, anchors: str) -> DataFrame:
    """``frame`` with the array column ``anchors``, one long for each anchor of column ``text`` in the order of their
    positions: 32 bits of its hash, then 32 bits of its position in words. Texts with fewer words than a window have each
    word as an anchor; longer ones in which no window is chosen, which takes fewer than 13 words, have all their windows.
    Null and texts without words have none."""
    names = {n: inner_name([*frame.columns, anchors], f"_{anchors}_{n}") for n in ("w", "s", "m2", "m4", "m", "n")}
    w, s, m2, m4, m, n = (names[k] for k in ("w", "s", "m2", "m4", "m", "n"))
    steps = WINDOW - INNER  # positions of the inner pieces, less one
    if (WINDOW, INNER) != (8, 2):
        raise ValueError("the sliding minimum below is laid out for 7 inner pieces")
    least = lambda a, b: F.least(a, b)
    split = F.transform(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(f"({WORD})")), lambda x: F.xxhash64(x))
    out = frame.withColumn(w, split)
    out = out.withColumn(s, F.zip_with(w, _shift(F.col(w), 1), lambda a, b: F.xxhash64(a, b)))
    # Least of 2, 4 and 7 neighbours; entries that run over the end are cut off below.
    out = out.withColumn(m2, F.zip_with(s, _shift(F.col(s), 1), least))
    out = out.withColumn(m4, F.zip_with(m2, _shift(F.col(m2), 2), least))
    out = out.withColumn(m, F.zip_with(m4, _shift(F.col(m4), steps - 3), least))
    out = out.withColumn(n, F.greatest(F.size(w) - F.lit(WINDOW - 1), F.lit(0)))
    ends = F.zip_with(s, _shift(F.col(s), steps), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    middle = F.zip_with(_shift(F.col(s), INNER), _shift(F.col(s), 2 * INNER), lambda a, b: F.xxhash64(a, b))
    windows = F.zip_with(
        F.zip_with(F.slice(ends, F.lit(1), F.col(n)), F.slice(F.col(m), F.lit(1), F.col(n)),
                   lambda e, x: F.struct(e.a.alias("a"), e.b.alias("b"), x.alias("x"))),
        F.slice(middle, F.lit(1), F.col(n)),
        lambda e, c: F.when((e.a == e.x) | (e.b == e.x), F.xxhash64(e.a, c, e.b)),
    )
    # Closed on no side: a few windows of a short text, whose hashes only need the pieces again.
    every = F.zip_with(
        F.slice(ends, F.lit(1), F.col(n)), F.slice(middle, F.lit(1), F.col(n)), lambda e, c: F.xxhash64(e.a, c, e.b)
    )
    place = lambda found: F.array_compact(
        F.transform(found, lambda h, i: F.shiftleft(F.shiftright(h, 32), 32).bitwiseOR(i.cast("long")))
    )
    out = out.withColumn(anchors, place(F.when(F.col(n) > 0, windows).otherwise(F.col(w))))
    bare = (F.col(n) > 0) & (F.size(anchors) == 0)
    return out.withColumn(anchors, F.when(bare, place(every)).otherwise(F.col(anchors))).drop(*names.values())


def printed(anchors: Column) -> Column:
    """The fingerprint as text, hash and position of each anchor; the empty text where there are none."""
    digits = lambda x: F.lpad(F.lower(F.hex(F.shiftrightunsigned(x, 32))), 8, "0")
    place = lambda x: x.bitwiseAND(F.lit(0xFFFFFFFF)).cast("string")
    return F.array_join(F.transform(anchors, lambda x: F.concat(digits(x), F.lit("@"), place(x))), " ")


def hashes(anchors: Column) -> Column:
    return F.transform(anchors, lambda x: F.shiftright(x, 32))


def likeness(a: Column, b: Column) -> Column:
    """Share of the different anchors that two hash arrays have in common, from 0 to 1; two empty ones are alike."""
    total = F.size(F.array_distinct(a)) + F.size(F.array_distinct(b))
    return F.when(total == 0, F.lit(1.0)).otherwise(2.0 * F.size(F.array_intersect(a, b)) / total)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` (text, more) with ``fingerprint``, the printed anchors, in the place of a column of that name.
    Null texts and those without words have the empty fingerprint, equal texts equal ones; texts of any length are read
    whole, and an empty table stays empty."""
    name = inner_name(docs.columns, "_anchors")
    return with_anchors(docs, "text", name).withColumn("fingerprint", printed(F.col(name))).drop(name)


def followed(docs: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """doc_id, text and anchors of each row, and ``next_text`` and ``next_anchors``, those of the next document by
    descending id; after the last comes the first.

    Documents are dealt into blocks by quantiles of their ids and each block is put in order by itself. The first
    document of a block is also sent to the block before it, whose last document it follows. So each text moves once.
    Rows of equal id are in the order of their texts' hashes; null ids come last and share a block; null texts are empty.
    """
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    total, high, nulls = slim.agg(
        F.sum(F.length("text").cast("long")), F.max("doc_id"), F.count_if(F.col("doc_id").isNull())
    ).first()
    number = min(MOST_BLOCKS, max(1, math.ceil((total or 0) / block_chars)))
    bounds: list[int] = []  # the highest id of each block; all are ids that exist
    if high is not None:
        shares = [i / number for i in range(1, number)]
        inner = slim.agg(F.percentile_approx("doc_id", shares, max(10_000, 4 * number))).first()[0] if shares else []
        bounds = sorted({*inner, high})
    # A block is found in two steps, so that the work per row goes with the root of their number.
    wide = max(1, math.isqrt(len(bounds)))
    rows = [bounds[i : i + wide] for i in range(0, len(bounds), wide)] or [[]]
    # One literal, parsed once when the plan is made.
    tops = F.from_json(F.lit(json.dumps([row[-1] for row in rows if row])), "array<bigint>")
    nested = F.from_json(F.lit(json.dumps(rows)), "array<array<bigint>>")
    below = lambda x: x < F.col("doc_id")
    mine = F.get(nested, F.col("_row"))
    null = F.col("doc_id").isNull()
    blocked = (
        slim.withColumn("_row", F.size(F.filter(tops, below)))
        .withColumn("_block", F.when(null, F.lit(0)).otherwise(F.col("_row") * wide + F.size(F.filter(mine, below)) + 1))
        .withColumn("_head", null | F.exists(mine, lambda x: x == F.col("doc_id")))
    )
    before = F.when(F.col("_block") == len(bounds), F.lit(0 if nulls or not bounds else 1)).otherwise(F.col("_block") + 1)
    stays = F.struct(F.col("_block").alias("block"), F.lit(False).alias("follows"))
    follows = F.struct(before.alias("block"), F.lit(True).alias("follows"))
    sent = with_anchors(blocked, "text", "anchors").select(
        "doc_id", "text", "anchors", F.explode(F.when(F.col("_head"), F.array(stays, follows)).otherwise(F.array(stays))).alias("_to")
    )
    order = Window.partitionBy("_to.block").orderBy("_to.follows", F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    led = sent.select(
        "doc_id", "text", "anchors", F.lead("text").over(order).alias("next_text"),
        F.lead("anchors").over(order).alias("next_anchors"), F.col("_to.follows").alias("_follows"),
    )
    return led.where(~F.col("_follows")).drop("_follows")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars and fingerprint of each document; digest and fingerprint of its edited text, whose last half
    (rounded down) is replaced by as much of the beginning of the next document; likeness to both. An empty table gives
    no rows; a document that is alone is followed by itself."""
    half = followed(docs).withColumn("n_chars", F.length("text").cast("long"))
    edited = half.withColumn(
        "edited",
        F.expr("concat(substring(text, 1, int(n_chars - n_chars div 2)), substring(next_text, 1, int(n_chars div 2)))"),
    )
    done = with_anchors(edited, "edited", "edited_anchors")
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        printed(F.col("anchors")).alias("fingerprint"),
        printed(F.col("edited_anchors")).alias("edited_fingerprint"),
        likeness(hashes(F.col("anchors")), hashes(F.col("edited_anchors"))).alias("near_edited"),
        likeness(hashes(F.col("anchors")), hashes(F.col("next_anchors"))).alias("near_next"),
    )
