"""Near duplicates by SimHash, found by the generalised pigeonhole principle.

A fingerprint has 64 bits; two link if at most ``distance`` bits differ. The bits are dealt into groups, bits that vary
together into the same one, and each group gets a threshold of its own, -1 or more, that sum up to
``distance - groups + 1``: of two fingerprints that link, some group's bits differ in no more than its threshold. How
many groups there are and which thresholds they have is decided by dynamic programming on the number of candidates that
each choice is expected to bring. The expectation comes from how often each two bits agree over all fingerprints.

A fingerprint is then looked up, group by group, with all its variants within the threshold, and candidates are verified
bit by bit. A place where many fingerprints meet is not searched pair by pair: its fingerprints are compared by their
neighbours at one bit. Two of them differ in at most two bits exactly if they share such a neighbour, so all that
share one are linked to the least of them, without any pairs.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.common import inner_name, null_last, staged

BITS = 64
SHINGLE_WORDS = 3
DISTANCE = 2
SEED = 42
# Fingerprints that may meet in one place before they are compared by their neighbours instead of pair by pair.
CROWD = 64
# What a looked-up variant costs against a verified candidate: it is shuffled and sorted.
LOOKUP_COST = 4.0
# Shingles that are turned into bits at once.
CHUNK = 1 << 16


def fingerprint(text: str | None, words: int = SHINGLE_WORDS, seed: int = SEED) -> int:
    """SimHash of a text: a bit is set if over half of the shingles' hashes have it. Null or no words: 0."""
    # Bytes lower-case and split on ASCII only.
    parts = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not parts:
        return 0
    joined = b" ".join(parts)
    if len(parts) <= words:
        return xxhash.xxh64_intdigest(joined, seed)
    lengths = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
    starts = np.cumsum(lengths + 1) - (lengths + 1)
    ends = (starts + lengths)[words - 1 :].tolist()
    number, digest = len(ends), xxhash.xxh64_intdigest
    counts = np.zeros(BITS, dtype=np.int64)
    starts = starts.tolist()
    for at in range(0, number, CHUNK):
        spans = zip(starts[at : at + CHUNK], ends[at : at + CHUNK], strict=False)
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > number, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, words: int = SHINGLE_WORDS, seed: int = SEED) -> Column:
    """The fingerprint as a long (its 64 bits, signed)."""

    @pandas_udf("long")
    def compute(texts: pd.Series) -> pd.Series:
        values = np.fromiter((fingerprint(t, words, seed) for t in texts), dtype=np.uint64, count=len(texts))
        return pd.Series(values.view(np.int64))

    return compute(text)


def hexadecimal(value: Column) -> Column:
    return F.lower(F.lpad(F.hex(value), 16, "0"))


# --- the search plan ---------------------------------------------------------------------------------------------


def bit_counts(values: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints (column ``fp``) and, for each two bits, how many have both. All rows are counted; 4 096
    sums reach the driver whatever the input."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((BITS, BITS), dtype=np.int64)
        for batch in batches:
            values = np.ascontiguousarray(batch.column(0).to_numpy(zero_copy_only=False)).astype("<i8")
            bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
        cells = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cells.astype(np.int32)), pa.array(total.ravel()[cells])], names=["cell", "n"]
        )

    counts = values.select("fp").mapInArrow(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    both = np.zeros(BITS * BITS, dtype=np.int64)
    for cell, n in counts.collect():
        both[cell] = n
    return values.count(), both.reshape(BITS, BITS)


def agreement(number: int, both: np.ndarray) -> np.ndarray:
    """For each two bits the chance that two random fingerprints agree in both of them."""
    n = max(number, 1)
    p11 = both / n
    ones = np.diag(p11)
    p10 = ones[:, None] - p11
    p01 = ones[None, :] - p11
    p00 = 1 - p11 - p10 - p01
    return p11**2 + p10**2 + p01**2 + p00**2


def deal_bits(agree: np.ndarray, groups: int) -> list[list[int]]:
    """Groups of bits of about equal size; each is a chain along which the next bit is the one most tied to the last."""
    alone = np.diag(agree)
    tie = np.abs(agree - np.outer(alone, alone))
    left, dealt = set(range(BITS)), []
    for size in (BITS // groups + (i < BITS % groups) for i in range(groups)):
        rest = sorted(left)
        chain = [max(rest, key=lambda b: (tie[b, rest].sum(), -b))]
        left.remove(chain[0])
        while len(chain) < size:
            chain.append(max(sorted(left), key=lambda b: (tie[chain[-1], b], -b)))
            left.remove(chain[-1])
        dealt.append(chain)
    return dealt


def differing(agree: np.ndarray, chain: list[int], most: int) -> list[float]:
    """Chance that two random fingerprints differ in at most 0, 1, ... ``most`` bits of a group: a Markov chain over
    its bits, whose steps are the chances that both neighbours agree, one does, or none."""
    alone = np.diag(agree)
    # state[a][d]: the last bit agrees (a = 1) or not, and d bits have differed
    state = np.zeros((2, most + 1))
    state[1][0] = alone[chain[0]]
    if most:
        state[0][1] = 1 - alone[chain[0]]
    for last, bit in zip(chain, chain[1:], strict=False):
        same = agree[last, bit]
        only = [max(alone[bit] - same, 0.0), same]
        base = [max(1 - alone[last], 1e-12), max(alone[last], 1e-12)]
        step = np.zeros_like(state)
        for a in (0, 1):
            stay = min(only[a] / base[a], 1.0)
            step[1] += state[a] * stay
            step[0][1:] += state[a][:-1] * (1 - stay)
        state = step
    return np.cumsum(state.sum(axis=0)).tolist()


def allocate(costs: list[list[float]], total: int) -> tuple[float, list[int]]:
    """The cheapest thresholds that sum up to ``total``; costs[g][t + 1] is the cost of threshold t for group g."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for group in costs:
        after: dict[int, tuple[float, list[int]]] = {}
        for done, (cost, chosen) in best.items():
            for t, more in enumerate(group, start=-1):
                way = (cost + more, [*chosen, t])
                if done + t not in after or way < after[done + t]:
                    after[done + t] = way
        best = after
    return best[total]


def variants(chain: list[int], threshold: int) -> list[int]:
    """All patterns of at most ``threshold`` of a group's bits."""
    return [sum(1 << b for b in some) for k in range(threshold + 1) for some in combinations(chain, k)]


def search_plan(number: int, both: np.ndarray, distance: int = DISTANCE) -> list[tuple[list[int], int]]:
    """Groups and thresholds for the search; groups with threshold -1 are not looked up."""
    agree = agreement(number, both)
    plans = []
    for groups in range(1, 2 * distance + 3):
        chains = deal_bits(agree, groups)
        costs = []
        for chain in chains:
            chance = differing(agree, chain, distance)
            looked = [len(variants(chain, t)) for t in range(distance + 1)]
            costs.append([0.0, *[LOOKUP_COST * number * looked[t] + number * number / 2 * chance[t] for t in range(distance + 1)]])
        cost, thresholds = allocate(costs, distance - groups + 1)
        plans.append((cost, groups, [(c, t) for c, t in zip(chains, thresholds, strict=True) if t >= 0]))
    return min(plans)[2]


# --- links and components ----------------------------------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << 64) if value >= 1 << 63 else value


def _lookups(values: DataFrame, plan: list[tuple[list[int], int]], near: bool) -> DataFrame:
    """A row (place, key, fp) for each group, and with ``near`` for each variant within its threshold."""
    keys = []
    for place, (chain, threshold) in enumerate(plan):
        mask = sum(1 << b for b in chain)
        for flip in variants(chain, threshold if near else 0):
            key = F.col("fp").bitwiseXOR(F.lit(_signed(flip))).bitwiseAND(F.lit(_signed(mask)))
            keys.append(F.struct(F.lit(place).alias("place"), key.alias("key")))
    return values.select("fp", F.explode(F.array(*keys)).alias("at")).select("at.place", "at.key", "fp")


def links(values: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """Links (u < v) between distinct fingerprints (column ``fp``) that connect all that are within ``distance`` bits.

    Every two that are near are linked directly, or, where more than ``crowd`` meet, by way of one near both.
    """
    if distance not in (1, 2):
        raise ValueError("crowded places are searched exactly for a distance of 1 or 2")
    number, both = bit_counts(values)
    plan = search_plan(number, both, distance)
    index = _lookups(values, plan, near=False)
    probes = _lookups(values, plan, near=True)
    crowded = index.groupBy("place", "key").count().where(F.col("count") > crowd).select("place", "key")
    a = index.join(crowded, ["place", "key"], "left_anti").withColumnRenamed("fp", "u")
    b = probes.join(crowded, ["place", "key"], "left_anti").withColumnRenamed("fp", "v")
    apart = F.bit_count(F.col("u").bitwiseXOR(F.col("v")))
    verified = a.join(b, ["place", "key"]).where((F.col("u") < F.col("v")) & (apart <= distance)).select("u", "v")
    many = probes.join(crowded, ["place", "key"], "left_semi").select("fp").distinct()
    around = [0, *[_signed(1 << b) for b in range(BITS)]]
    spots = many.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(x)) for x in around])).alias("spot"))
    if distance == 2:
        met = spots.groupBy("spot").agg(F.min("fp").alias("u"), F.count("*").alias("n")).where("n > 1")
    else:  # at one bit the spot must itself be one of the two
        met = many.select(F.col("fp").alias("u"), F.col("fp").alias("spot"))
    starred = spots.withColumnRenamed("fp", "v").join(met, "spot").where("u < v").select("u", "v")
    return verified.unionByName(starred).distinct()


def components(edges: DataFrame) -> DataFrame:
    """Each vertex (``u``) of the links, except the least of its component, with that least vertex (``v``).

    Large-star and small-star steps in turn, each written to the shared folder, until the links no longer change. The
    driver sees a count and a checksum for each round.
    """

    def least_neighbours(pairs: DataFrame) -> DataFrame:
        return pairs.groupBy("u").agg(F.min("v").alias("least"))

    def large_star(pairs: DataFrame) -> DataFrame:
        ways = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        found = ways.join(least_neighbours(ways), "u").where("v > u")
        return found.select(F.col("v").alias("u"), F.least("u", "least").alias("v")).distinct()

    def small_star(pairs: DataFrame) -> DataFrame:
        ways = pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        found = ways.join(least_neighbours(ways), "u")
        moved = found.where("v != least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        return moved.unionByName(found.select("u", F.col("least").alias("v"))).distinct()

    def state(pairs: DataFrame) -> tuple:
        return tuple(pairs.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    pairs = staged(edges, "links")
    now, before = state(pairs), None
    while now != before:
        pairs = staged(small_star(large_star(pairs)), "stars")
        before, now = now, state(pairs)
    return pairs


def classes(printed: DataFrame, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """One row for each distinct fingerprint of ``printed`` (doc_id, fp): fp, the ``root`` fingerprint of its component
    and ``component_id``, the smallest id that can be reached. A null id never is the smallest; a component of null ids
    only has a null id."""
    distinct = staged(printed.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "prints")
    roots = components(links(distinct, distance, crowd)).select(F.col("u").alias("fp"), F.col("v").alias("root"))
    rooted = distinct.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, crowd: int = CROWD) -> DataFrame:
    """doc_id, ``fingerprint`` and ``component_id`` of each row of ``docs`` (doc_id, text). Null and empty texts have
    fingerprint 0 and are linked like any other; repeated rows come back repeated; an empty table gives no rows."""
    printed = staged(docs.select("doc_id", fingerprints(F.col("text"), words).alias("fp")), "simhash")
    found = printed.join(classes(printed, distance, crowd), "fp")
    return found.select("doc_id", hexadecimal(F.col("fp")).alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, words: int = SHINGLE_WORDS, distance: int = DISTANCE, crowd: int = CROWD
) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id, and of rows that share that id
    the first by fingerprint and text. Where all ids are null, the first by fingerprint and text."""
    fp, row, key, place = (inner_name(docs.columns, name) for name in ("fp", "row", "key", "place"))
    printed = staged(docs.select(F.struct("*").alias(row), "doc_id", fingerprints(F.col("text"), words).alias(fp)), "simhash")
    found = classes(printed.select("doc_id", F.col(fp).alias("fp")), distance, crowd)
    members = printed.select("doc_id", F.col(fp).alias("fp")).join(found, "fp")
    chosen = members.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root", "component_id")
    keep = chosen.agg(F.min("fp").alias(fp)).select(fp, null_last("component_id").alias(key))
    # The join and the choice among rows of one id need the same partitioning, so the texts move once.
    joined = printed.withColumn(key, null_last("doc_id")).join(keep, [fp, key])
    first = Window.partitionBy(fp, key).orderBy(F.col(f"{row}.text"))
    return joined.withColumn(place, F.row_number().over(first)).where(F.col(place) == 1).select(f"{row}.*")
