"""Ranked lexical search by Block-Max MaxScore over an index of shards.

The index is built in one pass over the texts: each task cuts its documents into shards of bounded size and writes, for
every term of a shard, one row with its postings in blocks of 128 (document numbers as differences, and frequencies, as
variable-length bytes) and for each block its last document, the highest frequency and the fewest terms of a document. The bounds
hold whatever the corpus's averages are, so that shards can be added later.

A query's lists are ordered by what they can add to a score at most. Once a shard has k documents, lists whose bounds
together stay below the k-th score are not essential: only documents of the other lists are candidates. Block maxima of the
remaining lists reject most of them before a block is decompressed. The heaps of all shards are merged in two steps.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import shared_folder, staged

# Terms are runs of ASCII letters, digits and anything beyond ASCII; only A to Z are lower-cased.
SEPARATORS = [*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]
TABLE = bytes(0x20 if b in SEPARATORS else b + 0x20 if 0x41 <= b <= 0x5A else b for b in range(256))

# A shard ends after so many documents or bytes of text, whichever comes first.
SHARD_DOCS, SHARD_BYTES = 1 << 14, 16 << 20
BLOCK = 128
# Shards that one task searches: their lists are small, so that Spark would put far too many into one by their size.
SHARDS_A_TASK = 4
# Documents that are scored together; the k-th score is updated after each.
WINDOW = 1 << 10
# Bytes of query terms that are looked up at once; they go to all tasks.
QUERY_BYTES = 1 << 20


def terms_of(text: str | None) -> list[bytes]:
    return text.encode().translate(TABLE).split() if text else []


# --- index -------------------------------------------------------------------------------------------------------


def packed_numbers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers as bytes of seven bits, the lowest first and the last of each marked, and where each number ends."""
    size = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 63, 7):
        more = values >= 1 << bits
        if not more.any():
            break
        size += more
    ends = np.cumsum(size)
    data = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    first = ends - size
    for k in range(int(size.max(initial=0))):
        has = size > k
        data[first[has] + k] = values[has] >> 7 * k & 127
    data[ends - 1] |= 128
    return data, ends


def unpacked_numbers(data: np.ndarray) -> np.ndarray:
    ends = np.flatnonzero(data & 128)
    low = (data & 127).astype(np.int64)
    if len(ends) == len(data):
        return low
    first = np.concatenate(([0], ends[:-1] + 1))
    shift = np.arange(len(data)) - np.repeat(first, ends - first + 1)
    return np.add.reduceat(low << 7 * shift, first)


class Shard:
    """Documents whose postings are gathered until the shard is full."""

    def __init__(self):
        self.ids: list = []
        self.vocabulary: dict[bytes, int] = {}
        self.codes, self.lengths, self.bytes = array("I"), array("q"), 0

    def add(self, key: object, text: str | None) -> None:
        terms, vocabulary = terms_of(text), self.vocabulary
        self.codes.extend([vocabulary.setdefault(term, len(vocabulary)) for term in terms])
        self.ids.append(key)
        self.lengths.append(len(terms))
        self.bytes += 4 * len(text or "")

    def full(self) -> bool:
        return len(self.ids) >= SHARD_DOCS or self.bytes >= 4 * SHARD_BYTES

    def rows(self, number: int, id_type: pa.DataType, step: int = 2048) -> Iterator[pa.RecordBatch]:
        """One row for the documents (a null term) and one for each term."""
        lengths = np.frombuffer(self.lengths, dtype=np.int64)
        nothing = {"docs": None, "tfs": None, "last": None, "docs_end": None, "tfs_end": None, "most": None, "fewest": None}
        whole = {
            "shard": number, "term": None, "n": int((lengths > 0).sum()), "total": int(lengths.sum()), **nothing,
            "ids": self.ids, "lengths": lengths.tolist(),
        }
        schema = index_schema(id_type)
        yield pa.RecordBatch.from_pylist([whole], schema=schema)
        if not self.vocabulary:
            return
        docs = len(self.ids)
        codes = np.frombuffer(self.codes, dtype=np.uint32).astype(np.int64)
        key, tf = np.unique(codes * docs + np.repeat(np.arange(docs), lengths), return_counts=True)
        del codes
        term, doc = key // docs, key % docs
        bounds = np.searchsorted(term, np.arange(len(self.vocabulary) + 1))
        within = np.arange(len(term)) - bounds[term]
        starts = np.flatnonzero(within % BLOCK == 0)
        step_to = doc.copy()
        step_to[1:] -= np.where(within[1:] % BLOCK == 0, 0, doc[:-1])
        doc_data, doc_ends = packed_numbers(step_to)
        tf_data, tf_ends = packed_numbers(tf)
        ends = np.append(starts[1:], len(term)) - 1
        blocks = np.searchsorted(starts, bounds)
        of = term[starts]
        doc_at, tf_at = (np.concatenate(([0], e))[bounds] for e in (doc_ends, tf_ends))
        names = pa.array(list(self.vocabulary), pa.binary()).cast(pa.string())
        lists = [
            (pa.int32(), doc[ends]),
            (pa.int32(), doc_ends[ends] - doc_at[of]),
            (pa.int32(), tf_ends[ends] - tf_at[of]),
            (pa.int64(), np.maximum.reduceat(tf, starts)),
            (pa.int64(), np.minimum.reduceat(lengths[doc], starts)),
        ]
        total = np.add.reduceat(tf, bounds[:-1])
        for lo in range(0, len(names), step):
            hi = min(lo + step, len(names))
            at = pa.array((blocks[lo : hi + 1] - blocks[lo]).astype(np.int32))
            cut = [
                pa.ListArray.from_arrays(at, pa.array(v[blocks[lo] : blocks[hi]], kind)) for kind, v in lists
            ]
            columns = [
                pa.array([number] * (hi - lo), pa.int64()),
                names[lo:hi],
                pa.array(np.diff(bounds[lo : hi + 1]), pa.int64()),
                pa.array(total[lo:hi], pa.int64()),
                binaries(doc_data, doc_at[lo : hi + 1]),
                binaries(tf_data, tf_at[lo : hi + 1]),
                *cut,
                pa.nulls(hi - lo, pa.list_(id_type)),
                pa.nulls(hi - lo, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)


def binaries(data: np.ndarray, at: np.ndarray) -> pa.Array:
    offsets = (at - at[0]).astype(np.int32)
    return pa.Array.from_buffers(
        pa.binary(), len(at) - 1, [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data[at[0] : at[-1]].tobytes())]
    )


INDEX = (
    "shard long, term string, n long, total long, docs binary, tfs binary, last array<int>, docs_end array<int>, "
    "tfs_end array<int>, most array<long>, fewest array<long>, ids array<{id_type}>, lengths array<long>"
)


def index_schema(id_type: pa.DataType) -> pa.Schema:
    whole, small = pa.list_(pa.int64()), pa.list_(pa.int32())
    kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), small, small, small, whole, whole]
    names = [part.split()[0] for part in INDEX.split(", ")]
    return pa.schema(list(zip(names, [*kinds, pa.list_(id_type), whole], strict=True)))


def indexed(docs: DataFrame) -> DataFrame:
    """The index of ``docs`` (doc_id, text, more): a row per shard and term, and one per shard for its documents.

    It has to be written before it is searched: shards are numbered by the task that made them. Null and empty texts have
    no terms but are documents of their shard; a very long text fills a shard of its own. Null and repeated ids stay as
    they are. Other columns are not read; no rows, no shards.
    """

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, shard, id_type = TaskContext.get().partitionId() << 32, Shard(), None
        for batch in batches:
            id_type = batch.schema.field("doc_id").type
            for key, text in zip(batch.column("doc_id"), batch.column("text"), strict=True):
                shard.add(key.as_py(), text.as_py())
                if shard.full():
                    yield from shard.rows(number, id_type)
                    number, shard = number + 1, Shard()
        if shard.ids:
            yield from shard.rows(number, id_type)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(build, INDEX.format(id_type=id_type))


# --- search ------------------------------------------------------------------------------------------------------


class Corpus:
    """What a score needs to know of the whole corpus: documents with terms, and all their terms."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def length_factor(self, lengths: Iterable[int]) -> np.ndarray:
        """In whole numbers of any size first: length times documents may pass 64 bits."""
        return np.array([75 + 25 * n * self.documents // self.terms for n in lengths], dtype=np.int64)


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


class Postings:
    """One term's list in a shard; blocks are decompressed when they are first needed."""

    def __init__(self, row: dict, corpus: Corpus, m: np.ndarray):
        self.m = m
        self.last = np.array(row["last"], dtype=np.int64)
        self.top = impact(np.array(row["most"], dtype=np.int64), corpus.length_factor(row["fewest"]))
        self.bound = int(self.top.max())
        self.data = np.frombuffer(row["docs"], dtype=np.uint8), np.frombuffer(row["tfs"], dtype=np.uint8)
        self.ends = [0, *row["docs_end"]], [0, *row["tfs_end"]]
        # Until a block is known, all its places hold its last document: the whole stays in order.
        self.docs = np.repeat(self.last, BLOCK)[: row["n"]]
        self.gain = np.zeros(row["n"], dtype=np.int64)
        self.known = np.zeros(len(self.last), dtype=bool)

    def know(self, blocks: Iterable[int]) -> None:
        for b in blocks:
            if not self.known[b]:
                docs, tfs = (
                    unpacked_numbers(data[ends[b] : ends[b + 1]]) for data, ends in zip(self.data, self.ends, strict=True)
                )
                at = slice(b * BLOCK, b * BLOCK + len(docs))
                self.docs[at] = np.cumsum(docs)
                self.gain[at] = impact(tfs, self.m[self.docs[at]])
                self.known[b] = True

    def between(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``lo`` to ``hi`` and what they gain."""
        first, end = np.searchsorted(self.last, (lo, hi - 1)).tolist()
        end = min(end + 1, len(self.last))
        self.know(range(first, end))
        part = self.docs[first * BLOCK : end * BLOCK]
        a, b = np.searchsorted(part, (lo, hi)) + first * BLOCK
        return self.docs[a:b], self.gain[a:b]

    def block_tops(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The block in which each document would be, and the most that it can gain there."""
        block = np.searchsorted(self.last, docs)
        return block, np.append(self.top, 0)[block]

    def gains(self, docs: np.ndarray, block: np.ndarray) -> np.ndarray:
        self.know(np.unique(block[block < len(self.last)]).tolist())
        at = np.minimum(np.searchsorted(self.docs, docs), len(self.docs) - 1)
        return np.where(self.docs[at] == docs, self.gain[at], 0)


def best(lists: list[tuple[int, Postings]], docs: int, order: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The ``k`` documents with the highest scores above 0, as (score, document), equal ones by ``order``."""
    lists = sorted(lists, key=lambda x: x[0] * x[1].bound)
    upto = np.cumsum([w * p.bound for w, p in lists])
    score, found, least = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1
    for lo in range(0, docs, WINDOW):
        hi = min(lo + WINDOW, docs)
        # Documents that only the first lists hold stay below the k-th score.
        other = int(np.searchsorted(upto, least))
        if other == len(lists):
            break
        total = np.zeros(hi - lo, dtype=np.int64)
        for w, p in lists[other:]:
            at, gain = p.between(lo, hi)
            total[at - lo] += w * gain
        at = np.flatnonzero(total) if other else np.flatnonzero(total >= least)
        if other and len(at):
            total, at = total[at], at + lo
            keep = total + upto[other - 1] >= least
            total, at = total[keep], at[keep]
            tops = [p.block_tops(at) for _, p in lists[:other]]
            blocks = [block for block, _ in tops]
            rest = np.cumsum([w * top for (w, _), (_, top) in zip(lists, tops, strict=False)], axis=0)
            for i in range(other - 1, -1, -1):
                keep = total + rest[i] >= least
                if not keep.all():
                    total, at, rest = total[keep], at[keep], rest[:, keep]
                    blocks = [block[keep] for block in blocks[: i + 1]]
                if not len(at):
                    break
                w, p = lists[i]
                total = total + w * p.gains(at, blocks[i])
            at, total = at[total >= least], total[total >= least]
        else:
            at, total = at + lo, total[at]
        if len(at):
            score, found = np.append(score, total), np.append(found, at)
            if len(score) > k:
                first = np.lexsort((order[found], -score))[:k]
                score, found = score[first], found[first]
            if len(score) == k:
                least = int(score.min())
    return list(zip(score.tolist(), found.tolist(), strict=True))


def shard_hits(
    rows: list[dict], queries: list[tuple[int, dict[str, int]]], weight: dict[str, int], corpus: Corpus, k: int
) -> list[tuple[int, object, int]]:
    """(query, document id, score) of the best documents of one shard for each query."""
    whole = next(row for row in rows if row["term"] is None)
    ids, m = whole["ids"], corpus.length_factor(whole["lengths"])
    by_id = sorted(range(len(ids)), key=lambda i: (ids[i] is None, 0 if ids[i] is None else ids[i]))
    order = np.empty(len(ids), dtype=np.int64)
    order[by_id] = np.arange(len(ids))
    lists = {row["term"]: Postings(row, corpus, m) for row in rows if row["term"] is not None}
    hits = []
    for query, terms in queries:
        mine = [(weight[t] * times, lists[t]) for t, times in terms.items() if t in lists and weight[t]]
        hits += [(query, ids[doc], score) for score, doc in best(mine, len(ids), order, k)] if mine else []
    return hits


Query = tuple[int, object, dict[str, int]]  # its number, its id, its terms and how often each occurs


def blocks_of(queries: DataFrame) -> Iterator[list[Query]]:
    """The queries in blocks of ``QUERY_BYTES`` of terms, or of one query; those without terms are left out."""
    block, held = [], 0
    for number, row in enumerate(queries.select("item_id", "text").toLocalIterator()):
        terms = Counter(term.decode() for term in terms_of(row["text"]))
        if not terms:
            continue
        size = sum(map(len, terms))
        if block and held + size > QUERY_BYTES:
            yield block
            block, held = [], 0
        block.append((number, row["item_id"], terms))
        held += size
    if block:
        yield block


def block_hits(index: DataFrame, block: list[Query], corpus: Corpus, k: int, tasks: int) -> DataFrame:
    """The best documents of each shard for the queries of one block, searched in so many tasks."""
    spark = index.sparkSession
    names = sorted({term for _, _, terms in block for term in terms})
    # As large as the block at most.
    wanted = F.broadcast(spark.createDataFrame([(name, True) for name in names], "term string, wanted boolean"))
    lists = index.join(wanted, "term", "left").where("wanted or term is null")
    found = lists.where("term is not null").groupBy("term").agg(F.sum("n").alias("n")).collect()
    weight = {row["term"]: corpus.weight(row["n"]) for row in found}
    queries = [(number, terms) for number, _, terms in block]

    def search(table: pa.Table) -> pa.Table:
        shard, id_type = table.column("shard")[0].as_py(), table.schema.field("ids").type.value_type
        hits = shard_hits(table.to_pylist(), queries, weight, corpus, k)
        query, doc, score = zip(*hits, strict=True) if hits else ((), (), ())
        columns = {
            "query": pa.array(query, pa.int64()),
            "doc_id": pa.array(doc, id_type),
            "score": pa.array(score, pa.int64()),
            "shard": pa.array([shard] * len(hits), pa.int64()),
        }
        return pa.table(columns)

    id_type = index.schema["ids"].dataType.elementType.simpleString()
    return lists.drop("wanted").repartition(tasks, "shard").groupBy("shard").applyInArrow(
        search, f"query long, doc_id {id_type}, score long, shard long"
    )


def searched(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best documents of the index for each row of ``queries`` (item_id, text, more): item_id, rank, doc_id, score.

    Queries are taken in blocks of bounded size, each against the whole index. Equal scores come by ascending id, null
    last; documents that share id and score are listed each. A query without terms, or whose terms no document holds, has
    no rows; one that occurs twice is ranked twice. A term that nearly all documents hold weighs nothing.
    """
    spark = index.sparkSession
    whole = index.where("term is null")
    sums = whole.agg(F.sum("n").alias("n"), F.sum("total").alias("total"), F.count("*").alias("shards")).first()
    corpus = Corpus(sums["n"] or 0, sums["total"] or 0)
    tasks = -(-sums["shards"] // SHARDS_A_TASK) or 1
    item_type = queries.schema["item_id"].dataType.simpleString()
    id_type = index.schema["ids"].dataType.elementType.simpleString()
    folder = shared_folder(spark, "hits")
    for block in blocks_of(queries) if corpus.documents else ():
        items = spark.createDataFrame([(n, item) for n, item, _ in block], f"query long, item_id {item_type}")
        made = block_hits(index, block, corpus, k, tasks).join(F.broadcast(items), "query")
        made.write.mode("append").parquet(folder)
    hits = f"query long, doc_id {id_type}, score long, shard long, item_id {item_type}"
    spark.createDataFrame([], hits).write.mode("append").parquet(folder)  # a folder even where nothing was found
    best_hits = spark.read.schema(hits).parquet(folder)
    # First among some shards, then among all of them.
    for keys in (("query", F.pmod("shard", F.lit(64))), ("query",)):
        order = Window.partitionBy(*keys).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        best_hits = best_hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return best_hits.select("item_id", "rank", "doc_id", "score")


def ranked(docs: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """The ``k`` best rows of ``docs`` (doc_id, text, more) for each query; see :func:`searched`."""
    return searched(staged(indexed(docs), "index"), queries, k)


# The same rows as DuckDB SQL, for comparison.
SQL = r"""
WITH texts AS (
    SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'),
           '{pattern}') AS terms FROM documents),
wanted AS (
    SELECT item_id, term, count(*) AS times FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '{pattern}')) AS term
        FROM benchmark) GROUP BY ALL),
corpus AS (
    SELECT count(*) FILTER (len(terms) > 0) AS n, CAST(sum(len(terms)) AS BIGINT) AS l FROM texts),
postings AS (
    SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(terms) AS term FROM texts)
    WHERE term IN (SELECT term FROM wanted) GROUP BY ALL),
weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, corpus GROUP BY term, n),
scored AS (
    SELECT item_id, d, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 *
           (100 - 25 + (25 * len(terms) * n) // l)))) AS BIGINT) AS score
    FROM wanted JOIN postings USING (term) JOIN weights USING (term) JOIN texts USING (d), corpus
    GROUP BY item_id, d),
ranked AS (
    SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score
    FROM scored JOIN texts USING (d) WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= {k}
"""
# Fixed value: terms as a pattern.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def sql(k: int) -> str:
    upper = "".join(map(chr, range(0x41, 0x5B)))
    return SQL.format(upper=upper, lower=upper.lower(), pattern=TERM, k=k)
