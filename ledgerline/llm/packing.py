"""Best-fit packing of tokenised documents into sequences.

How many bins of which pattern (so many pieces of this length, so many of that) are used is decided on the histogram
of piece lengths alone: the configuration linear program is solved by multiplicative weights, where a knapsack dynamic
program finds the patterns that are worth most under the current weights of the lengths, the solution is rounded down,
and the pieces left over are packed best fit decreasing, many equal bins at a time. The histogram has at most as many
entries as a sequence has tokens, whatever the corpus holds.

Each piece has a rank among those of its length, which gives its sequence and its place in it. Tasks number their pieces
by length while they cut them, in blocks of bounded size, and only the sizes of the blocks are summed up. So no length, id
or text that many pieces share meets in one task.
"""

from __future__ import annotations

import string
import sys
import zlib
from array import array
from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from tokenizers import Tokenizer

from ledgerline.llm.common import staged, worker_memory

CAPACITY = 2048
END = 0
# Pieces that are numbered together.
BLOCK_PIECES = 1 << 16

# --- tokens ------------------------------------------------------------------------------------------------------

# Bytes that the words kept with their ids may take in a Python worker, and the parts that words are split into; what is
# longer than LONGEST_KEPT is not kept.
WORD_BYTES, PART_BYTES, LONGEST_KEPT = 96 << 20, 32 << 20, 64
# What an entry of a dictionary takes beside key and value.
ENTRY_BYTES = 104
# Fixed value: the pattern by which the tokenizer splits lower-cased text into parts.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+"


class Kept(dict):
    """A dictionary that fills itself and keeps what it met first, up to so many bytes."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.left = make, most

    def __missing__(self, key: str) -> bytes:
        value = self.make(key)
        if self.left > 0 and len(key) <= LONGEST_KEPT:
            self.left -= sys.getsizeof(key) + sys.getsizeof(value) + ENTRY_BYTES
            self[key] = value
        return value


class WordEncoder:
    """Ids of whole texts, as little-endian 32-bit bytes, from the ids of their words.

    The tokenizer never looks beyond white space, so that words can be encoded one by one and kept. Words in Latin letters
    are lower-cased and split into parts as the tokenizer's pattern does, and its model gives the ids of each part.
    Words with other letters, control characters or what may be a special token are left to the whole tokenizer.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.pattern = regex.compile(PARTS)
        # The byte alphabet of the vocabulary: printable Latin-1 stands for itself, other bytes follow from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {**{b: b for b in plain}, **{b: 256 + i for i, b in enumerate(rest)}}
        self.words = Kept(self._word, WORD_BYTES)
        self.parts = Kept(self._part, PART_BYTES)

    def encode(self, text: str) -> bytes:
        return b"".join(map(self.words.__getitem__, text.replace("\n", " ").split(" ")))

    def _word(self, word: str) -> bytes:
        if word.isascii():
            low = word.lower()
        elif max(word) <= "ɏ":
            low = self.tokenizer.normalizer.normalize_str(word)
        else:
            low = "<|"
        stem = low.rstrip(string.punctuation)
        if stem.isalpha():
            return self.parts[stem] + self.parts[low[len(stem) :]] if len(stem) < len(low) else self.parts[low]
        if "<|" in low or not word.isprintable():
            return np.array(self.tokenizer.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()
        return b"".join(map(self.parts.__getitem__, self.pattern.findall(low)))

    def _part(self, part: str) -> bytes:
        if not part.isascii():
            part = part.encode("utf-8").decode("latin-1").translate(self.alphabet)
        return array("I", [token.id for token in self.model.tokenize(part)]).tobytes()


def worker_encoder(path: str) -> WordEncoder:
    """The encoder of this Python worker; it outlives the task, so that the words it has met stay known."""
    kept = worker_memory()
    if path not in kept:
        kept[path] = WordEncoder(path)
    return kept[path]


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of each row of ``docs`` (doc_id, text, more): doc_id, piece, start, length, ids_crc32, and block and rank,
    the piece's number from 0 among those of its length in its block; if asked for, ``ids`` (binary, little-endian
    unsigned 32-bit). Null and empty texts have one piece, the end token. Null ids are kept, repeated rows cut each, other
    columns left behind; no rows, no pieces. Blocks are numbered by task, so write the pieces before they are used."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = worker_encoder(tokenizer_path)
        end, step = END.to_bytes(4, "little"), 4 * capacity
        block, held, ranks = TaskContext.get().partitionId() << 32, 0, defaultdict(int)
        for batch in batches:
            if held >= BLOCK_PIECES:
                block, held, ranks = block + 1, 0, defaultdict(int)
            doc, piece, length, rank, check, ids = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text").to_pylist()):
                data = (encoder.encode(text) if text else b"") + end
                for number, at in enumerate(range(0, len(data), step)):
                    part = data[at : at + step]
                    doc.append(row)
                    piece.append(number)
                    length.append(len(part) // 4)
                    rank.append(ranks[length[-1]])
                    ranks[length[-1]] += 1
                    check.append(zlib.crc32(part))
                    if with_ids:
                        ids.append(part)
            columns = {
                "doc_id": batch.column("doc_id").take(pa.array(doc, pa.int64())),
                "piece": pa.array(piece, pa.int32()),
                "start": pa.array([p * capacity for p in piece], pa.int64()),
                "length": pa.array(length, pa.int64()),
                "ids_crc32": pa.array(check, pa.int64()),
            }
            held += len(doc)
            columns |= {"block": pa.array([block] * len(doc), pa.int64()), "rank": pa.array(rank, pa.int64())}
            if with_ids:
                columns["ids"] = pa.array(ids, pa.binary())
            yield pa.RecordBatch.from_pydict(columns)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long, block long, rank long"
    schema += ", ids binary" * with_ids
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


# --- patterns ----------------------------------------------------------------------------------------------------

Pattern = tuple[tuple[int, int], ...]  # (length, how many), the longest first

ROUNDS = 160  # knapsack programs
WAYS = 32  # patterns taken from each
SLACK = 0.002  # how far from the best a pattern may be worth
SHARPNESS = 2.0  # how fast covered lengths lose weight
SHARE = 0.9  # of each length's demand; the rest is what rounding completes the bins with


def knapsack(worth: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best worth for each capacity up to ``len(worth) - 1``, and the length taken first (0: a token left free);
    ``worth[l]`` is that of one piece of length l, minus infinity where there is none."""
    best = np.zeros(len(worth))
    first = np.zeros(len(worth), dtype=np.int64)
    for c in range(1, len(worth)):
        ways = best[:c][::-1] + worth[1 : c + 1]
        way = int(np.argmax(ways))
        if ways[way] > best[c - 1]:
            best[c], first[c] = ways[way], way + 1
        else:
            best[c] = best[c - 1]
    return best, first


def fractional(counts: dict[int, int], capacity: int) -> dict[Pattern, float]:
    """Patterns and how often each is used, an approximate solution of the configuration linear program for ``SHARE``
    of the demand.

    A length starts with its own size as weight, the dual solution when all bins are full, and loses weight as patterns
    cover its demand. In each round the knapsack program prices all ways to fill a bin; a pattern is built from each of
    the best, no length is taken more often than it is left, and the pattern is used until half of what is left of its
    scarcest length is covered.
    """
    left = np.zeros(capacity + 1)
    for length, n in counts.items():
        left[length] = n * SHARE
    demand, sizes = left.copy(), np.arange(capacity + 1)
    used: dict[Pattern, float] = {}
    for _ in range(ROUNDS):
        open_ = left >= 1
        if not open_.any():
            break
        covered = 1 - np.divide(left, demand, out=np.zeros_like(left), where=open_)
        weight = sizes * np.exp(-SHARPNESS * (covered - covered[open_].min()) / capacity**0.5)
        worth = np.where(open_, weight, -np.inf)
        best, _ = knapsack(worth)
        starts = worth + best[::-1]
        good = np.flatnonzero(starts >= (1 - SLACK) * starts.max())
        for length in good[np.argsort(-left[good] * good, kind="stable")][:WAYS].tolist():
            if left[length] < 1:
                continue
            pattern, room = {length: 1}, capacity - length
            while room > 0:
                ways = worth[1 : room + 1] + best[:room][::-1]
                for spent, many in pattern.items():
                    if spent <= room and many + 1 > left[spent]:
                        ways[spent - 1] = -np.inf
                ways[left[1 : room + 1] < 1] = -np.inf
                if not len(ways) or ways.max() == -np.inf:
                    break
                # Of equal ways the one with the longest piece: short ones are what fills the last bins.
                pick = int(np.flatnonzero(ways >= ways.max() * (1 - 1e-9))[-1]) + 1
                pattern[pick] = pattern.get(pick, 0) + 1
                room -= pick
            if room:  # such bins are better made from what rounding leaves
                continue
            lengths = np.array(list(pattern))
            many = np.array(list(pattern.values()))
            times = float(np.maximum(left[lengths] / many / 2, 1).min())
            key = tuple(sorted(pattern.items(), reverse=True))
            used[key] = used.get(key, 0.0) + times
            left[lengths] -= times * many
    return used


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Best fit decreasing on a histogram: equal bins are filled together, so that the work goes with the number of
    lengths and not of pieces."""
    free: list[int] = []  # the room left that some bins have, in order
    bins: dict[int, list[tuple[list[tuple[int, int]], int]]] = {}

    def put(pattern: list[tuple[int, int]], room: int, many: int) -> None:
        if many:
            if room not in bins:
                bins[room] = []
                insort(free, room)
            bins[room].append((pattern, many))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect_left(free, length)
            if at < len(free):
                room = free[at]
                pattern, many = bins[room].pop()
                if not bins[room]:
                    del bins[room], free[at]
            else:
                each = capacity // length
                pattern, many, room = [], -(-left // each), capacity
            each = room // length
            full = min(many, left // each)
            put([*pattern, (length, each)], room - each * length, full)
            left -= full * each
            if full < many and left:  # one more takes the rest of this length
                put([*pattern, (length, left)], room - left * length, 1)
                full, left = full + 1, 0
            put(pattern, room, (many - full) if pattern else 0)
    return [(tuple(pattern), many) for groups in bins.values() for pattern, many in groups]


def solve(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[Pattern, int]]:
    """Patterns and their numbers of bins that hold exactly the pieces counted: those of the linear program, rounded and
    filled up, or, where these take more bins, those of best fit decreasing."""
    ways = rounded(counts, capacity), best_fit({length: n for length, n in counts.items() if n}, capacity)
    return min(ways, key=lambda patterns: sum(many for _, many in patterns))


def rounded(counts: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """The linear program's patterns, rounded down, and best fit decreasing for the pieces left over."""
    left = {length: n for length, n in counts.items() if n}
    chosen: list[tuple[Pattern, int]] = []
    for pattern, times in fractional(left, capacity).items() if left else ():
        many = min([int(times), *(left.get(length, 0) // a for length, a in pattern)])
        if many:
            chosen.append((pattern, many))
            for length, a in pattern:
                left[length] -= many * a
    return chosen + best_fit({length: n for length, n in left.items() if n}, capacity)


@dataclass
class Slots:
    """Where the n-th piece of a length goes, as sorted arrays: a run of slots for each pattern and length."""

    key: np.ndarray  # length and first rank of the run, in one number
    first: np.ndarray
    each: np.ndarray  # pieces of this length in a bin
    sequence: np.ndarray  # the pattern's first bin
    offset: np.ndarray  # where this length begins in the bin

    def place(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        run = np.searchsorted(self.key, (length << 40) + rank, side="right") - 1
        within = rank - self.first[run]
        return self.sequence[run] + within // self.each[run], self.offset[run] + within % self.each[run] * length


def slots(patterns: list[tuple[Pattern, int]]) -> Slots:
    ranks: dict[int, int] = {}
    runs, base = [], 0
    for pattern, many in patterns:
        offset = 0
        for length, each in pattern:
            first = ranks.get(length, 0)
            runs.append(((length << 40) + first, first, each, base, offset))
            ranks[length] = first + many * each
            offset += length * each
        base += many
    table = np.array(sorted(runs), dtype=np.int64).reshape(len(runs), 5)
    return Slots(*(np.ascontiguousarray(c) for c in table.T))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (length from 1 to ``capacity``, block, rank, more) with ``sequence_id`` and ``offset`` instead of block
    and rank, which are those of :func:`token_pieces`.

    It reads ``pieces`` twice, so hand it a written table. A column of the caller's named sequence_id or offset is
    replaced. No pieces, no rows.
    """
    carried = [c for c in pieces.columns if c.lower() not in ("block", "rank", "sequence_id", "offset")]
    blocks = pieces.groupBy("length", "block").agg(F.count("*").alias("n"))
    # At most one row for each length.
    counts = {r["length"]: r["n"] for r in blocks.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    plan = slots(solve(counts, capacity))
    before = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select("length", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))

    @pandas_udf("sequence_id long, offset long")
    def place(length: pd.Series, rank: pd.Series) -> pd.DataFrame:
        sequence, offset = plan.place(length.to_numpy(dtype=np.int64), rank.to_numpy(dtype=np.int64))
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    found = pieces.select("length", "block", "rank", F.struct(*carried).alias("piece")).join(starts, ["length", "block"])
    return found.select("piece", place("length", F.col("first") + F.col("rank")).alias("at")).select("piece.*", "at.*")


def packed(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of all documents with their sequences; see :func:`token_pieces` and :func:`pack`."""
    return pack(staged(token_pieces(docs, tokenizer_path, capacity, with_ids), "pieces"), capacity)
