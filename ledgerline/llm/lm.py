"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

The chance of a token is that of its class, given the words before it, times that of the word within its class. Classes
are hashes of a word's ending. Within a class a word is found by five decisions, the bits of a hash of the whole word,
and by its count among the few words that share them. Class softmax and decisions (softmaxes of two) have
hashes of real words as features: the last word, the one before it (a skip feature, for classes) and both together; for a
decision each together with the class and the decisions before it. Classes and decisions also have an exact bias.

How the work is spread:

* One pass over the texts cuts them into batches of bounded size. A batch has its own dictionary; its documents are
  kept as numbers and, for learning, as hashes of their words. The pass also counts classes and decisions at every
  feature, in a table of fixed size.
* Words are counted over all batches by one window over the dictionaries' words, which also brings the counts back.
* The weights start from those counts. Then gradients are summed over all training documents, a share of them in each
  step: every task sums those of its documents, Spark adds them up by parts of the table, and all weights move at once.
* Documents meet the counts of their batch's dictionary and are scored in numpy, all tokens of a batch at once.
"""

from __future__ import annotations

import string
import zlib
from collections.abc import Iterable, Iterator
from math import log10

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import staged

BATCH_CHARS = 12_000_000  # texts of one dictionary; a longer text has one to itself
SYMBOL_BITS, CLASS_BITS, LEVELS = 24, 4, 5  # a word's symbol, its class in the highest bits; decisions within a class
SYMBOLS = 1 << SYMBOL_BITS  # symbol 0: before the text, symbol 1 and class 0: the end
WORD_BITS = SYMBOL_BITS - CLASS_BITS
CLASSES, NODES = 1 << CLASS_BITS, 1 << CLASS_BITS + LEVELS  # decisions of all classes; as many sets of words
FEATURES, CELLS = 1 << 14, 1 << 17  # weights that hashed features share, for classes (a row each) and for decisions
ACTIVE = 4  # features of a token at a level, its bias included
ENDING = 2  # bytes of a long word that its class depends on, once marks at its end are taken off
WHOLE = 3  # words of so many bytes count whole
MARKS = string.punctuation.encode()
STEPS = 2
PARTS = 64  # of the table of weights; its size is fixed
COUNTED = 1 << 16  # tokens counted, or whose gradients are summed, at once
CHUNK = 1 << 16  # tokens scored at once
DOC, WORD, HISTORY = 0, 1, 2  # kinds of staged rows
END = b""  # the end as a token; no word is empty
# Weights of classes and, in the last row, their biases; weights of decisions; biases of decisions.
SHAPES = ((FEATURES + 1, CLASSES), (CELLS,), (NODES,))
SIZE = sum(int(np.prod(shape)) for shape in SHAPES)


def _symbols(words: Iterable[bytes]) -> np.ndarray:
    """Words as numbers: the class, by a hash of the stem's ending, and a hash of the whole word."""
    first: dict[bytes, int] = {}
    found = []
    for word in words:
        stem = word.rstrip(MARKS)
        key = (stem if len(stem) <= WHOLE else b"~" + stem[-ENDING:]) + b"|" * (len(stem) < len(word))
        if key not in first:
            first[key] = 1 + zlib.crc32(b"c" + key) % (CLASSES - 1) << WORD_BITS
        found.append(first[key] | zlib.crc32(word) & (1 << WORD_BITS) - 1 if word else 1)
    return np.array(found, dtype=np.int32)


def _decisions(symbol: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each level the number of the decision within the class and what is decided, 0 or 1."""
    base, node = symbol >> WORD_BITS << LEVELS, np.ones(len(symbol), dtype=np.int32)
    for at in range(LEVELS):
        bit = symbol >> at & 1
        yield base + node, bit
        node = node * 2 + bit


def sets(symbol: np.ndarray) -> np.ndarray:
    """The number of the set of words, of one class and alike in all decisions, that a symbol belongs to."""
    return (symbol >> WORD_BITS << LEVELS) + (symbol & (1 << LEVELS) - 1)


def _histories(symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """For each token, the two symbols before it in one number; ``starts`` has the first token of each text."""
    last = np.zeros(len(symbol), dtype=np.int64)
    last[1:] = symbol[:-1]
    last[starts] = 0
    before = np.zeros(len(symbol), dtype=np.int64)
    before[1:] = last[:-1]
    before[starts] = 0
    return before * SYMBOLS + last


def _mixed(keys: np.ndarray) -> np.ndarray:
    keys = keys * np.uint64(0x9E3779B97F4A7C15)
    return (keys ^ (keys >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)


def _hashes(history: np.ndarray) -> np.ndarray:
    """Hashes of what features see of histories: the last word, the word before it, both."""
    last, before = history & SYMBOLS - 1, history >> SYMBOL_BITS
    keys = np.stack([last, before + (1 << 33), history ^ (1 << 62)]).astype(np.uint64)
    return (_mixed(keys) >> np.uint64(32)).astype(np.uint32)


def _cells(hashes: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The decision weights of the last word and of both."""
    return ((hashes[::2] + node.astype(np.uint32) * np.uint32(0x9E3779B1)) >> np.uint32(15)).astype(np.int64)


def _starts(lengths: Iterable[int]) -> np.ndarray:
    """Where texts begin that stand one after the other."""
    ends = np.cumsum(np.fromiter(lengths, dtype=np.int64))
    return np.concatenate([[0], ends[:-1]]).astype(np.int64) if len(ends) else ends


def _chunks(lengths: Iterable[int], size: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbouring texts with about ``size`` tokens together; a longer text is a run of its own."""
    first = tokens = at = 0
    for at, n in enumerate(lengths, 1):
        tokens += n
        if tokens >= size:
            yield first, at
            first, tokens = at, 0
    if first < at:
        yield first, at


def _stored(tokens: np.ndarray) -> bytes:
    """Token numbers as 16 low bits each and then, if there are any, 8 high bits each."""
    low = tokens.astype("<u2").tobytes()
    return low + (tokens >> 16).astype(np.uint8).tobytes() if len(tokens) and tokens.max() >= 1 << 16 else low


def _restored(data: bytes, n: int) -> np.ndarray:
    tokens = np.frombuffer(data, dtype="<u2", count=n).astype(np.int64)
    return tokens + (np.frombuffer(data, dtype=np.uint8, offset=2 * n).astype(np.int64) << 16) if len(data) > 2 * n else tokens


def _packed(symbol: np.ndarray) -> bytes:
    """Symbols as three bytes each."""
    return symbol.astype("<i4").view(np.uint8).reshape(-1, 4)[:, :3].tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    found = np.zeros((len(data) // 3, 4), dtype=np.uint8)
    found[:, :3] = np.frombuffer(data, np.uint8).reshape(-1, 3)
    return found.view("<i4").ravel()


STAGED = "kind int, batch long, doc_id {id}, held_out boolean, n int, data binary, word binary, place int, count long, symbols binary"


def digested(docs: DataFrame, held_out: Column, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """The texts of ``docs`` (doc_id, text) as numbers, the batches' dictionaries with counts in training texts, and
    the classes and decisions at each feature in training texts, as rows of three kinds. ``n`` is the number of tokens of a
    text, or the symbol of a word. ``symbols`` are those of a training text's words, or counts of a part of the table. Null
    texts are empty."""
    id_type = docs.schema["doc_id"].dataType

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("kind", pa.int32()), ("batch", pa.int64()), ("doc_id", arrow_id), ("held_out", pa.bool_()), ("n", pa.int32()),
             ("data", pa.binary()), ("word", pa.binary()), ("place", pa.int32()), ("count", pa.int64()), ("symbols", pa.binary())]
        )
        number = (TaskContext.get().partitionId() + 1) << 20
        seen = np.zeros(SIZE * 2, dtype=np.int64)
        words: dict[bytes, int] = {END: 0}
        texts: list[tuple] = []
        chars = 0

        def rows(kind: int, size: int, **columns: pa.Array) -> pa.RecordBatch:
            fixed = {"kind": pa.array(np.full(size, kind, np.int32)), "batch": pa.array(np.full(size, number, np.int64))}
            return pa.RecordBatch.from_arrays(
                [(fixed | columns).get(f.name, pa.nulls(size, f.type)) for f in schema], schema=schema
            )

        def close() -> Iterator[pa.RecordBatch]:
            nonlocal number, words, texts, chars, seen
            symbol = _symbols(words)
            learned = [tokens for _, held, tokens in texts if not held]
            counts = np.zeros(len(words), dtype=np.int64)
            # A part of the tokens at a time: all of them at once would be held several times over.
            for first, last in _chunks(map(len, learned), COUNTED):
                together = np.concatenate(learned[first:last])
                np.add.at(counts, together, 1)
                _count(seen, symbol[together], _starts(map(len, learned[first:last])))
            listed = list(words)
            for at in range(0, len(listed), 50_000):
                some = listed[at : at + 50_000]
                yield rows(
                    WORD, len(some), word=pa.array(some, pa.binary()), count=pa.array(counts[at : at + 50_000]),
                    place=pa.array(np.arange(at, at + len(some), dtype=np.int32)),
                    n=pa.array(symbol[at : at + 50_000]),
                )
            for at in range(0, len(texts), 256):
                some = texts[at : at + 256]
                yield rows(
                    DOC, len(some), doc_id=pa.array([t[0] for t in some], arrow_id), held_out=pa.array([t[1] for t in some]),
                    n=pa.array([len(t[2]) for t in some], pa.int32()),
                    data=pa.array([_stored(t[2]) for t in some], pa.binary()),
                    symbols=pa.array([None if t[1] else _packed(symbol[t[2]]) for t in some], pa.binary()),
                )
            number, words, texts, chars = number + 1, {END: 0}, [], 0

        for batch in batches:
            columns = (batch.column(i).to_pylist() for i in range(3))
            for doc, held, text in zip(*columns, strict=True):
                found = text.encode("utf-8", "surrogatepass").lower().split() if text else []
                found.append(END)
                place = words.setdefault
                tokens = np.fromiter((place(w, len(words)) for w in found), dtype=np.int32, count=len(found))
                texts.append((doc, held, tokens))
                chars += len(text or "")
                if chars >= batch_chars:
                    yield from close()
        if texts:
            yield from close()
        if seen.any():
            parts = [part.astype("<i8").tobytes() for part in np.array_split(seen, PARTS)]
            yield rows(HISTORY, PARTS, place=pa.array(np.arange(PARTS, dtype=np.int32)), symbols=pa.array(parts, pa.binary()))

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type)
    sent = docs.select("doc_id", held_out.alias("held_out"), "text")
    return sent.mapInArrow(cut, STAGED.format(id=id_type.simpleString()))


# --- the class softmax -------------------------------------------------------------------------------------------


def added(parts: DataFrame, kind: str) -> np.ndarray | None:
    """The sum of tables that come as rows of ``place`` and ``data``, the numbers of one of ``PARTS`` parts."""

    def add(frames: Iterable[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for frame in frames:
            for place, data in zip(frame["place"], frame["data"], strict=True):
                numbers = np.frombuffer(data, kind)
                sums[place] = sums[place] + numbers if place in sums else numbers
        yield pd.DataFrame({"place": list(sums), "data": [x.tobytes() for x in sums.values()]})

    # One table of fixed size in all.
    found = dict(parts.repartition(PARTS // 4, "place").mapInPandas(add, "place int, data binary").collect())
    return np.concatenate([np.frombuffer(found[place], kind) for place in range(PARTS)]) if found else None


def _split(table: np.ndarray) -> list[np.ndarray]:
    """A table of ``SIZE`` numbers as the four it consists of."""
    ends = np.cumsum([int(np.prod(shape)) for shape in SHAPES])
    return [part.reshape(shape) for part, shape in zip(np.split(table, ends[:-1]), SHAPES, strict=True)]


def _count(seen: np.ndarray, symbol: np.ndarray, starts: np.ndarray) -> None:
    """Adds to ``seen`` the classes and the decisions for 1, then the decisions for 0, at each feature."""
    rows, cells, nodes = _split(seen[:SIZE])
    _, no_cells, no_nodes = _split(seen[SIZE:])
    history, group = _histories(symbol, starts), (symbol >> WORD_BITS).astype(np.int64)
    at = features(history).T * CLASSES + group
    rows[:-1] += np.bincount(at.ravel(), minlength=FEATURES * CLASSES).reshape(-1, CLASSES)
    rows[-1] += np.bincount(group, minlength=CLASSES)
    hashes = _hashes(history)
    decided = [(_cells(hashes, node) * 2 + bit, node * 2 + bit) for node, bit in _decisions(symbol)]
    for at, yes, no in zip(zip(*decided, strict=True), (cells, nodes), (no_cells, no_nodes), strict=True):
        both = np.bincount(np.concatenate(at, axis=-1).ravel(), minlength=2 * len(yes))
        no += both[::2]
        yes += both[1::2]


def features(history: np.ndarray) -> np.ndarray:
    """The rows of class weights of histories: last word, word before it, both."""
    return (_hashes(history) >> np.uint32(18)).astype(np.int64).T


def class_chances(weights: np.ndarray, history: np.ndarray) -> np.ndarray:
    """Natural logs of the chances of all classes after each history; the last row of ``weights`` is the bias."""
    last, before, both = features(history).T
    scores = weights[last] + weights[before] + weights[both] + weights[-1]
    scores -= scores.max(axis=1, keepdims=True)
    return scores - np.log(np.exp(scores).sum(axis=1, keepdims=True))


def gradient(
    weights: np.ndarray, history: np.ndarray, group: np.ndarray, n: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of ``weights`` that the histories touch, and slope and curvature of the log-likelihood of counted
    (history, class) pairs in each weight of those rows."""
    different, place = np.unique(history, return_inverse=True)
    counted = np.bincount(place * CLASSES + group, n, len(different) * CLASSES).reshape(-1, CLASSES).astype(weights.dtype)
    chance = np.exp(class_chances(weights, different))
    total = counted.sum(axis=1, keepdims=True)
    apart, bend = counted - total * chance, total * chance * (1 - chance)
    rows = features(different)
    flat = rows.T.ravel()
    order = np.argsort(flat.astype(np.uint16), kind="stable")
    touched, first = np.unique(flat[order], return_index=True)
    slope, curve = (
        np.concatenate([np.add.reduceat(x[order % len(different)], first, axis=0), x.sum(axis=0, keepdims=True)])
        for x in (apart, bend)
    )
    return np.append(touched, len(weights) - 1), slope, curve


def log_chances(table: np.ndarray, symbol: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Natural log of the chance of each token's class and decisions after the words before it."""
    rows, cells, nodes = _split(table)
    history = _histories(symbol, starts)
    chance = class_chances(rows, history)[np.arange(len(symbol)), symbol >> WORD_BITS].astype(float)
    hashes = _hashes(history)
    for node, bit in _decisions(symbol):
        score = cells.take(_cells(hashes, node)).sum(axis=0) + nodes[node]
        chance -= np.log1p(np.exp(np.where(bit == 1, -score, score)))
    return chance


def slopes(table: np.ndarray, symbol: np.ndarray, starts: np.ndarray, sums: np.ndarray) -> None:
    """Adds to ``sums`` the slope of the log-likelihood of some texts in each weight."""
    rows, cells, nodes = _split(table)
    history = _histories(symbol, starts)
    touched, slope, _ = gradient(rows, history, symbol >> WORD_BITS, np.ones(len(symbol)))
    into = _split(sums)
    into[0][touched] += slope
    hashes, found = _hashes(history), []
    for node, bit in _decisions(symbol):
        at = _cells(hashes, node)
        found.append((at, node, bit.astype(np.float32) - 1 / (1 + np.exp(-(cells.take(at).sum(axis=0) + nodes[node])))))
    apart = np.concatenate([a for *_, a in found])
    into[2][:] += np.bincount(np.concatenate([n for _, n, _ in found]), apart, NODES)
    at, apart = np.concatenate([at for at, *_ in found], axis=1).ravel(), np.tile(apart, 2)
    into[1][:] += np.bincount(at, apart, CELLS)


def start(counts: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Weights from the classes and decisions counted at each feature, and the curvature the counts give each weight. A
    bias is that of its counts, and a hashed feature has a share of how far its counts are from those of all tokens."""
    weights, curve = np.zeros(SIZE), np.zeros(SIZE)
    made, bent, yes, no = _split(weights), _split(curve), _split(counts[:SIZE]), _split(counts[SIZE:])
    total = yes[0].sum(axis=1, keepdims=True)
    mean = (yes[0][-1] + 1) / (total[-1] + CLASSES)
    share = (yes[0] + prior * mean) / (total + prior)
    made[0][:-1], made[0][-1] = np.log(share[:-1] / mean) / ACTIVE, np.log(mean)
    bent[0][:] = total * share * (1 - share)
    for at, room, active in ((1, prior, ACTIVE), (2, 1.0, 1)):
        share = (yes[at] + room / 2) / (yes[at] + no[at] + room)
        made[at][:] = np.log(share / (1 - share)) / active
        bent[at][:] = (yes[at] + no[at]) * share * (1 - share)
    return weights, curve + prior


def fit(texts: DataFrame, histories: DataFrame, steps: int = STEPS, prior: float = 8.0) -> np.ndarray:
    """The ``SIZE`` weights, from the words of the training texts (symbols) and what was counted at each feature (place,
    data).

    Every text is in the gradient of one step, equal texts in the same. In each step every task sends its summed gradient,
    and all weights move along their own axis by a step as long as the curvature makes it, shortened by the features that
    are active at once.
    """
    counts = added(histories, "<i8")
    if counts is None:
        return np.zeros(SIZE, dtype=np.float32)
    weights, curve = start(counts, prior)
    for step in range(steps):
        now = weights.astype(np.float32)  # sent along with the function that uses it

        def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums = np.zeros(SIZE)
            for batch in batches:
                lists = [_unpacked(x) for x in batch.column(0).to_pylist()]
                for first, last in _chunks(map(len, lists), COUNTED):
                    some = lists[first:last]
                    slopes(now, np.concatenate(some), _starts(map(len, some)), sums)
            data = [part.astype("<f4").tobytes() for part in np.array_split(sums, PARTS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(PARTS, dtype=np.int32)), pa.array(data, pa.binary())], names=["place", "data"]
            )

        share = texts.select("symbols").where(F.pmod(F.xxhash64("symbols"), F.lit(steps)) == step)
        slope = added(share.mapInArrow(summed, "place int, data binary"), "<f4")
        weights += np.clip(slope * float(steps) / curve / ACTIVE, -1, 1)
    return weights.astype(np.float32)


# --- scores ------------------------------------------------------------------------------------------------------


def scored(docs: DataFrame, held_out: Column, batch_chars: int = BATCH_CHARS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score (add-one unigrams) and ``score``, the model's log10
    probability of the text, of all rows; learned from those that are not held out. An empty text is one end. If nothing
    can be learned, every token counts as unknown. An empty table gives no rows."""
    rows = staged(digested(docs, held_out, batch_chars), "digested")
    words = rows.where(F.col("kind") == WORD).select("batch", "place", "n", "word", "count")
    # The batches' rows of a word meet once: they are added up and each gets the sum.
    counted = staged(
        words.select("batch", "place", "n", F.sum("count").over(Window.partitionBy("word")).alias("count"),
                     F.row_number().over(Window.partitionBy("word").orderBy("batch", "place")).alias("nth")),
        "counts",
    )

    # As many rows as there are sets of words.
    group = F.shiftright("n", WORD_BITS)
    number = F.shiftleft(group, LEVELS) + F.col("n").bitwiseAND((1 << LEVELS) - 1)
    each = counted.where("nth = 1").groupBy(number.alias("c"))
    per_class = np.zeros((NODES, 2), dtype=np.int64)
    for c, n, v in each.agg(F.sum("count"), F.count_if(F.col("count") > 0)).collect():
        per_class[c] = n, v
    tokens, kinds = int(per_class[:, 0].sum()), int(per_class[:, 1].sum())
    histories = rows.where(F.col("kind") == HISTORY).select("place", F.col("symbols").alias("data"))
    weights = fit(rows.where((F.col("kind") == DOC) & F.col("symbols").isNotNull()), histories)
    base_room, room = log10(tokens + kinds + 1), np.log10(per_class.sum(axis=1) + 1.0)

    def score(texts: pd.DataFrame, dictionary: pd.DataFrame) -> pd.DataFrame:
        if texts.empty:
            return pd.DataFrame(columns=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
        place = dictionary["place"].to_numpy()
        symbol, count = np.zeros(len(place), dtype=np.int32), np.zeros(len(place), dtype=np.int64)
        symbol[place], count[place] = dictionary["n"].to_numpy(), dictionary["count"].to_numpy()
        within, known = np.log10(count + 1.0), (count > 0).astype(np.int64)
        left = within - room[sets(symbol)]
        lengths = texts["n"].to_numpy(dtype=np.int64)
        sums = np.zeros((len(texts), 3))
        for first, last in _chunks(lengths, CHUNK):
            some = np.arange(first, last)
            numbers = np.concatenate([_restored(d, n) for d, n in zip(texts["data"].iloc[some], lengths[some], strict=True)])
            starts = _starts(lengths[some])
            chance = left[numbers] + log_chances(weights, symbol[numbers], starts) / np.log(10)
            for column, values in enumerate((known[numbers], within[numbers], chance)):
                sums[some, column] = np.add.reduceat(values, starts)
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"].to_numpy(),
                "held_out": texts["held_out"].to_numpy(),
                "n_tokens": lengths,
                "n_known": sums[:, 0].astype(np.int64),
                "train_tokens": tokens,
                "base_score": sums[:, 1] - lengths * base_room,
                "score": sums[:, 2],
            }
        )

    texts = rows.where(F.col("kind") == DOC).select("batch", "doc_id", "held_out", "n", "data")
    known = counted.select("batch", "place", "n", "count")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return texts.groupBy("batch").cogroup(known.groupBy("batch")).applyInPandas(score, schema)
