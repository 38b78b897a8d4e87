"""Fill-in-the-middle transformation: a text is cut at two code points and its parts are put in another order.

Where the n-th code point ends is found without decoding. The UTF-8 bytes of many texts are viewed as 64-bit words; a
byte ends a code point when the next one is no continuation byte, which shifts and masks mark in all eight bytes of a
word at once. Marks are counted per word, the running count is searched for the word that holds the n-th mark, and a
multiplication that adds up the marks within the word gives the byte.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The marks that stand before the parts.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
# Of a hundred texts, those that are transformed, and those of them whose suffix comes first.
TRANSFORMED, SUFFIX_FIRST = 90, 20
# Bytes whose words are marked at once.
GROUP_BYTES = 4 << 20

HIGH = np.uint64(0x8080808080808080)
ONES = np.uint64(0x0101010101010101)


class CodePoints:
    """The ends of code points in valid UTF-8 bytes."""

    def __init__(self, data: np.ndarray):
        words = np.zeros(len(data) // 8 + 1, dtype="<u8")
        words.view(np.uint8)[: len(data)] = data
        continued = words & ~(words << np.uint64(1)) & HIGH  # bit 7 set, bit 6 not
        begins = continued ^ HIGH
        following = np.append(begins[1:], HIGH)
        # A byte is marked if the byte after it begins a code point; zeros after the end do.
        self.marks = (begins >> np.uint64(8)) | (following << np.uint64(56))
        self.before = np.concatenate(([0], np.cumsum(np.bitwise_count(self.marks), dtype=np.int64)))

    def rank(self, at: np.ndarray) -> np.ndarray:
        """How many code points end in the first ``at`` bytes."""
        word, byte = at >> 3, (at & 7).astype(np.uint64)
        low = (np.uint64(1) << (byte * np.uint64(8))) - np.uint64(1)
        return self.before[word] + np.bitwise_count(self.marks[word] & low)

    def select(self, nth: np.ndarray) -> np.ndarray:
        """The number of bytes up to the end of the ``nth`` code point, counted from 1."""
        word = np.searchsorted(self.before, nth, side="left") - 1
        # Byte k of ``upto`` has the marks in bytes 0 to k; the first that reaches the wanted number is the one.
        upto = (self.marks[word] >> np.uint64(7)) * ONES
        wanted = (nth - self.before[word]).astype(np.uint64)
        reached = ((upto | HIGH) - wanted * ONES) & HIGH
        return word * 8 + 8 - np.bitwise_count(reached).astype(np.int64) + 1


def draws(seed: int, key: object) -> tuple[int, int, int, int]:
    """Four 32-bit numbers from the SHA-256 of seed and key; a null key counts as empty."""
    text = f"{seed}:{'' if key is None else key}"
    return struct.unpack(">4I", hashlib.sha256(text.encode()).digest()[:16])


def groups(size: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows of at most ``GROUP_BYTES`` bytes, or of one row."""
    start, held = 0, 0
    for row, n in enumerate(size.tolist()):
        if row > start and held + n > GROUP_BYTES:
            yield start, row
            start, held = row, 0
        held += n
    if start < len(size):
        yield start, len(size)


def arranged(keys: list, texts: pa.Array, seed: int) -> list[tuple[int, str, int | None, int | None, bytes]]:
    """Code points, form, their numbers in prefix and middle, and the output of each text; no nulls in ``texts``."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    offsets = offsets.astype(np.int64)
    data = np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8)
    marks = [mark.encode() for mark in (PREFIX, SUFFIX, MIDDLE)]
    p, s, m = marks
    made = []
    for first, end in groups(np.diff(offsets)):
        base = offsets[first]
        part = data[base : offsets[end]]
        points = CodePoints(part)
        at = offsets[first : end + 1] - base
        ended = points.rank(at)
        n = np.diff(ended)
        drawn = np.array([draws(seed, key) for key in keys[first:end]], dtype=np.int64)
        cuts = np.sort(drawn[:, :2] % (n + 1)[:, None], axis=1)
        place = np.where(cuts > 0, points.select(np.maximum(ended[:-1, None] + cuts, 1)), at[:-1, None])
        whole = part.tobytes()
        for row, (lo, hi) in enumerate(zip(at[:-1].tolist(), at[1:].tolist(), strict=True)):
            text = whole[lo:hi]
            if lo == hi or drawn[row, 2] % 100 >= TRANSFORMED or any(mark in text for mark in marks):
                made.append((int(n[row]), "plain", None, None, text))
                continue
            one, two = place[row].tolist()
            before, middle, after = whole[lo:one], whole[one:two], whole[two:hi]
            if drawn[row, 3] % 100 < SUFFIX_FIRST:
                form, output = "spm", b"".join((s, after, p, before, m, middle))
            else:
                form, output = "psm", b"".join((p, before, s, after, m, middle))
            made.append((int(n[row]), form, int(cuts[row, 0]), int(cuts[row, 1] - cuts[row, 0]), output))
    return made


def transformed(docs: DataFrame, seed: int = 1) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, more) as doc_id, n, form, prefix_chars, middle_chars and output.

    A null text counts as empty and stays plain, as does one that holds a mark. A null id draws like an empty one;
    equal ids draw equal numbers, so that repeated rows come out alike. Texts of any length are cut whole. Other columns
    are not carried along, whatever their names; no rows, no rows.
    """

    def arrange(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").cast(pa.string()).fill_null("")
            made = arranged(batch.column("doc_id").to_pylist(), texts, seed)
            n, form, prefix, middle, output = zip(*made, strict=True) if made else ((),) * 5
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n": pa.array(n, pa.int64()),
                    "form": pa.array(form, pa.string()),
                    "prefix_chars": pa.array(prefix, pa.int64()),
                    "middle_chars": pa.array(middle, pa.int64()),
                    "output": pa.array(output, pa.binary()).cast(pa.string()),
                }
            )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, n long, form string, prefix_chars long, middle_chars long, output string"
    return docs.select("doc_id", "text").mapInArrow(arrange, schema)


def restored(form: Column, output: Column) -> Column:
    """The text that an output was made from. A transformed text holds no mark, so that the first of each is ours."""
    body = F.substring(output, len(PREFIX) + 1, 2**31 - 1)
    first = F.split(body, F.when(form == "psm", F.lit(SUFFIX)).otherwise(F.lit(PREFIX)), 2)
    second = F.split(first[1], F.lit(MIDDLE), 2)
    parts = F.when(form == "psm", F.concat(first[0], second[1], second[0])).otherwise(
        F.concat(second[0], second[1], first[0])
    )
    return F.when(form == "plain", output).otherwise(parts)


def digest(docs: DataFrame, seed: int = 1) -> DataFrame:
    """What :func:`transformed` made, as hashes of the output and of the text rebuilt from it."""
    found = transformed(docs, seed)
    return found.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


# The same rows as DuckDB SQL, for comparison.
SQL = f"""
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
           sha256('{{seed}}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
    FROM documents),
drawn AS (
    SELECT doc_id, t, n,
           CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS a, CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS b,
           CAST('0x' || h[17:24] AS BIGINT) % 100 AS c, CAST('0x' || h[25:32] AS BIGINT) % 100 AS d
    FROM hashed),
formed AS (
    SELECT *, least(a, b) AS lo, greatest(a, b) AS hi,
           CASE WHEN n = 0 OR c >= {TRANSFORMED} OR contains(t, '{PREFIX}') OR contains(t, '{SUFFIX}')
                     OR contains(t, '{MIDDLE}') THEN 'plain'
                WHEN d < {SUFFIX_FIRST} THEN 'spm' ELSE 'psm' END AS form
    FROM drawn),
cut AS (
    SELECT *, substring(t, 1, lo) AS p, substring(t, lo + 1, hi - lo) AS m, substring(t, hi + 1) AS s FROM formed)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t
                        WHEN 'psm' THEN '{PREFIX}' || p || '{SUFFIX}' || s || '{MIDDLE}' || m
                        ELSE '{SUFFIX}' || s || '{PREFIX}' || p || '{MIDDLE}' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""
