"""Token counts by a byte-level tokenizer, without the tokens.

The tokenizer splits texts by a pattern before it merges bytes. Texts are cut where that pattern always splits, whatever
stands around, so that the counts of the parts add up to that of the text. Most parts are words met before; the others
are encoded in batches of a bounded number of bytes, and only their lengths are kept.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ledgerline.llm.common import worker_memory

# Bytes of text that are counted together, and encoded by one call.
GROUP_BYTES, CALL_BYTES = 2 << 20, 256 << 10
# Parts whose counts a Python worker keeps, and the longest of them: about 20 MB at most.
KEPT, LONGEST_KEPT = 1 << 17, 32
# Characters from which a part without a blank is cut further.
LONG = 64 << 10
# How far the search for a place to cut goes before a long part is left whole up to there.
REACH = 1 << 10

# A blank that something visible follows always begins a part: what is before it ends there, be it white space or not.
# Python's white space covers the tokenizer's; U+180E was white space in older Unicode tables.
BLANK = re.compile(r" (?=[^\s᠎])")
# Letters and digits whose class is the same in all Unicode tables, and marks that no contraction begins.
ALNUM = r"0-9A-Za-zぁ-ゖァ-ヺ一-龥가-힣"
MARKS = r"\n.,;:!?()、。！，：；？"
# Other places where the pattern splits: before a line's end or a mark that follows a letter or digit, and between an
# ASCII letter and a digit.
OTHER = re.compile(rf"(?<=[{ALNUM}])(?=[{MARKS}])|(?<=[A-Za-z])(?=[0-9])|(?<=[0-9])(?=[A-Za-z])")
# Within a run of letters a cut also needs a pair of letters that stands in no token. A contraction has two letters.
LETTERS = re.compile(r"(?<=[A-Za-z]{4})(?=[A-Za-z])")


class Counter:
    """Numbers of tokens of texts, equal to those of the tokenizer on the whole text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.joined = {
            token[i : i + 2] for token in self.tokenizer.get_vocab(with_added_tokens=False) for i in range(len(token) - 1)
        }
        self.special = max((len(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()), default=0)
        self.kept: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        parts = [self.parts(text) for text in texts]
        new: dict[str, int] = {}
        for part in {part for each in parts for part in each}.difference(self.kept):
            new[part] = 0
        self.encode(new)
        kept = self.kept
        found = [sum([kept[p] if p in kept else new[p] for p in each]) for each in parts]
        for part, n in new.items():
            if len(kept) >= KEPT:
                break
            if len(part) <= LONGEST_KEPT:
                kept[part] = n
        return found

    def parts(self, text: str) -> list[str]:
        """The text, cut at safe places. Parts after the first begin with a blank or stand where a long one was cut."""
        first, *rest = BLANK.split(text)
        parts = [first, *[" " + part for part in rest]]
        if len(text) > LONG and any(len(part) > LONG for part in parts):
            parts = [piece for part in parts for piece in (self.cut(part) if len(part) > LONG else (part,))]
        return parts

    def cut(self, part: str) -> Iterator[str]:
        start = 0
        while len(part) - start > LONG:
            at = self.place(part, start + LONG)
            if at is None:
                break
            yield part[start:at]
            start = at
        yield part[start:]

    def place(self, part: str, after: int) -> int | None:
        """The next safe place from ``after`` on that is in no special token, or None if there is none."""
        while after < len(part):
            window = min(after + REACH, len(part))
            found = (m.start() for kind in (OTHER, LETTERS) for m in kind.finditer(part, after, window))
            for at in found:
                if part[at - 1 : at + 1].isalpha() and part[at - 1 : at + 1].isascii():
                    if part[at - 1 : at + 1] in self.joined:
                        continue
                if "<|" not in part[max(at - self.special, 0) : at + 1]:
                    return at
            after = window
        return None

    def encode(self, new: dict[str, int]) -> None:
        """Fill in the counts, the parts in batches of about ``CALL_BYTES``."""
        batch, size = [], 0
        for part in new:
            batch.append(part)
            size += len(part) if part.isascii() else len(part.encode())
            if size >= CALL_BYTES:
                self.call(batch, new)
                batch, size = [], 0
        if batch:
            self.call(batch, new)

    def call(self, batch: list[str], into: dict[str, int]) -> None:
        for part, encoded in zip(batch, self.tokenizer.encode_batch_fast(batch, add_special_tokens=False), strict=True):
            into[part] = len(encoded)


def worker_counter(path: str) -> Counter:
    """The counter of this Python worker; it outlives the task."""
    kept = worker_memory()
    key = f"counter:{path}"
    if key not in kept:
        kept[key] = Counter(path)
    return kept[key]


def counted(docs: DataFrame, tokenizer_path: str, limit: int) -> DataFrame:
    """Each row of ``docs`` (doc_id, text, more) as doc_id, n_bytes, n_tokens and over_limit (more tokens than ``limit``).

    A null or empty text has none. Special strings within a text are one token each, as the tokenizer has it by default;
    none is added. Texts of any length are counted whole: a run of letters that has no safe place stays one part.
    Repeated rows are counted each, null ids are kept, other columns are not carried along; no rows, no rows.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = worker_counter(tokenizer_path)
        for batch in batches:
            sizes, tokens, group, held = [], [], [], 0
            for value in batch.column("text"):
                text = value.as_py() or ""
                sizes.append(len(text) if text.isascii() else len(text.encode()))
                if group and held + sizes[-1] > GROUP_BYTES:
                    tokens += counter.counts(group)
                    group, held = [], 0
                group.append(text)
                held += sizes[-1]
            tokens += counter.counts(group)
            columns = {
                "doc_id": batch.column("doc_id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
            }
            yield pa.RecordBatch.from_pydict(columns)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    found = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {id_type}, n_bytes long, n_tokens long")
    return found.withColumn("over_limit", F.col("n_tokens") > limit)
