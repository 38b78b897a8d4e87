"""Language identification in two steps: the family of languages first, then the languages within it.

Texts become hashed character n-grams (one to three letters, runs of anything else count as one space). Families are
groups of languages whose mean profiles are closest. One linear support vector machine per family separates it from the
others; within a family one machine per pair of languages votes.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.common import worker_memory

# About so many labelled documents are fitted, at most twice as many, shared equally by the languages.
SAMPLE = 6_000
BITS = 12  # of a hashed n-gram
ORDERS = 3
UNKNOWN = "und"
_MIX = 0x9E3779B97F4A7C15
CHUNK = 1 << 20  # characters turned into n-grams at once


def _letters() -> np.ndarray:
    kept = worker_memory()
    if "letters" not in kept:
        kept["letters"] = np.array([chr(c).isalpha() for c in range(0x10000)])
    return kept["letters"]


def _codes(text: str) -> np.ndarray:
    """Lower-case letters as code points, with one space for each run of anything else and at both ends."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    letter = np.zeros(len(codes), dtype=bool)
    basic = codes < 0x10000
    letter[basic] = _letters()[codes[basic]]
    if not basic.all():
        letter[~basic] = [chr(c).isalpha() for c in codes[~basic].tolist()]
    begins = letter.copy()
    begins[1:] |= letter[:-1]  # the first of a run of others stays, as a space
    kept = np.where(letter, codes, 32)[begins]
    return np.concatenate([[32], kept, [32]] if not len(kept) or kept[-1] != 32 else [[32], kept]).astype(np.uint64)


def profile(text: str | None) -> np.ndarray | None:
    """Damped, normalised n-gram counts of a whole text; None if it has no letter."""
    if not text:
        return None
    counts = np.zeros(1 << BITS, dtype=np.float64)
    for at in range(0, len(text), CHUNK):
        codes = _codes(text[at : at + CHUNK])
        if len(codes) < 3:
            continue
        key = codes.copy()
        for order in range(1, ORDERS + 1):
            if order > 1:
                key = key[:-1] * np.uint64(0x100000001B3) + codes[order - 1 :]
            slot = ((key + np.uint64(order)) * np.uint64(_MIX)) >> np.uint64(64 - BITS)
            counts += np.bincount(slot.astype(np.int64), minlength=1 << BITS)
    if not counts.any():
        return None
    damped = np.sqrt(counts)
    return (damped / np.linalg.norm(damped)).astype(np.float32)


def svm(rows: np.ndarray, signs: np.ndarray, cost: float = 4.0, rounds: int = 12) -> np.ndarray:
    """Weights of a linear support vector machine (hinge loss, L2), by dual coordinate descent. Both signs weigh alike
    however many rows they have."""
    upper = cost * np.where(signs > 0, len(signs) / (2 * max((signs > 0).sum(), 1)), len(signs) / (2 * max((signs < 0).sum(), 1)))
    weights = np.zeros(rows.shape[1], dtype=np.float64)
    alpha = np.zeros(len(rows))
    square = np.einsum("ij,ij->i", rows, rows).clip(1e-9)
    shuffled = np.random.default_rng(7)
    for _ in range(rounds):
        for i in shuffled.permutation(len(rows)).tolist():
            slope = signs[i] * float(rows[i] @ weights) - 1
            new = min(max(alpha[i] - slope / square[i], 0.0), upper[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * signs[i] * rows[i]
                alpha[i] = new
    return weights.astype(np.float32)


def families(means: np.ndarray) -> list[list[int]]:
    """Groups of languages, about the root of their number: the two groups with the closest means are joined until
    that many are left."""
    groups = [[i] for i in range(len(means))]
    while len(groups) > max(1, round(len(means) ** 0.5)):
        def near(pair: tuple[int, int]) -> float:
            a, b = (means[groups[g]].mean(axis=0) for g in pair)
            return float(a @ b / (np.linalg.norm(a) * np.linalg.norm(b) + 1e-12))

        a, b = max(combinations(range(len(groups)), 2), key=near)
        groups[a] += groups.pop(b)
    return [sorted(g) for g in groups]


def _sure(margin: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-4 * np.clip(margin, -8, 8)))


@dataclass
class Identifier:
    """A fitted model: languages, their families, a machine for each family and for each pair within one."""

    languages: list[str]
    groups: list[list[int]] = field(default_factory=list)
    family: np.ndarray | None = None
    pairs: dict[tuple[int, int], np.ndarray] = field(default_factory=dict)

    def predict(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The index of each row's language and a score from 0 to 1, the product of what both steps are sure of."""
        best, score = np.zeros(len(rows), dtype=np.int64), np.ones(len(rows))
        group = np.zeros(len(rows), dtype=np.int64)
        if len(self.groups) > 1:
            margins = rows @ self.family.T
            group = margins.argmax(axis=1)
            top = np.sort(margins, axis=1)
            score = _sure((top[:, -1] - top[:, -2]) / 2)
        for g, members in enumerate(self.groups):
            mine = np.flatnonzero(group == g)
            if not len(mine):
                continue
            votes, sure = np.zeros((len(mine), len(members))), np.zeros((len(mine), len(members)))
            for a, b in combinations(range(len(members)), 2):
                margin = rows[mine] @ self.pairs[members[a], members[b]]
                votes[:, a] += margin > 0
                votes[:, b] += margin <= 0
                sure[:, a] += _sure(margin)
                sure[:, b] += _sure(-margin)
            pick = (votes + sure / (len(members) + 1)).argmax(axis=1)
            best[mine] = np.array(members)[pick]
            if len(members) > 1:
                score[mine] *= sure[np.arange(len(mine)), pick] / (len(members) - 1)
        return best, score


def fit(rows: np.ndarray, labels: list[str]) -> Identifier:
    """The model of labelled profiles. With one language it always predicts that, with none there is no prediction."""
    languages = sorted(set(labels))
    if not languages:
        return Identifier([])
    number = np.array([languages.index(x) for x in labels], dtype=np.int64)
    means = np.array([rows[number == i].mean(axis=0) for i in range(len(languages))])
    model = Identifier(languages, families(means))
    if len(model.groups) > 1:
        inside = [np.isin(number, g) for g in model.groups]
        model.family = np.stack([svm(rows, np.where(i, 1, -1)) for i in inside])
    for members in model.groups:
        for a, b in combinations(members, 2):
            some = (number == a) | (number == b)
            model.pairs[a, b] = svm(rows[some], np.where(number[some] == a, 1, -1))
    return model


def train(docs: DataFrame, sample: int = SAMPLE) -> Identifier:
    """A model fitted on a bounded sample of ``docs`` (doc_id, text, lang); rows without a language or letters are left
    out."""
    labelled = docs.where("lang is not null")
    # A row for each language, as the model has. A document is chosen by the hash of its id alone, at the rate its
    # language needs, so that no task sees all documents of a language.
    counts = {r["lang"]: r["n"] for r in labelled.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    each = sample / max(len(counts), 1)
    rates = F.from_json(F.lit(json.dumps({k: int(min(1.0, each / n) * (1 << 30)) for k, n in counts.items()})), "map<string,int>")
    order = F.xxhash64("doc_id")
    chosen = labelled.where(F.pmod(order, F.lit(1 << 30)) < F.try_element_at(rates, F.col("lang")))

    @pandas_udf("binary")
    def packed(texts: pd.Series) -> pd.Series:
        found = [profile(t) for t in texts]
        return pd.Series([None if p is None else p.astype(np.float16).tobytes() for p in found], dtype=object)

    # Ids that repeat could bring more rows than wanted.
    rows = chosen.select("lang", order.alias("_order"), packed("text").alias("x")).where("x is not null")
    fitted = [(r.lang, r.x) for r in rows.orderBy("_order", F.xxhash64("x"), "lang").limit(2 * sample).collect()]
    matrix = np.array([np.frombuffer(x, dtype=np.float16) for _, x in fitted], dtype=np.float32)
    return fit(matrix.reshape(len(fitted), 1 << BITS), [lang for lang, _ in fitted])


def predict(text: Column, model: Identifier) -> Column:
    """Struct of ``lang_pred`` and ``score`` for each text; ``und`` with score 0 for null and texts without a letter, or
    if the model knows no language."""

    @pandas_udf("lang_pred string, score double")
    def compute(texts: pd.Series) -> pd.DataFrame:
        found = [profile(t) for t in texts]
        known = [i for i, p in enumerate(found) if p is not None] if model.languages else []
        lang, score = [UNKNOWN] * len(found), np.zeros(len(found))
        if known:
            best, sure = model.predict(np.stack([found[i] for i in known]))
            score[known] = sure
            for i, b in zip(known, best.tolist(), strict=True):
                lang[i] = model.languages[b]
        return pd.DataFrame({"lang_pred": lang, "score": score})

    return compute(text)


def held_out(doc_id: Column, parts: int = 3, part: int = 1) -> Column:
    """Whether a document is kept for testing; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % parts == part


def identified(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, lang_pred and score of all rows of ``docs`` (doc_id, text, lang, more), learned from those that are
    not held out. Null texts and those without a letter are ``und``, as are all if no row teaches a language; a null id
    counts as the empty text, repeated rows are predicted each, long texts are read whole, other columns are left behind
    and an empty table gives no rows."""
    model = train(docs.where(~held_out(F.col("doc_id"))))
    found = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), predict(F.col("text"), model).alias("_found"))
    return found.select("doc_id", "held_out", "_found.*")
