"""Quality rules: document statistics, fixed rules on them, and gradient-boosted trees for the verdict.

The trees are grown by histograms on a bounded sample of labelled documents, with monotonic constraints: more repeated
words, repeated lines or symbols never raise a score. They are flattened into numpy node arrays, over which a whole
batch of documents walks down at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from ledgerline.llm.common import inner_name

# The fixed rules.
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
WINDOW = 3
# The characters that count as symbols.
SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"

# At most so many labelled documents are fitted, those with the least hash of their id.
SAMPLE = 20_000
KEEP_FROM = 0.5

# Statistic and the direction in which it may move the score (0: any).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "repeated_share": -1,
    "duplicate_line_share": -1,
    "symbol_share": -1,
    "upper_share": 0,
    "digit_share": 0,
    "mark_share": 0,
    "words_per_line": 0,
    "distinct_share": 0,
    "top_word_share": 0,
    "short_line_share": 0,
}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_BYTES = np.arange(256)
_IS = {
    "space": np.isin(_BYTES, list(SPACES)),
    "symbol": np.isin(_BYTES, list(SYMBOLS)),
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "mark": np.isin(_BYTES, list(b".,;:!?\"'()[]{}-")),
    "inner": (_BYTES >= 0x80) & (_BYTES < 0xC0),  # not the first byte of a code point
}


def repeated_words(places: np.ndarray, different: int) -> int:
    """Words in a window of three that occurs twice or more; ``places`` has a number for each word."""
    if len(places) < WINDOW:
        return 0
    a, b, c = places[:-2], places[1:-1], places[2:]
    if different < 1 << 21:
        keys = (a * different + b) * different + c
    else:
        keys = np.unique(np.stack([a, b, c], axis=1), axis=0, return_inverse=True)[1].ravel()
    order = np.argsort(keys, kind="stable")
    same = np.diff(keys[order]) == 0
    again = np.zeros(len(keys), dtype=bool)
    again[order[1:]] |= same
    again[order[:-1]] |= same
    covered = np.zeros(len(places), dtype=bool)
    for k in range(WINDOW):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[list[int], list[float]]:
    """The base counts (``BASE``) and the statistics (``FEATURES``) of a text; zeros for null and empty texts."""
    data = text.encode("utf-8", "surrogatepass") if text else b""
    words = data.split()
    n = len(words)
    if not n:
        # Symbols are no white space, so a text without words has none.
        return [0] * len(BASE), [0.0] * len(FEATURES)
    seen = np.bincount(np.frombuffer(data, dtype=np.uint8), minlength=256)
    have = {name: int(seen[mask].sum()) for name, mask in _IS.items()}
    chars = len(data) - have["inner"] - have["space"]
    lines = [line for line in data.split(b"\n") if line.strip()]
    duplicates = len(lines) - len(set(lines))
    ids: dict[bytes, int] = {}
    places = np.fromiter((ids.setdefault(w, len(ids)) for w in words), dtype=np.int64, count=n)
    repeated = repeated_words(places, len(ids))
    short = sum(len(line) < 20 for line in lines)
    return [n, chars, have["symbol"], duplicates, repeated], [
        float(np.log1p(n)),
        chars / n,
        repeated / n,
        duplicates / len(lines),
        have["symbol"] / chars,
        have["upper"] / chars,
        have["digit"] / chars,
        have["mark"] / chars,
        n / len(lines),
        len(ids) / n,
        float(np.bincount(places).max()) / n,
        short / len(lines),
    ]


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < LEAST_WORDS or 100 * n_repeat_words > MOST_REPEATED_PERCENT * n_words


# --- boosted trees -----------------------------------------------------------------------------------------------


@dataclass
class Trees:
    """All trees of a model in flat arrays; a leaf points at itself. ``roots`` has the first node of each tree."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    start: float
    depth: int

    def margin(self, rows: np.ndarray) -> np.ndarray:
        """The log odds of each row."""
        if not len(self.roots):
            return np.full(len(rows), self.start)
        node = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        lines = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            goes_left = rows[lines, self.feature[node]] <= self.threshold[node]
            node = np.where(goes_left, self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(rows), -30, 30)))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    directions: list[int],
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 48,
    smooth: float = 2.0,
    least: float = 4.0,
) -> Trees:
    """Boosted trees for the log odds of a label.

    A split whose leaf values would go against its feature's direction is not taken, and the values below a split stay
    on their side of its middle, so that whole trees are monotonic. Without rows, or with one label only, there are
    no trees and the score is the share of that label, smoothed.
    """
    n = len(rows)
    share = (labels.sum() + 1) / (n + 2)
    start = float(np.log(share / (1 - share)))
    feature, threshold, left, right, value, roots = [], [], [], [], [], []
    if n and 0 < labels.sum() < n:
        edges = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(rows.shape[1])]
        binned = np.stack([np.searchsorted(e, rows[:, f], side="left") for f, e in enumerate(edges)], axis=1)
        margin = np.full(n, start)

        def node(low: float) -> int:
            place = len(feature)
            for array, x in ((feature, 0), (threshold, np.inf), (left, place), (right, place), (value, low)):
                array.append(x)
            return place

        def grow(mine: np.ndarray, g: np.ndarray, h: np.ndarray, lower: float, upper: float, level: int) -> int:
            total_g, total_h = g[mine].sum(), h[mine].sum()
            here = node(rate * float(np.clip(total_g / (total_h + smooth), lower, upper)))
            if level == depth:
                return here
            best = (1e-6, None)
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                size = len(cuts) + 1
                gl = np.cumsum(np.bincount(binned[mine, f], g[mine], size))[:-1]
                hl = np.cumsum(np.bincount(binned[mine, f], h[mine], size))[:-1]
                gr, hr = total_g - gl, total_h - hl
                vl = np.clip(gl / (hl + smooth), lower, upper)
                vr = np.clip(gr / (hr + smooth), lower, upper)
                allowed = (hl >= least / 4) & (hr >= least / 4) & ((vr - vl) * directions[f] >= 0)
                gain = gl**2 / (hl + smooth) + gr**2 / (hr + smooth) - total_g**2 / (total_h + smooth)
                gain = np.where(allowed, gain, -1.0)
                cut = int(np.argmax(gain))
                if gain[cut] > best[0]:
                    best = (gain[cut], (f, cut, float(vl[cut]), float(vr[cut])))
            if best[1] is None:
                return here
            f, cut, vl, vr = best[1]
            middle = (vl + vr) / 2
            below, above = (lower, middle), (middle, upper)
            if directions[f] < 0:
                below, above = (middle, upper), (lower, middle)
            elif directions[f] == 0:
                below = above = (lower, upper)
            goes_left = binned[mine, f] <= cut
            feature[here], threshold[here] = f, edges[f][cut]
            left[here] = grow(mine[goes_left], g, h, *below, level + 1)
            right[here] = grow(mine[~goes_left], g, h, *above, level + 1)
            return here

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            roots.append(grow(np.arange(n), labels - p, p * (1 - p), -4.0, 4.0, 0))
            last = Trees(
                np.array(roots[-1:]), *map(np.array, (feature, threshold, left, right, value)), start=0.0, depth=depth
            )
            margin += last.margin(rows)
    arrays = (np.array(roots, dtype=np.int64), np.array(feature, dtype=np.int64), np.array(threshold, dtype=float),
              np.array(left, dtype=np.int64), np.array(right, dtype=np.int64), np.array(value, dtype=float))
    return Trees(*arrays, start=start, depth=depth)


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Trees:
    """Trees for ``quality`` (0 or 1) of ``labels`` (doc_id, quality), fitted on the statistics of at most ``sample``
    labelled documents. Rows without an id or a label are left out, as are ids with different labels; of rows that share an
    id those with the least hashes of the text come first. So the sample does not depend on the order of the rows."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(
        F.min("quality").cast("double").alias("quality"), F.max("quality").cast("double").alias("_most")
    )
    known = known.where("quality = _most").drop("_most").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    @pandas_udf("array<double>")
    def statistics(texts: pd.Series) -> pd.Series:
        return pd.Series([measure(t)[1] for t in texts], dtype=object)

    # At most ``sample`` ids, so that side is small however large the tables are.
    found = docs.select("doc_id", "text").join(F.broadcast(known), "doc_id").orderBy(F.xxhash64("doc_id", "text"), "quality")
    rows = found.limit(sample).select("quality", statistics("text").alias("x")).collect()
    x = np.array([r.x for r in rows], dtype=float).reshape(len(rows), len(FEATURES))
    return fit(x, np.array([r.quality for r in rows]), list(FEATURES.values()))


JUDGED = ", ".join(f"{c} long" for c in BASE) + ", base_failed boolean, score double, kept boolean"


def judge(docs: DataFrame, model: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` as struct ``row`` and, as struct ``judged``, counts, rules, score and verdict. Null and
    empty texts have zero counts and fail; an empty table stays empty."""

    @pandas_udf(JUDGED)
    def compute(texts: pd.Series) -> pd.DataFrame:
        measured = [measure(t) for t in texts]
        counts = pd.DataFrame([c for c, _ in measured], columns=list(BASE), dtype="int64")
        rows = np.array([s for _, s in measured], dtype=float).reshape(len(measured), len(FEATURES))
        failed = [base_failed(c[0], c[4]) for c, _ in measured]
        score = model.score(rows)
        return counts.assign(base_failed=failed, score=score, kept=~np.array(failed, dtype=bool) & (score >= keep_from))

    judged = inner_name(docs.columns, "judged")
    return docs.select(F.struct("*").alias("row"), compute("text").alias(judged)).select(
        "row", F.col(judged).alias("judged")
    )


def kept(docs: DataFrame, model: Trees, keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` that pass rules and model, unchanged."""
    return judge(docs, model, keep_from).where("judged.kept").select("row.*")
