"""Secrets in texts: patterns propose candidates, a random forest takes away the false ones.

A candidate is the value given to something called token, key, password or the like, the password in an address, a long
word with a digit or in mixed case, or a private key block. The forest sees its length, its changes between kinds of characters, how much of it is made of
dictionary words, whether it looks like part of a path or host name, and the words beside it. It is trained on labelled
findings whose features come from the same expressions.

All of it is DataFrame and SQL functions; texts without a candidate cost two searches and nothing else.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import inner_name
from ledgerline.llm.labelled_findings import labelled_findings

# How candidates look. Long words are entered at their beginning only, so that a search stays linear.
NAMES = r"(?i:api[_-]?key|access[_-]?key|private[_-]?key|client[_-]?secret|passphrase|password|passwd|pass|pwd|secret|token)"
GIVES = r"[ \t]*+(?:=>|:=|==|[:=])[ \t]*+[\"']?"
# A name may end a longer one, which is entered where a long word would be.
HEAD = r"(?:(?<![A-Za-z0-9_+/=.\-])[A-Za-z0-9_.\-]{0,40}?)?" + NAMES + r"[\"']?" + GIVES
GIVEN = HEAD + r"[^\s\"']{6,}"
ADDRESS = r"://[^\s/:@\"'<>]{0,64}:"
INSIDE = ADDRESS + r"[^\s/@\"'<>]{3,}+(?=@)"
MIXED = r"(?=[A-Z0-9_+/=.\-]*+[a-z][a-z0-9_+/=.\-]*+[A-Z])"
LONG = r"(?<![A-Za-z0-9_+/=.\-])(?:(?=[A-Za-z_+/=.\-]*+[0-9])|" + MIXED + r")[A-Za-z0-9_+/=.\-]{16,}"
BLOCK = r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----[A-Za-z0-9+/=\s]*+(?:-----END [A-Z ]{0,40}PRIVATE KEY-----)?"
CANDIDATE = f"{BLOCK}|{GIVEN}|{INSIDE}|{LONG}"
# Forms of known issuers, which name the kind of a finding.
KINDS = {
    "private_key": r"^-----BEGIN ",
    "cloud_key": r"^A(KIA|SIA)[0-9A-Z]{16}$",
    "repository_token": r"^(gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20})",
    "chat_token": r"^xox[abprs]-[0-9A-Za-z-]{10,}",
    "payment_key": r"^(sk|rk)_(live|test)_[0-9A-Za-z]{16,}",
    "web_token": r"^eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.",
    "hex": r"^[0-9A-Fa-f]{24,}$",
}
GOOD_WORDS = r"(?i)(token|key|secret|passw|passphrase|pass[\"']?\s*[:=]|pwd|auth|bearer|credential|login)"
BAD_WORDS = r"(?i)(sha[0-9]|md5|checksum|commit|hash|uuid|isbn|version|digest|image|color|serial|order|id )"
PLACEHOLDER = r"(?i)(your|example|sample|here|xxxx|0000|1234|change|dummy|placeholder)"
NEAR = 40  # characters beside a candidate that are looked at
# The dictionary: the words that stand in most documents.
DICTIONARY_WORDS, WORD_LETTERS = 2_000, 3
KEEP_FROM = 0.5
TREES, DEPTH = 40, 8


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """A row for each candidate in column ``text`` of ``docs``: the other columns as struct ``row``, its ``value``,
    ``start`` and ``end`` (code points) and the text ``before`` and ``after`` it. Null and empty texts have none."""
    row = inner_name(docs.columns, "row")
    others = [c for c in docs.columns if c != text]
    cut = (
        docs.select(F.struct(*others).alias(row), F.col(text).alias("_text"))
        .withColumn("_found", F.regexp_extract_all("_text", F.lit(f"({CANDIDATE})")))
        .where(F.size("_found") > 0)
        .withColumn("_between", F.split(F.col("_text"), CANDIDATE, -1))
    )
    # The lengths of the matches and of what lies between them, summed up in blocks, give the places. Each array is used
    # twice below, which keeps the optimizer from computing it anew for every element.
    cut = cut.withColumn("_len", F.expr("zip_with(_between, _found, (b, f) -> length(b) + coalesce(length(f), 0))"))
    sums = "transform(sequence(0, (size(_len) - 1) div 256), j -> aggregate(slice(_len, int(j * 256 + 1), 256), 0, (a, x) -> a + x))"
    cut = cut.withColumn("_block", F.expr(f"aggregate({sums}, array(0), (a, n) -> concat(a, array(a[size(a) - 1] + n)))"))
    within = "aggregate(slice(_len, int((i div 256) * 256 + 1), int(i % 256 + 1)), 0, (a, y) -> a + y)"
    cut = cut.withColumn("_end", F.expr(f"transform(_len, (x, i) -> int(_block[0] + _block[int(i div 256)] + {within}))"))
    matches = F.transform(
        "_found",
        lambda m, i: F.struct(
            m.alias("match"),
            F.get("_end", i).alias("end"),
            F.right(F.get("_between", i), F.lit(NEAR)).alias("before"),
            F.left(F.get("_between", i + F.size("_end") - F.size("_found")), F.lit(NEAR)).alias("after"),
        ),
    )
    spread = cut.select(F.col(row).alias("row"), F.explode(matches).alias("_m")).select("row", "_m.*")
    value = F.when(F.col("match").rlike(f"^{GIVEN}"), F.regexp_extract("match", f"^{HEAD}([^\\s\"']+)$", 1))
    value = value.when(F.col("match").startswith("://"), F.regexp_extract("match", f"^{ADDRESS}(.+)$", 1))
    spread = spread.withColumn("value", F.coalesce(F.when(value != "", value), F.col("match")))
    named = F.expr("substring(match, 1, length(match) - length(value))")
    start = F.col("end") - F.length("value")
    return spread.select("row", "value", start.alias("start"), "end", F.concat("before", named).alias("before"), "after")


def _share(value: Column, characters: str) -> Column:
    return 1 - F.length(F.regexp_replace(value, characters, "")) / F.length(value)


def features(found: DataFrame, dictionary: list[str]) -> tuple[DataFrame, list[str]]:
    """``found`` with the forest's features as columns ``f_...``, and their names."""
    value, before, after = F.col("value"), F.col("before"), F.col("after")
    # One character for each run of a kind.
    runs = value
    for kind, mark in (("[a-z]+", "a"), ("[A-Z]+", "b"), ("[0-9]+", "c"), ("[^abc]+", "d")):
        runs = F.regexp_replace(runs, kind, mark)
    words = F.regexp_extract_all(value, F.lit(f"([A-Z]?[a-z]{{{WORD_LETTERS - 1},}}|[A-Z]{{{WORD_LETTERS},}})"))
    known = F.filter(words, lambda w: F.array_contains(F.from_json(F.lit(json.dumps(dictionary)), "array<string>"), F.lower(w)))
    covered = F.aggregate(known, F.lit(0), lambda n, w: n + F.length(w))
    pairs = F.lower(F.regexp_replace(value, "[^A-Za-z]", ""))
    columns = {
        "length": F.least(F.length(value), F.lit(400)),
        "changes": F.length(runs) / F.length(value),
        "digits": _share(value, "[0-9]"),
        "upper": _share(value, "[A-Z]"),
        "lower": _share(value, "[a-z]"),
        "marks": _share(value, "[^A-Za-z0-9]"),
        "hexadecimal": value.rlike("^([0-9a-f]+|[0-9A-F]+)$").cast("double"),
        "different": F.size(F.array_distinct(F.split(value, ""))) / F.least(F.length(value), F.lit(64)),
        "vowels": (F.length(pairs) - F.length(F.regexp_replace(pairs, "[aeiou]", ""))) / F.greatest(F.length(pairs), F.lit(1)),
        "covered": covered / F.length(value),
        "placeholder": value.rlike(PLACEHOLDER).cast("double"),
        "slashes": F.length(F.regexp_replace(value, "[^/]", "")),
        "dots": F.length(F.regexp_replace(value, "[^.]", "")),
        "path": (value.rlike(r"^/|\.[a-z]{2,4}$") | before.rlike(r"(://|/|www\.)\S*$")).cast("double"),
        "host": (value.rlike(r"^[A-Za-z0-9.-]+\.[a-z]{2,6}$") | before.rlike("@$")).cast("double"),
        "given": before.rlike(f"{GIVES}$").cast("double"),
        "address": before.rlike(f"{ADDRESS}$").cast("double"),
        "quoted": before.rlike("[\"']$").cast("double"),
        "good_word": before.rlike(GOOD_WORDS).cast("double"),
        "bad_word": before.rlike(BAD_WORDS).cast("double"),
        "good_after": after.rlike(GOOD_WORDS).cast("double"),
        "known_form": F.greatest(*[value.rlike(p).cast("double") for k, p in KINDS.items() if k != "hex"]),
    }
    return found.withColumns({f"f_{k}": c.cast("double") for k, c in columns.items()}), [f"f_{k}" for k in columns]


def dictionary_of(docs: DataFrame) -> list[str]:
    """The words that stand in most rows of ``docs`` (text), counted over all of them; ties by the word."""
    found = F.regexp_extract_all(F.lower("text"), F.lit(f"(\\b[a-z]{{{WORD_LETTERS},}}\\b)"))
    words = docs.where("text is not null").select(F.explode(F.array_distinct(found)).alias("w"))
    top = words.groupBy("w").count().orderBy(F.desc("count"), "w").limit(DICTIONARY_WORDS)
    return sorted(r["w"] for r in top.collect())


def train(spark: SparkSession, dictionary: list[str], seed: int = 3) -> RandomForestClassificationModel:
    """A forest fitted on the labelled findings."""
    lines = json.dumps([{"text": t, "label": y} for t, y in labelled_findings()])
    shown = spark.range(1).select(F.inline(F.from_json(F.lit(lines), "array<struct<text: string, label: double>>")))
    rows, names = features(candidates(shown), dictionary)
    rows = VectorAssembler(inputCols=names, outputCol="_features").transform(rows.withColumn("_label", F.col("row.label")))
    forest = RandomForestClassifier(
        featuresCol="_features", labelCol="_label", numTrees=TREES, maxDepth=DEPTH, minInstancesPerNode=2, seed=seed
    )
    # The copy leaves the training summary behind, which holds the session and must not travel to the executors.
    return forest.fit(rows.select("_features", "_label")).copy()


def kind(value: Column) -> Column:
    named = F.lit("generic")
    for name, pattern in reversed(KINDS.items()):
        named = F.when(value.rlike(pattern), F.lit(name)).otherwise(named)
    return named


def scan(docs: DataFrame, model: RandomForestClassificationModel, dictionary: list[str], keep_from: float = KEEP_FROM) -> DataFrame:
    """The columns of ``docs`` but its text as struct ``row``, once for each secret, with its ``kind``, ``start``, ``end``, ``value`` and
    ``score``. An empty table gives no rows."""
    rows, names = features(candidates(docs), dictionary)
    assembled = VectorAssembler(inputCols=names, outputCol="_features").transform(rows)
    judged = model.setFeaturesCol("_features").transform(assembled)
    score = vector_to_array("probability")[1]
    kept = judged.withColumn("score", score).where(F.col("score") >= keep_from)
    return kept.select("row", kind(F.col("value")).alias("kind"), "start", "end", "value", "score")


def secrets_of(docs: DataFrame) -> DataFrame:
    """doc_id, kind, start, end (code points), SHA-256 of the secret and score of each secret in ``docs`` (doc_id,
    text, more). Null and empty texts have none, repeated rows are scanned each, null ids are kept, texts of any length are
    scanned whole, and an empty table gives no rows."""
    docs = docs.select("doc_id", "text")
    dictionary = dictionary_of(docs)
    found = scan(docs, train(docs.sparkSession, dictionary), dictionary)
    return found.select("row.doc_id", "kind", "start", "end", F.sha2("value", 256).alias("secret_sha256"), "score")
