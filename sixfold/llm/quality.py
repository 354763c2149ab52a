"""Quality rules whose cutoffs are chosen on labelled texts so that few good texts are lost."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sixfold.llm.store import cut
from sixfold.llm.textscan import SPACED, VALUES, Texts, Words, extend, mix, span_hash, sums, windows

#: Steps from the most lenient rule set (0) to the strictest.
LEVELS = 24
#: Statistic -> cutoff at the most lenient and at the strictest step. A text is rejected above (for ``short_words``: below) it. The
#: strictest ones are those in common use for web text; all are fixed before any label is seen, and steps are spaced geometrically.
RULES = {
    "symbols": (2.0, 0.1),  # symbols a word
    "shouts": (1.0, 0.1),  # exclamation and question marks a word
    "capitals": (0.95, 0.3),  # share of A-Z among the ASCII letters
    "copied_lines": (0.9, 0.3),  # share of lines that are equal to an earlier one, beyond the first of them
    "copied_words": (0.5, 0.3),  # share of words in repeated windows
    "long_words": (40.0, 10.0),  # characters a word
    "short_words": (1.2, 3.0),
}


def cutoffs() -> dict[str, np.ndarray]:
    return {name: np.geomspace(a, b, LEVELS) for name, (a, b) in RULES.items()}


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, np.int64)
    table[list(chars)] = 1
    return table


_SYMBOL = _class(b"#*$%&|<>")
_SHOUT = _class(b"!?")
_CAPITAL = _class(bytes(range(65, 91)))
_LETTER = _CAPITAL + _class(bytes(range(97, 123)))
_POINT = np.array([(b & 0xC0) != 0x80 for b in range(256)], np.int64)  # first bytes of code points


def repeated(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key whether it stands there twice or more, and whether an equal one stands before it."""
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    later[order[1:][same]] = True
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return twice, later


def statistics(texts: Texts) -> dict[str, np.ndarray]:
    """Per text: the base counts, ``n_lines`` (lines with a word), ``n_shouts``, ``n_capitals``, ``n_letters``."""
    words = Words(texts, SPACED)
    owner = np.repeat(np.arange(texts.n), np.diff(texts.at))

    def count(table: np.ndarray, among: np.ndarray | None = None) -> np.ndarray:
        c = np.zeros(len(texts.buf) + 1, np.int64)
        np.cumsum(table[texts.buf] if among is None else table[texts.buf] * among, out=c[1:])
        return c[texts.at[1:]] - c[texts.at[:-1]]

    spaced = SPACED[texts.buf]
    c = sums(texts.buf, VALUES)
    h = span_hash(c, words.start, words.end)
    key, at = windows(words, h, 3)
    twice, _ = repeated(mix(key ^ mix(words.text[at].astype(np.uint64) + np.uint64(1))))
    covered = np.zeros(len(h) + 3, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    covered = covered[: len(h)]
    # Lines: from a text's start or a line feed to the next one.
    feeds = np.flatnonzero(texts.buf == 10)
    start = np.concatenate([texts.at[:-1], feeds + 1])
    line_text = np.concatenate([np.arange(texts.n), owner[feeds]])
    order = np.lexsort((start, line_text))
    start, line_text = start[order], line_text[order]
    last = np.ones(len(start), bool)
    last[:-1] = line_text[1:] != line_text[:-1]
    end = np.where(last, texts.at[line_text + 1], np.append(start[1:], 0) - 1) if len(start) else start
    filled = np.concatenate([[0], np.cumsum(spaced)])
    full = filled[end] > filled[start] if len(start) else np.zeros(0, bool)
    start, end, line_text = start[full], end[full], line_text[full]
    _, later = repeated(mix(span_hash(c, start, end) ^ mix(line_text.astype(np.uint64) + np.uint64(1))))
    return {
        "n_words": words.count,
        "word_chars": count(_POINT, spaced),
        "n_symbols": count(_SYMBOL),
        "n_dup_lines": np.bincount(line_text[later], minlength=texts.n),
        "n_repeat_words": np.bincount(words.text[covered], minlength=texts.n),
        "n_lines": np.bincount(line_text, minlength=texts.n),
        "n_shouts": count(_SHOUT),
        "n_capitals": count(_CAPITAL),
        "n_letters": count(_LETTER),
    }


def first_level(s: dict[str, np.ndarray]) -> np.ndarray:
    """The most lenient step at which some rule rejects each text; ``LEVELS`` if none does."""
    words, share = np.maximum(s["n_words"], 1), lambda a, b: a / np.maximum(b, 1)
    value = {
        "symbols": s["n_symbols"] / words,
        "shouts": s["n_shouts"] / words,
        "capitals": share(s["n_capitals"], s["n_letters"]),
        "copied_lines": share(np.maximum(s["n_dup_lines"] - 1, 0), s["n_lines"]),
        "copied_words": s["n_repeat_words"] / words,
        "long_words": s["word_chars"] / words,
        "short_words": s["word_chars"] / words,
    }
    level = np.full(len(words), LEVELS)
    for name, cuts in cutoffs().items():
        passed = np.searchsorted(cuts, value[name], "right") if name == "short_words" else np.searchsorted(-cuts, -value[name], "right")
        level = np.minimum(level, passed)
    return np.where(s["n_words"] > 0, level, LEVELS)


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial X, exact: terms are added from k downwards until they no longer count."""
    if k >= n:
        return 1.0
    log = math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1) + k * math.log(p) + (n - k) * math.log1p(-p)
    term = total = math.exp(log)
    if k > n * p:  # the terms rise first
        return 1.0
    for i in range(k, 0, -1):
        term *= i * (1 - p) / ((n - i + 1) * p)
        total += term
        if term < total * 1e-16:
            break
    return min(total, 1.0)


def choose_level(rejected: list[int], n: int, limit: float, error: float) -> int:
    """The strictest step that is shown to reject at most ``limit`` of the good texts; -1 if none.

    ``rejected[g]`` of ``n`` good texts are lost at step ``g``. Step by step from the lenient end, "more than ``limit`` are lost" is
    tested with the exact binomial tail, which is the same as an upper Clopper-Pearson bound below ``limit``; the first step that
    cannot be shown ends it. So testing many steps needs no further correction.
    """
    chosen = -1
    for g, k in enumerate(rejected):
        if not n or binomial_tail(k, n, limit) > error:
            break
        chosen = g
    return chosen


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: str = "lang", limit: float = 0.03, error: float = 0.05) -> DataFrame:
    """Judge every document by rules that lose at most ``limit`` of the good texts of each stratum, with confidence 1 - ``error``.

    ``docs`` has ``doc_id, text`` and the column ``stratum`` (null is a stratum); ``labels`` has ``doc_id, quality`` (1: good). A
    document is good if all its labels say so; labels of unknown documents and null ids do not count. The hold-out is every good
    document that passes the base rule. Nested rule sets are tried in fixed order per stratum (``choose_level``), each at ``error``
    divided by the number of strata that have labels. A stratum with too few labels gets no rules beyond the base rule.

    Returns ``doc_id``, the stratum, the counts, ``reject_level`` (first step that rejects; ``LEVELS``: none), ``chosen_level`` of the
    stratum (-1: none), ``base_failed`` and ``kept``. A null or empty text has no words and so fails the base rule; repeated rows are
    judged each; an empty table gives no rows. Only counts per stratum and step reach the driver, one row per stratum goes back.
    """

    def work(_, texts: Texts) -> dict:
        s = statistics(texts)
        return {**{name: s[name] for name in COUNTS}, "reject_level": first_level(s)}

    kinds = {name: ("bigint", pa.int64()) for name in (*COUNTS, "reject_level")}
    narrow = docs.select("doc_id", F.col(f"`{stratum}`").alias("stratum"), "text")
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    judged = cut(extend(narrow, work, kinds, without=("text",)).withColumn("base_failed", failed))
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality")).where("quality = 1").select("doc_id")
    counted = judged.where("NOT base_failed").join(good, "doc_id", "left_semi").groupBy("stratum", "reject_level").count().collect()
    strata: dict[str | None, list[int]] = {}
    for row in counted:
        strata.setdefault(row["stratum"], [0] * (LEVELS + 1))[row["reject_level"]] = row["count"]
    rows = [
        (name, choose_level(np.cumsum(at)[:LEVELS].tolist(), sum(at), limit, error / len(strata))) for name, at in strata.items()
    ]
    chosen = docs.sparkSession.createDataFrame(rows, "s string, chosen_level int")
    found = judged.join(F.broadcast(chosen), F.col("stratum").cast("string").eqNullSafe(F.col("s")), "left").withColumn("chosen_level", F.coalesce("chosen_level", F.lit(-1)))
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("reject_level") > F.col("chosen_level"))).drop("s")


def op3(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang")
    found = apply_rules(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    return found.select("doc_id", *COUNTS, "base_failed", "kept", F.col("stratum").alias("lang"), F.col("reject_level"), F.col("chosen_level").cast("long").alias("chosen_level"))


QUERIES = {"op3_quality_rules": (op3, None)}
