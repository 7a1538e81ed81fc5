"""Quality rules by weak supervision.

Every rule votes good or bad on a document or abstains. How far a rule can be trusted is not set by
hand: votes are counted by pattern over all documents, and expectation-maximisation finds for each
rule how often it says what on good and on bad documents, and the share of good ones. A pattern's
posterior probability of being good then decides. There are at most 3 to the power of the number of
rules patterns (6,561), so what the driver fits on is bounded whatever the corpus, and counts every
document.

Defined results: a null text counts as one without words; it fails the base rules, as do texts of
under 20 words; rows may repeat; null ids are fine; an empty table gives an empty result; other
columns never matter.
"""

from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .common import per_batch, texts, whole_text

# The base definitions.
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30

_SPACES = " \t\n\x0b\x0c\r"
_UPPER = bytes(range(65, 91))
_LETTERS = _UPPER + bytes(range(97, 123)) + bytes(range(128, 256))
_ABSTAIN, _GOOD, _BAD = 0, 1, 2

FEATURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
    "n_lines", "n_upper", "n_letters", "n_bytes", "n_marks", "n_stutter",
)
# The rules, as two conditions each: when it votes bad, when good; else, or on null, it abstains.
# Rules for one defect are one rule: the fit takes rules as independent within good and bad texts,
# and would take two that fire together for the difference between them. Having no defect of one
# kind says nothing of the others, so single defects have no good vote; plain prose has.
RULES: tuple[tuple[str, str, str], ...] = (
    ("size", "n_words < 20", "n_words >= 50"),
    ("symbols", "n_symbols > 0.2 * n_words", "false"),
    ("repeats", "n_repeat_words > 0.3 * n_words OR n_stutter > 0.3 * n_words", "false"),
    ("lines", "n_dup_lines > 0.5 * n_lines", "false"),
    ("shouting", "n_upper > 0.4 * n_letters OR n_marks > 0.3 * n_words", "false"),
    ("words", "word_chars < 2.5 * n_words OR word_chars > 12 * n_words", "false"),
    ("letters", "n_letters < 0.6 * n_bytes", "false"),
    (
        "prose",
        "false",
        "n_symbols < 0.05 * n_words AND n_marks < 0.1 * n_words AND n_upper < 0.15 * n_letters"
        " AND n_letters > 0.8 * n_bytes AND n_repeat_words <= 0.3 * n_words AND n_stutter < 0.2 * n_words",
    ),
)
# Expectation-maximisation: documents' worth of prior belief that a rule is right rather than wrong
# when it votes, as a share of the corpus, and when to stop.
PRIOR = 0.02
ITERATIONS = 200
TOLERANCE = 1e-9


def repeated_words(words: list[bytes]) -> int:
    """Words in windows of eight that stand in the text twice or more, each counted once."""
    n = len(words) - WINDOW + 1
    if n < 2:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.uint64, len(words))
    if len(number) == len(words):
        return 0
    windows = np.lib.stride_tricks.sliding_window_view(ids, WINDOW)
    powers = np.cumprod(np.full(WINDOW, 0x9E3779B97F4A7C15, np.uint64))
    keys = (windows * powers).sum(axis=1, dtype=np.uint64)
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    if not same.any():
        return 0
    # Equal keys are only candidates: neighbours in key order must be equal word by word.
    at = np.flatnonzero(same)
    equal = (windows[order[at]] == windows[order[at + 1]]).all(axis=1)
    twice = np.zeros(n, bool)
    if equal.all():
        twice[order[at]] = twice[order[at + 1]] = True
    else:
        seen: dict[bytes, int] = {}
        for i in range(n):
            first = seen.setdefault(windows[i].tobytes(), i)
            if first != i:
                twice[[first, i]] = True
    edges = np.zeros(len(words) + 1, np.int64)
    edges[:n] += twice
    edges[WINDOW : WINDOW + n] -= twice
    return int(np.count_nonzero(np.cumsum(edges)))


def measured(text: str) -> tuple[int, ...]:
    """The features of one text, in the order of FEATURES."""
    content = text.encode()
    words = content.split()
    lines = [line for line in text.split("\n") if line.strip(_SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, _SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(content) - len(content.translate(None, _UPPER)),
        len(content) - len(content.translate(None, _LETTERS)),
        sum(map(len, words)),
        text.count("!") + text.count("?"),
        sum(map(eq, words, words[1:])),
    )


def features(docs: DataFrame) -> DataFrame:
    """(doc_id, *FEATURES) of each document."""

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = [measured(t) for t in part.column("text").to_pylist()]
        columns = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [[]] * len(FEATURES))]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=["doc_id", *FEATURES])

    return per_batch(texts(docs), batch, "doc_id long, " + ", ".join(f"{f} long" for f in FEATURES))


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))


def votes(rules: tuple[tuple[str, str, str], ...] = RULES) -> Column:
    """A vote pattern as one number, a base-3 digit for each rule."""
    pattern = F.lit(0)
    for _, bad, good in rules:
        vote = F.when(F.expr(bad), _BAD).when(F.expr(good), _GOOD).otherwise(_ABSTAIN)
        pattern = pattern * 3 + vote
    return pattern.cast("int")


def posteriors(counts: dict[int, int], n_rules: int = len(RULES)) -> dict[int, float]:
    """Probability of being good for each vote pattern, from the patterns' counts.

    Two classes, rules independent within a class. Bad texts are bad in one way or another, so the
    start believes any bad vote; from there each rule earns or loses its weight. A prior of a few
    documents keeps the classes from swapping and rare votes from certainty.
    """
    if not counts:
        return {}
    patterns = np.array(sorted(counts))
    weight = np.array([counts[p] for p in patterns.tolist()], float)
    digits = np.stack([patterns // 3**i % 3 for i in reversed(range(n_rules))], axis=1)
    good, bad = (digits == _GOOD).sum(axis=1), (digits == _BAD).sum(axis=1)
    belief = np.where(bad > 0, 0.1, (good + 1) / (good + 2))
    one_hot = digits[:, :, None] == np.arange(3)
    strength = PRIOR * weight.sum()
    # Beliefs about votes on [bad, good] documents: abstain, good, bad.
    prior = strength * np.array([[0.2, 0.3, 0.5], [0.1, 0.85, 0.05]])
    for _ in range(ITERATIONS):
        share = np.stack([weight * (1 - belief), weight * belief])
        says = np.einsum("cp,prv->crv", share, one_hot) + prior[:, None, :]
        says /= says.sum(axis=2, keepdims=True)
        classes = share.sum(axis=1) + strength * np.array([0.2, 0.8])
        log = np.log(classes / classes.sum())[:, None] + np.einsum("crv,prv->cp", np.log(says), one_hot)
        new = 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))
        if np.abs(new - belief).max() < TOLERANCE:
            belief = new
            break
        belief = new
    return dict(zip(patterns.tolist(), belief.tolist()))


def fitted(patterns: DataFrame) -> dict[int, float]:
    """Posteriors from a column ``pattern`` over all documents; at most 3**rules rows come back."""
    counted = patterns.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    return posteriors({r["pattern"]: r["n"] for r in counted.collect()})


def scored(rows: DataFrame, probability: dict[int, float]) -> DataFrame:
    """``rows`` with the posterior of their column ``pattern`` as ``p_good``.

    The table has at most 3**rules rows, so it is broadcast whatever the corpus.
    """
    table = rows.sparkSession.createDataFrame(list(probability.items()), "pattern int, p_good double")
    joined = rows.join(F.broadcast(table), "pattern", "left")
    return joined.withColumn("p_good", F.coalesce("p_good", F.lit(0.5)))


def judge(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """One row per document: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, kept, p_good."""
    rows = written(features(docs).withColumn("pattern", votes()), "quality-features")
    kept = ~F.col("base_failed") & (F.col("p_good") >= threshold)
    return scored(rows, fitted(rows)).withColumn("base_failed", base_failed()).select(
        "doc_id", *FEATURES[:5], "base_failed", kept.alias("kept"), "p_good"
    )


def passed(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """The documents the verdict keeps, with all their columns. Texts are measured twice, once to
    fit and once to filter, so that they need not move."""
    probability = fitted(features(docs).select(votes().alias("pattern")))

    def measure_all(part: pd.Series) -> pd.Series:
        return part.map(measured)

    # Said to be nondeterministic, so that the filter below doesn't measure once more.
    measure = F.pandas_udf(measure_all, "array<long>").asNondeterministic()
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, measure(whole_text()).alias("m"))
    rows = rows.select("row", *[F.col("m")[i].alias(f) for i, f in enumerate(FEATURES)])
    judged = scored(rows.withColumn("pattern", votes()), probability)
    return judged.where(~base_failed() & (F.col("p_good") >= threshold)).select("row.*")
