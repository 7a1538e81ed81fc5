"""Language identification by cross-parsing entropy.

A suffix automaton of each language's labelled text tells how far a text can be followed inside it.
A text is parsed from left to right into the longest phrases that occur in the language's text; a
phrase costs the logarithm of that text's length (a place to copy from) and that of the alphabet
(how far), so the short phrases of a short text are not cheap. A letter the language lacks costs as
much as a phrase of the longest text and a letter of the alphabet, alike in all languages. The
language with the fewest bits per character wins. Ties go to the first language by name.

The labelled sample is bounded: ``SAMPLE_DOCS`` documents and ``SAMPLE_CHARS`` characters a
language, chosen by a hash of their ids, so the automata have one size whatever the corpus. Texts to
predict are parsed whole, in lock-step over many at once, restarting every ``BLOCK`` characters so
that long texts spread over lanes; only letters count, lower-cased, other runs are one blank.

Defined results: null texts and texts without a letter are ``und`` with score 0, as is every text if
nothing was learned; labelled texts without a letter are not learned from, and a label that has no
others is never predicted; rows may repeat; rows with a null id are in no fold and neither learned from
nor held out; an empty table gives an empty result; other columns never matter.
"""

import hashlib
import json
import math
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import per_batch, texts

# The bound on labelled text, for each language.
SAMPLE_DOCS = 64
SAMPLE_CHARS = 40_000
# Ids ranked for each that is chosen.
SPARE = 4
# Columns of a language's table, for its most frequent letters; moves by others are sorted keys.
ALPHABET = 126
BLOCK = 2048
# Blocks parsed side by side.
LANES = 16_384
FOLDS = 5
UNKNOWN = "und"

# Symbols of letters outside the sample and of blanks; the state between phrases.
_OTHER, _BLANK = 0, 1
_START = 1


def fold(doc_id: str | Column = "doc_id") -> Column:
    id_ = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(id_.cast("string")), F.lit(FOLDS))


def sample(docs: DataFrame, max_docs: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> dict[str, str]:
    """Labelled text of each language, from the documents of all folds but 0.

    Chosen on distinct ids alone: a language's ids are counted (approximately), and only those with a
    hash below what about ``SPARE`` times as many as asked for have are ranked. So few rows of a
    language meet in one task, however many rows or tasks there are. Texts are fetched for the chosen ids only,
    one for each id (the smallest beginning, where its rows differ), and share the characters
    evenly; what short ones leave goes to the longer.
    """
    labelled = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "lang", F.col("text")
    ).where((fold() != 0) & F.col("lang").isNotNull() & F.col("text").rlike(r"[\p{L}\p{M}]"))
    keyed = labelled.select("lang", F.xxhash64("doc_id").alias("order"), "doc_id")
    counts = keyed.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    share = F.col("order") / F.lit(2.0**64) + F.lit(0.5)
    low = share * F.col("ids") <= F.lit(float(SPARE * max_docs))
    # One row a language, as few as the sample has texts for.
    keyed = keyed.join(F.broadcast(counts), "lang").where(low | F.col("doc_id").isNull()).select("lang", "order", "doc_id").distinct()
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("order", "doc_id"))
    chosen = keyed.withColumn("rank", rank).where(F.col("rank") <= max_docs).select("lang", "doc_id")
    rows = labelled.join(F.broadcast(chosen), ["lang", "doc_id"], "left_semi")
    part = F.substring("text", 1, max_chars)
    one = rows.groupBy("lang", "doc_id").agg(F.min(part).alias("part"))
    found: dict[str, list[tuple]] = {}
    for r in one.select("lang", F.xxhash64("doc_id").alias("order"), "doc_id", "part").collect():
        found.setdefault(r["lang"], []).append((r["order"], r["doc_id"], r["part"]))
    return {lang: _even([p for *_, p in sorted(parts)], max_chars) for lang, parts in sorted(found.items())}


def _even(parts: list[str], max_chars: int) -> str:
    """The beginnings of texts, joined, as evenly long as they and ``max_chars`` allow."""
    left = max(0, max_chars - (len(parts) - 1))
    share = [0] * len(parts)
    for done, k in enumerate(sorted(range(len(parts)), key=lambda k: len(parts[k]))):
        share[k] = min(len(parts[k]), -(-left // (len(parts) - done)))
        left -= share[k]
    return "\n".join(p[:n] for p, n in zip(parts, share))[:max_chars]


def _automaton(symbols: list[int]) -> tuple[list[dict[int, int]], int]:
    """Transitions of the suffix automaton; state 0 is the start."""
    step: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in symbols:
        new, p = len(step), last
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        while p >= 0 and c not in step[p]:
            step[p][c] = new
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                copy = len(step)
                step.append(dict(step[q]))
                length.append(length[p] + 1)
                link.append(link[q])
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[new] = copy
        last = new
    return step, len(symbols)


class _Part(NamedTuple):
    """One language's automaton."""

    column: np.ndarray
    table: np.ndarray
    columns: int
    keys: np.ndarray
    targets: np.ndarray
    again: np.ndarray

    def move(self, state: np.ndarray, symbols: np.ndarray, width: int) -> np.ndarray:
        column = self.column[symbols]
        new = self.table[state * self.columns + column]
        if len(self.keys):
            rare = np.flatnonzero(column == 0)
            if len(rare):
                symbol = symbols[rare]
                key = state[rare].astype(np.int64) * width + symbol
                at = np.searchsorted(self.keys, key).clip(max=len(self.keys) - 1)
                new[rare] = np.where(self.keys[at] == key, self.targets[at], self.again[symbol])
        return new


class Models:
    """All languages' automata as tables.

    Every letter of the sample has a symbol; letters outside it are one symbol that all languages
    lack. A language's table has columns for the blank and its most frequent letters, and column 0
    for all other symbols. A cell has the next state for (state, column); where there is none, minus
    the state after starting a new phrase with that symbol. Each language also has a row for being
    between phrases, where a text begins and where a symbol leads that the language lacks (a phrase
    of its own). Moves by the language's rarer letters are looked up by (state, symbol) in a sorted
    list. State 0 is never used, so signs are never lost.
    """

    def __init__(self, labelled: dict[str, str]):
        raw = {lang: self._raw(text) for lang, text in sorted(labelled.items())}
        self.languages = [lang for lang, c in raw.items() if (c != _BLANK).any()]
        codes = [raw[lang] for lang in self.languages]
        letters = np.unique(np.concatenate(codes)) if codes else np.empty(0, np.uint32)
        letters = letters[letters > _BLANK]
        self.symbols = np.zeros(0x110000, np.int32)
        self.symbols[_BLANK] = _BLANK
        self.symbols[letters] = np.arange(2, 2 + len(letters))
        self.width = 2 + len(letters)
        self.parts = [self._part(self.symbols[c]) for c in codes]
        lengths = [math.log2(max(2, len(c))) for c in codes]
        # Bits of a phrase in each language, and of a letter a language lacks in all.
        letter = math.log2(self.width)
        self.bits = np.array(lengths) + letter
        self.literal = max(lengths, default=0.0) + 2 * letter

    def _part(self, symbols: np.ndarray) -> "_Part":
        step, _ = _automaton(symbols.tolist())
        values, counts = np.unique(symbols[symbols > _BLANK], return_counts=True)
        frequent = np.sort(values[np.lexsort((values, -counts))][: ALPHABET - 2])
        column = np.zeros(self.width, np.int32)
        column[_BLANK] = 1
        column[frequent] = np.arange(2, 2 + len(frequent))
        columns = column.tolist()
        table = np.zeros((_START + 1 + len(step), 2 + len(frequent)), np.int32)
        rare: list[tuple[int, int]] = []
        for state, moves in enumerate(step, _START + 1):
            for symbol, target in moves.items():
                if columns[symbol]:
                    table[state, columns[symbol]] = _START + 1 + target
                else:
                    rare.append((state * self.width + symbol, _START + 1 + target))
        begin = table[_START + 1]
        table = np.where(table > 0, table, -np.where(begin > 0, begin, _START)).astype(np.int32)
        # After starting a new phrase with a symbol that has no column.
        again = np.full(self.width, -_START, np.int32)
        for symbol, target in step[0].items():
            again[symbol] = -(_START + 1 + target)
        keys, targets = np.array(sorted(rare), np.int64).reshape(-1, 2).T
        return _Part(column, table.ravel(), table.shape[1], keys.copy(), targets.astype(np.int32), again)

    @staticmethod
    def _raw(text: str) -> np.ndarray:
        """Lower-cased letters as code points, every run of anything else as one blank."""
        codes = np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)
        codes = np.where(_letters()[codes], codes, _BLANK)
        return codes[np.r_[True, (codes[1:] != _BLANK) | (codes[:-1] != _BLANK)]] if len(codes) else codes

    def coded(self, text: str) -> np.ndarray:
        """A text's symbols; empty if it has no letter."""
        codes = self._raw(text)
        return self.symbols[codes] if (codes != _BLANK).any() else np.empty(0, np.int32)

    def phrases(self, blocks: list[np.ndarray]) -> np.ndarray:
        """Phrases of each block (rows) in each language (columns)."""
        return self.parsed(blocks)[0]

    def parsed(self, blocks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Phrases of each block (rows) in each language (columns), and how many of them are letters
        the language lacks."""
        out = np.zeros((len(blocks), len(self.languages)), np.int64)
        lacking = np.zeros_like(out)
        order = sorted(range(len(blocks)), key=lambda i: -len(blocks[i]))
        for a in range(0, len(order), LANES):
            lanes = order[a : a + LANES]
            sizes = np.array([len(blocks[i]) for i in lanes])
            symbols = np.zeros((sizes[0], len(lanes)), np.int32)
            for k, i in enumerate(lanes):
                symbols[: sizes[k], k] = blocks[i]
            # Lanes come longest first, so those still running are the first ones.
            running = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")
            for lang, part in enumerate(self.parts):
                state = np.full(len(lanes), _START, np.int32)
                count = np.zeros(len(lanes), np.int32)
                lacks = np.zeros(len(lanes), np.int32)
                for at in range(sizes[0]):
                    n = running[at]
                    new = part.move(state[:n], symbols[at, :n], self.width)
                    count[:n] += new < 0
                    lacks[:n] += new == -_START
                    np.abs(new, out=state[:n])
                out[lanes, lang] = count
                lacking[lanes, lang] = lacks
        return out, lacking

    def predict(self, batch: list[str | None]) -> list[tuple[str, float]]:
        """(language, score) of each text; the score is the winner's margin over the next, as a share."""
        owners, blocks, size = [], [], [0] * len(batch)
        for k, text in enumerate(batch):
            symbols = self.coded(text) if text else np.empty(0, np.int32)
            size[k] = len(symbols)
            for a in range(0, len(symbols), BLOCK):
                owners.append(k)
                blocks.append(symbols[a : a + BLOCK])
        if not self.languages or not blocks:
            return [(UNKNOWN, 0.0)] * len(batch)
        phrases, lacking = self.parsed(blocks)
        total = np.zeros((len(batch), len(self.languages)))
        np.add.at(total, owners, (phrases - lacking) * self.bits + lacking * self.literal)
        bits = total / np.maximum(1, size)[:, None]
        best = bits.argmin(axis=1)
        ranked = np.sort(bits, axis=1)
        margin = 1 - ranked[:, 0] / ranked[:, 1].clip(1e-12) if len(self.languages) > 1 else np.ones(len(batch))
        return [
            (self.languages[b], float(min(1.0, max(0.0, m)))) if n else (UNKNOWN, 0.0)
            for b, m, n in zip(best.tolist(), margin.tolist(), size)
        ]


_LETTERS: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _LETTERS:
        points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
        is_letter = np.zeros(0x110000, bool)
        for m in regex.finditer(r"[\p{L}\p{M}]+", points.tobytes().decode("utf-32-le")):
            is_letter[points[m.start() : m.end()]] = True
        _LETTERS.append(is_letter)
    return _LETTERS[0]


_MODELS: dict[str, Models] = {}


def models(labelled: str) -> Models:
    """The worker's one set of models, from the sample as JSON."""
    key = hashlib.sha256(labelled.encode()).hexdigest()
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = Models(json.loads(labelled))
    return _MODELS[key]


def identify(docs: DataFrame, max_docs: int = SAMPLE_DOCS, max_chars: int = SAMPLE_CHARS) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    labelled = json.dumps(sample(docs, max_docs, max_chars))
    # The sample itself travels (a bounded number of characters a language); workers build the automata.
    shared = docs.sparkSession.sparkContext.broadcast(labelled)

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        found = models(shared.value).predict(part.column("text").to_pylist())
        languages, scores = zip(*found) if found else ((), ())
        return pa.RecordBatch.from_arrays(
            [*part.columns[:2], pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
            names=["doc_id", "held_out", "lang_pred", "score"],
        )

    rows = texts(docs).select("doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "text")
    return per_batch(rows, batch, "doc_id long, held_out boolean, lang_pred string, score double")
