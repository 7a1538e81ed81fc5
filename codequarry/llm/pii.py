"""Personal data by offset-preserving deobfuscation.

Detectors for e-mail addresses, IP addresses, card and phone numbers run on a text as it is; what
they find are the base spans. Then transducers rewrite the text, each output character keeping the
place of the source characters it came from: one character by character (look-alike letters,
full-width and foreign digits and marks, invisible characters), the others over disguises (dots
spelled or bracketed between numbers, digits spelled as words, "at" and "dot" in brackets or as words
between what would be an address, its local part included). Few digits spelled among plain ones are
rewritten where a detector finds something in the result. The same detectors run after each
transducer that changed the text, so none hides what another has shown, and their spans go back to
source places. A span inside one of its kind found before is dropped, so base spans always stay.

Places count code points, ends are exclusive. Every scan is linear in the text: no pattern can
start again inside a run it has failed on.

Defined results: a null text counts as empty and has no spans (``redacted`` leaves it null); rows
may repeat; null ids are fine; an empty table gives an empty result; other columns never matter.
"""

import hashlib
import re
import unicodedata

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, texts

Span = tuple[int, int]
KINDS = ("email", "ip", "card", "phone")

# What the base detectors match.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters that look like a Latin one, by the Latin one.
LOOK_ALIKES = {
    "a": "аα", "c": "с", "e": "е", "h": "һ", "i": "іι", "j": "ј", "k": "к", "n": "ո", "o": "оο", "p": "рρ",
    "q": "ԛ", "s": "ѕ", "u": "υս", "v": "ν", "w": "ԝ", "x": "х", "y": "у",
    "A": "АΑ", "B": "ВΒ", "C": "С", "E": "ЕΕ", "H": "НΗ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ",
    "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "X": "ХΧ", "Y": "ΥҮ", "Z": "Ζ",
    "-": "‐‑‒–−", ".": "。․", " ": "   　",
}
# Characters that show nothing.
INVISIBLE = "­​‌‍⁠﻿"
# Digits as words.
DIGITS = {
    "zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4",
    "five": "5", "six": "6", "seven": "7", "eight": "8", "nine": "9",
}
MARKS = {"dot": ".", "point": ".", "plus": "+", "dash": "-"}


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping ``[A-Za-z0-9._%+-]+@`` and a dotted domain, found from the @."""
    found: list[Span] = []
    free, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            found.append((start, domain.end()))
            free = domain.end()
        at = text.find("@", domain.end() if domain else at + 1)
    return found


def ips(text: str) -> list[Span]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) <= 3 and int(part or 0) <= 255

    return [m.span() for m in _IP.finditer(text) if all(map(small, m[0].split(".")))]


def _luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def cards(text: str) -> list[Span]:
    found = []
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and _luhn(digits):
            found.append(m.span())
    return found


def phones(text: str) -> list[Span]:
    if "+" not in text:
        return []
    return [m.span() for m in _PHONE.finditer(text) if 8 <= sum(c in "0123456789" for c in m[0]) <= 15]


# By kind: the detector, and the digits without which it can find nothing.
DETECTORS = {"email": (emails, 0), "ip": (ips, 4), "card": (cards, 16), "phone": (phones, 8)}


def base_spans(text: str) -> dict[str, list[Span]]:
    content = text.encode()
    digits = len(content) - len(content.translate(None, b"0123456789"))
    return {kind: find(text) if digits >= least else [] for kind, (find, least) in DETECTORS.items()}


class Rewritten:
    """A text after rewriting, with the source place of every character."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text))
        self.ends = self.starts + 1

    def replace(self, changes: list[tuple[int, int, str]]) -> None:
        """Put strings in place of spans, which come in order and do not overlap. Each character of
        a string stands for its whole span."""
        if not changes:
            return
        text, starts, ends, at = [], [], [], 0
        for a, b, new in [*changes, (len(self.text), len(self.text), "")]:
            text += [self.text[at:a], new]
            starts += [self.starts[at:a], np.full(len(new), self.starts[a] if new else 0)]
            ends += [self.ends[at:a], np.full(len(new), self.ends[b - 1] if new else 0)]
            at = b
        self.text, self.starts, self.ends = "".join(text), np.concatenate(starts), np.concatenate(ends)

    def source(self, span: Span) -> Span:
        return int(self.starts[span[0]]), int(self.ends[span[1] - 1])


def _characters() -> dict[str, str]:
    table = {c: plain for plain, same in LOOK_ALIKES.items() for c in same} | dict.fromkeys(INVISIBLE, "")
    for code in range(0xFF01, 0xFF5F):  # full-width forms, in the order of ASCII
        table[chr(code)] = chr(code - 0xFEE0)
    for code in range(0x80, 0x1FC00):
        value = unicodedata.decimal(chr(code), None)
        if value is not None:
            table[chr(code)] = str(value)
    return table


_PLAIN = _characters()
_IS_ODD = np.zeros(0x110000, bool)
_IS_ODD[[ord(c) for c in _PLAIN]] = True


def plain_characters(text: Rewritten) -> None:
    if text.text.isascii():
        return
    odd = np.flatnonzero(_IS_ODD[np.frombuffer(text.text.encode("utf-32-le"), np.uint32)])
    text.replace([(at, at + 1, _PLAIN[text.text[at]]) for at in odd.tolist()])


# Lower-cases A-Z and blanks everything but letters, ASCII digits and underscores: words of the
# result include every ASCII word that stands between word borders.
_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if chr(b).isalnum() and b < 128 or b == 95 else 32 for b in range(256)
)


def words(text: str) -> list[bytes]:
    return text.encode().translate(_WORDS).split()


_DIGIT_WORDS = frozenset(w.encode() for w in DIGITS)
_DOT_WORDS = frozenset((b"dot", b"point", b"punkt", b"punto"))
_WORD = "|".join(DIGITS)
_SPELLED = re.compile(rf"\b(?:{_WORD})\b", re.I)
# A run of digit words, numbers and marks; at least one step behind a digit word.
_ITEM = rf"(?:{_WORD}|{'|'.join(MARKS)}|[0-9]+)"
_RUN = re.compile(rf"\+?{_ITEM}(?:[\x20,-]{{1,3}}{_ITEM})*\b", re.I)
_TOKEN = re.compile(rf"{_ITEM}|\+", re.I)
_STARTER = re.compile(rf"(?<![A-Za-z0-9])(?:\+|plus[\x20,-]{{1,3}})?(?:{_WORD}|[0-9]+)(?=[\x20,-]{{1,3}}(?:{_WORD}|{'|'.join(MARKS)}|[0-9]))", re.I)
# Runs with as many digit words are rewritten as they are, others where a detector accepts the result.
LEAST_SPELLED = 3
_MARK_WORDS = frozenset(w.encode() for w in MARKS)
_COMMA = re.compile(r"[\x20-]*,[\x20,-]*")


def _joined(text: str, a: int, b: int) -> tuple[list[tuple[int, int, str]], str]:
    """The changes that make a run one string of digits and marks, and that string."""
    changes, out, last = [], [], a
    for m in _TOKEN.finditer(text, a, b):
        new = DIGITS.get(m[0].lower()) or MARKS.get(m[0].lower()) or m[0]
        if m.start() > last:
            changes.append((last, m.start(), ""))
        if new != m[0]:
            changes.append((*m.span(), new))
        out.append(new)
        last = m.end()
    return changes, "".join(out)


def _number(text: str) -> bool:
    return bool(ips(text) or cards(text) or phones(text))


def spelled_digits(text: Rewritten) -> None:
    """Runs with at least three digit words, and others that have a digit or mark spelled and hold an
    address or number when written out, become one string of digits and marks."""
    there = set(words(text.text))
    if there.isdisjoint(_DIGIT_WORDS) and there.isdisjoint(_MARK_WORDS):
        return
    changes, at = [], 0
    while start := _STARTER.search(text.text, at):
        run = _RUN.match(text.text, start.start())
        at = run.end() if run else start.end()
        if not run:
            continue
        if len(_first(_SPELLED, run[0], LEAST_SPELLED)) >= LEAST_SPELLED:
            changes += _joined(text.text, *run.span())[0]
            continue
        whole = [run.span()]
        commas = [m.span() for m in _COMMA.finditer(text.text, *run.span())]
        between = zip([run.start(), *(b for _, b in commas)], [*(a for a, _ in commas), run.end()])
        # A number with commas inside, or else numbers between commas.
        for spans in (whole, list(between) if commas else []):
            found = []
            for a, b in spans:
                if any(c.isalpha() for c in text.text[a:b]):
                    new, number = _joined(text.text, a, b)
                    found += new if _number(number) else []
            if found:
                changes += found
                break
    text.replace(changes)


def _first(pattern: re.Pattern, text: str, n: int) -> list[re.Match]:
    found = []
    for m in pattern.finditer(text):
        found.append(m)
        if len(found) == n:
            break
    return found


_AT = re.compile(r"\s{0,2}[\[({<]\s{0,2}at\s{0,2}[\])}>]\s{0,2}|\s{1,2}at\s{1,2}|\s{0,2}@\s{0,2}", re.I)
_BRACKETED = r"\s{0,2}[\[({<]\s{0,2}(?:dot|point|punkt|punto|\.)\s{0,2}[\])}>]\s{0,2}"
_BRACKETED_SIGN = re.compile(r"[\[({<]\s{0,2}\.\s{0,2}[\])}>]")
_DOT = rf"(?:{_BRACKETED}|\s{{1,2}}dot\s{{1,2}}|\.)"
_DOTS = re.compile(_DOT, re.I)
_DOT_BEFORE = re.compile(rf"(?:{_BRACKETED}|\s{{1,2}}dot\s{{1,2}})\Z", re.I)
# Longest spelled dot: five letters, a bracket and two blanks on either side, and two more outside.
_DOT_LENGTH = 15
_SPELLED_DOMAIN = re.compile(rf"[A-Za-z0-9-]+(?:{_DOT}[A-Za-z0-9-]+)+", re.I)
# Words behind a bare "at" that start no domain.
_NO_DOMAIN = frozenset(("a", "an", "the", "this", "that", "my", "our", "your", "his", "her", "their", "its"))


# Four numbers, each in digits or up to three digit words, with dots of any form between.
_OCTET = rf"(?:[0-9]++|\b(?:{_WORD})(?:[\x20-](?:{_WORD})){{0,2}}\b)"
_OCTET_DOT = rf"(?:{_BRACKETED}|\s{{1,2}}(?:dot|point|punkt|punto)\s{{1,2}}|\.)"
_SPELLED_IP = re.compile(rf"(?<![0-9]){_OCTET}(?:{_OCTET_DOT}{_OCTET}){{3}}", re.I)
_IP_TOKEN = re.compile(rf"(?P<dot>{_OCTET_DOT})|{_WORD}|[0-9]+|[\x20-]", re.I)


def _has_dots(text: str, there: set[bytes]) -> bool:
    return not there.isdisjoint(_DOT_WORDS) or bool(_BRACKETED_SIGN.search(text))


def spelled_dots(text: Rewritten) -> None:
    """Spelled and bracketed dots between four numbers become signs where that makes an IP address."""
    if not _has_dots(text.text, set(words(text.text))):
        return
    changes = []
    for run in _SPELLED_IP.finditer(text.text):
        new, out = [], []
        for m in _IP_TOKEN.finditer(text.text, *run.span()):
            plain = "." if m["dot"] else DIGITS.get(m[0].lower(), "" if m[0] in " -" else m[0])
            out.append(plain)
            if plain != m[0]:
                new.append((*m.span(), plain))
        if ips("".join(out)):
            changes += new
    text.replace(changes)


def _local_dots(text: str, end: int, free: int) -> list[Span]:
    """Spelled dots of the local part that ends at ``end``, in order; none starts before ``free``."""
    found = []
    while True:
        while end > free and text[end - 1] in _LOCAL:
            end -= 1
        dot = _DOT_BEFORE.search(text, max(free, end - _DOT_LENGTH), end)
        if not dot or dot.start() <= free or text[dot.start() - 1] not in _LOCAL:
            return found[::-1]
        found.append(dot.span())
        end = dot.start()


def spelled_addresses(text: Rewritten) -> None:
    """"at" and "dot" between the parts of an address become signs. A bare word "at" counts only
    where some dot is spelled too; plain addresses stay as they are. Dots count in the local part as
    in the domain."""
    there = set(words(text.text))
    if not _has_dots(text.text, there) and not (b"at" in there and any(c in text.text for c in "[({<")):
        return
    changes, free = [], 0
    for at in _AT.finditer(text.text):
        if at.start() <= free or text.text[at.start() - 1] not in _LOCAL:
            continue
        domain = _SPELLED_DOMAIN.match(text.text, at.end())
        if not domain:
            continue
        dots = list(_DOTS.finditer(text.text, domain.start(), domain.end()))
        spelled = [d for d in dots if d[0] != "."]
        bracket = at[0].strip()[0] in "[({<"
        bare = not bracket and at[0].strip() != "@"
        first = text.text[domain.start() : dots[0].start()].lower()
        if bare and first in _NO_DOMAIN:
            continue
        local = _local_dots(text.text, at.start(), free)
        if not (bracket or spelled or local):
            continue
        changes += [(*d, ".") for d in local]
        changes.append((*at.span(), "@"))
        changes += [(*d.span(), ".") for d in spelled]
        free = domain.end()
    text.replace(changes)


def all_spans(text: str, base: dict[str, list[Span]] | None = None) -> dict[str, list[Span]]:
    """Base spans and those found after rewriting, each kind in order."""
    spans = {kind: list(found) for kind, found in (base or base_spans(text)).items()}
    plain = Rewritten(text)
    for transducer in (plain_characters, spelled_dots, spelled_digits, spelled_addresses):
        before = plain.text
        transducer(plain)
        if plain.text == before:
            continue
        for kind, found in base_spans(plain.text).items():
            known, more, k = spans[kind], [], 0
            for a, b in map(plain.source, found):
                while k < len(known) and known[k][1] <= a:
                    k += 1
                if k == len(known) or not (known[k][0] <= a and b <= known[k][1]):
                    more.append((a, b))
            spans[kind] = sorted(known + more)
    return spans


def listed(spans: dict[str, list[Span]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind in KINDS for a, b in spans[kind])


def find(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (base spans), base_sha256, spans."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in part.column("text").to_pylist():
            base = base_spans(text)
            digest = hashlib.sha256(listed(base).encode()).hexdigest()
            rows.append((*(len(base[k]) for k in KINDS), digest, listed(all_spans(text, base))))
        kinds = [pa.int64()] * len(KINDS) + [pa.string()] * 2
        columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(kinds), kinds)]
        return pa.RecordBatch.from_arrays([part.column("doc_id"), *columns], names=names)

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return per_batch(texts(docs), batch, f"doc_id long, {counts}, base_sha256 string, spans string")


def masked(text: str) -> str:
    """The text with every span replaced by its kind in angle brackets; where spans of different
    kinds overlap, the first one names them all."""
    spans = sorted((a, b, kind) for kind, found in all_spans(text).items() for a, b in found)
    out, at = [], 0
    for a, b, kind in spans:
        if a >= at:
            out += [text[at:a], f"<{kind.upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:] if out else text


def redacted(docs: DataFrame) -> DataFrame:
    """The documents with personal data masked and ``n_chars``, where there is one, counted anew."""

    @F.pandas_udf("string")
    def mask(part: pd.Series) -> pd.Series:
        return part.map(lambda t: None if t is None else masked(t))

    out = docs.withColumn("text", mask("text"))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])
