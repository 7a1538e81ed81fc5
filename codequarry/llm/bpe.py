"""Byte-level BPE encoding by prefix dynamic programming, and decoding.

Every prefix of a byte string has exactly one token that its encoding ends with: the token that
fits the end of the prefix, and fits behind the last token of the prefix before it. Two tokens fit
when merging their joined bytes gives the two of them back; a sequence whose neighbours all fit is
the encoding. So one token per prefix is stored, found from earlier ones in a few look-ups; reading
back from the end gives the tokens. The table stays valid when bytes are appended, and after an
edit it is filled again only until it agrees with the old one over the longest token's length.

Defined results: a null text counts as empty and has no ids; rows may repeat; a null id is a value
like any other; an empty table gives an empty result; other columns never matter. A piece of any
length takes time in proportion to it.
"""

import base64
import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame

from .common import per_batch, texts
from .pretokens import splitter

# What a worker remembers: ids of pieces (about 200 bytes each) and fits of token pairs.
PIECES = 600_000
PIECE_CHARS = 64
PAIRS = 500_000


def read_ranks(source: bytes) -> dict[bytes, int]:
    """A rank file's lines: base64 of the token's bytes, rank."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, source.splitlines())}


def merged(piece: bytes, ranks: dict[bytes, int], below: float = float("inf")) -> list[bytes]:
    """Byte-pair merging as defined: the lowest-ranked neighbours merge first, the left ones of
    equals; only ranks under ``below``."""
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= below:
            break
        parts[at : at + 2] = [parts[at] + parts[at + 1]]
    return parts


class Vocabulary:
    """A rank file, made ready for prefix tables."""

    def __init__(self, ranks: dict[bytes, int]):
        for b in range(256):
            if bytes([b]) not in ranks:
                raise ValueError(f"no token for byte {b}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.longest = max(map(len, ranks))
        halves: dict[int, tuple[int, int] | None] = {}
        for token, rank in ranks.items():
            parts = merged(token, ranks, rank) if len(token) > 1 else [token]
            if len(parts) == 1:
                halves[rank] = None
            elif len(parts) == 2 and all(ranks[p] < rank or len(p) == 1 for p in parts):
                halves[rank] = (ranks[parts[0]], ranks[parts[1]])
            # Else merging never ends in this token, so no encoding has it.
        # Left and right edge of each token's merge tree, from byte to whole token, with the rank
        # at which each node is merged into the next.
        self._left = {t: self._edge(t, halves, 0) for t in halves}
        self._right = {t: self._edge(t, halves, 1) for t in halves}
        # Every ending of a token: its id, or -1 where it is no token itself.
        self.endings: dict[bytes, int] = {}
        for t in halves:
            token = self.bytes_of[t]
            for i in range(1, len(token)):
                self.endings.setdefault(token[i:], -1)
        self.endings |= {self.bytes_of[t]: t for t in halves}
        self.known_fits: dict[int, bool] = {}

    def _edge(self, token: int, halves: dict, side: int) -> list[tuple[bytes, float]]:
        edge, until = [], float("inf")
        while True:
            edge.append((self.bytes_of[token], until))
            if not halves[token]:
                return edge[::-1]
            until, token = token, halves[token][side]

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the joined bytes of tokens a and b gives a and b."""
        known, key = self.known_fits, a << 32 | b
        if key not in known:
            if len(known) >= PAIRS:
                known.clear()
            known[key] = self._stand(self._right[a], self._left[b])
        return known[key]

    def _stand(self, left: list[tuple[bytes, float]], right: list[tuple[bytes, float]]) -> bool:
        """Follow the two nodes that meet at the border as they grow; a merge across it that comes
        before either grows would have joined them."""
        i = j = 0
        while True:
            (x, x_until), (y, y_until) = left[i], right[j]
            across = self.ranks.get(x + y)
            # Of equal ranks the left merge comes first: x grows before, y after the border's.
            if across is not None and across < x_until and across <= y_until:
                return False
            if x_until == y_until == float("inf"):
                return True
            if x_until <= y_until:
                i += 1
            else:
                j += 1


class PrefixTable:
    """The encoding of some bytes, as the last token of each of their prefixes."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = []
        self.append(data)

    def _fill(self, upto: int) -> None:
        """The last tokens of the prefixes up to this length, from those that are there."""
        data, last = self.data, self.last
        endings, known, fits = self.vocabulary.endings, self.vocabulary.known_fits, self.vocabulary.fits
        for end in range(len(last) + 1, upto + 1):
            for at in range(end - 1, -1, -1):
                token = endings.get(data[at:end])
                if token is None:
                    raise ValueError("the ranks give no encoding")
                if token >= 0:
                    if not at:
                        break
                    before = last[at - 1]
                    fit = known.get(before << 32 | token)
                    if fit or fit is None and fits(before, token):
                        break
            else:
                raise ValueError("the ranks give no encoding")
            last.append(token)

    def append(self, more: bytes) -> None:
        """Exact: no earlier entry changes."""
        self.data += more
        self._fill(len(self.data))

    def replace(self, start: int, stop: int, new: bytes) -> int:
        """Put ``new`` in place of bytes start to stop; returns how many entries were filled again.

        An entry depends on as many bytes and entries before it as the longest token has, so once
        that many behind the edit agree with the old table, the rest of it holds.
        """
        old, shift = self.last, len(new) - (stop - start)
        self.data = self.data[:start] + new + self.data[stop:]
        self.last = old[:start]
        agree, edited = 0, start + len(new)
        for end in range(start + 1, len(self.data) + 1):
            self._fill(end)
            if end > edited:
                agree = agree + 1 if self.last[-1] == old[end - shift - 1] else 0
                if agree >= self.vocabulary.longest:
                    self.last += old[end - shift :]
                    return end - start
        return len(self.data) - start

    def ids(self) -> list[int]:
        out, end = [], len(self.data)
        while end:
            token = self.last[end - 1]
            out.append(token)
            end -= len(self.vocabulary.bytes_of[token])
        return out[::-1]


class Codec(dict):
    """Texts to ids and back; as a dict it maps a piece of text to its ids."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        super().__init__()
        self.vocabulary = Vocabulary(ranks)
        self._split = splitter(pattern)
        self._names = {t: str(t) for t in self.vocabulary.bytes_of}

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(PrefixTable(self.vocabulary, piece.encode()).ids())
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = ids
        return ids

    def encode(self, text: str) -> list[int]:
        out: list[int] = []
        for piece in self._split(text):
            out += self[piece]
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))

    def decimals(self, ids: list[int]) -> str:
        return ",".join(map(self._names.__getitem__, ids))


_CODECS: dict[tuple, Codec] = {}


def codec(source: bytes, pattern: str) -> Codec:
    """The worker's one codec."""
    key = (hashlib.sha256(source).digest(), pattern)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(read_ranks(source), pattern)
    return _CODECS[key]


def _mapped(df: DataFrame, source: bytes, pattern: str, row, schema: str, column: str) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(source)  # the rank file: under a MiB, whatever the data

    def batch(part: pa.RecordBatch) -> pa.RecordBatch:
        own = codec(shared.value, pattern)
        made = [row(own, v) for v in part.column(column).to_pylist()]
        columns = [part.column("doc_id"), *map(list, zip(*made))] if made else [[] for _ in range(schema.count(",") + 1)]
        return pa.RecordBatch.from_arrays(
            [c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, _types(schema))],
            names=[f.split()[0] for f in schema.split(", ")],
        )

    return per_batch(df, batch, schema)


def _types(schema: str) -> list[pa.DataType]:
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "array<int>": pa.list_(pa.int32())}
    return [kinds[f.split()[1]] for f in schema.split(", ")]


def encode(docs: DataFrame, source: bytes, pattern: str) -> DataFrame:
    """(doc_id, ids) for each document."""
    return _mapped(texts(docs), source, pattern, lambda c, t: (c.encode(t),), "doc_id long, ids array<int>", "text")


def decode(encoded: DataFrame, source: bytes, pattern: str) -> DataFrame:
    """(doc_id, content) from (doc_id, ids); content is bytes, as ids may end inside a character."""
    return _mapped(
        encoded.select("doc_id", "ids"), source, pattern, lambda c, i: (c.decode(i or []),), "doc_id long, content binary", "ids"
    )


def digests(docs: DataFrame, source: bytes, pattern: str) -> DataFrame:
    """Encode and decode each document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    Ids and decoded bytes are digested where they are made instead of travelling to another worker.
    """

    def row(own: Codec, text: str) -> tuple[int, str, str]:
        ids = own.encode(text)
        decimal = own.decimals(ids).encode()
        return len(ids), hashlib.sha256(decimal).hexdigest(), hashlib.sha256(own.decode(ids)).hexdigest()

    return _mapped(
        texts(docs), source, pattern, row,
        "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "text",
    )
