"""Token ids of texts as the ``tokenizers`` library gives them, with a bounded memory of pieces."""

import json
import re
from itertools import chain

import tiktoken
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from .pretokens import PATTERN, split

# Pieces remembered by a worker (about 200 bytes each); when full, it starts afresh.
PIECES = 400_000
# Longer pieces are not remembered.
PIECE_CHARS = 64
# Token ids are kept as little-endian 32-bit integers.
WIDTH = 4


def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for 256 and up."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in printable}
    rest = [b for b in range(256) if chr(b) not in table]
    return table | {chr(256 + i): b for i, b in enumerate(rest)}


class PieceEncoder(dict):
    """Text to ids for a byte-level BPE whose ids are in merge order.

    Text is split into pieces; a piece's ids are looked up, or made by byte-pair merging and
    remembered. As a dict it maps a piece to its ids' bytes.
    """

    def __init__(self, ranks: dict[bytes, int], special: dict[str, int]):
        super().__init__()
        self._core = tiktoken.Encoding(
            "pieces", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}
        )._core_bpe
        self._special = special

    def __missing__(self, piece: str) -> bytes:
        ids = self._core.encode_single_piece(piece.encode())
        packed = b"".join([i.to_bytes(WIDTH, "little") for i in ids])
        if len(piece) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[piece] = packed
        return packed

    def ids(self, text: str) -> bytes:
        """Ids as consecutive 32-bit integers; special tokens in the text get their own ids."""
        parts = [text]
        for token, number in self._special.items():
            own = number.to_bytes(WIDTH, "little")
            parts = chain.from_iterable(_between(p, token, own) for p in parts)
        return b"".join(p if isinstance(p, bytes) else b"".join(map(self.__getitem__, split(p))) for p in parts)


def _between(part: str | bytes, token: str, own: bytes) -> list[str | bytes]:
    if isinstance(part, bytes) or token not in part:
        return [part]
    found = part.split(token)
    return [x for p in found for x in (p, own)][:-1]


class LibraryEncoder:
    """Any tokenizer file, whole texts through the library."""

    def __init__(self, tokenizer: Tokenizer):
        self._tokenizer = tokenizer

    def ids(self, text: str) -> bytes:
        ids = self._tokenizer.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(WIDTH, "little") for i in ids])


def from_json(source: bytes, plain_special: bool = False) -> PieceEncoder | LibraryEncoder:
    """An encoder for a tokenizers file: piece by piece where that provably gives the same ids.

    With ``plain_special`` the strings of special tokens are ordinary text.
    """
    spec = json.loads(source)
    model, alphabet = spec["model"], _byte_of_char()
    added = spec.get("added_tokens") or []
    plain = (
        spec.get("normalizer") is None
        and (spec.get("pre_tokenizer") or {}).get("type") == "ByteLevel"
        and not spec["pre_tokenizer"].get("add_prefix_space")
        and spec["pre_tokenizer"].get("use_regex", True)
        and model.get("type") == "BPE"
        and not any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback"))
        and not any(model.get(k) for k in ("continuing_subword_prefix", "end_of_word_suffix"))
        and not any(t[k] for t in added for k in ("single_word", "lstrip", "rstrip", "normalized"))
        and len(added) <= 1
    )
    if plain:
        special = {t["content"]: t["id"] for t in added}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        merged = [model["vocab"][a + b] for a, b in pairs]
        known = {k: v for k, v in model["vocab"].items() if k not in special}
        in_order = merged == sorted(set(merged)) and len(known) == len(merged) + 256
        single = [v for k, v in known.items() if len(k) == 1]
        if in_order and len(single) == 256 and max(single) < min(merged, default=256):
            ranks = {bytes(alphabet[c] for c in k): v for k, v in known.items()}
            return PieceEncoder(ranks, {} if plain_special else special)
    tokenizer = Tokenizer.from_str(source.decode())
    tokenizer.encode_special_tokens = plain_special
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return LibraryEncoder(tokenizer)


# A run of spaces with what follows up to the next one.
_SEGMENT = re.compile(" +[^ ]*")
_META = "\u2581"


class SegmentEncoder(dict):
    """Text to ids for a sentencepiece model that puts a space in front of each text.

    Where no piece has a space behind another character, nothing merges across the start of a run
    of spaces: text is cut there, and a segment's ids are looked up or made by the library and
    remembered. Any other model encodes whole texts. As a dict it maps a segment to its ids' bytes.
    """

    def __init__(self, model: bytes):
        super().__init__()
        self._sp = SentencePieceProcessor(model_proto=model)
        pieces = [self._sp.id_to_piece(i) for i in range(self._sp.get_piece_size())]
        self._whole = any(re.search(f"[^{_META}]{_META}", p) for p in pieces)

    def _encode(self, text: str) -> bytes:
        return b"".join([i.to_bytes(WIDTH, "little") for i in self._sp.encode(text)])

    def __missing__(self, segment: str) -> bytes:
        # The library puts the first space there itself, but in front of nothing.
        packed = self._encode(segment[1:]) if len(segment) > 1 else self._sp.piece_to_id(_META).to_bytes(WIDTH, "little")
        if len(segment) <= PIECE_CHARS:
            if len(self) >= PIECES:
                self.clear()
            self[segment] = packed
        return packed

    def ids(self, text: str) -> bytes:
        if self._whole or not text or _META in text:
            return self._encode(text)
        return b"".join(map(self.__getitem__, _SEGMENT.findall(" " + text)))

    def spelled(self) -> list[bytes]:
        """The bytes of each id: meta spaces as spaces, byte pieces as their byte."""
        sp = self._sp
        names = [sp.id_to_piece(i) for i in range(sp.get_piece_size())]
        return [
            bytes([int(n[3:5], 16)]) if sp.is_byte(i) else n.replace(_META, " ").encode() for i, n in enumerate(names)
        ]


def spelled_by_json(source: bytes) -> list[bytes]:
    """The bytes of each id of a byte-level tokenizers file; a special token's are its name's."""
    spec, alphabet = json.loads(source), _byte_of_char()
    special = {t["id"]: t["content"] for t in spec.get("added_tokens") or []}
    vocab = {i: k for k, i in spec["model"]["vocab"].items()} | special
    return [
        vocab.get(i, "").encode() if i in special or i not in vocab else bytes(alphabet[c] for c in vocab[i])
        for i in range(max(vocab, default=-1) + 1)
    ]


_LOADED: dict[str, PieceEncoder | LibraryEncoder] = {}


def loaded(version: str, source: bytes) -> PieceEncoder | LibraryEncoder:
    """The worker's one encoder of this version."""
    if version not in _LOADED:
        _LOADED.clear()
        _LOADED[version] = from_json(source)
    return _LOADED[version]
