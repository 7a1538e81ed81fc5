"""Row hashes, pair keys, MinHash signatures and hashed shingle sets."""

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .expr import as_col, staged
from .text import normalize, shingles_of, word_tokens

PRIME = (1 << 31) - 1
NUM_PERM = 128


def function_sha(docstring, function) -> Column:
    return F.sha1(F.concat(as_col(docstring), F.lit("\n"), as_col(function)))


def short_sha(sha) -> Column:
    return F.substring(as_col(sha), 1, 32)


def pair_key(docstring, function) -> Column:
    return F.md5(F.concat(normalize(docstring), F.lit("|||"), normalize(function)))


def exact_key(*cols) -> Column:
    """256-bit digest of a column tuple in which null and '' differ.

    Each value is length-prefixed, so no two tuples share an encoding. Shuffling and sorting on
    the digest instead of the texts keeps keys at 64 bytes whatever the texts' size.
    """
    parts = [
        F.concat(
            F.coalesce(F.length(as_col(c)).cast("string"), F.lit("null")),
            F.lit(":"),
            F.coalesce(as_col(c), F.lit("")),
        )
        for c in cols
    ]
    return F.sha2(F.concat(*parts), 256)


def text_hash31(c: Column) -> Column:
    """First 32 bits of md5, reduced modulo 2^31-1."""
    return F.conv(F.substring(F.md5(c), 1, 8), 16, 10).cast("bigint") % F.lit(PRIME)


def shingle_hashes(c, k: int = 3) -> Column:
    return F.transform(shingles_of(word_tokens(c), k), text_hash31)


def permutations(num_perm: int = NUM_PERM) -> tuple[list[int], list[int]]:
    """Multipliers and offsets of the hash family, derived from md5 of their index."""

    def word(tag: str, i: int) -> int:
        return int(hashlib.md5(f"{tag}{i}".encode()).hexdigest()[:8], 16)

    a = [word("a", i) % (PRIME - 1) + 1 for i in range(num_perm)]
    b = [word("b", i) % PRIME for i in range(num_perm)]
    return a, b


# Shingle hashes permuted at once: 128 rows of so many 8-byte numbers stay in a core's cache.
_BLOCK = 1 << 9


def signatures_of(hashes: pd.Series, num_perm: int = NUM_PERM) -> pd.Series:
    """MinHash signatures of arrays of 31-bit hashes; None for empty ones.

    The batch's hashes form one sequence that is permuted block by block whatever the rows; a
    block's minima per row are merged into the rows' signatures.
    """
    a, b = permutations(num_perm)
    mul, add = np.array(a, np.uint64)[:, None], np.array(b, np.uint64)[:, None]
    sizes = np.array([0 if h is None else len(h) for h in hashes], np.int64)
    # One row a text, so that its minima are written side by side.
    low = np.full((len(sizes), num_perm), PRIME, np.uint32)
    filled = np.flatnonzero(sizes)
    if len(filled):
        flat = np.concatenate([np.asarray(hashes.iloc[i], np.int64) for i in filled]).astype(np.uint64)
        owner = np.repeat(filled, sizes[filled])
        wide = np.empty((2, num_perm, _BLOCK), np.uint64)
        narrow = np.empty((2, num_perm, _BLOCK), np.uint32)
        for at in range(0, len(flat), _BLOCK):
            own = owner[at : at + _BLOCK]
            x, high = wide[:, :, : len(own)]
            y, less = narrow[:, :, : len(own)]
            # x mod (2^31-1) by folding: 31-bit factors keep the product below 2^62, so one fold
            # leaves less than twice the modulus, and y - modulus wraps around where y is below it.
            np.multiply(mul, flat[None, at : at + _BLOCK], out=x)
            np.add(x, add, out=x)
            np.right_shift(x, 31, out=high)
            np.bitwise_and(x, PRIME, out=x)
            np.add(x, high, out=y, casting="unsafe")
            np.subtract(y, np.uint32(PRIME), out=less)
            np.minimum(y, less, out=y)
            starts = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
            ends = np.r_[starts[1:], len(own)]
            for row, start, end in zip(own[starts], starts, ends):
                np.minimum(low[row], y[:, start:end].min(axis=1), out=low[row])
    low = low.astype(np.int64)
    return pd.Series([low[i] if n else None for i, n in enumerate(sizes)], index=hashes.index, dtype=object)


def with_minhash(df: DataFrame, hashes: Column, name: str = "signature", num_perm: int = NUM_PERM) -> DataFrame:
    """Add the MinHash signature array<bigint> of an array of shingle hashes; null when it is empty.

    128 multiply-mod-min passes per shingle are numpy's kind of work, done on whole Arrow batches.
    Rows never leave their partition.
    """

    def signatures(batch: pd.Series) -> pd.Series:
        return signatures_of(batch, num_perm)

    # Staged, so that the function's argument is a plain column: the planner does not reliably
    # take a Python function out of a projection when its argument contains lambdas.
    staged_df = staged(df, _hashes=hashes)
    signature = F.pandas_udf(signatures, "array<bigint>")("_hashes")
    return staged_df.withColumn(name, signature).drop("_hashes")


def signature_similarity(a: Column, b: Column, num_perm: int = NUM_PERM) -> Column:
    """Share of equal positions of two signatures."""
    equal = F.zip_with(a, b, lambda x, y: (x == y).cast("int"))
    return F.aggregate(equal, F.lit(0), lambda acc, x: acc + x) / F.lit(float(num_perm))


# Bytes of text that are cut into words at once, and the longest word that is hashed with others.
_TEXT = 1 << 18
_LONG = 256

_WORD = np.zeros(256, np.int8)
_WORD[np.frombuffer(b"abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_", np.uint8)] = 1
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit of ``x`` reaches every bit of the result."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def order_of(values: np.ndarray, *groups: np.ndarray) -> np.ndarray:
    """Order by the last of ``groups`` (numbers from 0), then by the one before, at last by value."""
    order = np.argsort(values)
    for group in groups:
        # Numbers of 16 bits are sorted in steps, without comparing them.
        narrow = group.astype(np.uint16) if len(group) and group.max() < 1 << 16 else group
        order = order[np.argsort(narrow[order], kind="stable")]
    return order


def _word_hashes(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words at ``starts``, eight bytes a step; eight bytes follow the last word."""
    eights = np.lib.stride_tricks.as_strided(data, (len(data) - 7, 8), (1, 1))
    hashes = mixed(lengths.astype(np.uint64) + _STEP)
    for i in np.flatnonzero(lengths > _LONG):
        digest = hashlib.blake2b(data[starts[i] : starts[i] + lengths[i]].tobytes(), digest_size=8).digest()
        hashes[i] ^= np.frombuffer(digest, np.uint64)[0]
    live = np.flatnonzero(lengths <= _LONG)
    at, left = starts[live], lengths[live]
    while len(live):
        part = eights[at].view(np.uint64).ravel() & _LOW_BYTES[np.minimum(left, 8)]
        hashes[live] = mixed(hashes[live] ^ part) + _STEP
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return hashes


def _in_blocks(texts: list[bytes]):
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= _TEXT):
            size += len(texts[end])
            end += 1
        yield texts[at:end]
        at = end


def _cut(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The texts in one run, their words' starts and lengths in it, and each word's text."""
    data = np.frombuffer(b"\n".join([*texts, bytes(8)]), np.uint8)
    edges = np.diff(_WORD[data], prepend=np.int8(0))
    starts = np.flatnonzero(edges == 1)
    ends = np.cumsum([len(t) + 1 for t in texts])
    return data, starts, np.flatnonzero(edges == -1) - starts, np.searchsorted(ends, starts, side="right")


def shingle_sets_of(texts: list[bytes], k: int = 3) -> tuple[np.ndarray, np.ndarray]:
    """Sorted 64-bit hashes of the distinct ``shingles`` of each text one after the other, and the
    place where each text's end. Texts are cut in blocks of bounded size."""
    out, counts = [], []
    for block in _in_blocks(texts):
        data, starts, lengths, owner = _cut(block)
        words = _word_hashes(data, starts, lengths)
        hashes = np.zeros(max(len(words) - k + 1, 0), np.uint64)
        for j in range(k):
            hashes = mixed(hashes + words[j : j + len(hashes)])
        own = owner[: len(hashes)]
        inside = own == owner[k - 1 :]
        hashes, own = hashes[inside], own[inside]
        # Fewer than k words are one shingle, joined without a space.
        few = np.flatnonzero((n := np.bincount(owner, minlength=len(block))) * (n < k))
        if len(few):
            first = np.cumsum(n) - n
            joined = [b"".join(data[s : s + w].tobytes() for s, w in zip(starts[f : f + m], lengths[f : f + m])) for f, m in zip(first[few], n[few])]
            data, starts, lengths, _ = _cut(joined)
            hashes, own = np.r_[hashes, _word_hashes(data, starts, lengths)], np.r_[own, few]
        order = order_of(hashes, own)
        hashes, own = hashes[order], own[order]
        new = np.ones(len(own), bool)
        new[1:] = (hashes[1:] != hashes[:-1]) | (own[1:] != own[:-1])
        out.append(hashes[new])
        counts.append(np.bincount(own[new], minlength=len(block)))
    empty = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    return np.concatenate(out or empty[0]), np.cumsum(np.concatenate(counts or empty[1]))


_MD5_ADDED = np.floor(np.abs(np.sin(np.arange(1, 65))) * 2.0**32).astype(np.uint32)
_MD5_TURNED = [n for turns in ((7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)) for n in turns * 4]
_MD5_WORD = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]

# Messages of one MD5 block are hashed so many at once, which keeps them in a core's cache.
_LANES = 1 << 12


def _md5_heads(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The first 32 bits of the MD5 of each message in ``data``, after which 64 bytes follow."""
    heads = np.empty(len(starts), np.uint32)
    short = lengths < 56
    for i in np.flatnonzero(~short):
        digest = hashlib.md5(data[starts[i] : starts[i] + lengths[i]].tobytes()).digest()
        heads[i] = int.from_bytes(digest[:4], "little")
    windows = np.lib.stride_tricks.as_strided(data, (len(data) - 63, 64), (1, 1))
    places, column = np.flatnonzero(short), np.arange(64)
    for at in range(0, len(places), _LANES):
        own = places[at : at + _LANES]
        n = lengths[own]
        blocks = windows[starts[own]]
        blocks[column >= n[:, None]] = 0
        blocks[np.arange(len(own)), n] = 0x80
        words = np.ascontiguousarray(blocks.view(np.uint32).T)
        words[14] = n * 8
        a, b, c, d = (np.full(len(own), x, np.uint32) for x in (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476))
        f, high = np.empty_like(a), np.empty_like(a)
        for i in range(64):
            if i < 16:
                np.bitwise_xor(c, d, out=f)
                np.bitwise_and(f, b, out=f)
                np.bitwise_xor(f, d, out=f)
            elif i < 32:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_and(f, d, out=f)
                np.bitwise_xor(f, c, out=f)
            elif i < 48:
                np.bitwise_xor(b, c, out=f)
                np.bitwise_xor(f, d, out=f)
            else:
                np.invert(d, out=f)
                np.bitwise_or(f, b, out=f)
                np.bitwise_xor(f, c, out=f)
            np.add(f, a, out=f)
            np.add(f, _MD5_ADDED[i], out=f)
            np.add(f, words[_MD5_WORD[i]], out=f)
            np.right_shift(f, np.uint32(32 - _MD5_TURNED[i]), out=high)
            np.left_shift(f, np.uint32(_MD5_TURNED[i]), out=f)
            np.bitwise_or(f, high, out=f)
            # The column that ``a`` leaves takes the new one.
            np.add(f, b, out=a)
            a, b, c, d = d, a, b, c
        heads[own] = a + np.uint32(0x67452301)
    return heads.byteswap()


def shingle_hashes_of(texts: list[bytes], k: int = 3) -> list[np.ndarray]:
    """``shingle_hashes`` of each text, repeated ones included, made block by block like the sets."""
    out = []
    for block in _in_blocks(texts):
        data, starts, lengths, owner = _cut(block)
        ends = np.cumsum(lengths + 1)
        first = ends - lengths - 1
        spaced = np.zeros((ends[-1] if len(ends) else 0) + 64, np.uint8)
        if len(ends):
            spaced[: ends[-1]] = data[np.repeat(starts - first, lengths + 1) + np.arange(ends[-1])]
            spaced[ends - 1] = ord(" ")
        last = np.arange(k - 1, len(owner))
        last = last[owner[last] == owner[last - k + 1]] if len(last) else last
        begins = first[last - k + 1]
        values = _md5_heads(spaced, begins, ends[last] - 1 - begins).astype(np.int64) % PRIME
        parts = np.split(values, np.searchsorted(owner[last], np.arange(1, len(block))))
        for i in np.flatnonzero((n := np.bincount(owner, minlength=len(block))) * (n < k)):
            words = np.flatnonzero(owner == i)
            joined = b"".join(data[starts[w] : starts[w] + lengths[w]].tobytes() for w in words)
            parts[i] = np.array([int(hashlib.md5(joined).hexdigest()[:8], 16) % PRIME], np.int64)
        out += parts
    return out


def list_array(values: np.ndarray, sizes: np.ndarray) -> pa.ListArray:
    offsets = np.zeros(len(sizes) + 1, np.int32)
    np.cumsum(sizes, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values))


def with_shingle_sets(df: DataFrame, text: str, tokens: bool = True, signed: bool = False) -> DataFrame:
    """Instead of the column ``text``: ``key`` (SHA-256) and ``size`` of its shingle set, on request
    ``tokens``, the sorted hashes of the shingles, and ``signature``, their MinHash signature. Texts
    without words have no row.

    Made in numpy from whole Arrow batches, without a string for each shingle.
    """
    kept = [c for c in df.columns if c != text]
    rows = df.select(*kept, F.col(text).cast("binary").alias(text))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != text]
    more = ["tokens array<bigint>"] * tokens + ["signature array<bigint>"] * signed
    schema = ", ".join([*kinds, "key binary", "size int", *more])

    def cut(batches):
        for batch in batches:
            texts = batch.column(text).to_pylist()
            values, ends = shingle_sets_of(texts)
            sizes = np.diff(ends, prepend=0)
            keys = [hashlib.sha256(values[e - n : e].tobytes()).digest() if n else None for e, n in zip(ends, sizes)]
            columns = [batch.column(c) for c in kept] + [pa.array(keys, pa.binary()), pa.array(sizes.astype(np.int32))]
            names = [*kept, "key", "size"]
            if tokens:
                columns.append(list_array(values.view(np.int64), sizes))
                names.append("tokens")
            if signed:
                columns.append(pa.array(signatures_of(pd.Series(shingle_hashes_of(texts))), pa.list_(pa.int64())))
                names.append("signature")
            yield pa.RecordBatch.from_arrays(columns, names).filter(pa.array(sizes > 0))

    return rows.mapInArrow(cut, schema)
