"""Token alignment against a brute-force version over the libraries themselves."""

import hashlib
from collections import Counter, defaultdict

import public_tokenizers
import pyarrow as pa
import pytest
from cases import awkward, documents, empty
from codequarry.llm import alignment, encoders
from codequarry.llm.queries import tokenizer_file
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

A, B = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
SP = SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
JSON = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
JSON.encode_special_tokens = True
UNICODE = {c: b for c, b in encoders._byte_of_char().items()}


def tokens(text):
    """[(id, start, end)] of both sides, or none."""
    if not text:
        return [], []
    a = [(i, bytes(UNICODE[c] for c in JSON.id_to_token(i))) for i in JSON.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in SP.encode(text):
        piece = SP.id_to_piece(i)
        b.append((i, bytes([int(piece[3:-1], 16)]) if SP.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return [], []

    def placed(toks):
        out, at = [], 0
        for i, x in toks:
            out.append((i, at, at + len(x)))
            at += len(x)
        return out

    return placed(a), placed(b)


def brute(docs):
    per_doc, holders = [], Counter()
    for doc_id, text in docs:
        a, b = tokens(text)
        links = [(i, j) for i, s, e in a for j, s2, e2 in b if s < e2 and s2 < e]
        holders.update(set(links))
        per_doc.append((doc_id, a, b, links))
    top = defaultdict(int)
    for (i, _), n in holders.items():
        top[i] = max(top[i], n)
    rows = []
    for doc_id, a, b, links in per_doc:
        cuts = sorted({e for *_, e in a} & {e for *_, e in b})
        groups = []
        for lo, hi in zip([0, *cuts], cuts):
            groups.append("|".join(",".join(str(i) for i, s, e in side if lo <= s and e <= hi) for side in (a, b)))
        digest = hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""
        best = sum(holders[x] == top[x[0]] for x in links)
        rows.append((doc_id, len(a), len(b), len(cuts), len(links), best, sum(holders[x] for x in links), digest))
    return sorted(map(repr, rows))


def rows(df):
    return sorted(repr(tuple(r)) for r in df.collect())


def short(docs, most=3000):
    return [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if len(r["text"] or "") <= most]


@pytest.mark.parametrize("block", [1, 5000, alignment.BLOCK_BYTES])
def test_alignment(spark, block):
    docs = documents(spark).where("length(text) <= 3000 OR text IS NULL")
    odd = awkward(spark).where("length(text) <= 3000 OR text IS NULL")
    more = [(50, "a▁b"), (51, "<|endoftext|><s> </s><0x41> \n\n  x "), (52, " "), (53, "  lead"), (54, " 　\u0000é́")]
    docs = docs.select("doc_id", "text").union(odd.select("doc_id", "text")).union(spark.createDataFrame(more, "doc_id long, text string"))
    result = alignment.alignment(docs.repartition(3), A, B, block)
    assert rows(result) == brute(short(docs))
    assert result.where("doc_id = 51 AND n_links > 0").count() == 1


def test_long_texts_and_other_columns(spark):
    result = {r["doc_id"]: r for r in alignment.alignment(awkward(spark), A, B).collect() if r["doc_id"] in (7, 8, 9)}
    assert result[7]["groups_sha256"] == result[8]["groups_sha256"] != ""
    assert result[7]["n_a"] == len(JSON.encode(" " + awkward(spark).where("doc_id = 7").first()["text"]).ids)
    assert all(r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"] for r in result.values())


def test_empty(spark):
    assert alignment.alignment(empty(spark), A, B).collect() == []


def test_ties_are_all_best(spark):
    docs = spark.createDataFrame([(1, "abcdefgh"), (2, "abcdefgx")], "doc_id long, text string")
    assert rows(alignment.alignment(docs, A, B)) == brute(short(docs))


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab e\n\t 1é日😀▁<>'_-　"), max_size=60))
def test_segments_are_what_the_library_gives(text):
    segments = encoders.SegmentEncoder(B)
    got = pa.array(memoryview(segments.ids(text)).cast("i").tolist() if text else [], pa.int32()).to_pylist()
    assert got == SP.encode(text)
