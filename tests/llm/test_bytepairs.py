"""Byte-level BPE by prefixes against the public library, and appends and edits against encoding anew."""

from __future__ import annotations

import base64
import hashlib
import random
from array import array

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from caseloom.llm.bytepairs import Prefixes, TextEncoder, decode_ids, encode_texts, merge_bytes, read_ranks
from caseloom.llm.queries import op11_byte_bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
KNOWN = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
OWN = TextEncoder(RANKS, PATTERN)


def ids(text):
    return list(array("I", OWN.encode(text)))


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(exclude_categories=["Cs"])) | st.text("aab '\n\ts1éñ字<|endoftext|>"))
def test_texts_encode_as_the_library_does(text):
    assert ids(text) == KNOWN.encode_ordinary(text)
    assert OWN.decode(OWN.encode(text)) == text.encode()


@settings(max_examples=300, deadline=None)
@given(st.binary(max_size=40) | st.lists(st.sampled_from([b"a", b"in", b"ing", b" the", b"==", b"\xc3"]), max_size=20).map(b"".join))
def test_prefixes_equal_plain_merging(data):
    prefixes = Prefixes(OWN.pieces, data)
    assert [OWN.pieces.token_bytes[t] for t in prefixes.tokens()] == merge_bytes(RANKS, data)[0]
    for end in range(1, len(data) + 1):
        assert OWN.pieces.token_bytes[prefixes.last[end]] == merge_bytes(RANKS, data[:end])[0][-1]


def test_appends_and_edits_equal_encoding_anew():
    rng = random.Random(5)
    data = "".join(rng.choice("etaoin shrdlu") for _ in range(3000)).encode()
    prefixes = Prefixes(OWN.pieces)
    for start in range(0, len(data), 700):
        prefixes.append(data[start : start + 700])
    assert prefixes.tokens() == Prefixes(OWN.pieces, data).tokens()
    for _ in range(40):
        start = rng.randrange(len(prefixes.data))
        stop = min(len(prefixes.data), start + rng.randrange(6))
        new = "".join(rng.choice("etaoin ") for _ in range(rng.randrange(6))).encode()
        computed = prefixes.replace(start, stop, new)
        assert prefixes.tokens() == Prefixes(OWN.pieces, prefixes.data).tokens()
        assert len(prefixes.last) == len(prefixes.data) + 1
        assert computed <= len(new) + 2 * OWN.pieces.longest
    prefixes.replace(0, len(prefixes.data), b"")
    assert prefixes.tokens() == []


def test_a_vocabulary_without_single_bytes_is_an_error():
    with pytest.raises(ValueError):
        TextEncoder({b"a": 0}, PATTERN)


def test_rows_keep_their_shape(spark):
    """Null and empty texts, null and repeated keys, clashing names, a very long text, an empty table."""
    long = "Wörter " * 60_000 + "x" * 300_000
    rows = [(1, None, 1, "c"), (2, "", 2, "c"), (3, "a b", 3, "c"), (3, "a b", 3, "c"), (None, " é", 4, "c"), (5, long, 5, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, k long, ids string")
    encoded = encode_texts(docs, RANKS, PATTERN)
    got = decode_ids(encoded, RANKS).collect()
    assert sorted((r.doc_id or -1, r.n_tokens) for r in got) == sorted(
        (k or -1, len(KNOWN.encode_ordinary(t or ""))) for k, t, *_ in rows
    )
    for r in got:
        text = next(t or "" for k, t, *_ in rows if k == r.doc_id)
        assert bytes(r.decoded) == text.encode() and bytes(r.ids) == array("I", KNOWN.encode_ordinary(text)).tobytes()
    assert decode_ids(encode_texts(docs.limit(0), RANKS, PATTERN), RANKS).collect() == []
    assert encode_texts(docs.selectExpr("k AS name", "text"), RANKS, PATTERN, key="name").columns == ["name", "n_tokens", "ids"]


def test_query_equals_the_library_on_whole_texts(spark, folder):
    assert read_ranks(spark, PATH) == RANKS
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op11_byte_bpe(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        expected = array("I", KNOWN.encode_ordinary(texts[r.doc_id])).tobytes()
        assert r.n_tokens == len(expected) // 4
        assert r.ids_sha256 == hashlib.sha256(expected).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
