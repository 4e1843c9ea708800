import hashlib
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from roadsift.llm import bpe_automaton, packing, registry, token_counts
from roadsift.llm.registry import BYTE_BPE, WORD_BPE

WORD, BYTE = Tokenizer.from_file(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
with open(WORD_BPE, encoding="utf-8") as f:
    AUTOMATON, MERGES = (bpe_automaton.Encoder(f_text, m) for f_text in [f.read()] for m in ("automaton", "merges"))
with open(BYTE_BPE, encoding="utf-8") as f:
    COUNTER = token_counts.MergeCounter(f.read())


def ids(encoder, text):
    return np.frombuffer(next(encoder.encode([text])), "<u4").tolist()


@settings(max_examples=300, deadline=None)
@given(st.text() | st.text("aAbt ' .\n\t<|>endoftx", max_size=60) | st.sampled_from(["the", "a" * 900, "aaab" * 40, " \n  x "]))
def test_ids_and_counts_equal_the_library(text):
    text = text.encode("utf-8", "ignore").decode()
    expected = WORD.encode(text, add_special_tokens=False).ids
    assert ids(AUTOMATON, text) == expected
    assert ids(MERGES, text) == expected
    assert AUTOMATON.decode(next(AUTOMATON.encode([text]))) == WORD.decode(expected, skip_special_tokens=False)
    assert COUNTER.count([text]) == [len(BYTE.encode(text, add_special_tokens=False).ids)]


def test_every_code_point_as_the_library():
    """Letters, digits, white space and lower case of the library's Unicode version, which is older than Python's."""
    texts = [f"a{c} 1{c}{c}'s é{c}." for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000 and (ord(c) < 0x3100 or 0xA000 <= ord(c) < 0xAC10 or 0x10000 <= ord(c) < 0x20000 or ord(c) % 61 == 0)]
    expected = [np.array(e.ids, "<u4").tobytes() for e in WORD.encode_batch_fast(texts, add_special_tokens=False)]
    assert MERGES.encode_array(pa.array(texts)) == expected
    assert AUTOMATON.encode_array(pa.array(texts)) == expected
    assert COUNTER.count(texts) == [len(e.ids) for e in BYTE.encode_batch_fast(texts, add_special_tokens=False)]


def test_arrays_of_all_kinds_at_once():
    texts = ["don't. stop", None, "Ab, c", " ", "", "λόγος 12", "<|endoftext|>x", "plain 42 words!!", "it's 'quoted'\n"] * 3
    for encoder in (AUTOMATON, MERGES):
        assert encoder.encode_array(pa.array(texts)) == [np.array(WORD.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]


def test_very_long_word_is_not_quadratic():
    word = "abracadabra" * 20_000
    assert ids(MERGES, word) == WORD.encode(word, add_special_tokens=False).ids


def test_digests_of_whole_queries(spark):
    sf = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    own = {k: WORD.encode(t, add_special_tokens=False).ids for k, t in rows.items()}
    hexed = lambda s: hashlib.sha256(s.encode()).hexdigest()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in registry.op4_bpe(spark, sf).collect()}
    assert got == {k: (len(i), hexed(" ".join(map(str, i))), hexed(WORD.decode(i, skip_special_tokens=False))) for k, i in own.items()}
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in registry.op7_token_counts(spark, sf).collect()}
    assert got == {k: (len(t.encode()), n := len(BYTE.encode(t, add_special_tokens=False).ids), n > 1024) for k, t in rows.items()}
    pieces = registry.op6_packing(spark, sf).collect()
    assert len({(r["sequence_id"], r["offset"]) for r in pieces}) == len(pieces)
    covered = defaultdict(int)
    for r in sorted(pieces, key=lambda r: r["start"]):
        all_ids = np.array([*own[r["doc_id"]], 1], "<u4")
        assert r["start"] == covered[r["doc_id"]] and r["doc_tokens"] == len(all_ids)
        assert r["ids_crc32"] == zlib.crc32(all_ids[r["start"] : r["start"] + r["length"]].tobytes())
        assert r["length"] <= 2048 and r["length"] & (r["length"] - 1) == 0
        covered[r["doc_id"]] += r["length"]
    assert covered == {k: len(i) + 1 for k, i in own.items()}


def test_long_word_equals_stepped_words():
    for word in ("internationalization", "zzzzzzzzzz", "éclair"):
        assert np.frombuffer(AUTOMATON.automaton.encode_words([word])[0], "<u4").tolist() == AUTOMATON.automaton.encode_word(word)


def test_encode_operator_on_odd_rows(odd):
    for r in bpe_automaton.encode_texts(odd, WORD_BPE).collect():
        assert isinstance(r["ids"], list)
    got = sorted((r["doc_id"] or 0, len(r["ids"])) for r in bpe_automaton.encode_texts(odd, WORD_BPE).collect())
    expected = sorted((r["doc_id"] or 0, len(WORD.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert got == expected


def test_counts_operator_on_odd_rows(odd):
    got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(odd, BYTE_BPE).collect())
    assert got == sorted((r["doc_id"] or 0, len((r["text"] or "").encode()), len(BYTE.encode(r["text"] or "", add_special_tokens=False).ids)) for r in odd.collect())


@pytest.mark.parametrize("n", [1, 2, 2047, 2048, 2049, 5000])
def test_binary_lengths(n):
    out = packing.binary_lengths(n, 2048)
    assert sum(out) == n and all(x & (x - 1) == 0 for x in out) and out == sorted(out, reverse=True)


def test_packing_keeps_every_id_once(odd):
    pieces = packing.pack_documents(odd, WORD_BPE, longest=64).collect()
    assert len({r["sequence_id"] for r in pieces}) == len(pieces)
    whole = defaultdict(list)
    for r in sorted(pieces, key=lambda r: r["start"]):
        assert (r["offset"], 1 << r["bucket"], len(r["ids"])) == (0, r["length"], 4 * r["length"])
        whole[r["doc_id"]].append(bytes(r["ids"]))
    one = b"".join(whole[4])
    text = next(r["text"] for r in odd.collect() if r["doc_id"] == 4)
    assert np.frombuffer(one, "<u4").tolist() == [*WORD.encode(text, add_special_tokens=False).ids, 1]
    assert zlib.crc32(b"".join(whole[1])) == zlib.crc32(np.array([1], "<u4").tobytes())


def test_empty_tables(docs):
    none = docs([])
    assert bpe_automaton.encode_texts(none, WORD_BPE).count() == token_counts.count_tokens(none, BYTE_BPE).count() == packing.pack_documents(none, WORD_BPE).count() == 0
