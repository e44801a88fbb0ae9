import hashlib

import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from guildbook.llm import op8_bpe as op

PATH = P.path("byte_bpe_50k.json")
TEXTS = [
    None, "", " ", "<|endoftext|>a <|endoftext|>", "  two  spaces\n\n x \n y\t z ", "a" * 20000, "it's we'll I'D 12345 ６７ ² é́ 😀😀", " lead", "don't\r\nstop   ",
    "\x1c a\x1cb \x85c  d", "the the the" * 500, "ªº µ×÷ ǅ", "x\u0000y",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def want(tokenizer, text):
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), digest(",".join(map(str, ids))), digest(tokenizer.decode(ids, skip_special_tokens=False))


def test_query_on_whole_documents(spark, tokenizer):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = {r["doc_id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in op.op8_bpe(spark, sf).collect()}
    assert got == {d["doc_id"]: want(tokenizer, d["text"]) for d in docs}


def test_defined_cases(spark, tokenizer):
    df = spark.createDataFrame([(i // 2, t, 0) for i, t in enumerate(TEXTS)] + [(0, None, 0)], "doc_id long, text string, n_tokens int")
    got = op.encode_documents(df, PATH).collect()
    assert sorted(tuple(r) for r in got) == sorted([(i // 2, *want(tokenizer, t)) for i, t in enumerate(TEXTS)] + [(0, *want(tokenizer, None))])
    assert op.encode_documents(spark.createDataFrame([], "doc_id long, text string"), PATH).count() == 0


codec = op.Codec(PATH)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aeinrst ABC'\n\t.,!0129éß"), st.characters(blacklist_categories=("Cs",))), max_size=60))
def test_any_text(text):
    tokenizer = Tokenizer.from_file(PATH) if not hasattr(test_any_text, "t") else test_any_text.t
    test_any_text.t = tokenizer
    n, ids, decoded = codec.encode_batch([text])[0]
    assert ids == ",".join(map(str, tokenizer.encode(text, add_special_tokens=False).ids)) and decoded.decode() == text


def test_all_pairs_of_ascii():
    """Every pair of ASCII characters, between letters and after a quote."""
    tokenizer = Tokenizer.from_file(PATH)
    texts = [f"a{chr(a)}{chr(b)}'s 1{chr(b)}{chr(a)} b" for a in range(128) for b in range(128)] + ["don't\x1c's"]
    want = [",".join(map(str, e.ids)) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert [ids for _, ids, _ in codec.encode_batch(texts)] == want


def test_shared_prefixes_are_walked_once(monkeypatch):
    v = op.Vocabulary(PATH)
    words = sorted(f"prefixprefix{x}".encode() for x in ("", "a", "ab", "abc", "b"))
    seen = []
    held = dict(v.id_of)

    class Spy(dict):
        def get(self, key, default=None):
            seen.append(key)
            return held.get(key, default)

    v.id_of = Spy(held)
    assert [b"".join(v.bytes_of[i] for i in ids) for ids in v.encode_sorted(words)] == words
    assert seen.count(b"prefixprefix") <= 1
