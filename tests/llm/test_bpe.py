import hashlib

import pytest

from entiledger.llm import bpe, queries

tokenizers = pytest.importorskip("tokenizers")
public = pytest.importorskip("public_tokenizers")
PATH = public.path(queries.TOKENIZER)

ODD = ["a<|endoftext|>b", "<|endoftext|><|endoftext|>", "  x   <|endoftext|> y", None, "",
       "aaaaaaa aaaaaaaa aaa", " " * 50, "\n\n\t x", "日本語テスト😀😀 ñandú", "I'm we've 's't",
       "x" * 5000, "<|endoftext", "\x00\x01", "é" * 300, "Ünï 12345 67_8!!??"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.load(PATH)


def encoded(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def test_odd_texts(library, vocabulary):
    for text, ids in zip(ODD, bpe.encode_texts(vocabulary, ODD), strict=True):
        assert ids.tolist() == encoded(library, text)
        assert bpe.decode_ids(vocabulary, ids) == (text or "")


def test_order_and_company_do_not_matter(vocabulary):
    alone = [bpe.encode_texts(vocabulary, [t])[0].tolist() for t in ODD]
    for texts, want in ((ODD[::-1], alone[::-1]), (ODD * 3, alone * 3)):
        got = bpe.encode_texts(vocabulary, texts)
        assert [g.tolist() for g in got] == want


def test_decode_of_cut_characters(library, vocabulary):
    ids = encoded(library, "日本語")
    for cut in ([*ids[:-1]], ids[1:], [ids[0], 50256, ids[-1]]):
        want = library.decode(cut, skip_special_tokens=False)
        assert bpe.decode_ids(vocabulary, cut) == want
    assert bpe.decode_ids(vocabulary, [-1, 10**6]) == ""


def test_query_is_the_library(spark, sf_dir, texts, library):
    got = queries.QUERIES["op4_bpe"](spark, sf_dir).collect()
    assert len(got) == len(texts)
    for r in got:
        ids = encoded(library, texts[r.doc_id])
        back = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()


def test_frames(spark, docs_of, library, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK", 64)
    shared = bpe.share(spark, PATH)
    docs = docs_of(list(enumerate(ODD)) + [(None, "x y"), (1, ODD[1])])
    coded = bpe.encode(docs, shared)
    assert sorted(coded.columns) == sorted(docs.columns)
    rows = coded.collect()
    assert len(rows) == len(ODD) + 2
    assert all(r.ids == encoded(library, r.text) for r in rows)
    back = bpe.decode(coded, shared).collect()
    assert all(r.decoded == (r.text or "") for r in back)
    both = bpe.round_trip(docs, shared).collect()
    assert all(r.decoded == (r.text or "") for r in both)
    assert {(r.doc_id, tuple(r.ids)) for r in both} == {(r.doc_id, tuple(r.ids)) for r in rows}
    assert bpe.round_trip(docs.limit(0), shared).count() == 0
    empty = spark.createDataFrame([(1, None), (2, [])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(empty, shared).collect()] == ["", ""]
