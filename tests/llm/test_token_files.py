from __future__ import annotations

import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from starload.llm.token_files import (
    Encoder,
    arrow_uri,
    open_part,
    plain,
    read_checksums,
    read_documents,
    read_parts,
    write_token_files,
)
from tests.conftest import SF_DIR

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")
FAST = {"words_apart": True, "plain_words": True}


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def encoder():
    return Encoder(WORDS, 1, **FAST)


def ids_of(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 1]


ODD = [
    "", " ", "don't. Don'T, I'm? 'S. ''s. 5, 5.5 a.b. ...", "İstanbul. ıI ŉ. Ǆ ǅ.", "ΣΑΣ. ΣΑΣ", "x́. a̸. ≠. é.",
    "<|endoftext|>. <|ENDOFTEXT|>, a<|startoftext|>b", "\x1c. a\x1cb \xa0  x \x85", "漢字。かな. 한국어, 하나", "½, ². ª º",
    "क़. ", "word\nword\r\nword\tWORD", "̀ ̀. a ́b", "a" * 3000, "!?!? a! a!? a?!", "é́. É,",
]


def test_odd_texts_are_encoded_as_the_library_does(tokenizer, encoder):
    for text in ODD:
        assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == ids_of(tokenizer, text), text


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("aBzé\xf7É.,!'<|5 \n\t\xa0ßσ", max_size=25), min_size=1, max_size=6))
def test_texts_together_are_encoded_as_one_by_one(tokenizer, encoder, texts):
    tokens, counts = encoder.encode_array(pa.array(["x", *texts]).slice(1))
    wanted = [ids_of(tokenizer, text) for text in texts]
    assert counts.tolist() == list(map(len, wanted))
    assert tokens.tolist() == [i for ids in wanted for i in ids]


@settings(max_examples=300, deadline=None)
@given(st.text("abIİéÉσΣ'.,!?<|>sS1 \ń̸½", max_size=40))
def test_any_text_is_encoded_as_the_library_does(tokenizer, encoder, text):
    assert np.frombuffer(encoder.encode([text])[0], "<u2").tolist() == ids_of(tokenizer, text)


def test_forgetting_words_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr("starload.llm.token_files._HELD_WORDS", 3)
    coder = Encoder(WORDS, 1, **FAST)
    for _ in range(3):
        for text in ("one two, three", "four. Five two", "one " + "x" * 100):
            assert np.frombuffer(coder.encode([text])[0], "<u2").tolist() == ids_of(tokenizer, text)
    assert not any(len(w) > 64 for w in coder.known)


def test_claims_that_do_not_hold_are_refused():
    with pytest.raises(ValueError):
        Encoder(BYTES, 1, words_apart=True)
    with pytest.raises(ValueError):
        Encoder(BYTES, 1, words_apart=False, plain_words=True)


def test_only_safe_words_are_taken_apart():
    assert plain("Word,") == ("word", ",")
    assert plain("É.") == ("é", ".")
    for word in ("Σ.", "İ.", "x́.", "<|X|>."):
        assert plain(word) == (word, "")
    assert plain(".") == (".", "")
    assert plain("'.") == ("'.", "")


@pytest.mark.parametrize(("file", "how", "width"), [(WORDS, FAST, 2), (BYTES, {}, 2)])
def test_round_trip(spark, documents, tmp_path, file, how, width):
    texts = [*ODD, None, "x " * 50_000, "same", "same"]
    rows = [(7 * i % 31 - 5, text) for i, text in enumerate(texts)]
    path = str(tmp_path / "tokens")
    write_token_files(documents(rows, id="?", tokens="?"), path, file, parts=4, **how)
    library = Tokenizer.from_file(file)
    start, wanted = 0, []
    for name, text in sorted(rows):
        ids = ids_of(library, text)
        wanted.append((name, start, len(ids), ids))
        start += len(ids)
    assert sorted(tuple(r) for r in read_documents(spark, path).collect()) == wanted
    sums = [(n, s, k, zlib.crc32(np.array(ids, "<u4").tobytes())) for n, s, k, ids in wanted]
    assert sorted(tuple(r) for r in read_checksums(spark, path).collect()) == sums
    parts = [r.asDict() for r in read_parts(spark, path).orderBy("part").collect()]
    assert {p["width"] for p in parts} == {width}
    opened = [open_part(path, p) for p in parts]
    whole = np.concatenate([p.tokens for p in opened])
    assert whole.tolist() == [x for *_, ids in wanted for x in ids]
    assert [int(p.base) for p in opened] == np.cumsum([0, *[len(p.tokens) for p in opened]])[:-1].tolist()
    assert np.concatenate([p.ids for p in opened]).tolist() == [w[0] for w in wanted]


def test_null_and_repeated_ids(spark, documents, tmp_path):
    rows = [(None, "b"), (None, None), (2, "c"), (2, "a"), (0, "x y")]
    path = str(tmp_path / "tokens")
    write_token_files(documents(rows), path, WORDS, parts=3, **FAST)
    found = sorted(((r["start"], r["doc_id"], r["n_tokens"]) for r in read_documents(spark, path).collect()))
    assert found == [(0, None, 1), (1, None, 2), (3, 0, 3), (6, 2, 2), (8, 2, 2)]


def test_empty_table(spark, documents, tmp_path):
    path = str(tmp_path / "tokens")
    write_token_files(documents([]), path, WORDS, **FAST)
    assert read_checksums(spark, path).count() == 0


def test_documents_equal_the_library(spark, tokenizer, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    path = f"file://{tmp_path}/tokens"
    write_token_files(docs, path, WORDS, **FAST)
    start = 0
    found = {r["doc_id"]: r for r in read_checksums(spark, path).collect()}
    for row in sorted(docs.collect(), key=lambda r: r["doc_id"]):
        ids = ids_of(tokenizer, row["text"])
        got = found[row["doc_id"]]
        assert (got["start"], got["n_tokens"]) == (start, len(ids))
        assert got["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_a_path_without_a_scheme_is_on_the_default_file_system(spark, documents, tmp_path):
    """The default is a view with a folder mounted: all files land in it, and none where the plain
    path would be on this machine."""
    rows = [(i, f"some words {i}") for i in range(30)]
    docs = documents(rows).cache()
    docs.count()
    (tmp_path / "real").mkdir()
    settings = spark._jsc.hadoopConfiguration()
    before = settings.get("fs.defaultFS")
    settings.set("fs.viewfs.mounttable.tokens.link./mounted", f"file://{tmp_path}/real")
    settings.set("fs.defaultFS", "viewfs://tokens/")
    try:
        write_token_files(docs, "/mounted/set", WORDS, parts=3, **FAST)
        found = {r["doc_id"]: r["n_tokens"] for r in read_documents(spark, "/mounted/set").collect()}
    finally:
        settings.set("fs.defaultFS", before)
    assert sorted(found) == list(range(30))
    kinds = sorted({p.suffix for p in (tmp_path / "real/set/files").iterdir()})
    assert kinds == [".bin", ".ids", ".idx"]
    assert not Path("/mounted").exists()
    docs.unpersist()


def test_all_files_lie_in_the_path(spark, documents, tmp_path):
    for path in (f"file://{tmp_path}/a", f"file:{tmp_path}/b", f"{tmp_path}/c"):
        write_token_files(documents([(1, "one"), (2, "two")]), path, WORDS, parts=2, **FAST)
        assert read_checksums(spark, path).count() == 2
    assert {p.name for p in tmp_path.iterdir()} == {"a", "b", "c"}
    assert all({p.name for p in d.iterdir()} == {"files", "parts", "written"} for d in tmp_path.iterdir())


def test_uris_that_arrow_opens():
    assert arrow_uri("s3a://bucket/x") == "s3://bucket/x"
    assert arrow_uri("file:/tmp/x") == "file:///tmp/x"
    assert arrow_uri("hdfs://name:8020/x") == "hdfs://name:8020/x"
    with pytest.raises(ValueError, match="wasbs"):
        arrow_uri("wasbs://c@account/x")
