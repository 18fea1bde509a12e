from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest

from starload.llm.lexical_search import search, terms_of
from tests.llm.conftest import plain_rows

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(lowered)


def expected(docs, queries, k):
    """(query, rank, id, score) by scoring everything."""
    counted = [(i, Counter(terms(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    n_docs, length = len(counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    found = []
    for query, text in queries:
        scored = []
        for i, c in counted:
            m = 100 - 50 + (50 * sum(c.values()) * n_docs) // length
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                * ((1000000000 * c[t]) // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(scored)[:k], 1):
            found.append((query, rank, i, -score))
    return sorted(found, key=repr)


def asked(spark, rows):
    return spark.createDataFrame(rows, "item_id BIGINT, text STRING")


def texts(n, words, seed, longest=40):
    draw = random.Random(seed)
    vocabulary = [f"w{int(draw.paretovariate(0.7))}" for _ in range(words)]
    return [(i, " ".join(draw.choices(vocabulary, k=draw.randint(0, longest)))) for i in range(n)]


@pytest.mark.parametrize("text", ["", None, "A b-C_d", "É naïve 中文 ... 42x", "x" * 3_000_000 + " end", "a " * 1_500_000, "\x00a\x7fb\u0080c d"])
def test_terms(text):
    assert [t.decode() for piece in terms_of(text) for t in piece] == terms(text)


@pytest.mark.parametrize(("k", "rows", "seeds", "focus"), [(5, 16, 8, 2), (50, 2048, 4096, 8), (3, 7, 20, 1), (1, 1, 1, 100)])
def test_equals_scoring_everything(spark, documents, k, rows, seeds, focus):
    docs = texts(700, 300, 5)
    queries = texts(25, 300, 6, 12)
    found = search(
        documents(docs).repartition(6), asked(spark, queries), k,
        bucket_rows=rows, seeds=seeds, focus=focus,
    )
    assert plain_rows(found) == expected(docs, queries, k)


def test_blocks_agree(spark, documents):
    docs, queries = texts(200, 200, 7), texts(40, 200, 8, 10)
    whole = search(documents(docs), asked(spark, queries), 10)
    assert plain_rows(search(documents(docs), asked(spark, queries), 10, block_bytes=9000)) == plain_rows(whole)


def test_ties_go_to_the_smallest_ids_and_null_ids_come_last(spark, documents):
    docs = [(i, "same text here") for i in (9, 3, 7, 5)] + [(None, "same text here"), (1, "other words"), (2, "more of it")]
    docs += [(100 + i, f"filler {i}") for i in range(20)]
    queries = [(1, "same"), (1, "same"), (2, "Text HERE"), (3, None), (4, ""), (5, "unknown"), (None, "other"), (6, "filler")]
    found = search(documents(docs).repartition(3), asked(spark, queries), 5)
    assert plain_rows(found) == expected(docs, queries, 5)
    rows = [r for r in found.collect() if r["item_id"] == 2]
    assert [r["doc_id"] for r in sorted(rows, key=lambda r: r["rank"])] == [3, 5, 7, 9, None]


def test_a_term_of_all_documents_weighs_almost_nothing(spark, documents):
    docs = [(i, "the " * (1 + i % 5)) for i in range(600)]
    assert plain_rows(search(documents(docs), asked(spark, [(1, "the")]), 4)) == expected(docs, [(1, "the")], 4)


def test_copies_of_a_third_of_the_rows(spark, documents):
    docs = texts(200, 100, 9) + [(1000 + i, "hot passage of many documents") for i in range(100)]
    queries = [(1, "hot passage"), (2, "many w1 w2 w3")]
    found = search(documents(docs).repartition(5), asked(spark, queries), 50, bucket_rows=10, seeds=3)
    assert plain_rows(found) == expected(docs, queries, 50)


def test_empty_tables_repeated_rows_long_texts_and_clashes(spark, documents):
    one = asked(spark, [(1, "a b")])
    assert search(documents([]), one).count() == 0
    assert search(documents([(1, "a b c"), (2, None), (3, "")]), asked(spark, [])).count() == 0
    docs = [(1, "a b c"), (1, "a b c"), (2, "z " * 400_000 + "b"), (3, "x y"), (4, "x z")]
    clash = {c: "?" for c in ("key", "id", "query", "terms", "score", "rank", "part", "n", "item_id")}
    found = search(documents(docs, **clash), one)
    assert plain_rows(found) == expected(docs, [(1, "a b")], 50)
