"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

from collections import Counter, defaultdict

import pytest

import __spark_entry__ as driver
import corpus_pipeline
from starload.llm.quality_domains import TARGETS, domains
from starload.llm.simhash_dedup import fingerprint
from starload.llm.soft_mixing import mix
from starload.session import stored
from tests.conftest import SF_DIR
from tests.llm.test_line_dedup import expected as lines_expected
from tests.llm.test_packing import check
from tests.oracle import differences, oracle_connection

CLASH = {
    c: "?"
    for c in (
        "lang_pred", "score", "n_lines", "n_dropped", "fingerprint", "place", "_id", "n_tokens", "rate", "copies",
        "p_good", "piece", "bucket", "id",
    )
}


def test_every_operator_is_registered():
    names = [n for n in driver.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in driver.queries()


@pytest.mark.parametrize("name", ["op9_exact_dedup", "op10_line_dedup", "op11_merkle", "op12_lexical_search"])
def test_equals_sql(spark, name):
    result = driver.queries()[name](spark, SF_DIR)
    assert differences(result, driver.oracle_sql()[name], oracle_connection(SF_DIR)) is None


@pytest.mark.parametrize("table", ["documents", "embeddings", "pages"])
def test_queries_return_every_row(spark, table):
    """The queries of a table, all of whose rows must come back."""
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet").count()
    own = {
        "documents": ["op3_token_files", "op5_language", "op6_soft_mixing", "op7_pii", "op8_simhash", "op13_shards"],
        "embeddings": ["op4_near_vectors"],
        "pages": ["op2_main_text"],
    }[table]
    for name in own:
        assert driver.queries()[name](spark, SF_DIR).count() == rows, name


@pytest.fixture(scope="module")
def stages(spark):
    """The documents that go into each stage, and what comes out of the last."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    tables = [docs]
    for name, stage in corpus_pipeline.STAGES:
        tables.append(stored(stage(spark, tables[-1], SF_DIR), name))
    return tables


def test_all_but_the_last_return_documents(stages):
    for table in stages[:-1]:
        assert table.columns == stages[0].columns


def test_language_rejects_only_texts_without_letters(stages):
    before, after = stages[0].collect(), stages[1].collect()
    letters = [r for r in before if any(c.isalpha() for c in r["text"] or "")]
    assert sorted(map(tuple, after)) == sorted(map(tuple, letters))


def test_lines_go_that_many_share(stages):
    rows = [(r["doc_id"], r["text"]) for r in stages[1].collect()]
    wanted = lines_expected(rows, 10)
    assert {r["doc_id"]: r["text"] for r in stages[2].collect()} == {i: w[0] for i, w in wanted.items()}


def test_one_document_of_each_group_stays(stages):
    rows = sorted((r["doc_id"], fingerprint(r["text"])) for r in stages[2].collect())
    label = {i: i for i, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, f in rows:
            least = min(label[j] for j, g in rows if (f ^ g).bit_count() <= 3)
            if least < label[i]:
                label[i], changed = least, True
    assert sorted(r["doc_id"] for r in stages[3].collect()) == sorted(set(label.values()))


def test_documents_come_as_often_as_the_mixture_says(spark, stages):
    labels = domains(spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    mixed = mix(stages[3], labels, TARGETS, corpus_pipeline.BUDGET_RATIO).collect()
    assert Counter(r["doc_id"] for r in stages[4].collect()) == Counter(
        {r["doc_id"]: r["copies"] for r in mixed if r["copies"]}
    )
    kept = {r["doc_id"] for r in stages[4].collect()}
    truth = defaultdict(list)
    for r in labels.collect():
        truth[r["domain"]].append(r["doc_id"])
    before = {r["doc_id"] for r in stages[3].collect()}
    good = before.intersection(truth["good"])
    assert len(good & kept) / len(good) > 0.97


def test_packing_covers_the_mixture(stages):
    rows = Counter((r["doc_id"], r["text"]) for r in stages[4].collect())
    once = [row for row, n in rows.items() if n == 1]
    names = {i for i, _ in once}
    packed = stages[5].collect()
    assert sum(r["n_tokens"] for r in packed) == sum(n * len((t or "").split()) for (_, t), n in rows.items())
    pieces = defaultdict(list)
    for r in packed:
        if r["doc_id"] in names:
            pieces[r["doc_id"]].append(r["n_tokens"])
    assert {i: sum(p) for i, p in pieces.items()} == {i: len((t or "").split()) for i, t in once}
    assert check  # the batches themselves are tested with packing


def test_tables_of_every_kind(spark, documents):
    text = "some words of a text that says a thing"
    rows = [(1, text, "en"), (1, text, "en"), (None, text, None), (2, None, "en"), (3, "", None), (4, "123", "en")]
    rows += [(10 + i, f"own text {i} with other words in it {i * i}\nshared", "en") for i in range(12)]
    rows.append((99, "very long " * 30_000, "en"))
    docs = documents(rows, **CLASH)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SF_DIR), name)
        assert docs.columns == documents([], **CLASH).columns
        assert {r["score"] for r in docs.collect()} == {"?"}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR).count() > 0
    empty = documents([])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF_DIR).count() == 0
