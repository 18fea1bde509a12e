from __future__ import annotations

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from starload.llm.merkle_manifest import fold, leaf_digest, merkle_manifest, siblings
from tests.llm.conftest import plain_rows


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    texts = [None if v is None else str(v) for v in (row[0], row[3], row[2], row[4], row[1])]
    return sha("".join("-" if t is None else f"{len(t.encode())}:{t}" for t in texts))


def expected(rows, fanout=8):
    """(id, leaf, subroot, root, siblings) of (id, text, lang, source, n_chars) rows."""
    proofs = [""] * len(rows)

    def apex(nodes):
        while len(nodes) > 1:
            above = []
            for first in range(0, len(nodes), fanout):
                run = nodes[first : first + fanout]
                for own, (_, members) in enumerate(run):
                    for member in members:
                        proofs[member] += "".join(d for i, (d, _) in enumerate(run) if i != own)
                above.append((sha("".join(d for d, _ in run)), [m for _, ms in run for m in ms]))
            nodes = above
        return nodes[0]

    groups = defaultdict(list)
    for place, row in enumerate(rows):
        groups[row[2]].append(place)
    tops, subroots = [], {}
    for lang in sorted(groups, key=lambda x: (x is not None, (x or "").encode())):
        order = sorted(
            groups[lang], key=lambda i: (rows[i][0] is not None, rows[i][0] or 0, leaf(rows[i]))
        )
        tops.append(apex([(leaf(rows[i]), [i]) for i in order]))
        subroots |= {i: tops[-1][0] for i in order}
    if not rows:
        return []
    root = apex(tops)[0]
    found = [(r[0], leaf(r), subroots[i], root, proofs[i]) for i, r in enumerate(rows)]
    return sorted(found, key=repr)


def made(spark, rows):
    schema = "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT"
    return spark.createDataFrame(rows, schema)


def of(manifest):
    return plain_rows(
        manifest.select("doc_id", "leaf", "subroot", "root", siblings(F.col("proof")).alias("s"))
    )


def some_rows(n, langs, seed=1):
    draw = random.Random(seed)
    return [
        (i, draw.choice([None, "", f"text é {i}\n", "x" * i]), draw.choice(langs),
         draw.choice([None, "web"]), draw.choice([None, i, -1]))
        for i in draw.sample(range(10 * n + 1), n)
    ]


@pytest.mark.parametrize("size", [1, 2, 8, 9, 64, 65, 520])
def test_one_group_of_every_shape(spark, size):
    rows = some_rows(size, ["en"], size)
    found = merkle_manifest(made(spark, rows).repartition(5))
    assert of(found) == expected(rows)
    assert found.filter("subroot != root").count() == 0


def test_groups_are_ordered_by_bytes_with_null_first(spark):
    langs = [None, "", "en", "EN", "é", "z", "\U0001f600", "￮", "-", "=", "de"]
    rows = some_rows(300, langs) + [(9999, "alone", "only", None, 5)]
    found = merkle_manifest(made(spark, rows).repartition(7))
    assert of(found) == expected(rows)
    alone = found.filter("doc_id = 9999").first()
    assert alone["leaf"] == alone["subroot"]


def test_a_group_with_most_rows(spark):
    """Ranges cut a group, and rows of one id, into several; the places go on over all of them."""
    rows = some_rows(900, ["en"], 3) + some_rows(30, ["de", "fr"], 4)
    docs = made(spark, rows)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert of(merkle_manifest(docs)) == expected(rows)
        # The same row many times: places, and so proofs, of their own.
        copies = [(7, "same", "en", "web", 4)] * 200
        found = merkle_manifest(made(spark, copies + rows[:20]))
        assert of(found) == expected(copies + rows[:20])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_null_ids_come_first(spark):
    rows = [(3, "c", "en", None, 1), (None, "a", "en", None, 1), (None, None, "en", None, None), (1, "b", None, None, 1)]
    assert of(merkle_manifest(made(spark, rows))) == expected(rows)


@pytest.mark.parametrize("fanout", [2, 3])
def test_other_fanouts(spark, fanout):
    rows = some_rows(50, ["en", "de", "fr"])
    assert of(merkle_manifest(made(spark, rows), fanout=fanout)) == expected(rows, fanout)


def test_every_proof_leads_to_the_root_and_no_other_leaf_does(spark):
    docs = made(spark, some_rows(150, [None, "en", "de"]))
    other = leaf_digest(*map(F.col, ("doc_id", "source", "lang", "n_chars")), F.lit("forged"))
    found = merkle_manifest(docs, carry={"forged": other})
    folded = found.select(
        "root", fold(F.col("leaf"), F.col("proof")).alias("kept"),
        fold(F.col("forged"), F.col("proof")).alias("other"),
    )
    assert folded.filter("kept = root and other != root").count() == 150


def test_any_change_changes_the_root(spark):
    rows = some_rows(70, ["en", "de"])
    root = merkle_manifest(made(spark, rows)).first()["root"]
    changed = [*rows[1:], (*rows[0][:4], -5)]
    assert merkle_manifest(made(spark, changed)).first()["root"] != root
    assert merkle_manifest(made(spark, rows[1:])).first()["root"] != root
    assert merkle_manifest(made(spark, rows[::-1])).first()["root"] == root


def test_empty_table_long_text_and_clashing_columns(spark, documents):
    assert merkle_manifest(documents([])).count() == 0
    rows = [(1, "x" * 3_000_000), (2, None), (3, "")]
    clash = {c: "?" for c in ("key", "at", "n", "id", "digest", "row", "part", "place", "c0", "proof", "root", "own", "leaf")}
    assert of(merkle_manifest(documents(rows, **clash))) == of(merkle_manifest(documents(rows)))
    assert of(merkle_manifest(documents(rows))) == expected([(*r, "en", None, None) for r in rows])


def test_wrong_fanout(documents):
    with pytest.raises(ValueError):
        merkle_manifest(documents([]), fanout=1)
