"""name -> (spark, sf_dir) -> DataFrame, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starload.llm.common import table
from starload.llm.exact_dedup import exact_dedup
from starload.llm.html_wrappers import extract_main_text
from starload.llm.label_shards import shard_documents
from starload.llm.language_id import held_out, learn, predict
from starload.llm.lexical_search import search
from starload.llm.line_dedup import drop_frequent_lines
from starload.llm.merkle_manifest import COLUMNS, fold, leaf_digest, merkle_manifest, siblings
from starload.llm.merkle_sql import merkle_sql
from starload.llm.packing import pack
from starload.llm.pivot_index import near_vectors
from starload.llm.pii import BASE, KINDS, find_pii
from starload.llm.simhash_dedup import simhash_groups
from starload.llm.quality_domains import BUDGET_RATIO, TARGETS, domains
from starload.llm.soft_mixing import mix
from starload.llm.token_files import read_checksums, write_token_files
from starload.session import scratch_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def op2_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(table(spark, sf_dir, "pages"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = scratch_dir(spark, "tokens")
    write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path("word_bpe_49k.json"),
        end_token=1, words_apart=True, plain_words=True,
    )
    return read_checksums(spark, path)


def op4_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    samples = learn(docs.filter(~held_out()))
    found = predict(docs.select("doc_id", "text"), samples)
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


def op6_soft_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(
        table(spark, sf_dir, "documents"), domains(table(spark, sf_dir, "labels")), TARGETS,
        BUDGET_RATIO,
    )
    return mixed.select("doc_id", "n_tokens", *[f"p_{d}" for d in TARGETS], "rate", "copies")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select(
        "doc_id",
        *[number(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_groups(table(spark, sf_dir, "documents"), shingle=3, radius=3)
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return groups.select("doc_id", digits.alias("fingerprint"), "component_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_frequent_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest, and whether rows prove to be in it after the texts of a third of them were
    lower-cased."""
    picked = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    lowered = F.translate("text", ascii_uppercase, ascii_lowercase)
    told = [lowered if c == "text" else F.col(c) for c in COLUMNS]
    manifest = merkle_manifest(
        table(spark, sf_dir, "documents"), carry={"tampered": F.when(picked, leaf_digest(*told))}
    )
    folded = fold(F.coalesce("tampered", "leaf"), F.col("proof"))
    return manifest.select(
        "doc_id", "leaf", "subroot", "root",
        F.sha2(siblings(F.col("proof")), 256).alias("proof_sha256"), folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard_documents(table(spark, sf_dir, "documents"), shards=16)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "linked",
    )


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_main_text": op2_main_text,
    "op3_token_files": op3_token_files,
    "op4_near_vectors": op4_near_vectors,
    "op5_language": op5_language,
    "op6_soft_mixing": op6_soft_mixing,
    "op7_pii": op7_pii,
    "op8_simhash": op8_simhash,
    "op9_exact_dedup": op9_exact_dedup,
    "op10_line_dedup": op10_line_dedup,
    "op11_merkle": op11_merkle,
    "op12_lexical_search": op12_lexical_search,
    "op13_shards": op13_shards,
}

ORACLE: dict[str, str] = {
    "op9_exact_dedup": """
        WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
        g AS (SELECT h, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY h)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, d.h AS text_sha256
        FROM d JOIN g USING (h)
    """,
    "op10_line_dedup": r"""
        WITH lines AS (
            SELECT doc_id, own, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                   generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
            FROM (SELECT *, row_number() OVER () AS own FROM documents) AS d
        ),
        keyed AS (
            SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
            FROM lines
        ),
        frequent AS (
            SELECT key FROM keyed WHERE length(key) >= 1
            GROUP BY key HAVING count(DISTINCT own) >= 10
        )
        SELECT doc_id, count(*) AS n_lines, count(f.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (f.key IS NULL), ''))
                   AS kept_sha256
        FROM keyed k LEFT JOIN frequent f USING (key) GROUP BY own, doc_id
    """,
    "op11_merkle": merkle_sql(),
    "op12_lexical_search": r"""
        WITH words AS (
            SELECT doc_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM documents
        ),
        tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY doc_id, term),
        sizes AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
        whole AS (SELECT count(*) AS docs, sum(n)::BIGINT AS length FROM sizes),
        weights AS (
            SELECT term, CAST(floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w
            FROM tf, whole GROUP BY term, docs
        ),
        asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
            FROM benchmark
        ),
        scored AS (
            SELECT item_id, doc_id,
                   sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // length))))::BIGINT AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN sizes USING (doc_id), whole
            GROUP BY item_id, doc_id
        ),
        ranked AS (
            SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place
            FROM scored WHERE score > 0
        )
        SELECT item_id, CAST(place AS INTEGER) AS rank, doc_id, score FROM ranked WHERE place <= 50
    """,
}
