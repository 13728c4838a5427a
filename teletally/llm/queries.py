"""The registered queries of this subpackage: one per operator, over whole tables.

All of them accept what the operators accept: nulls in any column, empty and very long texts, repeated rows and
ids, empty tables (an empty result) and further columns of any name, which are ignored. What differs between
them is in their docstrings.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from teletally.llm import (
    bpe,
    embedding_dedup,
    fingerprints,
    hard_negatives,
    language_model,
    lexical_search,
    mixing,
    order_minhash,
    pii,
    sharding,
    token_counts,
    token_planes,
    toxicity,
)
from teletally.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    """Place of a public tokenizer's file on the driver."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data of every row's text; a null text has none."""
    return pii.digests(table(spark, folder, "documents"))


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Ids of every row's text and what they decode to; a null text has no ids."""
    return bpe.digests(table(spark, folder, "documents"), tokenizer_path())


def op3_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Every row at least once, in mixed order; rows without a source are a source. Equal ids: by bytes."""
    return mixing.mix(table(spark, folder, "documents"))


def op4_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """Every row in one of 24 shards of like bytes; a null text has 8 bytes and the checksum of an empty one."""
    return sharding.shard_documents(table(spark, folder, "documents"))


def op8_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every row; null ids come last, equal ids by descending hash of the text."""
    return fingerprints.fingerprint_report(table(spark, folder, "documents"))


def op9_order_minhash(spark: SparkSession, folder: str) -> DataFrame:
    """One row per document with its class and component; rows without an id are in none and kept."""
    found = order_minhash.near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", "class_id", "component_id", "kept")


def op10_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every row; exactly 0.5 is toxic, a text without evidence, a null one too, 0.25 at most."""
    docs = table(spark, folder, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, folder, "labels")))


def op5_embedding_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """One row per vector; those without a label or with no proper components link with nothing."""
    return embedding_dedup.near_vectors(table(spark, folder, "embeddings"))


def op7_language_model(spark: SparkSession, folder: str) -> DataFrame:
    """Score of every row; a null text is an end alone, a null id is hashed as empty text."""
    return language_model.score_documents(table(spark, folder, "documents"))


def op6_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Tokens of every row, counted in files; a null text has none, a null id stays null."""
    return token_counts.document_token_counts(table(spark, folder, "documents"), tokenizer_path())


def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    """50 best documents of every item; equal scores by ascending id, rows without an id behind."""
    index = lexical_search.build_index(table(spark, folder, "documents"))
    return lexical_search.search(index, table(spark, folder, "benchmark"))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every anchor; rows with a null id, label or component take no part."""
    found = table(spark, folder, "embeddings")
    return hard_negatives.mine(found, label=hard_negatives.seventh_relabelled())


def op13_token_planes(spark: SparkSession, folder: str) -> DataFrame:
    """Place and checksum of every row's ids in files; a null text has the end-of-document id alone."""
    return token_planes.document_checksums(table(spark, folder, "documents"), tokenizer_path("word_bpe_49k.json"))


QUERIES: dict[str, Query] = {
    "op1_pii": op1_pii,
    "op2_bpe": op2_bpe,
    "op3_mixing": op3_mixing,
    "op4_sharding": op4_sharding,
    "op5_embedding_dedup": op5_embedding_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_language_model": op7_language_model,
    "op8_fingerprints": op8_fingerprints,
    "op9_order_minhash": op9_order_minhash,
    "op10_toxicity": op10_toxicity,
    "op11_lexical_search": op11_lexical_search,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_token_planes": op13_token_planes,
}

# The schedule of one period, turn by turn: counts of turns so far per source, and the source that takes
# the turn, among released blocks the one due first.
MIXING_SQL = """
WITH RECURSIVE docs AS (
    SELECT doc_id, source, strlen(coalesce(text, '')) AS bytes,
        CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS key,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 3) AS INTEGER) AS bucket
    FROM documents),
sources AS (SELECT key, CAST(sum(bytes) AS BIGINT) AS total FROM docs GROUP BY key),
shares AS (
    SELECT key, greatest(1, (total + 16383) // 16384) AS blocks, greatest(1000, 16 * count(*) OVER ()) AS period,
        (greatest(1000, 16 * count(*) OVER ()) - count(*) OVER ()) * power(greatest(total, 1), 0.9)
            / sum(power(greatest(total, 1), 0.9)) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
            AS exact
    FROM sources),
weights AS (
    SELECT key, blocks, period, 1 + CAST(floor(exact) AS BIGINT)
        + CASE WHEN row_number() OVER (ORDER BY floor(exact) - exact, key)
            <= period - sum(1 + CAST(floor(exact) AS BIGINT)) OVER () THEN 1 ELSE 0 END AS w
    FROM shares),
lists AS (SELECT list(w ORDER BY key) AS w, list(key ORDER BY key) AS keys, any_value(period) AS period FROM weights),
schedule AS (
    SELECT CAST(-1 AS BIGINT) AS turn, [CAST(0 AS BIGINT) FOR x IN w] AS used, CAST(0 AS BIGINT) AS pick FROM lists
    UNION ALL
    SELECT turn + 1, list_transform(used, lambda x, i: x + CASE WHEN i = next THEN 1 ELSE 0 END), next
    FROM (
        SELECT turn, used, list_min(list_transform(range(1, len(w) + 1), lambda i: CASE
            WHEN used[i] < w[i] AND used[i] * period // w[i] <= turn + 1
            THEN ((used[i] + 1) * period + w[i] - 1) // w[i] * 1000000 + i END)) % 1000000 AS next
        FROM schedule, lists WHERE turn + 1 < period)),
turns AS (SELECT keys[pick] AS key, used[pick] - 1 AS index, turn FROM schedule, lists WHERE pick > 0),
run AS (
    SELECT max(period * ((blocks - 1) // w) + turn + 1) AS turns
    FROM weights JOIN turns ON turns.key = weights.key AND turns.index = (blocks - 1) % w),
starts AS (
    SELECT *, CAST(sum(bytes) OVER (PARTITION BY key ORDER BY bucket, doc_id, bytes
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - bytes AS start FROM docs),
placed AS (
    SELECT doc_id, source, bytes, starts.key, start, least(start // 16384, blocks - 1) AS block, blocks, w, period, run.turns AS run
    FROM starts JOIN weights ON weights.key = starts.key, run),
repeated AS (
    SELECT *, unnest(range(0, (run // period + 1) * w // blocks + 1)) AS epoch FROM placed)
SELECT doc_id, source, bytes, CAST(block AS BIGINT) AS block, CAST(epoch AS BIGINT) AS epoch,
    CAST((epoch * blocks + block) // w * period + turns.turn AS BIGINT) AS turn,
    CAST(start - block * 16384 AS BIGINT) AS place
FROM repeated JOIN turns ON turns.key = repeated.key AND turns.index = (epoch * blocks + block) % w
WHERE (epoch * blocks + block) // w * period + turns.turn < run
"""

EMBEDDING_SQL = """
WITH RECURSIVE usable AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reached AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reached.vec_id, links.b FROM reached JOIN links ON reached.other = links.a),
components AS (SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(DISTINCT b) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(d.n, 0) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN components c ON c.vec_id = e.vec_id LEFT JOIN degrees d ON d.vec_id = e.vec_id
"""

SEARCH_SQL = r"""
WITH docs AS (
    SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents),
items AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark),
postings AS (SELECT row, any_value(doc_id) AS doc_id, term, count(*) AS tf FROM docs GROUP BY row, term),
sizes AS (SELECT row, CAST(sum(tf) AS BIGINT) AS n FROM postings GROUP BY row),
totals AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM sizes),
weights AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(docs) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
    FROM postings, totals GROUP BY term),
scores AS (
    SELECT i.item_id, p.row, p.doc_id, CAST(sum(
        w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + (50 * n * docs) // terms)))) AS BIGINT) AS score
    FROM items i JOIN postings p ON p.term = i.term JOIN weights ON weights.term = p.term JOIN sizes ON sizes.row = p.row, totals
    GROUP BY i.item_id, p.row, p.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0
QUALIFY rank <= 50
"""

NEGATIVES_SQL = """
WITH usable AS (
    SELECT row_number() OVER () AS number, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.number AS anchor, a.vec_id AS anchor_id, b.number AS other, b.vec_id AS other_id, a.label = b.label AS same,
        CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.number <> b.number AND len(a.v) = len(b.v)),
positives AS (
    SELECT anchor, anchor_id, other, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id, other) <= 5),
found AS (
    SELECT p.anchor_id, p.positive_id, s.other_id AS negative_id, p.positive_score, s.score AS negative_score,
        row_number() OVER (PARTITION BY p.anchor, p.other ORDER BY s.score DESC, s.other_id, s.other) AS place
    FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
        AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(place AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM found WHERE place <= 3
"""

# The others rest on hashes, checksums, merges or models that SQL does not have; tests hold them against
# brute force.
SQL: dict[str, str] = {
    "op3_mixing": MIXING_SQL,
    "op5_embedding_dedup": EMBEDDING_SQL,
    "op11_lexical_search": SEARCH_SQL,
    "op12_hard_negatives": NEGATIVES_SQL,
}
