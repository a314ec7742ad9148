"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabflow.llm import codes, counts, decontaminate, html_text, jaccard, langid, neighbours, pack, pii, records, shallot, toxicity, warc
from tabflow.llm.common import ship, table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
CAPACITY = 2048


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack.pack(spark, table(spark, sf_dir, "documents"), VOCABULARY, CAPACITY, with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.detect(spark, table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = pii.joined(F.col("base"))
    return found.select("doc_id", *[count(k) for k in pii.KINDS], F.sha2(base, 256).alias("base_sha256"), pii.joined(F.concat("base", "terms")).alias("spans"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_documents(spark, table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(spark, table(spark, sf_dir, "documents"))


def op7_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.near_duplicates(spark, table(spark, sf_dir, "embeddings"))


def op8_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(spark, table(spark, sf_dir, "pages"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = warc.deduplicated_archives(spark, table(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.token_records(spark, table(spark, sf_dir, "documents"), VOCABULARY)


def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shallot.centroid_clusters(spark, table(spark, sf_dir, "embeddings"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(spark, table(spark, sf_dir, "embeddings"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counts.token_counts(spark, table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: _shipped(f) for f in (
    op1_best_fit_packing, op2_toxicity, op3_pii, op4_jaccard_join, op5_decontamination, op6_language_id, op7_near_vectors, op8_html, op9_warc, op10_token_records,
    op11_centroid_clusters, op12_vector_codes, op13_token_counts)}


# --- SQL ------------------------------------------------------------------------------------------------------------

_SQUARED = "list_sum(list_transform(list_zip({a}, {b}), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT"
_FLOOR_MEAN = "((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT"
_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _clusters_sql(k: int, rounds: int, size: int, scale: int, salt: str) -> str:
    """Every vector compared with every centroid in each round."""
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings WHERE len(embedding) = {size} AND {_FINITE}),
    c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), v) - 1 AS j, v AS c FROM kept QUALIFY j < {k})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, min({{'d': {_SQUARED.format(a="v", b="c")}, 'j': j}}) AS m FROM kept, c{t} GROUP BY r)""")
        if t < rounds:
            steps.append(f"""c{t + 1} AS MATERIALIZED (SELECT c{t}.j, coalesce(g.c, c{t}.c) AS c FROM c{t} LEFT JOIN
      (SELECT j, list(x ORDER BY i) AS c FROM (SELECT j, i, {_FLOOR_MEAN} AS x FROM
        (SELECT m.j AS j, unnest(v) AS x, unnest(range(1, {size + 1})) AS i FROM kept JOIN a{t} USING (r)) GROUP BY j, i) GROUP BY j) g USING (j))""")
    return "WITH " + ",\n    ".join(steps) + f"""
    SELECT vec_id, m.j::INTEGER AS cluster, m.d AS distance, (sum(m.d) OVER (PARTITION BY m.j))::BIGINT AS cluster_inertia,
      (sum(m.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM kept JOIN a{rounds} USING (r) JOIN c{rounds} ON j = m.j"""


def _codes_sql(parts: int, entries: int, rounds: int, scale: int) -> str:
    """Every part compared with every entry of its codebook in each round."""
    steps = [f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
      FROM embeddings WHERE {_FINITE}),
    cut AS MATERIALIZED (SELECT r, vec_id, p, v[p * len(v) // {parts} + 1 : (p + 1) * len(v) // {parts}] AS v FROM kept, range({parts}) t(p)),
    c0 AS MATERIALIZED (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id, r) - 1 AS j, v AS c FROM cut QUALIFY j < {entries})"""]
    for t in range(rounds + 1):
        steps.append(f"""a{t} AS MATERIALIZED (SELECT r, p, min({{'d': {_SQUARED.format(a="v", b="c")}, 'j': j}}) AS m FROM cut JOIN c{t} USING (p) GROUP BY r, p)""")
        if t < rounds:
            steps.append(f"""c{t + 1} AS MATERIALIZED (SELECT c{t}.p, c{t}.j, coalesce(g.c, c{t}.c) AS c FROM c{t} LEFT JOIN
      (SELECT p, j, list(x ORDER BY i) AS c FROM (SELECT p, j, i, {_FLOOR_MEAN} AS x FROM
        (SELECT p, m.j AS j, unnest(v) AS x, unnest(range(len(v))) AS i FROM cut JOIN a{t} USING (r, p)) GROUP BY p, j, i) GROUP BY p, j) g USING (p, j))""")
    return "WITH " + ",\n    ".join(steps) + f""",
    found AS (SELECT r, string_agg(format('{{:02x}}', m.j), '' ORDER BY p) AS code, sum(m.d)::BIGINT AS error FROM a{rounds} GROUP BY r),
    books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, j)) AS s FROM c{rounds})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, s AS codebooks_sha256 FROM kept JOIN found USING (r), books"""


ORACLE_SQL: dict[str, str] = {
    "op11_centroid_clusters": _clusters_sql(shallot.CENTROIDS, shallot.ROUNDS, shallot.SIZE, shallot.SCALE, shallot.SALT),
    "op12_vector_codes": _codes_sql(codes.PARTS, codes.ENTRIES, codes.ROUNDS, codes.SCALE),
}
