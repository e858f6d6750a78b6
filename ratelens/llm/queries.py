"""The operators as queries over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ratelens.llm import (
    centroids,
    fingerprints,
    lm,
    mixing,
    packing,
    pii,
    quality,
    repeats,
    resampling,
    simhash,
    tokens,
    urls,
    warc,
)
from ratelens.llm.common import table
from ratelens.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]


def op1_fingerprint_edits(spark: SparkSession, directory: str) -> DataFrame:
    return fingerprints.fingerprint_edits(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


def op2_arc_to_warc(spark: SparkSession, directory: str) -> DataFrame:
    read = warc.archive(table(spark, directory, "pages"), scratch_path(spark, "archives"))
    return read.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_line_quality(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    chain = quality.fit_lines(documents, table(spark, directory, "labels"))
    return quality.quality(documents, chain).withColumnRenamed("id", "doc_id")


def op4_maxent_scores(spark: SparkSession, directory: str) -> DataFrame:
    return lm.scores(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


def op5_simhash_groups(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, directory, "documents"))
    printed = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select(F.col("id").alias("doc_id"), printed.alias("fingerprint"), "component_id")


def op6_url_verdicts(spark: SparkSession, directory: str) -> DataFrame:
    return urls.judge_urls(table(spark, directory, "pages")).withColumnRenamed("id", "page_id")


def op7_conflict_packing(spark: SparkSession, directory: str) -> DataFrame:
    return packing.pack(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


def op8_source_mix(spark: SparkSession, directory: str) -> DataFrame:
    mixed = mixing.mix(table(spark, directory, "documents"))
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op9_token_counts(spark: SparkSession, directory: str) -> DataFrame:
    return tokens.token_counts(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")


def op10_personal_data(spark: SparkSession, directory: str) -> DataFrame:
    return pii.personal_data(table(spark, directory, "documents"), pii.fit_tagger()).withColumnRenamed("id", "doc_id")


def op11_bisector_clusters(spark: SparkSession, directory: str) -> DataFrame:
    return centroids.cluster(table(spark, directory, "embeddings")).withColumnRenamed("id", "vec_id")


def op12_repeated_bytes(spark: SparkSession, directory: str) -> DataFrame:
    found = repeats.remove_repeats(table(spark, directory, "documents")).withColumnRenamed("id", "doc_id")
    return found.drop("kept")


def op13_target_resample(spark: SparkSession, directory: str) -> DataFrame:
    documents, benchmark = (table(spark, directory, name) for name in ("documents", "benchmark"))
    return resampling.resample(documents, benchmark).withColumnRenamed("id", "doc_id")


def pipeline(spark: SparkSession, directory: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, directory)


def queries() -> dict[str, Query]:
    return {
        "op1_fingerprint_edits": op1_fingerprint_edits,
        "op2_arc_to_warc": op2_arc_to_warc,
        "op3_line_quality": op3_line_quality,
        "op4_maxent_scores": op4_maxent_scores,
        "op5_simhash_groups": op5_simhash_groups,
        "op6_url_verdicts": op6_url_verdicts,
        "op7_conflict_packing": op7_conflict_packing,
        "op8_source_mix": op8_source_mix,
        "op9_token_counts": op9_token_counts,
        "op10_personal_data": op10_personal_data,
        "op11_bisector_clusters": op11_bisector_clusters,
        "op12_repeated_bytes": op12_repeated_bytes,
        "op13_target_resample": op13_target_resample,
        "pipeline": pipeline,
    }


#: RFC 4648 base32 of a SHA-1 in hex: four digits for each five of the forty.
_OP2 = """
WITH paid AS (
    SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
    SELECT page_id, octet_length(encode(payload)) AS payload_bytes,
        array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
            1 + ((('0x' || substr(hex, 1 + 5 * (i // 4)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31), 1)), '') AS payload_digest,
        max(page_id) OVER (PARTITION BY payload) AS largest
    FROM paid
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id < largest THEN largest END AS refers_to
FROM named
"""


def _op11_sql() -> str:
    """The first centroids, and ten times an assignment and the centroids after it."""
    away = "list_sum(list_transform(list_zip(k.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    parts = [
        """kept AS MATERIALIZED (
        SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v
        FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64)""",
        """c0 AS MATERIALIZED (SELECT c, v FROM (SELECT v, row_number() OVER (
        ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS c FROM kept) WHERE c < 8)""",
    ]
    for n in range(11):
        parts.append(
            f"""a{n} AS MATERIALIZED (SELECT row, any_value(vec_id) AS vec_id, any_value(v) AS v,
        arg_min(c, 8 * away + c) AS cluster, min(away) AS distance
        FROM (SELECT k.row, k.vec_id, k.v, c.c, {away} AS away FROM kept k, c{n} c) GROUP BY row)"""
        )
        if n < 10:
            parts.append(
                f"""c{n + 1} AS MATERIALIZED (SELECT c, coalesce(moved, v) AS v FROM c{n} LEFT JOIN (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS moved FROM (
            SELECT cluster, i, sum(x)::BIGINT AS total, count(*) AS n FROM (
                SELECT cluster, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{n}) GROUP BY cluster, i)
        GROUP BY cluster) ON c = cluster)"""
            )
    return "WITH " + ",\n".join(parts) + """
SELECT vec_id, cluster::INT AS cluster, distance, sum(distance) OVER (PARTITION BY cluster)::BIGINT AS cluster_inertia,
    sum(distance) OVER ()::BIGINT AS inertia, sha256(array_to_string(c10.v, ',')) AS centroid_sha256
FROM a10 JOIN c10 ON c = cluster
"""


#: CRC-32 of each distinct word, byte by byte, with the table that its fixed polynomial gives.
_OP13 = r"""
WITH crc AS MATERIALIZED (
    SELECT list_transform(range(256), lambda b: list_reduce(range(8), lambda x, k:
        CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, b)) AS step
), source AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents
), target AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark
), counted AS (
    SELECT word, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM (
        SELECT unnest(words) AS word, 1 AS s, 0 AS t FROM source UNION ALL SELECT word, 0, 1 FROM target) GROUP BY word
), hashed AS (
    SELECT word, s, t, xor(list_reduce(list_transform(range(length(hex(encode(word))) // 2),
        lambda k: ('0x' || substr(hex(encode(word)), 1 + 2 * k::INT, 2))::BIGINT),
        lambda x, b: xor(x >> 8, step[1 + (xor(x, b) & 255)]), 4294967295), 4294967295) % 10000 AS bucket
    FROM counted, crc
), buckets AS (
    SELECT bucket, sum(s) AS s, sum(t) AS t FROM hashed GROUP BY bucket
), totals AS (
    SELECT sum(s)::DOUBLE + 10000 AS every, sum(t)::DOUBLE + 10000 AS wanted FROM buckets
), gained AS (
    SELECT word, floor(1000 * ln((b.t::DOUBLE + 1) * every / ((b.s::DOUBLE + 1) * wanted)))::BIGINT AS gain
    FROM hashed JOIN buckets b USING (bucket), totals
), rows AS (
    SELECT row_number() OVER () AS row, doc_id, words FROM source
), weighed AS (
    SELECT row, sum(gain)::BIGINT AS weight FROM (SELECT row, unnest(words) AS word FROM rows) JOIN gained USING (word) GROUP BY row
), scored AS (
    SELECT doc_id, len(words)::BIGINT AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
        (('0x' || substr(sha256('2024:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5) / 4294967296.0)))::BIGINT AS score
    FROM rows LEFT JOIN weighed USING (row)
), ranked AS (
    SELECT *, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * n // 100 THEN rank END AS rank FROM ranked
UNION ALL SELECT doc_id, n_features, weight, score, NULL FROM scored WHERE n_features < 20
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_arc_to_warc": _OP2, "op11_bisector_clusters": _op11_sql(), "op13_target_resample": _OP13}
