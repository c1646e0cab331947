"""The registered queries of this subpackage: one per operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marlstone.llm import (
    automaton_dedup,
    centroids,
    conversations,
    decontaminate,
    language,
    mixing,
    near_dedup,
    packing,
    private_data,
    quality,
    search,
    suffix_dedup,
    warc,
)
from marlstone.llm.ship import ship

Query = Callable[[SparkSession, str], DataFrame]


def _shipped(run: Query) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return run(spark, sf_dir)

    return query


QUERIES: dict[str, Query] = {
    name: _shipped(run)
    for name, run in {
        "op1_near_dedup": near_dedup.op1,
        "op2_private_data": private_data.op2,
        "op3_quality": quality.op3,
        "op4_language": language.op4,
        "op5_search": search.op5,
        "op6_automaton_dedup": automaton_dedup.op6,
        "op7_packing": packing.op7,
        "op8_decontaminate": decontaminate.op8,
        "op9_mixing": mixing.op9,
        "op10_suffix_dedup": suffix_dedup.op10,
        "op11_conversations": conversations.op11,
        "op12_warc": warc.op12,
        "op13_centroids": centroids.op13,
    }.items()
}

def _k_means_sql(k: int, rounds: int) -> str:
    """The rounds written out, each from the centroids of the one before."""
    nearest = """
        SELECT v.n, v.vec_id, v.w, c.cluster, c.c, CAST(list_sum([(p[1] - p[2]) ** 2 FOR p IN list_zip(v.w, c.c)]) AS BIGINT) AS distance
        FROM v CROSS JOIN c{round} c
        QUALIFY row_number() OVER (PARTITION BY v.n ORDER BY distance, c.cluster) = 1
    """
    steps = []
    for i in range(rounds + 1):
        steps.append(f"a{i} AS MATERIALIZED ({nearest.format(round=i)})")
        steps.append(f"""m{i} AS (
            SELECT cluster, list(mean ORDER BY place) AS c FROM (
                SELECT cluster, place, CAST(floor(sum(x) / count(*)) AS BIGINT) AS mean
                FROM (SELECT cluster, unnest(w) AS x, unnest(range(len(w))) AS place FROM a{i}) GROUP BY cluster, place
            ) GROUP BY cluster)""")
        steps.append(f"c{i + 1} AS MATERIALIZED (SELECT c.cluster, coalesce(m.c, c.c) AS c FROM c{i} c LEFT JOIN m{i} m USING (cluster))")
    return f"""
        WITH kept AS (
            SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
            WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, w FROM kept),
        c0 AS (
            SELECT CAST(row_number() OVER (ORDER BY sha256('3:' || vec_id), w) - 1 AS INTEGER) AS cluster, w AS c
            FROM v QUALIFY cluster < {k}
        ),
        {", ".join(steps)}
        SELECT vec_id, cluster, distance, CAST(sum(distance) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_inertia,
               CAST(sum(distance) OVER () AS BIGINT) AS inertia,
               sha256(array_to_string(c, ',')) AS centroid_sha256
        FROM a{rounds}
    """


SQL: dict[str, str] = {
    "op5_search": """
        WITH v AS (
            SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS w FROM embeddings
            WHERE embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ),
        scored AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
                   CAST(list_sum([p[1] * p[2] FOR p IN list_zip(q.w, c.w)]) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        ),
        ranked AS (
            SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
                   vec_id, score
            FROM scored
        )
        SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
    """,
    "op12_warc": """
        WITH paid AS (
            SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages
        ),
        latest AS (SELECT digest, max(page_id) AS page_id FROM paid GROUP BY digest)
        SELECT p.page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
               array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
                   (CAST('0x' || substr(digest, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31 AS INTEGER), 1)
                   FOR i IN range(32)], '') AS payload_digest,
               CASE WHEN p.page_id IS NOT DISTINCT FROM l.page_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN p.page_id IS DISTINCT FROM l.page_id THEN l.page_id END AS refers_to
        FROM paid p JOIN latest l USING (digest)
    """,
    "op13_centroids": _k_means_sql(k=8, rounds=10),
}
