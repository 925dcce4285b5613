"""SQL of the clustering query: its rounds written out one after another."""

from __future__ import annotations

from loomstar.llm.centroids import CLUSTERS, DIMENSIONS, LIMIT, ROUNDS, SCALE, SEED


def _nearest(vectors: str, centroids: str) -> str:
    apart = "list_sum(list_transform(list_zip(v.v, c.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT"
    return f"""
        SELECT row, vec_id, v, arg_min(number, (distance, number)) AS cluster, min(distance) AS distance
        FROM (SELECT v.row, v.vec_id, v.v, c.number, {apart} AS distance FROM {vectors} v CROSS JOIN {centroids} c)
        GROUP BY row, vec_id, v"""


def clustering_sql() -> str:
    whole = f"len(embedding) = {DIMENSIONS} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x)"
    parts = [f"""
        kept AS (
            SELECT row_number() OVER () AS row, vec_id,
                   list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
            FROM embeddings WHERE {whole} AND abs({SCALE} * x::DOUBLE) < {LIMIT})) = {DIMENSIONS}
        ), c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || coalesce(vec_id::VARCHAR, '')), v) - 1 AS number, v FROM kept
            QUALIFY number < {CLUSTERS}
        )"""]
    for k in range(ROUNDS):
        parts.append(f"""a{k} AS ({_nearest("kept", f"c{k}")}
        ), s{k} AS (
            SELECT cluster, list(x ORDER BY i) AS v FROM (
                SELECT cluster, i, floor_div AS x FROM (
                    SELECT cluster, i, (sum(v[i]) - ((sum(v[i]) % count(*)) + count(*)) % count(*)) // count(*) AS floor_div
                    FROM a{k}, range(1, {DIMENSIONS + 1}) r(i) GROUP BY cluster, i))
            GROUP BY cluster
        ), c{k + 1} AS (
            SELECT number, coalesce(s{k}.v, c{k}.v)::BIGINT[] AS v FROM c{k} LEFT JOIN s{k} ON cluster = number
        )""")
    parts.append(f"""final AS ({_nearest("kept", f"c{ROUNDS}")})""")
    return f"""WITH {", ".join(parts)}
        SELECT vec_id, final.cluster::INTEGER AS cluster, distance,
               sum(distance) OVER (PARTITION BY final.cluster)::BIGINT AS cluster_inertia,
               sum(distance) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(c.v, ',')) AS centroid_sha256
        FROM final JOIN c{ROUNDS} c ON c.number = final.cluster"""
