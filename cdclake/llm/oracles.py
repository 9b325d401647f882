"""DuckDB SQL with the results of the operators that SQL can express."""

from __future__ import annotations

from cdclake.llm import centroids, mixing

ORACLES: dict[str, str] = {
    "op2_exact_dedup": r"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents)
        SELECT doc_id,
               first(doc_id) OVER best AS keep_id,
               count(*) OVER (PARTITION BY content) AS group_size,
               doc_id = first(doc_id) OVER best AS kept,
               sha256(content) AS text_sha256
        FROM docs
        WINDOW best AS (PARTITION BY content ORDER BY length(t) DESC, doc_id
                        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)""",
}


def _sweep_sql(name: str, free: str, weight: str) -> str:
    """Raking as a recursion over sweeps: each dimension scales ``free`` until ``weight`` has its goals.

    As there, every few sweeps the marginals are looked at: it ends when they are near, or no nearer than before.
    """
    goals = ", ".join(f"g_{d}" for d in mixing.DIMENSIONS)
    look = f"k > 0 AND k % {mixing.SWEEPS} = 0"
    inner = f"""SELECT k + 1 AS k, source, lang, topic, tokens, cap, {goals}, {free}, CASE WHEN {look} THEN off ELSE before END AS before
                FROM {name} WHERE k < {mixing.MOST_SWEEPS} AND NOT ({look} AND (off <= {mixing.TOLERANCE} OR coalesce(off > before * (1 - 1e-4), false)))"""
    kept = f"k, source, lang, topic, tokens, cap, {goals}, before"
    for dim in mixing.DIMENSIONS:
        if free == weight:
            inner = f"""SELECT {kept}, coalesce({free} * g_{dim} / nullif(sum({weight}) OVER (PARTITION BY {dim}), 0), 0) AS {free} FROM ({inner})"""
            continue
        # The factor at which the cells below their caps, in order of their ratio to these, make up the goal.
        inner = f"""SELECT {kept}, {free} * greatest(0, coalesce(max(CASE WHEN f * {free} / cap <= 1 + 1e-12 THEN f END) OVER (PARTITION BY {dim}),
                    max(CASE WHEN {free} > 0 THEN cap / {free} END) OVER (PARTITION BY {dim}), 0)) AS {free}
                FROM (SELECT *, (g_{dim} - (sum(cap) OVER (PARTITION BY {dim}) - sum(cap) OVER (PARTITION BY {dim} ORDER BY {free} / cap)))
                      / nullif(sum({free}) OVER (PARTITION BY {dim} ORDER BY {free} / cap), 0) AS f FROM ({inner}))"""
    errors = ", ".join(f"coalesce(abs(sum({weight}) OVER (PARTITION BY {d}) / nullif(g_{d}, 0) - 1), 0) AS e_{d}" for d in mixing.DIMENSIONS)
    worst = "greatest(" + ", ".join(f"e_{d}" for d in mixing.DIMENSIONS) + ")"
    return f"""SELECT k, source, lang, topic, tokens, cap, {goals}, {free}, max({worst}) OVER () AS off, before
               FROM (SELECT *, {errors} FROM ({inner}))"""


def _mixing_sql() -> str:
    """Cells, their target shares, raking without and with caps, and the documents."""
    topic = "CASE " + " ".join(
        "WHEN " + " OR ".join(f"contains(text, '{m}')" for m in marks) + f" THEN '{name}'" for name, marks in mixing.TOPICS
    ) + " ELSE 'prose' END"
    steps = [
        f"""docs AS (SELECT doc_id, source, lang, {topic} AS topic,
                len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) + 1 AS tokens FROM documents)""",
        "c AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM docs GROUP BY ALL)",
    ]
    for dim in mixing.DIMENSIONS:
        steps.append(f"m_{dim} AS (SELECT {dim}, pow(sum(tokens), {mixing.TEMPER[dim]}) AS p FROM c GROUP BY {dim})")
        # What each value's cells can give, and the factor by which the others make up for those that give all.
        steps.append(
            f"""s_{dim} AS (SELECT {dim}, p / (SELECT sum(p) FROM m_{dim}) AS wanted,
                 (SELECT sum(tokens) FROM c WHERE c.{dim} IS NOT DISTINCT FROM m_{dim}.{dim}) / ({mixing.KEEP} * (SELECT sum(tokens) FROM c)) AS most
                 FROM m_{dim})"""
        )
        steps.append(
            f"""f_{dim} AS (SELECT *, (least(1, sum(most) OVER ()) - coalesce(sum(most) OVER before, 0))
                 / (sum(wanted) OVER () - coalesce(sum(wanted) OVER before, 0)) AS f FROM s_{dim}
                 WINDOW before AS (ORDER BY most / wanted, {dim} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))"""
        )
        steps.append(
            f"""r_{dim} AS (SELECT {dim}, wanted, least(most, wanted *
                 greatest(1, coalesce((SELECT arg_min(f, most / wanted) FROM f_{dim} WHERE f * wanted < most), 1e300))) AS reached FROM s_{dim})"""
        )
    joins = " ".join(f"JOIN r_{d} ON c.{d} IS NOT DISTINCT FROM r_{d}.{d}" for d in mixing.DIMENSIONS)
    plain, cut = (", ".join(f"r_{d}.{kind} AS g_{d}" for d in mixing.DIMENSIONS) for kind in ("wanted", "reached"))
    share = "c.tokens / (SELECT sum(tokens) FROM c)"
    start = "SELECT 0 AS k, c.source, c.lang, c.topic, c.tokens, c.tokens / ({keep} * (SELECT sum(tokens) FROM c)) AS cap, {goals}, {share} AS {free}, NULL::DOUBLE AS off, NULL::DOUBLE AS before FROM c {joins}"
    for name, free, weight, goals in (("u", "w", "w", plain), ("b", "free", "least(free, cap)", cut)):
        first = start.format(keep=mixing.KEEP, goals=goals, share=share, free=free, joins=joins)
        steps.append(f"{name} AS ({first} UNION ALL {_sweep_sql(name, free, weight)})")
    steps.append(
        """p AS (SELECT u.source, u.lang, u.topic, u.w, least(b.free, b.cap) / b.cap AS probability
           FROM (SELECT * FROM u WHERE k = (SELECT max(k) FROM u)) u JOIN (SELECT * FROM b WHERE k = (SELECT max(k) FROM b)) b
           ON u.source IS NOT DISTINCT FROM b.source AND u.lang IS NOT DISTINCT FROM b.lang AND u.topic = b.topic)"""
    )
    return (
        "WITH RECURSIVE " + ",\n".join(steps) + """
        SELECT d.doc_id, d.source, d.lang, d.topic, d.tokens, round(p.w, 6) AS weight, round(p.probability, 6) AS probability,
               ('0x' || substr(md5(d.doc_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE < p.probability AS sampled
        FROM docs d JOIN p ON d.source IS NOT DISTINCT FROM p.source AND d.lang IS NOT DISTINCT FROM p.lang AND d.topic = p.topic"""
    )


ORACLES["op1_mixing"] = _mixing_sql()

ORACLES["op7_decontamination"] = r"""
    WITH w AS (
        SELECT 'd' AS kind, doc_id AS id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM documents
        UNION ALL
        SELECT 'i', item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')
        FROM benchmark),
    items AS (
        SELECT id, span, array_to_string(words[p:p + span - 1], ' ') AS win
        FROM (SELECT id, words, least(len(words), 10) AS span, unnest(range(1, len(words) - least(len(words), 10) + 2)) AS p
              FROM w WHERE kind = 'i' AND len(words) > 0)),
    docs AS (
        SELECT id, span, p, array_to_string(words[p:p + span - 1], ' ') AS win
        FROM (SELECT id, words, span, unnest(range(1, len(words) - span + 2)) AS p
              FROM w, (SELECT DISTINCT span FROM items) WHERE kind = 'd' AND len(words) >= span)),
    hits AS (SELECT d.id, d.p, d.span, i.id AS item FROM docs d JOIN items i USING (span, win)),
    per_doc AS (
        SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item::VARCHAR, ',' ORDER BY item::VARCHAR) AS items
        FROM hits GROUP BY id),
    covered AS (
        SELECT id, count(DISTINCT word) AS n_hit
        FROM (SELECT id, unnest(range(p, p + span)) AS word FROM (SELECT DISTINCT id, p, span FROM hits)) GROUP BY id)
    SELECT w.id AS doc_id, len(w.words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM w LEFT JOIN per_doc USING (id) LEFT JOIN covered USING (id) WHERE kind = 'd'"""

ORACLES["op9_warc"] = """
    WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
    f AS (SELECT *, min(page_id) OVER (PARTITION BY html) AS first FROM p)
    SELECT page_id, n AS payload_bytes, sha256(html) AS payload_digest,
           CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
           CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
    FROM f"""


def _centroids_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS) -> str:
    """The rounds unrolled: every kept vector against the centroids, a stated set of 16 rows."""
    parts = [
        f"""v AS (
        SELECT vec_id, list_transform(embedding, lambda c: floor({centroids.SCALE} * c::DOUBLE)::BIGINT) AS y
        FROM embeddings
        WHERE len(embedding) = {centroids.DIMS}
          AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = {centroids.DIMS})""",
        f"""c0 AS (
        SELECT row_number() OVER (ORDER BY mark, y) - 1 AS cluster, y AS c
        FROM (SELECT sha256('1:' || vec_id::VARCHAR) AS mark, y FROM v WHERE vec_id IS NOT NULL ORDER BY mark, y LIMIT {clusters}))""",
    ]
    for k in range(rounds + 1):
        parts.append(f"""a{k} AS (
        SELECT id, any_value(vec_id) AS vec_id, any_value(y) AS y, min((distance, cluster)) AS best
        FROM (SELECT id, vec_id, y, cluster,
                     list_sum(list_transform(list_zip(y, c), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS distance
              FROM (SELECT row_number() OVER () AS id, * FROM v) CROSS JOIN c{k})
        GROUP BY id)""")
        if k < rounds:
            parts.append(f"""c{k + 1} AS (
        SELECT c{k}.cluster, coalesce(m.c, c{k}.c) AS c
        FROM c{k} LEFT JOIN (
            SELECT cluster, list(((total - ((total % n) + n) % n) // n)::BIGINT ORDER BY place) AS c
            FROM (SELECT best[2] AS cluster, place, sum(y[place]) AS total, count(*) AS n
                  FROM a{k}, (SELECT unnest(range(1, {centroids.DIMS + 1})) AS place) GROUP BY ALL)
            GROUP BY cluster) m USING (cluster))""")
    return f"""
    WITH {", ".join(parts)}
    SELECT vec_id, best[2]::INT AS cluster, best[1] AS distance,
           (sum(best[1]) OVER (PARTITION BY best[2]))::BIGINT AS cluster_inertia,
           (sum(best[1]) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(c, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} ON best[2] = cluster"""


ORACLES["op12_centroids"] = _centroids_sql()
