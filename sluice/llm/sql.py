"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

OP9 = r"""
WITH d AS (
    SELECT doc_id, coalesce(length(text), 0) AS points,
           sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')) AS text_sha256
    FROM documents
), g AS (
    SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
           first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY points DESC, doc_id) AS keep_id
    FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g
"""

OP10 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS kind,
           CASE kind WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
    FROM d GROUP BY source
), rounds AS (
    SELECT 0 AS i, source, source_size, kind, weight, FALSE AS capped FROM s
    UNION ALL
    SELECT i + 1, source, source_size, kind, weight, capped OR weight * left_over > 200 * source_size * weights
    FROM (
        SELECT *,
               sum(source_size) OVER () * 150
                   - coalesce(sum(200 * source_size) FILTER (capped) OVER (), 0) AS left_over,
               coalesce(sum(weight) FILTER (NOT capped) OVER (), 0) AS weights
        FROM rounds
    ) r
    WHERE i < 40
), t AS (
    SELECT source, source_size, kind,
           CASE WHEN capped THEN 2.0::DOUBLE * source_size
                ELSE (weight * (sum(source_size) OVER () * 150
                        - coalesce(sum(200 * source_size) FILTER (capped) OVER (), 0)))::DOUBLE
                     / (sum(weight) FILTER (NOT capped) OVER () * 100)::DOUBLE END AS target
    FROM rounds WHERE i = 40
), p AS (
    SELECT d.doc_id, d.size, t.source_size, t.kind, t.target, floor(t.target + 0.5)::BIGINT AS wanted,
           (coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY md5(d.doc_id::VARCHAR), d.doc_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::BIGINT AS before
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       greatest(0, least(size, wanted - before)) + greatest(0, least(size, wanted - source_size - before)) AS taken,
       (least(size, wanted - before) > 0)::BIGINT + (least(size, wanted - source_size - before) > 0)::BIGINT AS readings,
       -- the demand is the integral of the schedule: 7.5 t - 2.5 t^2, 2 t and 0.5 t + 0.5 t^2
       CASE WHEN least(size, wanted - before) <= 0 THEN NULL WHEN before = 0 THEN 0.0::DOUBLE
            WHEN kind = 0 THEN 2 * (before / wanted * 5) / (7.5 + sqrt(56.25 - 10 * (before / wanted * 5)))
            WHEN kind = 1 THEN 2 * (before / wanted * 2) / (2.0 + sqrt(4.0 + 0 * (before / wanted * 2)))
            ELSE 2 * (before / wanted * 1) / (0.5 + sqrt(0.25 + 2 * (before / wanted * 1))) END AS first_position
FROM p
"""

OP4 = r"""
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), s AS (
    SELECT DISTINCT doc_id, unnest(
        CASE WHEN len(words) >= 5 THEN [words[i:i + 4] for i in range(1, len(words) - 3)]
             WHEN len(words) > 0 THEN [words] ELSE [] END) AS shingle
    FROM w
), n AS (
    SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), l AS (
    SELECT a.doc_id AS x, b.doc_id AS y
    FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
    GROUP BY a.doc_id, b.doc_id, na.n, nb.n
    HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))
), r AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT r.x, l.y FROM r JOIN l ON l.x = r.y
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.y) AS component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN r ON r.x = d.doc_id
GROUP BY d.doc_id
"""

OP6 = r"""
WITH v AS (
    SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS ints
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), s AS (
    SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.ints, c.ints)::BIGINT AS score
    FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id
)
SELECT query_id, rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s
) r WHERE rank <= 10
"""

OP11 = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), b AS (
    SELECT item_id, words, least(10, len(words)) AS size FROM (
        SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
            'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
        FROM benchmark) t
    WHERE len(words) > 0
), w AS (
    SELECT DISTINCT item_id, size, unnest([words[i:i + size - 1] for i in range(1, len(words) - size + 2)]) AS content
    FROM b
), p AS (
    SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS place
    FROM d, (SELECT DISTINCT size FROM w) z
), h AS (
    SELECT p.doc_id, p.place, p.size, w.item_id
    FROM p JOIN w ON w.size = p.size AND w.content = p.words[p.place:p.place + p.size - 1]
), n AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(place, place + size)) AS word FROM h
    ) t GROUP BY doc_id
), i AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
    FROM (SELECT DISTINCT doc_id, item_id FROM h) t GROUP BY doc_id
)
SELECT d.doc_id, len(d.words)::BIGINT AS n_words, coalesce(n.n_hit, 0)::BIGINT AS n_hit,
       coalesce(i.n_items, 0)::BIGINT AS n_items, sha256(coalesce(i.items, '')) AS items_sha256,
       coalesce(n.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN i ON i.doc_id = d.doc_id
"""

OP12 = r"""
WITH RECURSIVE d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
           min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS first_id
    FROM documents
), l AS (
    SELECT doc_id, coalesce(max(quality) = 1, FALSE) AS good, coalesce(max(toxic) = 1, FALSE) AS toxic
    FROM labels GROUP BY doc_id
), m AS (
    SELECT part, coalesce(good, FALSE) AS good, coalesce(toxic, FALSE) AS toxic, [
        len(words) < 100, 100 * len(list_distinct(words)) < 80 * len(words),
        100 * length(regexp_replace(text, '[^A-Z]+', '', 'g')) > 10 * length(text),
        regexp_matches(text, '[#$%&*|]'), coalesce(first_id < d.doc_id, FALSE)] AS fails
    FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), orders AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || letter FROM orders, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter)
    WHERE NOT contains(filter_order, letter)
), s AS (
    SELECT part, filter_order, step, good, toxic, n,
           fails[ascii(filter_order[step]) - 64] AS here,
           len([x for x in range(1, step) if fails[ascii(filter_order[x]) - 64]]) > 0 AS before,
           len([x for x in fails if x]) AS failed
    FROM (SELECT part, good, toxic, fails, count(*) AS n FROM m GROUP BY ALL),
         (SELECT * FROM orders, (SELECT unnest(range(1, 6)) AS step) WHERE length(filter_order) = 5)
), r AS (
    SELECT part, filter_order, step::INT AS step,
           coalesce(sum(n) FILTER (NOT here AND NOT before), 0)::BIGINT AS kept,
           coalesce(sum(n) FILTER (here AND NOT before), 0)::BIGINT AS removed,
           coalesce(sum(n) FILTER (here AND before), 0)::BIGINT AS redundant,
           coalesce(sum(n) FILTER (here AND failed = 1), 0)::BIGINT AS unique_fails,
           coalesce(sum(n) FILTER (here AND NOT before AND good), 0)::BIGINT AS good_lost,
           coalesce(sum(n) FILTER (here AND NOT before AND toxic), 0)::BIGINT AS toxic_lost
    FROM s GROUP BY part, filter_order, step
)
SELECT *, (sum(removed) OVER (PARTITION BY part, filter_order[step]))::BIGINT AS shapley FROM r
"""


def _op13(rounds: int = 2) -> str:
    """Each round assigns the parts (a) and replaces the entries of the codebooks (c)."""
    steps = [r"""
WITH v AS (
    SELECT vec_id, label, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS ints
    FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), p AS (
    SELECT vec_id, label, part, ints[part * (len(ints) // 16) + 1:(part + 1) * (len(ints) // 16)] AS x
    FROM v, (SELECT unnest(range(16)) AS part)
), c0 AS (
    SELECT part, entry, x AS e
    FROM p JOIN (
        SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM v ORDER BY vec_id LIMIT 64
    ) f ON f.vec_id = p.vec_id
)"""]
    for i in range(rounds + 1):
        steps.append(f""", a{i} AS (
    SELECT vec_id, label, part, x, min(d) AS d, arg_min(entry, d * 64 + entry) AS entry
    FROM (
        SELECT p.*, entry, list_sum([(x[i] - e[i]) * (x[i] - e[i]) for i in range(1, len(x) + 1)])::BIGINT AS d
        FROM p JOIN c{i} ON c{i}.part = p.part
    ) t GROUP BY vec_id, label, part, x
)""")
        if i < rounds:
            steps.append(f""", s{i} AS (
    SELECT part, entry, i, floor(sum(value)::DOUBLE / count(*))::BIGINT AS value
    FROM (SELECT part, entry, unnest(x) AS value, unnest(range(len(x))) AS i FROM a{i}) t
    GROUP BY part, entry, i
), m{i} AS (
    SELECT part, entry, list(value ORDER BY i) AS e FROM s{i} GROUP BY part, entry
), c{i + 1} AS (
    SELECT c{i}.part, c{i}.entry, coalesce(m{i}.e, c{i}.e) AS e
    FROM c{i} LEFT JOIN m{i} ON m{i}.part = c{i}.part AND m{i}.entry = c{i}.entry
)""")
    steps.append(f""", r AS (
    SELECT vec_id, label, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM a{rounds} GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) FROM c{rounds}) AS codebooks_sha256
FROM r
""")
    return "".join(steps)


SQL: dict[str, str] = {
    "op4_ngram_join": OP4,
    "op6_topk": OP6,
    "op9_exact_dedup": OP9, "op10_mixing": OP10,
    "op11_decontamination": OP11, "op12_filter_audit": OP12,
    "op13_vector_codes": _op13(),
}
