"""DuckDB SQL for the registered queries that SQL can express."""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def words_sql(text: str) -> str:
    """The words of a text, as a list."""
    return (
        f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), "
        r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )


OP8 = f"""
WITH item_words AS (
    SELECT item_id, {words_sql("text")} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT CAST(item_id AS VARCHAR) AS item,
           unnest([array_to_string(w[i:i + 12], ' ') FOR i IN range(1, greatest(2, len(w) - 11))]) AS win,
           least(13, len(w)) AS n
    FROM item_words WHERE len(w) > 0
), texts AS (
    SELECT t, {words_sql("t")} AS w FROM (SELECT DISTINCT text AS t FROM documents WHERE text IS NOT NULL)
), sizes AS (
    SELECT DISTINCT n FROM windows
), grams AS (
    SELECT t, n, unnest(range(1, len(w) - n + 2)) AS p, w FROM texts, sizes WHERE len(w) >= n
), hits AS (
    SELECT g.t, g.p, g.n, x.item
    FROM (SELECT t, p, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM grams) g
    JOIN windows x ON x.win = g.win AND x.n = g.n
), places AS (
    SELECT t, count(DISTINCT q) AS n_hit
    FROM (SELECT t, unnest(range(p, p + n)) AS q FROM hits) GROUP BY t
), items AS (
    SELECT t, list_sort(list(DISTINCT item)) AS items FROM hits GROUP BY t
)
SELECT d.doc_id, CAST(len({words_sql("d.text")}) AS BIGINT) AS n_words,
       CAST(coalesce(p.n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(len(i.items), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(i.items, ','), '')) AS items_sha256,
       coalesce(p.n_hit, 0) > 0 AND 20 * coalesce(p.n_hit, 0) >= len({words_sql("d.text")}) AS contaminated
FROM documents d LEFT JOIN places p ON p.t = d.text LEFT JOIN items i ON i.t = d.text
"""



OP2 = """
WITH vectors AS (
    SELECT vec_id, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 10
"""

OP6 = """
WITH payloads AS (
    SELECT page_id, encode(coalesce(html, '')) AS payload, sha256(coalesce(html, '')) AS digest FROM pages
), firsts AS (
    SELECT digest, min(page_id) AS first FROM payloads WHERE octet_length(payload) >= 100 GROUP BY digest
)
SELECT page_id, octet_length(payload) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON f.digest = p.digest AND octet_length(payload) >= 100
"""


def _op7() -> str:
    from .licenses import BLOCK, PHRASES, STEP, TEMPLATES, THRESHOLD

    phrases = " UNION ALL ".join(
        f"SELECT t, '{label}' AS label, unnest([i FOR i IN range(0, greatest(0, len(w) - {len(parts) - 1})) IF "
        + " AND ".join(f"w[i + {k + 1}] = '{part}'" for k, part in enumerate(parts))
        + "]) AS p FROM texts"
        for phrase, label in PHRASES.items()
        for parts in [phrase.split()]
    )
    templates = ", ".join(
        f"({i}, '{label}', {sorted(set(text.split()))!r})" for i, (label, text) in enumerate(TEMPLATES)
    )
    return f"""
WITH texts AS (
    SELECT t, {words_sql("t")} AS w FROM (SELECT DISTINCT text AS t FROM documents WHERE text IS NOT NULL)
), places AS ({phrases}
), base AS (
    SELECT t, count(*) AS n, min(p) AS a, max(p) AS b, list(DISTINCT label) AS labels FROM places GROUP BY t
), templates(k, label, words) AS (VALUES {templates}
), blocks AS (
    SELECT t, unnest([w[i * {STEP} + 1:i * {STEP} + {BLOCK}] FOR i IN range(0, 1 + CAST(ceil(greatest(len(w) - {BLOCK}, 0) / {STEP}) AS BIGINT))]) AS b
    FROM texts
), met AS (
    SELECT t, label, len(list_intersect(words, b)) / len(words) AS share FROM blocks, templates
    WHERE len(list_intersect(words, b)) >= ceil({THRESHOLD} * len(words) - 1e-9)
), found AS (
    SELECT t, list(DISTINCT label) AS labels, max(share) AS share FROM met GROUP BY t
)
SELECT d.doc_id, CAST(len({words_sql("d.text")}) AS BIGINT) AS n_words, CAST(coalesce(b.n, 0) AS BIGINT) AS n_base,
       b.a AS first_word, b.b AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(f.labels, [])))), ','), '') AS labels,
       CAST(CASE WHEN b.n > 0 THEN 1.0 ELSE coalesce(f.share, 0.0) END AS DOUBLE) AS score
FROM documents d LEFT JOIN base b ON b.t = d.text LEFT JOIN found f ON f.t = d.text
"""


OP13 = r"""
WITH hashed AS (
    -- crc32 bit by bit; 3988292384 is its polynomial, reversed
    SELECT doc_id, text, xor(4294967295, list_reduce([4294967295] || flatten([[(ord(c) >> k) & 1 FOR k IN range(8)] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
        lambda crc, b: xor(crc >> 1, 3988292384 * (xor(crc, b) & 1)))) AS h
    FROM documents
), split AS (
    SELECT doc_id, h // 10 AS g, h % 10 = 0 AS planted,
           regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM hashed
), tails AS (
    SELECT doc_id, w, len(w) AS n, g % len(w) AS a, 1 + (len(w) - g % len(w)) // (3 + g % 8) AS p
    FROM split WHERE planted AND len(w) > 0
), texts AS (
    SELECT doc_id, len(w) AS n, w FROM split WHERE NOT planted OR len(w) = 0
    UNION ALL
    SELECT doc_id, n, [w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] FOR i IN range(n)] FROM tails
), places AS (
    SELECT doc_id, n, unnest(w) AS word, unnest(range(n)) AS i FROM texts
), same AS (
    SELECT x.doc_id, x.i, y.i - x.i AS q
    FROM places x JOIN places y ON y.doc_id = x.doc_id AND y.word = x.word AND y.i > x.i AND y.i - x.i <= x.n // 4
), islands AS (
    SELECT doc_id, q, min(i) AS s, count(*) + q AS n
    FROM (SELECT doc_id, q, i, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM same)
    GROUP BY doc_id, q, island
), runs AS (
    -- a stretch's smallest period
    SELECT doc_id, s, n, min(q) AS q FROM islands WHERE n >= greatest(6, 4 * q) GROUP BY doc_id, s, n
), told AS (
    SELECT doc_id, count(*) AS n_runs, min((-n, s, q)) AS best,
           string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM runs GROUP BY doc_id
), dropped AS (
    SELECT DISTINCT doc_id, unnest(range(s + q, s + n)) AS i FROM runs
), collapsed AS (
    SELECT p.doc_id, string_agg(p.word, ' ' ORDER BY p.i) AS kept
    FROM places p LEFT JOIN dropped d ON d.doc_id = p.doc_id AND d.i = p.i WHERE d.i IS NULL GROUP BY p.doc_id
)
SELECT t.doc_id, coalesce(r.n_runs, 0) AS n_runs, r.best[2] AS start, -r.best[1] AS length, r.best[3] AS period,
       1000 * -r.best[1] // r.best[3] AS exponent_milli,
       sha256(coalesce(r.lines, '')) AS runs_sha256, sha256(coalesce(c.kept, '')) AS collapsed_sha256
FROM texts t LEFT JOIN told r ON r.doc_id = t.doc_id LEFT JOIN collapsed c ON c.doc_id = t.doc_id
"""

ORACLES: dict[str, str] = {
    "op2_top_k": OP2,
    "op6_warc": OP6,
    "op7_licenses": _op7(),
    "op8_decontamination": OP8,
    "op13_periodic_runs": OP13,
}
