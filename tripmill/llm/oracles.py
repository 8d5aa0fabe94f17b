"""DuckDB SQL that gives the same rows as the queries that SQL can express.

The others have none: SQL has no tokenizer, no fitted model and no content-defined chunks. They are tested
against brute force in ``tests/llm``.
"""

from __future__ import annotations

_ESCAPED = r"replace(replace(replace({0}, '\', '\s'), '<', '\l'), '#', '\h')"

CHAT = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
    UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
),
placed AS (
    SELECT *, coalesce(lag(role) OVER w = role, false) AS goes_on, coalesce(lead(role) OVER w = role, false) AS stays
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
)
SELECT conv_id,
       COUNT(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
                       FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(SUM(CASE WHEN goes_on THEN 7 ELSE 6 + length(replace({_ESCAPED.format("role")}, ':', '\c')) END
                + length({_ESCAPED.format("text")}) + CASE WHEN stays THEN 0 ELSE 8 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id"""

VECTORS = """
WITH RECURSIVE sound AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM sound a JOIN sound b ON a.label = b.label AND len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
    WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reach(node, other) AS (
    SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
low AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node),
counted AS (SELECT a, COUNT(*) AS n FROM links GROUP BY a)
SELECT v.vec_id, coalesce(c.n, 0) AS n_links, coalesce(l.component, v.vec_id) AS component_id,
       coalesce(l.component, v.vec_id) = v.vec_id AS kept
FROM embeddings v LEFT JOIN low l ON v.vec_id = l.node LEFT JOIN counted c ON v.vec_id = c.a"""

NEAR_DUPLICATES = r"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
               '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) <= 4 THEN [array_to_string(w, ' ')]
                   ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))) END AS s
    FROM words
),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM sets),
common AS (
    SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, COUNT(*) AS n
    FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY ALL
),
links AS (SELECT a, b FROM common WHERE 100 * n >= 80 * (na + nb - n)),
reach(node, other) AS (
    SELECT a, b FROM links UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
low AS (SELECT node, least(node, min(other)) AS component FROM reach GROUP BY node)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(l.component, s.doc_id) AS component_id,
       coalesce(l.component, s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN low l ON s.doc_id = l.node"""

FILL_IN_MIDDLE = r"""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
),
units AS (
    SELECT doc_id, text,
           regexp_extract_all(text, '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u,
           list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(h, i, 8) AS BIGINT)) AS draws
    FROM texts
),
placed AS (
    SELECT doc_id, text, u, len(u) AS n,
           least(draws[1] % (len(u) + 1), draws[2] % (len(u) + 1)) AS a,
           greatest(draws[1] % (len(u) + 1), draws[2] % (len(u) + 1)) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR draws[3] % 100 >= 50 THEN 'plain'
                WHEN draws[4] % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
    FROM units
),
cut AS (
    SELECT doc_id, text, n, form,
           array_to_string(list_slice(u, 1, a), '') AS prefix,
           array_to_string(list_slice(u, a + 1, b), '') AS middle,
           array_to_string(list_slice(u, b + 1, n), '') AS suffix
    FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        WHEN 'spm' THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle
                        ELSE text END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut"""


def _vector_codes(rounds: int = 6) -> str:
    """Lloyd rounds over all parts and entries, one pair of tables each."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""near{r} AS MATERIALIZED (
    SELECT v, p, CAST(min(d * 16 + e) % 16 AS BIGINT) AS e, min(d) AS d FROM (
        SELECT q.v, q.p, b.e,
               coalesce(list_sum(list_transform(range(1, len(q.x) + 1), lambda i: (q.x[i] - b.c[i]) * (q.x[i] - b.c[i]))), 0) AS d
        FROM parts q JOIN book{r} b ON q.p = b.p)
    GROUP BY v, p
)""")
        if r < rounds:
            steps.append(f"""book{r + 1} AS MATERIALIZED (
    SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM book{r} b LEFT JOIN (
        SELECT p, e, list(CAST(floor(s / n) AS BIGINT) ORDER BY i) AS c FROM (
            SELECT n.p, n.e, i, sum(q.x[i]) AS s, count(*) AS n
            FROM near{r} n JOIN parts q ON n.v = q.v AND n.p = q.p, unnest(range(1, len(q.x) + 1)) t(i)
            GROUP BY ALL)
        GROUP BY p, e) m ON m.p = b.p AND m.e = b.e
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id) - 1 AS v,
           list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS z
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
    SELECT v, p, z[p * len(z) // 8 + 1 : (p + 1) * len(z) // 8] AS x FROM kept, unnest(range(8)) t(p)
),
book0 AS MATERIALIZED (SELECT p, v AS e, x AS c FROM parts WHERE v < 16),
{(","+chr(10)).join(steps)},
coded AS (
    SELECT v, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM near{rounds} GROUP BY v
),
books AS (
    SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM kept JOIN coded ON kept.v = coded.v CROSS JOIN books"""


ORACLES = {
    "op6_minhash_near_dedup": NEAR_DUPLICATES,
    "op9_chat_formatting": CHAT,
    "op10_embedding_near_dedup": VECTORS,
    "op12_fill_in_middle": FILL_IN_MIDDLE,
    "op13_vector_codes": _vector_codes(),
}
