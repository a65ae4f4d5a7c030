"""DuckDB SQL for the registered queries that SQL can express; tests hold the others to brute force."""

from __future__ import annotations

OP3 = r"""
WITH raw AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b, strlen(coalesce(text, ''))::BIGINT AS n FROM documents
), places AS (
    SELECT doc_id, b, unnest(generate_series(1, n - 49)) AS p FROM raw WHERE n >= 50
), windows AS (
    SELECT doc_id, p, b[p : p + 49] AS w FROM places
), first_seen AS (
    SELECT w, min(doc_id) AS doc_id FROM windows GROUP BY w
), covered AS (
    SELECT DISTINCT windows.doc_id, p FROM windows JOIN first_seen AS f USING (w) WHERE f.doc_id < windows.doc_id
), marked AS (
    SELECT *, CASE WHEN p - lag(p) OVER own <= 50 THEN 0 ELSE 1 END AS fresh
    FROM covered WINDOW own AS (PARTITION BY doc_id ORDER BY p)
), numbered AS (
    SELECT *, sum(fresh) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM marked
), runs AS (
    SELECT doc_id, run, min(p) AS a, max(p) + 50 AS z FROM numbered GROUP BY ALL
), gaps AS (
    SELECT doc_id, run, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY run), 1) AS a, a AS z FROM runs
    UNION ALL
    SELECT raw.doc_id, NULL, coalesce(max(z), 1), raw.n + 1 FROM raw LEFT JOIN runs USING (doc_id)
    GROUP BY raw.doc_id, raw.n
), kept AS (
    SELECT doc_id, string_agg(CASE WHEN gaps.z > gaps.a THEN hex(b[gaps.a : gaps.z - 1]) ELSE '' END, ''
                              ORDER BY run NULLS LAST) AS bytes
    FROM gaps JOIN raw USING (doc_id) GROUP BY doc_id
)
SELECT raw.doc_id, raw.n AS n_bytes, coalesce(sum(runs.z - runs.a), 0)::BIGINT AS n_removed,
       count(runs.run)::BIGINT AS n_spans, sha256(unhex(any_value(kept.bytes))) AS kept_sha256
FROM raw JOIN kept USING (doc_id) LEFT JOIN runs USING (doc_id)
GROUP BY raw.doc_id, raw.n
"""

OP4 = r"""
WITH RECURSIVE spoken AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS words
    FROM documents
), places AS (
    SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 3, 1))) AS i
    FROM spoken WHERE len(words) > 0
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 3], ' ') AS shingle FROM places
), sizes AS (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
    SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
    FROM shingles AS a JOIN shingles AS b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
    GROUP BY ALL
), links AS (
    SELECT u, v FROM shared JOIN sizes AS x ON x.doc_id = u JOIN sizes AS y ON y.doc_id = v
    WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), edges AS (
    SELECT u, v FROM links UNION ALL SELECT v, u FROM links
), reached AS (
    SELECT doc_id, doc_id AS other FROM documents
    UNION
    SELECT reached.doc_id, edges.v FROM reached JOIN edges ON edges.u = reached.other
)
SELECT d.doc_id, coalesce(sizes.n, 0)::BIGINT AS n_shingles, c.component_id, c.component_id = d.doc_id AS kept
FROM documents AS d
JOIN (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) AS c USING (doc_id)
LEFT JOIN sizes USING (doc_id)
"""

OP13 = r"""
WITH texts AS (
    SELECT coalesce(lang, 'und') AS lang,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
    FROM documents
), pieces AS (
    SELECT lang, unnest(string_split_regex(text, '[.,;:!?\x0A-\x0D]')) AS piece FROM texts
), spoken AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM pieces
), sizes AS (
    SELECT unnest([1, 2, 3, 4]) AS size
), places AS (
    SELECT lang, size, words, unnest(generate_series(1, len(words) - size + 1)) AS i
    FROM spoken, sizes WHERE len(words) >= size
), counted AS (
    SELECT lang, size, array_to_string(words[i : i + size - 1], ' ') AS phrase, count(*) AS n
    FROM places GROUP BY ALL
), totals AS (
    SELECT lang, sum(n)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words
    FROM counted WHERE size > 1 AND n >= 30
), cuts AS (
    SELECT c.*, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1 :], ' ') AS tail
    FROM candidates AS c, (SELECT unnest([1, 2, 3]) AS k) WHERE k < size
), scored AS (
    SELECT u.lang, u.size, u.phrase, u.a, h.n AS l, t.n AS r, k,
           (2000000::HUGEINT * u.a) // (h.n::HUGEINT + t.n) AS score
    FROM cuts AS u
    JOIN counted AS h ON h.lang = u.lang AND h.phrase = u.head AND h.size = k
    JOIN counted AS t ON t.lang = u.lang AND t.phrase = u.tail AND t.size = u.size - k
), lowest AS (
    SELECT * FROM scored
    QUALIFY row_number() OVER (PARTITION BY lang, phrase, size ORDER BY score, k) = 1
), inner_phrases AS (
    SELECT c.lang, array_to_string(words[i : i + m - 1], ' ') AS phrase, m AS size, max(a) AS longer
    FROM candidates AS c, (SELECT unnest([2, 3]) AS m), (SELECT unnest([1, 2, 3]) AS i)
    WHERE m < c.size AND i + m - 1 <= c.size GROUP BY ALL
), kept AS (
    SELECT w.* FROM lowest AS w LEFT JOIN inner_phrases AS p USING (lang, phrase, size)
    WHERE p.longer IS NULL OR 100 * p.longer::HUGEINT < 80 * w.a::HUGEINT
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT lang, rank, phrase, a, l, r, totals.n AS n, score::BIGINT AS score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

SQL: dict[str, str] = {
    "op3_suffix_dedup": OP3,
    "op4_near_duplicates": OP4,
    "op13_collocations": OP13,
}
