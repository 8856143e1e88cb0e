"""DuckDB SQL for the text queries that SQL can express."""

from __future__ import annotations

MIXING = r"""
WITH d AS (
    SELECT doc_id, source,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
           -ln(((('0x' || substr(md5('7|' || coalesce(doc_id::VARCHAR, '') || '|0'), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496)
             / coalesce(greatest(0.25, length(regexp_replace(text, '[^\p{Ll}]+', '', 'g'))::DOUBLE / greatest(length(text), 1)), 0.25) AS k
    FROM documents
), s AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
    SELECT *, 2.0::DOUBLE * source_size AS cap,
           CASE (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS w
    FROM s
), l AS (
    SELECT *,
           (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER r, 0))
             / (sum(w) OVER () - coalesce(sum(w) OVER r, 0)) AS level
    FROM w
    WINDOW r AS (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), t AS (
    SELECT source, source_size, least(cap, max(CASE WHEN level < cap / w THEN level END) OVER () * w) AS target FROM l
), p AS (
    SELECT d.*, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS whole,
           coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
    SELECT *, CASE WHEN size > 0 THEN whole + CASE WHEN start + size / 2.0 <= target - whole * source_size THEN 1 ELSE 0 END ELSE 0 END::BIGINT AS epochs
    FROM p
)
SELECT doc_id, size, source_size, target, (size * epochs)::BIGINT AS taken, epochs FROM e
"""

# Without seeds: every diagonal on which some token agrees is counted.
DECONTAMINATION = r"""
WITH b AS (
    SELECT DISTINCT item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM benchmark
), i AS (
    SELECT row_number() OVER () AS part, item_id, words, len(words) AS n FROM b WHERE len(words) >= 5
), d AS (
    SELECT row_number() OVER () AS part, doc_id, words, len(words) AS n
    FROM (SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS words FROM documents)
), it AS (
    SELECT part, item_id, n, unnest(words) AS word, unnest(range(0, n)) AS q FROM i
), dt AS (
    SELECT part, doc_id, n, unnest(words) AS word, unnest(range(0, n)) AS p FROM d
), m AS (
    SELECT dt.part AS dp, it.part AS ip, doc_id, item_id, least(13, it.n) AS length, p - q AS diag, q,
           greatest(0, q - p) AS lo, least(it.n, dt.n - (p - q)) - 1 AS hi
    FROM it JOIN dt USING (word)
), c AS (
    -- a run that begins at a token that agrees, or the last run of the diagonal
    SELECT doc_id, item_id, length, hi - lo + 1 AS room,
           CASE WHEN q <= hi - length + 1
                THEN CASE WHEN length = 13 THEN count(*) OVER run ELSE count(*) OVER diagonal END
                ELSE count(CASE WHEN q > hi - length THEN 1 END) OVER diagonal END AS matched
    FROM m
    WINDOW run AS (PARTITION BY dp, ip, diag ORDER BY q RANGE BETWEEN CURRENT ROW AND 12 FOLLOWING),
           diagonal AS (PARTITION BY dp, ip, diag)
), f AS (
    SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM c WHERE room >= length AND matched >= 0.8 * length GROUP BY doc_id
)
SELECT documents.doc_id, items IS NOT NULL AS contaminated, coalesce(len(items), 0)::BIGINT AS n_items, coalesce(array_to_string(items, ','), '') AS items
FROM documents LEFT JOIN f ON documents.doc_id = f.doc_id
"""

COLLOCATIONS = r"""
WITH p AS (
    SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
    FROM (
        SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents
    )
), g AS (
    SELECT lang, 1 AS words, unnest(w) AS phrase FROM p
    UNION ALL
    SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM p
    UNION ALL
    SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM p
), t AS (
    SELECT lang, count(*) AS n FROM g WHERE words = 1 GROUP BY lang
), f AS (
    SELECT lang, words, phrase, count(*) AS a FROM g GROUP BY lang, words, phrase
), c AS (
    SELECT lang, words, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND a >= 10
), k AS (
    SELECT lang, words, phrase, a, 1 AS k, w[1] AS head, array_to_string(w[2:], ' ') AS tail FROM c
    UNION ALL
    SELECT lang, words, phrase, a, 2, w[1] || ' ' || w[2], w[3] FROM c WHERE words = 3
), s AS (
    SELECT k.lang, k.words, k.phrase, k.a, k.k, h.a AS l, e.a AS r,
           (1000000::HUGEINT * k.a * k.a) // (h.a::HUGEINT * e.a) AS score
    FROM k
    JOIN f h ON h.lang = k.lang AND h.phrase = k.head
    JOIN f e ON e.lang = k.lang AND e.phrase = k.tail
), b AS (
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), i AS (
    SELECT lang, phrase, max(a) AS held FROM (
        SELECT lang, a, w[1] || ' ' || w[2] AS phrase FROM c WHERE words = 3
        UNION ALL
        SELECT lang, a, w[2] || ' ' || w[3] FROM c WHERE words = 3
    ) GROUP BY lang, phrase
), x AS (
    SELECT b.*, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, b.phrase) AS rank
    FROM b LEFT JOIN i ON i.lang = b.lang AND i.phrase = b.phrase AND b.words = 2
    WHERE i.held IS NULL OR 100 * i.held < 50 * b.a
)
SELECT x.lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, t.n::BIGINT AS n, score::BIGINT AS score
FROM x JOIN t ON t.lang = x.lang
WHERE rank <= 2000
"""

LEXICAL_SEARCH = r"""
WITH d AS (
    SELECT doc_id, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
    FROM documents
), c AS (
    SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_words FROM d WHERE len(w) > 0
), q AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark
), p AS (
    SELECT doc_id, m, term, count(*) AS tf
    FROM (SELECT doc_id, 10 + (90 * len(w)::BIGINT * n_docs) // n_words AS m, unnest(w) AS term FROM d, c)
    WHERE term IN (SELECT term FROM q)
    GROUP BY doc_id, m, term
), v AS (
    SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS weight FROM p, c GROUP BY term
), s AS (
    SELECT item_id, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
    FROM q JOIN p USING (term) JOIN v USING (term)
    GROUP BY item_id, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INT AS rank, doc_id, score
FROM s WHERE score > 0
QUALIFY rank <= 10
"""

ORACLES = {
    "op3_mixing": MIXING,
    "op6_decontamination": DECONTAMINATION,
    "op12_collocations": COLLOCATIONS,
    "op13_lexical_search": LEXICAL_SEARCH,
}
