"""The queries of this subpackage in DuckDB SQL, where SQL can express them."""

STATEMENTS: dict[str, str] = {}

STATEMENTS["op4_content_archive"] = """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload) AS size, sha1(payload) AS digest, sha256(payload) AS content_key FROM p
), f AS (
  SELECT *, max(page_id) OVER (PARTITION BY content_key) AS first_id FROM d
)
SELECT page_id, size AS payload_bytes, digest AS payload_digest,
       CASE WHEN size >= 1000 AND page_id <> first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN size >= 1000 AND page_id <> first_id THEN first_id END AS refers_to
FROM f
"""

STATEMENTS["op2_positional_index"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents
), i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM benchmark
), iw AS (
  SELECT DISTINCT item_id, width, array_to_string(words[s : s + width - 1], ' ') AS phrase
  FROM (SELECT item_id, words, least(10, len(words)) AS width, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS s
        FROM i WHERE len(words) > 0)
), dw AS (
  SELECT doc_id, s, width, array_to_string(words[s : s + width - 1], ' ') AS phrase
  FROM (SELECT doc_id, words, width, unnest(range(1, len(words) - width + 2)) AS s
        FROM w CROSS JOIN (SELECT DISTINCT width FROM iw) WHERE len(words) >= width)
), hit AS (
  SELECT doc_id, s, dw.width, item_id FROM dw JOIN iw ON dw.phrase = iw.phrase AND dw.width = iw.width
), n AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + width)) AS pos FROM hit) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

STATEMENTS["op13_filter_audit"] = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), l AS (
  SELECT doc_id, max(quality) AS quality, max(toxic) AS toxic FROM labels GROUP BY doc_id
), f AS (
  SELECT part, coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS toxic,
         len(words) < 100 AS a,
         100 * len(list_distinct(words)) < 80 * len(words) AS b,
         100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text) AS c,
         regexp_matches(text, '[#$%&*|]') AS d,
         coalesce(min(d.doc_id) OVER (PARTITION BY text) < d.doc_id, false) AS e
  FROM d LEFT JOIN l ON l.doc_id = d.doc_id
), m AS (
  SELECT part, a::INT + 2 * b::INT + 4 * c::INT + 8 * d::INT + 16 * e::INT AS mask,
         count(*) AS n, count(*) FILTER (good) AS good_n, count(*) FILTER (toxic) AS toxic_n
  FROM f GROUP BY ALL
), p AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS letter
), o AS (
  SELECT p1.letter || p2.letter || p3.letter || p4.letter || p5.letter AS filter_order
  FROM p p1, p p2, p p3, p p4, p p5
  WHERE len(list_distinct([p1.letter, p2.letter, p3.letter, p4.letter, p5.letter])) = 5
), s AS (
  SELECT filter_order, step::INT AS step, 1 << (ascii(filter_order[step]) - 65) AS bit,
         coalesce(list_sum([1 << (ascii(filter_order[i]) - 65) FOR i IN range(1, step)]), 0)::INT AS earlier
  FROM o, range(1, 6) r(step)
)
SELECT part, filter_order, step,
       sum(CASE WHEN mask & (bit | earlier) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
       sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
       sum(CASE WHEN mask & bit <> 0 AND mask & earlier <> 0 THEN n ELSE 0 END)::BIGINT AS redundant,
       sum(CASE WHEN mask = bit THEN n ELSE 0 END)::BIGINT AS unique_fails,
       sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN good_n ELSE 0 END)::BIGINT AS good_lost,
       sum(CASE WHEN mask & bit <> 0 AND mask & earlier = 0 THEN toxic_n ELSE 0 END)::BIGINT AS toxic_lost,
       sum(CASE WHEN mask & bit <> 0 THEN n * (120 // bit_count(mask)) ELSE 0 END)::BIGINT AS shapley
FROM m, s GROUP BY part, filter_order, step
"""

STATEMENTS["op11_ranked_search"] = r"""
WITH w AS (
  SELECT doc_id, row_number() OVER () AS r,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS words
  FROM documents
), q AS (
  SELECT item_id, term, count(*) AS mult
  FROM (SELECT item_id, unnest(regexp_extract_all(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY ALL
), c AS (
  SELECT count(*)::BIGINT AS n_docs, sum(len(words))::BIGINT AS n_terms FROM w WHERE len(words) > 0
), m AS (
  SELECT r, doc_id, 25 + (75 * len(words)::BIGINT * n_docs) // n_terms AS m FROM w, c WHERE len(words) > 0
), p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(words) AS term FROM w)
  WHERE term IN (SELECT term FROM q) GROUP BY ALL
), d AS (
  SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS weight
  FROM p, c GROUP BY term
), s AS (
  SELECT item_id, r, sum(mult * weight * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
  FROM q JOIN d USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY item_id, r
)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT item_id, doc_id, score,
             row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS rank
      FROM s JOIN m USING (r) WHERE score > 0)
WHERE rank <= 10
"""
