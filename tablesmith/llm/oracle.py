"""DuckDB SQL for the queries that SQL can express."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), listed AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS INTEGER) AS kind
  FROM sized GROUP BY source
), weighed AS (
  SELECT *, [3, 1, 2][kind + 1]::BIGINT AS weight, 2 * source_size AS cap FROM listed
), filled AS (
  SELECT *, CAST(sum(source_size) OVER () * 150 AS BIGINT) AS budget,
         coalesce(sum(cap) OVER w, 0)::BIGINT AS caps_before,
         sum(weight) OVER (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::BIGINT AS weights_left
  FROM weighed
  WINDOW w AS (ORDER BY cap::DOUBLE / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), marked AS (
  SELECT *, weight * (budget - 100 * caps_before) > 100 * cap * weights_left AS capped FROM filled
), summed AS (
  SELECT *, (sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ())::BIGINT AS capped_sum,
         (sum(CASE WHEN capped THEN 0 ELSE weight END) OVER ())::BIGINT AS free_weight
  FROM marked
), targets AS (
  SELECT source, source_size, kind,
         CASE WHEN capped OR cap = 0 THEN cap::DOUBLE
              ELSE (weight * (budget - 100 * capped_sum))::DOUBLE / (100 * free_weight)::DOUBLE END AS target
  FROM summed
), placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.kind, t.target, round(t.target)::BIGINT AS words,
         coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id, s.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), cut AS (
  SELECT *, greatest(0, least(size, words - start))::BIGINT AS t1,
         greatest(0, least(size, words - start - source_size))::BIGINT AS t2,
         CASE WHEN target > 0 THEN start / target END AS part
  FROM placed
)
SELECT doc_id, size, source_size, target, t1 + t2 AS taken,
  CASE WHEN t1 > 0 THEN CASE kind
    WHEN 0 THEN 0.0::DOUBLE + 2.0 * (part * 2.0 - 0.0) / (3.0 + sqrt(greatest(9.0::DOUBLE + -4.0 * (part * 2.0 - 0.0), 0.0)))
    WHEN 1 THEN 0.0::DOUBLE + 2.0 * (part * 1.0 - 0.0) / (1.0 + sqrt(greatest(1.0::DOUBLE + 0.0 * (part * 1.0 - 0.0), 0.0)))
    ELSE CASE WHEN part * 1.75 >= 0.5
      THEN 0.5::DOUBLE + 2.0 * (part * 1.75 - 0.5) / (1.0 + sqrt(greatest(1.0::DOUBLE + 12.0 * (part * 1.75 - 0.5), 0.0)))
      ELSE 0.0::DOUBLE + 2.0 * (part * 1.75 - 0.0) / (1.0 + sqrt(greatest(1.0::DOUBLE + 0.0 * (part * 1.75 - 0.0), 0.0))) END
  END END AS first_position
FROM cut
"""

#: Cells of failures are counted, then asked of each order and step one by one.
FILTER_AUDIT = r"""
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents
), split AS (
  SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words, min(doc_id) OVER (PARTITION BY t) AS first FROM read
), judged AS (
  SELECT doc_id, part,
         len(words) < 200 AS a,
         100 * len(list_distinct(words)) < 50 * len(words) AS b,
         100 * len(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * len(t) AS c,
         regexp_matches(t, '[#$%&*|]') AS d,
         coalesce(doc_id > first, false) AS e
  FROM split
), marks AS (
  SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id
), cells AS (
  SELECT part, MAP {'A': a, 'B': b, 'C': c, 'D': d, 'E': e} AS fails,
         a::INT + b::INT + c::INT + d::INT + e::INT AS n_fails,
         count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic
  FROM judged LEFT JOIN marks USING (doc_id) GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l
), orders AS (
  SELECT v.l || w.l || x.l || y.l || z.l AS filter_order FROM letters v, letters w, letters x, letters y, letters z
  WHERE len(list_distinct([v.l, w.l, x.l, y.l, z.l])) = 5
), asked AS (
  SELECT c.*, filter_order, s.step, fails[substr(filter_order, s.step::INTEGER, 1)] AS here,
         len(list_filter(range(1, s.step), lambda i: fails[substr(filter_order, i::INTEGER, 1)])) > 0 AS earlier
  FROM cells c, orders, (SELECT unnest(range(1, 6)) AS step) s
), steps AS (
  SELECT part, filter_order, step,
         coalesce(sum(n) FILTER (NOT here AND NOT earlier), 0) AS kept,
         coalesce(sum(n) FILTER (here AND NOT earlier), 0) AS removed,
         coalesce(sum(n) FILTER (here AND earlier), 0) AS redundant,
         coalesce(sum(n) FILTER (here AND n_fails = 1), 0) AS unique_fails,
         coalesce(sum(n_good) FILTER (here AND NOT earlier), 0) AS good_lost,
         coalesce(sum(n_toxic) FILTER (here AND NOT earlier), 0) AS toxic_lost
  FROM asked GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, substr(filter_order, step::INTEGER, 1)))::BIGINT AS shapley
FROM steps
"""

LEXICAL_SEARCH = r"""
WITH read AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
  FROM documents
), numbered AS (
  SELECT row_number() OVER () AS doc, doc_id, terms, len(terms)::BIGINT AS n FROM read WHERE len(terms) > 0
), corpus AS (
  SELECT count(*)::BIGINT AS n_docs, sum(n)::BIGINT AS n_terms FROM numbered
), postings AS (
  SELECT doc, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT doc, doc_id, n, unnest(terms) AS term FROM numbered) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM postings, corpus GROUP BY term, n_docs
), asked AS (
  SELECT item, item_id, unnest(list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
  FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
), scored AS (
  SELECT item, item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms))))::BIGINT AS score
  FROM asked JOIN postings USING (term) JOIN weights USING (term), corpus GROUP BY ALL
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""

ORACLE = {"op7_mixing": MIXING, "op11_filter_audit": FILTER_AUDIT, "op12_lexical_search": LEXICAL_SEARCH}
