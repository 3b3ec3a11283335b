"""SQL of the queries that SQL can express."""

OP5 = """
WITH sizes AS (SELECT source, sum(length(text)) AS size FROM documents GROUP BY source),
rates AS (
    SELECT source, (pow(size, 0.5) / sum(pow(size, 0.5)) OVER ()) * CAST(sum(size) OVER () AS DOUBLE) / size AS rate
    FROM sizes
),
steps AS (
    SELECT source, rate, unnest(range(CAST(ceil(rate + 12 * sqrt(rate) + 30) AS BIGINT) + 1)) AS k FROM rates
),
logs AS (SELECT *, sum(ln(greatest(k, 1))) OVER (PARTITION BY source ORDER BY k) AS log_factorial FROM steps),
chances AS (SELECT source, k, exp(k * ln(rate) - rate - log_factorial) AS chance FROM logs),
cumulated AS (SELECT source, k, sum(chance) OVER (PARTITION BY source ORDER BY k) AS below FROM chances),
uniform AS (
    SELECT *, CAST(CAST('0x' || substr(md5('5|' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u FROM documents
),
drawn AS (
    SELECT d.* EXCLUDE (u), (SELECT count(*) FROM cumulated c WHERE c.source = d.source AND c.below <= d.u) AS n FROM uniform d
),
repeated AS (SELECT * EXCLUDE (n), unnest(range(1, n + 1)) AS copy FROM drawn)
SELECT doc_id, text, lang, source, n_chars, CAST(copy AS INT) AS copy, md5('6|' || doc_id || '|' || copy) AS shuffle_key
FROM repeated
"""

OP9 = """
WITH vectors AS (
    SELECT row_number() OVER () AS r, vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
),
scored AS (
    SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.vec_id % 100 = 0 AND q.r <> c.r AND len(q.v) = len(c.v)
),
ranked AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 10
"""

OP11 = r"""
WITH content AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
firsts AS (SELECT t, min(doc_id) AS first_id FROM content GROUP BY t),
split AS (SELECT *, [w FOR w IN regexp_split_to_array(t, '[ \t-\r]+') IF w <> ''] AS words FROM content),
marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
),
failing AS (
    SELECT part, len(words) < 50 AS a, 100 * len(list_distinct(words)) < 65 * len(words) AS b,
        100 * length(regexp_replace(t, '[^A-Z]+', '', 'g')) > 5 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
        coalesce(doc_id > first_id, false) AS e, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM split JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
),
masks AS (SELECT part, a, b, c, d, e, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failing GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT p.x || q.x || r.x || s.x || t.x AS filter_order
    FROM letters p, letters q, letters r, letters s, letters t
    WHERE len(list_distinct([p.x, q.x, r.x, s.x, t.x])) = 5
),
fates AS (
    SELECT *, least(
        if(a, instr(filter_order, 'A'), 6), if(b, instr(filter_order, 'B'), 6), if(c, instr(filter_order, 'C'), 6),
        if(d, instr(filter_order, 'D'), 6), if(e, instr(filter_order, 'E'), 6)
    ) AS gone
    FROM masks, orders
),
steps AS (
    SELECT *, substr(filter_order, step, 1) AS letter,
        CASE substr(filter_order, step, 1) WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS fails
    FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM fates)
),
counted AS (
    SELECT part, filter_order, step, letter,
        sum(if(gone > step, n, 0)) AS kept, sum(if(gone = step, n, 0)) AS removed, sum(if(fails AND gone < step, n, 0)) AS redundant,
        sum(if(fails AND a::INT + b::INT + c::INT + d::INT + e::INT = 1, n, 0)) AS unique_fails,
        sum(if(gone = step, good, 0)) AS good_lost, sum(if(gone = step, toxic, 0)) AS toxic_lost
    FROM steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""

ORACLES = {"op5_poisson_mixing": OP5, "op9_pivot_search": OP9, "op11_filter_audit": OP11}
