"""Check SQL of the text operators: what each query must return, written for DuckDB over the same tables."""

#: Draw towards the benchmark texts.  crc32 is computed byte by byte over the distinct runs of words.
RESAMPLING = r"""
WITH steps AS (
    SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
        lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
texts AS (
    SELECT row_number() OVER () AS r, doc_id, text, 0 AS target FROM documents
    UNION ALL SELECT -row_number() OVER (), NULL, text, 1 FROM benchmark),
worded AS (
    SELECT r, doc_id, target, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM texts),
runs AS (
    SELECT r, target, unnest(w) AS f FROM worded
    UNION ALL
    SELECT r, target, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM worded WHERE len(w) > 1),
hexed AS (SELECT f, hex(encode(f)) AS x FROM (SELECT DISTINCT f FROM runs)),
hashed AS (
    SELECT f, xor(list_reduce(list_prepend(4294967295, list_transform(range(len(x) // 2), lambda i: ('0x' || x[2*i+1:2*i+2])::BIGINT)),
        lambda c, b: xor(c >> 8, steps.t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket FROM hexed, steps),
placed AS (SELECT r, target, bucket FROM runs JOIN hashed USING (f)),
counts AS (SELECT bucket, count(*) FILTER (target = 0) AS s, count(*) FILTER (target = 1) AS t FROM placed GROUP BY 1),
totals AS (SELECT sum(s)::DOUBLE AS s_all, sum(t)::DOUBLE AS t_all FROM counts),
gains AS (
    SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (s_all + 10000) / ((s + 1)::DOUBLE * (t_all + 10000))))::BIGINT AS gain
    FROM counts, totals),
weights AS (
    SELECT r, count(*) AS n_features, floor(sum(gain)::DOUBLE / count(*))::BIGINT AS weight
    FROM placed JOIN gains USING (bucket) WHERE target = 0 GROUP BY 1),
scored AS (
    SELECT r, doc_id, len(w) >= 20 AS able, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln(
            (('0x' || substr(sha256('7:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
    FROM worded LEFT JOIN weights USING (r) WHERE target = 0),
ranked AS (
    SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n FROM scored WHERE able)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= 25 * n // 100 THEN place END AS rank
FROM scored LEFT JOIN ranked USING (r)
"""

#: Words of repeated windows removed; every window is spelt out and grouped.
REPEATS = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
worded AS (SELECT r, doc_id, len(w) AS n, unnest(w) AS word, unnest(range(len(w))) AS j FROM texts),
windows AS (
    SELECT r, doc_id, j, n, string_agg(word, ' ') OVER (PARTITION BY r ORDER BY j ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS g
    FROM worded),
keyed AS (SELECT r, doc_id, j, sha256(g) AS g FROM windows WHERE j <= n - 50),
repeated AS (
    SELECT r, j FROM keyed JOIN (SELECT g, min(doc_id) AS low FROM keyed GROUP BY 1) USING (g) WHERE low < doc_id),
covered AS (SELECT DISTINCT r, j + k AS j FROM repeated, range(50) AS t(k)),
kept AS (
    SELECT r, count(*) FILTER (c.r IS NOT NULL) AS n_removed,
        coalesce(string_agg(word, ' ' ORDER BY j) FILTER (c.r IS NULL), '') AS text
    FROM worded LEFT JOIN (SELECT r, j, true AS hit FROM covered) c USING (r, j) GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM texts LEFT JOIN kept USING (r)
"""

#: Documents cut at line ends and put in a new order.
FILL_IN_MIDDLE = r"""
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
        sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents),
drawn AS (
    SELECT *, len(u) AS n, ('0x' || substr(x, 1, 8))::BIGINT % (len(u) + 1) AS a, ('0x' || substr(x, 9, 8))::BIGINT % (len(u) + 1) AS b,
        CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || substr(x, 17, 8))::BIGINT % 100 >= 100 THEN 'plain'
            WHEN ('0x' || substr(x, 25, 8))::BIGINT % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (
    SELECT *, array_to_string(u[1:least(a, b)], '') AS p, array_to_string(u[least(a, b) + 1:greatest(a, b)], '') AS m,
        array_to_string(u[greatest(a, b) + 1:], '') AS s FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
    CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
