"""SQL for DuckDB that gives the rows of the queries SQL can express, over whole tables and by plain definitions."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

# Every window of 13 words, the first document that has it, and the words that later documents lose.
ORACLE["op5_substring_dedup"] = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
p AS (SELECT doc_id, unnest(range(1, len(ws) - 11)) AS i, ws FROM w WHERE len(ws) >= 13),
g AS (SELECT doc_id, i, array_to_string(ws[i:i + 12], ' ') AS window_ FROM p),
f AS (SELECT window_, min(doc_id) AS first_doc FROM g GROUP BY window_),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM g JOIN f USING (window_) WHERE first_doc < doc_id),
gl AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
k AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
             CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, j: NOT list_contains(gone, j)) END AS kept
      FROM w LEFT JOIN gl USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k"""

# Every window of 200 bytes, as 400 hexadecimal digits; those that stand twice, merged into maximal spans.
ORACLE["op8_suffix_array_dedup"] = r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
p AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 199)) AS i, h FROM d WHERE length(h) >= 400),
g AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS window_ FROM p),
f AS (SELECT window_ FROM g GROUP BY window_ HAVING count(*) > 1),
s AS (SELECT doc_id, i, CASE WHEN i - 200 <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) THEN 0 ELSE 1 END AS new_
      FROM g JOIN f USING (window_)),
r AS (SELECT doc_id, i, sum(new_) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s),
spans AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS z FROM r GROUP BY doc_id, run),
cuts AS (SELECT doc_id, a, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
kept AS (SELECT c.doc_id, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head,
                max(z) AS z, count(*) AS n_spans, sum(z - a)::BIGINT AS n_removed FROM cuts c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT doc_id, length(h) // 2 AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(head || substr(h, 2 * z + 1), h))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)"""

# Every shingle of four words, all pairs that share one, and what links reach.
ORACLE["op10_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS ws FROM documents),
g AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + 3], ' ') AS shingle
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 2, 2))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM g a JOIN g b USING (shingle) WHERE a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM pairs JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, other) AS (SELECT a, b FROM edges UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, least(w.doc_id, coalesce(min(other), w.doc_id)) AS component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN reach USING (doc_id) GROUP BY w.doc_id, n.n"""

# Sources by their cap a unit of weight (in tenths): a prefix of them is clamped. Then the least hashes that fit.
ORACLE["op13_mixing"] = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5('0:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS hash FROM documents),
s AS (SELECT source, sum(size)::HUGEINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight FROM s),
r AS (SELECT *, 2 * source_size * (10 // weight) AS height, sum(source_size) OVER () AS total FROM w),
l AS (
  SELECT *, 150 * total - 100 * coalesce(sum(2 * source_size) OVER (ORDER BY height RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS words,
         100 * sum(weight) OVER (ORDER BY height RANGE BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS unit FROM r),
c AS (SELECT *, weight * words >= 2 * source_size * unit AS clamped FROM l),
o AS (SELECT any_value(words) AS words, any_value(unit) AS unit FROM (
  SELECT words, unit FROM c WHERE NOT clamped ORDER BY height LIMIT 1)),
t AS (
  SELECT source, source_size, CASE WHEN clamped THEN (2 * source_size)::DOUBLE ELSE (weight * o.words)::DOUBLE / o.unit::DOUBLE END AS target,
         CASE WHEN clamped THEN 2 * source_size ELSE (weight * o.words) // o.unit END AS wanted FROM c, o),
e AS (SELECT *, CASE WHEN source_size > 0 THEN wanted // source_size ELSE 0 END AS whole FROM t),
h AS (SELECT source, hash, sum(size) AS words FROM d GROUP BY source, hash),
k AS (SELECT *, sum(words) OVER (PARTITION BY source ORDER BY hash ROWS UNBOUNDED PRECEDING) AS after FROM h)
SELECT d.doc_id, d.size, e.source_size::BIGINT AS source_size, e.target,
       (whole * size + CASE WHEN k.after <= wanted - whole * e.source_size THEN size
                            WHEN k.after - k.words >= wanted - whole * e.source_size THEN 0
                            ELSE (wanted - whole * e.source_size - (k.after - k.words)) * size // k.words END)::BIGINT AS taken
FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source JOIN k ON d.source IS NOT DISTINCT FROM k.source AND d.hash = k.hash"""

# All phrases by lists of words; every cut; every longer phrase around a candidate.
ORACLE["op12_collocations"] = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::HUGEINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
g AS (SELECT lang, ws, i, unnest(range(1, least(5, len(ws) - i + 1) + 1)) AS m FROM s),
f AS (SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS phrase, m, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS ws, unnest(range(1, m)) AS k FROM f WHERE m >= 2),
q AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, t.n,
         1000::HUGEINT * c.a * t.n // (l.f::HUGEINT * r.f) AS score
  FROM c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(ws[1:k], ' ')
         JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(ws[k + 1:], ' ') JOIN t ON t.lang = c.lang),
b AS (SELECT * FROM q QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
x AS (
  SELECT DISTINCT s.lang, s.phrase FROM (
    SELECT lang, f, unnest(list_transform(range(1, m), lambda i: ws[i:i + n - 1])) AS part FROM (
      SELECT lang, f, m, string_split(phrase, ' ') AS ws, unnest(range(2, m)) AS n FROM f WHERE m > 2)) o
  JOIN f s ON s.lang = o.lang AND s.phrase = array_to_string(o.part, ' ') AND 100 * o.f >= 100 * s.f AND s.m >= 2),
k AS (SELECT * FROM b WHERE NOT EXISTS (FROM x WHERE x.lang = b.lang AND x.phrase = b.phrase)),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM k)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM o WHERE rank <= 2000"""


def _codebook_rounds(rounds: int = 4) -> str:
    """Squared distances as |x|^2 - 2xy + |y|^2, exact in doubles; the entry's place in the last 8 bits breaks ties."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
a{i} AS MATERIALIZED (
  SELECT vec_id, label, v.part, min((list_inner_product(x, x) - 2 * list_inner_product(x, y) + list_inner_product(y, y))::BIGINT * 256
                             + entry) AS best FROM v JOIN b{i} b ON v.part = b.part GROUP BY ALL)""")
        if i < rounds:
            steps.append(f"""
b{i + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.y, b.y) AS y FROM b{i} b LEFT JOIN (
    SELECT part, entry, list(mean ORDER BY j) AS y FROM (
      SELECT part, entry, j, floor(sum(x[j]) / count(*)) AS mean FROM (
        SELECT v.part, best % 256 AS entry, x, unnest(range(1, len(x) + 1)) AS j FROM v JOIN a{i} a ON v.vec_id = a.vec_id AND v.part = a.part)
      GROUP BY ALL) GROUP BY ALL) m ON b.part = m.part AND b.entry = m.entry)""")
    return ",".join(steps)


# Vectors as integers in doubles, cut into parts; rounds as above; codes as hexadecimal digits.
ORACLE["op11_codebooks"] = f"""
WITH d AS (
  SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
v AS MATERIALIZED (
  SELECT vec_id, label, part, x[part * len(x) // 4 + 1:(part + 1) * len(x) // 4] AS x
  FROM d, (SELECT unnest(range(4)) AS part)),
f AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM d ORDER BY vec_id LIMIT 256),
b0 AS MATERIALIZED (SELECT part, entry, x AS y FROM v JOIN f USING (vec_id)),{_codebook_rounds()},
r AS (
  SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code,
         sum(best // 256)::BIGINT AS error FROM a4 GROUP BY vec_id),
s AS (SELECT sha256(string_agg(array_to_string(list_transform(y, lambda c: c::BIGINT), ','), ',' ORDER BY part, entry)) AS h FROM b4)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, h AS codebooks_sha256 FROM r, s"""
