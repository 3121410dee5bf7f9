"""DuckDB twins of the numbered queries that SQL can express, as plain computations."""

from __future__ import annotations

SPLIT = r"regexp_split_to_array({}, '[\x20\x09-\x0D]+')"
WORDS = f"list_filter({SPLIT}, lambda x: x <> '')"


def _words(text: str) -> str:
    return WORDS.format(text)


# Sainte-Lague over all quotients; the words taken from the position on the source's tape.
MIX = f"""
WITH d AS (SELECT doc_id, source, CAST(len({_words("coalesce(text, '')")}) AS BIGINT) AS size,
                  md5('17:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS k FROM documents),
s AS (SELECT source, sum(size) AS words, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS i FROM d GROUP BY source),
w AS (SELECT *, CAST(i % 3 + 1 AS DOUBLE) AS weight, CAST(words AS DOUBLE) AS z FROM s),
c AS (SELECT *, 3 * z / weight AS full_at,
             coalesce(sum(3 * z) OVER (ORDER BY 3 * z / weight, i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS gone,
             sum(weight) OVER (ORDER BY 3 * z / weight, i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
             sum(z) OVER () AS total FROM w),
f AS (SELECT *, (total - gone) / open > full_at AS capped FROM c),
g AS (SELECT *, coalesce(sum(3 * z) FILTER (capped) OVER (), 0) AS held, sum(weight) FILTER (NOT capped) OVER () AS rest FROM f),
t AS (SELECT i, source, CAST(words AS BIGINT) AS words, total, CASE WHEN capped THEN 3 * z ELSE (total - held) * weight / rest END AS target,
             CAST((words + 63) // 64 AS BIGINT) AS blocks,
             CAST('0x' || substr(md5('17|' || CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END), 1, 8) AS BIGINT) AS mark FROM g),
house AS (SELECT greatest(CAST(round_even(any_value(total) / 64, 0) AS BIGINT), 1) AS n FROM t),
q AS (SELECT i, target / (2 * k + 1) AS quotient FROM (SELECT i, target, unnest(range(3 * blocks)) AS k FROM t)),
won AS (SELECT i, count(*) AS seats FROM (SELECT i, row_number() OVER (ORDER BY quotient DESC, i) AS r FROM q)
        WHERE r <= (SELECT n FROM house) GROUP BY i),
p AS (SELECT t.*, coalesce(seats, 0) AS seats, CASE WHEN blocks > 0 THEN mark % blocks ELSE 0 END AS start,
             CASE WHEN blocks > 0 THEN coalesce(seats, 0) // blocks ELSE 0 END AS rounds FROM t LEFT JOIN won USING (i)),
a AS (SELECT d.*, coalesce(sum(size) OVER (PARTITION BY source ORDER BY k, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM d),
x AS (SELECT a.doc_id, a.size, p.words, p.target, p.rounds, a.b, a.b + a.size AS e, p.start * 64 AS lo,
             least((p.start + p.seats - p.rounds * p.blocks) * 64, p.words) AS hi,
             greatest(0, p.start + p.seats - p.rounds * p.blocks - p.blocks) * 64 AS wrap,
             p.seats > p.rounds * p.blocks AS part FROM a JOIN p ON p.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, words AS source_size, target,
       CAST(rounds * size + CASE WHEN part THEN greatest(0, least(e, hi) - greatest(b, lo)) + greatest(0, least(e, wrap) - b) ELSE 0 END AS BIGINT) AS taken
FROM x
"""

# All pairs that share a shingle, counted; components by closure.
JACCARD = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, {_words("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS ws FROM documents),
s AS (SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
             ELSE list_distinct([ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] for i in range(1, len(ws) - 1)]) END AS g FROM w),
u AS (SELECT doc_id, unnest(g) AS h FROM s),
n AS (SELECT doc_id, CAST(len(g) AS BIGINT) AS n FROM s),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM u x JOIN u y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM c JOIN n p ON p.doc_id = a JOIN n r ON r.doc_id = b WHERE 100 * shared >= 90 * (p.n + r.n - shared)),
reach AS (SELECT doc_id, doc_id AS root FROM n UNION SELECT e.b, reach.root FROM reach JOIN e ON e.a = reach.doc_id)
SELECT n.doc_id, n.n AS n_shingles, m.component_id
FROM n JOIN (SELECT doc_id, min(root) AS component_id FROM reach GROUP BY doc_id) m USING (doc_id)
"""

_FIVE = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
_BASE32 = " || ".join(
    f"substr('{_FIVE}', 1 + ((CAST('0x' || substr(h, {5 * k + 1}, 5) AS INTEGER) >> {shift}) & 31), 1)"
    for k in range(8) for shift in (15, 10, 5, 0))

WARC = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, strlen(body) AS n, sha1(body) AS h FROM p),
r AS (SELECT *, max(page_id) OVER (PARTITION BY h, n) AS head FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id = head THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> head THEN head END AS refers_to FROM r
"""

TOP = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
      FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""

# Cuts by counting lines in a list; the rebuilt text is the text.
FIM = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h FROM documents),
l AS (SELECT *, string_split(t, chr(10)) AS parts, CAST(CASE WHEN t = '' THEN 0 WHEN right(t, 1) = chr(10) THEN len(string_split(t, chr(10))) - 1
             ELSE len(string_split(t, chr(10))) END AS BIGINT) AS n,
             [CAST('0x' || substr(h, 8 * k + 1, 8) AS BIGINT) FOR k IN [0, 1, 2, 3]] AS r FROM d),
c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
             CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 100 THEN 'plain'
                  WHEN r[4] % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM l),
u AS (SELECT *, [p || chr(10) FOR p IN parts[1:len(parts) - 1]] || CASE WHEN parts[-1] = '' THEN [] ELSE parts[-1:] END AS units FROM c),
p AS (SELECT *, array_to_string(units[1:a], '') AS prefix, array_to_string(units[a + 1:b], '') AS middle,
             array_to_string(units[b + 1:], '') AS suffix FROM u)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256 FROM p"""

_TERMS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

# Scores of every document that shares a term with an item.
SEARCH = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS row, {_TERMS.format("text")} AS terms FROM documents WHERE text IS NOT NULL),
g AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(terms)) AS BIGINT) AS total FROM d WHERE len(terms) > 0),
p AS (SELECT row, any_value(doc_id) AS doc_id, CAST(any_value(n) AS BIGINT) AS n, term, CAST(count(*) AS BIGINT) AS tf
      FROM (SELECT row, doc_id, len(terms) AS n, unnest(terms) AS term FROM d) GROUP BY row, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) AS BIGINT) AS w
      FROM (SELECT term, count(*) AS df FROM p GROUP BY term), g),
i AS (SELECT DISTINCT item_id, text, unnest({_TERMS.format("text")}) AS term FROM benchmark),
s AS (SELECT item_id, text, row, any_value(doc_id) AS doc_id,
             CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score
      FROM i JOIN p USING (term) JOIN w USING (term), g GROUP BY item_id, text, row),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id, text ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10"""
