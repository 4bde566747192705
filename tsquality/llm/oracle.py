"""DuckDB twins of the queries that SQL can express (operators 3, 5, 9, 11, 12 and 13).

The others cannot: tokenizer ids (1, 10), crc32 and the model's state (2, 7), Newton rounds (4), HTML
parsing (6), seeded XXH64 and components (8).
"""

from __future__ import annotations

from tsquality.llm.quality import GRIDS, PATH

_WORDS = r"regexp_extract_all(t, '[^\x20\x09-\x0D]+')"

OP3 = """
SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN most END AS refers_to
FROM (SELECT *, octet_length(encode(coalesce(html, ''))) >= 1000 AND most IS NOT NULL
        AND page_id IS DISTINCT FROM most AS again
      FROM (SELECT page_id, html, max(page_id) OVER (PARTITION BY coalesce(html, '')) AS most FROM pages) a) b
"""

OP5 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v, row_number() OVER () AS r
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
e AS (SELECT r, vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS k FROM v),
s AS (
  SELECT q.r AS q, q.vec_id AS query_id, c.vec_id, c.r, CAST(sum(q.x * c.x) AS BIGINT) AS score
  FROM e q JOIN e c ON q.k = c.k AND q.r <> c.r WHERE q.vec_id % 50 = 0 GROUP BY ALL)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY q ORDER BY score DESC, vec_id) AS rank FROM s) t
WHERE rank <= 5
"""


def op9(max_false: float = 0.02, error: float = 0.05) -> str:
    """The fixed-sequence test: at step k of the path each rule has the last cutoff that the path gave it. Windows are
    joined by number, so that no row carries a text's words beside each of them."""
    at: dict[str, float] = {}
    steps = []
    for rule, cutoff in PATH:
        at[rule] = cutoff
        steps.append("(" + ", ".join([str(len(steps) + 1), *(str(at.get(r, "NULL::DOUBLE")) for r in GRIDS)]) + ")")
    any_rule = " OR ".join(f"coalesce({r} >= c_{r}, FALSE)" for r in GRIDS)
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang AS stratum, coalesce(text, '') AS t FROM documents),
w AS MATERIALIZED (SELECT *, {_WORDS} AS ws, [x FOR x IN string_split(t, chr(10)) IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS ls FROM d),
p AS (SELECT r, unnest(ws) AS a, unnest(range(1, len(ws) + 1)) AS i FROM w),
i AS (SELECT r, i, a, lead(a) OVER s AS b, lead(a, 2) OVER s AS c FROM p WINDOW s AS (PARTITION BY r ORDER BY i)),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM i WHERE c IS NOT NULL) x WHERE n > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM again) x GROUP BY r),
m AS (
  SELECT r, doc_id, stratum, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
    CAST(len(regexp_extract_all(t, '[#*$%&|<>]')) AS BIGINT) AS n_symbols, CAST(len(ls) - len(list_distinct(ls)) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words, len(ls) AS n_lines
  FROM w LEFT JOIN cov USING (r)),
b AS MATERIALIZED (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CASE WHEN n_words > 0 THEN n_symbols / n_words ELSE 0 END AS symbol_rate,
    CASE WHEN n_lines > 0 THEN n_dup_lines / n_lines ELSE 0 END AS dup_line_share,
    CASE WHEN n_words > 0 THEN n_repeat_words / n_words ELSE 0 END AS repeat_share,
    CASE WHEN n_words > 0 THEN word_chars / n_words ELSE 0 END AS word_length
  FROM m),
good AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1),
h AS MATERIALIZED (SELECT b.* FROM b JOIN good USING (doc_id) WHERE NOT base_failed),
path AS (SELECT * FROM (VALUES {", ".join(steps)}) v (step, {", ".join(f"c_{r}" for r in GRIDS)})),
hits AS (SELECT stratum, step, count(*) AS n, CAST(count_if({any_rule}) AS BIGINT) AS k FROM h, path GROUP BY stratum, step),
tails AS (
  SELECT stratum, step, sum(exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({max_false}) + (n - i) * ln(1 - {max_false}))) AS p
  FROM (SELECT *, unnest(generate_series(0, k)) AS i FROM hits) x GROUP BY stratum, step),
strata AS (SELECT count(*) AS n FROM (SELECT DISTINCT stratum FROM h) x),
walked AS (
  SELECT stratum, coalesce(min(step) FILTER (p > {error} / strata.n), {len(steps) + 1}) - 1 AS step FROM tails, strata GROUP BY stratum),
cuts AS (SELECT walked.stratum, path.* FROM walked JOIN path USING (step)),
bad AS (SELECT DISTINCT r FROM b JOIN cuts ON b.stratum IS NOT DISTINCT FROM cuts.stratum WHERE {any_rule})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND r NOT IN (SELECT r FROM bad) AS kept
FROM b
"""


#: Words of operators 11 and 13 in a text that may be null.
_ALNUM = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

OP11 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS ws FROM documents),
w AS MATERIALIZED (SELECT r, unnest(ws) AS w FROM d),
b AS MATERIALIZED (SELECT unnest({_ALNUM}) AS w FROM benchmark),
tab AS (SELECT list_transform(range(256), lambda i: list_reduce(
    list_prepend(i, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab),
h AS (SELECT w, hex(encode(w)) AS h FROM (SELECT w FROM w UNION SELECT w FROM b) x),
v AS MATERIALIZED (
  SELECT w, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i:
      16 * (instr('0123456789ABCDEF', h[2 * i + 1:2 * i + 1]) - 1) + instr('0123456789ABCDEF', h[2 * i + 2:2 * i + 2]) - 1)),
    lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1]))) % 10000 AS bucket
  FROM h, tab),
s AS (SELECT bucket, count(*) AS s FROM w JOIN v USING (w) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM b JOIN v USING (w) GROUP BY bucket),
n AS (SELECT (SELECT coalesce(sum(s), 0) FROM s) AS s, (SELECT coalesce(sum(t), 0) FROM t) AS t),
g AS (
  SELECT bucket, CAST(floor(1000 * ln((coalesce(t.t, 0) + 1)::DOUBLE * (n.s + 10000)::DOUBLE
      / ((coalesce(s.s, 0) + 1)::DOUBLE * (n.t + 10000)::DOUBLE))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT bucket FROM v) a LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket), n),
x AS (SELECT r, sum(gain) AS weight FROM w JOIN v USING (w) JOIN g USING (bucket) GROUP BY r),
k AS (
  SELECT r, doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
    ('0x' || substr(sha256('2024:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8))::BIGINT AS h
  FROM d LEFT JOIN x USING (r)),
m AS (SELECT *, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))) AS BIGINT) AS score FROM k),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, r) AS rank, count(*) OVER () AS total FROM m WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN rank <= 10 * total // 100 THEN rank END AS rank FROM m LEFT JOIN o USING (r)
"""

OP13 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_ALNUM} AS ws FROM documents),
b AS (SELECT item_id, {_ALNUM} AS ws FROM benchmark),
bi AS (SELECT item_id, ws, least(len(ws), 10) AS n, unnest(range(1, len(ws) - least(len(ws), 10) + 2)) AS i FROM b WHERE len(ws) > 0),
bw AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(ws[i:i + n - 1], ' ') AS words FROM bi),
lengths AS (SELECT DISTINCT n FROM bw),
p AS (SELECT r, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d),
f AS (SELECT r, i, list(w) OVER (PARTITION BY r ORDER BY i ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS ws FROM p),
dw AS (SELECT r, i, n, array_to_string(ws[1:n], ' ') AS words FROM f, lengths WHERE len(ws) >= n),
hits AS MATERIALIZED (SELECT r, i, n, item_id FROM dw JOIN bw USING (n, words)),
hit AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM hits) x) y GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT r, item_id, coalesce(CAST(item_id AS VARCHAR), '') AS item FROM hits) x GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""


def op12(rounds: int = 4) -> str:
    """A round: ``a`` has each part's nearest entry (by squared distances, all of them exact in doubles)."""
    def assigned(k: int) -> str:
        return f"""
a{k} AS MATERIALIZED (
  SELECT r, part, CAST(best[2] AS INTEGER) AS e, best[1] AS far FROM (
    SELECT r, part, min([list_dot_product(p.x, p.x) - 2 * list_dot_product(p.x, c{k}.x) + list_dot_product(c{k}.x, c{k}.x), e]) AS best
    FROM p JOIN c{k} USING (part) GROUP BY r, part) b)"""

    def refined(k: int) -> str:
        return f"""
m{k} AS (
  SELECT part, e, list(floor(s / n) ORDER BY j) AS x FROM (
    SELECT part, e, j, sum(y) AS s, count(*) AS n FROM (
      SELECT part, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM p JOIN a{k - 1} USING (r, part)) u
    GROUP BY part, e, j) t GROUP BY part, e),
c{k} AS MATERIALIZED (SELECT part, e, coalesce(m{k}.x, c{k - 1}.x) AS x FROM c{k - 1} LEFT JOIN m{k} USING (part, e))"""
    steps = ",".join([assigned(0), *(x for k in range(1, rounds + 1) for x in (refined(k), assigned(k)))])
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id) AS r, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
p AS MATERIALIZED (SELECT r, part, v[part * (len(v) // 4) + 1:(part + 1) * (len(v) // 4)] AS x FROM v, range(4) t(part)),
c0 AS MATERIALIZED (SELECT part, r - 1 AS e, x FROM p WHERE r <= 256),{steps},
code AS (SELECT r, string_agg(lower(printf('%02x', e)), '' ORDER BY part) AS code, CAST(sum(far) AS BIGINT) AS error FROM a{rounds} GROUP BY r),
books AS (
  SELECT sha256(string_agg(CAST(CAST(y AS BIGINT) AS VARCHAR), ',' ORDER BY part, e, j)) AS codebooks_sha256
  FROM (SELECT part, e, unnest(x) AS y, generate_subscripts(x, 1) AS j FROM c{rounds}) u)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM v JOIN code USING (r), books
"""


SQL = {"op3_chunked_warc": OP3, "op5_voronoi_knn": OP5, "op9_quality_rules": op9(), "op11_importance_resampling": OP11,
       "op12_vector_codes": op12(), "op13_decontamination": OP13}
