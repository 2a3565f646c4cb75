"""DuckDB SQL with the results of the queries of this package that SQL can express.

The others have none: fitted models, alignments, packings, rolling hashes and 64-bit key hashes are held
against brute force, round trips or held-out rows in the tests.
"""

CAPITALS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

URLS = f"""
WITH parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), {CAPITALS}) AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
rules AS (
  SELECT * FROM (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                        ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')) r(h, p, v)),
fits AS (
  SELECT page_id, max_by(h || p, length(h || p)) AS rule, max_by(v, length(h || p)) AS verdict
  FROM parts, rules
  WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY page_id)
SELECT a.page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict
FROM parts a LEFT JOIN fits f ON a.page_id = f.page_id"""

NEAR_DUPLICATES = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {CAPITALS}), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
  FROM words),
grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM sets s JOIN reach r ON s.doc_id = r.x GROUP BY s.doc_id, s.s"""

ARCHIVE = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
coded AS (
  SELECT page_id, octet_length(encode(body)) AS payload_bytes, body,
         min(page_id) OVER (PARTITION BY body) AS first,
         CAST(CAST(unhex(sha1(body)) AS BIT) AS VARCHAR) AS bits
  FROM payloads)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST(list_sum(list_transform(range(0, 5), lambda j:
           CAST(substr(bits, CAST(5 * i + j + 1 AS BIGINT), 1) AS INTEGER) * (16 >> CAST(j AS INTEGER)))) AS BIGINT), 1)), '')
         AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM coded"""

PHRASES = rf"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), {CAPITALS}), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM words GROUP BY lang),
grams AS (
  SELECT lang, k, unnest(list_transform(range(0, len(w) - k + 1), lambda i: array_to_string(w[i + 1:i + k], ' '))) AS phrase
  FROM words, (VALUES (1), (2), (3)) s(k) WHERE len(w) >= k),
counts AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY lang, k, phrase HAVING count(*) >= 10),
cuts AS (
  SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, k)) AS cut FROM counts WHERE k > 1),
scores AS (
  SELECT c.lang, c.k, c.phrase, c.a, x.f AS l, y.f AS r, cut,
         CAST((1000000 * CAST(a AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = array_to_string(w[1:cut], ' ')
  JOIN counts y ON y.lang = c.lang AND y.phrase = array_to_string(w[cut + 1:c.k], ' ')),
lowest AS (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
around AS (
  SELECT lang, array_to_string(w[i:i + 1], ' ') AS phrase, max(a) AS f
  FROM (SELECT lang, a, w, unnest([1, 2]) AS i FROM cuts WHERE k = 3 AND cut = 1) GROUP BY ALL),
ranked AS (
  SELECT s.*, row_number() OVER (PARTITION BY s.lang ORDER BY score DESC, a DESC, s.phrase) AS rank
  FROM lowest s LEFT JOIN around o ON s.lang = o.lang AND s.phrase = o.phrase
  WHERE o.f IS NULL OR 100 * o.f < 50 * s.a)
SELECT r.lang, rank, phrase, a, l, r, n, score FROM ranked r JOIN totals t ON r.lang = t.lang WHERE rank <= 2000"""

#: crc32 of the key in decimals, bit by bit.
KEY_CRC32 = """xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], [0, 0, 0, 0, 0, 0, 0, 0]),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)), 4294967295)"""

# A run of length n and period q is a stretch of n - q words, six or more, that are equal to the words q on.
RUNS = rf"""
WITH given AS (
  SELECT doc_id, {KEY_CRC32} AS h, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
placed AS (
  SELECT doc_id, w, h, len(w) AS n, CASE WHEN len(w) > 0 THEN (h // 10) % len(w) ELSE 0 END AS a, h // 10 AS g
  FROM given),
planted AS (
  SELECT doc_id, n, CASE WHEN h % 10 = 0 AND n > 0
    THEN list_transform(range(0, n), lambda i: w[CASE WHEN i >= a THEN a + (i - a) % (1 + (n - a) // (3 + g % 8)) ELSE i END + 1])
    ELSE w END AS w
  FROM placed),
grams AS (
  SELECT doc_id, unnest(range(0, n - 5)) AS i, unnest(list_transform(range(0, n - 5), lambda i: array_to_string(w[i + 1:i + 6], ' '))) AS g
  FROM planted WHERE n >= 12),
equal AS (
  SELECT a.doc_id, b.i - a.i AS q, a.i, a.i - row_number() OVER (PARTITION BY a.doc_id, b.i - a.i ORDER BY a.i) AS island
  FROM grams a JOIN grams b ON a.doc_id = b.doc_id AND a.g = b.g AND a.i < b.i),
stretches AS (SELECT doc_id, q, min(i) AS s, count(*) + 5 AS m FROM equal GROUP BY doc_id, q, island),
runs AS (
  SELECT doc_id, s, m + q AS n, min(q) AS q FROM stretches WHERE m >= q AND m + q >= 12 GROUP BY doc_id, s, m + q),
told AS (
  SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || n || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
         first(s ORDER BY n DESC, s, q) AS s, max(n) AS n, first(q ORDER BY n DESC, s, q) AS q
  FROM runs GROUP BY doc_id),
words AS (SELECT doc_id, unnest(range(0, n)) AS i, unnest(w) AS word FROM planted WHERE doc_id IN (SELECT doc_id FROM told)),
dropped AS (SELECT DISTINCT r.doc_id, unnest(range(s + q, s + r.n)) AS i FROM runs r),
collapsed AS (
  SELECT w.doc_id, string_agg(word, ' ' ORDER BY i) AS words
  FROM words w ANTI JOIN dropped d ON w.doc_id = d.doc_id AND w.i = d.i GROUP BY w.doc_id)
SELECT p.doc_id, coalesce(n_runs, 0) AS n_runs, CAST(t.s AS BIGINT) AS start, CAST(t.n AS BIGINT) AS length,
       CAST(t.q AS BIGINT) AS period, CAST(1000 * t.n // t.q AS BIGINT) AS exponent_milli,
       sha256(coalesce(listed, '')) AS runs_sha256,
       sha256(CASE WHEN t.doc_id IS NULL THEN array_to_string(p.w, ' ') ELSE coalesce(c.words, '') END) AS collapsed_sha256
FROM planted p LEFT JOIN told t ON p.doc_id = t.doc_id LEFT JOIN collapsed c ON p.doc_id = c.doc_id"""

ORACLES: dict[str, str] = {
    "op1_url_filters": URLS, "op5_ngram_jaccard_join": NEAR_DUPLICATES, "op10_warc": ARCHIVE,
    "op11_phrase_collocations": PHRASES, "op13_periodic_runs": RUNS,
}
