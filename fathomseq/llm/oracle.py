"""SQL for DuckDB that gives the rows of those queries that SQL can express."""

from __future__ import annotations

_RULES = "('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'allow'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')"
_NAMES = "('adult-x'), ('ads-track'), ('casino-win'), ('cheap-pills'), ('free-bets'), ('spam-farm')"
_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

URL_FILTER = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), urls AS (
  SELECT page_id, translate(coalesce(regexp_extract(rest, '^([^/?#]*)', 1), ''), {_LOWER}) AS host, coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path FROM cut
), rules(of_host, of_path, says) AS (VALUES {_RULES}
), names(name) AS (VALUES {_NAMES}
), listed AS (
  SELECT name || '.example.' || top AS of_host FROM names, (VALUES ('com'), ('net'), ('org')) tops(top)
), fits AS (
  SELECT page_id, of_host || of_path AS rule, says,
    row_number() OVER (PARTITION BY page_id ORDER BY length(of_host || of_path) DESC, length(of_host) DESC, says DESC) AS place
  FROM urls JOIN rules ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path)
), bad AS (
  SELECT DISTINCT page_id FROM urls JOIN listed ON host = of_host OR ends_with(host, '.' || of_host)
)
SELECT u.page_id, host, path, rule, coalesce(says, CASE WHEN b.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict, b.page_id IS NOT NULL AS host_listed
FROM urls u LEFT JOIN fits f ON u.page_id = f.page_id AND place = 1 LEFT JOIN bad b ON u.page_id = b.page_id
"""

WARC_FIXITY = """
WITH sizes AS (
  SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html, coalesce(page_id::VARCHAR, '') AS id,
    greatest(1, (SELECT count(*) FROM pages) // 1000) AS files
  FROM pages
), records AS (
  SELECT page_id, url, ('0x' || substr(md5(id), 1, 8))::BIGINT % files AS file,
    strlen('WARC/1.1..WARC-Type: response..WARC-Target-URI: ' || url || '..WARC-Record-ID: <urn:md5:' || md5(id || '|' || url)
      || '>..Content-Type: text/html..Content-Length: ' || strlen(html)::VARCHAR || '....' || html || '....') AS bytes,
    substr(md5('replica|' || page_id), 1, 2) AS fate
  FROM sizes
), placed AS (
  SELECT *, coalesce(sum(bytes) OVER (PARTITION BY file ORDER BY page_id, url ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS "offset" FROM records
)
SELECT file::BIGINT AS file, "offset", bytes::BIGINT AS bytes, page_id, url, CASE WHEN fate < '04' THEN 'changed' ELSE 'missing' END AS damage
FROM placed WHERE fate < '08'
"""

NGRAM_JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, {_WORDS.format(f"translate(coalesce(text, ''), {_LOWER})")} AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sized AS (
  SELECT doc_id, len(s)::BIGINT AS n_shingles, s FROM sets
), classes AS (
  SELECT min(doc_id) AS class, any_value(n_shingles) AS n, any_value(s) AS s FROM sized WHERE n_shingles > 0 GROUP BY list_sort(s)
), named AS (
  SELECT doc_id, n_shingles, CASE WHEN n_shingles > 0 THEN min(doc_id) OVER (PARTITION BY list_sort(s)) ELSE doc_id END AS class FROM sized
), flat AS (
  SELECT class, n, unnest(s) AS g FROM classes
), shared AS (
  SELECT a.class AS x, b.class AS y, any_value(a.n) + any_value(b.n) AS both_n, count(*) AS same FROM flat a JOIN flat b ON a.g = b.g AND a.class < b.class GROUP BY 1, 2
), links AS (
  SELECT x, y FROM shared WHERE 100 * same >= 90 * (both_n - same)
), ends AS (
  SELECT x, y FROM links UNION SELECT y, x FROM links
), reach AS (
  SELECT class AS a, class AS b FROM classes UNION SELECT a, y FROM reach JOIN ends ON b = x
), components AS (
  SELECT a AS class, min(b) AS component_id FROM reach GROUP BY a
)
SELECT doc_id, n_shingles, coalesce(component_id, doc_id) AS component_id FROM named LEFT JOIN components USING (class)
"""

TOP_PRODUCTS = """
WITH clean AS (
  SELECT vec_id, list_transform(embedding, lambda x: CASE WHEN isfinite(x) THEN floor(256 * x::DOUBLE)::BIGINT END) AS v FROM embeddings WHERE vec_id IS NOT NULL
), rows AS (
  SELECT vec_id, v FROM clean WHERE v IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL)) = 0
), scored AS (
  SELECT q.vec_id AS query_id, r.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * r.v[i]))::BIGINT AS score
  FROM rows q JOIN rows r ON q.vec_id % 50 = 0 AND q.vec_id <> r.vec_id AND len(q.v) = len(r.v)
), ranked AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({_WORDS.format("coalesce(text, '')")})::BIGINT AS size, md5('1|' || coalesce(doc_id::VARCHAR, 'null')) AS key FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source
), filled AS (
  SELECT *, 3 * source_size AS cap, (SELECT sum(source_size) FROM sources)::HUGEINT
      - coalesce(sum(3 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_over,
    sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM sources WINDOW w AS (ORDER BY (3 * source_size)::DOUBLE / weight, source NULLS LAST)
), first_free AS (
  SELECT left_over AS free, open AS shares FROM filled WHERE cap * open > left_over * weight ORDER BY cap::DOUBLE / weight, source NULLS LAST LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN cap * open <= left_over * weight THEN cap::DOUBLE ELSE free::DOUBLE * weight::DOUBLE / shares::DOUBLE END AS target
  FROM filled LEFT JOIN first_free ON true
), parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM targets
), placed AS (
  SELECT d.doc_id, d.size, p.source_size, p.target, p.whole,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.key, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target, (size * (whole + CASE WHEN before + size / 2 <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT AS taken FROM placed
"""

SQL: dict[str, str] = {
    "op2_url_filter": URL_FILTER,
    "op3_warc_fixity": WARC_FIXITY,
    "op4_ngram_jaccard": NGRAM_JACCARD,
    "op6_bitsliced_topk": TOP_PRODUCTS,
    "op9_mixing": MIXING,
}
