"""DuckDB SQL for the queries that SQL can express (on the same Parquet tables)."""

MIXING = r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), sums AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), ranked AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rank FROM sums
), weighed AS (
  SELECT *, CASE (rank - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM ranked
), lines AS (
  SELECT *, source_size / w::DOUBLE AS ratio FROM weighed
), levels AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER before, 0))::DOUBLE
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0))::DOUBLE AS level
  FROM lines
  WINDOW before AS (ORDER BY ratio, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), final AS (
  SELECT level FROM levels WHERE w * level <= 3 * source_size ORDER BY ratio, rank LIMIT 1
), targets AS (
  SELECT source, source_size,
    CASE WHEN w * l.level > 3 * source_size THEN (3 * source_size)::DOUBLE ELSE w * f.level END AS target
  FROM levels l, final f
), drawn AS (
  SELECT s.*, t.source_size, t.target,
    CASE WHEN t.source_size > 0 THEN least(t.target / t.source_size, 3.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE / 4503599627370496::DOUBLE AS u
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  ((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM drawn
"""

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SUFFIX_DECONTAMINATION = rf"""
WITH d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT item_id, least(13, len(w)) AS n, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS k FROM b WHERE len(w) > 0
), wins AS (
  SELECT DISTINCT item_id, n, array_to_string(w[k : k + n - 1], ' ') AS g FROM bw
), dw AS (
  SELECT doc_id, n, w, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM wins) WHERE len(w) >= n
), found AS (
  SELECT doc_id, k, dw.n, item_id
  FROM (SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS g FROM dw) dw JOIN wins ON dw.n = wins.n AND dw.g = wins.g
), hits AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit
  FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM (SELECT DISTINCT doc_id, k, n FROM found)) GROUP BY doc_id
), items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS i FROM found) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""

SUBSTRING_DEDUP = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, k, array_to_string(w[k : k + 49], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS k FROM d WHERE len(w) >= 50)
), firsts AS (
  SELECT g, min(doc_id) AS first FROM windows GROUP BY g HAVING count(*) > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(k, k + 50)) AS p FROM windows JOIN firsts USING (g) WHERE first < doc_id
), words AS (
  SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM d
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def license_scan(templates) -> str:
    """Exact containment of every template in every window, without signatures."""
    values = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(templates))
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    return rf"""
WITH t AS (
  SELECT n, name, regexp_extract_all(lower(text), '{pattern}') AS w FROM (VALUES {values}) v(n, name, text)
), ts AS (
  SELECT DISTINCT n, name, array_to_string(w[k : k + 4], ' ') AS s FROM (SELECT n, name, w, unnest(range(1, len(w) - 3)) AS k FROM t)
), sizes AS (
  SELECT n, count(*) AS total, (2 ** ceil(log2(count(*))))::BIGINT AS l FROM ts GROUP BY n
), d AS (
  SELECT doc_id, regexp_extract_all(lower(coalesce(text, '')), '{pattern}') AS w FROM documents
), ds AS (
  SELECT doc_id, k - 1 AS i, array_to_string(w[k : k + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS k FROM d)
), hits AS (
  SELECT doc_id, n, name, total, l, s, unnest([i // l, i // l - 1]) AS k FROM ds JOIN ts USING (s) JOIN sizes USING (n)
), shares AS (
  SELECT doc_id, n, name, l, k, count(DISTINCT s) / total::DOUBLE AS c FROM hits WHERE k >= 0 GROUP BY doc_id, n, name, l, k, total
), best AS (
  SELECT * FROM shares WHERE c >= 0.8 QUALIFY c = max(c) OVER (PARTITION BY doc_id, l, k)
), named AS (
  SELECT doc_id, count(DISTINCT name) AS n_licenses, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses, count(DISTINCT n) AS n_templates
  FROM best GROUP BY doc_id
)
SELECT doc_id, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(licenses, '') AS licenses, coalesce(n_templates, 0)::BIGINT AS n_templates
FROM d LEFT JOIN named USING (doc_id)
"""

_WHOLE = """embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0"""
_SCALED = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"


def _codes(book: str) -> str:
    """Nearest entry of every part: 64 * distance + entry, the smallest."""
    return f"""
  SELECT rid, p.part, any_value(p.v) AS v,
    min(64 * list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - b.v[i]) * (p.v[i] - b.v[i])))::BIGINT + b.entry) AS best
  FROM parts p JOIN {book} b ON p.part = b.part GROUP BY rid, p.part"""


def _means(codes: str, book: str) -> str:
    """Entries of ``book`` replaced by the floor of their parts' componentwise mean."""
    return f"""
  SELECT part, entry, list(coalesce(m, old) ORDER BY i) AS v
  FROM (SELECT part, entry, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS old FROM {book})
  LEFT JOIN (
    SELECT part, entry, i, (s - ((s % n) + n) % n) // n AS m
    FROM (SELECT part, best % 64 AS entry, i, sum(x)::BIGINT AS s, count(*) AS n
          FROM (SELECT part, best, unnest(range(1, len(v) + 1)) AS i, unnest(v) AS x FROM {codes}) GROUP BY ALL)
  ) USING (part, entry, i) GROUP BY part, entry"""


VECTOR_CODES = f"""
WITH kept AS (
  SELECT vec_id, label, {_SCALED} AS v, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid
  FROM embeddings WHERE {_WHOLE}
), parts AS (
  SELECT rid, part, list_slice(v, part * (len(v) // 16) + 1, (part + 1) * (len(v) // 16)) AS v
  FROM kept, (SELECT unnest(range(16)) AS part)
), book0 AS (
  SELECT part, rid - 1 AS entry, v FROM parts WHERE rid <= 64
), codes0 AS MATERIALIZED ({_codes("book0")}
), book1 AS MATERIALIZED ({_means("codes0", "book0")}
), codes1 AS MATERIALIZED ({_codes("book1")}
), book2 AS MATERIALIZED ({_means("codes1", "book1")}
), codes2 AS MATERIALIZED ({_codes("book2")}
), coded AS (
  SELECT rid, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, sum(best // 64)::BIGINT AS error
  FROM codes2 GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM book2) AS codebooks_sha256
FROM kept JOIN coded USING (rid)
"""

HARD_NEGATIVES = f"""
WITH vectors AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_SCALED} AS v
  FROM embeddings WHERE label IS NOT NULL AND {_WHOLE}
), scored AS MATERIALIZED (
  SELECT a.rid AS anchor, a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same,
    list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * o.v[i]))::BIGINT AS score
  FROM vectors a JOIN vectors o ON a.rid <> o.rid WHERE a.vec_id % 50 = 0
), positives AS (
  SELECT anchor, anchor_id, other_id AS positive_id, score AS positive_score, place
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, other_id NULLS LAST) AS place FROM scored WHERE same)
  WHERE place <= 5
), ranked AS (
  SELECT p.*, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.place ORDER BY s.score DESC, s.other_id NULLS LAST) AS rank
  FROM positives p JOIN scored s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
