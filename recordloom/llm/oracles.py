"""SQL oracles of the operators whose whole result SQL can express.

They say what the rows must be, not how to get them at scale: every word, window and pair of
equal word groups is a row.
"""

from __future__ import annotations

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _lower(column: str) -> str:
    return f"translate({column}, '{_UPPER}', '{_UPPER.lower()}')"


def _letter_words(column: str) -> str:
    return rf"coalesce(regexp_extract_all({_lower(column)}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


def _blank_words(column: str) -> str:
    return rf"coalesce(regexp_extract_all({column}, '[^\x20\x09-\x0D]+'), [])"


# Equal words on one diagonal of (document, item) that follow each other are a verbatim match; one
# of at least `need` words is covered by windows that occur.
DECONTAMINATION = f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, {_letter_words("text")} AS w FROM documents),
    items AS (
      SELECT row_number() OVER () AS b, item_id, {_letter_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
    doc_words AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs),
    item_words AS (
      SELECT b, item_id, least(len(w), 10) AS need, unnest(w) AS word, unnest(range(len(w))) AS j FROM items),
    steps AS (
      SELECT r, b, item_id, need, i, i - j AS diagonal,
             i - row_number() OVER (PARTITION BY r, b, i - j ORDER BY i) AS stretch
      FROM doc_words JOIN item_words USING (word)),
    found AS (
      SELECT r, b, item_id, min(i) AS first, count(*) AS length
      FROM steps GROUP BY r, b, item_id, need, diagonal, stretch HAVING count(*) >= need),
    hit AS (
      SELECT r, count(DISTINCT i) AS n_hit
      FROM (SELECT r, unnest(range(first, first + length)) AS i FROM found) GROUP BY r),
    named AS (
      SELECT r, count(*) AS n_items, string_agg(name, ',' ORDER BY name) AS names
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS name FROM found) GROUP BY r),
    best AS (
      SELECT r, first, length, item_id FROM found
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, first, item_id) = 1)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
           sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated,
           coalesce(length, 0)::BIGINT AS longest_match, first::BIGINT AS match_start, item_id AS match_item
    FROM docs LEFT JOIN hit USING (r) LEFT JOIN named USING (r) LEFT JOIN best USING (r)"""

# A window is told by the digest of its 50 words; it goes where it also starts under a smaller id.
SUBSTRING_DEDUP = f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, {_blank_words("text")} AS w FROM documents),
    windows AS (
      SELECT r, doc_id, i, md5(array_to_string(w[i + 1 : i + 50], ' ')) AS m
      FROM (SELECT r, doc_id, w, unnest(range(len(w) - 49)) AS i FROM docs WHERE len(w) >= 50)),
    least_ids AS (SELECT m, min(doc_id) AS least FROM windows GROUP BY m),
    gone AS (
      SELECT DISTINCT r, i + o AS i
      FROM windows JOIN least_ids USING (m), (SELECT unnest(range(50)) AS o) WHERE doc_id > least),
    kept AS (
      SELECT r, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n_kept
      FROM (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i FROM docs) ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n_kept, 0))::BIGINT AS n_removed,
           sha256(coalesce(kept, '')) AS kept_sha256
    FROM docs LEFT JOIN kept USING (r)"""

# The CRC takes 8 steps a byte: the byte enters with the first of them.
_CRC = """xor(list_reduce(
        flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda c: [ascii(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
        lambda a, x: CASE WHEN xor(a, x) & 1 = 1 THEN xor(xor(a, x) >> 1, 3988292384) ELSE xor(a, x) >> 1 END,
        4294967295::BIGINT), 4294967295)"""

# A run of period q holds at least max(6 - q, 3q) >= 5 places i whose word is that of i + q, so equal
# groups of 5 words find all of them. A stretch with several periods counts with its smallest.
PERIODIC_RUNS = f"""
    WITH docs AS (
      SELECT row_number() OVER () AS r, doc_id, {_CRC} AS h, {_blank_words("text")} AS w FROM documents),
    cut AS (
      SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM docs),
    planted AS (
      SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE list_transform(w, lambda x, i:
               CASE WHEN i - 1 < a THEN x ELSE w[a + (i - 1 - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1] END) END AS w
      FROM cut),
    words AS (SELECT r, n, unnest(w) AS word, unnest(range(n)) AS i FROM planted),
    fives AS (
      SELECT r, n, i, md5(array_to_string(w[i + 1 : i + 5], ' ')) AS m
      FROM (SELECT r, n, w, unnest(range(n - 4)) AS i FROM planted WHERE n >= 5)),
    equal AS (
      SELECT x.r, y.i - x.i AS q, x.i, x.i - row_number() OVER (PARTITION BY x.r, y.i - x.i ORDER BY x.i) AS stretch
      FROM fives x JOIN fives y ON x.r = y.r AND x.m = y.m AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
    stretches AS (
      SELECT r, q, min(i) AS start, count(*) + 4 + q AS length FROM equal GROUP BY r, q, stretch),
    runs AS (
      SELECT r, start, length, min(q) AS period FROM stretches
      WHERE length >= greatest(6, 4 * q) GROUP BY r, start, length),
    told AS (
      SELECT r, count(*) AS n_runs, string_agg(concat(start, ',', length, ',', period, chr(10)), '' ORDER BY start, period) AS runs
      FROM runs GROUP BY r),
    best AS (
      SELECT r, start, length, period FROM runs
      QUALIFY row_number() OVER (PARTITION BY r ORDER BY length DESC, start, period) = 1),
    gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
    kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (r, i) GROUP BY r)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
           period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
           sha256(coalesce(runs, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
    FROM planted LEFT JOIN told USING (r) LEFT JOIN best USING (r) LEFT JOIN kept USING (r)"""
