"""Registered queries: text preparation over whole document texts."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import clean_text, tokenize_alpha, tokenize_ws
from ..operators import textprep as t
from .registry import query, spread_table, sql_alpha, sql_tokens, table

MIN_FREQ = 2
_STATS = f"""
SELECT term, count(*) AS n, min(doc_id * 2147483648 + pos) AS f FROM {sql_tokens()} GROUP BY term"""
_IDS = f"""
SELECT term, row_number() OVER (ORDER BY n DESC, f) + 1 AS id, n FROM ({_STATS}) WHERE n >= {MIN_FREQ}"""


def _docs(spark, sf_dir):
    return spread_table(spark, sf_dir, "documents").select("doc_id", "text")


def _tokens(spark, sf_dir):
    return t.token_rows(_docs(spark, sf_dir), "doc_id", tokenize_alpha(F.col("text")))


def _vocab(spark, sf_dir):
    stats = t.term_stats(_docs(spark, sf_dir), "doc_id", tokenize_alpha(F.col("text")))
    return t.assign_ids(t.build_vocab(stats, MIN_FREQ))


@query(
    "clean_text",
    r"""
    SELECT doc_id, trim(regexp_replace(regexp_replace(text, '[^a-zA-Z0-9\s\x0b\x1c-\x1f\x{85}\p{Z}]', '', 'g'), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+', ' ', 'g')) AS clean
    FROM documents""",
)
def clean(spark, sf_dir):
    return _docs(spark, sf_dir).select("doc_id", clean_text(F.col("text")).alias("clean"))


@query(
    "tokenize_ws",
    r"""
    SELECT doc_id, len(l) AS n, array_to_string(l, ' ') AS tokens
    FROM (SELECT doc_id, list_filter(string_split_regex(lower(text), '[\s\x0b\x1c-\x1f\x{85}\p{Z}]+'), lambda t: t <> '') AS l FROM documents)""",
)
def ws(spark, sf_dir):
    tokens = tokenize_ws(F.col("text"))
    return _docs(spark, sf_dir).select(
        "doc_id", F.size(tokens).cast("long").alias("n"), F.array_join(tokens, " ").alias("tokens")
    )


@query(
    "tokenize_alpha",
    f"""
    SELECT doc_id, len(l) AS n, array_to_string(l, ' ') AS tokens
    FROM (SELECT doc_id, {sql_alpha('text')} AS l FROM documents)""",
)
def alpha(spark, sf_dir):
    tokens = tokenize_alpha(F.col("text"))
    return _docs(spark, sf_dir).select(
        "doc_id", F.size(tokens).cast("long").alias("n"), F.array_join(tokens, " ").alias("tokens")
    )


@query("term_counts", f"SELECT term, n FROM ({_STATS})")
def term_counts(spark, sf_dir):
    return t.term_counts(_tokens(spark, sf_dir))


@query("vocab_min_freq", f"SELECT term, n FROM ({_STATS}) WHERE n >= 5")
def vocab_min_freq(spark, sf_dir):
    return t.build_vocab(t.term_counts(_tokens(spark, sf_dir)), 5)


@query(
    "vocab_ids",
    f"SELECT term, id, n FROM ({_IDS}) UNION ALL SELECT '<UNK>', 0, 0 UNION ALL SELECT '<PAD>', 1, 0",
)
def vocab_ids(spark, sf_dir):
    return _vocab(spark, sf_dir)


@query(
    "encode_corpus",
    f"""
    SELECT doc_id, pos::BIGINT AS pos, coalesce(id, 0) AS token_id
    FROM {sql_tokens()} LEFT JOIN ({_IDS}) USING (term)""",
)
def encode_corpus(spark, sf_dir):
    encoded = t.encode(_tokens(spark, sf_dir), _vocab(spark, sf_dir))
    return encoded.withColumn("pos", F.col("pos").cast("long"))


@query(
    "corpus_metadata",
    f"""
    SELECT (SELECT count(*) FROM documents) AS source_documents, (SELECT count(*) FROM ({_IDS})) + 2 AS vocab_size,
      (SELECT count(*) FROM {sql_tokens()}) AS total_tokens, {MIN_FREQ}::BIGINT AS min_freq""",
)
def metadata(spark, sf_dir):
    docs = _docs(spark, sf_dir)
    meta = t.corpus_metadata(docs, tokenize_alpha(F.col("text")), _vocab(spark, sf_dir), MIN_FREQ)
    return meta.drop("created_utc")


_L = 8


@query(
    "sequence_windows",
    f"""
    SELECT doc_id, i AS start, array_to_string(l[i + 1:i + {_L}], ' ') AS x,
      array_to_string(l[i + 2:i + {_L + 1}], ' ') AS y
    FROM (SELECT doc_id, l, unnest(generate_series(0, len(l) - {_L + 1})) AS i
          FROM (SELECT doc_id, {sql_alpha('text')} AS l FROM documents) WHERE len(l) > {_L})""",
)
def sequence_windows(spark, sf_dir):
    rows = t.sequence_windows(_docs(spark, sf_dir), tokenize_alpha(F.col("text")), _L)
    return rows.select(
        "doc_id",
        F.col("start").cast("long").alias("start"),
        F.array_join("x", " ").alias("x"),
        F.array_join("y", " ").alias("y"),
    )


@query(
    "corpus_windows",
    f"""
    WITH tok AS (SELECT term, row_number() OVER (ORDER BY doc_id, pos) - 1 AS i FROM {sql_tokens()}),
    far AS (SELECT i AS start, term AS x_first, lead(term, {_L - 1}) OVER (ORDER BY i) AS x_last,
              lead(term, 1) OVER (ORDER BY i) AS y_first, lead(term, {_L}) OVER (ORDER BY i) AS y_last FROM tok)
    SELECT * FROM far WHERE y_last IS NOT NULL""",
)
def corpus_windows(spark, sf_dir):
    rows = t.corpus_windows(_docs(spark, sf_dir), "doc_id", tokenize_alpha(F.col("text")), _L)
    first, last = F.lit(1), F.lit(-1)
    return rows.select(
        "start",
        F.element_at("x", first).alias("x_first"),
        F.element_at("x", last).alias("x_last"),
        F.element_at("y", first).alias("y_first"),
        F.element_at("y", last).alias("y_last"),
    )


@query(
    "normalize_strings",
    """
    SELECT c_custkey, lower(trim(c)) AS clean, starts_with(lower(trim(c)), 'mach') AS has_prefix,
      'segment=' || lower(trim(c)) || '!' AS message
    FROM (SELECT c_custkey, '  ' || c_mktsegment || ' ' AS c FROM customer)""",
)
def normalize_strings(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey", F.concat(F.lit("  "), "c_mktsegment", F.lit(" ")).alias("c")
    )
    return t.normalize_strings(rows, "c", "mach", "segment=%s!").drop("c")


# Fixed value: the form of an e-mail address that the search for personal data takes, for a whole word.
_EMAIL = r"^[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+$"


@query(
    "regex_match_count",
    rf"""
    SELECT word, count(*) AS n
    FROM (SELECT unnest(string_split_regex(text, '\s+')) AS word FROM documents)
    WHERE regexp_matches(word, '{_EMAIL}') GROUP BY word""",
)
def regex_match_count(spark, sf_dir):
    words = _docs(spark, sf_dir).select(F.explode(F.split("text", r"\s+")).alias("word"))
    return t.regex_matches(words, "word", _EMAIL).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


@query("upper_column", "SELECT * REPLACE (upper(c_name) AS c_name) FROM customer")
def upper_column(spark, sf_dir):
    return t.upper_column(table(spark, sf_dir, "customer"), "c_name")


@query(
    "level_filter",
    """
    SELECT event_id, CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' END AS level
    FROM events WHERE event_type IN ('error', 'purchase')""",
)
def level_filter(spark, sf_dir):
    kind = F.col("event_type")
    level = F.when(kind == "error", "ERROR").when(kind == "purchase", "WARNING").when(kind == "view", "DEBUG")
    rows = table(spark, sf_dir, "events").select("event_id", level.otherwise("INFO").alias("level"))
    return t.level_filter(rows, "level", "WARNING")
