"""Registered queries: sources and sinks, as round trips over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import tokenize_alpha
from ..operators.evaluate import classification_report
from ..operators.generate import turns_to_records
from ..operators.textprep import (
    assign_ids,
    build_vocab,
    corpus_metadata,
    encode,
    term_stats,
    token_rows,
)
from ..scale import scratch_path
from ..sources import files
from ..sources.catalog import parse_catalog
from .derived import YAML_PATH_SQL, YAML_STATUS_SQL, part_yaml
from .q_evaluation import LABEL_SQL, REPORT_SQL, labelled
from .registry import query, spread_table, sql_tokens, table


@query(
    "scan_catalog",
    f"""
    SELECT {YAML_PATH_SQL} AS path, {YAML_STATUS_SQL} AS status,
      CASE WHEN p_size % 10 > 1 THEN 'part.' || p_partkey END AS pattern_id,
      CASE WHEN p_size % 10 > 2 THEN 'Make {{{{ kind }}}} ' || p_name END AS instruction,
      CASE WHEN p_size % 10 > 1 AND p_size % 10 <> 6 THEN 'a,b,c' END AS options,
      CASE WHEN p_size % 10 > 1 AND p_size % 10 <> 6 THEN p_size::VARCHAR END AS n_default
    FROM part""",
)
def scan_catalog(spark, sf_dir):
    rows = parse_catalog(part_yaml(spark, sf_dir))
    kind = F.try_element_at("parameters", F.lit("kind"))
    return rows.select(
        "path",
        "status",
        "pattern_id",
        "instruction",
        F.array_join(F.transform(kind["options"], lambda o: o["v"]), ",").alias("options"),
        F.try_element_at("parameters", F.lit("n"))["default"]["v"].alias("n_default"),
    )


@query(
    "scan_lines",
    """
    SELECT count(*) AS n_lines, count(*) FILTER (WHERE contains(line, 'the')) AS n_matching
    FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)""",
)
def scan_lines(spark, sf_dir):
    path = scratch_path(spark, "lines")
    files.write_lines(table(spark, sf_dir, "documents"), "text", path)
    return files.count_matching(files.scan_lines(spark, path), "the")


@query("scan_csv", "SELECT c_acctbal, c_custkey, c_name FROM customer")
def scan_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    files.write_csv(table(spark, sf_dir, "customer"), path)
    schema = T.StructType(
        [
            T.StructField("c_acctbal", T.DoubleType()),
            T.StructField("c_custkey", T.LongType()),
            T.StructField("c_name", T.StringType()),
        ]
    )
    return files.read_csv(spark, path, schema)


@query(
    "scan_fixed_records",
    """
    SELECT vec_id, label::BIGINT AS label, len(embedding) AS n,
      round(list_sum(list_transform(embedding, lambda x: x::DOUBLE)), 6) AS total
    FROM embeddings""",
)
def scan_fixed_records(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    width = vectors.agg(F.max(F.size("embedding"))).first()[0]
    record = F.concat(F.array("vec_id", "label").cast("array<double>"), F.col("embedding").cast("array<double>"))
    path = scratch_path(spark, "fixed")
    files.write_fixed(vectors.select(record.alias("record")), "record", "double", path)
    items = F.slice("items", 3, width)
    return files.read_fixed(spark, path, "double", width + 2).select(
        F.get("items", F.lit(0)).cast("long").alias("vec_id"),
        F.get("items", F.lit(1)).cast("long").alias("label"),
        F.size(items).cast("long").alias("n"),
        F.round(F.aggregate(items, F.lit(0.0), lambda a, x: a + x), 6).alias("total"),
    )


RECORDS_SQL = """
SELECT conv_id, turn, text AS instruction, '' AS input, next_text AS output
FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text
      FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'user' AND next_role = 'assistant'"""


@query("sink_jsonl", f"SELECT instruction, input, output FROM ({RECORDS_SQL})")
def sink_jsonl(spark, sf_dir):
    path = scratch_path(spark, "jsonl")
    records = turns_to_records(table(spark, sf_dir, "conversations"))
    shaped = records.select("instruction", "input", "output")
    files.write_jsonl(shaped, path)
    return files.read_jsonl(spark, path, shaped.schema)


@query(
    "sink_csv",
    "SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day, o_orderpriority FROM orders",
)
def sink_csv(spark, sf_dir):
    path = scratch_path(spark, "csv")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"), "o_orderpriority"
    )
    files.write_csv(orders, path)
    return files.read_csv(spark, path, orders.schema)


@query("sink_csv_texts", "SELECT doc_id, text FROM documents")
def sink_csv_texts(spark, sf_dir):
    path = scratch_path(spark, "csv-texts")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    files.write_csv(docs, path)
    return files.read_csv(spark, path, docs.schema, multi_line=True)


@query(
    "sink_corpus",
    f"""
    WITH tok AS {sql_tokens()},
    voc AS (SELECT term, count(*) AS n, min(doc_id * 2147483648 + pos) AS f FROM tok GROUP BY term HAVING count(*) >= 2),
    ids AS (SELECT term, n, row_number() OVER (ORDER BY n DESC, f) + 1 AS id FROM voc)
    SELECT doc_id, count(*) AS n_tokens, sum(coalesce(id, 0))::BIGINT AS id_sum,
      (SELECT count(*) FROM ids) + 2 AS vocab_size
    FROM tok LEFT JOIN ids USING (term) GROUP BY doc_id""",
)
def sink_corpus(spark, sf_dir):
    docs = spread_table(spark, sf_dir, "documents")
    words = tokenize_alpha(F.col("text"))
    tokens = token_rows(docs, "doc_id", words)
    vocab = assign_ids(build_vocab(term_stats(docs, "doc_id", words), 2))
    meta = corpus_metadata(docs, words, vocab, 2)
    path = scratch_path(spark, "corpus")
    files.write_corpus(encode(tokens, vocab), vocab, meta, path)
    written, _, described = files.read_corpus(spark, path)
    size = described.first()["vocab_size"]
    return written.groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_tokens"),
        F.sum("token_id").alias("id_sum"),
        F.lit(size).cast("long").alias("vocab_size"),
    )


@query("sink_metrics", REPORT_SQL.format(labels=LABEL_SQL))
def sink_metrics(spark, sf_dir):
    report = classification_report(labelled(spark, sf_dir), "y", "p")
    path = scratch_path(spark, "metrics")
    files.write_metrics(report, path)
    return spark.read.schema(report.schema).json(path).select(
        "label", *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")], "support"
    )


@query(
    "snapshot_versioned",
    """
    SELECT 'v1' AS version, s_suppkey, s_acctbal FROM supplier
    UNION ALL SELECT 'v2', s_suppkey, round(s_acctbal + 1, 2) FROM supplier""",
)
def snapshot_versioned(spark, sf_dir):
    base = scratch_path(spark, "versions")
    supplier = table(spark, sf_dir, "supplier")
    files.write_version(supplier, base, "v1")
    newer = supplier.select("s_acctbal", "s_nationkey", "s_name", "s_suppkey").withColumn(
        "s_acctbal", F.round(F.col("s_acctbal") + 1, 2)
    )
    files.write_version(newer, base, "v2")
    columns = ["s_suppkey", "s_acctbal"]
    both = [
        files.read_version(spark, base, v, columns).select(F.lit(v).alias("version"), *columns)
        for v in ("v1", "v2")
    ]
    return both[0].unionAll(both[1])
