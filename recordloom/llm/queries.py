"""Registered queries of this subpackage and, where SQL can say it, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scale import spread
from . import bpe, centroids, chat, decontaminate, licenses, mixing, oracles, passages, periods, private, quality, sharding, simhash, urlrules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Fixed values of the contract: the URL rules.
URL_RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


def query(name: str, oracle: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return register


def read(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents", "doc_id", "text")


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES)


@query(
    "op3_url_filter",
    rf"""
    WITH rules(rule_host, rule_path, rule_verdict) AS (VALUES {_RULES_SQL}),
    parts AS (
      SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1),
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
      FROM pages)
    SELECT page_id, host, path,
           (SELECT r.rule_host || r.rule_path FROM rules r
            WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)
            ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC LIMIT 1) AS rule,
           coalesce((SELECT r.rule_verdict FROM rules r
            WHERE (host = r.rule_host OR ends_with(host, '.' || r.rule_host)) AND starts_with(path, r.rule_path)
            ORDER BY length(r.rule_host) DESC, length(r.rule_path) DESC LIMIT 1), 'allow') AS verdict
    FROM parts""",
)
def url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return urlrules.judge_urls(read(spark, sf_dir, "pages", "page_id", "url"), rules)


@query("op4_sharding")
def sharding_rows(spark, sf_dir):
    return sharding.shard_rows(documents(spark, sf_dir))


@query("op2_license_scan")
def license_scan(spark, sf_dir):
    return licenses.scan_licenses(documents(spark, sf_dir))


@query("op6_mixing")
def mixing_rows(spark, sf_dir):
    return mixing.mix_rows(read(spark, sf_dir, "documents", "doc_id", "text", "source"))


@query("op9_decontamination", oracles.DECONTAMINATION)
def decontamination(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark", "item_id", "text")
    return decontaminate.contamination(documents(spark, sf_dir), items)


@query("op8_simhash")
def simhash_classes(spark, sf_dir):
    return simhash.duplicate_classes(documents(spark, sf_dir))


@query("op10_substring_dedup", oracles.SUBSTRING_DEDUP)
def substring_dedup(spark, sf_dir):
    return passages.remove_repeats(documents(spark, sf_dir))


@query("op1_quality_rules")
def quality_rules(spark, sf_dir):
    docs = documents(spark, sf_dir)
    trees = quality.fit_quality(docs, read(spark, sf_dir, "labels", "doc_id", "quality"))
    return quality.judge_quality(docs, trees)


@query("op5_private_data")
def private_data(spark, sf_dir):
    return private.private_spans(documents(spark, sf_dir))


@query("op7_chat_format")
def chat_format(spark, sf_dir):
    turns = read(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    # Fixed values of the contract: a conversation that looks like a template itself.
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    windows = chat.chat_windows(turns.unionByName(extra), chat.token_counter(spark))
    return chat.read_back(windows)


@query("op11_bpe")
def bpe_round_trip(spark, sf_dir):
    return bpe.token_digests(bpe.round_trip(documents(spark, sf_dir), bpe.share_vocabulary(spark)))


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Fixed by the contract: one document of ten, by the CRC of its id, goes on from word a with period p."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    chosen = (h % 10 == 0) & F.col("text").isNotNull()
    g, n = F.col("g"), F.size("words").cast("long")
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), F.when(chosen, words).alias("words"))
    placed = cut.withColumn("a", F.when(n > 0, g % n)).withColumn("p", F.floor((n - F.col("a")) / (g % 8 + 3)) + 1)
    planted = F.array_join(
        F.transform(
            "words", lambda w, i: F.when(i < F.col("a"), w).otherwise(F.get("words", (F.col("a") + (i - F.col("a")) % F.col("p")).cast("int")))
        ),
        " ",
    )
    return placed.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))


@query("op12_periodic_runs", oracles.PERIODIC_RUNS)
def periodic_runs(spark, sf_dir):
    return periods.run_digests(periods.periodic_runs(with_planted_periods(documents(spark, sf_dir))))


def _clusters_sql() -> str:
    """All distances in every round, as lists of 64 whole numbers."""
    parts = ["""
    kept AS (
      SELECT row_number() OVER (ORDER BY vec_id) AS row_id, vec_id,
             list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v
      FROM embeddings
      WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
    centres0 AS (
      SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS w
      FROM kept QUALIFY c < 16)"""]
    for i in range(4):
        parts.append(f"""
    near{i} AS (
      SELECT row_id, min({{'d': d, 'c': c}}) AS best FROM (
        SELECT row_id, c, list_sum(list_transform(list_zip(v, w), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
        FROM kept, centres{i})
      GROUP BY row_id)""")
        if i < 3:
            parts.append(f"""
    moved{i} AS (
      SELECT c, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY part) AS w FROM (
        SELECT best.c AS c, part, sum(v[part])::HUGEINT AS s, count(*) AS n
        FROM kept JOIN near{i} USING (row_id), (SELECT unnest(range(1, 65)) AS part)
        GROUP BY 1, 2)
      GROUP BY c),
    centres{i + 1} AS (
      SELECT o.c, coalesce(m.w, o.w) AS w FROM centres{i} o LEFT JOIN moved{i} m USING (c))""")
    return "WITH " + ",".join(parts) + """
    SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
           (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
           (sum(best.d) OVER ())::BIGINT AS inertia,
           sha256(array_to_string(w, ',')) AS centroid_sha256
    FROM kept JOIN near3 USING (row_id) JOIN centres3 ON c = best.c"""


@query("op13_centroid_clusters", _clusters_sql())
def centroid_clusters(spark, sf_dir):
    return centroids.centroid_digests(centroids.cluster_vectors(read(spark, sf_dir, "embeddings", "vec_id", "embedding")))
