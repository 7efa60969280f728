"""Corpus work: term counts, vocabularies, encoding, training windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import normalize_string
from ..scale import global_index, materialize, pin, running

UNK_ID, PAD_ID, FIRST_ID = 0, 1, 2
WIDE = "decimal(32,0)"
# The broadcast part of a vocabulary: at most this many terms of this length.
HEAD_TERMS = 500_000
HEAD_LENGTH = 64
# Terms outside that part are hot from a share of 1 / HOT_TERMS on; their number is bounded by it.
HOT_TERMS = 1000

LEVELS = {"DEBUG": 10, "INFO": 20, "WARNING": 30, "ERROR": 40, "CRITICAL": 50}


def token_rows(df: DataFrame, key: str, tokens: Column) -> DataFrame:
    """(key, pos, term), one row per token."""
    return df.select(key, F.posexplode(tokens).alias("pos", "term"))


def term_counts(tokens: DataFrame) -> DataFrame:
    """Corpus-wide frequency; counted map-side, so a hot term shuffles one row per task."""
    return tokens.groupBy("term").agg(F.count(F.lit(1)).alias("n"))


def term_stats(docs: DataFrame, key: str, tokens: Column) -> DataFrame:
    """Count and first place (document, position) of each term.

    For whole-number keys the place is one fixed-width number, so the grouping stays a
    hash aggregation; other keys, text above all, give a (key, pos) struct. The type
    follows the key's type only, never the data.
    """
    rows = token_rows(docs, key, tokens).groupBy("term")
    n = F.count(F.lit(1)).alias("n")
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        return rows.agg(n, F.min(F.struct(F.col(key).alias("key"), "pos")).alias("first_at"))
    packed = F.col(key).cast("decimal(20,0)") * F.lit(1 << 31).cast("decimal(10,0)") + F.col("pos")
    # places that fit are compared as plain longs, since wide decimals cost an object per token
    number = F.col(key).cast("long")
    fits = number.between(-(1 << 32), (1 << 32) - 1)
    near = F.min(F.when(fits, number * F.lit(1 << 31) + F.col("pos"))).cast(WIDE)
    return rows.agg(n, F.least(near, F.min(F.when(fits, None).otherwise(packed)).cast(WIDE)).alias("first_at"))


def build_vocab(stats: DataFrame, min_freq: int) -> DataFrame:
    return stats.filter(F.col("n") >= min_freq)


def assign_ids(vocab: DataFrame, unk: str = "<UNK>", pad: str = "<PAD>") -> DataFrame:
    """(term, id, n): 0 and 1 are special, the rest from 2 by falling count, then first place."""
    # counted, sampled and copied below, which must not read the corpus each time; limit 0: always
    # written in ordered blocks, for the uses of the result
    vocab = materialize(vocab, "terms")
    ids = global_index(vocab, [F.col("n").desc(), "first_at"], "id", FIRST_ID, limit=0)
    special = ids.sparkSession.createDataFrame(
        [(unk, UNK_ID, 0), (pad, PAD_ID, 0)], "term string, id long, n long"
    )
    return special.unionAll(ids.select("term", "id", "n"))


def encode(tokens: DataFrame, vocab: DataFrame, head_terms: int = HEAD_TERMS) -> DataFrame:
    """Replace terms by `token_id`, unknown ones by 0.

    Ids follow frequency, so the first `head_terms` ids are the frequent terms: they
    are broadcast (bounded count and length) and need no shuffle. Only tokens outside
    them are joined by shuffle with the rest of the vocabulary, without the hot ones among
    them (unknown terms above all), which a second small broadcast settles.
    """
    words = vocab.filter(F.col("id") >= FIRST_ID).select("term", "id")
    in_head = (F.col("id") < FIRST_ID + head_terms) & (F.length("term") <= HEAD_LENGTH)
    head, tail = F.broadcast(words.filter(in_head)), words.filter(~in_head)
    others = [c for c in tokens.columns if c != "term"]
    token_id = F.coalesce("id", F.lit(UNK_ID).cast("long")).alias("token_id")
    if tail.isEmpty():
        return tokens.join(head, "term", "left").select(*others, token_id)
    common = tokens.join(head, "term").select(*others, F.col("id").alias("token_id"))
    # written, since four steps read them and making tokens costs most
    rare = materialize(
        tokens.join(head.select("term"), "term", "left_anti").withColumn("_digest", F.md5("term")), "rare"
    )
    hot = hot_digests(rare)
    ids = tail.withColumn("_digest", F.md5("term")).join(F.broadcast(hot), "_digest").select("_digest", "id")
    settled = F.broadcast(materialize(hot.join(ids, "_digest", "left"), "hot-terms"))
    frequent = rare.join(settled, "_digest").select(*others, token_id)
    cold = rare.join(F.broadcast(hot), "_digest", "left_anti").drop("_digest")
    return common.unionAll(frequent).unionAll(cold.join(tail, "term", "left").select(*others, token_id))


def hot_digests(rows: DataFrame, items: int = HOT_TERMS) -> DataFrame:
    """(_digest): all values with more than 1 / `items` of the rows, at most 2 * `items` in all.

    One pass with a frequency sketch of fixed size per task. Tracking 8 * `items` values it
    overrates one by less than a quarter of that share and never underrates, so none is
    missed; a few just below the share may come along, which does no harm.
    """
    found = rows.agg(
        F.count("_digest").alias("n"), F.expr(f"approx_top_k(_digest, {2 * items}, {8 * items})").alias("top")
    )
    share = F.col("top")["count"] * F.lit(items) > F.col("n")
    hot = found.select("n", F.explode("top").alias("top")).filter(share).select(F.col("top.item").alias("_digest"))
    return materialize(hot, "hot-digests")


def corpus_metadata(
    docs: DataFrame, tokens: Column, vocab: DataFrame, min_freq: int, created: str | None = None
) -> DataFrame:
    """One row that describes an encoded corpus; the time stamp is passed in."""
    return docs.agg(
        F.count(F.lit(1)).alias("source_documents"),
        F.coalesce(F.sum(F.size(tokens).cast("long")), F.lit(0)).alias("total_tokens"),
    ).select(
        "source_documents",
        F.lit(vocab.count()).cast("long").alias("vocab_size"),
        "total_tokens",
        F.lit(min_freq).cast("long").alias("min_freq"),
        F.lit(created).alias("created_utc"),
    )


# Windows that begin in one chunk of a text; a chunk also holds the tokens its last windows reach.
CHUNK = 1024


def sequence_windows(df: DataFrame, tokens: Column, length: int, chunk: int = CHUNK) -> DataFrame:
    """Stride-1 windows inside each row: start, x (length tokens), y (shifted by one).

    A text is cut into chunks that overlap by `length` tokens, then positions are exploded and
    slices taken in generated code, so a long text is held about once and never all its windows.
    """
    ready = pin(df, {"_tokens": tokens})
    last = F.size("_tokens") - F.lit(length) - 1  # start of the last window
    firsts = F.when(last >= 0, F.sequence(F.lit(0), last, F.lit(chunk))).otherwise(F.array().cast("array<int>"))
    halo = F.lit(chunk + length)
    chunks = F.transform(
        firsts, lambda c: F.struct(c.alias("_first"), F.slice(F.col("_tokens"), c + 1, halo).alias("_chunk"))
    )
    pieces = ready.select(*df.columns, F.inline(chunks))
    start = (F.col("_first") + F.col("_at")).alias("start")
    return _cut(pieces, "_chunk", F.size("_chunk") - F.lit(length), length).select(*df.columns, start, "x", "y")


def _cut(rows: DataFrame, tokens: str, count: Column, length: int) -> DataFrame:
    """The first `count` windows of a bounded token array: `_at` from 0, x and y."""
    at = F.explode(F.sequence(F.lit(0), count - 1))
    placed = rows.filter(count > 0).withColumn("_at", at)
    cut = {
        "x": F.slice(F.col(tokens), F.col("_at") + 1, F.lit(length)),
        "y": F.slice(F.col(tokens), F.col("_at") + 2, F.lit(length)),
    }
    return placed.withColumns(cut).drop(tokens)


def corpus_windows(
    docs: DataFrame, key: str, tokens: Column, length: int, block: int = 8192, **bounds
) -> DataFrame:
    """Windows over the whole token stream in key order, across row borders.

    A running sum over the documents places each one in the stream. Documents are then
    sliced into stream blocks that also hold the first tokens of the next block, so every
    window forms inside one bounded array and long documents spread over many blocks.
    A block is at least twice as long as the window.
    """
    block = max(block, 2 * length)
    rows = docs.select(key, tokens.alias("_t"))
    sizes = materialize(rows.select(key, F.size("_t").cast("long").alias("_n")), "sizes")
    placed = running(sizes, [], [key], {"_off": ("sum", F.col("_n"))}, **bounds)
    size, length_ = F.lit(block).cast("long"), F.lit(length).cast("long")
    off, end = F.col("_off"), F.col("_off") + F.col("_n")
    first = F.greatest(F.floor((off - length_) / size).cast("long"), F.lit(0).cast("long"))
    last = F.floor((end - 1) / size).cast("long")
    pieces = (
        rows.join(placed.filter("_n > 0"), key)
        .withColumn("_b", F.explode(F.sequence(first, last)))
        .withColumn("_s", F.greatest(off, F.col("_b") * size))
        .withColumn("_len", F.least(end, (F.col("_b") + 1) * size + length_) - F.col("_s"))
        .select("_b", "_s", F.slice("_t", (F.col("_s") - off + 1).cast("int"), F.col("_len").cast("int")).alias("_p"))
    )
    blocks = pieces.groupBy("_b").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("_s", "_p"))), lambda p: p["_p"])).alias("_t")
    )
    count = F.least(F.size("_t") - F.lit(length), F.lit(block))
    windows = _cut(blocks, "_t", count, length)
    return windows.select((F.col("_b") * size + F.col("_at")).alias("start"), "x", "y")


def require_windows(n_tokens: int, length: int) -> int:
    """Number of windows of a stream, an error when it is too short."""
    if n_tokens <= length:
        raise ValueError(f"{n_tokens} tokens are too few for windows of {length}")
    return n_tokens - length


def normalize_strings(df: DataFrame, col: str, prefix: str, message: str) -> DataFrame:
    """Trimmed lower-case text, whether it starts with `prefix`, and a message."""
    clean = normalize_string(F.col(col))
    return df.withColumns(
        {
            "clean": clean,
            "has_prefix": F.startswith(clean, F.lit(prefix)),
            "message": F.format_string(message, clean),
        }
    )


def regex_matches(df: DataFrame, col: str, pattern: str) -> DataFrame:
    return df.filter(F.col(col).rlike(pattern))


def upper_column(df: DataFrame, name: str) -> DataFrame:
    if name not in df.columns:
        raise ValueError(f"column not found: {name}")
    return df.withColumn(name, F.upper(name))


def level_filter(df: DataFrame, col: str, level: str) -> DataFrame:
    """Rows at or above a severity."""
    rank = F.create_map(*[F.lit(x) for pair in LEVELS.items() for x in pair])
    return df.filter(F.try_element_at(rank, F.upper(col)) >= F.lit(LEVELS[level]))
