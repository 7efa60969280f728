import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import rows
from recordloom.functions.text import clean_text, tokenize_alpha, tokenize_ws
from recordloom.operators import textprep as t

random.seed(5)
WORDS = ["the"] * 40 + [f"w{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(120)] + ["x" * 90]
DOCS = [(i, " ".join(random.choices(WORDS, k=random.choice([0, 1, 3, 30, 400])))) for i in range(60)]
DOCS.append((60, " ".join(["the"] * 3000)))


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(DOCS, "doc_id long, text string").repartition(4)


def stream():
    return [(d, p, w) for d, text in sorted(DOCS) for p, w in enumerate(text.split())]


def expected_ids(min_freq):
    counts = Counter(w for _, _, w in stream())  # keeps first-seen order
    kept = [w for w in sorted(counts, key=counts.get, reverse=True) if counts[w] >= min_freq]
    return {w: i for i, w in enumerate(kept, 2)}


def test_clean_and_tokens(spark):
    df = spark.createDataFrame([("  Héllo,\n\tWorld-42!  A_b é1 snake_case x9 Zed ",)], "t string")
    got = df.select(clean_text(F.col("t")), tokenize_ws(F.col("t")), tokenize_alpha(F.col("t"))).first()
    assert got[0] == "Hllo World42 Ab 1 snakecase x9 Zed"
    assert got[1] == ["héllo,", "world-42!", "a_b", "é1", "snake_case", "x9", "zed"]
    assert got[2] == ["world", "zed"]


@pytest.mark.parametrize("shift", [0, 1 << 40])
@pytest.mark.parametrize("min_freq", [1, 5])
def test_ids_follow_count_then_first_place(docs, min_freq, shift):
    moved = docs.withColumn("doc_id", F.col("doc_id") + shift)  # wide keys take the decimal place
    vocab = t.assign_ids(t.build_vocab(t.term_stats(moved, "doc_id", tokenize_alpha(F.col("text"))), min_freq))
    got = {r["term"]: r["id"] for r in vocab.collect()}
    assert got == {"<UNK>": 0, "<PAD>": 1, **expected_ids(min_freq)}


@pytest.mark.parametrize("head_terms", [500_000, 3, 0])
def test_encoding_is_the_same_with_any_head(docs, head_terms):
    words = tokenize_alpha(F.col("text"))
    vocab = t.assign_ids(t.build_vocab(t.term_stats(docs, "doc_id", words), 5)).cache()
    got = t.encode(t.token_rows(docs, "doc_id", words), vocab, head_terms)
    ids = expected_ids(5)
    assert {(r["doc_id"], r["pos"]): r["token_id"] for r in got.collect()} == {
        (d, p): ids.get(w, 0) for d, p, w in stream()
    }


def test_hot_unknown_terms_are_not_shuffled_to_one_task(spark):
    unknown, long_term = "zz", "t" * 100
    words = F.when(F.col("id") % 3 == 0, unknown).when(F.col("id") % 3 == 1, long_term).otherwise(
        F.concat(F.lit("w"), (F.col("id") % 997).cast("string"))
    )
    tokens = spark.range(0, 30_000, 1, 6).select(F.col("id").alias("key"), words.alias("term"))
    tokens = tokens.unionAll(spark.createDataFrame([(30_000, None), (30_001, "")], tokens.schema))
    vocab = spark.createDataFrame(
        [("<UNK>", 0, 0), ("<PAD>", 1, 0), ("w1", 2, 9), (long_term, 3, 8), ("w2", 4, 7), ("w3", 5, 1)],
        "term string, id long, n long",
    )
    hot = t.hot_digests(tokens.withColumn("_digest", F.md5("term")), 10)
    assert {r[0] for r in hot.collect()} == {hashlib.md5(w.encode()).hexdigest() for w in (unknown, long_term)}
    got = {r["key"]: r["token_id"] for r in t.encode(tokens, vocab, 2).collect()}
    ids = {r["term"]: r["id"] for r in vocab.collect()}
    assert got == {r["key"]: ids.get(r["term"], 0) for r in tokens.collect()}
    # the hot rows stay in the tasks that hold them: no exchange of theirs on the way
    settled = t.encode(tokens.filter(F.col("term") == unknown), vocab, 2)
    assert settled.filter("token_id = 0").count() == 10_000


@pytest.mark.parametrize("bounds", [{}, {"limit": 7}])
@pytest.mark.parametrize("block", [9, 64, 8192])
def test_corpus_windows_cross_documents(docs, block, bounds):
    got = t.corpus_windows(docs, "doc_id", F.filter(F.split("text", " "), lambda w: w != ""), 8, block, **bounds)
    words = [w for _, _, w in stream()]
    want = [(i, words[i : i + 8], words[i + 1 : i + 9]) for i in range(len(words) - 8)]
    assert [tuple(r) for r in got.orderBy("start").collect()] == want


def test_row_windows(spark):
    df = spark.createDataFrame([(1, [1, 2, 3, 4]), (2, [5, 6]), (3, [])], "id long, t array<int>")
    got = t.sequence_windows(df.withColumnRenamed("t", "a"), F.col("a"), 2).select("id", "start", "x", "y")
    assert rows(got, "start") == [(1, 0, [1, 2], [2, 3]), (1, 1, [2, 3], [3, 4])]
    assert t.require_windows(10, 4) == 6
    with pytest.raises(ValueError):
        t.require_windows(4, 4)


def test_metadata(docs):
    words = tokenize_alpha(F.col("text"))
    vocab = t.assign_ids(t.build_vocab(t.term_stats(docs, "doc_id", words), 5))
    row = t.corpus_metadata(docs, words, vocab, 5, "2024-01-01T00:00:00").first()
    assert tuple(row) == (61, len(expected_ids(5)) + 2, len(stream()), 5, "2024-01-01T00:00:00")


def test_small_text_operators(spark):
    df = spark.createDataFrame([(" Error: Disk ", "debug"), ("fine", "ERROR"), (None, "nolevel")], "s string, lvl string")
    got = t.normalize_strings(df, "s", "err", "[%s]").first()
    assert (got["clean"], got["has_prefix"], got["message"]) == ("error: disk", True, "[error: disk]")
    assert [r["s"] for r in t.level_filter(df, "lvl", "WARNING").collect()] == ["fine"]
    assert t.upper_column(df, "s").first()["s"] == " ERROR: DISK "
    with pytest.raises(ValueError):
        t.upper_column(df, "missing")
    mails = spark.createDataFrame([("a@b.co",), ("a@b",), ("@b.co",)], "m string")
    assert t.regex_matches(mails, "m", r"^[\w.+-]+@[\w-]+\.[\w.-]+$").count() == 1


def test_windows_of_a_very_long_text(spark):
    df = spark.range(1).select("id", F.transform(F.sequence(F.lit(1), F.lit(200_000)), lambda i: i).alias("a"))
    got = t.sequence_windows(df, F.col("a"), 8)
    assert got.agg(F.count(F.lit(1)), F.sum(F.col("y")[7])).first()[:] == (199_992, sum(range(9, 200_001)))


def test_blocks_grow_with_the_window(spark):
    df = spark.createDataFrame([(1, "a b c"), (2, "d e f g")], "k long, text string")
    got = t.corpus_windows(df, "k", F.split("text", " "), 5, block=2)
    assert [tuple(r) for r in got.orderBy("start").collect()] == [
        (0, list("abcde"), list("bcdef")),
        (1, list("bcdef"), list("cdefg")),
    ]


def test_text_keys_and_unicode_blanks(spark):
    df = spark.createDataFrame([("b", "x y"), ("a", "y z")], "k string, text string")
    stats = t.term_stats(df, "k", F.split("text", " "))
    assert [r["term"] for r in t.assign_ids(t.build_vocab(stats, 1)).orderBy("id").collect()][-3:] == ["y", "z", "x"]
    blanks = spark.createDataFrame([("a\u00a0b\u2003c d\x1ce",)], "s string")
    row = blanks.select(clean_text(F.col("s")), tokenize_ws(F.col("s"))).first()
    assert tuple(row) == ("a b c d e", ["a", "b", "c", "d", "e"])


@pytest.mark.parametrize("chunk", [1, 2, 7, 1024])
def test_windows_do_not_depend_on_chunks(spark, chunk):
    texts = [(i, " ".join(f"w{j}" for j in range(n))) for i, n in enumerate([0, 1, 3, 4, 5, 6, 7, 8, 9, 14, 15, 30])] + [(99, None)]
    df = spark.createDataFrame(texts, "id long, text string")
    words = F.filter(F.split("text", " "), lambda w: w != "")
    got = {(r["id"], r["start"]): (r["x"], r["y"]) for r in t.sequence_windows(df, words, 4, chunk).collect()}
    want = {}
    for i, text in texts:
        w = (text or "").split()
        for s in range(len(w) - 4):
            want[(i, s)] = (w[s : s + 4], w[s + 1 : s + 5])
    assert got == want


def test_windows_of_a_long_text(spark):
    df = spark.range(1).withColumn("text", F.array_join(F.transform(F.sequence(F.lit(0), F.lit(199_999)), lambda i: F.concat(F.lit("w"), i.cast("string"))), " "))
    got = t.sequence_windows(df, F.split("text", " "), 64)
    right = (F.element_at("x", 1) == F.concat(F.lit("w"), F.col("start").cast("string"))) & (
        F.element_at("y", 64) == F.concat(F.lit("w"), (F.col("start") + 64).cast("string"))
    )
    assert got.agg(F.count(F.lit(1)), F.min("start"), F.max("start"), F.bool_and(right)).first() == (199_936, 0, 199_935, True)


def test_first_places_of_any_whole_key(spark):
    far = 1 << 40
    data = [(far, "b a"), (5, "x a b"), (-7, "c"), (-far, "c d"), (None, "e"), ((1 << 32) - 1, "f"), (1 << 32, "f g")]
    stats = t.term_stats(spark.createDataFrame(data, "k long, s string"), "k", F.split("s", " "))
    assert stats.schema["first_at"].dataType.simpleString() == "decimal(32,0)"
    want = {
        "a": (2, (5, 1)), "b": (2, (5, 2)), "x": (1, (5, 0)), "c": (2, (-far, 0)), "d": (1, (-far, 1)),
        "e": (1, None), "f": (2, ((1 << 32) - 1, 0)), "g": (1, (1 << 32, 1)),
    }
    got = {r["term"]: (r["n"], None if r["first_at"] is None else int(r["first_at"])) for r in stats.collect()}
    assert got == {w: (n, None if at is None else at[0] * (1 << 31) + at[1]) for w, (n, at) in want.items()}


def test_the_corpus_is_read_once_for_ids_and_twice_for_codes(spark):
    calls = spark.sparkContext.accumulator(0)

    @F.udf("boolean")
    def told(_):
        calls.add(1)
        return True

    terms = [(f"w{i}", 20 - i, i) for i in range(20)]
    vocab = spark.createDataFrame(terms, "term string, n long, first_at long").filter(told("term"))
    ids = t.assign_ids(vocab)
    assert ids.filter("id = 21").first()["term"] == "w19" and calls.value == 20
    calls.value = 0
    tokens = spark.range(30).select("id", F.concat(F.lit("w"), F.col("id").cast("string")).alias("term"))
    codes = t.encode(tokens.withColumnRenamed("id", "pos").filter(told("pos")), ids, head_terms=3)
    assert dict(rows(codes)) == {i: i + 2 if i < 20 else 0 for i in range(30)}
    assert calls.value == 60
