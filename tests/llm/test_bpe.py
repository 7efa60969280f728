import hashlib
import random

import pytest
from tokenizers import Tokenizer

from recordloom.llm import bpe, queries

ALPHABET = [*"abcdefghijklmnop  ''.,!?|\n\t0123456789éñΣσİßАж中文あ😀́̈\x1c\x85　 QWERTY"]
STRINGS = ["<|endoftext|>", "<|startoftext|>", "<|endof", "'s", "'ll", "the", "ing", "</w>", "Ġ", "ﬁ", "Å"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(bpe.VOCABULARY)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.read_vocabulary()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(library, doc, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    return doc, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def random_texts(n, seed=3):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(ALPHABET + STRINGS) for _ in range(rnd.randint(0, 40))) for _ in range(n)]


def test_every_assigned_character(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    for first in range(1, 0x3000, 64):
        text = " ".join(f"a{chr(c)}B {chr(c)}" for c in range(first, first + 64) if not bpe._older(chr(c)) == "�")
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, hex(first)


@pytest.mark.parametrize("most", [3, 100_000])
def test_random_texts(library, vocabulary, most):
    encoder = bpe.Encoder(vocabulary, most)
    for text in random_texts(3000):
        assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)
    assert len(encoder.chunks) <= most


def test_long_word_and_long_text(library, vocabulary):
    encoder = bpe.Encoder(vocabulary)
    text = "".join(random.Random(1).choices("abest", k=30_000))
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids
    text = "one two, three.\n" * 70_000  # over LONG_TEXT
    assert encoder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_rows_nulls_and_clashing_columns(spark, library):
    docs = [(1, "Hello <|endoftext|> World"), (1, "Hello <|endoftext|> World"), (None, "x"), (2, None), (3, ""), (4, " \n")]
    docs += list(enumerate(random_texts(300, 9), 10))
    table = spark.createDataFrame([(d, t, "old", [7]) for d, t in docs], "doc_id long, text string, decoded string, ids array<int>")
    vocabulary = bpe.share_vocabulary(spark)
    made = bpe.decode_ids(bpe.encode_texts(table.repartition(3), vocabulary), vocabulary)
    assert made.columns == ["doc_id", "text", "ids", "decoded"]
    got = sorted((tuple(r) for r in bpe.token_digests(made).collect()), key=repr)
    assert got == sorted((expected(library, d, t) for d, t in docs), key=repr)
    trip = bpe.round_trip(table, vocabulary)
    assert trip.columns == ["doc_id", "ids", "decoded"]
    assert sorted((tuple(r) for r in bpe.token_digests(trip).collect()), key=repr) == got
    assert bpe.encode_texts(table.limit(0), vocabulary).count() == 0
    assert bpe.round_trip(table.limit(0), vocabulary).count() == 0


def test_decoding_unknown_and_null_ids(spark, library):
    rows = spark.createDataFrame([(1, [320, -1, None, 10**6, 49407]), (2, []), (3, None)], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["decoded"] for r in bpe.decode_ids(rows, bpe.share_vocabulary(spark)).collect()}
    assert got == {1: library.decode([320, 49407], skip_special_tokens=False), 2: "", 3: None}


def test_registered_query(spark, library):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.QUERIES["op11_bpe"](spark, sf).collect())
    assert got == sorted(expected(library, *d) for d in docs)


def test_other_files_are_refused(tmp_path, vocabulary):
    text = open(bpe.VOCABULARY, encoding="utf-8").read()
    path = tmp_path / "other.json"
    path.write_text(text.replace('"NFC"', '"NFD"'), encoding="utf-8")
    with pytest.raises(ValueError):
        bpe.read_vocabulary(str(path))
