import random

import pytest

import corpus_pipeline as cp
from recordloom.llm import simhash

PRINT = lambda words: simhash.fingerprint(simhash.shingle_hashes(" ".join(words).encode().split(), 3))
DOCS = "doc_id long, text string, lang string, source string, n_chars long, copies int"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Clean documents with planted junk, exact and near copies and benchmark passages."""
    rnd = random.Random(12)
    path = tmp_path_factory.mktemp("corpus")
    words = lambda n: [f"word{rnd.randrange(4000)}" for _ in range(n)]
    items = [(i, " ".join(words(25))) for i in range(5)]
    docs, kind, labels = [], {}, []

    def add(text, what):
        i = len(docs)
        docs.append((i, text, "en", f"s{i % 4}" if i % 9 else None, None, 7))
        kind[i] = what
        return i

    for n in range(300):
        w = words(rnd.randint(60, 150))
        first = add(" ".join(w), "clean")
        if n % 10 == 0:
            add(" ".join(w), "copy")
        if n % 10 == 1:
            near = list(w)
            while near == w or ((PRINT(near) ^ PRINT(w)) & (1 << 64) - 1).bit_count() > 3:
                near = list(w)
                near[rnd.randrange(len(w))] = f"other{rnd.randrange(99)}"
            add(" ".join(near), "near")
        if n % 10 == 2:
            add(" ".join(words(40) + items[n % 5][1].upper().split()[3:20] + words(40)), "leak")
        if n % 10 in (3, 4):
            labels.append((add(" ".join(x.upper() + "!!" for x in words(80)), "junk"), 0, None))
        labels.append((first, 1, 0))
    add("too short", "junk")
    add(None, "junk")
    spark.createDataFrame(docs, DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return str(path), kind


def test_each_stage_removes_its_cases_and_keeps_the_clean(spark, folder):
    path, kind = folder
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    of = lambda *what: {i for i, k in kind.items() if k in what}
    docs = spark.read.parquet(f"{path}/documents.parquet")
    want = [of("clean", "copy", "near", "leak"), of("clean", "leak"), of("clean")]
    for (_, stage), left in zip(cp.STAGES, want):
        docs, columns = stage(spark, docs, path), docs.columns
        assert docs.columns == columns and ids(docs) == left
    mixed = cp.mix_sources(spark, docs, path)
    assert mixed.columns == columns and ids(mixed) <= of("clean")
    n = mixed.count()
    placed = cp.shard(spark, mixed, path)
    assert placed.count() == n and {r[0] for r in placed.select("shard").distinct().collect()} <= set(range(40))


def test_run_is_the_stages_in_order(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, path)
    assert sorted(map(tuple, cp.run(spark, path).collect())) == sorted(map(tuple, docs.collect()))


def test_empty_documents(spark, folder):
    path, _ = folder
    docs = spark.read.parquet(f"{path}/documents.parquet").limit(0)
    for _, stage in cp.STAGES:
        docs = stage(spark, docs, path)
    assert docs.collect() == []
