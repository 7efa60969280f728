import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from recordloom.llm import simhash as s
from recordloom.llm.components import components

DOCS = "doc_id long, text string, fp string, component_id string"


def table(spark, docs):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(3)


def plain_print(text, k=3):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_components(ids, links):
    parent = {i: i for i in ids}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def corpus():
    rnd = random.Random(1)
    docs = []
    for g in range(12):
        base = [f"W{rnd.randrange(300)}é" for _ in range(rnd.choice([1, 2, 5, 80, 250]))]
        for _ in range(rnd.choice([1, 3, 10])):
            words = list(base)
            if rnd.random() < 0.7:
                words[rnd.randrange(len(words))] = f"x{rnd.randrange(9)}"
            docs.append((len(docs), " \n".join(words)))
    return docs + [(900, None), (901, ""), (902, " \t"), (903, docs[5][1])]


@pytest.mark.parametrize("hot", [256, 0])
def test_agrees_with_all_pairs(spark, hot):
    docs = corpus()
    prints = {i: plain_print(t) for i, t in docs}
    links = [(a, b) for a in prints for b in prints if a < b and bin(prints[a] ^ prints[b]).count("1") <= 3]
    want = plain_components(prints, links)
    got = s.duplicate_classes(table(spark, docs), hot=hot).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {
        (i, f"{prints[i]:016x}", want[i]) for i in prints
    }
    assert len(got) == len(docs)


def test_crowded_buckets_lose_no_link(spark):
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    fps = {base} | {base ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(1, 4))) for _ in range(300)}
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    nodes = spark.createDataFrame([(f,) for f in signed], "fp long")
    want = {(min(a, b), max(a, b)) for a in signed for b in signed if a != b and bin((a ^ b) & (1 << 64) - 1).count("1") <= 3}
    for hot in (3, 10_000):
        assert {tuple(r) for r in s.links_within_3(nodes, hot).collect()} == want


def test_components_of_long_chains(spark):
    rnd = random.Random(2)
    links = [(i, i + 1) for i in range(60)] + [(100 + rnd.randrange(40), 100 + rnd.randrange(40)) for _ in range(30)]
    links += [(200, 200 + k) for k in range(1, 50)]
    rnd.shuffle(links)
    ids = {x for e in links if e[0] != e[1] for x in e}
    want = plain_components(ids, links)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {tuple(r) for r in got.collect()} == set(want.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_nulls_repeats_and_empty(spark):
    docs = table(spark, [(None, "a b c d"), (4, "a b c d"), (4, "a b c d"), (None, "lonely words here now"), (7, None)])
    got = sorted((tuple(r) for r in s.duplicate_classes(docs).select("doc_id", "component_id").collect()), key=repr)
    assert got == sorted([(None, 4), (4, 4), (4, 4), (None, None), (7, 7)], key=repr)
    assert s.one_of_each(docs).count() == 5
    assert s.duplicate_classes(docs.limit(0)).collect() == []
    assert s.one_of_each(docs.limit(0)).collect() == []
    assert s.duplicate_classes(table(spark, [(1, "long " * 300_000)])).select(F.max("component_id")).first()[0] == 1


def test_fingerprint_chunks(monkeypatch):
    h = np.random.default_rng(0).integers(0, 1 << 63, 1000).astype(np.uint64)
    whole = s.fingerprint(h)
    monkeypatch.setattr(s, "_CHUNK", 7)
    assert s.fingerprint(h) == whole and s.fingerprint(h[:0]) == 0


def test_one_of_each_class_stays(spark):
    """Copies and copies with a changed word: what stays are the smallest ids of the classes by brute force."""
    rnd = random.Random(9)
    docs = []
    for _ in range(40):
        base = [f"w{rnd.randrange(5000)}" for _ in range(rnd.choice([120, 900]))]
        for c in range(rnd.choice([1, 1, 2, 5])):
            words = list(base)
            if c > 1:
                words[rnd.randrange(len(words))] = "changed"
            docs.append((len(docs), " ".join(words)))
    source = table(spark, docs)
    prints = {i: s.fingerprint(s.shingle_hashes(t.encode().lower().split(), 3)) for i, t in docs}
    near = [(a, b) for a in prints for b in prints if a < b and ((prints[a] ^ prints[b]) & (1 << 64) - 1).bit_count() <= 3]
    want = plain_components(prints, near)
    assert len(near) > 40 and len(set(want.values())) >= 40
    kept = s.one_of_each(source)
    assert kept.schema == source.schema
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))
