import hashlib
import random
import re

import numpy as np
import pytest

from recordloom.llm import decontaminate as d

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
DOCS = "doc_id long, text string, n_words string, item_id string"
ITEMS = "item_id long, text string, doc_id long"


def words(text):
    return WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, window=10):
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for item, body in items:
            if item is None or body is None:
                continue
            b = words(body)
            n = min(window, len(b))
            grams = {tuple(b[i : i + n]) for i in range(len(b) - n + 1)} if n else set()
            for i in range(len(w) - n + 1 if n else 0):
                if tuple(w[i : i + n]) in grams:
                    hit |= set(range(i, i + n))
                    found.add(item)
        digest = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit)))
    return sorted(out, key=repr)


def run(spark, docs, items, **kw):
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(2)
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], ITEMS)
    return sorted((tuple(r)[:6] for r in d.contamination(table, bench, **kw).collect()), key=repr)


@pytest.mark.parametrize("blocks", [4_000_000, 300])
def test_agrees_with_plain_windows(spark, blocks):
    rnd = random.Random(7)
    text = lambda n: " ".join(rnd.choice(["a", "B", "c-d", "é", "the", "9"]) for _ in range(n))
    items = [(i, text(rnd.choice([3, 8, 10, 11, 25]))) for i in range(25)] + [(3, text(12)), (99, None), (None, "a"), (50, " - ")]
    docs = [(i, text(rnd.randint(0, 60)) + (" " + rnd.choice(items[:25])[1].upper() if i % 3 else "")) for i in range(80)]
    docs += [(1, docs[1][1]), (None, items[2][1]), (500, None), (501, "")]
    assert run(spark, docs, items, block_bytes=blocks) == brute(docs, items)


def test_very_long_text_single_words_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(60_000))
    items = [(1, " ".join(f"w{i}" for i in range(500, 530))), (2, "W7"), (3, "w8 w10")]
    docs = [(1, long), (2, "w7."), (3, "w9")]
    assert run(spark, docs, items) == brute(docs, items)
    assert run(spark, docs, []) == brute(docs, [])
    assert run(spark, [], items) == []


def test_many_blocks_share_one_pass_and_text_ids_stay_text(spark):
    """Forty blocks need no more workers than one: the documents pass a single Python stage."""
    passage = lambda i: " ".join(f"p{i}x{j}" for j in range(12))
    bench = spark.createDataFrame([(f"item-{i}", passage(i), i) for i in range(40)], "item_id string, text string, doc_id long")
    docs = spark.createDataFrame([(i, f"a {passage(i)} b {passage((i + 1) % 40)}", "", "") for i in range(40)], DOCS)
    found = d.contamination(docs, bench, block_bytes=80)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") + plan.count("PythonMapInArrow") <= 2  # the node and its name
    got = {r["doc_id"]: r for r in found.collect()}
    for i in range(40):
        names = sorted((f"item-{i}", f"item-{(i + 1) % 40}"))
        assert got[i]["n_items"] == 2 and got[i]["n_hit"] == 24 and got[i]["match_item"] in names
        assert got[i]["items_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()


def test_longest_match_and_clean_rows(spark):
    bench = spark.createDataFrame([(5, " ".join(f"w{i}" for i in range(30)), 1)], ITEMS)
    docs = spark.createDataFrame([(1, "x " + " ".join(f"w{i}" for i in range(4, 21)) + " y", "", ""), (2, "w1 w2", "", "")], DOCS)
    got = {r["doc_id"]: r for r in d.contamination(docs, bench).collect()}
    assert (got[1]["longest_match"], got[1]["match_start"], got[1]["match_item"]) == (17, 1, 5)
    clean = d.clean_documents(docs, bench)
    assert clean.schema == docs.schema and [r["doc_id"] for r in clean.collect()] == [2]


def test_suffix_array_sorts_suffixes():
    words_ = np.array([3, 1, 3, 1, 3, 2, -1, 3, 1], dtype=np.int64)
    got = d.suffix_array(words_, 100)
    assert got.tolist() == sorted(range(9), key=lambda i: words_[i:].tolist())
