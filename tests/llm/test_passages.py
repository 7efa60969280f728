import hashlib
import random

import numpy as np
import pytest

from recordloom.llm import passages as p

DOCS = "doc_id long, text string, sha string, first string"


def brute(docs):
    first, out = {}, []
    for doc, text in sorted((d for d in docs if d[0] is not None), key=lambda d: d[0]):
        w = (text or "").split()
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), doc)
    for doc, text in docs:
        w = (text or "").split()
        gone = set()
        for i in range(len(w) - 49):
            if doc is not None and first[tuple(w[i : i + 50])] < doc:
                gone |= set(range(i, i + 50))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def run(spark, docs, **kw):
    table = spark.createDataFrame([(i, t, "x", "y") for i, t in docs], DOCS).repartition(3)
    return sorted((tuple(r) for r in p.remove_repeats(table, **kw).collect()), key=repr)


def corpus(seed=1):
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "é", "b.", "the"]) if rnd.random() < 0.3 else f"w{rnd.randrange(400)}"
    text = lambda n: [word() for _ in range(n)]
    shared = [text(n) for n in (49, 50, 51, 60, 90, 200)] + [["la"] * 120]
    docs = []
    for i in range(90):
        w = text(rnd.randint(0, 40))
        for _ in range(rnd.randint(0, 3)):
            s = rnd.choice(shared)
            cut = rnd.randint(0, 5)
            w += s[cut : len(s) - rnd.randint(0, 5)] + text(rnd.randint(0, 30))
        docs.append((i, " \n".join(w)))
    rnd.shuffle(docs)
    return docs + [(200 + i, docs[i][1]) for i in range(6)] + [(-5, docs[40][1]), (300, None), (301, "")]


@pytest.mark.parametrize("limit,bundle", [(20_000, 30_000), (5, 40), (0, 1)])
def test_agrees_with_plain_windows(spark, monkeypatch, limit, bundle):
    monkeypatch.setattr(p, "BUNDLE_ROWS", bundle)
    docs = corpus()
    assert run(spark, docs, group_rows=limit) == brute(docs)


def test_nulls_repeats_and_empty(spark):
    text = " ".join(f"w{i}" for i in range(70))
    docs = [(None, text), (3, text), (3, text), (3, text + " more"), (5, "x " + text), (None, None)]
    assert run(spark, docs) == brute(docs)
    assert run(spark, []) == []


def test_very_long_text_and_kept_text(spark):
    w = [f"w{i}" for i in range(30_000)]
    docs = [(1, " ".join(w)), (2, "y " + " ".join(w[100:29_000]) + " z")]
    assert run(spark, docs) == brute(docs)
    table = spark.createDataFrame([(i, t, "", "") for i, t in docs], DOCS)
    kept = {r["doc_id"]: r["kept_text"] for r in p.remove_repeats(table, with_text=True).collect()}
    assert kept == {1: None, 2: "y z"}


def test_every_window_has_its_anchor():
    h = np.random.default_rng(3).integers(0, 50, 500).astype(np.uint64)
    place, _ = p.anchors(h)
    for start in range(len(h) - p.WINDOW + 1):
        assert np.any((place >= start) & (place <= start + p.REACH))
