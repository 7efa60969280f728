import hashlib
import random
import zlib

import numpy as np
import pytest

from recordloom.llm import periods, queries


def brute_runs(words):
    """Every stretch of least period q and at least max(6, 4 q) words that no neighbour extends."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        start = 0
        while start + q < n:
            end = start + q
            while end < n and words[end] == words[end - q]:
                end += 1
            if end - start >= max(6, 4 * q):
                found.setdefault((start, end - start), q)  # the smallest period comes first
            start = max(start + 1, end - q + 1)
    return sorted((s, n_, q) for (s, n_), q in found.items())


def brute_row(doc, text):
    words = [w for w in (text or "").split()]
    runs = sorted(brute_runs(words), key=lambda r: (r[0], r[2]))
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    milli = best[1] * 1000 // best[2] if runs else None
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    return (doc, len(runs), *best, milli, sha(listed), sha(kept))


def plant(doc, text):
    words = (text or "").split()
    h = zlib.crc32(str(doc).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    return " ".join(words)


def random_words(rnd):
    kind = rnd.random()
    if kind < 0.3:
        return [rnd.choice("ab") for _ in range(rnd.randint(0, 60))]
    if kind < 0.4:
        return ["a"] * rnd.randint(0, 80)
    if kind < 0.5:  # Fibonacci words have many overlapping runs
        a, b = ["a"], ["a", "b"]
        for _ in range(rnd.randint(3, 8)):
            a, b = b, b + a
        return b
    words = []
    for _ in range(rnd.randint(1, 6)):
        unit = [rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 9))]
        words += (unit * rnd.randint(1, 9))[rnd.randint(0, 3) :]
        words += [rnd.choice("xyz") for _ in range(rnd.randint(0, 4))]
    return words * rnd.choice([1, 1, 1, 4, 5])


@pytest.mark.parametrize("seed", range(6))
def test_agrees_with_all_stretches(seed):
    rnd = random.Random(seed)
    texts = [random_words(rnd) for _ in range(rnd.choice([1, 5, 200]))]
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for t in texts for w in t], np.int64)
    ends = np.cumsum([len(t) for t in texts])
    want = [(s + e - len(t), n, q) for t, e in zip(texts, ends) for s, n, q in sorted(brute_runs(t), key=lambda r: (r[0], r[2]))]
    assert [tuple(r) for r in periods.runs_of(ids, ends).tolist()] == want


@pytest.mark.parametrize("batch", [1, 40, 150_000])
def test_rows(spark, monkeypatch, batch):
    monkeypatch.setattr(periods, "BATCH_WORDS", batch)
    rnd = random.Random(8)
    docs = [(i, "\n ".join(random_words(rnd))) for i in range(80)]
    docs += [(3, "la " * 9), (None, "la " * 9), (None, None), (200, None), (201, ""), (202, " \t"), (203, "é é é é é é"), docs[5]]
    table = spark.createDataFrame([(d, t, 1, "x") for d, t in docs], "doc_id long, text string, runs int, collapsed string")
    made = periods.periodic_runs(table.repartition(3))
    assert made.columns == ["doc_id", "n_words", "runs", "collapsed"]
    got = sorted((tuple(r) for r in periods.run_digests(made).collect()), key=repr)
    assert got == sorted((brute_row(*d) for d in docs), key=repr)
    assert periods.run_digests(periods.periodic_runs(table.limit(0))).count() == 0


def test_very_long_texts():
    n = 300_000
    words = np.zeros(n, np.int64)
    assert periods.runs_of(words, np.array([n])).tolist() == [[0, n, 1]]
    unit = np.random.default_rng(1).integers(0, 10**6, 70_000)
    words = np.concatenate([np.tile(unit, 5), [10**6]])
    assert periods.runs_of(words, np.array([len(words)])).tolist() == [[0, 350_000, 70_000]]


def test_many_places_with_different_left_words():
    words = [w for i in range(4000) for w in (f"w{i}", *["ha"] * (5 + i % 4))]
    number = {}
    ids = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
    assert [tuple(r) for r in periods.runs_of(ids, np.array([len(ids)])).tolist()] == brute_runs_of_ha(words)


def brute_runs_of_ha(words):
    out, start = [], None
    for i, w in enumerate([*words, "end"]):
        if w == "ha":
            start = i if start is None else start
        elif start is not None:
            if i - start >= 6:
                out.append((start, i - start, 1))
            start = None
    return out


def test_registered_query(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(tuple(r) for r in queries.QUERIES["op12_periodic_runs"](spark, sf).collect())
    want = []
    for doc, text in docs:
        text = plant(doc, text)
        if len(text.split()) <= 2500 or zlib.crc32(str(doc).encode()) % 10 == 0:
            want.append(brute_row(doc, text))
    ids = {r[0] for r in want}
    assert len(got) == len(docs) and [r for r in got if r[0] in ids] == sorted(want)
    assert sum(r[1] > 0 for r in got) > 5


def test_planting_follows_the_contract(spark):
    docs = [(i, " ".join(f"w{j}" for j in range(i % 50))) for i in range(400)] + [(None, "a b"), (500, None)]
    table = spark.createDataFrame(docs, "doc_id long, text string")
    got = {(r["doc_id"], r["text"]) for r in queries.with_planted_periods(table).collect() if r["doc_id"] is not None}
    assert got == {(d, None if t is None else plant(d, t)) for d, t in docs if d is not None}
