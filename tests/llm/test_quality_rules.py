import random
import re

import numpy as np

from recordloom.llm import quality as q

DOCS = "doc_id long, text string, n_words string, label string, x string"


def plain(text):
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
    seen, dups = set(), 0
    for x in lines:
        dups += x in seen
        seen.add(x)
    grams = {}
    for i in range(len(w) - 7):
        grams.setdefault(tuple(w[i : i + 8]), []).append(i)
    hit = {j for at in grams.values() if len(at) > 1 for i in at for j in range(i, i + 8)}
    n = len(w)
    return (n, sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dups, len(hit), n < 20 or 100 * len(hit) > 30 * n)


def texts():
    rnd = random.Random(8)
    out = []
    for i in range(120):
        words = [rnd.choice(["a", "é", "b|", "#", "ab\x0bc", "x y", "\xa0"]) for _ in range(rnd.randint(0, 60))]
        out.append(rnd.choice([" ", "\n", " \n "]).join(words))
    return [*out, None, "", "w " * 40, " ".join(map(str, range(8))) + " x " + " ".join(map(str, range(8))), "w " * 20_000]


def test_base_columns_agree_with_plain_counts(spark):
    rows = [(i, t, "x", "y", "z") for i, t in enumerate(texts())]
    got = q.judge_quality(spark.createDataFrame(rows, DOCS).repartition(3), None).orderBy("doc_id").collect()
    for (i, t, *_), r in zip(rows, got):
        assert tuple(r)[:7] == (i, *plain(t)) and r["kept"] == (not r["base_failed"])


def labelled(spark, n=600):
    rnd = random.Random(2)
    docs, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        w = [f"w{rnd.randrange(300)}" for _ in range(rnd.randint(30, 90))]
        if not good:
            w = [x.upper() + "!!" for x in w] if i % 8 else [x + "%%%" for x in w]
        docs.append((i, " ".join(w), "x", "y", "z"))
        if i % 2 == 0:
            labels.append((i, int(good), "clash"))
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_held_out_documents_are_told_apart(spark):
    docs, labels = labelled(spark)
    trees = q.fit_quality(docs, labels)
    again = q.fit_quality(docs.repartition(5), labels.repartition(3))
    assert np.array_equal(trees.value, again.value) and trees.keep_at == again.keep_at
    got = {r["doc_id"]: r["kept"] for r in q.judge_quality(docs, trees).collect() if r["doc_id"] % 2 == 0 or r["doc_id"] % 8 in (4, 0)}
    assert sum(got[i] == (i % 4 != 0) for i in got) / len(got) > 0.98
    kept = q.good_documents(docs, trees)
    assert kept.schema == docs.schema
    assert {r["doc_id"] for r in kept.collect()} >= {i for i in got if i % 4}


def test_scores_are_monotonic_and_match_a_walk():
    rng = np.random.default_rng(1)
    x = rng.random((1500, 3))
    y = ((x[:, 0] + 0.4 * np.sin(9 * x[:, 1]) + 0.3 * rng.standard_normal(1500)) < 0.6).astype(float)
    trees = q.train(x, y, [-1, 0, 1])
    probe = rng.random((200, 3))
    for f, sign in ((0, -1), (2, 1)):
        grid = np.repeat(probe[:, None, :], 30, axis=1)
        grid[:, :, f] = np.linspace(0, 1, 30)
        s = trees.score(grid.reshape(-1, 3)).reshape(200, 30)
        assert (sign * np.diff(s, axis=1) >= -1e-12).all()
    assert (np.diff(trees.score(np.column_stack([np.full(30, 0.5), np.linspace(0, 1, 30), np.full(30, 0.5)]))) > 0).any()

    def walk(row):
        total = trees.base
        for at in trees.roots:
            while trees.left[at] != at:
                at = trees.left[at] if row[trees.feature[at]] <= trees.threshold[at] else trees.right[at]
            total += trees.value[at]
        return total

    assert np.allclose(trees.score(probe), [walk(r) for r in probe])


def test_cut_comes_from_rows_the_trees_did_not_see():
    rng = np.random.default_rng(3)
    x = rng.random((800, 2))
    x = np.concatenate([x, x[:50]])  # equal rows are held out together
    y = (rng.random(850) < 0.2 + 0.6 * (x[:, 0] > 0.5)).astype(float)
    seen, unseen = q.train(x, y, [0, 0]).score(x), q.held_out_scores(x, y, [0, 0])
    loss = lambda s: np.mean(np.log1p(np.exp(np.where(y == 1, -s, s))))
    assert loss(seen) < loss(unseen)
    assert np.array_equal(unseen[:50], unseen[800:])
    fold = np.unique(x, axis=0, return_inverse=True)[1].ravel() % q.FOLDS
    mine = fold == 2
    assert np.array_equal(unseen[mine], q.train(x[~mine], y[~mine], [0, 0]).score(x[mine]))
    assert np.isfinite(q.held_out_scores(np.ones((40, 2)), np.arange(40) % 2.0, [0, 0])).all()


def test_without_labels_or_rows(spark):
    docs, labels = labelled(spark, 40)
    assert q.fit_quality(docs, labels.limit(0)) is None
    assert q.fit_quality(docs, labels.filter("quality = 1")) is None
    assert q.fit_quality(docs.limit(0), labels) is None
    trees = q.fit_quality(docs, labels.unionByName(labels.selectExpr("doc_id", "cast(null as int) quality", "text")))
    assert q.judge_quality(docs.limit(0), trees).collect() == []
    twice = spark.createDataFrame([(None, "a", "", "", "")] * 2, DOCS)
    assert [r["kept"] for r in q.judge_quality(twice, trees).collect()] == [False, False]
