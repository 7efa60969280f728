import random
import re

from recordloom.llm import licenses as li

DOCS = "doc_id long, text string, labels string"
WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    w = WORD.findall((text or "").translate({c: c + 32 for c in range(65, 91)}))
    places = [(i, label) for p, label in li.PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    return len(w), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in places}))


def run(spark, texts):
    rows = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], DOCS)
    return li.scan_licenses(rows).orderBy("doc_id").collect()


def test_base_places_agree_with_plain_search(spark):
    rnd = random.Random(2)
    vocabulary = "gnu general public license apache mit cc by the licensed under x version of".split()
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(0, 40))) for _ in range(150)]
    texts += ["CC-BY, cc by; Apache\nLicense", None, "", "gnu general public gnu general public license", "é mit É license", "cc " * 9 + "by"]
    for text, got in zip(texts, run(spark, texts)):
        assert tuple(got)[1:6] == base(text)
        assert set(filter(None, got["base_labels"].split(","))) <= set(got["labels"].split(","))
        assert 0 <= got["score"] <= 1


def test_method_labels_and_spans(spark):
    texts = [
        "Before. Licensed under CC BY-NC 4.0.\nafter",
        "Permission is hereby granted, free of charge, to EVERY person obtaining a copy of this software and associated "
        "documentation files to deal in the Software without restriction",
        "this work is under the version 3 of the free software",
        "Licensed under the Apache License, Version 2.0. " + "word " * 30_000,
    ]
    nc, mit, none, apache = run(spark, texts)
    assert nc["labels"] == "cc-by,cc-by-nc" and nc["score"] == 1.0
    assert [(s["label"], s["first"], s["last"]) for s in nc["spans"]] == [("cc-by-nc", 1, 7)]
    assert mit["labels"] == "mit" and mit["base_labels"] == "" and 0.9 < mit["score"] < 1
    assert none["labels"] == "" and none["spans"] == []
    assert apache["labels"] == "apache,apache-2"


def test_matching_statistics_against_plain_search():
    rnd = random.Random(4)
    templates = [[rnd.randrange(3) for _ in range(rnd.randint(1, 9))] for _ in range(6)]
    text = [rnd.randrange(4) for _ in range(400)]
    inside = {tuple(t[i:j]) for t in templates for i in range(len(t)) for j in range(i, len(t) + 1)}
    for i, (_, n) in enumerate(li.Automaton(templates).walk(text)):
        assert n == max(k for k in range(i + 2) if tuple(text[i + 1 - k : i + 1]) in inside)


def test_empty_and_repeated(spark):
    rows = spark.createDataFrame([(None, "mit license", "")] * 2, DOCS)
    assert [r["n_base"] for r in li.scan_licenses(rows).collect()] == [1, 1]
    assert li.scan_licenses(rows.limit(0)).collect() == []


def test_stray_template_words_before_a_notice_lose_nothing(spark):
    notice = "This work is licensed under the GNU General Public License version 3"
    texts = [f"GNU General Public License\n{notice}", f"public license version 3. {notice}", f"{notice} {notice}"]
    title, stray, twice = run(spark, texts)
    for got, first in ((title, 4), (stray, 4)):
        assert got["score"] == 1.0 and "gpl-3" in got["labels"].split(",")
        assert [(s["first"], s["last"], s["covered"]) for s in got["spans"] if s["label"] == "gpl-3"] == [(first, first + 11, 12)]
    assert [(s["first"], s["covered"]) for s in twice["spans"] if s["label"] == "gpl-3"] == [(0, 12), (12, 12)]
