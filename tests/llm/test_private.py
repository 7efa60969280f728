import hashlib
import random
import re

from recordloom.llm import private as p

DOCS = "doc_id long, text string, spans string, found string"
RULES = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def passes(kind, m):
    digits = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and p.luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def plain(text):
    found = []
    for k, (kind, rule) in enumerate(RULES.items()):
        found += [(m.start(), k, m.end()) for m in re.finditer(rule, text or "") if passes(kind, m.group())]
    names = [f"{list(RULES)[k]}:{a}:{b}" for a, k, b in sorted(found)]
    counts = [sum(k == j for _, k, _ in found) for j in range(4)]
    return counts, names


def run(spark, texts, **kw):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts)]
    return p.private_spans(spark.createDataFrame(rows, DOCS).repartition(3), **kw).orderBy("doc_id").collect()


def test_base_spans_agree_with_plain_patterns(spark):
    rnd = random.Random(1)
    pieces = ["a@b.c", "@", ".", "x.y-z@q.w.e", "1.2.3.4", "256.1.1.1", "0001.02.3.4.5", "4111 1111 1111 1111", "-", " ", "+1 (988) 555-2485",
              "+", "12", "é", "\n", "4111-1111-1111-1111-1", "a@b@c.d", "..@x.y", "(", ")", "555", "%"]
    texts = ["".join(rnd.choices(pieces, k=rnd.randint(0, 25))) for _ in range(400)]
    texts += [None, "", "9" * 30_000, "a" * 30_000 + "@", "1." * 5000, "+1" + "(" * 3000, ("x" * 50 + " ") * 2000 + "a@b.cd"]
    for t, r in zip(texts, run(spark, texts)):
        counts, names = plain(t)
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == counts
        assert r["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest()
        assert set(filter(None, r["spans"].split(","))) >= set(names)


def revealing():
    rnd = random.Random(4)
    filler = lambda n: " ".join(f"word{rnd.randrange(60):c<3}" for _ in range(n))
    texts = [f"{filler(12)} Blacksmith {filler(2)} jo@ex.org {filler(12)}" for _ in range(6)]
    texts += [f"{filler(10)} baker ann@ex.org {filler(10)}" for _ in range(5)] + [f"baker {filler(9)}" for _ in range(3)]
    return texts + [filler(20) for _ in range(200)] + ["carpenter zed@ex.org"] * 5


def test_terms_that_reveal_an_entity_become_spans(spark):
    texts = revealing()
    got = run(spark, texts)
    for t, r in zip(texts[:6], got):
        a = t.index("Blacksmith")
        assert f"term:{a}:{a + 10}" in r["spans"].split(",")
    assert all("term" not in r["spans"] for r in got[14:])  # no entity, or one text only
    actions = {
        texts[r["doc_id"]][s["start"] : s["end"]].lower(): s["action"]
        for r in p.find_private(spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)], DOCS)).collect()
        for s in r["all_spans"]
        if s["kind"] == "term"
    }
    assert actions["blacksmith"] == "remove" and actions["baker"] == "generalise"
    assert not any(w.startswith("word") for w in actions)


def test_sanitised_text(spark):
    texts = revealing()
    docs = spark.createDataFrame([(i, t, "", "") for i, t in enumerate(texts)] + [(None, None, "", "")], DOCS)
    out = p.sanitised(docs)
    assert out.schema == docs.schema and out.count() == len(texts) + 1
    got = {r["doc_id"]: r["text"] for r in out.collect()}
    assert "[term]" in got[0] and "[email]" in got[0] and "Blacksmith" not in got[0] and "jo@" not in got[0]
    assert "[...] [email]" in got[6] and got[100] == texts[100] and got[None] is None


def test_nulls_repeats_and_empty(spark):
    docs = spark.createDataFrame([(None, "a@b.c", "", "")] * 2 + [(1, None, "", "")], DOCS)
    assert sorted(r["spans"] for r in p.private_spans(docs).collect()) == ["", "email:0:5", "email:0:5"]
    assert p.private_spans(docs.limit(0)).collect() == []


def test_an_entity_in_one_text_has_terms_that_reveal_it(spark):
    rnd = random.Random(8)
    filler = lambda n: " ".join(f"word{rnd.randrange(60):c<3}" for _ in range(n))
    once = f"{filler(9)} Glassblower {filler(2)} kim@ex.org {filler(9)}"
    copied = f"{filler(9)} Falconer {filler(2)} lee@ex.org {filler(9)}"
    common = f"{filler(9)} Farmer {filler(2)} pat@ex.org {filler(9)}"
    texts = [once, common, *[copied] * 30, *[f"{filler(9)} farmer" for _ in range(20)]] + [filler(9) for _ in range(1400)]
    got = run(spark, texts)
    terms = lambda i: [texts[i][int(a) : int(b)] for k, a, b in (x.split(":") for x in got[i]["spans"].split(",")) if k == "term"]
    assert terms(0) == ["Glassblower"] and terms(1) == []
    assert all(terms(i) == ["Falconer"] for i in range(2, 32))
    assert not any("term" in r["spans"] for r in got[32:])
