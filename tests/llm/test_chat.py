import hashlib
import random

import pytest
from pyspark.sql import functions as F

from recordloom.llm import chat as c

TURNS = "conv_id long, turn long, role string, text string, window string, pos string"


def count_words(text):
    return F.size(F.split(text, " ")).cast("long")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], TURNS).repartition(3)


def plain(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted(
            ((t, r or "", x or "") for k, t, r, x in rows if k == conv), key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])
        )
        said = "".join(x for _, r, x in own if r == "assistant")
        turns = "".join(f"{r}\n{x}\n" for _, r, x in own)
        out[conv] = (len(own), hashlib.sha256(turns.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest())
    return out


def corpus():
    rnd = random.Random(3)
    bits = ["</s>", "[INST]", "[/INST]", "<s>", "<|turn|>", "<|end|>\n", "\\", "<\\|end|>", "[\\\\INST]", "é", "plain words here", "\n", "<", "|"]
    text = lambda: " ".join(rnd.choices(bits, k=rnd.randint(0, 12)))
    rows = []
    for conv in range(30):
        n = rnd.choice([1, 2, 5, 40])
        if rnd.random() < 0.5:
            rows.append((conv, 0, "system", text()))
        rows += [(conv, t + 1, rnd.choice(["user", "assistant", "tool|>", None]), rnd.choice([text(), None])) for t in range(n)]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    return rows + [rows[4]] * 2 + [(None, None, None, None), (500, 1, "assistant", "long " * 3000)]


@pytest.mark.parametrize("budget", [32, 160, 2048])
def test_round_trip(spark, budget):
    rows = corpus()
    windows = c.chat_windows(table(spark, rows), count_words, budget)
    got = {r["conv_id"]: tuple(r)[1:5] for r in c.read_back(windows).collect()}
    assert got == plain(rows)


def test_windows_respect_the_budget_and_mask_repeats(spark):
    rows = [(1, 0, "system", "rules")] + [(1, t, "assistant" if t % 2 else "user", f"say {t} " + "w " * (t % 5)) for t in range(1, 200)]
    got = c.chat_windows(table(spark, rows), count_words, 64).orderBy("window").collect()
    assert len(got) > 5
    for n, w in enumerate(got):
        turns = c.read_turns(w["text"])
        assert turns[0] == ("system", "rules") and w["n_tokens"] <= 64
        assert (w["n_repeated"] > 0) == (n > 0)
        fresh = [x for r, x in turns[w["n_repeated"] :] if r == "assistant"]
        assert [w["text"][s["start"] : s["end"]] for s in w["loss"]] == fresh
    assert any(w["n_repeated"] > 1 for w in got)


def test_control_strings_never_occur_in_texts(spark):
    text = "</s> <|end|> [INST] <\\|x"
    w = c.chat_windows(table(spark, [(1, 1, "user", text)]), count_words).first()["text"]
    body = w.split(c.TEXT)[1].removesuffix(c.END)
    assert not any(x in body for x in ("</s>", "<|", "[INST]")) and c.unescape(body) == text


def test_public_vocabulary_and_empty(spark):
    tokens = c.token_counter(spark)
    one = spark.createDataFrame([("hello world",)], "t string").select(tokens(F.col("t")).alias("n")).first()["n"]
    assert one == 2
    empty = c.chat_windows(table(spark, [(1, 1, "user", "x")]).limit(0), tokens)
    assert empty.collect() == [] and c.read_back(empty).collect() == []


def test_history_is_every_trailing_turn_that_fits(spark):
    rows = [(1, 0, "system", "rules")] + [(1, t, "user", f"say {t}") for t in range(1, 120)]
    long = [(2, 1, "user", "w " * 20)] + [(2, t, "user", "w " * 9) for t in range(2, 30)]
    got = c.chat_windows(table(spark, rows + long), count_words, 64).orderBy("conv_id", "window").collect()
    for n, w in enumerate(x for x in got if x["conv_id"] == 1):
        turns = c.read_turns(w["text"])[1:]
        assert n == 0 or w["n_repeated"] >= 1 + 2  # the system turn and at least two turns of history
        assert [int(t.split()[1]) for _, t in turns] == list(range(int(turns[0][1].split()[1]), int(turns[-1][1].split()[1]) + 1))
        assert w["n_tokens"] <= 64
    assert all(w["n_repeated"] >= 1 and w["n_tokens"] <= 64 for w in got if w["conv_id"] == 2 and w["window"])


def plain_windows(sizes, system, budget):
    """(repeated turns, fresh turns) of each window of one conversation, turn by turn."""
    out, start, skip = [], 0, 1 if system else 0
    while start < len(sizes):
        lead = sizes[0] if system and start else 0
        history = []
        for j in range(start - 1, skip - 1, -1):
            if history and sum(sizes[i] for i in history) + sizes[j] > budget // 4:
                break
            history.insert(0, j)
            if sum(sizes[i] for i in history) > budget // 4:
                break
        while history and lead + sum(sizes[i] for i in history) + sizes[start] > budget:
            history.pop(0)
        used, fresh = lead + sum(sizes[i] for i in history), [start]
        used += sizes[start]
        while fresh[-1] + 1 < len(sizes) and used + sizes[fresh[-1] + 1] <= budget:
            fresh.append(fresh[-1] + 1)
            used += sizes[fresh[-1]]
        out.append((history, fresh))
        start = fresh[-1] + 1
    return out


def test_spans_agree_with_a_turn_by_turn_choice():
    rnd = random.Random(9)
    for _ in range(500):
        sizes = [rnd.choice([1, 3, 7, 12, 20, 45, 90]) for _ in range(rnd.randint(1, 60))]
        system, budget = rnd.random() < 0.5, rnd.choice([16, 64, 100])
        got = c.choose_spans(sizes, 0, sizes[0] if system else 0, system, budget)
        assert [(list(range(a, s)), list(range(s, e))) for a, s, e in got] == plain_windows(sizes, system, budget)


def test_a_conversation_within_the_budget_is_one_window(spark):
    rows = [(k, t, "assistant" if t % 2 else "user", "w " * 8) for k in range(40) for t in range(k + 1)]
    got = c.chat_windows(table(spark, rows), count_words, 128).collect()
    sizes = {k: sum(w["n_tokens"] for w in got if w["conv_id"] == k) for k in range(40)}
    counts = {k: sum(w["conv_id"] == k for w in got) for k in range(40)}
    assert all((counts[k] == 1) == (sizes[k] <= 128) for k in range(40)) and counts[0] == 1 and counts[39] > 1


def test_a_long_conversation_is_spread_in_stretches(spark):
    rows = [(1, 0, "system", "rules")] + [(1, t, "assistant" if t % 2 else "user", f"say {t}") for t in range(1, 3000)]
    windows = c.chat_windows(table(spark, rows), count_words, 64)
    got = windows.orderBy("window").collect()
    assert len({w["window"] >> 32 for w in got}) > 10 and all(w["n_tokens"] <= 64 for w in got)
    assert sum(w["n_tokens"] > 56 for w in got) > 0.8 * len(got)  # nearly all are filled
    assert all(w["n_repeated"] > 2 for w in got[1:])  # history also across the borders
    assert {r["conv_id"]: tuple(r)[1:5] for r in c.read_back(windows).collect()} == plain(rows)
