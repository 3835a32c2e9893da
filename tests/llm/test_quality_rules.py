"""Operator 2: base counts against brute force, and the line rules."""
import random
import re

from tabulark.llm.quality_rules import quality_rules

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(t):
    t = t or ""
    w = WORD.findall(t)
    lines = [x for x in t.split("\n") if WORD.search(x)]
    grams = {}
    for i in range(len(w) - 2):
        grams.setdefault(tuple(w[i:i + 3]), []).append(i)
    at = set()
    for v in grams.values():
        if len(v) > 1:
            at.update(j + k for j in v for k in range(3))
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(at))


def test_base_counts(spark):
    rnd = random.Random(1)
    words = ["a", "b", "über", "x#y", "<b>", "é", " ", "z z", "😀"]
    texts = [None, "", " \t\n\x0b\x0c\r", "a", "a a", "a a a", "a a a a", "\n\na b\n a b\na b"]
    texts += ["".join(rnd.choice(words) + rnd.choice([" ", "\n", "  ", "\t", "\r\n", "\x0b"]) for _ in range(rnd.randint(1, 80))) for _ in range(150)]
    df = spark.createDataFrame([(i, t, 1, "q") for i, t in enumerate(texts)] + [(None, "a", 1, "q")], "doc_id long, text string, row int, quality string")
    out = {r.doc_id: r.quality for r in quality_rules(df).collect()}
    assert len(out) == len(texts) + 1
    for i, t in enumerate(texts):
        q = out[i]
        assert (q.n_words, q.word_chars, q.n_symbols, q.n_dup_lines, q.n_repeat_words) == brute(t), (t, q)
        n, _, _, _, r = brute(t)
        assert q.base_failed == (n < 50 or 100 * r > 50 * n)
        assert not (q.base_failed and q.kept)


def prose(rnd, n):
    return " ".join("".join(rnd.choices("abcdefgh", k=rnd.randint(2, 7))) for _ in range(n)) + "."


def test_line_rules(spark):
    rnd = random.Random(2)
    good = "\n".join(prose(rnd, 15) for _ in range(8))
    bad = {"menu": " | ".join("abc def" for _ in range(9)), "symbols": " ".join(prose(rnd, 1) + "***" for _ in range(30)),
           "shout": "THIS IS A BANNER!! OF!! MARKS!!", "banner": "BUY OUR THINGS TODAY", "stock": "All rights reserved by us.",
           "repeat": "word " * 40}
    rows = [(0, good)] + [(i + 1, good + "\n" + b) for i, b in enumerate(bad.values())]
    rows += [(20, good + "\n" + "\n".join(" ".join(prose(rnd, 1) + "%%%" for _ in range(60)) for _ in range(9))), (21, good + "\n" + good.split("\n")[0])]
    out = {r.doc_id: r.quality for r in quality_rules(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out[0].kept and out[0].removed == 0 and out[0].clean_text == good
    for i in range(len(bad)):
        assert out[i + 1].removed == 1 and out[i + 1].clean_text == good, list(bad)[i]
        assert out[i + 1].kept == (list(bad)[i] not in ("symbols",) or out[i + 1].lost_chars * 100 <= 30 * out[i + 1].chars)
    assert not out[20].kept and not out[20].base_failed
    assert out[21].removed == 1 and out[21].clean_text == good
    assert quality_rules(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_native_plan(spark):
    df = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = quality_rules(df)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
