"""Operator 7: formats, coreference, distinctness, gender, and texts around entities."""
import random
import re

import pytest
from pyspark.sql import functions as F

from tabulark.llm import pii
from tabulark.llm.pii import FEMALE, MALE, replace_pii, surrogate_collisions


def run(spark, texts, key="k"):
    df = spark.createDataFrame([(i, t, "z", 1) for i, t in enumerate(texts)], "doc_id long, text string, pii string, _row int")
    return {r.doc_id: r for r in replace_pii(df, key).collect()}


def shape(s):
    return re.sub("[a-z]", "a", re.sub("[A-Z]", "A", re.sub(r"\d", "0", s)))


def luhn(d):
    t = [int(c) for c in d[::-1]]
    return (sum(t[::2]) + sum(sum(divmod(2 * x, 10)) for x in t[1::2])) % 10


def test_entities_and_formats(spark):
    e = ["joe.92@mail2.example.com", "+1 (499) 555-6503", "172.242.194.228", "4432507379035540", "4111 1111 1111 1111",
         "078-05-1120", "(212) 555-0199", "6df57b16f87eabefefcab67b433efd90636bb6bd", "GB82WEST12345698765432"]
    texts = [f"Before {x}, after the 2 of them." for x in e]
    out = run(spark, texts)
    for i, x in enumerate(e):
        r = out[i]
        assert [p.original for p in r.pii] == [x], (x, r.pii)
        new = r.pii[0].surrogate
        assert r.text == texts[i].replace(x, new) and new != x and r._row == 1
        if r.pii[0].kind != "ip":
            assert shape(new) == shape(x)
    assert out[0].pii[0].surrogate.endswith(".com") and out[1].pii[0].surrogate.startswith("+1 (")
    assert all(0 <= int(p) < 256 for p in out[2].pii[0].surrogate.split("."))
    for i in (3, 4):
        old, new = (re.sub(r"\D", "", x) for x in (e[i], out[i].pii[0].surrogate))
        assert luhn(old) == luhn(new)


def test_coreference(spark):
    out = run(spark, ["a Joe.X@Mail.com and joe.x@mail.com", "+1 (499) 555-6503 or +1 499-555-6503", "4111 1111 1111 1111 = 4111111111111111"])
    for i in (0, 1, 2):
        a, b = (p.surrogate.lower() for p in out[i].pii)
        assert re.sub(r"[^a-z0-9@.]" if i == 0 else r"\D", "", a) == re.sub(r"[^a-z0-9@.]" if i == 0 else r"\D", "", b)
    assert run(spark, ["joe@a.com"], "other")[0].text != run(spark, ["joe@a.com"])[0].text


def test_names(spark):
    out = run(spark, ["Yesterday Mary Smith met John Smith.", "Dear Mr. Tanaka and Frau Weiß, hello", 'token = "6df57b16f87e" password: hunter2xyz'])
    m = re.fullmatch(r"Yesterday (\w+) (\w+) met (\w+) (\w+)\.", out[0].text)
    assert m[1] in FEMALE and m[1] != "Mary" and m[3] in MALE and m[3] != "John"
    assert m[2] == m[4] and m[2] != "Smith" and m[2][0].isupper() and m[2][1:].islower()
    assert out[1].text.startswith("Dear Mr. ") and "Tanaka" not in out[1].text and "Weiß" not in out[1].text and out[1].text.endswith(", hello")
    assert out[2].text.startswith('token = "') and "6df57b16f87e" not in out[2].text and "hunter2xyz" not in out[2].text


def test_distinct(spark):
    rnd = random.Random(1)
    texts = [f"{rnd.choice('abc')}{i % 100}@x.org {i:03d}-11-2222 10.0.{i % 256}.{i // 256}" for i in range(900)]
    df = replace_pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), "k")
    assert surrogate_collisions(df).collect() == []
    seen = {}
    for r in df.collect():
        assert len(r.pii) == 3
        for p in r.pii:
            assert seen.setdefault((p.kind, p.original), p.surrogate) == p.surrogate
    assert len({(k, s) for (k, _), s in seen.items()}) == len(seen)


def test_edges(spark):
    out = run(spark, [None, "", "no entity 12", "a@b.com", "x " * 50000 + "a@b.com"])
    assert out[0].text is None and out[0].pii == [] and out[1].text == "" and out[2].text == "no entity 12" and out[2].pii == []
    assert out[3].text != "a@b.com" and len(out[3].text) == 7 and out[4].text.startswith("x x ") and "a@b.com" not in out[4].text
    assert replace_pii(spark.createDataFrame([], "doc_id long, text string"), "k").collect() == []
    plan = replace_pii(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "k")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_one_phone_in_any_format(spark):
    same = [["+14995556503", "+1 499 555 6503", "+1 (499) 555-6503", "+1499 555 6503"], ["+358401234567", "+358 40 123 4567", "+3 58 401 2345 67"],
            ["(212) 555-0199", "212-555-0199", "212.555.0199"], ["+212 555 0199", "+2125550199"]]
    out = run(spark, [" or ".join(x) for x in same])
    made = []
    for i, x in enumerate(same):
        assert [p.original for p in out[i].pii] == x
        new = {(p.surrogate[0] == "+", re.sub(r"\D", "", p.surrogate)) for p in out[i].pii}
        assert len(new) == 1
        made.append(new.pop())
    assert [d[:k] for (_, d), k in zip(made, (1, 3, 0, 3))] == ["1", "358", "", "212"] and len(set(made)) == 4


def test_listed_names_and_hexadecimal_are_kept_apart(spark, monkeypatch):
    """A word never becomes a first name of the list, a secret that is not hexadecimal never one that is."""
    monkeypatch.setattr(pii, "FEMALE", tuple("ABCDEFGHIJKLM"))
    monkeypatch.setattr(pii, "MALE", ("Zo",))
    words = [chr(c) for c in range(65, 91)]
    df = spark.createDataFrame([(w,) for w in words], "m string")
    got = {r.m: r.s for r in df.select("m", pii._name(F.col("m"), "k").alias("s")).collect()}
    assert len(set(got.values())) == 26 and {got[w] for w in words[:13]} == set(words[:13])
    values = [a + b for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnopqrstuvwxyz"]
    df = spark.createDataFrame([("token=" + v,) for v in values], "m string")
    got = {r.m[6:]: r.s[6:] for r in df.select("m", pii.surrogate(F.col("m"), F.lit("secret"), "k").alias("s")).collect()}
    is_hex = lambda v: set(v) <= set("abcdef")
    assert len(set(got.values())) == 26 * 26 and all(is_hex(a) == is_hex(b) for a, b in got.items())


def test_check_on_the_main_path(spark, monkeypatch, tmp_path):
    schema = "doc_id long, text string, pii array<struct<kind:string,original:string,surrogate:string>>"
    good = [("ip", "1.2.3.4", "9.9.9.9"), ("ip", "01.2.3.4", "9.9.9.9"), ("mail", "A@b.com", "x@b.com")]
    pii.check_surrogates(spark.createDataFrame([(1, "", good)], schema))
    with pytest.raises(ValueError, match="ip: 1 x surrogate with several entities"):
        pii.check_surrogates(spark.createDataFrame([(1, "", good), (2, "", [("ip", "1.2.3.5", "9.9.9.9")])], schema))
    with pytest.raises(ValueError, match="mail: 1 x entity with several surrogates"):
        pii.check_surrogates(spark.createDataFrame([(1, "", good), (2, "", [("mail", "a@B.com", "y@b.com")])], schema))
    import corpus_pipeline
    from tabulark.llm import queries
    spark.createDataFrame([(1, "mail a@b.com"), (2, "mail c@b.com")], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert queries.op7(spark, str(tmp_path)).count() == 2 and corpus_pipeline.personal_data(spark, docs, str(tmp_path)).count() == 2
    monkeypatch.setattr(pii, "surrogate", lambda m, kind, key: F.lit("z@b.com"))
    for run_it in (lambda: queries.op7(spark, str(tmp_path)), lambda: corpus_pipeline.personal_data(spark, docs, str(tmp_path))):
        with pytest.raises(ValueError, match="mail: 1 x surrogate with several entities"):
            run_it()


def test_more_forms(spark):
    found = ["Password: hunter2xyz", "API_KEY=Abcdef123", "Api-Key: Abcdef123", "PASSWORD = 'Abcdef123", "господин Иванов", "Госпожа Анна Петрова",
             "κ. Παπαδόπουλος", "Signora Rossi", "+49 30/1234 5678", "+1\u00a0499\u00a0555\u00a06503", "499 555 6503", "01 23 45 67 89", "030/1234567"]
    kinds = ["secret"] * 4 + ["name"] * 4 + ["phone"] * 5
    none = ["on 08.12.2020 or 08/12/2020", "in 0.125 of 10 000 000", "12 100 200 3000", "the secretary: somebody", "маг-н Иванов"]
    out = run(spark, [f"x {x}, y" for x in found] + ["DB_PASSWORD=hunter2xyz"] + none)
    for i, (x, kind) in enumerate(zip(found, kinds)):
        assert [(p.kind, p.original) for p in out[i].pii] == [(kind, x)] and x not in out[i].text, (x, out[i].pii)
    assert out[0].text.startswith("x Password: ") and out[4].text.startswith("x господин ") and out[13].text.startswith("DB_PASSWORD=")
    assert "hunter2xyz" not in out[13].text
    assert all(out[14 + i].text == t and out[14 + i].pii == [] for i, t in enumerate(none))
