"""Operator 11 against scoring every document for every item."""
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tabulark.llm import lexical_search
from tabulark.llm.lexical_search import Best, Block, _index, _words, lexical_topk, search_block

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    N, L = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    asked = {}
    for item, text in set(items):
        if text is not None:
            asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, q in asked.items():
        scored = []
        for i, c in counts:
            m = 75 + 25 * sum(c.values()) * N // L
            s = sum(n * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * (1_000_000_000 * c[t] // (1000 * c[t] + 12 * m))
                    for t, n in q.items() if t in c)
            if s > 0:
                scored.append((-s, i is None, i, s))
        scored.sort(key=lambda x: (x[0], x[1], x[2] or 0))
        out += [(item, r, x[2], x[3]) for r, x in enumerate(scored[:k], 1)]
    return sorted(out, key=str)


def fixture(seed=1, n=400):
    rnd = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)] + ["É", "été", "日本", "X9"]
    weights = [1 / (i + 1) for i in range(len(vocab))]
    docs = [(i, rnd.choice([" ", "_", "\n", ", "]).join(rnd.choices(vocab, weights, k=rnd.randint(1, 40)))) for i in range(n)]
    docs += [(None, "w1 w2 w3"), (None, "w50"), (7, "w7 w7 w8"), (7, "w7 w7 w8"), (900, None), (901, ""), (902, "-- !!"), (903, "W40 " * 3000)]
    docs += [(1000 + i, docs[3][1]) for i in range(150)]                    # ties
    items = [(i, " ".join(rnd.choices(vocab, k=rnd.randint(1, 30)))) for i in range(12)]
    items += [(100, "w1 w1 w40"), (101, "absent"), (102, None), (103, ""), (None, "w5 w6"), (104, "w9 w10"), (104, "w9 w10"), (104, "w11"),
              (105, " ".join(vocab * 2))]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_equals_scoring_everything(spark, monkeypatch, small):
    if small:        # many blocks of items, documents and bits
        monkeypatch.setattr(lexical_search, "ITEM_PAIRS", 40)
        monkeypatch.setattr(lexical_search, "BLOCK_DOCS", 16)
        monkeypatch.setattr(lexical_search, "BITS_AT_ONCE", 64)
        monkeypatch.setattr(lexical_search, "SLICE_BYTES", 64)
    docs, items = fixture()
    got = lexical_topk(spark.createDataFrame([(*d, "s", 1) for d in docs], "doc_id long, text string, score string, rank int").repartition(5),
                       spark.createDataFrame([(*i, 2) for i in items], "item_id long, text string, doc_id int"), 20)
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, 20)


def test_groups_are_left_out_only_when_safe():
    """Fewer documents are evaluated than match, and the list is the same."""
    import pyarrow as pa
    rnd = random.Random(5)
    docs = [f"rare{i % 7} common" if i < 40 else "common " + " ".join(f"x{rnd.randint(0, 30)}" for _ in range(5)) for i in range(5000)]
    vocabulary = {t.encode(): i for i, t in enumerate(["common", "rare3", "x1", "x2"])}
    batch = pa.RecordBatch.from_arrays([pa.array(range(5000)), pa.array([d.encode() for d in docs])], names=["doc_id", "text"])
    (out,) = _index(vocabulary)(iter([batch]))
    block = Block(out.column("blob")[0].as_py(), 5000, sum(len(d.split()) for d in docs))
    value, scratch = np.array([1, 5000, 700, 700], np.int64), np.zeros(4, np.int64)
    best = Best(5)
    seen = search_block(block, np.arange(4), value, scratch, best)
    scores = block.scores(np.arange(5000), value)
    order = np.lexsort((block.ids, -scores))[:5]
    assert best.ids.tolist() == block.ids[order].tolist() and best.score.tolist() == scores[order].tolist()
    assert seen < 500 and not scratch.any()


def test_slices_end_between_terms(monkeypatch):
    monkeypatch.setattr(lexical_search, "SLICE_BYTES", 10)
    text = "Abc-def  " * 50 + "z" * 95 + " end É"
    assert [w for part in _words(text.encode()) for w in part] == [t.encode() for t in terms(text)]


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    ask = spark.createDataFrame([(1, "b"), (2, "--")], "item_id long, text string")
    assert lexical_topk(docs, items).collect() == [] and lexical_topk(docs, ask).collect() == [] and lexical_topk(one, items).collect() == []
    assert [tuple(r)[:3] for r in lexical_topk(one, ask).collect()] == [(1, 1, 1)]
