"""Operator 12 against the public library, plain merging and round trips."""
import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabulark.llm import byte_bpe
from tabulark.llm.byte_bpe import ByteBpe, Editable, decode_byte_bpe, encode_byte_bpe, ids_array, reencode_edits

PATH = P.path("byte_bpe_multi_50k.tiktoken")
ODD = ["", " ", "   ", "\n\n x", "don't we'll 'S", "日本語テキスト", "naïve café", "Привет, мир", "a\x00b", "😀😀 x", "x" * 3000, " \t\r\n", "1234567",
       "՘b ࢏1", "  trailing  ", "été's", "'re're", "   z", "<|endoftext|>"]


@pytest.fixture(scope="module")
def bpe():
    return ByteBpe.from_file(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(bpe):
    import tiktoken
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=bpe.ranks, special_tokens={})


def ids_of(blob):
    return np.frombuffer(blob, "<u4").tolist()


def test_equals_the_library_on_documents(spark, bpe, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for r in encode_byte_bpe(docs.withColumn("t", F.col("text")), bpe, decoded=True).collect():
        assert ids_of(r.ids) == library.encode_ordinary(r.doc.t) and r.n_tokens == len(r.ids) // 4
        assert bytes(r.decoded) == r.doc.t.encode()


def test_equals_the_library_on_odd_texts(bpe, library):
    for t in ODD:
        assert ids_of(bpe.encode(t)) == library.encode_ordinary(t), t


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_equals_the_library_on_any_text(bpe, library, t):
    assert ids_of(bpe.encode(t)) == library.encode_ordinary(t)
    assert bpe.decode(bpe.encode(t)) == t.encode()


def test_tables_equal_merging_for_every_prefix(bpe):
    rnd = random.Random(3)
    tokens = sorted(bpe.ranks)
    for _ in range(300):
        data = b"".join(rnd.choice(tokens) for _ in range(rnd.randint(1, 5)))
        last = bpe.extend(data, [-1])
        for end in range(1, len(data) + 1):
            want = [bpe.ranks[x] for x in bpe.merged(data[:end])]
            assert last[end] == want[-1]
            assert bpe.read(data[:end], last[:end + 1]) in (want, [bpe.ranks.get(data[:end])])


def test_a_vocabulary_in_any_order():
    """Tokens whose parts rank behind them, and tokens that merging never makes."""
    rnd = random.Random(9)
    for trial in range(60):
        words = {bytes([b]) for b in range(256)}
        words |= {bytes(rnd.choices(b"abc", k=rnd.randint(2, 4))) for _ in range(12)}
        order = sorted(words, key=lambda w: (len(w) > 1, rnd.random()))
        v = ByteBpe({w: i for i, w in enumerate(order)}, P.PATTERN)
        if not v.ordered:
            continue
        for _ in range(60):
            data = bytes(rnd.choices(b"abc", k=rnd.randint(1, 9)))
            want = [v.ranks[data]] if data in v.ranks else [v.ranks[x] for x in v.merged(data)]
            assert v.encode_match(data) == want, (order[256:], data)


@settings(max_examples=200, deadline=None)
@given(st.text(" abt's\n1é", max_size=30), st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30), st.text(" abt're\n1é", max_size=6)), max_size=5))
def test_edits_equal_encoding_anew(bpe, text, edits):
    e = Editable(bpe, text)
    for lo, size, new in edits:
        lo = min(lo, len(e.text))
        want = e.text[:lo] + new + e.text[lo + size:]
        e.replace(lo, lo + size, new)
        assert e.text == want and e.ids == ids_of(bpe.encode(want))
        fresh = Editable(bpe, want)
        assert (e.starts, e.codes) == (fresh.starts, fresh.codes)


def test_an_append_only_adds_to_the_table(bpe, monkeypatch):
    e = Editable(bpe, "word " * 2000)
    e.append("anti").append("dis")
    built = []
    old = ByteBpe.extend
    monkeypatch.setattr(ByteBpe, "extend", lambda self, data, last: built.append((len(last), len(data))) or old(self, data, last))
    e.append("establish")
    assert built == [(len(" antidis") + 1, len(" antidisestablish"))] and e.kept == 2000
    assert e.ids == ids_of(bpe.encode(e.text))


def test_edits_in_a_table(spark, bpe):
    docs = spark.createDataFrame([(1, "one two three"), (2, ""), (3, None), (None, "x" * 50), (5, "say 'hello' twice")], "doc_id long, text string")
    encoded = encode_byte_bpe(docs.withColumn("t", F.col("text")), bpe).select("doc.doc_id", F.col("doc.t").alias("text"), "ids")
    edits = encoded.withColumns({"lo": F.lit(4), "hi": F.when(F.col("doc_id") != 5, 7), "new": F.lit("2 or é"), "ids2": F.lit(1)})
    got = {r.doc.doc_id: r for r in reencode_edits(edits, bpe).collect()}
    assert got[1].text == "one 2 or é three" and got[2].text == "2 or é" and got[3].text == "2 or é" and got[5].text == "say 2 or é"
    assert all(ids_of(r.ids) == ids_of(bpe.encode(r.text)) and r.n_tokens == len(r.ids) // 4 and r.doc.ids2 == 1 for r in got.values())
    assert got[1].n_kept == 1                    # ' three'


def test_query_columns(spark, library):
    from tabulark.llm import queries
    got = {r.doc_id: r for r in queries.op12(spark, "/root/testdata/sf0.001").collect()}
    for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect():
        ids = np.array(library.encode_ordinary(r.text), "<u4")
        g = got[r.doc_id]
        assert (g.n_tokens, g.ids_sha256) == (len(ids), hashlib.sha256(ids.tobytes()).hexdigest())
        assert g.decoded_sha256 == hashlib.sha256(r.text.encode()).hexdigest()
    assert len(got) == 200


def test_nulls_copies_bytes_clashing_names_and_empty_tables(spark, bpe):
    rows = [(1, "a b", 7, 8), (1, "a b", 7, 8), (None, "z", 1, None), (4, None, None, None), (5, "", 0, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int, n_tokens int")
    out = encode_byte_bpe(docs, bpe, decoded=True)
    got = sorted(out.select("doc.doc_id", "doc.ids", "n_tokens", ids_array(F.col("ids")).alias("a")).collect(), key=str)
    assert sorted(str((r.doc_id, r.n_tokens, list(r.a))) for r in got) == sorted(
        str((i, len(ids_of(bpe.encode(t))), ids_of(bpe.encode(t)))) for i, t, *_ in rows)
    back = decode_byte_bpe(out.select("doc.doc_id", "ids"), bpe)
    assert sorted((bytes(r.decoded) for r in back.collect())) == [b"", b"", b"a b", b"a b", b"z"]
    assert encode_byte_bpe(docs.limit(0), bpe).collect() == []
    raw = b"ok \xff\xfe\x80 end"
    assert bpe.decode(bpe.encode(raw)) == raw


def test_long_texts_and_a_small_cache(bpe, library, monkeypatch):
    rnd = random.Random(4)
    long = " ".join("".join(rnd.choices("abcdeé", k=rnd.randint(1, 9))) for _ in range(40_000)) + "q" * 20_000
    want = library.encode_ordinary(long)
    assert ids_of(bpe.encode(long)) == want
    monkeypatch.setattr(byte_bpe, "CACHE_BYTES", 64 << 10)
    small = ByteBpe(bpe.ranks, P.PATTERN, (bpe.left, bpe.right))
    assert ids_of(small.encode(long)) == want and small.words.size <= 64 << 10
