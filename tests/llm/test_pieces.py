"""Operator 6 against the installed library, brute-force Viterbi and round trips."""
import itertools
import random

import pyarrow as pa
import pytest

from tabulark.llm.pieces import MARK, Vocabulary, _encoded, decode_pieces, encode_pieces

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


@pytest.fixture(scope="module")
def bpe():
    return Vocabulary.from_sentencepiece(open(MODEL, "rb").read())


def texts():
    rnd = random.Random(1)
    syllables = ["the", "and", "tion", "er", "ß", "ch", "é", "eau", "ción", "ñ", "st", "wh", "ing", "a", "I", "12", "z"]
    out = ["", " ", "  two  spaces ", "line\nbreak\t tab\r\n", "日本語 テキスト", "emoji 😀 end", "ﬁ ligature", "x" * 300, "a\x00b", "ａ full width",
           "http://www.example.com/a?b=c&d=%20", "don't stop", "3.14159 1,000,000", "\u0301 combining", "end "]
    for _ in range(200):
        out.append(rnd.choice([" ", "\n", ", "]).join("".join(rnd.choices(syllables, k=rnd.randint(1, 6))) for _ in range(rnd.randint(1, 30))))
    return out


def test_equals_the_library(bpe):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    for t, ids in zip(texts(), bpe.encode(texts())):
        assert ids.tolist() == sp.encode(t), t


def test_equals_the_library_on_documents(spark, bpe):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    rows = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    for t, ids in zip(rows, bpe.encode(rows)):
        assert ids.tolist() == sp.encode(t)


def test_round_trip(spark, bpe):
    rows = list(enumerate(texts())) + [(None, "null id"), (999, None), (3, "repeated"), (3, "repeated")]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, ids int")
    enc = encode_pieces(df, bpe, check=True)
    assert all(r.round_trip for r in enc.collect() if r.n_tokens is not None)
    back = sorted(((r.doc_id, r.text) for r in decode_pieces(enc, bpe).collect()), key=str)
    assert back == sorted(rows, key=str)
    assert encode_pieces(df.limit(0), bpe).collect() == []


def test_unigram_is_the_best_path():
    rnd = random.Random(2)
    pieces = [MARK, "a", "b", "ab", "ba", "aab", "abb", MARK + "a", MARK + "ab", "bab"]
    v = Vocabulary({p: (i, -rnd.random() * 5) for i, p in enumerate(pieces)}, {}, 99, set(), "unigram")
    words = sorted({MARK + "".join(rnd.choices("ab", k=rnd.randint(1, 8))) for _ in range(60)})
    for w, got in v.split(words):
        best = None
        for cuts in itertools.chain.from_iterable(itertools.combinations(range(1, len(w)), k) for k in range(len(w))):
            parts = [w[i:j] for i, j in zip((0, *cuts), (*cuts, len(w)))]
            if all(p in v.scores for p in parts):
                s = sum(v.scores[p][1] for p in parts)
                best = s if best is None else max(best, s)
        assert abs(sum(v.scores[p][1] for p in got) - best) < 1e-9


def test_round_trip_decodes_every_piece():
    """A known piece with wrong bytes shows in the rows that have it."""
    v = Vocabulary.from_sentencepiece(open(MODEL, "rb").read())
    rows = ["the end", "of the day", "12"]
    v.pieces = {**v.pieces, int(v.encode(["the"])[0][0]): b"wrong"}
    batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2]), pa.array(rows)], names=["doc_id", "text"])
    assert [b for out in _encoded(v, True)(iter([batch])) for b in out.column("round_trip").to_pylist()] == [False, False, True]
