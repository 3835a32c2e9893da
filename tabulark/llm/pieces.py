"""Operator 6: encoding to vocabulary pieces and back, sharing prefixes between words.

A text becomes marked words: every space turns into the mark U+2581, one more goes
in front, and a word is a run of marks with the letters behind it (no piece of the
vocabularies used has a mark behind a letter, so no piece crosses words). The
distinct words of a block of texts are sorted, which makes them the leaves of a
trie in depth-first order; the forward table of a prefix is kept on a stack and
reused by every word that continues it. Two kinds of vocabulary are read:

* ``unigram``: the forward score of a prefix is the best sum of piece scores
  (Viterbi); a word takes the path behind its last score.
* ``bpe``: pieces are ranked merges, and a best sum would not give the
  vocabulary's own encoding. The forward state of a prefix is its last piece in that
  encoding: the one piece that ends there and is *compatible* with the last piece
  of what stands before it (merging the two pieces' letters gives the two pieces
  again). That is the same recursion over the same trie with one valid path, and
  equals merging pair by pair.

Characters outside the vocabulary become byte pieces, or the unknown piece if there
are none. Words are encoded once a block, with a bounded cache across blocks;
nothing is shuffled.

Defined results: a null text has null ids; an empty text has none; null document ids
pass through; repeated rows get equal results. Decoding inverts encoding but for a
literal U+2581 in a text, which comes back as a space.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "\u2581"
WORD = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+")
CACHE = 800_000
BLOCK_CHARS = 1 << 21


class Vocabulary:
    """Pieces with ids and scores, and how they split a marked word."""

    def __init__(self, scores: dict[str, tuple[int, float]], byte_ids: dict[int, int], unknown: int,
                 special: set[int], kind: str = "bpe"):
        self.scores, self.byte_ids, self.unknown, self.special, self.kind = scores, byte_ids, unknown, special, kind
        self.pieces: dict[int, bytes] = {i: p.encode() for p, (i, _) in scores.items()}
        self.pieces.update({i: bytes([b]) for b, i in byte_ids.items()})
        self.whole = any(MARK in p.lstrip(MARK) for p in scores)       # a piece that crosses words
        self.known = {p: i for p, (i, _) in scores.items()}
        self.rank = {p: -s for p, (_, s) in scores.items()}
        self.fits: dict[tuple[str, str], bool] = {}
        # pieces that merging makes of their own letters, and all of their endings
        self.made = scores if kind != "bpe" else {p for p in scores if len(p) == 1 or self._merged(p) == [p]}
        self.endings = {p[i:] for p in self.made for i in range(len(p))}
        self.cache: dict[str, tuple[int, ...]] = {}
        self.older: dict[str, tuple[int, ...]] = {}

    def __reduce__(self):
        # a worker that has had tasks of this vocabulary keeps it, with the words it knows
        return _kept, (self.digest(), self.scores, self.byte_ids, self.unknown, self.special, self.kind)

    def digest(self) -> str:
        import hashlib
        return hashlib.sha256(repr((sorted(self.scores.items()), sorted(self.byte_ids.items()), self.unknown,
                                    sorted(self.special), self.kind)).encode()).hexdigest()

    @classmethod
    def from_sentencepiece(cls, model: bytes, kind: str = "bpe") -> Vocabulary:
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        scores, byte_ids, special = {}, {}, set()
        for i in range(sp.get_piece_size()):
            if sp.is_byte(i):
                byte_ids[int(sp.id_to_piece(i)[3:5], 16)] = i
            elif sp.is_control(i) or sp.is_unknown(i):
                special.add(i)
            elif not sp.is_unused(i):
                scores[sp.id_to_piece(i)] = (i, sp.get_score(i))
        return cls(scores, byte_ids, sp.unk_id(), special, kind)

    # -- encoding --

    def _merged(self, text: str) -> list[str]:
        """Merging pair by pair, the best ranked and leftmost first (short strings)."""
        parts, rank = list(text), self.rank
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def _compatible(self, left: str, right: str) -> bool:
        ok = self.fits.get((left, right))
        if ok is None:
            if len(self.fits) > 2_000_000:
                self.fits.clear()
            ok = self.fits[left, right] = self._merged(left + right) == [left, right]
        return ok

    def split(self, words: list[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, pieces) of ascending distinct words; a character without a piece stands alone."""
        scores, made, endings, bpe = self.scores, self.made, self.endings, self.kind == "bpe"
        fits, compatible = self.fits, self._compatible
        starts: list[int] = [0]                  # by prefix length: where its last piece starts
        totals: list[float] = [0.0]              # by prefix length: forward score (unigram)
        worst = min((s for _, s in scores.values()), default=0.0) - 10
        before = ""
        for w in words:
            same, n = 0, min(len(before), len(w))
            while same < n and before[same] == w[same]:
                same += 1
            del starts[same + 1:], totals[same + 1:]
            for end in range(same + 1, len(w) + 1):
                at = pick = end - 1
                ends = []                        # starts of the pieces that end here
                while at >= 0:
                    piece = w[at:end]
                    if piece not in endings:
                        break
                    if piece in made:
                        ends.append(at)
                    at -= 1
                if bpe:
                    for at in reversed(ends):
                        if at == 0 or w[at - 1] not in scores:
                            pick = at
                            break
                        pair = w[starts[at]:at], w[at:end]
                        ok = fits.get(pair)
                        if compatible(*pair) if ok is None else ok:
                            pick = at
                            break
                else:
                    score = totals[pick] + (worst if not ends or ends[0] != pick else scores[w[pick:end]][1])
                    for at in ends:
                        t = totals[at] + scores[w[at:end]][1]
                        if t > score:
                            pick, score = at, t
                    totals.append(score)
                starts.append(pick)
            pieces, end = [], len(w)
            while end:
                pieces.append(w[starts[end]:end])
                end = starts[end]
            before = w
            yield w, pieces[::-1]

    def _ids(self, piece: str) -> list[int]:
        known = self.scores.get(piece)
        if known:
            return [known[0]]
        return [self.byte_ids[b] for b in piece.encode("utf-8", "surrogatepass")] if self.byte_ids else [self.unknown]

    def marked(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARK + text.replace(" ", MARK)
        return [marked] if self.whole else WORD.findall(marked)

    def encode(self, texts: list[str | None]) -> list[np.ndarray | None]:
        docs = [None if t is None else self.marked(t) for t in texts]
        if len(self.cache) > CACHE // 2:         # the words not seen for a while go
            self.older, self.cache = self.cache, {}
        cache, older, known = self.cache, self.older, self.known
        new = []
        for w in set().union(*(d for d in docs if d)):
            if w not in cache:
                ids = older.get(w)
                if ids is None:
                    new.append(w)
                else:
                    cache[w] = ids
        new.sort()
        for w, pieces in self.split(new):
            try:
                cache[w] = tuple([known[p] for p in pieces])
            except KeyError:                     # characters without a piece
                cache[w] = tuple(i for p in pieces for i in self._ids(p))
        get = cache.__getitem__
        return [None if d is None else np.fromiter(chain.from_iterable(map(get, d)), np.int32) for d in docs]

    # -- decoding --

    def text(self, ids) -> str:
        get, special = self.pieces.get, self.special
        ids = ids.tolist() if isinstance(ids, np.ndarray) else ids
        return b"".join([get(i, b"") for i in ids if i not in special]).decode("utf-8", "replace")

    def decode(self, ids) -> str:
        text = self.text(ids).replace(MARK, " ")
        return text[1:] if text.startswith(" ") else text


_KEPT: dict[str, Vocabulary] = {}


def _kept(digest: str, *args) -> Vocabulary:
    if digest not in _KEPT:
        _KEPT.clear()
        _KEPT[digest] = Vocabulary(*args)
    return _KEPT[digest]


def _blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, list]]:
    values = batch.column(column).to_pylist()
    lo = 0
    while lo < len(values):
        hi, size = lo, 0
        while hi < len(values) and (hi == lo or size < BLOCK_CHARS):
            size += len(values[hi] or ())
            hi += 1
        yield lo, values[lo:hi]
        lo = hi


def _encoded(vocabulary: Vocabulary, check: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, texts in _blocks(batch, "text"):
                ids = vocabulary.encode(texts)
                back = [None if i is None or not check else vocabulary.decode(i) == t for i, t in zip(ids, texts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(texts)), pa.array(ids, pa.list_(pa.int32())),
                     pa.array([None if i is None else len(i) for i in ids], pa.int64()), pa.array(back, pa.bool_())],
                    names=["doc_id", "ids", "n_tokens", "round_trip"])
    return run


def encode_pieces(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text",
                  check: bool = False) -> DataFrame:
    """``doc_id, ids, n_tokens`` and, with ``check``, whether the ids decode to the text."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(_encoded(vocabulary, check), f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean")


def decode_pieces(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``doc_id, text`` of encoded rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, ids in _blocks(batch, "ids"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(lo, len(ids)),
                     pa.array([None if i is None else vocabulary.decode(i) for i in ids], pa.string())], names=["doc_id", "text"])
    rows = encoded.select(F.col(id_col).alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
