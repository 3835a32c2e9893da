"""Operator 12: byte-level BPE by a table of unique last tokens.

A text is split by the vocabulary's pattern; each match is encoded by itself. Merging
pair by pair (lowest rank first, leftmost first) leaves every byte prefix of a match
with exactly one last token: the token that ends there and is *compatible* with the
last token of what stands before it, that is, no merge across their boundary comes
before the merges that made the two. So one table, the last token of each prefix,
holds the encodings of all prefixes:

* encoding reads the table backwards from the end;
* an append only adds entries, the ones there stay valid;
* an edit keeps the entries before it. Matches that end before the edit and those
  behind the first old boundary that is met again keep their tokens (``Editable``).

Whether two tokens are compatible is decided by undoing their merges, latest first,
and looking for an earlier merge across the boundary. If the vocabulary has a token
whose parts rank behind it, that order is not known and the pair is merged from bytes.
A match that is a token as a whole is that token, also where merging does not make it.

Texts are encoded where they are, nothing is shuffled. A worker keeps the words it has
met in a cache bounded by bytes; the vocabulary (checked to be below 64 MB) travels
with the tasks. Matches are taken in slices, so a very long text costs a few times its
own size; one match of n bytes costs a table of n entries.

Defined results: a null text counts as empty; an empty text has no ids; bytes that are
not UTF-8 pass through (each is a character that is no letter, digit or space);
repeated rows, null ids and ties need no care, as rows are independent; an empty table
gives an empty result. The columns of the input come back inside the struct ``doc``, so
no name can clash.
"""

from __future__ import annotations

import base64
from array import array
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from itertools import islice

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CACHE_BYTES = 96 << 20          # of known words, per worker
ENTRY_BYTES = 160               # bookkeeping of one of them
BLOCK_BYTES = 2 << 20           # of text a result batch
SLICE = 1 << 16                 # matches at once
MAX_VOCABULARY = 64 << 20       # bytes of tokens that may travel with the tasks

# Letters and digits assigned after Unicode 16, in natural order. The public
# library's tables end there, so its pattern takes them for other characters.
_LATER = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a\U00011db0-\U00011ddb"
    "\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686\U00016ea0-\U00016eb8"
    "\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda\U00018d09-\U00018d20"
    "\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128\U0001b168\U0001d6a6"
    "\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff\U0001e6c0-\U0001e6de"
    "\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4\U0001e6fe-\U0001e6ff"
    "\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479\U0003d000-\U0003fc3f")
LATER = regex.compile(f"[{_LATER}]")


class _LaterLetter(Exception):
    """A match holds a character that the pattern must not take for a letter or digit."""


class _Words(dict):
    """Match -> its ids as bytes; misses are encoded. Two generations share the bound."""

    def __init__(self, bpe: ByteBpe, careful: bool):
        self.bpe, self.careful, self.size, self.older = bpe, careful, 0, {}

    def __missing__(self, word: str) -> bytes:
        if not self.careful and LATER.search(word):
            raise _LaterLetter
        ids = self.older.get(word)
        if ids is None:
            ids = array("I", self.bpe.encode_match(word.encode("utf-8", "surrogateescape"))).tobytes()
        size = 4 * len(word) + len(ids) + ENTRY_BYTES
        if size <= CACHE_BYTES >> 6:
            if self.size + size > CACHE_BYTES >> 1:              # words not seen for a while go
                self.older = dict(self)
                self.clear()
                self.size = 0
            self[word] = ids
            self.size += size
        return ids


class ByteBpe:
    """Ranked byte tokens and a split pattern."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, splits: tuple[dict, dict] | None = None):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every single byte must be a token")
        if sum(map(len, ranks)) > MAX_VOCABULARY:
            raise ValueError("the vocabulary is too large to travel with the tasks")
        self.ranks, self.pattern = ranks, pattern
        self.tokens = {i: t for t, i in ranks.items()}
        self.longest = max(map(len, ranks))
        self.left, self.right = splits or self._split()
        # tokens that merging makes of their own bytes; only these stand in a table
        self.made = {t: i for t, i in ranks.items() if len(t) == 1 or i in self.left}
        self.ordered = all(max(self._time(self.left[i]), self._time(self.right[i])) < i for i in self.left)
        self.finder = ahocorasick.Automaton()
        for t, i in self.made.items():
            self.finder.add_word(t.decode("latin-1"), (i, len(t)))
        self.finder.make_automaton()
        self.pairs: dict[tuple[int, int], bool] = {}
        self.match = regex.compile(pattern)
        later = regex.escape(_LATER, special_only=True).replace("\\-", "-")
        # the same pattern with its letters and digits cut down
        self.careful = regex.compile(pattern.replace(r"[^\s\p{L}\p{N}]", rf"(?:[^\s\p{{L}}\p{{N}}]|[{later}])")
                                     .replace(r"\p{L}+", rf"(?:(?![{later}])\p{{L}})+").replace(r"\p{N}+", rf"(?:(?![{later}])\p{{N}})+"))
        self.words, self.careful_words = _Words(self, False), _Words(self, True)

    @classmethod
    def from_file(cls, path: str, pattern: str) -> ByteBpe:
        """A rank file: a token in base 64 and its rank on each line."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}, pattern)

    def __reduce__(self):
        # a worker that has had tasks of this vocabulary keeps it, with the words it knows
        return _kept, (hash_of(self.ranks, self.pattern), self.ranks, self.pattern, (self.left, self.right))

    # -- merges --

    def _time(self, i: int) -> int:
        return i if len(self.tokens[i]) > 1 else -1

    def merged(self, data: bytes) -> list[bytes]:
        """Merging pair by pair; for short strings, and the yardstick of the tests."""
        parts, rank = [data[i:i + 1] for i in range(len(data))], self.ranks
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                r = rank.get(parts[i] + parts[i + 1])
                if r is not None and (best is None or r < best):
                    best, at = r, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _split(self) -> tuple[dict[int, int], dict[int, int]]:
        """The two tokens whose merge makes each token, for those that merging makes."""
        left, right, ranks = {}, {}, self.ranks
        for token, i in ranks.items():
            if len(token) < 2:
                continue
            parts = [token[k:k + 1] for k in range(len(token))]
            while len(parts) > 2:
                best, at = None, -1
                for k in range(len(parts) - 1):
                    r = ranks.get(parts[k] + parts[k + 1])
                    if r is not None and (best is None or r < best):
                        best, at = r, k
                if best is None:
                    break
                parts[at:at + 2] = [parts[at] + parts[at + 1]]
            if len(parts) == 2:
                left[i], right[i] = ranks[parts[0]], ranks[parts[1]]
        return left, right

    def compatible(self, a: int, b: int) -> bool:
        """Whether the bytes of ``a`` and ``b`` together encode to ``[a, b]``."""
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= 1 << 18:
                self.pairs.clear()
            tokens = self.tokens
            if self.ordered:
                known = self._undo(a, b)
            else:
                known = self.merged(tokens[a] + tokens[b]) == [tokens[a], tokens[b]]
            self.pairs[a, b] = known
        return known

    def _undo(self, a: int, b: int) -> bool:
        ranks, tokens = self.ranks, self.tokens
        before = 1 << 62                         # a merge across the boundary counts if its rank is below
        while True:
            across = ranks.get(tokens[a] + tokens[b])
            if across is not None and across < before:
                return False
            when_a, when_b = self._time(a), self._time(b)
            if when_a > when_b:                  # of equal ranks the left merge came first
                before, a = when_a, self.right[a]
            elif when_b >= 0:
                before, b = when_b + 1, self.left[b]
            else:
                return True

    # -- one match --

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Add to ``last`` (last[i]: the last token of the first i bytes) up to the end of ``data``."""
        pairs, compatible, done = self.pairs, self.compatible, len(last) - 1
        base = max(0, done - self.longest)
        # all tokens that end at a byte, the longest first, byte by byte
        for end, (token, size) in self.finder.iter(data[base:].decode("latin-1")):
            end += base + 1
            if end <= done:
                continue
            at = end - size
            if at:
                fits = pairs.get((last[at], token))
                if not (compatible(last[at], token) if fits is None else fits):
                    continue
            last.append(token)
            done = end
        return last

    def read(self, data: bytes, last: list[int]) -> list[int]:
        """The ids of ``data`` from its table."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        out, end, tokens = [], len(data), self.tokens
        while end:
            out.append(last[end])
            end -= len(tokens[last[end]])
        return out[::-1]

    def encode_match(self, data: bytes) -> list[int]:
        whole = self.ranks.get(data)
        return [whole] if whole is not None else self.read(data, self.extend(data, [-1]))

    # -- texts --

    def _joined(self, found: Iterator[str], words: _Words) -> bytes:
        parts = []
        while part := b"".join(map(words.__getitem__, islice(found, SLICE))):
            parts.append(part)
        return b"".join(parts)

    def matches(self, text: str, careful: bool = False, at: int = 0) -> Iterator[str]:
        pattern = self.careful if careful else self.match
        if len(text) <= SLICE and at == 0:
            return iter(pattern.findall(text))
        return (m.group() for m in pattern.finditer(text, at))

    def encode(self, data: bytes | str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        text = data if isinstance(data, str) else (data or b"").decode("utf-8", "surrogateescape")
        try:
            return self._joined(self.matches(text), self.words)
        except _LaterLetter:
            return self._joined(self.matches(text, True), self.careful_words)

    def decode(self, ids: bytes | np.ndarray) -> bytes:
        ids = np.frombuffer(ids, "<u4") if isinstance(ids, bytes) else ids
        get = self.tokens.__getitem__
        return b"".join(b"".join(map(get, ids[lo:lo + SLICE].tolist())) for lo in range(0, len(ids), SLICE))


def hash_of(ranks: dict[bytes, int], pattern: str) -> str:
    import hashlib
    h = hashlib.sha256(pattern.encode())
    for token, i in ranks.items():
        h.update(b"%d %d " % (i, len(token)) + token)
    return h.hexdigest()


_KEPT: dict[str, ByteBpe] = {}


def _kept(digest: str, *args) -> ByteBpe:
    if digest not in _KEPT:
        _KEPT.clear()
        _KEPT[digest] = ByteBpe(*args)
    return _KEPT[digest]


class Editable:
    """A text with its encoding that follows appends and edits.

    ``kept`` counts the matches whose tokens the last change left as they were. A match
    depends on the text up to one character behind it, so those that end two characters
    before an edit stay; behind the edit, matches stay from the first old boundary on that
    the new ones meet. The table of a match is built once and reused up to the edit.
    """

    def __init__(self, bpe: ByteBpe, text: str = "", ids: Iterable[int] | None = None):
        self.bpe, self.text, self.kept = bpe, text, 0
        self.starts: list[int] = []              # of the matches, in characters
        self.codes: list[list[int]] = []         # ids of each match
        self.tables: dict[int, tuple[bytes, list[int]]] = {}     # by start: bytes and table of recent matches
        given = None if ids is None else iter(ids)
        at = 0
        for m in self._matches(0):
            data = m.encode("utf-8", "surrogateescape")
            if given is None:
                code = bpe.encode_match(data)
            else:
                code, size = [], 0
                while size < len(data):
                    code.append(next(given))
                    size += len(bpe.tokens[code[-1]])
            self.starts.append(at)
            self.codes.append(code)
            at += len(m)

    def _matches(self, at: int) -> Iterator[str]:
        return self.bpe.matches(self.text, bool(LATER.search(self.text)), at)

    @property
    def ids(self) -> list[int]:
        return [i for code in self.codes for i in code]

    def append(self, more: str) -> Editable:
        return self.replace(len(self.text), len(self.text), more)

    def replace(self, lo: int, hi: int, new: str) -> Editable:
        """``text[lo:hi]`` becomes ``new``."""
        lo, hi = max(0, min(lo, len(self.text))), max(0, min(hi, len(self.text)))
        hi = max(lo, hi)
        careful = bool(LATER.search(self.text))
        self.text = self.text[:lo] + new + self.text[hi:]
        if careful != bool(LATER.search(self.text)):             # the split changes everywhere
            fresh = Editable(self.bpe, self.text)
            self.starts, self.codes, self.tables, self.kept = fresh.starts, fresh.codes, {}, 0
            return self
        # the first match that may see the edit, and where it starts
        first = max(0, bisect_left(self.starts, max(0, lo - 1)) - 1)
        at = self.starts[first] if self.starts else 0
        shift = len(new) - (hi - lo)
        starts, codes, tables = [], [], {s: t for s, t in self.tables.items() if s < at}
        resume = len(self.starts)
        for m in self._matches(at):
            old = bisect_left(self.starts, at - shift)
            if at >= lo + len(new) and old < len(self.starts) and self.starts[old] == at - shift and at - shift >= hi:
                resume = old
                break
            data = m.encode("utf-8", "surrogateescape")
            known, last = self.tables.get(at, (b"", [-1]))
            same = 0
            while same < min(len(known), len(data)) and known[same] == data[same]:
                same += 1
            last = self.bpe.extend(data, last[:same + 1])
            tables[at] = data, last
            starts.append(at)
            codes.append(self.bpe.read(data, last))
            at += len(m)
        tail = range(resume, len(self.starts))
        self.kept = first + len(tail)
        self.codes = self.codes[:first] + codes + [self.codes[i] for i in tail]
        self.starts = self.starts[:first] + starts + [self.starts[i] + shift for i in tail]
        # tables near this edit stay for the next one
        self.tables = dict(list(tables.items())[-8:])
        return self


def _blocks(batch: pa.RecordBatch, column: str) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``BLOCK_BYTES`` of ``column``."""
    values = batch.column(column).cast(pa.large_binary())
    ends = np.frombuffer(values.buffers()[1], np.int64, len(values) + 1, values.offset * 8) if len(values) else np.zeros(1, np.int64)
    lo = 0
    while lo < len(values):
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + BLOCK_BYTES, "right")) - 1)
        yield lo, min(hi, len(values))
        lo = min(hi, len(values))


def encode_byte_bpe(docs: DataFrame, bpe: ByteBpe, text_col: str = "text", decoded: bool = False) -> DataFrame:
    """``doc`` (all columns of ``docs`` but the text), ``ids`` (binary: little-endian unsigned
    32-bit integers, ``ids_array`` makes numbers of them), ``n_tokens`` and, with ``decoded``,
    the bytes that the ids decode to."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _blocks(batch, "text"):
                ids = [bpe.encode(t.as_py()) for t in batch.column("text").slice(lo, hi - lo)]
                out = [batch.column("doc").slice(lo, hi - lo), pa.array(ids, pa.binary()),
                       pa.array([len(i) // 4 for i in ids], pa.int64())]
                if decoded:
                    out.append(pa.array([bpe.decode(i) for i in ids], pa.binary()))
                yield pa.RecordBatch.from_arrays(out, names=["doc", "ids", "n_tokens", "decoded"][:len(out)])
    rest = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    rows = docs.select(F.struct(*rest).alias("doc"), F.col(text_col).cast("binary").alias("text"))
    kind = rows.schema["doc"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc {kind}, ids binary, n_tokens long" + (", decoded binary" if decoded else ""))


def ids_array(ids):
    """Column of packed ids as array<long>."""
    fours = F.regexp_extract_all(F.hex(ids), F.lit("(.{8})"))
    return F.transform(fours, lambda x: F.conv(F.concat(*[F.substring(x, at, 2) for at in (7, 5, 3, 1)]), 16, 10).cast("long"))


def decode_byte_bpe(encoded: DataFrame, bpe: ByteBpe, ids_col: str = "ids") -> DataFrame:
    """``doc`` (all other columns) and ``decoded``: the bytes of each row's ids (null: none)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _blocks(batch, "ids"):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc").slice(lo, hi - lo),
                     pa.array([bpe.decode(i.as_py() or b"") for i in batch.column("ids").slice(lo, hi - lo)], pa.binary())],
                    names=["doc", "decoded"])
    rest = [F.col(f"`{c}`") for c in encoded.columns if c != ids_col]
    rows = encoded.select(F.struct(*rest).alias("doc"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(run, f"doc {rows.schema['doc'].dataType.simpleString()}, decoded binary")


def reencode_edits(edits: DataFrame, bpe: ByteBpe) -> DataFrame:
    """Follow edits of encoded texts without encoding them anew.

    Takes ``text, ids`` (as ``encode_byte_bpe`` gives them), ``lo, hi`` (characters, cut to
    the text; null: its end) and ``new`` (null: empty); other columns are carried in ``doc``.
    Gives ``doc, text, ids, n_tokens, n_kept`` with ``text[lo:hi]`` replaced; ``n_kept`` is
    the number of matches that kept their tokens."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi in _blocks(batch, "text"):
                part = batch.slice(lo, hi - lo)
                rows = []
                for text, ids, a, b, new in zip(*(part.column(c).to_pylist() for c in ("text", "ids", "lo", "hi", "new"))):
                    text = (text or b"").decode("utf-8", "surrogateescape")
                    new = (new or b"").decode("utf-8", "surrogateescape")
                    e = Editable(bpe, text, np.frombuffer(ids or b"", "<u4").tolist())
                    e.replace(len(text) if a is None else a, len(text) if b is None else b, new)
                    rows.append((e.text.encode("utf-8", "surrogateescape"), np.array(e.ids, "<u4").tobytes(), e.kept))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.binary()),
                     pa.array([len(r[1]) // 4 for r in rows], pa.int64()), pa.array([r[2] for r in rows], pa.int64())],
                    names=["doc", "text", "ids", "n_tokens", "n_kept"])
    own = ("text", "ids", "lo", "hi", "new")
    rest = [F.col(f"`{c}`") for c in edits.columns if c not in own]
    rows = edits.select(F.struct(*rest).alias("doc"), F.col("text").cast("binary").alias("text"), "ids",
                        F.col("lo").cast("long").alias("lo"), F.col("hi").cast("long").alias("hi"), F.col("new").cast("binary").alias("new"))
    kind = rows.schema["doc"].dataType.simpleString()
    out = rows.mapInArrow(run, f"doc {kind}, text binary, ids binary, n_tokens long, n_kept long")
    return out.withColumn("text", F.col("text").cast("string"))
