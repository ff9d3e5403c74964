"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text is cut into the pieces of a vocabulary with the highest sum of scores.
The search reads the text once.  It keeps the best score of each boundary in a
window as long as the longest piece, since no piece reaches further back, and
the back pointers that are not committed yet.  Whenever the paths from all
boundaries in the window run through one boundary, the ids up to there are
final and are committed.

Blanks become the mark U+2581 and one mark is put in front, as the vocabulary's
model does; a character that no piece covers becomes the pieces of its UTF-8
bytes.  A piece of the public vocabulary holds a mark only at its start or is
all marks, so at a mark after another character all paths converge.  The text
between two such boundaries has the same ids wherever it stands; they are kept
in a bounded table in each task.

Defined results: a null text has null ids; an empty text has none; a mark in the
text itself becomes the pieces of its bytes, so that decoding gives every text
back exactly; ids that are null or out of range, or whose bytes make no UTF-8,
decode to null, as null ids do; repeated rows encode alike; an empty table gives
an empty one; other columns are never read.
"""

from __future__ import annotations

import os
from array import array
from collections import deque
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.llm.common import table

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
LITERAL = "\ud800"           # stands for a mark of the text itself; no valid text holds it
KEPT = 500_000               # entries of the table of encoded stretches
LONGEST = 64                 # characters of a stretch in it
NONE = float("-inf")


class Vocabulary:
    """Pieces and scores; ids of bytes; which pieces end where."""

    def __init__(self, pieces: Sequence[tuple[str, float, str]]):
        """pieces: (text, score, kind), kind one of piece, byte, special."""
        self.scores = {p: (s, i) for i, (p, s, kind) in enumerate(pieces) if kind == "piece"}
        self.longest = max(map(len, self.scores), default=1)
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(pieces) if kind == "byte"}
        #: lower than any piece, so that bytes are used only for what no piece covers
        self.uncovered = min((s for s, _ in self.scores.values() if s > -1e8), default=0.0) - 10.0
        self.decoded = [p.replace(MARK, " ").encode() if kind == "piece" else
                        bytes([int(p[3:5], 16)]) if kind == "byte" else b"" for p, _, kind in pieces]
        #: pieces by their characters, each [score, id, what may follow]; a prefix that is no piece scores NONE
        self.trie: dict[str, list] = {}
        for p, (score, i) in self.scores.items():
            at = self.trie
            for c in p[:-1]:
                entry = at.setdefault(c, [NONE, -1, None])
                entry[2] = at = {} if entry[2] is None else entry[2]
            at.setdefault(p[-1], [NONE, -1, None])[:2] = score, i
        self.mark_starts = not any(MARK in p.lstrip(MARK) for p in self.scores)

    @classmethod
    def load(cls, model: bytes) -> "Vocabulary":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        kind = lambda i: "byte" if sp.is_byte(i) else "special" if sp.is_control(i) or sp.is_unknown(i) else "piece"
        return cls([(sp.id_to_piece(i), sp.get_score(i), kind(i)) for i in range(sp.vocab_size())])


def _utf8(c: str) -> bytes:
    return (MARK if c == LITERAL else c).encode()


def _marked(text: str) -> str:
    """Marks for blanks; the text's own marks are covered by no piece and become their bytes."""
    return text.replace(MARK, LITERAL).replace(" ", MARK)


def viterbi(text: str, v: Vocabulary) -> Iterator[list[int]]:
    """Ids of ``text`` (with marks), committed in parts as soon as they are final.

    Of equal sums the one whose last piece starts earliest wins.  The public
    vocabulary's scores are whole numbers and sums are taken back to small ones
    at each commit, so equal sums are equal wherever parts are committed."""
    n, longest = len(text), v.longest
    best: deque[float] = deque([0.0])           # scores of the boundaries low .. low + len(best) - 1
    back: deque = deque([None])                 # (start, ids) of the last piece
    low = 0
    for start in range(n):
        here = best[start - low]
        if here is not None:
            at = v.trie
            for end, c in enumerate(text[start:start + longest], start + 1):
                found = at.get(c)
                if found is None:
                    break
                score, i, at = found
                if score != NONE:
                    _offer(best, back, low, end, here + score, start, i)
                if at is None:
                    break
            if text[start] not in v.scores:
                _offer(best, back, low, start + 1, here + v.uncovered, start, text[start])
        elif len(best) == start - low + 1:
            best.append(None)
            back.append(None)
        if start - low >= 2 * longest:
            meet = _meet(back, low, start + 1, start + longest)
            if meet > low:
                yield _path(back, low, meet, v)
                base = best[meet - low]
                for _ in range(meet - low):
                    best.popleft()
                    back.popleft()
                best = deque(None if s is None else s - base for s in best)   # sums stay small in long texts
                low = meet
    if n > low:
        yield _path(back, low, n, v)


def _offer(best: deque, back: deque, low: int, end: int, score: float, start: int, piece) -> None:
    while len(best) <= end - low:
        best.append(None)
        back.append(None)
    if best[end - low] is None or score > best[end - low]:
        best[end - low], back[end - low] = score, (start, piece)


def _meet(back: deque, low: int, first: int, last: int) -> int:
    """The latest boundary that all paths from the reached boundaries of the
    window run through."""
    open_ = {b for b in range(first, min(last, low + len(back) - 1) + 1) if back[b - low] is not None}
    while len(open_) > 1:
        b = max(open_)
        open_.remove(b)
        if b > low:
            open_.add(back[b - low][0])
    return open_.pop() if open_ else low


def _path(back: deque, low: int, end: int, v: Vocabulary) -> list[int]:
    ids: list[int] = []
    while end > low:
        end, piece = back[end - low]
        ids.extend(reversed([v.bytes[b] for b in _utf8(piece)] if isinstance(piece, str) else [piece]))
    return ids[::-1]


def _short(s: str, v: Vocabulary) -> list[int]:
    """The same search for a stretch that fits the window: nothing to commit before its end."""
    n, trie, alone = len(s), v.trie, v.scores
    best = [0.0] + [NONE] * n          # every boundary is reached: by a piece of one character or by its bytes
    starts, pieces = [0] * (n + 1), [0] * (n + 1)
    for start in range(n):
        here, at, end = best[start], trie, start
        for c in s[start:]:
            found = at.get(c)
            if found is None:
                break
            score, i, at = found
            end += 1
            score += here
            if score > best[end]:
                best[end], starts[end], pieces[end] = score, start, i
            if at is None:
                break
        if s[start] not in alone and here + v.uncovered > best[start + 1]:
            best[start + 1], starts[start + 1], pieces[start + 1] = here + v.uncovered, start, -1
    ids: list[int] = []
    while n:
        if pieces[n] < 0:
            ids.extend(reversed([v.bytes[b] for b in _utf8(s[n - 1])]))
        else:
            ids.append(pieces[n])
        n = starts[n]
    return ids[::-1]


def encode_whole(text: str, v: Vocabulary) -> list[int]:
    """``text`` in one search."""
    return [i for part in viterbi(MARK + _marked(text), v) for i in part] if text else []


class Stretches(dict):
    """Ids (as the bytes of int32) of stretches, each a mark and the key; short ones are kept."""

    def __init__(self, v: Vocabulary):
        super().__init__()
        self.v, self.short = v, min(LONGEST, 2 * v.longest)

    def __missing__(self, key: str) -> bytes:
        s = MARK + key
        if len(s) > self.short:
            return array("i", [i for part in viterbi(s, self.v) for i in part]).tobytes()
        if len(self) >= KEPT:
            self.clear()
        ids = self[key] = array("i", _short(s, self.v)).tobytes()
        return ids


class Codec:
    """Encodes texts stretch by stretch and decodes ids."""

    def __init__(self, v: Vocabulary):
        self.v, self.table = v, Stretches(v)

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.int32)
        if not self.v.mark_starts:
            return np.array(encode_whole(text, self.v), np.int32)
        parts = text.replace(MARK, LITERAL).split(" ")
        # marks that follow each other stay together: pieces may be all marks
        if "" in parts:
            parts = _joined(parts)
        return np.frombuffer(b"".join(map(self.table.__getitem__, parts)), np.int32)

    def decode(self, ids: Sequence[int | None]) -> str | None:
        """The text; None if an id is null or out of range, or if bytes make no UTF-8."""
        try:
            if len(ids) and min(ids) < 0:
                return None
            return b"".join(map(self.v.decoded.__getitem__, ids)).decode().removeprefix(" ")
        except (TypeError, IndexError, UnicodeDecodeError):      # a null, out of range, no UTF-8
            return None


def _joined(parts: list[str]) -> list[str]:
    """Lone marks, the empty parts, put before what follows them; the first mark of a part is not written."""
    out, lone = [], 0
    for p in parts:
        if p:
            out.append(MARK * lone + p)
            lone = 0
        else:
            lone += 1
    return out + [MARK * (lone - 1)] if lone else out


_codecs: dict[bytes, Codec] = {}


def _codec(model: bytes) -> Codec:
    """One codec a worker."""
    if model not in _codecs:
        _codecs[model] = Codec(Vocabulary.load(model))
    return _codecs[model]


def _encoder(model):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                texts = part.column("t").to_pylist()
                ids = [codec.encode(t or "") for t in texts]
                same = [None if t is None else codec.decode(i.tolist()) == t for t, i in zip(texts, ids)]
                ends = pa.array(np.cumsum([0] + [len(i) for i in ids]), pa.int32())
                lists = pa.ListArray.from_arrays(ends, pa.array(np.concatenate(ids)),
                                                 mask=pa.array([t is None for t in texts]))
                yield pa.RecordBatch.from_arrays([part.column("id"), lists, pa.array(same, pa.bool_())], ["id", "ids", "same"])
    return encode


def _decoder(model):
    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(model.value)
        for b in batches:
            for lo in range(0, b.num_rows, 200):
                part = b.slice(lo, 200)
                texts = [None if i is None else codec.decode(i) for i in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(texts, pa.string())], ["id", "text"])
    return decode


def _model(spark: SparkSession, path: str):
    """The vocabulary file (half a megabyte), read on the driver for all tasks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """id, ``ids`` (array<int>) and ``round_trip`` (whether decoding gives the text back)."""
    d = df.select(F.col(id).alias("id"), F.col(text).alias("t"))
    kind = dict(d.dtypes)["id"]
    return d.mapInArrow(_encoder(_model(df.sparkSession, model)), f"id {kind}, ids array<int>, same boolean") \
            .select(F.col("id").alias(id), "ids", F.col("same").alias("round_trip"))


def decode(df: DataFrame, id: str = "doc_id", ids: str = "ids", model: str = MODEL) -> DataFrame:
    """id and ``text``."""
    d = df.select(F.col(id).alias("id"), F.col(ids).alias("ids"))
    kind = dict(d.dtypes)["id"]
    return d.mapInArrow(_decoder(_model(df.sparkSession, model)), f"id {kind}, text string") \
            .select(F.col("id").alias(id), "text")


def op8(spark, sf_dir: str) -> DataFrame:
    return encode(table(spark, sf_dir, "documents")).withColumn("n_ids", F.size("ids"))
