"""Exact token counts of every prefix by dynamic programming.

The last token of a prefix's encoding is the one token that ends there and is
stable next to the last token of the prefix before it: two neighbours are
stable if encoding their joined characters gives the two again.  So the count
of a prefix is one more than the count of the prefix its last token starts at,
and one walk over a text gives the count of each of its prefixes.  A stored
table of them answers how many tokens a cut text has, where a budget ends and
which texts fit a limit, without encoding anything again.

Blanks become the mark U+2581 and one mark is put in front, as the vocabulary's
model does; a character that no piece covers costs its UTF-8 bytes.  Characters
that some piece holds next to each other are of one kind (the public vocabulary
has some fifty: Latin letters, signs, ...; a digit stands alone).  No token
crosses from one kind to another or to the marks before it, so counts of what
follows add to the count before it, wherever it stands.  Texts are cut there;
a vocabulary with fewer such places gives longer
stretches, at worst whole texts.  Prefix counts of short stretches are computed
many at a time, a column of characters after the other, and kept in a bounded
table in each task; long ones are walked one by one.

Scale: one pass over the texts, no shuffle; memory of a task is one text, its
counts and the two bounded tables.

Defined results: a null text counts as empty; an empty text has no tokens and
no bytes, and the table holds the count 0 of its one prefix; strings of special
tokens are ordinary text; repeated rows count alike; an empty table gives an
empty one; other columns are never read.
"""

from __future__ import annotations

import os
import re
from array import array
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fincrime.llm.common import table, whole

MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")
MARK = "▁"
LIMIT = 4096
KEPT = 600_000               # stretches whose counts a task keeps
LONGEST = 60                 # characters of a stretch that is kept: its counts fit in bytes
TOGETHER = 50_000            # stretches that are walked together
PAIRS = 500_000              # pairs of tokens whose stability a task keeps
PART = 4_000_000             # characters of texts that are counted together
START, UNCOVERED = -1, -2    # in place of a last token
END = 0x110000               # in place of a character, after the last


def _cutter(pieces: Iterable[str]) -> re.Pattern | None:
    """Finds the stretches of a text with blanks for marks; None if only whole texts will do.

    Characters that follow each other inside a piece are of one kind; a stretch
    is a run of one kind, or one character that no piece joins to another, with
    the marks before it."""
    kind: dict[str, str] = {}

    def first(c: str) -> str:
        while kind.setdefault(c, c) != c:
            kind[c] = c = kind[kind[c]]
        return c

    for p in pieces:
        inner = p.lstrip(MARK)
        if MARK in inner:
            return None
        for a, b in zip(inner, inner[1:]):
            kind[first(a)] = first(b)
    kinds: dict[str, list[str]] = {}
    for c in sorted(kind):
        kinds.setdefault(first(c), []).append(c)
    runs = ["[" + "".join(map(re.escape, chars)) + "]+" for chars in sorted(kinds.values(), key=len, reverse=True)]
    return re.compile(" *(?:" + "|".join([*runs, "[^ ]"]) + ")| +")


class Totals(dict):
    """Tokens of whole stretches, the last of their prefix counts."""

    def __init__(self, counter: "Counter"):
        super().__init__()
        self.counter = counter

    def __missing__(self, stretch: str) -> int:
        return self.counter[stretch][-1]


class Counter(dict):
    """Prefix counts of stretches, by stretch."""

    def __init__(self, pieces: Sequence[tuple[str, float] | None]):
        """pieces: (text, score) by id; None for ids that no text is merged to."""
        super().__init__()
        self.total = Totals(self)
        self.size = len(pieces)
        self.pieces = [p[0] if p else "" for p in pieces]
        self.scores = {p[0]: p[1] for p in pieces if p}
        self.longest = max(map(len, self.scores), default=1)
        self.cut = _cutter(self.scores)
        self.pairs, self.apart = np.zeros(0, np.int64), np.zeros(0, bool)      # known stability, sorted by pair
        # the trie of pieces: node * letters + letter -> node; token of a node or -1
        self.letters = {c: i for i, c in enumerate(sorted({c for p in self.scores for c in p}), 1)}
        edges: dict[int, int] = {}
        token = [-1]
        for i, p in enumerate(self.pieces):
            if p and (len(p) == 1 or self.merged(p) == [p]):      # a piece that merging never makes is no token
                at = 0
                for c in p:
                    key = at * (len(self.letters) + 1) + self.letters[c]
                    if key not in edges:
                        edges[key] = len(token)
                        token.append(-1)
                    at = edges[key]
                token[at] = i
        self.edges = edges
        self.edge = np.array(sorted(edges), np.int64)
        self.below = np.array([edges[k] for k in sorted(edges)], np.int64)
        self.token = np.array(token, np.int64)
        self.letter = np.zeros(END + 1, np.int32)
        self.letter[[ord(c) for c in self.letters]] = list(self.letters.values())
        self.covered = np.zeros(len(self.letters) + 1, bool)
        self.covered[[i for c, i in self.letters.items() if c in self.scores]] = True

    @classmethod
    def load(cls, model: bytes) -> "Counter":
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_proto=model)
        special = lambda i: sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)
        return cls([None if special(i) else (sp.id_to_piece(i), sp.get_score(i)) for i in range(sp.vocab_size())])

    def merged(self, text: str) -> list[str]:
        """Pairs of neighbours merged, highest score first and leftmost of equal ones."""
        parts = list(text)
        while True:
            best, at = None, -1
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if best is None:
                return parts
            parts[at:at + 2] = [parts[at] + parts[at + 1]]

    def stable(self, pairs: np.ndarray) -> np.ndarray:
        """Which pairs of tokens (left * size + right) stay apart when their characters are encoded together."""
        at = np.searchsorted(self.pairs, pairs)
        known = at < len(self.pairs)
        known[known] = self.pairs[at[known]] == pairs[known]
        if not known.all():
            new = np.unique(pairs[~known])
            if len(self.pairs) + len(new) > PAIRS:
                self.pairs, self.apart = self.pairs[:0], self.apart[:0]
                new = np.unique(pairs)
            parts = [(self.pieces[a], self.pieces[b]) for a, b in zip(*(x.tolist() for x in np.divmod(new, self.size)))]
            apart = np.array([self.merged(a + b) == [a, b] for a, b in parts], bool)
            to = np.searchsorted(self.pairs, new)
            self.pairs, self.apart = np.insert(self.pairs, to, new), np.insert(self.apart, to, apart)
            at = np.searchsorted(self.pairs, pairs)
        return self.apart[at]

    def walk(self, stretch: str) -> array:
        """Tokens of each prefix of one stretch, from the empty one on."""
        marked = stretch.replace(" ", MARK)
        n, width = len(marked), len(self.letters) + 1
        counts, last = array("i", bytes(4 * (n + 1))), [START] * (n + 1)
        codes = [self.letters.get(c, 0) for c in marked]
        known: dict[int, bool] = {}
        for start, first in enumerate(marked):
            left, count = last[start], counts[start]
            if first not in self.scores:
                last[start + 1], counts[start + 1] = UNCOVERED, count + len(first.encode())
            node: int | None = 0
            for end in range(start, n):
                node = self.edges.get(node * width + codes[end])
                if node is None:
                    break
                token = int(self.token[node])
                if token < 0:
                    continue
                pair = left * self.size + token
                if left >= 0 and pair not in known:
                    known[pair] = bool(self.stable(np.array([pair]))[0])
                if left < 0 or known[pair]:
                    last[end + 1], counts[end + 1] = token, count + 1
        return counts

    def walk_all(self, stretches: list[str]) -> Iterator[tuple[str, bytes]]:
        """The same for many short stretches at a time, in order, so that those with a prefix in common
        are neighbours: each prefix is walked once, for the first stretch that has it."""
        sizes = np.array(list(map(len, stretches)))
        most, k = int(sizes.max()), len(stretches)
        points = np.frombuffer("".join(s.replace(" ", MARK).ljust(most, "\0") for s in stretches).encode("utf-32-le"), np.uint32)
        points = np.where(np.arange(most) < sizes[:, None], points.reshape(k, most), END).T
        utf8 = 1 + (points > 0x7F).astype(np.uint8) + (points > 0x7FF) + (points > 0xFFFF)
        codes = self.letter[points]
        shared = np.zeros(k, np.int64)
        shared[1:] = np.minimum.accumulate(points[:, 1:] == points[:, :-1], axis=0).sum(axis=0)
        # by length: the stretches that have a prefix first, and for each stretch the one that has its prefix first
        firsts = [np.flatnonzero((shared < n) & (sizes >= n)) for n in range(most + 1)]
        firsts[0] = np.zeros(1, np.int64)
        first_of = []
        for f in firsts:
            of = np.zeros(k, np.int32)
            of[f] = f
            first_of.append(np.maximum.accumulate(of))
        last = np.full((most + 1, k), START, np.int64)
        counts = np.zeros((most + 1, k), np.uint8)
        width = len(self.letters) + 1
        for start in range(most):
            rows = firsts[start + 1]
            bare = rows[~self.covered[codes[start, rows]]]
            last[start + 1, bare] = UNCOVERED
            counts[start + 1, bare] = counts[start, first_of[start][bare]] + utf8[start, bare]
            nodes = np.zeros(k, np.int64)
            for end in range(start, min(most, start + self.longest)):
                rows = firsts[end + 1]
                node = nodes[first_of[end][rows]]
                rows, node = rows[node >= 0], node[node >= 0]
                key = node * width + codes[end, rows]
                at = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
                found = self.edge[at] == key
                rows, node = rows[found], self.below[at[found]]
                if not len(rows):
                    break
                nodes = np.full(k, -1)
                nodes[rows] = node
                token = self.token[node]
                here, token = rows[token >= 0], token[token >= 0]
                before = first_of[start][here]
                left = last[start, before]
                fits = left < 0
                fits[~fits] = self.stable(left[~fits] * self.size + token[~fits])
                last[end + 1, here[fits]], counts[end + 1, here[fits]] = token[fits], counts[start, before[fits]] + 1
        for n, of in enumerate(first_of):
            counts[n] = counts[n, of]
        flat = counts.T.tobytes()
        for i, s in enumerate(stretches):
            yield s, flat[i * (most + 1):i * (most + 1) + len(s) + 1]

    def learn(self, stretches: set[str]) -> None:
        """Holds the counts of ``stretches``' short ones from here on, as long as no more are learned than fit."""
        if len(self) + len(stretches) > KEPT:
            self.clear()
            self.total.clear()
        new = sorted(s for s in stretches if s not in self and len(s) <= LONGEST)
        for lo in range(0, len(new), TOGETHER):
            walked = dict(self.walk_all(new[lo:lo + TOGETHER]))
            self.update(walked)
            self.total.update((s, c[-1]) for s, c in walked.items())

    def __missing__(self, stretch: str) -> array:
        return self.walk(stretch)

    def stretches(self, text: str) -> list[str]:
        """The text with a blank in front, cut where no token crosses."""
        if not text:
            return []
        spaced = " " + text.replace(MARK, " ")
        return self.cut.findall(spaced) if self.cut else [spaced]

    def cut_and_learnt(self, texts: Iterable[str]) -> Iterator[list[str]]:
        """Each text's stretches, in parts of the batch whose counts are then held."""
        part: list[list[str]] = []
        size = 0
        for t in texts:
            part.append(self.stretches(t))
            size += len(t)
            if size >= PART:
                self.learn(set().union(*part))
                yield from part
                part, size = [], 0
        self.learn(set().union(*part))
        yield from part

    def totals(self, texts: Iterable[str]) -> list[int]:
        """Tokens of each whole text, its longest prefix."""
        return [sum(map(self.total.__getitem__, parts)) for parts in self.cut_and_learnt(texts)]

    def prefixes(self, texts: Iterable[str]) -> Iterator[array]:
        """Tokens of the first 0, 1, ... characters of each text."""
        for parts in self.cut_and_learnt(texts):
            out, before = array("i", [0]), 0
            for k, s in enumerate(parts):
                counts = self[s]
                # the blank in front belongs to no prefix of the text
                out.extend([before + c for c in counts[2 if k == 0 else 1:]])
                before += counts[-1]
            yield out


_counters: dict[bytes, Counter] = {}


def _counter(model: bytes) -> Counter:
    """One a worker."""
    if model not in _counters:
        _counters[model] = Counter.load(model)
    return _counters[model]


def _model(spark: SparkSession, path: str):
    """The vocabulary file (half a megabyte), read on the driver for all tasks."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def _totals(model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model.value)
        for b in batches:
            n = pa.array(counter.totals(t.as_py() for t in b.column(2)), pa.int64())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), n], ["id", "n_bytes", "n_tokens"])
    return count


def _prefixes(model):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(model.value)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = b.slice(lo, 500)
                found = [np.frombuffer(c, np.int32) for c in counter.prefixes(t.as_py() or "" for t in part.column(1))]
                counts = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), counts], ["id", "text", "prefix_tokens"])
    return count


def counts(df: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """id, ``n_bytes`` and ``n_tokens`` of the whole text."""
    t = whole(text)
    d = df.select(F.col(id).alias("id"), F.octet_length(t).cast("long").alias("n_bytes"), t.alias("t"))
    kind = dict(d.dtypes)["id"]
    return d.mapInArrow(_totals(_model(df.sparkSession, model)), f"id {kind}, n_bytes long, n_tokens long") \
            .withColumnRenamed("id", id)


def prefixes(df: DataFrame, id: str = "doc_id", text: str = "text", model: str = MODEL) -> DataFrame:
    """The table to store: id, ``text`` and ``prefix_tokens``, whose element i
    (from 0) is the number of tokens of the text's first i characters."""
    d = df.select(F.col(id).alias("id"), F.col(text).alias("text"))
    kind = dict(d.dtypes)["id"]
    return d.mapInArrow(_prefixes(_model(df.sparkSession, model)), f"id {kind}, text string, prefix_tokens array<int>") \
            .withColumnRenamed("id", id)


def tokens_at(length: Column, prefix_tokens: str = "prefix_tokens") -> Column:
    """Tokens of the first ``length`` characters; of the whole text if it is shorter."""
    c = F.col(prefix_tokens)
    return F.get(c, F.greatest(F.least(length, F.size(c) - 1), F.lit(0)))


def longest_within(budget: Column, prefix_tokens: str = "prefix_tokens") -> Column:
    """Characters of the longest prefix of at most ``budget`` tokens.

    Counts may fall as a prefix grows (a word's end can join what stood in
    parts), so the last prefix within the budget counts, not the first beyond."""
    c = F.col(prefix_tokens)
    fits = F.transform(c, lambda n, i: F.when(n <= budget, i))
    return F.coalesce(F.array_max(fits), F.lit(0))


def truncate(stored: DataFrame, budget: int, text: str = "text", prefix_tokens: str = "prefix_tokens") -> DataFrame:
    """``stored`` with its texts cut to the longest prefix within the budget; null stays null."""
    cut = F.substring(F.col(text), F.lit(1), longest_within(F.lit(budget), prefix_tokens))
    return stored.withColumn(text, cut)


def op13(spark, sf_dir: str) -> DataFrame:
    return counts(table(spark, sf_dir, "documents")).withColumn("over_limit", F.col("n_tokens") > LIMIT)
