"""SentencePiece encoding as a shortest path through a weighted transducer, and decoding.

The transducer is the composition of three parts that are compiled from a model file: the normaliser
(space to ``▁``, a leading ``▁``), the pieces, and byte fallback for characters without a piece.
Composed with an input it is a lattice over the input's characters; the encoding is its shortest
path in the tropical semiring.

- Unigram models: an arc weighs minus its piece's score.
- Byte-pair models: a state also knows the last piece. An arc weighs nothing if merging the last
  piece's and its own characters gives back these two pieces, else infinity. Merging is local, so
  exactly one path is finite, and that is the sequence merging gives for the whole input.

No piece holds a ``▁`` after another character, or a character that is in no longer piece beside
another; all paths meet there. The input is cut at those places, and a path is searched once for a
segment that a task has not met lately.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import pairwise
from math import inf
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Fixed values of the model format.
SPACE = "▁"
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, USER_DEFINED, BYTE = 1, 2, 4, 6
#: Segments and pairs of pieces that a task remembers, and the characters of all of them; they bound memory only.
REMEMBERED, CHARACTERS = 300_000, 1 << 23
#: Cost of a character without a piece.
UNREAD = 1e3


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """The fields of a protocol-buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + size]
            at += size


class Model(NamedTuple):
    kind: int
    pieces: list[tuple[str, float, int]]
    unknown: int
    leading_space: bool

    @classmethod
    def parse(cls, data: bytes) -> Model:
        pieces, trainer, normaliser = [], {}, {}
        for field, value in _fields(data):
            if field == 1:
                piece = dict(_fields(value))
                score = np.frombuffer(piece.get(2, bytes(4)), "<f4")[0]
                pieces.append((piece[1].decode(), float(score), piece.get(3, NORMAL)))
            elif field == 2:
                trainer = dict(_fields(value))
            elif field == 3:
                normaliser = dict(_fields(value))
        if normaliser.get(2) or normaliser.get(4, 1):
            raise ValueError("only normalisers that keep all characters and spaces are supported")
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
            raise ValueError("only unigram and byte-pair models are supported")
        return cls(trainer.get(3, UNIGRAM), pieces, trainer.get(40, 0), bool(normaliser.get(3, 1)))


class Remembered(dict):
    """Values by key, computed when missing. When full, what was not asked for since it last was goes."""

    def __init__(self, compute):
        self.compute, self.older, self.characters = compute, {}, 0

    def __missing__(self, key):
        size = len(key) if isinstance(key, str) else 1
        if size > CHARACTERS // 64:  # so long a segment hardly comes again
            return self.compute(key)
        if len(self) >= REMEMBERED or self.characters + size > CHARACTERS:
            self.older, self.characters = dict(self), 0
            self.clear()
        self.characters += size
        value = self.older.get(key)
        if value is None:
            value = self.compute(key)
        self[key] = value
        return value


#: What stands for a piece before the first one, and for a character that has none.
START, FALLBACK = -1, -2


class Transducer:
    def __init__(self, model: Model):
        self.model = model
        self.merging = model.kind == BPE
        self.ids = {p: i for i, (p, _, kind) in enumerate(model.pieces) if kind in (NORMAL, USER_DEFINED)}
        self.bytes = {int(p[3:5], 16): i for i, (p, _, kind) in enumerate(model.pieces) if kind == BYTE}
        self.trie: dict = {}  # of characters; None leads to the id of the piece that ends there
        for piece, i in self.ids.items():
            node = self.trie
            for c in piece:
                node = node.setdefault(c, {})
            node[None] = i
        self.cut = self._cut()
        self.meets = Remembered(self._meets)
        self.encoded = Remembered(self._encode)
        texts = [p.replace(SPACE, " ").encode() if kind in (NORMAL, USER_DEFINED) else b"" for p, _, kind in model.pieces]
        for byte, i in self.bytes.items():
            texts[i] = bytes([byte])
        if model.pieces:
            texts[model.unknown] = " ⁇ ".encode()
        self.texts = texts

    def _cut(self) -> re.Pattern:
        """Finds segments; no piece reads across their ends, as none holds the two characters there side by side."""
        if any(SPACE in p.lstrip(SPACE) for p in self.ids):
            return re.compile(".+", re.DOTALL)
        before: dict[str, set[str]] = {}
        for piece in self.ids:
            for a, b in pairwise(piece):
                before.setdefault(a, set())
                before.setdefault(b, set()).add(a)
        joined = set(before) - {SPACE}
        marks = {c for c in joined if not c.isalpha()}
        while any(before[c] & (joined - marks) for c in marks):
            marks = {c for c in marks if not before[c] & (joined - marks)}
        if not joined - marks or not marks:
            return re.compile(f"{SPACE}+.?[^{SPACE}]*|[^{SPACE}]+", re.DOTALL)
        inner, first, every = (f"[{''.join(map(re.escape, sorted(c)))}]" for c in (joined - marks, marks, joined))
        return re.compile(f"{SPACE}+(?:{first}{every}*|{inner}*)|{inner}+|{first}{every}*|.", re.DOTALL)

    def _merged(self, text: str) -> list[str]:
        """The pieces that are left when the best-scored neighbours, leftmost first, are merged."""
        parts = list(text)
        while True:
            best = None
            for i, (a, b) in enumerate(pairwise(parts)):
                found = self.ids.get(a + b)
                if found is not None and (best is None or self.model.pieces[found][1] > best[0]):
                    best = self.model.pieces[found][1], i
            if best is None:
                return parts
            i = best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def _meets(self, pair: int) -> bool:
        """Whether merging leaves two neighbours as they are; the arc weighs nothing then, else infinity."""
        last, piece = divmod(pair, len(self.model.pieces))
        pieces = [self.model.pieces[i][0] for i in (last, piece) if i >= 0]
        return self._merged("".join(pieces)) == pieces

    def path(self, text: str) -> list[tuple[int, int]]:
        """The arcs of the shortest path, last one first: the piece's id, or FALLBACK, and where it begins.

        One state a place is enough: of those that differ in cost only, the cheapest; of those that
        differ in the last piece, one is finite.
        """
        n, many, merging, meets, scores, trie = len(text), len(self.model.pieces), self.merging, self.meets, self.model.pieces, self.trie
        costs, pieces, before = [inf] * (n + 1), [START] * (n + 1), [0] * (n + 1)
        costs[0] = 0.0
        for at in range(n):
            cost = costs[at]
            if cost == inf:
                continue
            pair = pieces[at] * many if pieces[at] >= 0 else -many
            node = trie
            for to in range(at + 1, n + 1):
                node = node.get(text[to - 1])
                if node is None:
                    break
                piece = node.get(None)
                if piece is None:
                    continue
                if merging:
                    if costs[to] == inf and meets[pair + piece]:
                        costs[to], pieces[to], before[to] = cost, piece, at
                elif cost - scores[piece][1] < costs[to]:
                    costs[to], pieces[to], before[to] = cost - scores[piece][1], piece, at
            # a character without a piece is read as bytes, at more cost than by any longer piece
            if costs[at + 1] == inf and text[at] not in self.ids:
                costs[at + 1], pieces[at + 1], before[at + 1] = cost + UNREAD, FALLBACK, at
        found, at = [], n
        while at:
            found.append((pieces[at], before[at]))
            at = before[at]
        return found

    def _encode(self, segment: str) -> bytes:
        """The ids of a segment's pieces as 32-bit numbers."""
        ids: list[int] = []
        for piece, at in reversed(self.path(segment)):
            if piece != FALLBACK:
                ids.append(piece)
            elif self.bytes:
                ids += [self.bytes[b] for b in segment[at].encode()]
            else:
                ids.append(self.model.unknown)
        return array("i", ids).tobytes()

    def encode(self, text: str) -> np.ndarray:
        if not text:
            return np.empty(0, np.int32)
        normal = text.replace(" ", SPACE)
        if self.model.leading_space:
            normal = SPACE + normal
        return np.frombuffer(b"".join(map(self.encoded.__getitem__, self.cut.findall(normal))), np.int32)

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.texts.__getitem__, ids.tolist())).decode("utf-8", "replace")
        return text[1:] if self.model.leading_space and text.startswith(" ") else text


@lru_cache(maxsize=4)
def compiled(data: bytes) -> Transducer:
    return Transducer(Model.parse(data))


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    return pa.ListArray.from_arrays(offsets, np.concatenate(arrays) if arrays else np.empty(0, np.int32))


def _coder(model: Broadcast):
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        transducer = compiled(model.value)
        for batch in batches:
            # part by part, so that no more than some MB of ids are held
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                ids = [transducer.encode(t or "") for t in part.column(1).to_pylist()]
                decoded = pa.array([transducer.decode(i) for i in ids], pa.string())
                counts = pa.array([len(i) for i in ids], pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0), counts, _lists(ids), decoded], ["doc_id", "n_ids", "ids", "decoded"])

    return code


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_ids, ids, decoded``: the ids of each whole text, and the text decoded from them.

    The model file is read by the driver and sent to the executors; its size is that of a
    vocabulary. Rows are coded one by one where they are read, without a shuffle. The ids are those
    the SentencePiece library gives. Decoding gives the text back, but ``▁`` in a text becomes a
    space. A null text counts as empty: no ids, decoded to an empty text. Ids of documents may be
    null or repeat, rows stay as they are. Other columns are not read. An empty table gives an empty
    one.
    """
    spark = docs.sparkSession
    with open(model_path, "rb") as file:
        model = spark.sparkContext.broadcast(file.read())
    read = docs.select(docs[f"`{id_col}`"].cast("long").alias("doc_id"), docs[f"`{text_col}`"].alias("text"))
    return read.mapInArrow(_coder(model), "doc_id long, n_ids long, ids array<int>, decoded string")
