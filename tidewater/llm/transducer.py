"""Minimal acyclic transducers from sorted keys to their ordinals, and the walk of many words at once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

#: Each byte of a word in lower case (A-Z alone changes), 0 for bytes that part words.
LETTERS = np.zeros(256, dtype=np.uint8)
LETTERS[0x61:0x7B] = LETTERS[0x41:0x5B] = np.arange(0x61, 0x7B)
LETTERS[0x80:] = np.arange(0x80, 0x100)
#: The same with digits.
DIGITS = LETTERS.copy()
DIGITS[0x30:0x3A] = np.arange(0x30, 0x3A)
#: Bytes of text looked at together.
PIECE = 1 << 20


class Transducer:
    """The ordinal of each of some sorted byte strings.

    States are merged as soon as no later key can change them (keys come in order), so the automaton is
    minimal at any time. A transition adds the number of keys that branch off before it; the sum
    along a key's path is its ordinal. Transitions lie in one array, each state's shifted so that
    they meet only free places.
    """

    def __init__(self, keys: Iterable[bytes]):
        #: for each state: whether a key ends there, its bytes, their targets
        self.ends: list[bool] = []
        self.arcs: list[tuple[tuple[int, ...], tuple[int, ...]]] = []
        self.sizes: list[int] = []
        known: dict[tuple, int] = {}
        path: list[list] = [[False, [], []]]
        last = b""

        def settle(depth: int) -> None:
            while len(path) > depth + 1:
                path[-2][2].append(self._state(path.pop(), known))

        for key in keys:
            if last and key <= last:
                raise ValueError("keys must be sorted and distinct")
            same = 0
            while same < min(len(last), len(key)) and last[same] == key[same]:
                same += 1
            settle(same)
            for byte in key[same:]:
                path[-1][1].append(byte)
                path.append([False, [], []])
            path[-1][0] = True
            last = key
        settle(0)
        self.root = self._state(path[0], known)
        self._lay_out()

    def _state(self, node: list, known: dict[tuple, int]) -> int:
        name = (node[0], tuple(node[1]), tuple(node[2]))
        if name not in known:
            known[name] = len(self.ends)
            self.ends.append(name[0])
            self.arcs.append(name[1:])
            self.sizes.append(name[0] + sum(self.sizes[t] for t in name[2]))
        return known[name]

    def _lay_out(self) -> None:
        n = sum(len(letters) for letters, _ in self.arcs)
        taken = bytearray(4 * n + 1024)
        self.base = np.zeros(len(self.arcs), dtype=np.int32)
        placed: list[tuple[int, int, int, int]] = []
        free = {}
        for state in sorted(range(len(self.arcs)), key=lambda s: -len(self.arcs[s][0])):
            letters, targets = self.arcs[state]
            if not letters:
                continue
            # states of one size look for a place from where the last of them found one
            at = free.get(len(letters), 256)
            while True:
                at = taken.find(0, at)
                if at < 0 or at + 512 > len(taken):
                    taken.extend(bytes(len(taken)))
                    at = 256 if at < 0 else at
                    continue
                if not any(taken[at - letters[0] + b] for b in letters):
                    break
                at += 1
            free[len(letters)] = at
            self.base[state] = at - letters[0]
            more = int(self.ends[state])
            for byte, target in zip(letters, targets):
                place = at - letters[0] + byte
                taken[place] = 1
                placed.append((place, state, target, more))
                more += self.sizes[target]
        size = max((p[0] for p in placed), default=0) + 513
        self.owner = np.full(size, -1, dtype=np.int32)
        self.target = np.zeros(size, dtype=np.int32)
        self.more = np.zeros(size, dtype=np.int64)
        if placed:
            places, owners, targets, more = (np.array(c) for c in zip(*placed))
            self.owner[places], self.target[places], self.more[places] = owners, targets, more
        self.final = np.array(self.ends, dtype=bool)
        del self.ends, self.arcs, self.sizes

    def step(self, key: bytes) -> tuple[int, int]:
        """The state after ``key`` and what its path adds; state -1 if there is none."""
        state, ordinal = self.root, 0
        for byte in key:
            place = self.base[state] + byte
            if self.owner[place] != state:
                return -1, 0
            state, ordinal = int(self.target[place]), ordinal + int(self.more[place])
        return state, ordinal

    def walk(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, states: np.ndarray, ordinals: np.ndarray) -> np.ndarray:
        """The ordinals of the words ``data[start:start + length]`` read on from the given states; -1 for others."""
        found = np.full(len(starts), -1, dtype=np.int64)
        word = np.flatnonzero(states >= 0)
        state, ordinal, at, ends = states[word], ordinals[word], starts[word], starts[word] + lengths[word]
        while len(word):
            place = self.base[state] + data[at]
            alive = np.flatnonzero(self.owner[place] == state)
            word, place, at, ends = word[alive], place[alive], at[alive] + 1, ends[alive]
            state, ordinal = self.target[place], ordinal[alive] + self.more[place]
            done = at == ends
            accepted = np.flatnonzero(done & self.final[state])
            found[word[accepted]] = ordinal[accepted]
            alive = np.flatnonzero(~done)
            word, at, ends, state, ordinal = word[alive], at[alive], ends[alive], state[alive], ordinal[alive]
        return found


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of an Arrow string array and the offsets of its texts in them."""
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int32)[texts.offset : texts.offset + len(texts) + 1]
    return np.frombuffer(texts.buffers()[2] or b"", dtype=np.uint8), offsets.astype(np.int64)


def words_of(
    data: np.ndarray, offsets: np.ndarray, piece: int = PIECE, alphabet: np.ndarray = LETTERS
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """The words of texts that lie one after the other in ``data``, some MB at a time.

    Yields the lower-cased bytes of a stretch, the starts and lengths of its words in them and the
    number of each word's text. A stretch ends between words, however long they are. ``alphabet`` has
    what becomes of each byte, 0 for those that part words.
    """
    first, end = int(offsets[0]), int(offsets[-1])
    while first < end:
        cut = min(first + piece, end)
        while cut < end:
            border = int(offsets[np.searchsorted(offsets, cut)])
            parts = np.flatnonzero(alphabet[data[cut : min(border, cut + piece)]] == 0)
            if len(parts) or border <= cut + piece:
                cut = cut + int(parts[0]) if len(parts) else border
                break
            cut += piece
        letters = alphabet[data[first:cut]]
        inside = letters > 0
        begins, stops = inside.copy(), inside.copy()
        begins[1:] &= ~inside[:-1]
        stops[:-1] &= ~inside[1:]
        borders = offsets[np.searchsorted(offsets, first, "right") : np.searchsorted(offsets, cut)] - first
        begins[borders] = inside[borders]
        stops[borders - 1] = inside[borders - 1]
        starts = np.flatnonzero(begins)
        yield letters, starts, np.flatnonzero(stops) - starts + 1, np.searchsorted(offsets, starts + first, "right") - 1
        first = cut
