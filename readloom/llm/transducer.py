"""A minimal acyclic automaton that maps words to lists of ids."""

from __future__ import annotations

import numpy as np
import pyarrow as pa


class Lexicon:
    """Words (bytes) with id lists, in arrays that can be memory-mapped.

    The automaton shares prefixes and suffixes. An arc's output is the number of accepted words that precede those behind
    it, so the outputs along a word's path add up to the word's number, which leads to its ids.
    """

    PARTS = ("first", "label", "target", "skip", "final", "start", "ids")

    def __init__(self, arrays: dict[str, np.ndarray]):
        self.arrays = arrays
        self.first, self.label, self.target, self.skip, self.final, self.start, self.ids = (arrays[p] for p in self.PARTS)
        n_arcs = np.diff(self.first[:-1])  # the last entry is the root
        self.arcs = np.repeat(np.arange(len(n_arcs), dtype=np.int64), n_arcs) * 256 + self.label  # rising: (state, byte)

    @classmethod
    def build(cls, words: dict[bytes, list[int]]) -> Lexicon:
        """From words in any order; a state is added once its right language is known, or found among the equal ones."""
        ordered = sorted(words)
        known: dict[tuple, int] = {}
        states: list[tuple[bool, tuple]] = []
        accepted: list[int] = []

        def keep(node: list) -> int:
            signature = (node[0], tuple(node[1]))
            if signature not in known:
                known[signature] = len(states)
                states.append(signature)
                accepted.append(int(node[0]) + sum(accepted[t] for _, t in node[1]))
            return known[signature]

        path: list[list] = [[False, []]]  # the unfinished states along the last word: final or not, arcs
        last = b""
        for word in ordered:
            shared = next((i for i, (x, y) in enumerate(zip(word, last)) if x != y), min(len(word), len(last)))
            while len(path) > shared + 1:
                done = keep(path.pop())
                path[-1][1].append((last[len(path) - 1], done))
            path.extend([False, []] for _ in word[shared:])
            path[-1][0] = True
            last = word
        while len(path) > 1:
            done = keep(path.pop())
            path[-1][1].append((last[len(path) - 1], done))
        root = keep(path.pop())

        first, label, target, skip = [0], [], [], []
        for final, arcs in states:
            before = int(final)
            for byte, to in arcs:
                label.append(byte)
                target.append(to)
                skip.append(before)
                before += accepted[to]
            first.append(len(label))
        lists = [words[w] for w in ordered]
        return cls(
            {
                "first": np.array([*first, root], np.int32),  # the root stands last
                "label": np.array(label, np.uint8),
                "target": np.array(target, np.int32),
                "skip": np.array(skip, np.int32),
                "final": np.array([f for f, _ in states], np.uint8),
                "start": np.cumsum([0, *map(len, lists)]).astype(np.int32),
                "ids": np.array([i for ids in lists for i in ids], np.int32),
            }
        )

    def numbers(self, words: pa.StringArray) -> np.ndarray:
        """Each word's number, or -1 for a word that isn't there. All words walk along the automaton together, byte by byte."""
        _, offsets, data = words.buffers()
        bounds = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
        text = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
        at, end = bounds[:-1], bounds[1:]
        state, number = np.full(len(words), int(self.first[-1]), np.int64), np.zeros(len(words), np.int64)
        walking, step = np.flatnonzero(at < end), 0
        while len(walking):
            key = state[walking] * 256 + text[at[walking] + step]
            arc = np.searchsorted(self.arcs, key)
            found = self.arcs[np.minimum(arc, len(self.arcs) - 1)] == key if len(self.arcs) else np.zeros(len(key), bool)
            state[walking[~found]] = -1
            walking, arc, step = walking[found], arc[found], step + 1
            state[walking], number[walking] = self.target[arc], number[walking] + self.skip[arc]
            walking = walking[at[walking] + step < end[walking]]
        accepted = (state >= 0) & (self.final[np.maximum(state, 0)] == 1)
        return np.where(accepted, number, -1)

    def find(self, word: str) -> list[int] | None:
        """The word's ids, or None for a word that isn't there."""
        n = int(self.numbers(pa.array([word], pa.string()))[0])
        return None if n < 0 else self.ids[self.start[n] : self.start[n + 1]].tolist()

    def to_bytes(self) -> bytes:
        """A header of part lengths, then the parts, each at a multiple of eight bytes."""
        out = [np.array([self.arrays[p].nbytes for p in self.PARTS], np.int64).tobytes()]
        for p in self.PARTS:
            raw = np.ascontiguousarray(self.arrays[p]).tobytes()
            out.append(raw + bytes(-len(raw) % 8))
        return b"".join(out)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        """Maps a file written from to_bytes(); all workers of a machine share its pages."""
        raw = np.memmap(path, np.uint8, "r")
        lengths = raw[: 8 * len(cls.PARTS)].view(np.int64)
        at, arrays = 8 * len(cls.PARTS), {}
        for part, n in zip(cls.PARTS, lengths.tolist()):
            arrays[part] = raw[at : at + n].view(np.uint8 if part in ("label", "final") else np.int32)
            at += n + -n % 8
        return cls(arrays)
