"""A vocabulary as a minimal acyclic transducer: sorted terms in, lexicographic ordinals out.

Terms are UTF-8 byte strings. States with equal ends are one state, also across the languages of a part; every
transition carries how many terms come before those behind it, so the sum along a term's path is its ordinal.
"""

from __future__ import annotations

import io
import json
from collections.abc import Iterable

import numpy as np

from waitflow.llm.probing import Places

_IS_TERM = np.zeros(256, bool)
_IS_TERM[[*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 32

#: Maps term bytes to themselves, A-Z lower-cased, and all other bytes to a blank.
TERM_BYTES = bytes(int(_LOWER[b]) if _IS_TERM[b] else 0x20 for b in range(256))


class Builder:
    """Takes terms in ascending order of (root name, term)."""

    def __init__(self) -> None:
        self.register: dict[tuple, int] = {}
        self.finals: list[bool] = []
        self.reach: list[int] = []  # terms that can be completed from a state
        self.edges: list[tuple[int, int, int, int]] = []  # state, label, next state, terms before
        self.roots: dict[str, int] = {}

    def _freeze(self, final: bool, labels: list[int], children: list[int]) -> int:
        key = (final, *labels, *children)
        state = self.register.get(key)
        if state is None:
            state = self.register[key] = len(self.finals)
            before = int(final)
            for label, child in zip(labels, children):
                self.edges.append((state, label, child, before))
                before += self.reach[child]
            self.finals.append(final)
            self.reach.append(before)
        return state

    def add_root(self, name: str, terms: Iterable[bytes]) -> None:
        """One language. The last term's path stays open; what the next term leaves behind is frozen."""
        path: list[list] = [[False, [], []]]
        last = b""
        for term in terms:
            same = 0
            most = min(len(term), len(last))
            while same < most and term[same] == last[same]:
                same += 1
            while len(path) > same + 1:
                child = self._freeze(*path.pop())
                path[-1][2].append(child)
            for label in term[same:]:
                path[-1][1].append(label)
                path.append([False, [], []])
            path[-1][0] = True
            last = term
        while len(path) > 1:
            child = self._freeze(*path.pop())
            path[-1][2].append(child)
        self.roots[name] = self._freeze(*path[0])

    def dump(self) -> bytes:
        state, label, to, before = np.array(self.edges, np.int64).reshape(-1, 4).T
        out = io.BytesIO()
        np.savez(
            out, key=(state << 8) | label, to=to.astype(np.int32), before=before.astype(np.int32),
            finals=np.array(self.finals, bool), names=np.frombuffer(json.dumps(list(self.roots)).encode(), np.uint8),
            roots=np.array(list(self.roots.values()), np.int32),
        )
        return out.getvalue()


class Transducer:
    """Reads the terms of many texts in lockstep, one byte of every term that is still alive at a step."""

    def __init__(self, payload: bytes):
        data = np.load(io.BytesIO(payload))
        self.places = Places(data["key"])
        self.to, self.before, self.finals = data["to"].astype(np.int64), data["before"].astype(np.int64), data["finals"]
        self.roots = dict(zip(json.loads(data["names"].tobytes()), data["roots"].tolist()))

    def ordinals(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray, roots: np.ndarray) -> np.ndarray:
        """Ordinal of each term data[start : start + length] below its root state, -1 for terms that are not kept."""
        out = np.full(len(starts), -1, np.int64)
        alive = np.flatnonzero(roots >= 0)
        state, total, step = roots[alive].astype(np.int64), np.zeros(len(alive), np.int64), 0
        while len(alive):
            ended = lengths[alive] == step
            if ended.any():
                done = ended & self.finals[state]
                out[alive[done]] = total[done]
                go = ~ended
                alive, state, total = alive[go], state[go], total[go]
            edge = self.places.find((state << 8) | _LOWER[data[starts[alive] + step]])
            known = edge >= 0
            alive, edge = alive[known], edge[known]
            state, total, step = self.to[edge], total[known] + self.before[edge], step + 1
        return out


def term_spans(data: np.ndarray, text_starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the maximal runs of term bytes in texts that lie one behind the other."""
    inside = np.concatenate([[False], _IS_TERM[data], [False]])
    cut = np.zeros(len(data) + 1, bool)
    cut[text_starts[text_starts <= len(data)]] = True
    before, after = inside[:-1], inside[1:]  # of the places between bytes
    starts = np.flatnonzero(after & (~before | cut))
    ends = np.flatnonzero(before & (~after | cut))
    return starts, ends - starts
