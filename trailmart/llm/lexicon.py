"""A lexicon of words with the ids of their tokens, as a minimal acyclic automaton over bytes.

Words that share endings share states. Each state knows how many words can be completed from it, so
adding the counts of the transitions passed over gives a word's number, and the number its ids: the
automaton is a transducer whose outputs are pushed to the transitions as integers. It is stored as flat
arrays in one file that workers map into memory, and many words walk it at once, a byte a step.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

import numpy as np

MAGIC = b"TRLX0001"
ARRAYS = (("keys", "<i8"), ("targets", "<i4"), ("skips", "<i4"), ("final", "<u1"), ("offsets", "<i4"), ("ids", "<i4"))


def build(words: Iterable[bytes], ids: dict[bytes, list[int]]) -> bytes:
    """The automaton of ``words`` (distinct, in byte order) with their ids, as the bytes of a file.

    States are made minimal as they are closed, from the ends of the words: a state equal to one
    already kept (same finality, same transitions) is replaced by it.
    """
    kept: dict[tuple, int] = {}
    shapes: list[tuple] = []
    totals: list[int] = []

    def close(state: list) -> int:
        shape = (state[0], tuple(state[1]))
        at = kept.get(shape)
        if at is None:
            at = kept[shape] = len(shapes)
            shapes.append(shape)
            totals.append(state[0] + sum(totals[t] for _, t in shape[1]))
        return at

    path: list[list] = [[0, []]]  # open states of the last word: finality and closed transitions
    last, offsets, flat = b"", [0], []
    for word in words:
        same = 0
        while same < len(last) and same < len(word) and last[same] == word[same]:
            same += 1
        for depth in range(len(last), same, -1):
            path[depth - 1][1].append((last[depth - 1], close(path.pop())))
        path += ([0, []] for _ in range(len(word) - same))
        path[-1][0] = 1
        flat += ids[word]
        offsets.append(len(flat))
        last = word
    for depth in range(len(last), 0, -1):
        path[depth - 1][1].append((last[depth - 1], close(path.pop())))
    root = close(path[0])
    keys, targets, skips = [], [], []
    for state, (final, moves) in enumerate(shapes):
        passed = final
        for byte, target in sorted(moves):
            keys.append(state << 8 | byte)
            targets.append(target)
            skips.append(passed)
            passed += totals[target]
    data = {"keys": keys, "targets": targets, "skips": skips, "final": [f for f, _ in shapes], "offsets": offsets, "ids": flat}
    head = {"root": root, "sizes": {name: len(data[name]) for name, _ in ARRAYS}}
    body = b"".join(np.asarray(data[name], kind).tobytes().ljust(-(-len(data[name]) * int(kind[2]) // 8) * 8, b"\0") for name, kind in ARRAYS)
    text = json.dumps(head).encode()
    text = text.ljust(-(-(len(text) + 16) // 8) * 8 - 16)
    return MAGIC + len(text).to_bytes(8, "little") + text + body


class Lexicon:
    """The automaton of a file, mapped into memory."""

    def __init__(self, path: str) -> None:
        raw = np.memmap(path, np.uint8, "r")
        if bytes(raw[:8]) != MAGIC:
            raise ValueError(f"{path} is no lexicon")
        at = 16 + int.from_bytes(bytes(raw[8:16]), "little")
        head = json.loads(bytes(raw[16:at]))
        self.root = head["root"]
        for name, kind in ARRAYS:
            size = head["sizes"][name] * int(kind[2])
            setattr(self, name, raw[at : at + size].view(kind))
            at += -(-size // 8) * 8

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def find(self, data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The numbers of the words at data[start : start + length], or -1 where a word is unknown."""
        found = np.full(len(starts), -1, np.int64)
        live = np.flatnonzero(lengths > 0)
        state = np.full(len(live), self.root, np.int64)
        number = np.zeros(len(live), np.int64)
        step = 0
        while len(live) and len(self.keys):
            ended = lengths[live] == step
            if ended.any():
                done = ended & (self.final[state] == 1)
                found[live[done]] = number[done]
                live, state, number = live[~ended], state[~ended], number[~ended]
                if not len(live):
                    break
            key = state << 8 | data[starts[live] + step]
            at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
            known = self.keys[at] == key
            live, at = live[known], at[known]
            number = number[known] + self.skips[at]
            state = self.targets[at].astype(np.int64)
            step += 1
        return found
