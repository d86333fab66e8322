"""Token ids of many byte spans at once, from a table of spans met before.

Splitting a text before white space (or at it) changes no token of the public tokenizers used
here: no token crosses from a word into white space that follows. So a text's ids are those of
its spans, one after the other, and each distinct span is encoded once per task.
"""

from __future__ import annotations

import os

import numpy as np


def ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes ``starts[i] .. starts[i] + counts[i] - 1`` for every i, one after the other."""
    total = int(counts.sum())
    first = np.cumsum(counts) - counts
    return np.arange(total, dtype=np.int64) + np.repeat(starts - first, counts)


class SpanTable:
    """Ids by span hash, in sorted arrays. Emptied when it holds ``most`` spans; that only costs time.

    Spans are told apart by a 64-bit hash and their length. New ones are encoded together, with
    a special token of the vocabulary between them: the tokenizer cuts a text at special tokens
    before anything else, so every span is encoded as if alone. Spans that may hold a special
    token themselves go one by one.
    """

    def __init__(self, tokenizer_json: str, most: int = 500_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.most = Tokenizer.from_str(tokenizer_json), most
        added = sorted(self.tokenizer.get_added_tokens_decoder().items())
        self.mark_id, mark = next((number, t) for number, t in added if t.special and not t.normalized)
        self.mark = np.frombuffer(mark.content.encode(), np.uint8)
        self._clear()

    def _clear(self) -> None:
        self.names, self.ids = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts = self.counts = np.zeros(0, np.int64)

    def known(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Spans found elsewhere: for each span a first id and a count (-1: not found), and the ids."""
        return np.zeros(len(starts), np.int64), np.full(len(starts), -1, np.int64), np.zeros(0, np.int32)

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, names: np.ndarray) -> None:
        edge = np.concatenate(([0], np.cumsum(data == self.mark[0])))
        alone = edge[ends] > edge[starts]
        order = np.concatenate((np.flatnonzero(~alone), np.flatnonzero(alone)))
        starts, ends, names = starts[order], ends[order], names[order]
        found: list[np.ndarray] = []
        counts = np.zeros(len(names), np.int64)
        together = len(names) - int(alone.sum())
        for at in range(0, together, 4096):
            a, b = starts[at : min(at + 4096, together)], ends[at : min(at + 4096, together)]
            size = b - a
            place = np.cumsum(size + len(self.mark)) - size - len(self.mark)
            text = np.empty(int(size.sum()) + len(a) * len(self.mark), np.uint8)
            text[ragged(place, size)] = data[ragged(a, size)]
            text[(place + size)[:, None] + np.arange(len(self.mark))] = self.mark
            ids = np.array(self.tokenizer.encode_batch_fast([text.tobytes().decode("utf-8", "replace")], add_special_tokens=False)[0].ids, np.int32)
            stops = np.flatnonzero(ids == self.mark_id)
            counts[at : at + len(a)] = np.diff(stops, prepend=-1) - 1
            found.append(ids[ids != self.mark_id])
        for i in range(together, len(names)):
            ids = self.tokenizer.encode(data[starts[i] : ends[i]].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids
            counts[i] = len(ids)
            found.append(np.array(ids, np.int32))
        first = len(self.ids) + np.cumsum(counts) - counts
        self.ids = np.concatenate((self.ids, *found))
        order = np.argsort(names)
        at = np.searchsorted(self.names, names[order])
        self.names = np.insert(self.names, at, names[order])
        self.starts, self.counts = np.insert(self.starts, at, first[order]), np.insert(self.counts, at, counts[order])

    def _find(self, names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        slot = np.searchsorted(self.names, names)
        slot[slot == len(self.names)] = 0
        return slot, (self.names[slot] == names) if len(self.names) else np.zeros(len(names), bool)

    def encode(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the spans in order, and how many each span has."""
        keys = hashes + (ends - starts).astype(np.uint64)
        distinct, at, where = np.unique(keys, return_index=True, return_inverse=True)
        first, count, own = self.known(data, starts[at], ends[at])
        rest = np.flatnonzero(count < 0)
        if len(rest):
            if len(self.names) > self.most:
                self._clear()
            _, met = self._find(distinct[rest])
            new = rest[~met]
            if len(new):
                self._learn(data, starts[at[new]], ends[at[new]], distinct[new])
            slot, _ = self._find(distinct[rest])
            first[rest], count[rest] = self.starts[slot] + len(own), self.counts[slot]
        ids = np.concatenate((own, self.ids))
        per_span = count[where]
        return ids[ragged(first[where], per_span)], per_span
