"""Token ids of whole texts by a public tokenizer file, computed once per distinct word of a task.

The tokenizer drops white space and never joins characters across it, so a text's ids are the ids of its
blank-separated chunks in a row.  Plain chunks (ASCII without apostrophes, and Latin-1 letters) are split further,
into letter runs, single digits and runs of other signs, as the tokenizer's own pattern does; every other chunk goes
to the tokenizer whole.  ``tests/llm`` holds this against the tokenizer on whole texts.
"""

from __future__ import annotations

import os

import numpy as np

from . import words as W

#: words kept in a task's table; beyond it the table starts anew
TABLE = 400_000
#: words that go to the tokenizer as one text, and what stands between them
TOGETHER, MARK = 256, "0"
#: texts that the tokenizer gets at a time: what it returns takes far more memory than the ids
AT_ONCE = 16

_BLANK, _LETTER, _DIGIT, _OTHER, _ODD = range(5)
_KIND = np.full(256, _ODD, np.uint8)
_KIND[[0x20, *range(0x09, 0x0E)]] = _BLANK
_KIND[0x21:0x7F] = _OTHER
_KIND[0x30:0x3A] = _DIGIT
_KIND[0x41:0x5B] = _LETTER
_KIND[0x61:0x7B] = _LETTER
_KIND[0x27] = _ODD  # an apostrophe may begin a contraction


class Encoder:
    """Ids of slices of texts; the table of known words is bounded by ``TABLE``."""

    def __init__(self, spec: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_str(spec)
        (self.mark,) = self.tok.encode(MARK, add_special_tokens=False).ids
        self._clear()

    def _clear(self) -> None:
        self.at: dict[int, int] = {}
        self.ids = np.empty(1 << 16, np.uint32)
        self.used = 0
        self.begin = np.empty(1 << 16, np.int64)
        self.size = np.empty(1 << 16, np.int64)

    def _encoded(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for k in range(0, len(texts), AT_ONCE)
                for e in self.tok.encode_batch_fast(texts[k : k + AT_ONCE], add_special_tokens=False)]

    def _ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row, how many each text has, and the order of the texts in that row.

        Words of letters go to the tokenizer many at a time, with a digit between them: white space keeps words apart,
        and no word of letters has a digit's id."""
        plain = np.fromiter(map(str.isalpha, texts), bool, len(texts))
        size = np.zeros(len(texts), np.int64)
        parts = np.empty(len(texts), object)
        at = np.flatnonzero(plain).tolist()
        groups = [at[k : k + TOGETHER] for k in range(0, len(at), TOGETHER)]
        joined = [f" {MARK} ".join([texts[i] for i in g]) for g in groups]
        rest, kept = np.flatnonzero(~plain).tolist(), []
        for g, ids in zip(groups, self._encoded(joined), strict=True):
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) + 1 != len(g):  # a word that becomes a digit after all
                rest += g
                continue
            kept += g
            size[g] = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
            parts[g[0]] = np.delete(ids, cut)  # the ids of the whole group, at its first word
        for i, ids in zip(rest, self._encoded([texts[i] for i in rest]), strict=True):
            size[i], parts[i] = len(ids), ids
        order = kept + rest
        flat = np.concatenate([x for x in parts[order] if x is not None] or [np.empty(0, np.uint32)])
        return flat, size, np.array(order, np.int64)

    def _learn(self, keys: list[int], texts: list[str]) -> None:
        flat, size, order = self._ids(texts)
        i, n = len(self.at), len(keys)
        while self.used + len(flat) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * len(self.ids))
        while i + n > len(self.begin):
            self.begin, self.size = np.resize(self.begin, 2 * len(self.begin)), np.resize(self.size, 2 * len(self.size))
        self.ids[self.used : self.used + len(flat)] = flat
        size = size[order]
        self.begin[i : i + n] = self.used + np.cumsum(size) - size
        self.size[i : i + n] = size
        self.at.update(zip([keys[k] for k in order.tolist()], range(i, i + n)))
        self.used += len(flat)

    def encode(self, s: W.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the slice in a row, and the bounds of each text's ids."""
        raw, n = s.data, len(s.data)
        if not n:
            return np.empty(0, np.uint32), np.zeros(len(s.bounds), np.int64)
        kind = _KIND[raw]
        lead = np.flatnonzero(raw[:-1] == 0xC3)
        lead = lead[(raw[lead + 1] != 0x97) & (raw[lead + 1] != 0xB7)]  # all but the signs x and :
        kind[lead] = _LETTER
        kind[lead + 1] = _LETTER
        low = W.lower(raw)
        cap = lead[raw[lead + 1] < 0x9F] + 1
        low[cap] += 0x20
        special = np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C))  # <|
        kind[special] = _ODD
        edge = np.zeros(n + 1, bool)
        edge[s.bounds] = True
        # chunks that hold anything odd are one word each, in their own case
        solid = kind != _BLANK
        opens = solid.copy()
        opens[1:] &= ~solid[:-1] | edge[1:n]
        chunk = np.cumsum(opens) - 1
        odd = np.flatnonzero(kind == _ODD)
        if len(odd):
            bad = np.zeros(int(chunk[-1]) + 1, bool)
            bad[chunk[odd]] = True
            whole = bad[np.maximum(chunk, 0)] & solid
            kind[whole] = _ODD
            low[whole] = raw[whole]
        starts = solid.copy()
        starts[1:] &= (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT) | edge[1:n]
        start = np.flatnonzero(starts)
        stops = solid.copy()
        stops[:-1] &= starts[1:] | ~solid[1:] | edge[1:n]
        end = np.flatnonzero(stops) + 1
        h = W.span_hash(W.prefix_hash(low), start, end)
        h[kind[start] == _ODD] ^= W.U64(0x5851F42D4C957F2D)
        uniq, first, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.at) + len(uniq) > TABLE:
            self._clear()
        keys = uniq.tolist()
        missing = [i for i, k in enumerate(keys) if k not in self.at]
        if missing:
            self._learn([keys[i] for i in missing],
                        [bytes(low[start[first[i]] : end[first[i]]]).decode("utf-8") for i in missing])
        known = np.fromiter(map(self.at.__getitem__, keys), np.int64, len(keys))[back]
        size = self.size[known]
        stop = np.cumsum(size)
        total = int(stop[-1]) if len(stop) else 0
        ids = self.ids[np.repeat(self.begin[known] - (stop - size), size) + np.arange(total)]
        bounds = np.concatenate([[0], stop])[np.searchsorted(start, s.bounds)]
        return ids, bounds
