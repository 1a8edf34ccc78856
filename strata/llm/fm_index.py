"""FM-index over a wavelet matrix, for matching statistics up to a fixed depth.

The text is a row of word numbers (0 separates passages). Its suffixes are
sorted by their first ``depth`` words, which is all that patterns of at most
``depth`` words need. What is kept is the Burrows-Wheeler transform in a wavelet
matrix (one packed bit vector per bit of a word number, with block counts) and,
per row, the common prefix with the row above (cut at ``depth``), the rows where
that interval ends, and the smallest owner of each interval of full depth.

Queries run backwards, many in step with each other: a word is put before the
match by two ranks; where that fails the match is cut to the next shorter
interval that exists (its parent), and tried again.
"""

from __future__ import annotations

import numpy as np

NO_OWNER = np.iinfo(np.int64).max


class WaveletMatrix:
    """Ranks of symbols in a sequence, one packed bit vector per bit of the symbols."""

    def __init__(self, seq: np.ndarray, symbols: int):
        self.levels = max(int(symbols - 1).bit_length(), 1)
        self.words, self.counts, self.zeros = [], [], []
        for level in range(self.levels - 1, -1, -1):
            bit = (seq >> level & 1).astype(np.uint8)
            packed = np.zeros(len(seq) // 64 * 8 + 8, np.uint8)
            part = np.packbits(bit, bitorder="little")
            packed[:len(part)] = part
            words = packed.view(np.uint64)
            ones = np.bitwise_count(words).astype(np.int64)
            self.words.append(words)
            self.counts.append(np.cumsum(ones) - ones)
            self.zeros.append(len(seq) - int(ones.sum()))
            seq = np.concatenate([seq[bit == 0], seq[bit == 1]])
        self.start = self._descend(np.arange(symbols), np.zeros(symbols, np.int64))

    def _descend(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for i in range(self.levels):
            block, inside = at >> 6, (at & 63).astype(np.uint64)
            below = (np.uint64(1) << inside) - np.uint64(1)
            ones = self.counts[i][block] + np.bitwise_count(self.words[i][block] & below)
            bit = symbol >> (self.levels - 1 - i) & 1
            at = np.where(bit == 1, self.zeros[i] + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """How often each symbol stands before place ``at``."""
        return self._descend(symbol, at) - self.start[symbol]


class FMIndex:
    def __init__(self, seq: np.ndarray, owner: np.ndarray, depth: int):
        """``seq``: word numbers 1, 2, ...; 0 after each passage. ``owner``: a number for each place."""
        n = self.n = len(seq)
        self.depth = depth
        names, size = [seq.astype(np.int32)], 1
        while size < depth:  # names of blocks of 1, 2, 4, ... words, in the order of the blocks
            low = names[-1]
            nxt = np.zeros(n, np.int64)
            if size < n:
                nxt[:-size] = low[size:].astype(np.int64) + 1
            pair = low.astype(np.int64) * (int(low.max()) + 2) + nxt
            names.append(np.unique(pair, return_inverse=True)[1].astype(np.int32))
            size *= 2
        rows = np.argsort(names[-1], kind="stable")
        symbols = int(seq.max()) + 1
        self.bwt = WaveletMatrix(seq[rows - 1].astype(np.int64), symbols)  # the last place is a separator
        self.first = np.concatenate(([0], np.cumsum(np.bincount(seq, minlength=symbols))))
        # common prefix of neighbouring rows, at most ``depth``
        above, below = rows[:-1], rows[1:]
        common = np.zeros(max(n - 1, 0), np.int64)
        for k in range(len(names) - 1, -1, -1):
            x, y = above + common, below + common
            inside = np.flatnonzero((x < n) & (y < n) & (common + (1 << k) <= 2 * depth))
            same = names[k][x[inside]] == names[k][y[inside]]
            common[inside[same]] += 1 << k
        self.lcp = np.full(n + 1, -1, np.int16 if depth < 30_000 else np.int32)
        self.lcp[1:n] = np.minimum(common, depth)
        self.left, self.right = self._smaller(-1), self._smaller(1)
        # intervals of depth - 1 around each row, and of full depth with their smallest owner
        self.wide_from, self.wide_to = self._intervals(depth - 1)
        begin, _ = self._intervals(depth)
        edges = np.flatnonzero(begin == np.arange(n))
        self.least = np.minimum.reduceat(owner[rows], edges)[np.searchsorted(edges, np.arange(n), side="right") - 1] \
            if n else np.zeros(0, np.int64)

    def _smaller(self, step: int) -> np.ndarray:
        """Nearest row before (-1) or after (1) each with a smaller common prefix, by jumps over known answers."""
        n, lcp = self.n, self.lcp
        out = np.clip(np.arange(n + 1) + step, 0, n).astype(np.int64)
        open_ = np.arange(1, n)
        while len(open_):
            open_ = open_[lcp[out[open_]] >= lcp[open_]]
            out[open_] = out[out[open_]]
        return out

    def _intervals(self, depth: int) -> tuple[np.ndarray, np.ndarray]:
        edge = np.flatnonzero(self.lcp[:self.n] < depth)
        own = np.searchsorted(edge, np.arange(self.n), side="right") - 1
        return edge[own], np.concatenate([edge[1:], [self.n]])[own]

    def least_owner(self, query: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Per place of ``query`` the smallest owner of a place in the text where the same ``depth`` words begin
        (``NO_OWNER``: none), for the pieces [begin, end) of the query; words that the text lacks are 0."""
        out = np.full(len(query), NO_OWNER, np.int64)
        count = np.append(np.diff(self.first), 0)
        query = np.where(count[np.minimum(query, len(count) - 1)] > 0, query, 0)
        order = np.argsort(begin - end, kind="stable")  # longest first
        end, size = end[order], (end - begin)[order]
        low, high = np.zeros(len(order), np.int64), np.full(len(order), self.n, np.int64)
        length = np.zeros(len(order), np.int64)
        for t in range(int(size.max(initial=0))):
            live = int(np.searchsorted(-size, -t, side="left"))
            place = end[:live] - 1 - t
            word = query[place]
            full = np.flatnonzero(length[:live] == self.depth)
            if len(full):  # drop the last word of a match of full depth
                row = low[full]
                low[full], high[full], length[full] = self.wide_from[row], self.wide_to[row], self.depth - 1
            stop = np.flatnonzero(word == 0)
            low[stop], high[stop], length[stop] = 0, self.n, 0
            tried = np.flatnonzero(word != 0)
            while len(tried):
                w = word[tried]
                ranks = self.bwt.rank(np.concatenate([w, w]), np.concatenate([low[tried], high[tried]]))
                new_low, new_high = self.first[w] + ranks[:len(w)], self.first[w] + ranks[len(w):]
                good = new_low < new_high
                hit = tried[good]
                low[hit], high[hit] = new_low[good], new_high[good]
                length[hit] += 1
                tried = tried[~good]
                a, b = self.lcp[low[tried]], self.lcp[high[tried]]
                row = np.where(a >= b, low[tried], high[tried])
                low[tried], high[tried], length[tried] = self.left[row], self.right[row], np.maximum(a, b)
            done = np.flatnonzero(length[:live] == self.depth)
            out[place[done]] = self.least[low[done]]
        return out
