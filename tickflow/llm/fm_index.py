"""A bidirectional FM-index over a delimited list of words, searched with one error, in numpy.

The text is ``$w1$w2$...$wn$``.  A pattern is an interval of the sorted
suffixes and, kept in step with it, the interval of the reversed pattern among
the sorted suffixes of the reversed text; it can therefore grow at either end.
Both Burrows-Wheeler transforms are wavelet matrices, so one growth step is a
few array look-ups for all patterns of a batch at once.

When suffixes are compared, every delimiter is a symbol of its own that ranks by
the word after it (the words are distinct), so no comparison goes beyond a word's
end and the order is that of a proper suffix sort.
"""

from __future__ import annotations

import numpy as np

#: Queries and symbols of queries searched at once; bounds the arrays of a step, not the result.
BATCH = 20_000
BATCH_SYMBOLS = 1_000_000


def sorted_suffixes(text: np.ndarray, delimiter_rank: np.ndarray) -> np.ndarray:
    """Positions of ``text`` (0 is the delimiter) in the order of their suffixes, by prefix doubling."""
    t = len(text)
    rank = text.astype(np.int64) + len(delimiter_rank)
    rank[text == 0] = delimiter_rank
    step = 1
    order = np.argsort(rank, kind="stable")
    while True:
        sorted_rank = rank[order]
        new = np.empty(t, np.int64)
        new[order] = np.concatenate([[0], np.cumsum(sorted_rank[1:] != sorted_rank[:-1])])
        if new.max() == t - 1:
            return order
        rank = new * t + np.roll(new, -step)
        order = np.argsort(rank, kind="stable")
        step *= 2


class Wavelet:
    """Counts of a symbol, and of the smaller ones, in any stretch of a sequence."""

    def __init__(self, symbols: np.ndarray, n_symbols: int):
        self.bits = max(1, int(n_symbols - 1).bit_length())
        self.zeros, self.n_zeros = [], []
        s = symbols.astype(np.int32)
        for shift in range(self.bits - 1, -1, -1):
            zero = (s >> shift & 1) == 0
            self.zeros.append(np.concatenate([[0], np.cumsum(zero)]).astype(np.int32))
            self.n_zeros.append(np.int32(zero.sum()))
            s = np.concatenate([s[zero], s[~zero]])
        every = np.arange(n_symbols)
        none = np.zeros(n_symbols, np.int32)
        self.first = none
        self.first = self._walk(none, none, every)[0]

    def _walk(self, lo, hi, symbol):
        smaller = np.zeros(len(lo), np.int32)
        for level, shift in enumerate(range(self.bits - 1, -1, -1)):
            zeros, z = self.zeros[level], self.n_zeros[level]
            one = (symbol >> shift & 1).astype(bool)
            lo0, hi0 = zeros[lo], zeros[hi]
            smaller += np.where(one, hi0 - lo0, 0)
            lo, hi = np.where(one, z + lo - lo0, lo0), np.where(one, z + hi - hi0, hi0)
        return lo, hi, smaller

    def count(self, lo: np.ndarray, hi: np.ndarray, symbol: np.ndarray):
        """How often ``symbol`` occurs before lo and in [lo, hi), and how many in [lo, hi) are smaller."""
        a, b, smaller = self._walk(lo, hi, symbol)
        return a - self.first[symbol], b - a, smaller


class Patterns:
    """A batch of patterns: where each is in the forward and in the reverse order, and how often it occurs."""

    __slots__ = ("here", "back", "n")

    def __init__(self, here: np.ndarray, back: np.ndarray, n: np.ndarray):
        self.here, self.back, self.n = here, back, n

    def take(self, which: np.ndarray) -> Patterns:
        return Patterns(self.here[which], self.back[which], self.n[which])


class FmIndex:
    """The index of distinct words, numbered as in ``words``, which is sorted."""

    def __init__(self, words: list[str], alphabet: str = ""):
        """``alphabet``: code points of queries that may not occur in the words."""
        self.words = words = sorted(words)
        points = np.frombuffer("".join(words).encode("utf-32-le"), "<u4")
        self.alphabet = np.unique(np.concatenate([points, np.frombuffer(alphabet.encode("utf-32-le"), "<u4")]))
        self.n_symbols = len(self.alphabet) + 1
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        text = np.zeros(len(points) + len(words) + 1, np.int32)
        at = np.arange(len(points)) + np.repeat(np.arange(len(words)), lengths) + 1
        text[at] = np.searchsorted(self.alphabet, points) + 1
        n = len(words)  # the last delimiter has no word after it and comes first
        order = sorted_suffixes(text, np.concatenate([np.arange(1, n + 1), [0]]))
        delimiter = np.cumsum(text == 0) - 1
        self.word_at = delimiter[order].astype(np.int32)  # of a suffix that starts with a delimiter: the word after it
        self.before = text[order - 1]
        mirrored = text[::-1]
        mirror_rank = np.empty(n + 1, np.int64)  # of the delimiters of the mirrored text, whose first one precedes the last word
        mirror_rank[[*sorted(range(n), key=lambda i: words[n - 1 - i][::-1])]] = np.arange(1, n + 1)
        mirror_rank[n] = 0
        back = sorted_suffixes(mirrored, mirror_rank)
        self.after = mirrored[back - 1]
        self.smaller = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.n_symbols))]).astype(np.int32)
        self.left_side, self.right_side = Wavelet(self.before, self.n_symbols), Wavelet(self.after, self.n_symbols)
        self.n_delimiters = len(words) + 1

    def symbols(self, words: list[str], width: int) -> np.ndarray:
        """The words' symbols, a row each, filled up with 0; every code point must be in the alphabet."""
        out = np.zeros((len(words), width), np.int32)
        for i, w in enumerate(words):
            out[i, :len(w)] = np.searchsorted(self.alphabet, np.frombuffer(w.encode("utf-32-le"), "<u4")) + 1
        return out

    def starts(self, n: int) -> Patterns:
        """n times the pattern of a delimiter alone."""
        return Patterns(np.zeros(n, np.int32), np.zeros(n, np.int32), np.full(n, self.n_delimiters, np.int32))

    def left(self, p: Patterns, symbol: np.ndarray) -> Patterns:
        """``symbol`` put before each pattern."""
        before, n, smaller = self.left_side.count(p.here, p.here + p.n, symbol)
        return Patterns(self.smaller[symbol] + before, p.back + smaller, n)

    def right(self, p: Patterns, symbol: np.ndarray) -> Patterns:
        """``symbol`` put after each pattern."""
        before, n, smaller = self.right_side.count(p.back, p.back + p.n, symbol)
        return Patterns(p.here + smaller, self.smaller[symbol] + before, n)

    def _next_symbols(self, p: Patterns, rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """(pattern, symbol) of the symbols by which a pattern can grow; all symbols for very frequent patterns."""
        lo, next_to = (p.back, self.after) if rightward else (p.here, self.before)
        few = np.flatnonzero(p.n <= 2 * self.n_symbols)
        rows = np.repeat(few, p.n[few])
        ends = np.cumsum(p.n[few])
        at = np.arange(len(rows)) - np.repeat(ends - p.n[few], p.n[few]) + lo[rows]
        found = np.unique(rows * self.n_symbols + next_to[at])
        many = np.flatnonzero(p.n > 2 * self.n_symbols)
        every = (many[:, None] * self.n_symbols + np.arange(1, self.n_symbols)).ravel()
        both = np.concatenate([found, every])
        return both // self.n_symbols, both % self.n_symbols

    def one_more_or_other(self, words: list[str], exact: list[int], rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        """(query, word) pairs: the indexed word is the query with one symbol replaced or inserted.

        Scheme: the query's first ``exact`` symbols (read from its end if not ``rightward``)
        are matched as they are, the rest with exactly one error.  Each pair comes once: an
        inserted symbol differs from the one after it, so it stands last in its run.
        """
        order = sorted(range(len(words)), key=lambda i: len(words[i]))  # batches of words of about one length
        query, word = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        while order:
            n = 1
            while n < min(BATCH, len(order)) and (n + 1) * len(words[order[n]]) <= BATCH_SYMBOLS:
                n += 1
            which, order = order[:n], order[n:]
            a, b = self._scheme([words[i] for i in which], np.array([exact[i] for i in which]), rightward)
            query.append(np.array(which)[a])
            word.append(b)
        return np.concatenate(query), np.concatenate(word)

    def _scheme(self, words: list[str], exact: np.ndarray, rightward: bool) -> tuple[np.ndarray, np.ndarray]:
        length = np.fromiter(map(len, words), np.int64, len(words))
        grow = self.right if rightward else self.left
        q = self.symbols(words if rightward else [w[::-1] for w in words], int(length.max()) + 1)
        one, sound = np.arange(len(words)), self.starts(len(words))  # queries matched without an error so far
        wrong, erring = np.empty(0, np.int64), self.starts(0)  # queries and patterns with their error behind them
        out_query, out_pattern = [], []
        for i in range(q.shape[1]):
            new = np.flatnonzero(exact[one] <= i)
            which, symbol = self._next_symbols(sound.take(new), rightward)
            which = new[which]
            other = (symbol != 0) & (symbol != q[one[which], i])
            which, symbol = which[other], symbol[other]
            grown = grow(sound.take(which), symbol)
            there = np.flatnonzero(grown.n)
            grown, query = grown.take(there), one[which[there]]
            # inserted before symbol i, which is still to come; replaced: symbol i is done
            wrong, erring = np.concatenate([wrong, query]), _joined(erring, grown)
            over = length[wrong] == i
            out_query.append(wrong[over])
            out_pattern.append(erring.take(over))
            wrong, erring = wrong[~over], erring.take(~over)
            erring = grow(erring, q[wrong, i])
            alive = np.flatnonzero(erring.n)
            wrong, erring = wrong[alive], erring.take(alive)
            replaced = np.flatnonzero(length[query] > i)
            wrong, erring = np.concatenate([wrong, query[replaced]]), _joined(erring, grown.take(replaced))
            more = np.flatnonzero(length[one] > i)
            one, sound = one[more], grow(sound.take(more), q[one[more], i])
            alive = np.flatnonzero(sound.n)
            one, sound = one[alive], sound.take(alive)
        query, pattern = np.concatenate(out_query), out_pattern[0]
        for p in out_pattern[1:]:
            pattern = _joined(pattern, p)
        closed = grow(pattern, np.zeros(len(query), np.int32))
        whole = np.flatnonzero(closed.n)
        return query[whole], self.word_at[closed.here[whole]].astype(np.int64)


def _joined(a: Patterns, b: Patterns) -> Patterns:
    return Patterns(np.concatenate([a.here, b.here]), np.concatenate([a.back, b.back]), np.concatenate([a.n, b.n]))
