"""Substring dedup by recompression of word sequences.

Runs of one word are replaced by new symbols once, and then, round by round, pairs of
neighbouring symbols; equal symbols that meet in later rounds stay apart. A symbol's name depends on its content alone, so every
task gives equal content the same name. Which pairs merge is decided by one bit of
each symbol's name, new in every round: a left symbol merges with a right symbol
behind it. Each symbol carries the words on which its making depended; a window
that holds them all has this symbol wherever it occurs.

The anchors of a window are the symbols of its highest level, those with the least
name. Shared anchors reveal repeats; their surroundings, compared by name, verify
them (``ridestrata.llm.repeats``)."""

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ridestrata.llm.repeats import CROWD, HOT, Units, merged, name, repeated_spans, with_spans

WIDTH = 20
ROUNDS = 6
PAD = 0xFFFFFFFFFFFFFFFF
_MOST = np.uint64(PAD)


class _WordNames(dict):
    """Names of words, kept up to a limit."""

    def __missing__(self, word: bytes) -> int:
        found = xxhash.xxh64_intdigest(word)
        found -= found == PAD
        if len(self) >= 300_000:
            self.clear()
        self[word] = found
        return found


_names = _WordNames()


def _words(text: bytes) -> np.ndarray:
    words = text.split()
    return np.fromiter(map(_names.__getitem__, words), dtype=np.uint64, count=len(words))


def _single(array: np.ndarray) -> tuple[np.ndarray, int]:
    return array, 1


class _Symbols:
    """Symbols in order: names, the words [start, stop) they stand for, and the
    words [low, high) on which they depend."""

    def __init__(self, names, start, stop, low, high):
        self.names, self.start, self.stop, self.low, self.high = names, start, stop, low, high

    def runs(self) -> "_Symbols":
        """Runs of equal symbols as one; where a run ends, its neighbours tell."""
        new = np.r_[True, (self.names[1:] != self.names[:-1]) | (self.names[1:] == _MOST)]
        head = np.flatnonzero(new)
        count = np.diff(np.r_[head, len(self.names)])
        names = np.where(count > 1, name(self.names[head], count.astype(np.uint64)), self.names[head])
        low = np.minimum.reduceat(self.low, head)
        high = np.maximum.reduceat(self.high, head)
        low = np.minimum(low, np.r_[low[:1], low[:-1]])
        high = np.maximum(high, np.r_[high[1:], high[-1:]])
        return _Symbols(names, self.start[head], self.stop[head + count - 1], low, high)

    def pairs(self, turn: int) -> tuple["_Symbols", np.ndarray]:
        """Left symbols merged with right ones; which of the new symbols are pairs."""
        pad = self.names == _MOST
        side = name(self.names, np.full(1, turn + 1, dtype=np.uint64)) >> np.uint64(63)
        left, right = (side == 0) & ~pad, (side == 1) & ~pad
        pair = np.r_[left[:-1] & right[1:], False]
        taken = np.r_[False, pair[:-1]]
        # A left symbol that stays alone depends on the next one, a right one on the last.
        high = np.where(left & ~pair, np.maximum(self.high, np.r_[self.high[1:], self.high[-1:]]), self.high)
        low = np.where(right & ~taken, np.minimum(self.low, np.r_[self.low[:1], self.low[:-1]]), self.low)
        keep = np.flatnonzero(~taken)
        paired = pair[keep]
        other = np.minimum(keep + 1, len(pad) - 1)
        merge = name(name(self.names[keep], self.names[other]), np.full(1, turn + 101, dtype=np.uint64))
        symbols = _Symbols(
            np.where(paired, merge, self.names[keep]),
            self.start[keep],
            np.where(paired, self.stop[other], self.stop[keep]),
            low[keep],
            np.where(paired, high[other], high[keep]),
        )
        return symbols, paired


def _symbols_of(array: np.ndarray) -> _Symbols:
    """Words as symbols, with one pad between texts on which nothing can rely."""
    pad = array == _MOST
    keep = np.flatnonzero(~pad | np.r_[True, ~pad[:-1]])
    far = len(array) * 4 + 1
    low = np.where(pad[keep], -far, keep)
    high = np.where(pad[keep], far, keep + 1)
    return _Symbols(array[keep], keep, keep + 1, low, high)


def _candidates(array: np.ndarray, width: int, rounds: int):
    """Symbols that fit a window with all they depend on: level, name, place."""
    symbols = _symbols_of(array)
    found = []

    def add(level: int, some: _Symbols, which: np.ndarray) -> None:
        fits = np.flatnonzero(which & (some.high - some.low <= width) & (some.names != _MOST))
        rank = np.uint64(level << 60) | (some.names[fits] >> np.uint64(4))
        found.append((rank, *(x[fits] for x in (some.names, some.start, some.stop, some.low, some.high))))

    words = symbols
    symbols = symbols.runs()
    add(2, symbols, symbols.stop - symbols.start > 1)
    for turn in range(rounds):
        symbols, paired = symbols.pairs(turn)
        add(turn + 3, symbols, paired)
    return [np.concatenate(column) for column in zip(*found)], words


def _best(best: np.ndarray, rank: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """At each window start the highest rank among the symbols that it holds."""
    depth = width.bit_length()
    tables = [best] + [np.zeros_like(best) for _ in range(1, depth)]
    power = np.floor(np.log2(last - first + 1)).astype(np.int64)
    for k in range(depth):
        some = power == k
        np.maximum.at(tables[k], first[some], rank[some])
        np.maximum.at(tables[k], last[some] - (1 << k) + 1, rank[some])
    for k in range(depth - 1, 0, -1):
        half = 1 << (k - 1)
        np.maximum(tables[k - 1], tables[k], out=tables[k - 1])
        np.maximum(tables[k - 1][half:], tables[k][:-half], out=tables[k - 1][half:])
    return tables[0]


def _chosen(best: np.ndarray, rank: np.ndarray, first: np.ndarray, last: np.ndarray, width: int) -> np.ndarray:
    """Which symbols are the best of a window; ``best`` is at least each one's rank
    wherever it is held, so the least ``best`` on its range tells."""
    power = np.floor(np.log2(last - first + 1)).astype(np.int64)
    chosen = np.zeros(len(rank), dtype=bool)
    least = best
    for k in range(width.bit_length()):
        some = np.flatnonzero(power == k)
        lowest = np.minimum(least[first[some]], least[last[some] - (1 << k) + 1])
        chosen[some] = lowest == rank[some]
        step = 1 << k
        least = np.minimum(least, np.r_[least[step:], np.full(min(step, len(least)), _MOST)])
    return chosen


def _high_symbols(array: np.ndarray, inside: np.ndarray, width: int, rounds: int = ROUNDS):
    (rank, names, start, stop, low, high), words = _candidates(array, width, rounds)
    first, last = high - width, low
    best = _best(np.zeros(len(array), dtype=np.uint64), rank, first, last, width)
    # Windows of one word's run hold no symbol of a higher level: there the words serve.
    bare = np.cumsum(np.r_[0, inside & (best == 0)])
    begin, end = np.maximum(words.start - width + 1, 0), words.start + 1
    lone = np.flatnonzero((words.names != _MOST) & (bare[end] > bare[begin]))
    word_rank = (np.uint64(1) << np.uint64(60)) | (words.names[lone] >> np.uint64(4))
    word_first, word_last = words.start[lone] - width + 1, words.start[lone]
    best = _best(best, word_rank, word_first, word_last, width)
    best = np.where(inside, best, _MOST)
    one = _chosen(best, rank, first, last, width)
    two = _chosen(best, word_rank, word_first, word_last, width)
    at = np.concatenate([start[one], words.start[lone][two]])
    size = np.concatenate([(stop - start)[one], np.ones(two.sum(), dtype=np.int64)])
    return at, size, np.concatenate([names[one], words.names[lone][two]])


def word_units(width: int = WIDTH) -> Units:
    return Units(width, "<u8", PAD, _words, _single, _high_symbols)


CUT = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_removed", T.LongType()),
        T.StructField("kept", T.StringType()),
    ]
)


def recompression_dedup(docs: DataFrame, width: int = WIDTH, crowd: int = CROWD, hot: float = HOT) -> DataFrame:
    """(doc_id, n_words, n_removed, kept) per row of ``docs``: each text without the
    words covered by a window of ``width`` words that also starts earlier, in a text
    with a smaller doc_id or before it in the same text; kept words are joined by
    single spaces.

    Null texts have no words. Repeated rows get the same result each. Rows without
    doc_id are left whole and cover nothing. Of different texts under one doc_id one
    is judged, the others are left whole. An empty table gives no rows; other columns
    are not read."""

    def kept(text: bytes, starts: np.ndarray, stops: np.ndarray, copy: bool) -> tuple:
        words = text.split()
        n = len(words)
        if copy and n >= width:
            return n, n, ""
        starts, stops = merged(starts, stops, n)
        cuts = [0, *np.stack([starts, stops], axis=1).ravel().tolist(), n]
        left = [word for a, b in zip(cuts[::2], cuts[1::2]) for word in words[a:b]]
        return n, n - len(left), b" ".join(left).decode()

    found = repeated_spans(docs, word_units(width), True, crowd, hot)
    cut = with_spans(docs.select("doc_id", "text"), found, kept, CUT)
    return cut.select("doc_id", "_rs_cut.*")
