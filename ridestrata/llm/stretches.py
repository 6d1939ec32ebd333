"""Texts as the stretches and pieces of byte-level BPE, of which each is encoded once.

Pieces do not reach over the ends of a stretch: white space ends one, and its last blank
goes with the word after it. So the ids of a text are those of its stretches, one after
another, and those of a stretch are those of its pieces. In texts whose words stand one
blank or one or two line feeds apart, stretches are the parts between blanks; Arrow finds
the different ones of many texts, and each is looked up once. A text that may hold an
added token is left to the tokenizer."""

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

STRETCHES = 250_000  #: stretches that a worker remembers, and as many older ones
RUNS = 10_000  #: runs of marks that a worker remembers
LONGEST = 64  #: characters of the longest that is remembered
ROWS_TOGETHER, BYTES_TOGETHER = 1024, 2 << 20  #: rows, and bytes of their texts, that are encoded together

#: The white space of Unicode, the pieces of byte-level BPE, the end of the
#: Latin blocks whose letters are settled, and the ASCII marks that begin no other piece.
WHITE = "\t-\r \x85\xa0  -     　"
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LATIN = "ɐ"
MARKS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"


def portions(rows: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """``rows`` in order, few and short enough at a time to be encoded together."""
    sizes = pc.fill_null(pc.binary_length(rows[text]), 0).to_numpy(zero_copy_only=False)
    ends, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(ends):
        before = int(ends[at] - sizes[at])
        till = max(at + 1, int(np.searchsorted(ends, before + BYTES_TOGETHER, side="right")))
        till = min(till, at + ROWS_TOGETHER)
        yield rows.slice(at, till - at)
        at = till


class Stretches:
    """What encodes whole texts with a memory for stretches and pieces. Ids are unsigned
    32-bit numbers, as bytes or arrays."""

    thrift = 1  #: how many times fewer stretches are remembered
    pieces_kept = 0  #: pieces that a worker remembers, and as many older ones
    by_pieces = True  #: false if ``special`` has to encode every text

    def piece_ids(self, piece: str) -> bytes:
        raise NotImplementedError

    def letter_ids(self, word: str) -> bytes:
        """Ids of a blank and the ASCII letters behind it: one piece, which is remembered as
        a stretch and not once more."""
        piece = " " + word
        return self._known.get(piece) or self._older.get(piece) or self.piece_ids(piece)

    def special(self, text: str) -> np.ndarray:
        """Ids of a text that may hold an added token."""
        raise NotImplementedError

    def begin(self, added: Iterable[str]) -> None:
        named = "|".join(map(re.escape, sorted(added, key=len, reverse=True))) or "\0"
        self.added_tokens = re.compile(named)
        apart = WHITE.replace(" ", "").replace("\t-", "\t\x0b-")
        self.uneven = rf"[\x00{apart}]|  | \n|\n |\n\n\n|^[ \n]|[ \n]$|{named}"
        self.stretches = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
        self.pieces = regex.compile(PIECES)
        self.forget()

    def forget(self) -> None:
        """Start with an empty memory."""
        self._words: dict[str, bytes] = {}
        self._older_words: dict[str, bytes] = {}
        self._marks: dict[str, bytes] = {}
        self._known: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def encode_array(self, text: str) -> np.ndarray:
        if not self.by_pieces or self.added_tokens.search(text):
            return self.special(text)
        return self.of_stretches(text)

    def of_stretches(self, text: str) -> np.ndarray:
        """Ids of a text without added tokens."""
        return np.frombuffer(b"".join(map(self._ids, self.stretches.findall(text))), np.uint32)

    def encode_all(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Ids of each text; there is no null."""
        uneven = np.ones(len(texts), bool)
        if self.by_pieces:
            uneven = pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False)
        found: list[np.ndarray] = [None] * len(texts)  # type: ignore[list-item]
        for row in np.flatnonzero(uneven).tolist():
            found[row] = self.encode_array(texts[row].as_py())
        even = np.flatnonzero(~uneven)
        if len(even):
            for row, ids in zip(even.tolist(), self._even(texts.take(pa.array(even)))):
                found[row] = ids
        return found

    def _even(self, texts: pa.StringArray) -> list[np.ndarray]:
        """Texts as the words between blanks: one that begins a text is marked by a NUL, one
        behind a line feed holds it."""
        marked = pc.binary_join_element_wise("\0", pc.replace_substring(texts, "\n", " \n"), "")
        split = pc.split_pattern(marked, " ")
        coded = split.flatten().dictionary_encode()
        known = self._words.get
        parts = [known(word) or self._word(word) for word in coded.dictionary.to_numpy(zero_copy_only=False)]
        flat, sizes = np.frombuffer(b"".join(parts), np.uint32), np.array(list(map(len, parts)), np.int64) // 4
        words = coded.indices.to_numpy()
        lengths = sizes[words]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        # Shifts may wrap round; the places that they give do not.
        shifts = ((np.cumsum(sizes) - sizes)[words] - ends[:-1]).astype(np.int32)
        places = np.repeat(shifts, lengths) + np.arange(ends[-1], dtype=np.int32)
        return np.split(flat[places], ends[split.offsets.to_numpy()[1:-1]])

    def _word(self, word: str) -> bytes:
        """Ids of a word that is new, or was last met before the memory was full."""
        ids = self._older_words.get(word)
        if ids is None:
            if word.isascii() and word.isalpha():
                ids = self.letter_ids(word)
            elif word[0] == "\0" or word[0] == "\n":
                ids = b"".join(map(self._ids, self.stretches.findall(word.lstrip("\0"))))
            else:
                ids = self._ids(" " + word)
        if len(word) <= LONGEST:
            if len(self._words) * self.thrift >= STRETCHES:
                self._older_words, self._words = self._words, {}
            self._words[word] = ids
        return ids

    def _ids(self, part: str) -> bytes:
        """Ids of a stretch. Latin letters alone are one piece, marks behind them another."""
        letters = part[1:] if part[0] == " " else part
        if letters.isalpha() and (letters.isascii() or max(letters) < LATIN):
            return self._piece(part)
        head = letters.rstrip(MARKS)
        if head.isalpha() and (head.isascii() or max(head) < LATIN):
            cut = len(part) - len(letters) + len(head)
            word = (self._words.get(head) or self._older_words.get(head)) if part[0] == " " else None
            marks = part[cut:]
            return (word or self._piece(part[:cut])) + (self._marks.get(marks) or self._run(marks))
        return b"".join(map(self._piece, self.pieces.findall(part)))

    def _run(self, marks: str) -> bytes:
        """Ids of a run of marks that is new."""
        ids = self.piece_ids(marks)
        if len(marks) <= LONGEST and len(self._marks) < RUNS:
            self._marks[marks] = ids
        return ids

    def _piece(self, piece: str) -> bytes:
        if not self.pieces_kept:
            return self.piece_ids(piece)
        ids = self._known.get(piece) or self._older.get(piece) or self.piece_ids(piece)
        if len(piece) <= LONGEST and piece not in self._known:
            if len(self._known) >= self.pieces_kept:
                self._older, self._known = self._known, {}
            self._known[piece] = ids
        return ids
