"""Public tokenizers inside tasks: exact ids at a fraction of the usual work.

The tokenizer's file is a parameter and must be readable where tasks run.
"""

from __future__ import annotations

import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text between two words when unseen words are encoded together. It must be
#: one token by itself; a word that holds it is encoded alone.
MARK = "\x01"
#: Words whose ids a task remembers before it starts afresh (some 100 MB).
REMEMBERED = 400_000
#: Words encoded in one text of a library batch.
JOINED = 2_000

def load_tokenizer(path: str):
    """A ``tokenizers`` (.json) or ``sentencepiece`` (.model) object."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
    if path.endswith(".model"):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_file=path)
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class WordEncoder:
    """Ids of whole texts by a tokenizer that drops white space.

    For such a tokenizer the ids of a text are those of its white-space
    separated words, one after the other. Arrow splits the texts and finds the
    distinct words; the library encodes only words not seen before, many in one
    text, and numpy puts the ids of each text together. If the tokenizer also
    ignores case and parts letters from full stops and commas, so does the
    table of words, which makes it smaller.
    """

    def __init__(self, path: str):
        self.tokenizer = load_tokenizer(path)
        mark = self._ids([MARK])[0]
        self.mark = mark[0] if len(mark) == 1 else None
        if len(self._ids([f" {MARK} \n"])[0]) != len(mark):
            raise ValueError("the tokenizer keeps white space")
        same = [["Ab", "ab"], ["ab.", "ab ."], ["ab,cd", "ab , cd"], ["à,", "à ,"]]
        self.folds = all(len({tuple(x) for x in self._ids(pair)}) == 1 for pair in same)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _ids(self, texts: list[str]) -> list[list[int]]:
        return [
            e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if MARK not in w] if self.mark is not None else []
        odd = [w for w in words if MARK in w] if self.mark is not None else words
        joined = f" {MARK} "
        parts, lengths = [], []
        for at in range(0, len(plain), JOINED * 16):
            some = plain[at : at + JOINED * 16]
            texts = [
                joined.join(some[i : i + JOINED]) + joined
                for i in range(0, len(some), JOINED)
            ]
            flat = np.concatenate([np.array(x, np.uint32) for x in self._ids(texts)])
            marks = np.flatnonzero(flat == self.mark)
            if len(marks) != len(some):
                raise ValueError("a word's ids hold the mark")
            lengths.append(np.diff(marks, prepend=-1) - 1)
            parts.append(flat[flat != self.mark])
        if odd:
            own = [np.array(x, np.uint32) for x in self._ids(odd)]
            lengths.append(np.array([len(x) for x in own], np.int64))
            parts += own
        first = len(self.slots)
        self.slots.update(zip(plain + odd, range(first, first + len(words))))
        self.ids = np.concatenate([self.ids, *parts])
        ends = self.starts[-1] + np.cumsum(np.concatenate(lengths))
        self.starts = np.concatenate([self.starts, ends])

    def _folded(self, texts: pa.Array) -> pa.Array:
        """Texts of the same ids with fewer distinct words. Capitals stay where
        a mark could compose with them, or where special strings may stand."""
        risky = pc.match_substring_regex(texts, r"\p{M}|<\|")
        lower = pc.if_else(risky, texts, pc.ascii_lower(texts))
        return pc.replace_substring_regex(lower, r"([a-zà-öø-ÿ])([.,])", r"\1 \2")

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids in one array, and the place where each text's ids begin
        (one place more than texts). No null texts."""
        texts = texts.cast(pa.string())
        lists = pc.ascii_split_whitespace(self._folded(texts) if self.folds else texts)
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary.to_pylist()
        if len(self.slots) > REMEMBERED:
            self._forget()
        new = [w for w in words if w not in self.slots]
        if new:
            self._learn(new)
        slot = np.fromiter((self.slots[w] for w in words), np.int64, len(words))
        if not len(words):
            return np.zeros(0, np.uint32), np.zeros(len(texts) + 1, np.int64)
        of_word = slot[np.asarray(coded.indices)]
        lengths = self.starts[of_word + 1] - self.starts[of_word]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(ends[-1]) + np.repeat(self.starts[of_word] - ends[:-1], lengths)
        return self.ids[place], ends[offsets]


def with_end(ids: np.ndarray, bounds: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The same with ``end_id`` after the ids of each text."""
    return np.insert(ids, bounds[1:], np.uint32(end_id)), bounds + np.arange(len(bounds))


class PieceCounter:
    """Token counts of whole texts by a tokenizer that keeps white space.

    Texts are split at safe boundaries: where a space or line end follows another
    kind of character. The patterns of byte-level BPE files never join a
    character with white space after it, so the pieces' tokens are the text's.
    The library encodes each distinct piece once, in calls of about ``call``
    characters; only the counts are kept. Texts that hold the zero character, which parts the
    pieces, are encoded by themselves.
    """

    _PART = "\0"
    # Unlike Python's, this class lists what other libraries take for white space.
    _SPLIT = (
        r"([^\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200b}"
        r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}])([ \n])"
    )

    def __init__(self, path: str, call: int):
        self.tokenizer = load_tokenizer(path)
        self.call = call
        self.known: dict[str, int] = {}

    def _learn(self, pieces: list[str]) -> None:
        held, size = [], 0
        for piece in [*pieces, None]:
            if held and (piece is None or size + len(piece) > self.call):
                found = self.tokenizer.encode_batch_fast(held, add_special_tokens=False)
                self.known.update(zip(held, map(len, found)))
                held, size = [], 0
            if piece is not None:
                held.append(piece)
                size += len(piece)

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text; no null texts."""
        texts = texts.cast(pa.string())
        odd = pc.match_substring(texts, self._PART)
        marked = pc.replace_substring_regex(
            pc.if_else(odd, "", texts), self._SPLIT, f"\\1{self._PART}\\2"
        )
        lists = pc.split_pattern(marked, self._PART)
        offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
        coded = lists.flatten().dictionary_encode()
        pieces = coded.dictionary.to_pylist()
        if len(self.known) > REMEMBERED:
            self.known = {}
        self._learn([p for p in pieces if p not in self.known])
        lengths = np.fromiter((self.known[p] for p in pieces), np.int64, len(pieces))
        sums = np.concatenate([[0], np.cumsum(lengths[np.asarray(coded.indices)])])
        counts = sums[offsets[1:]] - sums[offsets[:-1]]
        for i in np.flatnonzero(np.asarray(odd)):
            counts[i] = len(self.tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False))
        return counts
