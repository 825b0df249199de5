"""Whole texts cut where no token can reach across, each distinct piece encoded once.

Works with ``tokenizers`` (.json) and ``sentencepiece`` (.model) files. Whether a
cut is safe is read from the file; where that cannot be shown, a text is one piece.
"""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pyarrow as pa

#: Distinct pieces, and their characters, that a task remembers before it starts afresh.
REMEMBERED, REMEMBERED_CHARS = 400_000, 1 << 26
#: Characters the library gets in one call.
CALL = 1 << 18
#: Lead bytes of the characters that some library takes for white space, or that
#: sentencepiece writes for a space: no cut is made behind a character with one.
UNSURE = (0xC2, 0xE1, 0xE2, 0xE3, 0xEF)


def _safe_json(path: str) -> bool:
    """True if the file's pattern never joins a character with white space after
    it: the byte-level one, with no step before it and no token that holds, or
    takes in, white space, a full stop or a comma."""
    with open(path, encoding="utf-8") as file:
        spec = json.load(file)
    pattern = spec.get("pre_tokenizer") or {}
    return (
        spec.get("normalizer") is None
        and not spec["model"].get("dropout")
        and pattern.get("type") == "ByteLevel"
        and pattern.get("use_regex", True)
        and not pattern.get("add_prefix_space", True)
        and not any(
            t.get("lstrip") or t.get("rstrip") or any(c.isspace() or c in ".," for c in t["content"])
            for t in spec.get("added_tokens", [])
        )
    )


def _safe_model(path: str, processor) -> bool:
    """True if texts are taken as they are, with a space in front, and no entry
    holds a space behind another character."""
    from sentencepiece import sentencepiece_model_pb2

    spec = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        spec.ParseFromString(file.read())
    rule = spec.normalizer_spec
    return (
        rule.name == "identity"
        and not rule.precompiled_charsmap
        and rule.add_dummy_prefix
        and not rule.remove_extra_whitespaces
        and not spec.trainer_spec.treat_whitespace_as_suffix
        and not any("▁" in p.piece.lstrip("▁") for p in spec.pieces)
    )


def byte_decoder() -> dict[str, int]:
    """The byte of each character in the entries of byte-level files: printable
    Latin characters stand for themselves, the others follow from 256 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    others = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(others)}


def piece_bytes(piece: str) -> bytes:
    """What a sentencepiece entry stands for: a byte, or text with ▁ for a space."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


def inside(piece: str) -> bool:
    """True if the piece may stand between two others in one text."""
    last = piece[-1]
    return piece[0] in " \n" and ("!" <= last <= "~" or last.isalnum())


class Encoder:
    """Ids of pieces by one tokenizer file, remembered by piece.

    With ``plain`` the special strings of a .json file are ordinary text. A
    .model file puts a space in front of a text; ``drop`` characters are cut
    from the start of each piece before it is encoded, to make up for that.
    """

    def __init__(self, path: str, plain: bool = False, drop: int = 0):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the threads
        self.drop = drop
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self.safe = drop == 1 and _safe_model(path, model)
            self.encode_all = lambda texts: model.encode(texts, num_threads=1)
            self.bytes = [piece_bytes(model.id_to_piece(i)) for i in range(model.vocab_size())]
        else:
            from tokenizers import Tokenizer

            model = Tokenizer.from_file(path)
            model.no_truncation()
            model.no_padding()
            model.encode_special_tokens = plain
            self.safe = _safe_json(path)
            self.encode_all = lambda texts: [
                e.ids for e in model.encode_batch_fast(texts, add_special_tokens=False)
            ]
            decode = byte_decoder()
            entries = (model.id_to_token(i) or "" for i in range(model.get_vocab_size()))
            self.bytes = [bytes(decode.get(c, 0) for c in entry) for entry in entries]
        self.widths = np.array([len(b) for b in self.bytes], np.int64)
        self._forget()

    def _forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.chars = 0
        self.ids = np.zeros(0, np.uint32)
        self.starts = np.zeros(1, np.int64)

    def _encode(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, one after the other, and how many each has.

        Pieces between two cuts are one text to the library; the bytes of the
        tokens tell where each ends. All others are texts of their own.
        """
        if len(pieces) > 1 and self.safe:
            ids = np.array(self.encode_all(["".join(pieces)[self.drop :]])[0], np.uint32)
            sizes = np.array([len(p.encode()) for p in pieces], np.int64)
            ends = np.cumsum(self.widths[ids])
            last = np.searchsorted(ends, np.cumsum(sizes))
            if len(ends) and ends[-1] == sizes.sum() and (ends[last] == np.cumsum(sizes)).all():
                return ids, np.diff(last + 1, prepend=0)
        found = self.encode_all([p[self.drop :] for p in pieces])
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        return np.array([i for ids in found for i in ids], np.uint32), lengths

    def _learn(self, pieces: list[str]) -> None:
        inner = [p for p in pieces if inside(p)]
        outer = [p for p in pieces if not inside(p)]
        parts, counts = [self.ids], []
        for group, joined in ((inner, True), (outer, False)):
            held: list[str] = []
            size = 0
            for piece in [*group, None]:
                if held and (piece is None or size + len(piece) > CALL):
                    for some in [held] if joined else [[p] for p in held]:
                        ids, lengths = self._encode(some)
                        parts.append(ids)
                        counts.append(lengths)
                    held, size = [], 0
                if piece is not None:
                    held.append(piece)
                    size += len(piece)
        first = len(self.slots)
        self.slots.update(zip(inner + outer, range(first, first + len(pieces))))
        self.chars += sum(map(len, pieces))
        self.ids = np.concatenate(parts)
        self.starts = np.concatenate(
            [self.starts, self.starts[-1] + np.cumsum(np.concatenate(counts))]
        )

    def encode(
        self, pieces: list[str], coded: np.ndarray, firsts: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array and where each text's begin (one place
        more than texts): text t is made of the pieces coded from firsts[t] on."""
        if len(self.slots) > REMEMBERED or self.chars > REMEMBERED_CHARS:
            self._forget()
        new = [p for p in pieces if p not in self.slots]
        if new:
            self._learn(new)
        slot = np.fromiter((self.slots[p] for p in pieces), np.int64, len(pieces))
        if not len(pieces):
            return np.zeros(0, np.uint32), np.zeros(len(firsts), np.int64)
        of_piece = slot[coded]
        lengths = self.starts[of_piece + 1] - self.starts[of_piece]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        place = np.arange(ends[-1]) + np.repeat(self.starts[of_piece] - ends[:-1], lengths)
        return self.ids[place], ends[firsts]


def cuts(data: np.ndarray, patterned: bool) -> np.ndarray:
    """Places of a space behind a character that surely is no white space to any
    library; for patterned (byte-level) files also of a line end there, and of a
    full stop or comma behind a plain letter."""
    gap = data == 32
    if patterned:
        gap |= data == 10
    places = np.flatnonzero(gap)
    places = places[places > 0]
    before = data[places - 1]
    ascii_ = (before > 32) & (before < 127)
    # The lead byte of a longer character before the gap.
    lead = before
    for back in (2, 3, 4):
        lead = np.where((lead & 0xC0) == 0x80, data[np.maximum(places - back, 0)], lead)
    wide = (lead >= 0xC0) & ~np.isin(lead, UNSURE)
    found = places[ascii_ | wide]
    if not patterned:
        return found
    marks = np.flatnonzero((data == 44) | (data == 46))
    marks = marks[marks > 0]
    letter = data[marks - 1] | 32
    return np.concatenate([found, marks[(letter >= 97) & (letter <= 122)]])


def split(
    texts: pa.Array, safe: bool = True, patterned: bool = True
) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct pieces, the codes of all pieces in order, and each text's first
    piece (one place more than texts). No null texts; an empty text has no piece."""
    texts = texts.cast(pa.string())
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int32)[texts.offset : texts.offset + len(texts) + 1]
    low, high = int(bounds[0]), int(bounds[-1])
    if low == high:
        return [], np.zeros(0, np.int64), np.zeros(len(texts) + 1, np.int64)
    data = np.frombuffer(values, np.uint8)[low:high]
    bounds = (bounds - low).astype(np.int64)
    begins = bounds[:-1][bounds[:-1] < bounds[1:]]
    starts = begins
    if safe:
        at = np.zeros(len(data), bool)
        at[cuts(data, patterned)] = True
        at[bounds[1:] - 1] = False  # to sentencepiece, a last space alone is no text
        at[begins] = True
        starts = np.flatnonzero(at)
    places = np.append(starts, high - low).astype(np.int32)
    pieces = pa.Array.from_buffers(
        pa.string(), len(starts), [None, pa.py_buffer(places), pa.py_buffer(data)]
    )
    coded = pieces.dictionary_encode()
    return coded.dictionary.to_pylist(), np.asarray(coded.indices), np.searchsorted(starts, bounds)


def blocks(texts: pa.Array, limit: int, patterned: bool = True) -> tuple[pa.Array, np.ndarray]:
    """``texts`` with those of over ``limit`` bytes cut at safe places into blocks
    of about that size, and the text that each block belongs to. A stretch
    without a safe place stays whole. No null texts."""
    texts = texts.cast(pa.string())
    sizes = np.asarray(pa.compute.binary_length(texts))
    if not (sizes > limit).any():
        return texts, np.arange(len(texts))
    out: list[bytes] = []
    owner: list[int] = []
    for i, size in enumerate(sizes.tolist()):
        raw = texts[i].as_buffer().to_pybytes()
        at = 0
        while size - at > limit:
            width, found = limit, np.zeros(0, np.int64)
            while not len(found) and at + width < size:
                stretch = min(width, size - at)
                found = cuts(np.frombuffer(raw, np.uint8, stretch, at), patterned)
                found = found[found < size - at - 1]
                width *= 2
            if not len(found):
                break
            out.append(raw[at : at + int(found.max())])
            owner.append(i)
            at += int(found.max())
        out.append(raw[at:])
        owner.append(i)
    return pa.array(out, pa.binary()).cast(pa.string()), np.array(owner, np.int64)


def digest(data: memoryview) -> str:
    return hashlib.sha256(data).hexdigest()
