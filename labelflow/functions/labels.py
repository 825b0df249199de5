"""Turn a raw model response into a list of labels."""

from __future__ import annotations

import re
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from labelflow.functions.text import let, strip

# Everything that separates two labels in a response, the prefix
# that a label may have, and what a quoted or plain run is. The order of the
# separators counts: at one position the first entry that fits is taken.
SEPARATORS = [
    "    ", "   ", "  ", "\n",
    "<TAB>", "TAB", "<tab>", "(tab)", "<Tab>", "[tab]",
    "▪️", "(Tab)",
    "\xa0\xa0\xa0\xa0", "\xa0", "\u2003", "、", "\x0b", "\x0c",
    ";", ".", "--", "-", "–", "_", "\\", "\\n", "/", "@", "|", "\r",
    "+", "<", ">", "·",
]
LABEL_PREFIX = r"Category \p{Nd}+:"
QUOTED_OR_PLAIN = r'([^"]+|"[^"]+")'


_SINGLES = "".join(s for s in SEPARATORS if len(s) == 1)
# A longer entry whose first character is itself listed earlier is never reached.
_LONGER = [
    s
    for i, s in enumerate(SEPARATORS)
    if len(s) > 1 and s[0] not in SEPARATORS[:i]
]
_LONGER_PATTERN = "|".join(re.escape(s) for s in _LONGER)


def split_tabs(text: Column) -> Column:
    return F.transform(F.split(text, "\t"), strip)


def mask_commas(text: Column) -> Column:
    """Replace each comma that has an even number of quotes after it by ``|``.

    The text is cut at its quotes; a piece has an even number of quotes after
    it exactly when its distance from the last piece is even. Linear, where a
    look-ahead regex is quadratic.
    """

    def mask(pieces: Column, last: Column) -> Column:
        return F.transform(
            pieces,
            lambda piece, i: F.when(
                (last - i) % 2 == 0, F.replace(piece, F.lit(","), F.lit("|"))
            ).otherwise(piece),
        )

    # ``let`` keeps the cut and its size out of the per-piece function.
    masked = let(
        F.split(text, '"'), lambda p: let(F.size(p) - 1, lambda last: mask(p, last))
    )
    return F.when(F.contains(text, F.lit('"')), F.array_join(masked, '"')).otherwise(
        F.replace(text, F.lit(","), F.lit("|"))
    )


def _pieces(text: Column, singles: str) -> Column:
    """Non-empty stripped pieces between separators.

    Longer separators, then single characters, become line breaks, and the cut
    is made there: a constant regex is compiled once per task, while a regex
    split would compile it for every row.
    """
    lines = F.translate(
        F.regexp_replace(text, _LONGER_PATTERN, "\n"), singles, "\n" * len(singles)
    )
    return F.filter(F.transform(F.split(lines, "\n"), strip), lambda piece: piece != "")


def split_separators(text: Column) -> Column:
    return _pieces(text, _SINGLES)


def strip_label_prefix(text: Column) -> Column:
    return F.regexp_replace(text, LABEL_PREFIX, "")


def quoted_segments(text: Column) -> Column:
    """Quoted and unquoted runs when the text has a quote, else comma parts."""
    return F.when(
        F.contains(text, F.lit('"')),
        F.regexp_extract_all(text, F.lit(QUOTED_OR_PLAIN), F.lit(1)),
    ).otherwise(F.transform(F.split(text, ","), strip))


def split_labels(parts: Column) -> Column:
    """Comma masking, separator split and prefix removal over an array."""
    pieces = F.flatten(
        F.transform(parts, lambda part: split_separators(mask_commas(part)))
    )
    return F.transform(pieces, strip_label_prefix)


def quoted_label_list(raw: Column) -> Column:
    """All steps one after another; right for every response."""
    return F.flatten(F.transform(split_labels(split_tabs(raw)), quoted_segments))


def plain_label_list(raw: Column) -> Column:
    """The same for a response without quotes.

    There every comma is masked and every tab cuts, so both join the other
    separators and one pass is enough.
    """
    pieces = _pieces(raw, _SINGLES + ",\t")
    return F.when(
        F.contains(raw, F.lit("Category ")),
        F.transform(pieces, lambda piece: strip(strip_label_prefix(piece))),
    ).otherwise(pieces)


def label_list(raw: Column) -> Column:
    """Raw response to labels, in order, duplicates kept; null stays null."""
    return F.when(F.contains(raw, F.lit('"')), quoted_label_list(raw)).otherwise(
        plain_label_list(raw)
    )


def bare(label: Column) -> Column:
    """The form in which a label is looked up: no full stops, no quotes."""
    return F.translate(label, '."', "")


# Private-use characters that stand for separators inside a protected label.
_HIDDEN_FROM = ",\t" + _SINGLES
_HIDDEN_TO = "".join(chr(0xE000 + i) for i in range(len(_HIDDEN_FROM)))
_JOINER, _ESCAPE = "\ue0ff", "\ue0fe"
_OURS = _HIDDEN_TO + _JOINER + _ESCAPE

_HIDE = str.maketrans(_HIDDEN_FROM, _HIDDEN_TO)
# Of a longer separator whose characters separate nothing alone, the joiner
# after the first character is enough.
_TORN = re.compile(
    "|".join(re.escape(s) for s in SEPARATORS if len(s) > 1 and not set(s) & set(_SINGLES))
)


def hide_separators(label: str) -> str:
    """Swap the separators inside a label for private-use characters."""
    joined = _TORN.sub(lambda m: _JOINER.join(m.group()), label)
    return joined.translate(_HIDE)


def escape_marks(text: str) -> str:
    """Private-use characters that a text already has, as pairs that no step
    takes for a separator."""
    if not any(c in text for c in _OURS):
        return text
    return "".join(_ESCAPE + chr(0x4E00 + _OURS.index(c)) if c in _OURS else c for c in text)


def show_separators(label: Column) -> Column:
    """Undo ``hide_separators`` and then ``escape_marks``."""
    shown = F.translate(label, _HIDDEN_TO + _JOINER, _HIDDEN_FROM)
    unescaped = shown
    for i, mark in enumerate(_OURS):
        unescaped = F.replace(unescaped, F.lit(_ESCAPE + chr(0x4E00 + i)), F.lit(mark))
    return F.when(F.contains(shown, F.lit(_ESCAPE)), unescaped).otherwise(shown)


class Protector:
    """Hides the separators of entries in texts, longest entry first.

    Entries are listed under their first characters, at most HEAD, so a text is
    looked up once at each of its places, however many entries there are.
    """

    HEAD = 4

    def __init__(self, entries: Sequence[str]):
        escaped = {escape_marks(e) for e in entries}
        self.hidden = {e: h for e in escaped if (h := hide_separators(e)) != e}
        self.by_head: dict[str, list[str]] = {}
        for entry in self.hidden:
            self.by_head.setdefault(entry[: self.HEAD], []).append(entry)
        self.lengths = sorted({len(h) for h in self.by_head})

    def __call__(self, text: str) -> str:
        """``text`` must have its own marks escaped."""
        found = {
            e
            for i in range(len(text))
            for n in self.lengths
            for e in self.by_head.get(text[i : i + n], ())
            if text.startswith(e, i)
        }
        for entry in sorted(found, key=lambda e: (-len(e), e)):
            text = text.replace(entry, self.hidden[entry])
        return text


def hide_entries(raw: Column, entries: Sequence[str], escaped: bool = False) -> Column:
    """``raw`` with the separators of all entries in it hidden. ``escaped``: its
    own marks are escaped already, by an earlier pass."""
    protector = Protector(entries)

    @F.pandas_udf(T.StringType())
    def hide(texts: pd.Series) -> pd.Series:
        return texts.map(
            lambda t: protector(t if escaped else escape_marks(t)), na_action="ignore"
        )

    return hide(raw)


def protected_label_list(raw: Column, entries: Sequence[str]) -> Column:
    """Like ``label_list`` but entries that hold separators stay whole."""
    return F.transform(label_list(hide_entries(raw, entries)), show_separators)


def is_torn(entry: Column) -> Column:
    """Does an entry hold a separator, so that splitting would tear it?"""
    longer = "|".join(re.escape(s) for s in SEPARATORS if len(s) > 1)
    singles = "".join(re.escape(s) for s in _SINGLES)
    return F.rlike(entry, F.lit(f"[{singles},\t]|{longer}"))
