"""Text cleaning and token budgets as column expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a plain-text strip removes, the text put in
# place of an empty record, and the pattern of a web address.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
NO_TEXT = "No text provided"
URL_PATTERN = r"https?://[$-_a-z!]+"

# The same whitespace, without the plain space, as ranges of a regex class.
_ODD_SPACE = (
    r"\t-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
)
_WORD = r"A-Za-z0-9_\p{L}\p{M}\p{N}"
# A token is a run of word characters or one other visible character.
TOKEN_PATTERN = f"(?:[{_WORD}]+|[^{_WORD} {_ODD_SPACE}])"
_SPACED_TOKEN = f"[ {_ODD_SPACE}]*{TOKEN_PATTERN}"

TokenCounter = Callable[[Column], Column]
#: Cuts a text to its first tokens; it must follow the same rule as the counter.
TokenCutter = Callable[[Column, Column], Column]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove Unicode whitespace from both ends (linear, no regex)."""
    return F.btrim(text, F.lit(WHITESPACE))


def remove_urls(text: Column) -> Column:
    return F.regexp_replace(text, URL_PATTERN, " ")


def remove_html(text: Column) -> Column:
    """Replace tags by a space.

    Only the part up to the last ``>`` is searched. There every ``<`` finds its
    end, so the work is linear even for a text made of unclosed ``<``.
    """

    def strip_tags(text: Column) -> Column:
        tail = F.substring_index(text, ">", -1)
        head = F.left(text, F.length(text) - F.length(tail))
        return F.when(
            F.contains(text, F.lit("<")) & F.contains(text, F.lit(">")),
            F.concat(F.regexp_replace(head, "<[^>]++>", " "), tail),
        ).otherwise(text)

    return let(text, strip_tags)


def normalize_whitespace(text: Column) -> Column:
    """One space for every run of whitespace, none at the ends.

    Two narrow patterns touch only what has to change; one wide pattern would
    replace every single space by itself.
    """
    spaces = F.regexp_replace(text, f"[{_ODD_SPACE}]", " ")
    return F.trim(F.regexp_replace(spaces, " {2,}", " "))


def truncate_chars(text: Column, max_length: int | None) -> Column:
    return F.substring(text, 1, max_length) if max_length else text


def blank_if_short(text: Column, min_length: int | None) -> Column:
    if not min_length:
        return text
    return F.when(F.length(text) < min_length, F.lit("")).otherwise(text)


def or_placeholder(text: Column) -> Column:
    return F.coalesce(F.nullif(text, F.lit("")), F.lit(NO_TEXT))


def clean_text(
    text: Column,
    *,
    urls: bool = True,
    html: bool = True,
    whitespace: bool = True,
    min_length: int | None = None,
    max_length: int | None = None,
) -> Column:
    """The full cleaning chain. Never null, never empty, never drops a row."""
    out = or_placeholder(text.cast("string"))
    if urls:
        out = remove_urls(out)
    if html:
        out = remove_html(out)
    if whitespace:
        out = normalize_whitespace(out)
    out = truncate_chars(out, max_length)
    out = blank_if_short(out, min_length)
    return or_placeholder(out)


def token_count(text: Column) -> Column:
    """Number of tokens under the word-or-mark rule (null counts as 0)."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN_PATTERN)), F.lit(0))


def keep_tokens(text: Column, limit: Column | int) -> Column:
    """First ``limit`` tokens of the text, with the whitespace between them.

    A text has at most as many tokens as characters, so short texts are not
    tokenized at all.
    """
    n = limit if isinstance(limit, Column) else F.lit(limit)
    n = F.greatest(n.cast("int"), F.lit(0))

    def cut(text: Column) -> Column:
        pieces = F.regexp_extract_all(text, F.lit(f"({_SPACED_TOKEN})"), F.lit(1))
        first = let(
            pieces,
            lambda p: F.when(
                F.size(p) > n, F.array_join(F.slice(p, F.lit(1), n), "")
            ).otherwise(text),
        )
        return F.when(F.length(text) > n, first).otherwise(text)

    return let(text, cut)


def keep_to_budget(
    text: Column,
    title: Column,
    fixed_tokens: int,
    budget: int,
    count: TokenCounter = token_count,
    cut: TokenCutter = keep_tokens,
) -> Column:
    """Cut only ``text`` so that template, title and text fit the budget."""
    return cut(text, F.lit(budget - fixed_tokens) - count(title))


def strip_echo(response: Column, prompt: Column) -> Column:
    """Drop the prompt a model repeats before its answer, then strip."""
    rest = F.when(
        F.startswith(response, prompt),
        F.right(response, F.length(response) - F.length(prompt)),
    ).otherwise(response)
    return strip(rest)


def parse_lines(response: Column) -> Column:
    """Non-empty stripped lines of a response."""
    return F.filter(
        F.transform(F.split(response, "\n"), strip), lambda line: line != ""
    )


def fill_default(value: Column, default: str) -> Column:
    return F.coalesce(F.nullif(value, F.lit("")), F.lit(default))
