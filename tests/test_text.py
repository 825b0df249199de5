from __future__ import annotations

import random
import re

from pyspark.sql import functions as F

from labelflow.functions import prompts as P
from labelflow.functions import text as X


def _clean(text):
    """The cleaning rules stated in Python."""
    text = text or "No text provided"
    text = re.sub(r"https?://[$-_a-z!]+", " ", text)
    text = re.sub(r"<[^>]+>", " ", text)
    return re.sub(r"\s+", " ", text).strip() or "No text provided"


def test_clean_text_cases(column):
    cases = {
        None: "No text provided",
        "": "No text provided",
        "   \n": "No text provided",
        "<p>": "No text provided",
        "a <b>bold</b> word": "a bold word",
        # The address swallows the tag that touches it.
        "http://x.org</p>tail end": "end",
        'see http://x.org/a#frag "q"': 'see #frag "q"',
        "1 < 2 > 1": "1 1",
        "a <> b": "a <> b",
        "a < b": "a < b",
        "a b　\x1c c": "a b c",
    }
    got = column(X.clean_text, list(cases))
    assert dict(zip(cases, got)) == cases


def test_clean_text_equals_rules(column):
    rng = random.Random(5)
    parts = ["http://", "https://a.b/c", "<", ">", "<p>", "</p>", " ", "\n", "\t", " ", "x", "Y", "é", '"', "#"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 15))) for _ in range(3000)]
    assert column(X.clean_text, texts) == [_clean(t) for t in texts]


def test_unclosed_tags_are_linear(column):
    text = "<" * 500_000
    assert column(X.remove_html, [text, text + ">"]) == [text, " "]


def test_length_limits(column):
    texts = ["abcdefgh", "abc", "éé éé"]
    assert column(lambda c: X.clean_text(c, max_length=5, min_length=4), texts) == [
        "abcde", "No text provided", "éé éé",
    ]
    # Zero turns a limit off.
    assert column(lambda c: X.clean_text(c, max_length=0, min_length=0), ["a"]) == ["a"]


def test_tokens(column):
    texts = ["one two, three!", "  lead", "", None, "über-größe_1"]
    assert column(X.token_count, texts) == [5, 1, 0, 0, 3]
    assert column(lambda c: X.keep_tokens(c, 2), texts) == [
        "one two", "  lead", "", None, "über-",
    ]
    assert column(lambda c: X.keep_tokens(c, 0), ["a b"]) == [""]
    # A text within the limit keeps its last spaces.
    assert column(lambda c: X.keep_tokens(c, 2), ["a b  "]) == ["a b  "]


def test_budget_cuts_only_the_text(column):
    cut = column(
        lambda c: X.keep_to_budget(c, F.lit("a title"), fixed_tokens=3, budget=8),
        ["one two three four five", "one"],
    )
    assert cut == ["one two three", "one"]


def test_echo_and_lines(column):
    assert column(lambda c: X.strip_echo(c, F.lit("ask: ")), ["ask:  yes ", "no"]) == [
        "yes", "no",
    ]
    assert column(X.parse_lines, [" a \n\n b\n"]) == [["a", "b"]]


def test_placeholders_are_replaced_in_order(column):
    def prompt(c):
        return P.fill("<title>|<abstract>|<other>", {"title": c, "abstract": F.lit("A")})

    assert column(prompt, ["<abstract>", None]) == ["A|A|<other>", "|A|<other>"]


def test_template_keeps_unknown_placeholders():
    text = P.format_template("<topics>/<num_terms>/<x>", ["a", "b"], num_terms=3)
    assert text == "a\nb/3/<x>"


def test_request_is_nested_and_cut(column):
    import json

    def line(c):
        return P.request_line(P.request(F.lit(7), c, "m", context_tokens=2))

    (got,) = column(line, ["one two three"])
    assert json.loads(got) == {
        "custom_id": "7",
        "method": "POST",
        "url": "/v1/chat/completions",
        "body": {
            "model": "m",
            "messages": [{"role": "user", "content": "one two"}],
            "max_tokens": 248,
        },
    }
