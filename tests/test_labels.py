from __future__ import annotations

import random
import re

from labelflow.functions import labels as L
from labelflow.functions.text import WHITESPACE

ALPHABET = [*L.SEPARATORS, *"abTBt", '"', '"', ",", ",", "\t", " ", "Category 1:", "é"]


def _random_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 14))) for _ in range(n)]


def test_whitespace_is_all_unicode_whitespace():
    import sys

    expected = {chr(c) for c in range(sys.maxunicode + 1) if chr(c).isspace()}
    assert set(WHITESPACE) == expected


def test_separators_in_order(column):
    texts = _random_texts(3000, 1)
    pattern = "|".join(map(re.escape, L.SEPARATORS))
    expected = [[p.strip() for p in re.split(pattern, t) if p.strip()] for t in texts]
    assert column(L.split_separators, texts) == expected


def test_comma_masking_is_quote_parity(column):
    texts = _random_texts(3000, 2)
    ahead = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'
    assert column(L.mask_commas, texts) == [re.sub(ahead, "|", t) for t in texts]


def test_comma_masking_is_linear(column):
    text = '",' * 200_000
    assert column(L.mask_commas, [text]) == [_mask(text)]


def _mask(text: str) -> str:
    pieces = text.split('"')
    last = len(pieces) - 1
    return '"'.join(
        p.replace(",", "|") if (last - i) % 2 == 0 else p for i, p in enumerate(pieces)
    )


def test_quoted_segments(column):
    texts = _random_texts(3000, 3)
    expected = [
        re.findall(r'[^"]+|"[^"]+"', t) if '"' in t else [p.strip() for p in t.split(",")]
        for t in texts
    ]
    assert column(L.quoted_segments, texts) == expected


def test_plain_path_equals_general_path(column):
    texts = [t.replace('"', "") for t in _random_texts(5000, 4)]
    assert column(L.plain_label_list, texts) == column(L.quoted_label_list, texts
    )


def test_label_list_cases(column):
    cases = {
        "Biology\tChemistry": ["Biology", "Chemistry"],
        "Biology, Chemistry; Physics": ["Biology", "Chemistry", "Physics"],
        "DATABASE": ["DA", "ASE"],
        "X-ray diffraction": ["X", "ray diffraction"],
        "a\\nb": ["a", "nb"],
        "a<tab>b<TAB>c(Tab)d": ["a", "b", "c", "d"],
        "Category 1: Biology": ["Biology"],
        # The prefix of a quoted label leaves a blank label behind.
        'Category 12: "Work, life"': [" ", '"Work, life"'],
        '"Work, life", Biology': ['"Work, life"', "Biology"],
        "Work, life": ["Work", "life"],
        "Category 3:": [""],
        "": [],
        " ; , ": [],
        "a▪️b　": ["a", "b"],
        "a a": ["a a"],
        "a  a": ["a", "a"],
    }
    got = column(L.label_list, list(cases))
    assert dict(zip(cases, got)) == cases


def test_null_stays_null(column):
    assert column(L.label_list, [None]) == [None]


def test_bare(column):
    assert column(L.bare, ['"a. b"', "c"]) == ["a b", "c"]


def test_protected_labels_stay_whole(column):
    names = ["Allergy, clinical - immunology", "X-ray diffraction", "DATABASE"]

    def protected(raw):
        return L.protected_label_list(raw, names)

    texts = [
        "X-ray diffraction, Allergy, clinical - immunology; DATABASE",
        '"Allergy, clinical - immunology"\tX-ray',
    ]
    assert column(protected, texts) == [
        ["X-ray diffraction", "Allergy, clinical - immunology", "DATABASE"],
        ['"Allergy, clinical - immunology"', "X", "ray"],
    ]


def test_protection_leaves_private_use_characters_alone(column):
    names = ["red, blue", "a  b", "x (tab) y", "\ue000, z"]
    texts = [
        "\ue000abc; \ue0ff\ue0fe", "red, blue, \ue001", "a  b|x (tab) y|\ue000, z", None,
        "bared, bluest",
    ]
    assert column(lambda raw: L.protected_label_list(raw, names), texts) == [
        ["\ue000abc", "\ue0ff\ue0fe"], ["red, blue", "\ue001"], ["a  b", "x (tab) y", "\ue000, z"],
        None, ["bared, bluest"],
    ]
