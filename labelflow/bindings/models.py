"""Offline stand-ins for a model."""

from __future__ import annotations

from collections.abc import Sequence


class TermModel:
    """Offline stand-in for a model: the terms that occur in the prompt."""

    def __init__(self, terms: Sequence[str]):
        self.terms = list(terms)

    def __call__(self, prompts: Sequence[str]) -> list[str]:
        return [
            "\t".join(t for t in self.terms if t in prompt.lower())
            for prompt in prompts
        ]


class TitleModel(TermModel):
    """Names the terms of the prompt and misspells its title."""

    def __call__(self, prompts: Sequence[str]) -> list[str]:
        terms = super().__call__(prompts)
        return [f"{t}\t{p.split(': ')[0]}x" for t, p in zip(terms, prompts)]


class FlakyModel(TermModel):
    """Fails on the first call of each prompt, and always on some."""

    def __init__(self, terms: Sequence[str]):
        super().__init__(terms)
        self.last = None

    def __call__(self, prompts: Sequence[str]) -> list[str]:
        first, self.last = self.last != prompts[0], prompts[0]
        if first or "promo" in prompts[0]:
            raise RuntimeError("model failed")
        return super().__call__(prompts)
