"""Label a table end to end: clean, prompt, ask the model, normalize."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelflow.functions.prompts import fill
from labelflow.functions.text import clean_text
from labelflow.operators.infer import Model, infer
from labelflow.operators.matching import Vocabulary
from labelflow.plans.normalize import normalize
from labelflow.storage import materialise

Step = Callable[[DataFrame], DataFrame]


def apply_steps(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """Chain table-to-table steps in order."""
    for step in steps:
        df = df.transform(step)
    return df


def clean_step(**options) -> Step:
    return lambda items: items.withColumn("text", clean_text(F.col("text"), **options))


def prompt_step(template: str, fields: Mapping[str, Column]) -> Step:
    """Adds ``prompt`` last, so that earlier steps never carry it."""
    return lambda items: items.withColumn("prompt", fill(template, fields))


def normalize_step(vocabulary: Vocabulary, **options) -> Step:
    return lambda results: normalize(results, vocabulary, **options)


def check_inputs(items: DataFrame, vocabulary: Vocabulary) -> None:
    """A run needs a vocabulary and at least one item."""
    if vocabulary.names == [] or vocabulary.topics.isEmpty():
        raise ValueError("the vocabulary is empty")
    if items.isEmpty():
        raise ValueError("the source has no rows")


def label(
    items: DataFrame,
    factory: Callable[[], Model],
    vocabulary: Vocabulary,
    template: str,
    fields: Mapping[str, Column],
    *,
    before: Sequence[Step] = (),
    after: Sequence[Step] = (),
    save: Callable[[DataFrame], DataFrame] = materialise,
    normalize_options: Mapping[str, object] | None = None,
    **infer_options,
) -> DataFrame:
    """Items (id, text, metadata) to results with ``categories``.

    ``before`` and ``after`` are the user's own steps around the model. Only id
    and prompt go to the model. The normalizer reads the answers several times,
    so ``save`` stores them, without the prompts, once the model has run.
    """
    check_inputs(items, vocabulary)
    prompts = apply_steps(
        items, [clean_step(), *before, prompt_step(template, fields)]
    )
    answers = save(infer(prompts.select("id", "prompt"), factory, **infer_options).drop("prompt"))
    steps = [normalize_step(vocabulary, **(normalize_options or {})), *after]
    return apply_steps(answers, steps)
