"""Allow and block rules for URLs, fetched by their rarest literal token."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rules are an argument on the driver; so many bytes of them go to a task at
#: once, and more in further passes over the URLs.
RULE_BYTES = 64 << 20

_TOKEN = re.compile(r"[a-z0-9]+")
_CAPITALS = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


@dataclass(frozen=True)
class Rule:
    """``regex`` is matched from the start of a dot, the host and what follows.

    ``tokens`` are literal tokens that every matching URL has, in any case. Of
    the rules that match, the largest ``rank`` decides.
    """

    name: str
    action: str
    regex: str
    tokens: tuple[str, ...]
    rank: tuple

    @staticmethod
    def of_host(host: str, path: str, action: str) -> Rule:
        """For ``host`` and its subdomains, where the path starts with ``path``.
        Longer rules win; of equal ones, block. They win over patterns."""
        name = host + path
        regex = r"[^/?#]*\." + re.escape(host) + r"(?![^/?#])(?=[^?#]*)" + re.escape(path)
        if "?" in path or "#" in path:
            regex = r"(?!)"  # no path holds these
        return Rule(
            name, action, regex, _bounded([host, path], True, False),
            (1, len(name), action == "block", name),
        )

    @staticmethod
    def of_pattern(pattern: str, action: str) -> Rule:
        """For URLs that hold ``pattern``: ``*`` is any text, ``^`` the end or a
        character other than letters, digits and ``_-.%``, ``||`` at the start
        the beginning of a host or of a part of it, ``|`` at the end the end."""
        body, host, end = pattern, pattern.startswith("||"), pattern.endswith("|")
        body = body[2 * host : len(body) - end]
        parts = [
            r"(?:[^A-Za-z0-9_.%-]|\Z)" if x == "^" else ".*" if x == "*" else re.escape(x)
            for x in re.split(r"([*^])", body)
        ]
        regex = (r"[^/?#]*\." if host else ".*") + "".join(parts) + (r"\Z" if end else "")
        pieces = re.split(r"\*", body)
        tokens = [
            t
            for i, piece in enumerate(pieces)
            for t in _bounded(
                piece.split("^"), host and i == 0, end and i == len(pieces) - 1
            )
        ]
        return Rule(
            pattern, action, regex, tuple(tokens), (0, len(pattern), action == "block", pattern)
        )


def _bounded(parts: list[str], left: bool, right: bool) -> tuple[str, ...]:
    """Tokens that cannot be a part of a longer one: not at an open end."""
    text = "\0".join(parts).translate(_CAPITALS)
    return tuple(
        m.group()
        for m in _TOKEN.finditer(text)
        if (left or m.start() > 0) and (right or m.end() < len(text))
    )


def split_url(url: str | None) -> tuple[str, str, str]:
    """Host (A-Z in lower case), path, and all that follows the host."""
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.partition("://")[2]
    host = re.match(r"[^/?#]*", rest).group()
    tail = rest[len(host) :]
    return host.translate(_CAPITALS), re.match(r"[^?#]*", tail).group(), tail


def _tokens(host: str, tail: str) -> set[str]:
    return set(_TOKEN.findall(host)) | set(_TOKEN.findall(tail.translate(_CAPITALS)))


class RuleIndex:
    """Each rule under one of its tokens; those without any under none."""

    def __init__(self, rules: list[Rule], frequency: dict[str, int]):
        self.rules: dict[str | None, list[tuple[Rule, re.Pattern]]] = defaultdict(list)
        for rule in rules:
            token = min(rule.tokens, key=lambda t: (frequency.get(t, 0), -len(t), t), default=None)
            self.rules[token].append((rule, re.compile(rule.regex, re.DOTALL)))

    def best(self, host: str, tail: str) -> Rule | None:
        text, best = f".{host}{tail}", None
        for token in [None, *_tokens(host, tail)]:
            for rule, regex in self.rules.get(token, ()):
                if (best is None or rule.rank > best.rank) and regex.match(text):
                    best = rule
        return best


def token_frequency(df: DataFrame, url: str, tokens: set[str]) -> dict[str, int]:
    """In how many URLs each of ``tokens`` (those of the rules) occurs."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for value in batch.column(0).to_pylist():
                host, _, tail = split_url(value)
                counts.update(_tokens(host, tail) & tokens)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
            names=["token", "n"],
        )

    counted = df.select(F.col(url).cast("string")).mapInArrow(run, "token string, n long")
    return {r["token"]: r["n"] for r in counted.groupBy("token").agg(F.sum("n").alias("n")).collect()}


def _groups(rules: list[Rule]) -> list[list[Rule]]:
    """The rules in groups of at most RULE_BYTES (or one rule)."""
    groups: list[list[Rule]] = [[]]
    size = 0
    for rule in rules:
        more = len(rule.name) + len(rule.regex)
        if groups[-1] and size + more > RULE_BYTES:
            groups.append([])
            size = 0
        groups[-1].append(rule)
        size += more
    return groups


def judge_urls(
    df: DataFrame, keys: list[str], url: str, rules: list[Rule], otherwise: str = "allow"
) -> DataFrame:
    """``keys``, host, path, rule (of_host only), pattern and verdict per row.

    One pass counts the rules' tokens in the URLs; every rule is then kept
    under its rarest. In the second pass a URL's tokens fetch the rules to try,
    and only those run their regular expression. Both are map-only but for the
    counts of the rules' tokens. More than RULE_BYTES of rules take a pass for
    each so many, each of which keeps the better of its rule and the one before.

    A null URL, or one without ``://``, has an empty host and path and fits no
    rule: ``otherwise``. Null keys, repeated rows and empty tables need no
    care; other columns, whatever their names, are not read.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    schema = T.StructType(
        [
            *[T.StructField(n, df.schema[k].dataType) for n, k in zip(names, keys)],
            T.StructField("_url", T.StringType()),
            *[T.StructField(n, T.StringType()) for n in ("host", "path", "best", "action")],
            T.StructField("kind", T.IntegerType()),
        ]
    )

    def judged_by(group: list[Rule], frequency: dict[str, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = RuleIndex(group, frequency)
            for batch in batches:
                urls = batch.column("_url").to_pylist()
                before = zip(*(batch.column(n).to_pylist() for n in ("best", "action", "kind")))
                rows = []
                for value, (name, action, kind) in zip(urls, before):
                    host, path, tail = split_url(value)
                    best = index.best(host, tail) if host or tail else None
                    # Of the rules of different groups, as of one, the larger rank.
                    if best is not None and (
                        kind is None or best.rank > (kind, len(name), action == "block", name)
                    ):
                        name, action, kind = best.name, best.action, best.rank[0]
                    rows.append((host, path, name, action, kind))
                columns = zip(*rows) if rows else [()] * 5
                kinds = [pa.string()] * 4 + [pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(n) for n in [*names, "_url"]],
                        *[pa.array(c, t) for c, t in zip(columns, kinds)],
                    ],
                    names=schema.names,
                )

        return run

    judged = df.select(
        *[F.col(k).alias(n) for n, k in zip(names, keys)],
        F.col(url).cast("string").alias("_url"),
        *[F.lit(None).cast("string").alias(n) for n in ("host", "path", "best", "action")],
        F.lit(None).cast("int").alias("kind"),
    )
    for group in _groups(rules):
        frequency = token_frequency(df, url, {t for r in group for t in r.tokens})
        judged = judged.mapInArrow(judged_by(group, frequency), schema)
    return judged.select(
        *[F.col(n).alias(k) for n, k in zip(names, keys)],
        "host",
        "path",
        F.when(F.col("kind") == 1, F.col("best")).alias("rule"),
        F.when(F.col("kind") == 0, F.col("best")).alias("pattern"),
        F.coalesce("action", F.lit(otherwise)).alias("verdict"),
    )
