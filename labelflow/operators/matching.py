"""Match unknown labels to a vocabulary: edit distance, synonyms, tokens.

Every entry of the vocabulary is listed in a dictionary under a set of keys, and
every unknown label probes the same key space, so all kinds of match are found
by one equi join that is then verified. No pair is compared unless it shares a
key:

* short labels (up to ``SHORT`` characters): the strings left after deleting at
  most k characters. Two strings within edit distance k always share one.
* longer labels: an entry is cut into k + 1 pieces. With at most k edits one
  piece is untouched, and the edits before and after it bound how far away it is
  found in the unknown label (the partition scheme of Pass-Join, VLDB 2011).
  That makes 25 keys for a label of any length.
* token fallback: the lowercase entry, probed by each lowercase token.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from labelflow.functions.text import WHITESPACE
from labelflow.storage import materialise, rows_if_at_most

TOPIC_EDITS = 2
SYNONYM_EDITS = 1
SHORT = 8

# A vocabulary up to this many entries and characters is held in the plan itself.
INLINE_LABELS = 5_000
INLINE_CHARS = 500_000
# A dictionary up to this many bytes, texts and repeats included, is broadcast.
BROADCAST_BYTES = 32 << 20

# Kinds of match, best first.
TOPIC_EDIT, SYNONYM_EDIT, TOPIC_TOKEN, SYNONYM_TOKEN = range(4)
KINDS = ("topic", "synonym", "topic token", "synonym token")


@dataclass(frozen=True)
class Vocabulary:
    """topics(pos, topic), synonyms(pos, synonym, label); ``pos`` orders ties.

    ``names`` holds every topic when the vocabulary is small, else None.
    ``nbytes`` bounds the size of the dictionary when it is known, else None.
    """

    topics: DataFrame
    synonyms: DataFrame
    names: list[str] | None
    nbytes: int | None

    @classmethod
    def of(
        cls,
        topics: DataFrame,
        synonyms: DataFrame | None = None,
        inline_limit: int = INLINE_LABELS,
    ) -> "Vocabulary":
        """Look at both tables once.

        Small ones are kept as local tables. Large ones are stored, so that the
        planner knows their true size before it thinks of broadcasting.
        """
        spark = topics.sparkSession
        topics = topics.select("pos", "topic")
        if synonyms is None:
            synonyms = topics.limit(0).select(
                "pos", F.col("topic").alias("synonym"), F.col("topic").alias("label")
            )
        synonyms = synonyms.select("pos", "synonym", "label")
        topic_rows = _small(topics, inline_limit)
        synonym_rows = _small(synonyms, inline_limit)
        nbytes = None

        def kept(table: DataFrame, rows: list[Row] | None) -> DataFrame:
            if rows is None:
                return materialise(table)
            return spark.createDataFrame(rows, table.schema)

        topics, synonyms = kept(topics, topic_rows), kept(synonyms, synonym_rows)
        if topic_rows is not None and synonym_rows is not None:
            nbytes = sum(_bytes(r["topic"], r["topic"], TOPIC_EDITS) for r in topic_rows)
            nbytes += sum(
                _bytes(r["synonym"], r["label"], SYNONYM_EDITS) for r in synonym_rows
            )
        names = None if topic_rows is None else [r["topic"] for r in topic_rows]
        return cls(topics, synonyms, names, nbytes)

    def contains(self, label: Column) -> Column:
        """Membership as a hash-set test; only for a small vocabulary."""
        if self.names is None:
            raise ValueError("vocabulary is too large for an inline test")
        return label.isin(self.names) if self.names else F.lit(False)


def _small(table: DataFrame, limit: int) -> list[Row] | None:
    """All rows of a table of few rows and characters, else None."""
    texts = [F.length(c) for c, t in table.dtypes if t == "string"]
    chars = sum((F.coalesce(t, F.lit(0)) for t in texts), F.lit(0))
    head = table.limit(limit + 1).agg(F.count("*").alias("n"), F.sum(chars).alias("c")).first()
    if head["n"] > limit or (head["c"] or 0) > INLINE_CHARS:
        return None
    return rows_if_at_most(table, limit)


def _bytes(entry: str, target: str, edits: int) -> int:
    """At most so many bytes of dictionary rows for one entry."""
    n = len(entry)
    keys = 2 + n + (n * (n - 1) // 2 if edits > 1 else 0) if n <= SHORT else edits + 2
    return keys * (4 * (n + len(target or "")) + 100)


def _deletions(text: Column, edits: int) -> Column:
    """All strings left after deleting at most ``edits`` (1 or 2) characters."""
    n = F.length(text)
    none = F.array().cast("array<string>")

    def cut(i: Column) -> Column:
        return F.concat(F.left(text, i - 1), F.substr(text, i + 1))

    def cut_two(i: Column, j: Column) -> Column:
        return F.concat(
            F.left(text, i - 1), F.substr(text, i + 1, j - i - 1), F.substr(text, j + 1)
        )

    one = F.when(n > 0, F.transform(F.sequence(F.lit(1), n), cut)).otherwise(none)
    if edits == 1:
        return F.concat(F.array(text), one)
    two = F.when(
        n > 1,
        F.flatten(
            F.transform(
                F.sequence(F.lit(1), n - 1),
                lambda i: F.transform(
                    F.sequence(i + 1, n), lambda j: cut_two(i, j)
                ),
            )
        ),
    ).otherwise(none)
    return F.concat(F.array(text), one, two)


def _deletion_keys(text: Column, edits: int) -> Column:
    return F.transform(_deletions(text, edits), lambda t: F.xxhash64(F.lit("d"), t))


def _piece(text: Column, length: Column, i: int, edits: int, shift: Column) -> Column:
    """Key of piece ``i`` of ``edits + 1`` for an entry of the given length."""
    base = F.floor(length / (edits + 1)).cast("int")
    size = length - base * edits if i == edits else base
    start = base * i + shift
    return F.xxhash64(
        F.lit("p"), F.lit(edits), F.lit(i), length, F.substr(text, start + 1, size)
    )


def _entry_keys(text: Column, edits: int) -> Column:
    n = F.length(text)
    zero = F.lit(0)
    return F.when(n <= SHORT, _deletion_keys(text, edits)).otherwise(
        F.array(*[_piece(text, n, i, edits, zero) for i in range(edits + 1)])
    )


def _probe_pieces(text: Column, edits: int) -> Column:
    """Keys of all places where an untouched piece of an entry can stand.

    If piece i is the first untouched one, at least i edits lie before it, so it
    is shifted by at most i; and at most ``edits - i`` edits lie behind it, so
    its distance from the end changes by no more than that.
    """
    n = F.length(text)
    keys = []
    for longer in range(-edits, edits + 1):
        length = n - longer
        for i in range(edits + 1):
            low = max(-i, longer - (edits - i))
            high = min(i, longer + (edits - i))
            keys += [
                F.when(length > SHORT, _piece(text, length, i, edits, F.lit(shift)))
                for shift in range(low, high + 1)
            ]
    return F.filter(F.array(*keys), lambda key: key.isNotNull())


def _tokens(text: Column) -> Column:
    words = F.split(F.lower(text), f"[{WHITESPACE}]+")
    return F.array_distinct(F.filter(words, lambda w: w != ""))


def _token_key(token: Column) -> Column:
    return F.xxhash64(F.lit("t"), token)


def _probe_keys(text: Column, longest: Column, kinds: tuple[int, ...]) -> Column:
    """All keys of an unknown label, each with the token it stands for, if any.

    ``longest`` is the length of the longest entry: no longer label can be
    within reach of an edit match, so it only probes with its tokens.
    """
    n = F.length(text)
    none = F.array().cast("array<bigint>")
    parts = []
    if TOPIC_EDIT in kinds or SYNONYM_EDIT in kinds:
        edits = TOPIC_EDITS if TOPIC_EDIT in kinds else SYNONYM_EDITS
        reach = n <= longest + edits
        parts.append(
            F.when(reach & (n <= SHORT + edits), _deletion_keys(text, edits)).otherwise(
                none
            )
        )
        for k, kind in ((TOPIC_EDITS, TOPIC_EDIT), (SYNONYM_EDITS, SYNONYM_EDIT)):
            if kind in kinds:
                parts.append(
                    F.when(
                        reach & (n > SHORT - k), _probe_pieces(text, k)
                    ).otherwise(none)
                )
    edit_keys = F.array_distinct(F.concat(none, *parts))
    probes = F.transform(
        edit_keys, lambda k: F.struct(k.alias("key"), F.lit(None).cast("string").alias("token"))
    )
    if TOPIC_TOKEN not in kinds and SYNONYM_TOKEN not in kinds:
        return probes
    words = F.transform(
        _tokens(text), lambda t: F.struct(_token_key(t).alias("key"), t.alias("token"))
    )
    return F.concat(probes, words)


def _dictionary(vocabulary: Vocabulary, kinds: tuple[int, ...]) -> DataFrame:
    """(key, kind, pos, entry, target), one row per key of an entry.

    Topics and synonyms may be ordered by columns of different types, so ``pos``
    has a place for each; entries of the two are never compared with each other.
    """
    at, none = F.col("pos"), F.lit(None)
    topic_type = vocabulary.topics.schema["pos"].dataType
    synonym_type = vocabulary.synonyms.schema["pos"].dataType
    topics = vocabulary.topics.select(
        F.struct(at.alias("t"), none.cast(synonym_type).alias("s")).alias("pos"),
        F.col("topic").alias("entry"),
        F.col("topic").alias("target"),
    )
    synonyms = vocabulary.synonyms.select(
        F.struct(none.cast(topic_type).alias("t"), at.alias("s")).alias("pos"),
        F.col("synonym").alias("entry"),
        F.col("label").alias("target"),
    )
    entry = F.col("entry")
    word = F.array(_token_key(F.lower(entry)))
    sources = {
        TOPIC_EDIT: (topics, _entry_keys(entry, TOPIC_EDITS)),
        SYNONYM_EDIT: (synonyms, _entry_keys(entry, SYNONYM_EDITS)),
        TOPIC_TOKEN: (topics, word),
        SYNONYM_TOKEN: (synonyms, word),
    }
    out = None
    for kind in kinds:
        table, keys = sources[kind]
        part = table.select(
            F.explode(F.array_distinct(keys)).alias("key"),
            F.lit(kind).alias("kind"),
            "pos",
            "entry",
            "target",
        )
        out = part if out is None else out.unionByName(part)
    if vocabulary.nbytes is not None and vocabulary.nbytes <= BROADCAST_BYTES:
        return F.broadcast(out)
    return out.hint("merge")


def match_misses(
    misses: DataFrame,
    vocabulary: Vocabulary,
    kinds: tuple[int, ...] = (TOPIC_EDIT, SYNONYM_EDIT, TOPIC_TOKEN, SYNONYM_TOKEN),
) -> DataFrame:
    """Best match of each distinct unknown label: (miss, label, kind, distance).

    The first kind that hits wins, then the smaller distance, then the earlier
    entry. Labels without any match are absent.
    """
    miss, entry, kind = F.col("miss"), F.col("entry"), F.col("kind")
    longest = (
        vocabulary.topics.select(F.length("topic").alias("n"))
        .unionAll(vocabulary.synonyms.select(F.length("synonym")))
        .agg(F.coalesce(F.max("n"), F.lit(0)))
    )
    probes = (
        misses.select(miss, longest.scalar().alias("longest"))
        .select(miss, F.explode(_probe_keys(miss, F.col("longest"), kinds)).alias("p"))
        .select("miss", "p.key", "p.token")
    )
    near = F.levenshtein(miss, entry, TOPIC_EDITS)
    distance = (
        F.when((kind == TOPIC_EDIT) & (near > 0), near)
        .when((kind == SYNONYM_EDIT) & near.between(0, SYNONYM_EDITS), near)
        .when(
            (kind >= TOPIC_TOKEN) & (F.col("token") == F.lower(entry)),
            F.levenshtein(miss, entry),
        )
    )
    order = F.struct("kind", "distance", "pos", "entry")
    return (
        probes.join(_dictionary(vocabulary, kinds), "key")
        .withColumn("distance", distance)
        .where(F.col("distance").isNotNull())
        .groupBy("miss")
        .agg(F.min(F.struct(order.alias("order"), "target")).alias("best"))
        .select(
            "miss",
            F.col("best.target").alias("label"),
            F.element_at(
                F.array(*[F.lit(k) for k in KINDS]), F.col("best.order.kind") + 1
            ).alias("kind"),
            F.col("best.order.distance").alias("distance"),
        )
    )
