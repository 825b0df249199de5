"""Nulls, empty and long texts, ties, repeats, empty tables and clashing names."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from labelflow.llm import (
    mixing,
    packing,
    quality,
    similar,
    simhash,
    substring_dedup,
    token_counts,
    token_files,
    topk,
    url_filters,
    warc,
)
from labelflow.llm.components import connected
from labelflow.llm.tokens import PieceCounter, WordEncoder
from labelflow.storage import scratch_dir

WORDS = tokenizer_path("word_bpe_49k.json")
BYTES = tokenizer_path("byte_bpe_50k.json")
#: Columns that the operators use inside or return.
CLASHING = (
    "_row string, _marks string, _text string, row string, kept boolean, size string, target string, "
    "copies string, fp string, component_id string, _k0 string, _pos string, digest string, place int"
)
DOCS = "doc_id long, text string, lang string, source string, n_chars long, " + CLASHING
ODD_TEXTS = [
    "", "  ", "\n\n", "a<|endoftext|>b c", "a  b  c\x1cd \x85e", "\x01 x\x01y", "É é e\u0301 T\u0308 t\u0308",
    "don't we'll 's 123 4.5e", " lead\n\n\tand\x0b\x0ctrail  ", "😀 😀😀", "ΑΣ Σ. İI", "x\ufeff y\u180e z\u200b w",
    "end. of, line.\u0301 ok", "<|startoftext|><|ENDOFTEXT|> <|end oftext|>",
]


def prose(n, seed):
    chosen = random.Random(seed)
    return " ".join("".join(chosen.choices("abcdefghij", k=chosen.randint(2, 9))) for _ in range(n))


@pytest.fixture(scope="module")
def odd_rows():
    long = prose(60_000, 1)
    texts = [None, "", "   \n ", prose(80, 2), prose(80, 2), prose(80, 3), long, "x" * 300_000, *ODD_TEXTS]
    ids = [None, 1, 2, 3, 3, 4, 5, 6, None, *range(7, 7 + len(ODD_TEXTS) - 1)]
    return [
        (i, t, None, None if k % 3 == 0 else f"s{k % 2}", None if t is None else len(t), *["x"] * 4, True, *["y"] * 8, 1)
        for k, (i, t) in enumerate(zip(ids, texts))
    ]


@pytest.fixture(scope="module")
def odd(spark, odd_rows):
    fields = DOCS.count(",") + 1
    rows = [r[:5] + tuple("x" if n not in (4, 13) else (True if n == 4 else 1) for n in range(fields - 5)) for r in odd_rows]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOCS)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=60), max_size=6))
def test_word_encoder_equals_library(texts):
    encoder = test_word_encoder_equals_library.encoder
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    for i, text in enumerate(texts):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == expected


test_word_encoder_equals_library.encoder = WordEncoder(WORDS)


def test_word_encoder_on_odd_texts():
    encoder = WordEncoder(WORDS)
    ids, bounds = encoder.encode(pa.array(ODD_TEXTS))
    for i, text in enumerate(ODD_TEXTS):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert ids[bounds[i] : bounds[i + 1]].tolist() == expected
    with pytest.raises(ValueError):
        WordEncoder(BYTES)


@settings(max_examples=80, deadline=None)
@given(
    st.lists(st.text(max_size=60) | st.text(alphabet=st.sampled_from("ab.1' \n\t\u00a0\x1c\u180e\x00<|é\u3000"), max_size=60), max_size=5)
)
def test_piece_counter_equals_library(texts):
    counter = test_piece_counter_equals_library.counter
    expected = [len(counter.tokenizer.encode(t, add_special_tokens=False)) for t in texts]
    assert counter.count(pa.array(texts, pa.string())).tolist() == expected


test_piece_counter_equals_library.counter = PieceCounter(BYTES, 100)


def test_token_counts(odd, none, odd_rows):
    tokenizer = Tokenizer.from_file(BYTES)
    rows = token_counts.count_tokens(odd, ["doc_id"], "text", BYTES).collect()
    expected = Counter(
        (r[0], len((r[1] or "").encode()), len(tokenizer.encode(r[1] or "", add_special_tokens=False)))
        for r in odd_rows
    )
    assert Counter(map(tuple, rows)) == expected
    assert token_counts.count_tokens(none, ["doc_id"], "text", BYTES).count() == 0
    pieces = token_counts.count_tokens(odd, ["doc_id"], "text", tokenizer_path("piece_bpe_32k.model"))
    assert pieces.count() == len(odd_rows)


def test_packing(odd, none, odd_rows):
    packed = packing.pack_documents(odd, "doc_id", "text", WORDS, 1, 512, with_ids=True)
    rows = packed.collect()
    bins = Counter()
    for r in rows:
        bins[r["sequence_id"]] += r["length"]
        assert len(r["ids"]) == r["length"] <= 512
    assert max(bins.values()) <= 512
    tokenizer = Tokenizer.from_file(WORDS)
    total = sum(len(tokenizer.encode(r[1] or "", add_special_tokens=False)) + 1 for r in odd_rows)
    assert sum(bins.values()) == total and len(bins) <= total / 512 + 2
    assert packing.pack_documents(none, "doc_id", "text", WORDS, 1, 512).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=120))
def test_fit(sizes):
    bin_of, offset, free = packing.fit(np.array(sizes, np.int64), 50)
    for b in range(len(free)):
        mine = [i for i in range(len(sizes)) if bin_of[i] == b]
        spans = sorted((offset[i], sizes[i]) for i in mine)
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) + free[b] == 50
    half = [b for b in range(len(free)) if free[b] >= 25]
    assert len(half) <= 1


def test_pack_merges_open_sequences_of_partitions(spark):
    """In the end no two sequences fit into one, whatever the partitions were."""
    size = (F.pmod(F.xxhash64("id"), F.lit(45)) + 1).alias("size")
    rows = spark.range(50).select(size, "id").repartition(10)
    packed = packing.pack(rows, "size", 50)
    fills = sorted(r["n"] for r in packed.groupBy("sequence_id").agg(F.sum("size").alias("n")).collect())
    assert packed.count() == 50 and fills[0] + fills[1] > 50 and fills[-1] <= 50


def test_pack_of_sizes_that_never_fit_together_ends(spark, monkeypatch):
    monkeypatch.setattr(packing, "ITEMS", 7)
    packed = packing.pack(spark.range(60).select(F.lit(30).cast("long").alias("size"), "id"), "size", 50)
    assert packed.select("sequence_id").distinct().count() == 60


def test_pack_lets_the_last_two_that_fit_meet(spark, monkeypatch):
    """Of 102 open sequences two fit into one, in whichever tasks they are."""
    monkeypatch.setattr(packing, "ITEMS", 7)
    for other in (30, 60, 101):
        sizes = [35] * 102
        sizes[0], sizes[other] = 20, 30
        rows = spark.createDataFrame(
            spark.sparkContext.parallelize(list(enumerate(sizes)), 20), "id long, size long"
        )
        found = packing.pack(rows, "size", 50).collect()
        assert len(found) == 102
        place = {r["id"]: (r["sequence_id"], r["offset"]) for r in found}
        assert len({s for s, _ in place.values()}) == 101 and place[0][0] == place[other][0]
        assert {place[0][1], place[other][1]} in ({0, 20}, {0, 30})


def test_token_files(spark, odd, none, odd_rows):
    tokenizer = Tokenizer.from_file(WORDS)
    folder = scratch_dir(spark)
    token_files.write_token_files(odd, "doc_id", "text", WORDS, 2, folder, shards=3)
    rows = token_files.read_token_files(spark, folder, odd, "doc_id", with_ids=True).collect()
    expected = Counter(
        (r[0], tuple(tokenizer.encode(r[1] or "", add_special_tokens=False).ids + [2])) for r in odd_rows
    )
    assert Counter((r["key"], tuple(r["ids"])) for r in rows) == expected
    at = 0
    for r in sorted(rows, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]
    order = [r["key"] for r in sorted(rows, key=lambda r: r["start"])]
    assert order == sorted(order, key=lambda k: (k is not None, k or 0))
    unknown = spark.createDataFrame([(10**12,), (-5,)], "doc_id long")
    assert token_files.read_token_files(spark, folder, unknown, "doc_id").count() == 0
    empty = scratch_dir(spark)
    token_files.write_token_files(none, "doc_id", "text", WORDS, 2, empty)
    assert token_files.read_token_files(spark, empty, odd, "doc_id").count() == 0


@settings(max_examples=40, deadline=None)
@given(st.sets(st.integers(-(2**63), 2**63 - 1), max_size=300))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), np.int64)
    slots = token_files.PerfectHash.build(keys).slots(keys)
    assert sorted(slots.tolist()) == list(range(len(keys)))


def test_one_key_in_many_shards(spark):
    rows = [(7, prose(20, i)) for i in range(200)] + [(i, prose(5, i)) for i in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    folder = scratch_dir(spark)
    manifest = token_files.write_token_files(df, "doc_id", "text", WORDS, 2, folder, shards=6)
    assert manifest.where("least <= 7 and most >= 7").count() > 2
    found = token_files.read_token_files(spark, folder, df, "doc_id")
    assert found.count() == 220 and found.where("key = 7").count() == 201


def test_covering_masks():
    chosen = random.Random(5)
    for radius in (1, 2, 3, 5):
        masks = [m % (1 << 64) for m in simhash.covering_masks(radius)]
        assert len(masks) == 2 ** (radius + 1) - 1
        for _ in range(2_000):
            differ = sum(1 << i for i in chosen.sample(range(64), radius))
            assert any(not differ & m for m in masks)


@pytest.mark.parametrize("radius, least", [(5, 31), (6, 32), (7, 28), (8, 28), (9, 28)])
def test_every_covering_mask_is_wide(radius, least):
    masks = [m % (1 << 64) for m in simhash.covering_masks(radius)]
    assert len(set(masks)) == 2 ** (radius + 1) - 1
    assert min(m.bit_count() for m in masks) >= least
    chosen = random.Random(radius)
    for _ in range(500):
        differ = sum(1 << i for i in chosen.sample(range(64), radius))
        assert any(not differ & m for m in masks)


def test_links_of_full_buckets(spark, monkeypatch):
    """Blocks of a crowded bucket are all compared: same groups as all pairs."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    chosen = random.Random(3)
    base = [chosen.getrandbits(63) for _ in range(4)]
    values = set()
    for b in base:
        for _ in range(60):
            v = b
            for i in chosen.sample(range(63), chosen.randint(0, 3)):
                v ^= 1 << i
            values.add(v)
    df = spark.createDataFrame([(v, v, 0) for v in values], "node long, fp long, also long")
    found = connected(simhash.near_links(df, 2)).collect()
    root = {r["node"]: r["root"] for r in found}
    parent = {v: v for v in values}

    def find(v):
        while parent[v] != v:
            v = parent[v]
        return v

    ordered = sorted(values)
    for i, a in enumerate(ordered):
        for b in ordered[:i]:
            if (a ^ b).bit_count() <= 2:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    assert {v: root.get(v, v) for v in values} == {v: find(v) for v in values}


def test_near_links_once_connect_what_any_distance_connects(spark, monkeypatch):
    """Links left out because an earlier table has them part nobody, at any
    distance in the second fingerprint, also in crowded buckets."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    chosen = random.Random(5)

    def near(bits, most, width):
        return sum(1 << i for i in chosen.sample(range(width), chosen.randint(0, most))) ^ bits

    rows = {}
    for _ in range(3):
        fp, also = chosen.getrandbits(63), chosen.getrandbits(63)
        for _ in range(50):
            rows[len(rows)] = near(fp, 3, 63), near(also, 6, 63)
    for k in range(60):  # a chain, each within 3 bits of the one before
        fp = near(fp, 3, 63)
        rows[len(rows)] = fp, near(also, 6, 63)
    df = spark.createDataFrame([(k, *v) for k, v in rows.items()], "node long, fp long, also long")
    often, once = (
        {(r["a"], r["b"]) for r in found.collect()}
        for found in (
            simhash.near_links(df, 3, 8, similar.nearest_tree),
            simhash.near_links(df, 3, 8, similar.nearest_tree, once=True),
        )
    )
    assert once < often

    def groups(links):
        label = list(range(len(rows)))
        for a, b in links:
            x, y = label[a], label[b]
            label = [x if c == y else c for c in label]
        first = {}
        return [first.setdefault(c, i) for i, c in enumerate(label)]

    def apart(what, a, b):
        return (rows[a][what] ^ rows[b][what]).bit_count()

    every = [(a, b) for a in rows for b in range(a) if apart(0, a, b) <= 3]
    for limit in range(9):
        assert groups([e for e in once if apart(1, *e) <= limit]) == groups(
            [e for e in every if apart(1, *e) <= limit]
        )
    assert all(apart(0, *e) <= 3 and apart(1, *e) <= 8 for e in once)


def test_nearest_tree_connects_what_any_distance_connects():
    chosen = random.Random(11)
    for n in (1, 2, 3, 40):
        values = np.array([chosen.getrandbits(3) for _ in range(n)], np.int64)
        also = np.array([chosen.getrandbits(7) for _ in range(n)], np.int64)
        a, b = similar.nearest_tree(values, also, 2, 5)
        for limit in range(6):
            apart = np.bitwise_count(also[:, None] ^ also)
            near = (np.bitwise_count(values[:, None] ^ values) <= 2) & (apart <= limit)
            tree = np.zeros_like(near)
            some = apart[a, b] <= limit
            tree[a[some], b[some]] = tree[b[some], a[some]] = True
            for _ in range(7):
                near = near | (near.astype(int) @ near > 0)
                tree = tree | (tree.astype(int) @ tree > 0)
            assert len(a) < n and (near | np.eye(n, dtype=bool) == tree | np.eye(n, dtype=bool)).all()


def test_similar_texts_cases(spark, odd, none, odd_rows, monkeypatch):
    """Null, empty and repeated rows, clashing columns, and a group of copies
    with edits that is dealt into blocks."""
    kept = similar.keep_dissimilar(odd, 5, 0.8, 6, 19)
    assert kept.columns == odd.columns
    blank = [r for r in kept.collect() if not (r["text"] or "").strip()]
    assert len(blank) == 1 and kept.where("doc_id = 3").count() == 1
    assert similar.keep_dissimilar(none, 5, 0.8, 6, 19).count() == 0
    monkeypatch.setattr(simhash, "BLOCK", 8)
    words = prose(300, 77).split()
    rows = [(i, " ".join([*words[: 6 * i], f"edit{i}", *words[6 * i + 1 :]])) for i in range(40)]
    rows += [(100 + i, prose(60, 900 + i)) for i in range(20)] + [(200, " ".join(words[:180]))]
    df = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(3)
    found = sorted(r["doc_id"] for r in similar.keep_dissimilar(df, 5, 0.8, 6, 19).collect())
    assert found == [0, *range(100, 120), 200]


def test_components_of_a_long_chain_and_a_hub(spark):
    chain = [(i, i + 1) for i in range(300)]
    hub = [(1_000, 1_000 + i) for i in range(1, 400)] + [(2_000, 2_000)]
    links = spark.createDataFrame(chain + hub, "a long, b long")
    root = {r["node"]: r["root"] for r in connected(links).collect()}
    assert root == {i: 0 for i in range(301)} | {1_000 + i: 1_000 for i in range(400)}


def test_near_duplicates_cases(odd, none, odd_rows):
    rows = simhash.near_duplicates(odd, "doc_id", "text").collect()
    assert len(rows) == len(odd_rows)
    empty = {r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert empty == {1}
    assert {r["component_id"] for r in rows if r["doc_id"] == 3} == {3}
    assert simhash.near_duplicates(none, "doc_id", "text").count() == 0
    nulls = odd.withColumn("doc_id", F.lit(None).cast("long"))
    assert {r["component_id"] for r in simhash.near_duplicates(nulls, "doc_id", "text").collect()} == {None}


def test_repeats_cases(spark, odd, none, odd_rows):
    rows = substring_dedup.repeats(odd, ["doc_id"], "text").collect()
    assert len(rows) == len(odd_rows)
    twice = sorted(r["text"] for r in rows if r["doc_id"] == 3)
    assert twice == ["", prose(80, 2)]
    assert substring_dedup.repeats(none, ["doc_id"], "text").count() == 0
    passage = prose(55, 9)
    texts = [f"{prose(40 + i, 100 + i)} {passage} {prose(40, 200 + i)}" for i in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in substring_dedup.repeats(df, ["doc_id"], "text").collect()}
    cut = [r for r in found.values() if r["removed_words"]]
    assert len(cut) == 29
    for r in cut:
        assert 25 <= r["removed_words"] <= 55
        assert prose(40 + r["doc_id"], 100 + r["doc_id"]) in r["text"]
        assert prose(40, 200 + r["doc_id"]) in r["text"]


def test_earlier_is_by_row_number_not_by_task(spark):
    """Tasks that hold the rows in another order mark the same chunks."""
    text = prose(80, 5)
    rows = [(1, text), (0, text), (2, f"{prose(60, 6)} {text} {text}")]
    marks = []
    for order in (rows, sorted(rows)):
        df = spark.createDataFrame(spark.sparkContext.parallelize(order, 3), "row long, text string")
        found = substring_dedup._marks(df, "row", "text").collect()
        marks.append({r["_marked"]: sorted(r["_marks"]) for r in found})
    assert marks[0] == marks[1] and set(marks[0]) == {1, 2}
    chunks = substring_dedup.Chunks([text.encode()])
    assert marks[0][1] == list(range(len(chunks.first) - 1))


def test_a_text_of_single_chunks_of_others_is_left_alone(spark):
    """No run of words of the last text is anywhere else as a whole."""
    others = [prose(60, 40 + i) for i in range(6)]
    parts = []
    for text in others:
        chunks = substring_dedup.Chunks([text.encode()])
        at = int(np.argmax(chunks.size[2:-2])) + 2
        words = text.split()
        parts += words[chunks.first[at] : chunks.last[at] + 1]
    assert len(parts) > substring_dedup.LEAST_WORDS
    rows = list(enumerate([*others, " ".join(parts), f"{others[0]} {others[1]}"]))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in substring_dedup.repeats(df, ["doc_id"], "text").collect()}
    assert [found[i]["removed_words"] for i in range(7)] == [0] * 7
    assert found[7]["removed_words"] >= 90


@pytest.mark.parametrize("period", range(1, 9))
def test_repeated_lines_are_cut_at_the_same_words(period):
    """60 words that repeat a short line, behind different words: most of them are
    in whole chunks that both documents have."""
    for seed in range(60):
        line = prose(period, 1_000 * period + seed).split()
        passage = (line * 60)[:60]
        chunks = []
        for side in (1, 2):
            around = [prose(30 + (7 * seed * side) % 23, 31 * seed + 7 * side + k) for k in (0, 3)]
            text = " ".join([around[0], *passage, around[1]])
            chunks.append(substring_dedup.Chunks([text.encode()]))
        shared = np.isin(chunks[1].digest, chunks[0].digest)
        assert chunks[1].size[shared].sum() >= 30, (period, seed)
        known = set(zip(chunks[0].digest[:-1], chunks[0].digest[1:]))
        pairs = zip(chunks[1].digest[:-1], chunks[1].digest[1:])
        marks = np.flatnonzero([p in known for p in pairs])
        found = substring_dedup._passages(chunks[1], 0, marks)
        assert sum(b - a for a, b in found) >= 30, (period, seed)


def test_word_boundaries_resist_insertions():
    text = prose(400, 4).encode()
    first = substring_dedup.Chunks([text])
    second = substring_dedup.Chunks([b"some new words here " + text])
    assert len(set(first.digest.tolist()) - set(second.digest.tolist())) <= 2


def test_chunks_do_not_depend_on_other_texts():
    texts = [prose(n, n).encode() for n in range(1, 60)]
    together = substring_dedup.Chunks(texts)
    alone = [d for t in texts for d in substring_dedup.Chunks([t]).digest.tolist()]
    assert together.digest.tolist() == alone


def test_cuts_of_repeated_lines_do_not_depend_on_other_texts():
    texts = [f"{prose(n % 7, n)} {f'{prose(1 + n % 9, n)} ' * (n % 40)}".encode() for n in range(300)]
    together = substring_dedup.Chunks(texts)
    alone = [d for t in texts for d in substring_dedup.Chunks([t]).digest.tolist()]
    assert together.digest.tolist() == alone


def test_quality_cases(spark, odd, none, odd_rows):
    labels = spark.createDataFrame([(3, 1, 0), (None, 1, 0), (4, None, 1)], "doc_id long, quality int, toxic int")
    assert quality.train(odd, labels) is None
    assert quality.train(none, labels.limit(0)) is None
    rows = quality.judge(odd, ["doc_id"], "text", None).collect()
    assert len(rows) == len(odd_rows)
    assert all(r["base_failed"] and not r["kept"] for r in rows if r["n_words"] < 50)
    assert quality.judge(none, ["doc_id"], "text", None).count() == 0
    kept = quality.keep_good(odd, None)
    assert kept.columns == odd.columns and kept.count() == sum(r["kept"] for r in rows)


def test_quality_classifier_on_unseen_rows(spark):
    """Held-out accuracy on texts of two kinds."""
    good = [prose(90, i) for i in range(160)]
    bad = [" ".join(f"{w}###" for w in prose(90, 1_000 + i).split()) for i in range(160)]
    texts = [t for pair in zip(good, bad) for t in pair]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i in range(200)], "doc_id long, quality int")
    model = quality.train(docs, labels)
    rows = quality.judge(docs.where("doc_id >= 200"), ["doc_id"], "text", model).collect()
    assert len(rows) == 120 and all(r["kept"] == (r["doc_id"] % 2 == 0) for r in rows)


def test_mixing_cases(odd, none, odd_rows):
    mixed = mixing.mix_documents(odd)
    assert mixed.columns == odd.columns
    times = Counter(r["text"] for r in mixed.collect())
    have = Counter(r[1] for r in odd_rows)
    assert all(n <= 2 * have[t] for t, n in times.items())
    assert mixing.mix_documents(none).count() == 0


def test_mixing_takes_each_crossing_once(spark):
    """Against the plain method: prefix sums of expected copies, one offset."""
    mix = mixing.Mix(weights=(3, 1), share=0.9)
    rows = [(i, "a" if i % 3 else None, 1 + i % 7) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, size long").repartition(5)
    found = {r["doc_id"]: r for r in mixing.copies(df, "source", "size", [F.col("doc_id")], mix).collect()}
    for source in ("a", None):
        own = sorted((s, d) for d, x, s in rows if x == source)
        total = sum(s for s, _ in own)
        rate = found[own[0][1]]["target"] / total
        for k, (_, doc) in enumerate(own):
            expected = int(mix.offset + rate * (k + 1)) - int(mix.offset + rate * k)
            assert found[doc]["copies"] == expected


def test_url_rules(spark):
    rules = [
        url_filters.Rule.of_host("org", "/", "allow"),
        url_filters.Rule.of_host("example.org", "/en/1", "block"),
        url_filters.Rule.of_host("EXAMPLE", "/", "block"),
        url_filters.Rule.of_pattern("||ads.*^x", "block"),
        url_filters.Rule.of_pattern("*", "allow"),
        url_filters.Rule.of_pattern(".gif|", "block"),
        url_filters.Rule.of_pattern("Track*me", "block"),
    ]
    urls = {
        "http://a.EXAMPLE.org/en/12?x": ("a.example.org", "/en/12", "example.org/en/1", "block"),
        "http://myexample.org/en/12": ("myexample.org", "/en/12", "org/", "allow"),
        "http://example.org": ("example.org", "", None, "allow"),
        "http://example.org/EN/1": ("example.org", "/EN/1", "org/", "allow"),
        "http://ads.b.net/x": ("ads.b.net", "/x", None, "block"),
        "http://b.net/y.gif": ("b.net", "/y.gif", None, "block"),
        "http://b.net/y.gif?a": ("b.net", "/y.gif", None, "allow"),
        "http://b.net/Trackingme": ("b.net", "/Trackingme", None, "block"),
        "http://b.net/trackingme": ("b.net", "/trackingme", None, "allow"),
        "x://y://z.org/p#q": ("y:", "//z.org/p", None, "allow"),
        "no scheme.org/": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    df = spark.createDataFrame([(u, i, "h", "p") for i, u in enumerate(urls)], "url string, id int, host string, path string")
    for frequency in (None, {}):
        rows = url_filters.judge_urls(df, ["url"], "url", rules).collect()
        assert {r["url"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows} == urls
    assert url_filters.judge_urls(df.limit(0), ["url"], "url", rules).count() == 0


def test_every_rule_is_found_by_any_of_its_tokens():
    chosen = random.Random(8)
    rules = [url_filters.Rule.of_host(f"h{i}.org", f"/p{i}/q", "block") for i in range(50)]
    for _ in range(20):
        frequency = {t: chosen.random() for r in rules for t in r.tokens}
        index = url_filters.RuleIndex(rules, frequency)
        for i in range(50):
            assert index.best(f"www.h{i}.org", f"/p{i}/qx?y").name == f"h{i}.org/p{i}/q"
            assert index.best(f"h{i}.org", f"/p{i}/r") is None


def test_warc_cases(spark):
    rows = [
        (1, "http://a/ü\r\nX: y", "<p>same</p>"), (None, None, "<p>same</p>"), (5, "http://b", "<p>same</p>"),
        (5, "http://b", "<p>same</p>"), (2, "u", None), (3, "u", ""), (4, "u", "long " * 300_000), (6, "u", "ü"),
    ]
    schema = "page_id long, url string, html string, digest string, row string, first_page long"
    pages = spark.createDataFrame([(*r, "d", "r", 1) for r in rows], schema).repartition(3)
    folder = scratch_dir(spark)
    index = warc.write_archives(pages, "page_id", "url", "html", folder)
    found = warc.read_records(index, folder, with_payload=True).collect()
    assert len(found) == len(rows)
    payloads = Counter((r["page_id"], bytes(r["payload"])) for r in found if r["payload"] is not None)
    assert payloads == Counter(
        {(5, b"<p>same</p>"): 1, (3, b""): 1, (4, b"long " * 300_000): 1, (6, "ü".encode()): 1}
    )
    revisits = Counter((r["page_id"], r["refers_to"], r["payload_bytes"]) for r in found if r["record_type"] == "revisit")
    assert revisits == Counter({(1, 5, 11): 1, (None, 5, 11): 1, (5, 5, 11): 1, (2, 3, 0): 1})
    some = index.where("page_id in (1, 4)")
    assert {r["page_id"] for r in warc.read_records(some, folder).collect()} == {1, 4}
    other = scratch_dir(spark)
    index = warc.write_archives(pages, "page_id", "url", "html", other, least_bytes=5)
    assert index.where("record_type = 'revisit'").count() == 3
    empty = scratch_dir(spark)
    index = warc.write_archives(pages.limit(0), "page_id", "url", "html", empty)
    assert warc.read_records(index, empty).count() == 0


def brute_top_k(rows, k):
    values = {i: [int(np.floor(1024 * float(np.float32(x)))) for x in v] for i, v in rows.items()}
    out = set()
    for q, a in values.items():
        if q % 100 == 0:
            scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in values.items() if i != q]
            out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scores)[:k])}
    return out


def test_top_k_cases(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 64)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "FIRST", 16)
    chosen = random.Random(2)
    rows = {i: [chosen.gauss(0, 0.3) * (1 if i % 2 else 20) for _ in range(24)] for i in range(700)}
    rows |= {700 + i: rows[i % 5] for i in range(40)}  # ties
    rows[100] = rows[100][:7]  # shorter
    bad = [(1_000, None), (1_100, [1.0, None]), (1_200, [float("nan")]), (1_300, [float("inf")]), (None, [1.0])]
    df = spark.createDataFrame([*rows.items(), *bad], "vec_id long, embedding array<float>").repartition(3)
    found = topk.top_k(df, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10)
    assert {tuple(r) for r in found.collect()} == brute_top_k(rows, 10)
    few = df.where("vec_id < 4")
    assert topk.top_k(few, "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10).count() == 3
    assert topk.top_k(df.limit(0), "vec_id", "embedding", F.col("vec_id") % 100 == 0, 10).count() == 0


def test_max_score_prunes():
    rng = np.random.default_rng(0)
    value = rng.integers(-300, 300, (64, 3_000)).astype(np.float64)
    value[:, 7] = 290
    query = np.full(64, 250.0)
    at, score = topk.max_score(query, value, np.arange(3_000), -1, 5)
    every = query @ value
    best = np.lexsort((np.arange(3_000), -every))[:5]
    assert at.tolist() == best.tolist() and score.tolist() == every[best].tolist()


def test_stages_on_odd_and_empty_tables(spark, odd, none, tmp_path):
    labels = spark.createDataFrame([(3, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd, none):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, docs, str(tmp_path))
            if name != "packing":
                assert result.columns == docs.columns
            assert docs is odd or result.count() == 0
            result.collect()
