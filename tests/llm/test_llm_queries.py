"""The queries over the smallest test tables, against plain versions of them."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import duckdb
import numpy as np
import pytest
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from xxhash import xxh64_intdigest

import corpus_pipeline
from labelflow.llm import queries, substring_dedup

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")
WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def documents():
    rows = duckdb.sql(f"SELECT * FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id")
    return rows.fetchall()


@pytest.fixture(scope="module")
def texts(documents):
    return {r[0]: r[1] or "" for r in documents}


def ids(name, text, end=None):
    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    found = tokenizer.encode(text, add_special_tokens=False).ids
    return found + [end] if end is not None else found


def crc(values):
    return zlib.crc32(np.array(values, "<u4").tobytes())


def fingerprint(text, shingle=3):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(items, linked):
    """Least key reachable, by comparing all pairs."""
    parent = {k: k for k in items}

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    keys = sorted(items)
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if linked(items[a], items[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {k: find(k) for k in keys}


def shingle_set(text):
    """Five-word shingles; a text with fewer words is one."""
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def alike(a, b):
    if min(len(a), len(b)) < 0.8 * max(len(a), len(b)):
        return False
    common = len(a & b)
    return common >= 0.8 * (len(a) + len(b) - common)


def test_quality_counts(spark, texts):
    rows = queries.op2_quality_rules(spark, SF_DIR).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[r["doc_id"]]
        words = WORD.findall(text)
        windows = Counter(zip(words, words[1:], words[2:]))
        marked = {
            i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)
        }
        lines = [x for x in text.split("\n") if WORD.search(x)]
        failed = len(words) < 50 or 100 * len(marked) > 50 * len(words)
        assert (
            r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"],
            r["base_failed"],
        ) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
            len(lines) - len(set(lines)), len(marked), failed,
        )
        assert not (failed and r["kept"])


def test_packing(spark, texts):
    rows = queries.op4_best_fit_packing(spark, SF_DIR).collect()
    pieces, places = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    total = 0
    for doc, found in pieces.items():
        expected = ids(queries.WORD_BPE, texts[doc], 1)
        total += len(expected)
        found.sort(key=lambda r: r["piece"])
        assert [r["piece"] for r in found] == list(range(-(-len(expected) // 4096)))
        for r in found:
            part = expected[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 4096 * r["piece"] and len(part) == r["length"]
            assert part == expected[r["start"] : r["start"] + 4096]
            assert r["ids_crc32"] == crc(part)
    for spans in places.values():
        spans.sort()
        assert [s for s, _ in spans] == [sum(n for _, n in spans[:i]) for i in range(len(spans))]
        assert sum(n for _, n in spans) <= 4096
    assert len(places) <= total / 4096 * 1.02 + 1


def test_simhash(spark, texts):
    prints = {k: fingerprint(t) for k, t in texts.items()}
    expected = components(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    rows = queries.op6_simhash_near_dedup(spark, SF_DIR).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in rows} == {
        (k, f"{prints[k]:016x}", expected[k]) for k in texts
    }
    assert len(rows) == len(texts)


def test_token_counts(spark, texts):
    rows = queries.op7_token_counts(spark, SF_DIR).collect()
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in rows}
    for doc, text in texts.items():
        n = len(ids(queries.BYTE_BPE, text))
        assert found[doc] == (len(text.encode()), n, n > 1024)


def test_token_files(spark, texts):
    rows = queries.op9_token_files(spark, SF_DIR).collect()
    found = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in rows}
    start = 0
    for doc in sorted(texts):
        expected = ids(queries.WORD_BPE, texts[doc], 2)
        assert found[doc] == (start, len(expected), crc(expected))
        start += len(expected)


def plain_chunks(words, gear):
    """First words of the chunks: the rule of cuts, word by word."""
    line, hashes = " ".join(words).encode(), []
    at = 0
    for word in words:
        before = line[max(0, at - 8) : at]
        rolled = sum(int(gear[b]) << k for k, b in enumerate(reversed(before)))
        hashes.append(rolled % 2**32 if at >= 8 else None)
        at += len(word.encode()) + 1
    chosen = [h is not None and h >> 28 < 5 for h in hashes]
    opens = {
        i for i in range(len(words)) if i == 0 or chosen[i] and not any(chosen[max(0, i - 2) : i])
    }
    extra = []
    for i, h in enumerate(hashes):
        around = range(max(0, i - 8), min(len(words), i + 9))
        if h is None or opens.intersection(around) or (extra and i - extra[-1] <= 2):
            continue
        if all(hashes[k] is None or h <= hashes[k] for k in around):
            extra.append(i)
    return sorted(opens | set(extra))


def test_repeats_equal_a_plain_version(spark, texts):
    gear = substring_dedup.GEAR
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    # rows are judged in the order of storage
    order = [r["doc_id"] for r in docs.select("doc_id").collect()]
    rows = substring_dedup.repeats(docs, ["doc_id"], "text").collect()
    found = {r["doc_id"]: r for r in rows}
    seen, removed = set(), Counter()
    for doc in order:
        words = WORD.findall(texts[doc])
        first = plain_chunks(words, gear) if words else []
        ends = [*first[1:], len(words)][: len(first)]
        chunks = [tuple(words[a:b]) for a, b in zip(first, ends)]
        run, left = [], set(range(len(words)))
        for i in range(len(chunks)):
            pair = tuple(chunks[i : i + 2])
            if len(pair) == 2 and pair in seen:
                run.append(i)
                continue
            if run and ends[i] - first[run[0]] >= 20:
                left -= set(range(first[run[0]], ends[i]))
            run = []
            if len(pair) == 2:
                seen.add(pair)
        assert WORD.findall(found[doc]["text"]) == [words[i] for i in sorted(left)], doc
        removed["words"] += len(words) - len(left)
    assert removed["words"] > 100


def test_repeats(spark, texts):
    rows = queries.op3_substring_dedup(spark, SF_DIR).collect()
    found = {r["doc_id"]: r for r in rows}
    assert set(found) == set(texts)
    for doc, r in found.items():
        left, at = [], 0
        for start, end in r["removed"]:
            left.append(texts[doc][at:start])
            at = end
        assert r["text"] == "".join([*left, texts[doc][at:]])
        words = len(WORD.findall(texts[doc])) - len(WORD.findall(r["text"]))
        assert r["removed_words"] == words
    # of every run of 50 words that two documents share, most is left in one only
    seen = {}
    for doc in sorted(texts):
        words = WORD.findall(texts[doc])
        for i in range(0, len(words) - 60):
            run = " ".join(words[i : i + 60])
            if run in seen and seen[run] != doc:
                assert run not in " ".join(WORD.findall(found[doc]["text"])) or (
                    run not in " ".join(WORD.findall(found[seen[run]]["text"]))
                )
            seen.setdefault(run, doc)
    # a text none of whose ten-word windows is anywhere else is left alone
    windows = defaultdict(set)
    many = Counter()
    for doc, text in texts.items():
        words = WORD.findall(text)
        for i in range(len(words) - 3):
            windows[tuple(words[i : i + 3])].add(doc)
            many[doc, tuple(words[i : i + 3])] += 1
    for doc, text in texts.items():
        words = WORD.findall(text)
        if all(
            len(windows[tuple(words[i : i + 3])]) == 1 and many[doc, tuple(words[i : i + 3])] == 1
            for i in range(len(words) - 3)
        ):
            assert found[doc]["text"] == text


def test_pipeline_stages(spark, documents):
    """Every stage against a plain version, over what its predecessor kept."""
    stages = corpus_pipeline.STAGES
    assert [n for n, _ in stages] == [
        "quality rules", "near-duplicate removal", "substring removal", "mixing", "packing",
    ]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    kept = stages[0][1](spark, docs, SF_DIR).toPandas()
    judged = {r["doc_id"]: r["kept"] for r in queries.op2_quality_rules(spark, SF_DIR).collect()}
    assert list(kept.columns) == columns
    assert sorted(kept["doc_id"]) == sorted(k for k, v in judged.items() if v)
    assert {tuple(r) for r in kept.itertuples(index=False)} <= set(documents)

    docs = spark.createDataFrame(kept, docs.schema).repartition(4)
    unique = stages[1][1](spark, docs, SF_DIR).toPandas()
    shingles = {r.doc_id: shingle_set(r.text) for r in kept.itertuples()}
    groups = components(shingles, alike)
    assert list(unique.columns) == columns
    stays = set(unique["doc_id"])
    assert len(stays) == len(unique) and stays >= set(groups.values())
    assert len(stays - set(groups.values())) <= 0.1 * (len(groups) - len(set(groups.values())))

    docs = spark.createDataFrame(unique, docs.schema)
    cut = stages[2][1](spark, docs, SF_DIR).toPandas()
    assert list(cut.columns) == columns
    assert set(cut["doc_id"]) <= set(unique["doc_id"])
    assert all(len(r.text) == r.n_chars for r in cut.itertuples())

    docs = spark.createDataFrame(cut, docs.schema)
    mixed = stages[3][1](spark, docs, SF_DIR).toPandas()
    assert list(mixed.columns) == columns
    sizes = {r.doc_id: (r.source, len(WORD.findall(r.text))) for r in cut.itertuples()}
    per_source, largest = Counter(), Counter()
    for source, n in sizes.values():
        per_source[source] += n
        largest[source] = max(largest[source], n)
    targets = plain_targets(per_source)
    taken = Counter()
    for doc in mixed["doc_id"]:
        taken[sizes[doc][0]] += sizes[doc][1]
    for source, target in targets.items():
        assert abs(taken[source] - target) <= 2 * largest[source]
    assert max(Counter(mixed["doc_id"]).values()) <= 2

    docs = spark.createDataFrame(mixed, docs.schema)
    packed = stages[4][1](spark, docs, SF_DIR).toPandas()
    assert all(len(r.ids) == r.length and crc(r.ids) == r.ids_crc32 for r in packed.itertuples())
    length = Counter()
    for r in packed.itertuples():
        length[r.doc_id] += r.length
    times = Counter(mixed["doc_id"])
    texts = dict(zip(cut["doc_id"], cut["text"]))
    assert length == {d: n * len(ids(queries.WORD_BPE, texts[d], 1)) for d, n in times.items()}
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096


def test_near_duplicate_recall(spark):
    """Documents and copies of them with a few words changed: of the pairs of
    different texts with a similarity of 0.8 or more nine of ten lose one, in
    the upper and in the lower half of that range; no text goes that is below
    0.8 to all others."""
    path = "/root/testdata/sf0.01/documents.parquet"
    texts = [
        t for t, in duckdb.sql(
            f"SELECT DISTINCT text FROM '{path}' WHERE length(text) BETWEEN 300 AND 9000 ORDER BY text"
        ).fetchall()
    ]
    chosen, rows = random.Random(8), []
    for n, text in enumerate(texts):
        rows.append(text)
        words = WORD.findall(text)
        many = chosen.randint(1, max(1, len(words) // 45))
        for at in chosen.sample(range(len(words)), many):
            words[at] = chosen.choice(texts[n - 1].split())
        rows.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string").repartition(4)
    kept = {r["doc_id"] for r in corpus_pipeline.near_dedup_stage(spark, docs, "").collect()}
    sets = [shingle_set(t) for t in rows]
    # sets of similarity 0.8 share one of the rarest fifth of their shingles
    often = Counter(s for found in sets for s in found)
    holders, pairs = defaultdict(list), set()
    for doc, found in enumerate(sets):
        rare = sorted(found, key=lambda s: (often[s], s))[: len(found) // 5 + 1]
        pairs |= {(o, doc) for o in {o for s in rare for o in holders[s]} if alike(found, sets[o])}
        for s in rare:
            holders[s].append(doc)
    linked = {doc for pair in pairs for doc in pair}
    assert set(range(len(rows))) - kept <= linked
    for low, high in ((0.8, 0.9), (0.9, 1.01)):
        some = [(a, b) for a, b in pairs if low <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < high]
        caught = sum(not {a, b} <= kept for a, b in some)
        assert len(some) > 100 and caught >= 0.9 * len(some)


def plain_targets(per_source, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(per_source, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    amount, fixed = share * sum(per_source.values()), {}
    while True:
        free = [s for s in names if s not in fixed]
        if not free:
            return fixed
        left = amount - sum(fixed.values())
        part = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if part[s] > most * per_source[s]]
        if not over:
            return fixed | part
        fixed |= {s: most * per_source[s] for s in over}


def test_mix_query(spark, documents):
    rows = queries.op10_mixing(spark, SF_DIR).collect()
    sizes = {r[0]: (r[3], len(WORD.findall(r[1] or ""))) for r in documents}
    per_source, taken = Counter(), Counter()
    for source, n in sizes.values():
        per_source[source] += n
    targets = plain_targets(per_source)
    for r in rows:
        source, n = sizes[r["doc_id"]]
        assert r["size"] == n and r["source_size"] == per_source[source]
        assert r["target"] == pytest.approx(targets[source])
        assert r["taken"] in (0, n, 2 * n)
        taken[source] += r["taken"]
    assert len(rows) == len(sizes)
    for source, target in targets.items():
        largest = max(n for s, n in sizes.values() if s == source)
        assert abs(taken[source] - target) <= 2 * largest
    again = queries.op10_mixing(spark, SF_DIR)
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again.collect()))


def test_mixing_plan_is_native(spark):
    plan = queries.op10_mixing(spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_top_k_ranks_every_query(spark):
    rows = queries.op8_exact_top_k(spark, SF_DIR).groupBy("query_id").agg(
        F.sort_array(F.collect_list("rank")).alias("ranks")
    )
    asked = duckdb.sql(
        f"SELECT vec_id FROM '{SF_DIR}/embeddings.parquet' WHERE vec_id % 100 = 0"
    ).fetchall()
    assert {(r["query_id"], tuple(r["ranks"])) for r in rows.collect()} == {
        (q, tuple(range(1, 11))) for (q,) in asked
    }
