"""Window packing, conversation repair and tokenizer alignment against plain versions."""

from __future__ import annotations

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
import sentencepiece
from public_tokenizers import path as tokenizer_path
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from labelflow.llm import alignment, conversations, pieces, queries, window_packing

SF_DIR = "/root/testdata/sf0.001"
ODD = [
    None, "", " ", "a", "  two  spaces ", "line\nends\n\n here \n", "\ttab\x0bmore\x0c",
    "<|endoftext|> inside <|endoftext|>text", "naïve café é́ ﬁn", "中文 字 符", "a　b  c  d",
    "emoji 👩‍👩‍👧 ️ x", "▁ under ▁▁", "<0x41> <unk> </s>", "nul \0 byte", "don't I'll we've 12345 3.14",
    "same", "same", "x" * 3000, "word " * 4000, "﻿ bom ", "a​ b", "don 't\r\n 's",
]


def docs(spark, texts, ids=None):
    rows = [(i if ids is None else ids[i], t, "x", 1) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, key string, part int")


# Window packing


def plain_best_fit(sizes, capacity):
    free = []
    for size in sorted(sizes, reverse=True):
        fitting = [f for f in free if f >= size]
        if fitting:
            free.remove(min(fitting))
        free.append((min(fitting) if fitting else capacity) - size)
    return sorted(free)


def test_best_fit_equals_item_by_item():
    rng = random.Random(1)
    for _ in range(500):
        capacity = rng.choice([7, 16, 50, 64])
        some = [rng.randint(1, capacity) for _ in range(3)] + [1, capacity // 2 + 1]
        sizes = [rng.choice([rng.randint(1, capacity), *some]) for _ in range(rng.randint(0, 60))]
        _, windows, used = window_packing.best_fit(list(Counter(sizes).items()), capacity)
        free = [c for c, runs in enumerate(windows.runs) for _, n in runs for _ in range(n)]
        assert sorted(free) == plain_best_fit(sizes, capacity) and used == len(free)


def test_number_of_moves_has_a_bound():
    rng = random.Random(2)
    counts = [(s, rng.choice([1, 7, 10**6, 10**9])) for s in range(1, 2049)]
    moves, _, _ = window_packing.best_fit(counts, 2048)
    assert len(moves) < 11 * 3 * 2048


def check_windows(rows, texts, end, capacity, tokenizer):
    """Each id in one piece, sequences without gaps; returns the padding."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(by_doc) == set(range(len(texts)))
    for i, text in enumerate(texts):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [end]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            raw = np.array(ids[at : at + r["length"]], "<u4").tobytes()
            assert r["ids_crc32"] == zlib.crc32(raw)
            if "ids" in r:
                assert list(r["ids"]) == ids[at : at + r["length"]]
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for parts in by_sequence.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
        padding += capacity - at if at & (at - 1) else 0
    return padding


@pytest.mark.parametrize("capacity", [16, 2048])
def test_windows(spark, capacity):
    path = tokenizer_path("byte_bpe_50k.json")
    df = docs(spark, ODD).repartition(3)
    packed = window_packing.pack_windows(df, "doc_id", "text", path, 1, capacity, with_ids=True)
    rows = [r.asDict() for r in packed.withColumnRenamed("key", "doc_id").collect()]
    padding = check_windows(rows, ODD, 1, capacity, Tokenizer.from_file(path))
    assert padding <= capacity * window_packing.SLACK * len({r["sequence_id"] for r in rows})


def test_windows_of_an_empty_table_and_of_null_keys(spark):
    path = tokenizer_path("byte_bpe_50k.json")
    df = docs(spark, ["a b", "a b", None], [None, None, 7])
    assert window_packing.pack_windows(df.limit(0), "doc_id", "text", path, 1, 16).count() == 0
    rows = window_packing.pack_windows(df, "doc_id", "text", path, 1, 16).collect()
    assert sorted((r["doc_tokens"] for r in rows)) in ([1, 3, 3], [1, 3, 3, 3])
    assert sum(r["length"] for r in rows) == 7


def test_equal_lengths_over_half_a_window_leave_no_padding(spark):
    """Best fit alone would leave almost half of each window empty."""
    path = tokenizer_path("byte_bpe_50k.json")
    texts = ["word " * 1099] * 40  # with the blank at the end and the end id 1101
    packed = window_packing.pack_windows(docs(spark, texts), "doc_id", "text", path, 1, 2048)
    rows = [r.asDict() for r in packed.withColumnRenamed("key", "doc_id").collect()]
    assert check_windows(rows, texts, 1, 2048, Tokenizer.from_file(path)) == 0
    assert len({r["sequence_id"] for r in rows}) <= 40 * 1101 // 2048 + 11


def test_window_query(spark):
    texts = duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    rows = [r.asDict() for r in queries.op11_window_packing(spark, SF_DIR).collect()]
    first = min(r["doc_id"] for r in rows)
    rows = [r | {"doc_id": r["doc_id"] - first} for r in rows]
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    padding = check_windows(rows, [t[0] for t in texts], 1, 2048, tokenizer)
    assert padding <= 0.01 * sum(r["length"] for r in rows)


# Pieces


@pytest.mark.parametrize("limit", [64, 1 << 20])
def test_pieces_equal_the_library(limit):
    import pyarrow as pa

    rng = random.Random(3)
    alphabet = "ab cé 中\n\t  .'<|x▁ 　́👩0"
    texts = [t or "" for t in ODD] + ["".join(rng.choices(alphabet, k=rng.randint(0, 90))) for _ in range(800)]
    spaced = [f" {t}" for t in texts]
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    json_file = pieces.Encoder(tokenizer_path("byte_bpe_50k.json"))
    model_file = pieces.Encoder(tokenizer_path("piece_bpe_32k.model"), drop=1)
    assert json_file.safe and model_file.safe
    for encoder, given, want, patterned in (
        (json_file, texts, [library.encode(t, add_special_tokens=False).ids for t in texts], True),
        (model_file, spaced, [model.encode(t) for t in texts], False),
    ):
        some, owner = pieces.blocks(pa.array(given), limit, patterned)
        assert (len(some) > len(given)) == (limit == 64)
        ids, bounds = encoder.encode(*pieces.split(some, True, patterned))
        got = [[] for _ in given]
        for i, b, e in zip(owner, bounds, bounds[1:]):
            got[i] += ids[b:e].tolist()
        assert got == want
    assert not pieces.Encoder(tokenizer_path("word_bpe_49k.json")).safe


# Tokenizer alignment


def plain_alignment(texts):
    a = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    back = pieces.byte_decoder()
    links, groups, sizes = [], [], []
    for text in texts:
        whole = f" {text}".encode()
        ids_a = a.encode(f" {text}", add_special_tokens=False).ids if text else []
        ids_b = b.encode(text) if text else []
        bytes_a = [bytes(back[c] for c in a.id_to_token(i)) for i in ids_a]
        bytes_b = []
        for i in ids_b:
            piece = b.id_to_piece(i)
            one = re.fullmatch("<0x(..)>", piece)
            bytes_b.append(bytes([int(one[1], 16)]) if one else piece.replace("▁", " ").encode())
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            ids_a, ids_b, bytes_a, bytes_b = [], [], [], []
        ends_a = list(itertools.accumulate(map(len, bytes_a)))
        ends_b = list(itertools.accumulate(map(len, bytes_b)))
        both = sorted(set(ends_a) & set(ends_b))
        made = []
        for low, high in zip([0, *both], both):
            made.append(
                ",".join(str(i) for i, e in zip(ids_a, ends_a) if low < e <= high) + "|"
                + ",".join(str(i) for i, e in zip(ids_b, ends_b) if low < e <= high)
            )
        groups.append(made)
        links.append([
            (x, y)
            for x, s, e in zip(ids_a, [0, *ends_a], ends_a)
            for y, t, f in zip(ids_b, [0, *ends_b], ends_b)
            if max(s, t) < min(e, f)
        ])
        sizes.append((len(ids_a), len(ids_b)))
    counts = Counter(p for found in links for p in found)
    most = defaultdict(int)
    for (_, y), n in counts.items():
        most[y] = max(most[y], n)
    return [
        (
            *size, len(made), len(found), sum(counts[p] == most[p[1]] for p in found),
            sum(counts[p] for p in found),
            hashlib.sha256(";".join(made).encode()).hexdigest() if made else "",
        )
        for size, made, found in zip(sizes, groups, links)
    ]


@pytest.mark.parametrize("pairs, block", [(500_000, 2 << 20), (0, 100)])
def test_alignment(spark, monkeypatch, pairs, block):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", pairs)
    monkeypatch.setattr(alignment, "TEXT_BYTES", block)
    texts = [t[:1500] if t else t for t in ODD] + duckdb.sql(
        f"SELECT text[:600] AS t FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id LIMIT 60"
    ).fetchnumpy()["t"].tolist()
    found = alignment.align(
        docs(spark, texts).withColumn("digest", F.lit(1)), "doc_id", "text",
        tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"),
    ).orderBy("key").collect()
    assert [tuple(r)[1:] for r in found] == plain_alignment(texts)


def test_alignment_of_an_empty_table(spark):
    paths = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    assert alignment.align(docs(spark, []), "doc_id", "text", *paths).count() == 0
    rows = alignment.align(docs(spark, [None, "", None], [None, None, 1]), "doc_id", "text", *paths)
    assert [tuple(r)[1:] for r in rows.collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_alignment_query(spark):
    texts = duckdb.sql(f"SELECT text FROM '{SF_DIR}/documents.parquet' ORDER BY doc_id").fetchall()
    rows = queries.op13_tokenizer_alignment(spark, SF_DIR).orderBy("doc_id").collect()
    assert len(rows) == len(texts)
    model = sentencepiece.SentencePieceProcessor(model_file=tokenizer_path("piece_bpe_32k.model"))
    for r, (text,) in zip(rows, texts):
        if r["n_b"]:
            assert r["n_b"] == len(model.encode(text))
            assert r["n_links"] == r["n_a"] + r["n_b"] - r["n_groups"]


# Conversation repair

GOOD = re.compile("(s?(ua)+)?")


def faults(rows):
    out, seen = [], set()
    for role, text in rows:
        stripped = text.rstrip(conversations.SPACE)
        out.append(
            "blank" if not stripped else "duplicate" if (role, text) in seen
            else "truncated" if stripped[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Dynamic programming over (rows used, role initials so far in short) with whole strings."""
    marks = faults(rows)
    start = {"": (0, "", ())}

    def inserted(cells):
        for _ in range(3):
            for state, (cost, audit, out) in list(cells.items()):
                for role in ("user", "assistant"):
                    offer(cells, state, role[0], cost + 2, audit + "I", out + (f"{role}:",))
        return cells

    def offer(cells, state, initial, cost, audit, out):
        to = {"u": "u", "a": "a", "s": "s"}.get(initial)
        if to and (state, to) in {("", "s"), ("", "u"), ("s", "u"), ("u", "a"), ("a", "u")}:
            keep(cells, to, (cost, audit, out))

    def keep(cells, state, value):
        if state not in cells or value[:2] < cells[state][:2]:
            cells[state] = value

    cells = inserted(dict(start))
    for (role, text), mark in zip(rows, marks):
        new: dict = {}
        more = mark == "truncated"
        for state, (cost, audit, out) in cells.items():
            keep(new, state, (cost + 3, audit + "D", out))
            if mark in ("", "truncated"):
                offer(new, state, role[:1], cost + more, audit + "K", out + (f"{role}:{text}",))
                for to in ("user", "assistant"):
                    offer(new, state, to[0], cost + 2 + more, audit + "R", out + (f"{to}:{text}",))
        cells = inserted(new)
    return min(cells[s] for s in ("", "a") if s in cells), marks


def all_repairs(rows):
    """Every way with at most three insertions, tried out."""
    marks = faults(rows)
    best = None

    def go(i, cost, audit, initials, left):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and GOOD.fullmatch(initials):
            best = min(best, (cost, audit)) if best else (cost, audit)
        if left:
            for x in "ua":
                go(i, cost + 2, audit + "I", initials + x, left - 1)
            if i == len(rows):
                return
        if i < len(rows):
            go2(i, cost, audit, initials, left)

    def go2(i, cost, audit, initials, left):
        go(i + 1, cost + 3, audit + "D", initials, left)
        if marks[i] not in ("blank", "duplicate"):
            more = marks[i] == "truncated"
            if rows[i][0][:1] in ("s", "u", "a"):
                go(i + 1, cost + more, audit + "K", initials + rows[i][0][:1], left)
            for x in "ua":
                go(i + 1, cost + 2 + more, audit + "R", initials + x, left)

    go(0, 0, "", "", 3)
    return best


def random_rows(rng, n):
    roles = ["system", "user", "assistant", "user", "assistant", "tool", " ", ""]
    return [(rng.choice(roles), rng.choice(["", " ", "Yes.", "No", "Why?", "x y", "z!"])) for _ in range(n)]


def test_solve_equals_plain_and_exhaustive():
    rng = random.Random(4)
    for case in range(600):
        rows = random_rows(rng, rng.randint(0, 4 if case < 300 else 30))
        (cost, audit, out), marks = plain_repair(rows)
        if len(rows) <= 4:
            assert all_repairs(rows) == (cost, audit), rows
        given = [(r[:1], m in ("blank", "duplicate"), m == "truncated") for (r, _), m in zip(rows, marks)]
        _, found = conversations.best_end(conversations.solve(given, 0))
        assert found == (cost, audit), rows
        roles, texts = conversations.apply_edits(audit, 0, *map(list, zip(*rows or [("", "")])))
        assert tuple(f"{r}:{t}" for r, t in zip(roles, texts)) == out


def test_equal_hashes_are_verified(monkeypatch):
    """With a hash that is always zero the answers stay the same."""
    monkeypatch.setattr(conversations, "_PRIME", 1)
    test_solve_equals_plain_and_exhaustive()


def plain_report(rows):
    """rows: (turn, role, text) in order."""
    (cost, audit, out), marks = plain_repair([r[1:] for r in rows])
    turns = [t for t, _, _ in rows if t is not None]
    count = Counter(marks)
    initials = [r[1][:1] for r in rows]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        count["blank"], count["duplicate"], count["truncated"],
        sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:])),
        cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest(),
    )


def in_order(rows):
    return sorted(
        rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest())
    )


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_repair_in_blocks(spark, monkeypatch, block_rows):
    monkeypatch.setattr(conversations, "BLOCK_ROWS", block_rows)
    rng = random.Random(5)
    rows = []
    for conv, n in [(None, 9), (1, 0), (2, 1), (3, 300), *((k, rng.randint(1, 9)) for k in range(4, 60))]:
        rows.append((conv, 1, "user", "lost.", True))
        for role, text in random_rows(rng, n):
            turn = rng.choice([None, rng.randint(0, 2 * n)])
            rows += [(conv, turn, role or None, text or None, False)] * rng.choice([1, 1, 1, 2])
    df = spark.createDataFrame(rows, "conv long, turn int, part string, block string, audit boolean")
    blocks = conversations.repair(df.repartition(7), "conv", "turn", "part", "block", F.col("audit"))
    got = {r["key"]: tuple(r)[1:] for r in conversations.reports(blocks).collect()}
    by_key = defaultdict(list)
    for conv, turn, role, text, gone in rows:
        mine = by_key[conv]
        if not gone:
            mine.append((turn, " " if role is None else role, " " if text is None else text))
    assert got == {k: plain_report(in_order(v)) for k, v in by_key.items()}
    turns = conversations.repaired_turns(blocks).where("key = 3").orderBy("part", "block", "place").collect()
    lines = "\n".join(f"{r['role']}:{r['text']}" for r in turns)
    assert hashlib.sha256(lines.encode()).hexdigest() == got[3][-1]


def test_repair_of_an_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert conversations.reports(conversations.repair(df, "conv_id", "turn", "role", "text")).count() == 0


def test_a_long_conversation_is_split(spark):
    rows = spark.range(40_000).selectExpr(
        "7L AS k", "id AS t", "if(id % 2 = 0, 'user', 'assistant') AS r", "concat('Text ', id, '.') AS x"
    )
    blocks = conversations.repair(rows, "k", "t", "r", "x")
    assert blocks.count() >= 10 and blocks.select(F.max(F.size("texts"))).first()[0] <= 4096
    (report,) = conversations.reports(blocks).collect()
    assert (report["cost"], report["audit"]) == (0, "K" * 40_000)


def test_repair_query(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF_DIR}/conversations.parquet'").fetchall()
    by_key = defaultdict(list)
    for conv, turn, role, text in rows:
        mine = by_key[conv]
        fate = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        if fate != 0:
            mine += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    got = {r["conv_id"]: tuple(r)[1:] for r in queries.op12_conversation_repair(spark, SF_DIR).collect()}
    assert got == {k: plain_report(in_order(v)) for k, v in by_key.items()}


def test_links_that_a_tree_left_out_are_tried(spark, monkeypatch):
    """Six pairs of similar texts that all fall into one bucket at one distance."""
    from labelflow.llm import similar

    prints, none = similar._prints, F.lit(0).cast("long")
    monkeypatch.setattr(
        similar, "_prints", lambda texts, size: prints(texts, size).withColumns({"fp": none, "also": none})
    )
    rows = []
    for k in range(6):
        text = " ".join(f"w{k}x{i}" for i in range(60))
        rows += [(2 * k, text), (2 * k + 1, text + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = similar.keep_dissimilar(docs, 5, 0.8, 6, 19)
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 4, 6, 8, 10]


def test_near_texts_that_are_not_similar_are_not_paired_as_rows(spark, monkeypatch):
    """Eighty texts and copies with a word more, all in one bucket: pairs that are
    only tried are no rows, and no pair of similar texts is lost."""
    from labelflow.llm import similar

    prints, none = similar._prints, F.lit(0).cast("long")
    monkeypatch.setattr(
        similar, "_prints", lambda texts, size: prints(texts, size).withColumns({"fp": none, "also": none})
    )
    verified, tried = similar._verified, []

    def counted(pairs, *rest):
        tried.append(pairs.count())
        return verified(pairs, *rest)

    monkeypatch.setattr(similar, "_verified", counted)
    rows = [(-1, None), (-2, "")]
    for k in range(80):
        text = " ".join(f"w{k}x{i}" for i in range(30))
        rows += [(2 * k, text), (2 * k + 1, text + " end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = similar.keep_dissimilar(docs, 5, 0.8, 6, 19)
    assert sorted(r["doc_id"] for r in kept.collect()) == [-2, *range(0, 160, 2)]
    assert sum(tried) < 2 * len(rows)


def test_links_between_groups_connect_what_all_pairs_connect():
    """Against all pairs, with one block and with two; the first bit counts as any other."""
    from labelflow.llm import similar

    chosen = random.Random(23)
    for blocks in (1, 2):
        for _ in range(40):
            n = chosen.randint(0, 25)
            bits = [chosen.getrandbits(3) << 61 | chosen.getrandbits(2) for _ in range(n)]
            fp = np.array(bits, np.uint64).view(np.int64)
            also = np.array([chosen.getrandbits(2) << 62 for _ in range(n)], np.uint64).view(np.int64)
            group = np.array([chosen.randrange(-9, 9) for _ in range(n)], np.int64)
            own = np.array([chosen.randrange(blocks) for _ in range(n)], np.int64)
            sets = [np.unique(np.array(chosen.choices(range(8), k=6), np.uint64)) for _ in range(n)]
            found = similar.links_between(fp, also, group, own, sets, 2, 1, 0.7)

            def holds(a, b):
                x, y = set(sets[a].tolist()), set(sets[b].tolist())
                apart = ((int(also[a]) ^ int(also[b])) & 2**64 - 1).bit_count()
                near = (bits[a] ^ bits[b]).bit_count() <= 2 and apart <= 1
                two = len(set(own.tolist())) > 1
                return near and (own[a] != own[b] or not two) and len(x & y) >= 0.7 * len(x | y)

            def groups(links):
                label = {g: g for g in group.tolist()}
                for a, b in links:
                    x, y = label[int(group[a])], label[int(group[b])]
                    label = {g: x if c == y else c for g, c in label.items()}
                return sorted(tuple(sorted(g for g in label if label[g] == c)) for c in set(label.values()))

            assert all(holds(a, b) and group[a] != group[b] for a, b in found)
            assert groups(found) == groups([(a, b) for a in range(n) for b in range(a) if holds(a, b)])
            assert len(found) < max(1, len(set(group.tolist())))
