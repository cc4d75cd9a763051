"""Exact copies, tokens, token files, packing, fingerprints."""

import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import check
from fleetgauge.llm import exact_dedup, fingerprints, packing, queries, token_files
from fleetgauge.llm.common import Scratch
from fleetgauge.llm.tokens import ChunkEncoder
from tests.conftest import SMALL
from tests.llm.helpers import ROWS, none, odd, text_of

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")


def ids_of(path, text):
    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True
    return tokenizer.encode(text, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=30))
def test_trie_holds_what_was_inserted(keys):
    trie = exact_dedup.PatriciaTrie()
    for key in keys:
        node = trie.terminal(key)
        node.value = (node.value or 0) + 1
    assert trie.bytes >= 0
    assert list(trie.take_all()) == [(k, keys.count(k)) for k in sorted(set(keys))] and trie.bytes == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=12).map(lambda b: bytes(x % 3 for x in b)), max_size=30, unique=True))
def test_trie_frees_what_lies_left_of_the_path(keys):
    trie, out = exact_dedup.PatriciaTrie(), []
    for key in sorted(keys):
        trie.terminal(key)
        out += trie.take_before(key)
        trie.terminal(key).value = True
        assert trie.bytes <= 2 * len(key) + 24
    assert [k for k, _ in [*out, *trie.take_all()]] == sorted(keys)


def test_exact_dedup_matches_sql(spark):
    assert check.compare(queries.QUERIES["op1_exact_dedup"](spark, SMALL), check.connect(SMALL).sql(
        queries.ORACLES["op1_exact_dedup"])) == []


def test_exact_dedup_of_odd_rows_with_spilling(spark):
    for keep, best in (("largest", max), ("smallest", min)):
        rows = exact_dedup.exact_groups(odd(spark), keep=keep, combine_bytes=50).collect()
        assert len(rows) == len(ROWS)
        groups = {}
        for r in ROWS:
            groups.setdefault((r[1] or "").encode().lower(), []).append(r[0])
        want = {hashlib.sha256(k).hexdigest(): v for k, v in groups.items()}
        for sha, ids in want.items():
            mine = [r for r in rows if r["text_sha256"] == sha]
            assert sorted(str(r["doc_id"]) for r in mine) == sorted(map(str, ids))
            assert {r["keep_id"] for r in mine} == {best(i for i in ids if i is not None)}
            assert {r["group_size"] for r in mine} == {len(ids)} and sum(r["kept"] for r in mine) == 1
    assert exact_dedup.exact_groups(none(spark)).count() == 0


def test_pieces_give_the_ids_of_the_whole_text():
    rng = random.Random(3)
    marks = ["a", "B", "'s", " ", "  ", "\n", "\t", "é", "é", "1", "$", "\x1c", "ß", "İ", "Σ", "<|endoftext|>", "\x85", "漢", "\r", "Ab", "-", "''",
             "'ll", "%%", "42", "\x00", "\x7f", "|", "\u0301", "\u200d"]
    texts = ["".join(rng.choice(marks) for _ in range(rng.randint(0, 12))) for _ in range(3000)]
    for path, byte_level in ((BYTE, True), (WORD, False)):
        encoder = ChunkEncoder(path, byte_level, most=100_000)
        got = [x for at in range(0, 3000, 250) for x in encoder.encode(texts[at:at + 250])]
        assert got == encoder._raw(texts)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=70), st.sampled_from(["bit", "byte"]))
def test_planes_round_trip(ids, unit):
    ids = np.array(ids, np.uint32)
    assert (token_files.from_planes(token_files.to_planes(ids, unit), len(ids)) == ids).all()


def test_token_files_give_every_document_back(spark):
    for unit in ("byte", "bit"):
        scratch = Scratch(spark, "test")
        token_files.write_tokens(odd(spark).filter("doc_id > 0").dropDuplicates(["doc_id"]), scratch, BYTE, block_ids=64, unit=unit)
        start = 0
        for row in token_files.read_documents(spark, scratch.path).orderBy("doc_id").collect():
            ids = ids_of(BYTE, next(r[1] or "" for r in ROWS if r[0] == row["doc_id"])) + [0]
            assert (row["start"], row["n_tokens"], row["ids_crc32"]) == (start, len(ids), crc(ids))
            start += len(ids)
        index = spark.read.parquet(f"{scratch.path}/index")
        assert index.agg(F.sum("n_ids")).first()[0] == start
        scratch.drop()
    assert token_files.read_documents(spark, _written(spark, odd(spark))).count() == len(ROWS)
    assert token_files.read_documents(spark, _written(spark, none(spark))).count() == 0


def _written(spark, docs):
    scratch = Scratch(spark, "test")
    token_files.write_tokens(docs, scratch, BYTE, block_ids=1000)
    return scratch.path


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 60), st.integers(1, 9), max_size=15))
def test_packing_places_every_piece_once(counts):
    runs, made = packing.match_and_fit(counts, 60)
    placed, bins = {}, {}
    for length, first, start, each, offset in runs:
        placed.setdefault(length, []).append(first)
        taken = [r[1] for r in runs if r[0] == length and r[1] > first] + [counts[length]]
        for rank in range(first, min(taken)):
            at = start + (rank - first) // each
            bins.setdefault(at, []).append((offset + (rank - first) % each * length, length))
    assert sorted(bins) == list(range(made))
    for items in bins.values():
        end = 0
        for offset, length in sorted(items):
            assert offset == end
            end += length
        assert end <= 60 and sum(3 * length > 60 for _, length in items) <= 2
    assert sum(map(len, bins.values())) == sum(counts.values())


def test_packing_of_odd_rows(spark):
    rows = packing.pack(odd(spark), WORD, capacity=100).collect()
    for doc_id, text in {(r[0], r[1] or "") for r in ROWS if r[0] not in (None, 8)}:
        ids = ids_of(WORD, text) + [0]
        mine = sorted((r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows if r["doc_id"] == doc_id)
        assert mine == [(i, at, len(ids[at:at + 100]), crc(ids[at:at + 100])) for i, at in enumerate(range(0, len(ids), 100))]
    bins = {}
    for r in rows:
        bins.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for items in bins.values():
        items.sort()
        assert [o for o, _ in items] == [sum(n for _, n in items[:i]) for i in range(len(items))]
        assert sum(n for _, n in items) <= 100
    assert packing.pack(none(spark), WORD).count() == 0


def test_fingerprints_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").orderBy(F.desc("doc_id")).collect()
    found = {r["doc_id"]: r for r in queries.QUERIES["op6_fingerprints"](spark, SMALL).collect()}
    assert len(found) == len(docs)
    for row, after in zip(docs, [*docs[1:], docs[0]], strict=True):
        text, n = text_of(row), len(text_of(row))
        edited = text[:n - n // 2] + text_of(after)[:n // 2]
        got = found[row["doc_id"]]
        assert (got["n_chars"], got["edited_sha256"]) == (n, hashlib.sha256(edited.encode()).hexdigest())
        sections = [s for s in _parts(text, "\n\n")]
        hashes = [hashlib.sha256("".join(hashlib.sha256(p.encode()).hexdigest() for p in _parts(s, "\n")).encode()).hexdigest()
                  for s in sections]
        assert got["fingerprint"] == hashlib.sha256("".join(hashes).encode()).hexdigest()
        assert (got["fingerprint"] == got["edited_fingerprint"]) == (text == edited)
        assert 0 <= got["near_edited"] <= 1 and 0 <= got["near_next"] <= 1
    assert sum(r["near_edited"] for r in found.values()) > 0.3 * len(found)


def _parts(text, end):
    """The text cut behind every place where ``end`` ends."""
    cuts = [0, *(i for i in range(1, len(text) + 1) if text[:i].endswith(end)), len(text)]
    if text.endswith(end) or not text:
        return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False)]
    return [text[a:b] for a, b in zip(cuts, cuts[1:], strict=False) if a < b]


def _spans(text):
    out = set()
    for paragraph in (p for s in _parts(text, "\n\n") for p in _parts(s, "\n")):
        units = []
        for word in re.findall(r"[^ \t\n\x0b\f\r]+[ \t\n\x0b\f\r]*|[ \t\n\x0b\f\r]+", paragraph):
            body = word.rstrip(" \t\n\x0b\f\r")
            cut = [word] if len(body) <= 16 else list(body)
            units += [*cut[:-1], cut[-1] + word[len(body):]] if len(body) > 16 else cut
        out |= {tuple(units[i:i + 4]) for i in range(max(len(units) - 3, min(len(units), 1)))}
    return out


def test_likeness_survives_small_edits(spark):
    words, signs = " ".join(f"w{i}" for i in range(400)), "".join(chr(97 + i * i % 26) for i in range(60)) * 5
    pairs = [(words, "new " + words), (signs, signs[:150] + "!" + signs[150:]), (words, words.replace("w200", "x")), ("a b c", "a b"),
             ("", ""), ("", "z"), ("  ", " x"), ("a\n\nb\n", "b\n\n\na\n"), ("one two three four five", "two three four five six"),
             (words, words[::-1]), ("\U0001f600" * 20, "\U0001f600" * 19)]
    frame = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)], "i int, a string, b string")
    trees = frame.select("i", fingerprints.tree(F.col("a")).alias("a"), fingerprints.tree(F.col("b")).alias("b"))
    got = {r["i"]: r["x"] for r in trees.select("i", fingerprints.likeness(F.col("a"), F.col("b")).alias("x")).collect()}
    for i, (a, b) in enumerate(pairs):
        mine, other = _spans(a), _spans(b)
        want = 1.0 if a == b else 2 * len(mine & other) / max(1, len(mine) + len(other))
        assert got[i] == pytest.approx(want), (a, b)
    assert min(got[i] for i in range(3)) > 0.8


def test_fingerprints_of_odd_rows(spark):
    rows = fingerprints.fingerprints(odd(spark)).collect()
    assert len(rows) == len(ROWS) and fingerprints.fingerprints(none(spark)).count() == 0
    assert sorted(r["n_chars"] for r in rows) == sorted(len(x[1] or "") for x in ROWS)
    assert len({r["fingerprint"] for r in rows}) == len({x[1] or "" for x in ROWS})


def test_fingerprints_locate_edits(spark):
    frame = spark.createDataFrame([("a\nb\n\nc\nd", "a\nb\n\nc\nx"), ("a\nb", "a\nb"), ("", "z"), ("a", "a\n\nb")], "a string, b string")
    trees = frame.select(fingerprints.tree(F.col("a")).alias("a"), fingerprints.tree(F.col("b")).alias("b"))
    section, paragraph = fingerprints.first_difference(F.col("a"), F.col("b"))
    assert [tuple(r) for r in trees.select(section, paragraph).collect()] == [(1, 1), (None, None), (0, 0), (0, 0)]


@pytest.mark.parametrize("rows", [ROWS, [], ROWS[:1]])
def test_next_text_wraps_around(spark, rows):
    frame = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string").fillna("", ["text"])
    got = fingerprints.with_next_text(frame).collect()
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    want = [(a[0], a[1] or "", b[1] or "") for a, b in zip(order, [*order[1:], *order[:1]], strict=True)]
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))
