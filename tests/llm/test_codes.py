"""Vector codes, importance resampling and SimHash against brute force, and odd inputs of each."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

import check
from fleetgauge.llm import queries, simhash, target_sampling, vector_codes
from fleetgauge.llm.common import Scratch
from tests.conftest import SMALL
from tests.llm.helpers import LONG, ROWS, none, odd


# --- Vector codes --------------------------------------------------------------------------------


@pytest.mark.parametrize("width,bits", [(2, 3), (3, 2), (4, 1), (1, 4)])
def test_neighbours_on_the_curve_are_neighbours_in_space(width, bits):
    cells = np.array(list(product(range(1 << bits), repeat=width)), np.int64)
    place = vector_codes.hilbert_place(cells, bits)
    assert sorted(place) == list(range(len(cells)))
    steps = np.abs(np.diff(cells[np.argsort(place)], axis=0)).sum(1)
    assert (steps == 1).all()


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 4).flatmap(lambda w: st.tuples(
    st.lists(st.lists(st.integers(-9, 9), min_size=w, max_size=w), min_size=1, max_size=8),
    st.lists(st.lists(st.integers(-9, 9), min_size=w, max_size=w), min_size=1, max_size=8))))
def test_shortlists_keep_the_first_nearest_entry(drawn):
    points, book = (np.array(x, np.int64) for x in drawn)
    few = vector_codes.shortlist(points.min(0), points.max(0), book)
    entry, distance = vector_codes.nearest(points, book[few])
    want, least = vector_codes.nearest(points, book)
    assert (few[entry] == want).all() and (distance == least).all()


def brute_codes(rows, parts, entries, rounds):
    kept = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    ids = sorted({i for i, _, _ in kept if i is not None})[:entries]
    first = [min(v for j, v, _ in kept if j == i) for i in ids]
    books = [[v[p * width:(p + 1) * width] for v in first] for p in range(parts)]

    def assign(v):
        out = []
        for p in range(parts):
            at = v[p * width:(p + 1) * width]
            out.append(min((sum((a - b) ** 2 for a, b in zip(at, e, strict=True)), n) for n, e in enumerate(books[p])))
        return out

    for _ in range(rounds):
        groups = {}
        for _, v, _ in kept:
            for p, (_, e) in enumerate(assign(v)):
                groups.setdefault((p, e), []).append(v[p * width:(p + 1) * width])
        for (p, e), members in groups.items():
            books[p][e] = [sum(c) // len(members) for c in zip(*members, strict=True)]
    sha = hashlib.sha256(",".join(str(x) for p in books for e in p for x in e).encode()).hexdigest()
    found = [(i, label, "".join(f"{e:02x}" for _, e in assign(v)), sum(d for d, _ in assign(v))) for i, v, label in kept]
    of_label = Counter()
    for _, label, _, error in found:
        of_label[label] += error
    return Counter((i, label, code, error, of_label[label], sha) for i, label, code, error in found)


VECTORS = "vec_id long, embedding array<float>, label int, row long, part string, size int, entry int, ints int"


def _vectors(spark, rows):
    return spark.createDataFrame([(i, v, label, 1, "x", 2, 3, 4) for i, v, label in rows], VECTORS).repartition(3)


def test_vector_codes_match_sql(spark):
    assert check.compare(queries.QUERIES["op11_vector_codes"](spark, SMALL), check.connect(SMALL).sql(
        queries.ORACLES["op11_vector_codes"])) == []


def test_vector_codes_of_odd_rows_match_brute_force(spark):
    rng = random.Random(5)
    hot = [rng.uniform(-1, 1) for _ in range(6)]
    rows = [(i, [np.float32(rng.gauss(0, 1)).item() for _ in range(6)], rng.choice([None, 1, 2])) for i in range(300)]
    hot = [np.float32(x).item() for x in hot]
    rows += [(1000 + i, hot, 7) for i in range(200)]  # a hot vector and a hot label
    rows += [(3, [0.0] * 6, 1), (3, [0.0] * 6, 1), (None, [0.5] * 6, None), (5000, None, 1), (5001, [float("nan")] * 6, 1),
             (5002, [None] + [0.0] * 5, 1), (5003, [float("inf")] + [0.0] * 5, 2), (-1, [-0.00001] * 6, 2)]
    found = vector_codes.compress(_vectors(spark, rows), parts=3, entries=5, rounds=4)
    got = Counter(tuple(r[c] for c in ("vec_id", "label", "code", "error", "label_error", "codebooks_sha256")) for r in found.collect())
    assert got == brute_codes(rows, 3, 5, 4)


def test_vector_codes_without_rows_ids_or_components(spark):
    assert vector_codes.compress(_vectors(spark, [])).count() == 0
    assert vector_codes.compress(_vectors(spark, [(1, None, 2)])).count() == 0
    unnamed = vector_codes.compress(_vectors(spark, [(None, [1.0, 2.0], 1), (None, [1.0, 2.0], 1)]), parts=2).collect()
    assert [(r["code"], r["error"]) for r in unnamed] == [(None, None)] * 2
    bare = vector_codes.compress(_vectors(spark, [(4, [], 1), (5, [], None)]), parts=2).collect()
    assert {(r["vec_id"], r["code"], r["error"]) for r in bare} == {(4, "0000", 0), (5, "0000", 0)}
    with pytest.raises(ValueError):
        vector_codes.compress(_vectors(spark, [(1, [1.0, 2.0], 1), (2, [1.0], 1)]), parts=1)
    with pytest.raises(Exception, match="a component is beyond"):
        vector_codes.compress(_vectors(spark, [(1, [1e30, 2.0], 1)]), parts=1)


# --- Importance resampling -----------------------------------------------------------------------


def brute_sample(docs, aims, longest, buckets, percent, least, seed):
    def features(text):
        found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return found, [zlib.crc32(" ".join(found[i:i + n]).encode()) % buckets
                       for n in range(1, longest + 1) for i in range(len(found) - n + 1)]

    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(features(text)[1])
    for text in aims:
        t.update(features(text)[1])
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in s}
    rows = []
    for doc_id, text in docs:
        found, own = features(text)
        weight = sum(gain[b] for b in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        rows.append((doc_id, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32))), len(found)))
    order = sorted((r for r in rows if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    drawn = [(*r[:4], n + 1) for n, r in enumerate(order[:len(order) * percent // 100])]
    rest = [(*r[:4], None) for r in order[len(drawn):]] + [(*r[:4], None) for r in rows if r[4] < least]
    return Counter(drawn + rest)


def test_target_sampling_matches_sql(spark):
    assert check.compare(queries.QUERIES["op12_target_sampling"](spark, SMALL), check.connect(SMALL).sql(
        queries.ORACLES["op12_target_sampling"])) == []


@pytest.mark.parametrize("percent,longest", [(10, 1), (60, 2), (100, 1), (0, 1)])
def test_target_sampling_over_many_runs_and_segments(spark, percent, longest):
    rng = random.Random(percent)
    docs = [(rng.choice([None, 7, i, -i]), " ".join(rng.choices(["Ab", "c9", "é", "x-y", "zz"], k=rng.choice([0, 3, 9])))) for i in range(700)]
    docs += [(42, "ab c9 zz same row")] * 400  # a third of all rows are one
    aims = ["ab ab é", None, "zz c9"]
    frame = spark.createDataFrame([(i, t, 1, 2.0, "s") for i, t in docs], "doc_id long, text string, run int, score double, rows string")
    target = spark.createDataFrame([(i, t) for i, t in enumerate(aims)], "item_id long, text string")
    found = target_sampling.resample(frame.repartition(4), target, longest=longest, buckets=50, percent=percent, least_words=3,
                                     seed=9, run_rows=50, stride=4, segment_rows=16).collect()
    assert Counter(map(tuple, found)) == brute_sample(docs, aims, longest, 50, percent, 3, 9)


def test_target_sampling_of_odd_rows(spark):
    target = spark.createDataFrame([(1, None), (2, "plain word1")], "item_id long, text string")
    docs = [(r[0], r[1]) for r in ROWS]
    found = target_sampling.resample(odd(spark), target, least_words=1, percent=50).collect()
    assert Counter(map(tuple, found)) == brute_sample(docs, ["", "plain word1"], 1, 10_000, 50, 1, 2024)
    assert target_sampling.resample(none(spark), target).count() == 0
    untargeted = target_sampling.resample(odd(spark), target.filter("false"), least_words=1, percent=50).collect()
    assert Counter(map(tuple, untargeted)) == brute_sample(docs, [], 1, 10_000, 50, 1, 2024)


def test_keys_sort_as_their_rows_do():
    rows = [(s, i, f, 0) for s in (-5, 0, 9) for i in (-3, 0, 8, None) for f in (0, 2)]
    packed = target_sampling._packed(random.Random(1).sample(rows, len(rows)), 3, 0)
    out = target_sampling._unpacked(target_sampling._ordered(packed), np.zeros(len(rows), np.int64)).to_pylist()
    want = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    assert [(r["score"], r["doc_id"], r["n_features"]) for r in out] == [r[:3] for r in want]


# --- SimHash -------------------------------------------------------------------------------------


def brute_fingerprint(text, width=3, seed=42):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i:i + width]) for i in range(max(1, len(words) - width + 1))] if words else []
    hashes = [xxhash.xxh64(s, seed=seed).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(codes, distance):
    """Smallest id reachable, for (id, code) rows."""
    ids, distinct = {}, sorted({c for i, c in codes if i is not None})
    for i, c in codes:
        if i is not None:
            ids[c] = min(i, ids.get(c, i))
    parent = {c: c for c in distinct}

    def find(c):
        while parent[c] != c:
            c = parent[c]
        return c

    for n, a in enumerate(distinct):
        for b in distinct[n + 1:]:
            if (a ^ b).bit_count() <= distance:
                low, high = sorted((find(a), find(b)), key=lambda c: ids[c])
                parent[high] = low
                ids[low] = min(ids[low], ids[high])
    return {c: ids[find(c)] for c in distinct}


@pytest.mark.parametrize("text", ["", " \t", "a", "A b", "a b c", "One  two\tthree four ONE two three", "é ü 12 . !", LONG])
def test_fingerprints_match_the_definition(text):
    assert simhash.fingerprint(text.encode(), 3, 42) == brute_fingerprint(text)


def test_gray_rank_is_the_place_in_the_gray_sequence():
    ranks = np.arange(1000, dtype=np.uint64)
    assert (simhash.gray_rank(ranks ^ ranks >> np.uint64(1)) == ranks).all()


def test_masks_below_leave_no_close_pair_out():
    rng = random.Random(2)
    for distance in (0, 1, 2, 3):
        for mask in (0, simhash.below(0, distance)[-1]):
            masks, open_bits = simhash.below(mask, distance), [b for b in range(64) if not mask >> b & 1]
            for _ in range(100):
                flipped = sum(1 << b for b in rng.sample(open_bits, min(distance, len(open_bits))))
                assert any(not flipped & m for m in masks)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 3), st.lists(st.tuples(st.integers(0, 3), st.integers(0, 2**12 - 1)), min_size=1, max_size=150, unique=True))
def test_index_finds_exactly_the_close_pairs(distance, rows):
    node, codes = (np.array(x) for x in zip(*rows, strict=True))
    codes = codes.astype(np.uint64) << np.uint64(30)
    index = simhash.GrayIndex(node, codes)
    found = {tuple(sorted((int(index.order[i]), int(index.order[j])))) for a, b in index.pairs(distance) for i, j in zip(a, b, strict=True)}
    want = {(i, j) for i in range(len(rows)) for j in range(i + 1, len(rows))
            if node[i] == node[j] and int(codes[i] ^ codes[j]).bit_count() <= distance}
    assert found == want
    links = index.links(distance)
    assert set(map(tuple, map(sorted, links))) <= {tuple(sorted(x)) for x in _closure(want)} and len(links) == _merges(len(rows), want)


def _groups(n, pairs):
    parent = list(range(n))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in pairs:
        parent[find(a)] = find(b)
    return [find(x) for x in range(n)]


def _merges(n, pairs):
    return n - len(set(_groups(n, pairs)))


def _closure(pairs):
    nodes = {x for p in pairs for x in p}
    at = _groups(max(nodes, default=-1) + 1, pairs)
    return {(a, b) for a in nodes for b in nodes if a < b and at[a] == at[b]}


@pytest.mark.parametrize("most", [100, 4096])
def test_close_codes_with_large_and_hot_nodes(spark, most):
    rng = random.Random(most)
    centre = [rng.getrandbits(64) for _ in range(30)]
    codes = {c ^ sum(1 << b for b in rng.sample(range(64), rng.choice([0, 1, 2, 3]))) for c in centre for _ in range(12)}
    codes |= {centre[0] ^ x for x in rng.sample(range(2**12), 300)}  # many that share most of their bits
    rows = list(enumerate(sorted(codes, key=lambda c: hash((c, 1)))))
    frame = spark.createDataFrame([(int(np.uint64(c).view(np.int64)), i) for i, c in rows], "code long, rep long")
    links = simhash.close_codes(frame, Scratch(spark, "test"), 2, len(rows), most)
    of, want = dict(rows), brute_components(rows, 2)
    at = _groups(len(rows), [(r["a"], r["b"]) for r in links.collect()])
    least = {}
    for i, root in enumerate(at):
        least[root] = min(i, least.get(root, i))
    assert {i: least[at[i]] for i in range(len(rows))} == {i: want[of[i]] for i in range(len(rows))}


def _check_simhash(found, docs):
    prints = [(i, brute_fingerprint(t)) for i, t in docs]
    of = brute_components(prints, 2)
    want = Counter((i, f"{c:016x}", None if i is None else of[c]) for i, c in prints)
    assert Counter((r["doc_id"], r["fingerprint"], r["component_id"]) for r in found.collect()) == want


def test_simhash_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    _check_simhash(queries.QUERIES["op13_simhash"](spark, SMALL), docs)


def test_simhash_of_odd_rows(spark):
    _check_simhash(simhash.near_by_simhash(odd(spark)), [(r[0], r[1]) for r in ROWS])
    assert simhash.near_by_simhash(none(spark)).count() == 0
