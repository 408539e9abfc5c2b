import hashlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
import xxhash

from llm.conftest import clashing
from panelcast.llm import simhash, substrings
from panelcast.llm.components import connected_components

SPACE = " \t\n\x0b\x0c\r"


def split(text):
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return [w for w in text.split(" ") if w]


def plain_simhash(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    w = split(lower)
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i:i + 4]).encode(), 42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def closure(n, links):
    label = list(range(n))
    for a, b in links:
        x, y = label[a], label[b]
        label = [x if v == y else v for v in label]
    return label


@pytest.mark.parametrize("table", ["odd", "small"])
def test_near_duplicates_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fp = [plain_simhash(t) for _, t in rows]
    label = closure(len(rows), [(i, j) for i, j in combinations(range(len(rows)), 2) if (fp[i] ^ fp[j]).bit_count() <= 4])
    ids = defaultdict(list)
    for (i, _), c in zip(rows, label):
        if i is not None:
            ids[c].append(i)
    want = sorted(map(str, [(i, f"{f:016x}", min(ids[c], default=None)) for (i, _), f, c in zip(rows, fp, label)]))
    got = simhash.near_duplicates(clashing(docs, ["fp", "fingerprint", "component_id", "key"])).collect()
    assert sorted(str(tuple(r)) for r in got) == want


def test_any_four_places_hold_a_triple():
    triples = simhash.place_triples()
    assert len(triples) == 20
    assert all(any(set(t) <= set(four) for t in triples) for four in combinations(range(8), 4))


def test_long_posting_lists_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(simhash, "TILE", 16)
    rng = np.random.default_rng(3)
    fps = set()
    for _ in range(40):
        center = int(rng.integers(0, 2**63))
        for _ in range(12):
            fps.add(center ^ sum(1 << int(b) for b in rng.choice(64, int(rng.integers(0, 5)), replace=False)))
    fps |= {(0xABCDEF << 40) | int(x) for x in rng.integers(0, 2**12, 150)}
    fps = [f - 2**64 if f >= 2**63 else f for f in fps]
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    at = {f: i for i, f in enumerate(fps)}
    got = closure(len(fps), [(at[r.a], at[r.b]) for r in links.collect()])
    want = closure(len(fps), [(i, j) for i, j in combinations(range(len(fps)), 2) if ((fps[i] ^ fps[j]) & (2**64 - 1)).bit_count() <= 4])
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_components_of_paths_and_stars(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (None, 3), (200, 150)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {i: 0 for i in range(41)} | {100 + i: 100 for i in range(30)} | {200: 150, 150: 150}
    assert got == want


def test_no_documents(empty):
    assert simhash.near_duplicates(empty).collect() == []
    assert substrings.without_repeats(empty).collect() == []


def plain_removal(rows, n=50):
    first = {}
    for i, t in rows:
        w = split(t)
        for p in range(len(w) - n + 1):
            if i is not None:
                key = tuple(w[p:p + n])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, t in rows:
        w = split(t)
        gone = set()
        for p in range(len(w) - n + 1):
            if i is not None and first[tuple(w[p:p + n])] < i:
                gone |= set(range(p, p + n))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((i, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("table", ["odd", "small"])
@pytest.mark.parametrize("window", [50, 7])
def test_repeated_windows_equal_brute_force(request, table, window, monkeypatch):
    monkeypatch.setattr(substrings, "STEP_WORDS", 500)
    monkeypatch.setattr(substrings, "FLUSH_WINDOWS", 300)
    docs = request.getfixturevalue(table)
    want = plain_removal([(r.doc_id, r.text) for r in docs.collect()], window)
    out = substrings.without_repeats(clashing(docs, ["n_words", "kept_text", "id", "starts", "half"]), window)
    found = out.collect()
    got = sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found), key=str)
    assert got == want
    assert sorted(str(r.text) for r in found) == sorted(str(r.text) for r in docs.collect())
    assert all(hashlib.sha256(r.kept_text.encode()).hexdigest() == r.kept_sha256 for r in found)
    plain = substrings.without_repeats(docs, window, with_text=False).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, plain), key=str) == want
    assert sum(x[2] for x in want) > 0


@pytest.mark.parametrize("stride", [1, 16, 4096, -4096])
def test_documents_with_a_stride_spread_over_buckets(stride):
    bucket = substrings.bucket_of(np.arange(20_000) * stride, 2048)
    assert len(np.unique(bucket)) > 2040 and np.bincount(bucket).max() < 40
