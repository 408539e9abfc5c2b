import hashlib
import math
import random
from collections import defaultdict
from fractions import Fraction
from itertools import groupby
from zlib import crc32

import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from llm.conftest import clashing
from panelcast.llm import langid, merkle, queries, whitening

# languages

SYLLABLES = {"aa": "ka lo mi tu ren vas pol".split(), "bb": "sch ver ung ein ich keit tz".split(), "cc": "eau oui ment ère ç queux lais".split()}


def speech(lang, rng, n):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def spoken(spark):
    rng = random.Random(3)
    rows = [(i, speech(lang := rng.choice(list(SYLLABLES)), rng, rng.choice([6, 40, 300])), lang, "s", 1) for i in range(300)]
    rows += [(1000 + i, rows[0][1], rows[0][2], "s", 1) for i in range(150)]  # copies
    rows += [(2000, None, "aa", "s", 1), (2001, "", "aa", "s", 1), (2002, "12 ½ ² !!", "bb", "s", 1), (2003, speech("bb", rng, 9), None, "s", 1),
             (None, speech("cc", rng, 9), "cc", "s", 1), (2004, speech("aa", rng, 9000), "aa", None, None), (2005, "x", "dd", "s", 1), (2005, "x", "dd", "s", 1)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(6).cache()


def plain_classes(docs, learnt):
    """Sizes by one compressor call a part, with the dictionaries as the operator learnt them."""
    models = {r.lang: (r.n, zstandard.ZstdCompressionDict(b" ".join(map(bytes, r.pieces)), dict_type=zstandard.DICT_TYPE_RAWCONTENT)) for r in learnt}
    out = []
    for r in docs.collect():
        kept, word = [], ""
        for ch in (r.text or "").lower() + " ":
            if ch.isalpha():
                word += ch
            elif not (word and (ch.isalnum() and not ch.isdecimal())):
                kept += [word] if word else []
                word = ""
        raw = " ".join(w for w, _ in groupby(kept)).encode()
        if not raw:
            out.append((r.doc_id, "und", 0.0, None, True))
            continue
        sizes = {}
        for lang, (n, held) in models.items():
            by = zstandard.ZstdCompressor(level=langid.LEVEL, dict_data=held, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(by.compress(raw[a:a + langid.PART])) for a in range(0, len(raw), langid.PART))
        best = min(sizes, key=lambda k: (sizes[k], -models[k][0], k))
        second = min(v for k, v in sizes.items() if k != best)
        score = 1 / sum(2 ** ((sizes[best] - v) / langid.HALVE) for v in sizes.values())
        out.append((r.doc_id, best, round(score, 9), sizes[best], second - sizes[best] < langid.MARGIN * sizes[best]))
    return sorted(map(str, out))


@pytest.mark.parametrize("at_once", [256, 2])
def test_languages_against_plain_sizes(spoken, at_once):
    docs = clashing(spoken, ["h", "n", "piece", "row", "found", "score", "lang_pred", "share"])
    out = langid.classify(docs, queries.fold() != 0, languages_at_once=at_once)
    learnt = langid.sample(spoken.where(queries.fold() != 0)).collect()
    got = sorted(str((r.doc_id, r.lang_pred, round(r.score, 9), r.encoded_size, r.rejected)) for r in out.collect())
    assert got == plain_classes(spoken, learnt)


def test_languages_right_and_sample_bounded(spoken):
    out = langid.classify(spoken, queries.fold() != 0, rows=20).alias("o").join(spoken.alias("d"), "doc_id")
    rows = [r for r in out.select("doc_id", "o.lang_pred", "d.lang", "text", "rejected").collect() if r.doc_id < 1000]
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)
    learnt = langid.sample(spoken.where(queries.fold() != 0), rows=20).collect()
    assert {r.lang for r in learnt} >= set(SYLLABLES) and all(1 <= len(r.pieces) <= 20 and len(set(map(bytes, r.pieces))) == len(r.pieces) for r in learnt)
    assert all(len(p) <= langid.PIECE for r in learnt for p in r.pieces)
    assert {r.lang: r.n for r in learnt} == {r.lang: r.n for r in spoken.where(queries.fold() != 0).where("lang is not null and text is not null")
                                             .groupBy("lang").agg(F.count("*").alias("n")).collect() if r.lang in {x.lang for x in learnt}}


def test_languages_without_labels_or_rows(spoken, empty):
    assert langid.classify(empty).collect() == []
    none = langid.classify(spoken.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert len(none) == spoken.count() and {(r.lang_pred, r.score, r.rejected) for r in none} == {("und", 0.0, True)}
    one = langid.classify(spoken.where("lang = 'aa'")).collect()
    assert {(r.lang_pred, r.score) for r in one if r.encoded_size} == {("aa", 1.0)}


def test_query_held_out_accuracy(spark, small):
    out = queries.op11_language(spark, "/root/testdata/sf0.01").alias("o").join(queries.documents(spark, "/root/testdata/sf0.01").alias("d"), "doc_id")
    rows = out.select("o.held_out", "o.lang_pred", "d.lang", "d.doc_id").collect()
    assert all(r.held_out == (crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)


# whitening

VEC = "vec_id long, embedding array<float>, label int"


def reference(rows, wanted=4):
    """Dense eigenvectors of the exact covariance of the distinct quantised vectors."""
    good = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v, _ in rows
            if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    width = max((len(x) for _, x in good), default=0)
    good = [(i, x + [0] * (width - len(x))) for i, x in good]
    fit = sorted({tuple(x) for _, x in good})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    x = np.array([[float(Fraction(v * n - s, n)) for v, s in zip(row, sums)] for row in fit])
    values, vectors = np.linalg.eigh(x.T @ x / n)
    values, vectors = values[::-1][:wanted], vectors[:, ::-1][:, :wanted]
    deviation = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for _, row in good]
    own = np.array([[float(Fraction(v * n - s, n)) for v, s in zip(row, sums)] for _, row in good]) @ vectors
    return good, n, deviation, own, values, np.trace(x.T @ x / n)


def check_whitened(spark, rows, components=4, tolerance=1e-9):
    frame = clashing(spark.createDataFrame(rows, VEC).repartition(4), ["code", "block", "place", "n", "component", "whitened"])
    out = whitening.whiten(frame).collect()
    good, n, deviation, own, values, trace = reference(rows)
    found = defaultdict(list)
    for r in out:
        found[r.component].append(r)
        assert r.n == n and r.identity_error < 1e-9 and r.explained == pytest.approx(values[r.component - 1] / trace, rel=1e-9)
    assert sorted(found) == list(range(1, components + 1))
    for c, got in found.items():
        assert sorted((str(r.vec_id), int(r.deviation_digits)) for r in got) == sorted((str(i), d) for (i, _), d in zip(good, deviation))
        assert all(r.deviation == (int(r.deviation_digits) if int(r.deviation_digits) < 2 ** 63 else None) for r in got)
        want = sorted((str(i), d, w) for (i, _), d, w in zip(good, deviation, own[:, c - 1] / np.sqrt(values[c - 1])))
        close = [sorted((str(r.vec_id), int(r.deviation_digits), sign * r.whitened) for r in got) for sign in (1, -1)]
        assert any(np.allclose([x[2] for x in g], [x[2] for x in want], atol=tolerance, rtol=tolerance) for g in close)


def vectors(n, width, seed=1, scales=None):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, width)) * (np.ones(width) if scales is None else scales)
    return [(i, [float(np.float32(c)) for c in v], 0) for i, v in enumerate(x)]


def test_whitening_against_dense_eigenvectors(spark):
    rows = vectors(400, 24, scales=np.linspace(2, 0.5, 24))
    odd = [(500, None, 1), (501, [1.0, None] + [0.0] * 22, 1), (502, [float("nan")] * 24, 1), (503, [float("inf")] + [0.0] * 23, 1),
           (504, [], 1), (505, [0.5, -0.5], 1), (None, rows[0][1], 1), (3, rows[7][1], 1), (3, rows[7][1], 1)]
    check_whitened(spark, rows + odd + [(600 + i, rows[2][1], 2) for i in range(200)])


def test_whitening_close_values_and_few_dimensions(spark):
    check_whitened(spark, vectors(300, 40, seed=2), tolerance=1e-7)
    check_whitened(spark, vectors(50, 2, seed=3), components=2)
    check_whitened(spark, vectors(4, 16, seed=4), components=3)


def test_whitening_large_entries_stay_exact(spark):
    rows = vectors(60, 5, seed=5, scales=[1e13, 3e12, 1e11, 1e10, 5.0])
    frame = whitening.whiten(spark.createDataFrame(rows, VEC)).where("component = 1")
    good, n, deviation, *_ = reference(rows)
    assert sorted((r.vec_id, int(r.deviation_digits)) for r in frame.collect()) == sorted((i, d) for (i, _), d in zip(good, deviation))
    whitening.whiten(spark.createDataFrame([(1, [3e38, 1.0], 0), (2, [-3e38, 2.0], 0), (3, [0.0, 0.0], 0)], VEC)).collect()


def test_whitening_without_spread(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0)], [(1, [1.0, 2.0], 0)], [(i, [1.0, 2.0], 0) for i in range(9)]):
        assert whitening.whiten(spark.createDataFrame(rows, VEC)).collect() == []


def test_filter_finds_a_hidden_spectrum():
    rng = np.random.default_rng(7)
    q = np.linalg.qr(rng.standard_normal((200, 200)))[0]
    values = np.concatenate([[5, 4.9, 4.899, 4.5], np.linspace(4.4, 0, 196)])
    passes = []

    def times(x):
        passes.append(1)
        return q @ (values[:, None] * (q.T @ x))

    got, vecs, worst = whitening.leading(times, 200, 4)
    assert worst < 1e-13 and np.allclose(got, values[:4], rtol=1e-12)
    assert np.allclose(np.abs(np.sum(vecs * q[:, :4], axis=0)), 1, atol=1e-9)
    assert len(passes) < 300


# manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def up(nodes):
    return [h(*nodes[i:i + 2]) for i in range(0, len(nodes), 2)]


def path(nodes, at):
    """(is the other left, other or None) on the way from ``at`` to the root, and the root."""
    out = []
    while len(nodes) > 1:
        run = nodes[at - at % 2:at - at % 2 + 2]
        out.append((at % 2 == 1, run[1 - at % 2] if len(run) == 2 else None))
        nodes, at = up(nodes), at // 2
    return out, nodes[0]


def plain_manifest(rows):
    names = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(r):
        return h("".join("-" if r[k] is None else f"{len(str(r[k]).encode())}:{r[k]}" for k in names))

    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    order = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    leaves = {}
    for lang in order:
        groups[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        leaves[lang] = [leaf(r) for r in groups[lang]]
    subroots = [path(leaves[lang], 0)[1] for lang in order]
    out = []
    for g, lang in enumerate(order):
        beyond, root = path(subroots, g)
        for i, r in enumerate(groups[lang]):
            tampered = r["doc_id"] is not None and r["n_chars"] is not None and crc32(str(r["doc_id"]).encode()) % 7 == 0
            node, whole = leaf({**r, "n_chars": r["n_chars"] + 1} if tampered else r), path(leaves[lang], i)[0] + beyond
            for left, other in whole:
                node = h(node) if other is None else h(other, node) if left else h(node, other)
            out.append(str((r["doc_id"], leaves[lang][i], subroots[g], root, h("".join(o for _, o in whole if o)), node, node == root)))
    return sorted(out)


@pytest.mark.parametrize("height", [10, 2, 1])
@pytest.mark.parametrize("table", ["odd", "small", "empty", "many"])
def test_manifest_against_plain_trees(spark, request, tmp_path, monkeypatch, table, height):
    if table == "many":
        docs = spark.range(700).selectExpr("id * 64 doc_id", "concat('t', id) text", "case when id % 3 = 0 then 'hot' when id % 50 = 7 then null else concat('l', id % 41) end lang",
                                           "'s' source", "case when id % 9 > 0 then id end n_chars")
    else:
        docs = request.getfixturevalue(table)
    if table == "small" and height < 10:
        docs = docs.where("doc_id < 90")
    monkeypatch.setattr(merkle, "HEIGHT", height)
    clashing(docs, ["node", "tree", "place", "size", "leaf", "root", "at", "part"]).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op13_manifest(spark, str(tmp_path)).collect()
    assert sorted(str(tuple(r)) for r in got) == plain_manifest([r.asDict() for r in docs.collect()])
    assert table == "empty" or 0 < sum(r.verified for r in got) < len(got)


def test_manifest_spreads_a_row_that_repeats(spark):
    docs = spark.range(3000).selectExpr("7L doc_id", "'same' text", "'en' lang", "'s' source", "4L n_chars")
    rows = merkle.manifest(docs, ["doc_id", "text"], "lang", "doc_id").select("place", "root", "verified").collect()
    assert sorted(r.place for r in rows) == list(range(3000)) and len({r.root for r in rows}) == 1 and all(r.verified for r in rows)
