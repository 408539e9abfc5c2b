import hashlib
import math
import os
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm.conftest import SF, clashing
from llm.test_simhash_substrings import split
from panelcast.llm import blobs, bloom_lm, cdc, chains, gam, queries
from panelcast.llm.words import WordHash, bounds, mix, unmix, word_hashes, words
from panelcast.sources import staging


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def held(i, n, k):
    return i is not None and zlib.crc32(str(i).encode()) % n == k


@pytest.mark.parametrize("slice_mb", [256, 0])
def test_base_score_equals_brute_force(small, odd, slice_mb, monkeypatch):
    monkeypatch.setattr(bloom_lm, "STEP_TOKENS", 5000)
    monkeypatch.setattr(bloom_lm, "SCORE_TOKENS", 3000)
    for docs in (small, odd):
        docs = clashing(docs, ["n_tokens", "score"]).withColumn("held_out", F.coalesce(queries.fold() == 1, F.lit(False)))
        rows = docs.collect()
        count = Counter(w for r in rows if not held(r.doc_id, 5, 1) for w in [*split(lower(r.text)), None])
        n, v = sum(count.values()), len(count)
        model = bloom_lm.learn(docs.where(~F.col("held_out")), slice_mb=slice_mb)
        want, texts = {}, Counter()
        for r in rows:
            w = [*split(lower(r.text)), None]
            want[r.doc_id, len(w)] = (sum(count[x] > 0 for x in w), sum(math.log10((count[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w))
            texts[r.doc_id, len(w)] += 1
        got = bloom_lm.score(docs, model, ["doc_id", "held_out"]).collect()
        assert Counter((r.doc_id, r.n_tokens) for r in got) == texts
        for r in got:
            known, base = want[r.doc_id, r.n_tokens]
            assert (r.train_tokens, r.n_known, r.held_out) == (n, known, held(r.doc_id, 5, 1))
            assert math.isclose(r.base_score, base, rel_tol=1e-9, abs_tol=1e-9) and r.score < 0


def test_model_leaves_the_executors_when_scores_are_written(spark, small, tmp_path):
    model, told = bloom_lm.learn(small, slice_mb=0), []
    for part in (model.words, *[b for *_, b in model.slices]):
        part.unpersist = lambda blocking=False, f=part.unpersist: (told.append(blocking), f(blocking))
    out = bloom_lm.score(small, model, ["doc_id"])
    assert told == [True] * (1 + len(model.slices))
    again = bloom_lm.score(small, model, ["doc_id"])
    assert out.orderBy("doc_id").collect() == again.orderBy("doc_id").collect()
    files = [part._path for part in (model.words, *[b for *_, b in model.slices])]
    model.destroy()
    assert not any(map(os.path.exists, files)) and out.count() == small.count()
    small.write.parquet(f"{tmp_path}/documents.parquet")
    scored = queries.op2_lm_scoring(spark, str(tmp_path))  # its model is gone, its rows stay
    assert scored.count() == small.count() and scored.where("score is null").count() == 0


def test_slices_do_not_change_scores(small):
    a, b = (bloom_lm.score(small, bloom_lm.learn(small, slice_mb=mb), ["doc_id"]).orderBy("doc_id").collect() for mb in (256, 0))
    assert all(math.isclose(x.score, y.score, rel_tol=1e-9) for x, y in zip(a, b))


def test_nothing_learnt_passes_through_the_driver(spark, small, monkeypatch):
    def no(*a, **b):
        raise AssertionError("the model came to the driver")
    got, frame = [], type(small)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", no)
    monkeypatch.setattr(frame, "toLocalIterator", no)
    monkeypatch.setattr(frame, "collect", lambda self, f=frame.collect: (got.append(rows := f(self)), rows)[1])
    before = spark.conf.get(staging.CLEANUP, None)
    model = bloom_lm.learn(small)
    out = bloom_lm.score(small, model, ["doc_id"])
    model.destroy()
    assert sum(len(str(rows)) for rows in got) < 1000 and spark.conf.get(staging.CLEANUP, None) == before
    assert out.count() == small.count() and out.where("score is null").count() == 0


def test_lots_answer_what_the_whole_model_says(small, odd, monkeypatch):
    monkeypatch.setattr(blobs, "CHUNK_CHARS", 1 << 12)  # many chunks and lots
    monkeypatch.setattr(bloom_lm, "SCORE_TOKENS", 5000)
    docs = small.limit(300).select("doc_id", "text").unionAll(odd.select("doc_id", "text")).cache()
    model = bloom_lm.learn(small, slice_mb=0)
    assert model.contexts.count() > 3
    singles, keys, sums = model.words.value
    parts, low, room = [(lo, hi, b.value) for lo, hi, b in model.slices], 0.5, model.n + 0.5 * (model.types + 1)

    def whole(text):
        tokens = np.r_[word_hashes(words(text, lower=True)), bloom_lm.END]
        pairs, before = bloom_lm.pair_hashes(tokens, bounds([len(tokens)]))
        chunk = pairs >> np.uint64(64 - model.bits)
        count = sum(np.where((chunk >= lo) & (chunk < hi), bloom_lm.Filter(p[0]).count(pairs), 0.0) for lo, hi, p in parts)
        held = bloom_lm._found(keys, sums, bloom_lm.context(before).astype(np.uint32))
        p_word = (bloom_lm.Filter(singles).count(tokens) + low) / room
        return float(np.sum(np.log10(count + model.prior * p_word) - np.log10(held + model.prior + bloom_lm.SLACK)))
    want = Counter((r.doc_id, round(whole(r.text), 6)) for r in docs.collect())
    assert Counter((r.doc_id, round(r.score, 6)) for r in bloom_lm.score(docs, model, ["doc_id"]).collect()) == want


def test_kept_columns_come_back_as_they_were(spark):
    big = 2**62 + 1  # no double has it
    docs = spark.createDataFrame([(big, {"a": 1}, "one two", "x"), (None, None, None, None), (big + 2, {}, "one two", "y")],
                                 "score_id long, m map<string,int>, body string, `lot` string")
    out = bloom_lm.score(docs, bloom_lm.learn(docs, "body"), ["score_id", "m", "lot"], "body")
    assert sorted((r.score_id or 0, r.m, r.lot, r.n_tokens) for r in out.collect()) == [(0, None, None, 1), (big, {"a": 1}, "x", 3), (big + 2, {}, "y", 3)]


def test_packed_numbers_come_back():
    x = np.sort(np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64))
    for part in (x, x[:1], x[:0], (x >> np.uint64(40)).astype(np.uint32)):
        assert (blobs.from_gaps(blobs.gaps(part), part.dtype) == part).all() and len(blobs.from_gaps(blobs.gaps(part), part.dtype)) == len(part)
    y = np.random.default_rng(4).random(100)
    assert (blobs.from_planes(blobs.planes(y), float) == y).all() and (blobs.from_planes(blobs.planes(y.astype(np.float32)), np.float32) == y.astype(np.float32)).all()


def test_filter_levels_are_one_sided():
    rng = np.random.default_rng(1)
    h, c = rng.integers(0, 2**63, 20_000).astype(np.uint64), rng.zipf(1.6, 20_000).clip(1, 10**6)
    raw, size = bloom_lm.build_filter(h, c)
    packed = bloom_lm.Packed(1, 2, 2 * size)
    for k in (0, 1):
        packed.add(k, raw, size, bloom_lm.PROBES, b"")
    f = bloom_lm.Filter(packed.arrays())
    level = f.level(h)
    assert (level >= bloom_lm.quantise(c)).all() and (level == bloom_lm.quantise(c)).mean() > 0.95
    assert (f.level(rng.integers(0, 2**63, 20_000).astype(np.uint64)) > 0).mean() < 0.04


def test_levels_equal_one_probe_after_another_in_few_calls(monkeypatch):
    rng = np.random.default_rng(2)
    parts = [(rng.integers(0, 2**63, n).astype(np.uint64), rng.zipf(1.5, n).clip(1, 10**5), first) for n, first in ((300, 20), (1, 6), (500, 24))]
    built = [bloom_lm.build_filter(*p) for p in parts]
    raw = np.frombuffer(b"".join(r for r, _ in built), np.uint8)
    starts = np.cumsum([0, *[size for _, size in built]])
    asked = [np.concatenate([h, rng.integers(0, 2**63, 200).astype(np.uint64)]) for h, *_ in parts]
    h, k = np.concatenate(asked), np.repeat(np.arange(3), [len(a) for a in asked])
    size, start, first = np.array([n for _, n in built], np.uint64)[k], starts[k].astype(np.uint64), np.array([p[2] for p in parts])[k]
    size[-7:] = 0  # chunks without n-grams

    def one(h, size, start, first):
        q = 0
        while size:
            a, b = (int(x[0]) for x in bloom_lm._seeds(np.array([h], np.uint64), q + 1))
            bits = [int(start) + (a + i * b) % 2**64 % int(size) for i in range(bloom_lm.PROBES if q else first)]
            if not all(raw[x >> 3] >> (x & 7) & 1 for x in bits):
                break
            q += 1
        return q
    calls, place = [], bloom_lm._place
    monkeypatch.setattr(bloom_lm, "_place", lambda *x: (calls.append(1), place(*x))[1])
    got = bloom_lm.levels(raw, h, size, start, first)
    assert got.tolist() == [one(*x) for x in zip(h, size, start, first)] and got.max() > 5
    assert len(calls) <= 24 // bloom_lm.AT_ONCE + got.max()
    monkeypatch.setattr(bloom_lm, "PLACES", 1)
    assert (bloom_lm.levels(raw, h, size, start, first) == got).all()
    known = np.concatenate([np.r_[bloom_lm.quantise(c), np.zeros(200, np.int64)] for _, c, _ in parts])
    known[-7:] = 0
    assert (bloom_lm.levels(raw, h, size, start, first, known) == got).all()
    assert len(bloom_lm.levels(raw, h[:0], size[:0], start[:0], first[:0])) == 0


def test_hashes_of_words_are_the_same_with_and_without_a_cache():
    parts = [b"a", b"", b"two words", "\u00e9\U0001f600".encode(), b"x" * 5000]
    assert word_hashes(parts).tolist() == WordHash().array(parts).tolist() and word_hashes([]).dtype == np.uint64 and len(word_hashes([])) == 0


def next_words(model, contexts):
    """Sum of P(word | context) over the vocabulary and one unknown word, for each context."""
    parts = [b.value for _, _, b in model.slices]
    vocabulary = np.concatenate([h for _, h, *_ in parts])
    low, room = 0.5, model.n + 0.5 * (model.types + 1)
    singles, keys, sums = model.words.value
    p = (bloom_lm.Filter(singles).count(vocabulary) + low) / room
    assert math.isclose(p.sum() + low / room, 1, rel_tol=1e-9)
    out = []
    for c in contexts:
        h = bloom_lm.pair_hash(np.full(len(vocabulary), np.uint64(c) << np.uint64(64 - bloom_lm.CONTEXT_BITS)), vocabulary)
        chunk = (h >> np.uint64(64 - model.bits)).astype(np.int64)
        count = sum(np.where((chunk >= lo) & (chunk < hi), bloom_lm.Filter(part[0]).count(h), 0.0) for (lo, hi, _), part in zip(model.slices, parts))
        held = bloom_lm._found(keys, sums, np.array([c], np.uint32))[0]
        out.append((count.sum() + model.prior * (p.sum() + low / room)) / (held + model.prior + bloom_lm.SLACK))
    return out


@pytest.mark.parametrize("scale, slice_mb", [("0.001", 256), ("0.01", 256), ("0.01", 0)])
def test_probabilities_of_the_next_word_sum_to_one(spark, scale, slice_mb):
    docs = queries.documents(spark, SF.replace("0.001", scale))
    model = bloom_lm.learn(docs, slice_mb=slice_mb)
    _, keys, held = model.words.value
    order, rng = np.argsort(held), np.random.default_rng(1)
    chosen = [*order[-8:], *rng.choice(order[:len(order) // 2], 12), *rng.choice(order[len(order) // 2:], 12)]
    for total in next_words(model, [*keys[chosen], 12345]):
        assert 0.98 <= total <= 1.0 + 1e-7


def test_scrambling_can_be_undone():
    x = np.random.default_rng(0).integers(0, 2**64, 10_000, dtype=np.uint64)
    assert (unmix(mix(x)) == x).all() and (mix(unmix(x)) == x).all()
    before, word = x[:5000], x[5000:]
    assert (bloom_lm.context_of(bloom_lm.pair_hash(before, word)) == before >> np.uint64(40)).all()


def test_scores_follow_exact_counts_and_beat_the_base(spark):
    docs = queries.documents(spark, SF.replace("0.001", "0.01")).withColumn("held_out", queries.fold() == 1)
    rows = docs.collect()
    texts = {r.doc_id: [*split(lower(r.text)), None] for r in rows}
    single, pair, context = Counter(), Counter(), Counter()
    for r in rows:
        if not r.held_out:
            w = texts[r.doc_id]
            single.update(w)
            pair.update(zip([None, *w], w))
            context.update([None, *w[:-1]])
    n, v, prior = sum(single.values()), len(single), 200.0
    model = bloom_lm.learn(docs.where("not held_out"), prior=prior)
    got = bloom_lm.score(docs, model, ["doc_id", "held_out"]).collect()
    error, mine, base, tokens = 0.0, 0.0, 0.0, 0
    for r in got:
        w = texts[r.doc_id]
        want = sum(math.log10((pair[a, b] + prior * (single[b] + 0.5) / (n + 0.5 * (v + 1))) / (context[a] + prior + bloom_lm.SLACK))
                   for a, b in zip([None, *w], w))
        error = max(error, abs(r.score - want) / len(w))
        if r.held_out:
            mine, base, tokens = mine + r.score, base + r.base_score, tokens + r.n_tokens
    assert error < 0.15 and mine / tokens > base / tokens + 0.2


def test_model_without_texts(spark, empty, small):
    out = bloom_lm.score(small, bloom_lm.learn(empty), ["doc_id"]).collect()
    assert {(r.train_tokens, r.n_known, r.base_score) for r in out} == {(0, 0, 0.0)}
    assert bloom_lm.score(empty, bloom_lm.learn(small), ["doc_id"]).collect() == []


def test_model_prefers_held_out_prose_in_order(small):
    model = bloom_lm.learn(small.where(queries.fold() != 1))
    out = bloom_lm.score(small.where(queries.fold() == 1), model, ["doc_id"]).agg(F.sum("score"), F.sum("base_score")).first()
    assert out[0] > 1.02 * out[1]


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_edits_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.collect()
    got = cdc.compare_with_edits(clashing(docs, ["bucket", "tail", "fingerprint", "missing"])).collect()
    assert len(got) == len(rows)
    known = [r for r in rows if r.doc_id is not None]
    if len({r.doc_id for r in known}) == len(rows):
        known.sort(key=lambda r: -r.doc_id)
        want = {}
        for r, s in zip(known, known[1:] + known[:1]):
            cut = len(r.text) // 3
            want[r.doc_id] = (len(r.text), hashlib.sha256((r.text[:len(r.text) - cut] + s.text[:cut]).encode()).hexdigest())
        assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in got} == want
    prints = {r.doc_id: cdc.read(r.fingerprint) for r in got}
    for r in got:
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert math.isclose(r.near_edited, cdc.containment(cdc.read(r.fingerprint), cdc.read(r.edited_fingerprint)))
    assert len(prints) == len({r.doc_id for r in rows})


def test_edits_of_odd_rows(odd):
    one_each = odd.dropDuplicates(["doc_id"]).cache()
    rows = sorted(one_each.collect(), key=lambda r: -r.doc_id if r.doc_id is not None else math.inf)
    want = {}
    for r, s in zip(rows, rows[1:] + rows[:1]):
        t, u = r.text or "", s.text or ""
        cut = len(t) // 3
        want[r.doc_id] = (len(t), hashlib.sha256((t[:len(t) - cut] + u[:cut]).encode()).hexdigest())
    assert {r.doc_id: (r.n_chars, r.edited_sha256) for r in cdc.compare_with_edits(one_each).collect()} == want


def plain_gear(raw):
    h, out = 0, []
    for b in raw:
        h = ((h << 1) + int(cdc.GEAR[b])) % 2**32
        out.append(h)
    return out


def test_chunks():
    rng = np.random.default_rng(2)
    raw = bytes(rng.integers(97, 123, 5000, dtype=np.uint8))
    assert cdc.gear(raw).tolist() == plain_gear(raw)
    ends = cdc.cut_places(raw)
    sizes = np.diff([0, *ends])
    assert ends[-1] == len(raw) and sizes.max() <= cdc.MAX and sizes[:-1].min() >= cdc.MIN and 30 < sizes.mean() < 90
    shifted = cdc.containment(cdc.chunk_set(raw), cdc.chunk_set(b"inserted in front " + raw[:2500] + b"and here" + raw[2500:]))
    assert shifted > 0.9 and cdc.containment(cdc.chunk_set(raw), cdc.chunk_set(raw[::-1])) < 0.05
    assert cdc.read(cdc.spell(cdc.chunk_set(raw))) == cdc.chunk_set(raw)
    assert cdc.containment({}, {}) == 1 and cdc.containment({1: 2}, {}) == 0
    cut, cdc.STEP = cdc.cut_places(raw), 700
    assert cdc.cut_places(raw) == cut


def test_gam_learns_an_interaction():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(4000, len(gam.FEATURES)))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit(x[:3000], y[:3000])
    assert ((gam.predict(model, x[3000:]) > 0.5) == y[3000:]).mean() > 0.95
    assert (1, 0) in model["pairs"]


def sf01():
    return SF.replace("0.001", "0.01")


def test_quality_on_held_out_documents(spark):
    out = queries.op9_quality(spark, sf01()).join(spark.read.parquet(f"{sf01()}/labels.parquet"), "doc_id")
    rows = out.where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.93


def test_toxicity_on_held_out_documents(spark):
    out = queries.op3_toxicity(spark, sf01()).join(spark.read.parquet(f"{sf01()}/labels.parquet"), "doc_id")
    rows = out.where("held_out").collect()
    assert np.mean([r.predicted == r.toxic for r in rows]) > 0.93


def test_classifiers_on_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(i * 3, i % 2 if i % 5 else None, i % 3 == 0) for i in range(40)], "doc_id long, quality int, b boolean")
    labels = labels.withColumn("toxic", F.col("b").cast("int"))
    docs = clashing(odd, ["features", "ids", "score", "quality", "toxic", "fold"])
    for known in (labels, labels.limit(0), labels.where("quality = 1")):
        a = gam.classify(docs, known).collect()
        b = chains.classify(docs, known, ["quality", "toxic"]).collect()
        assert len(a) == len(b) == odd.count()
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in a)
        assert all(0 <= r.p_quality <= 1 and 0 <= r.p_toxic <= 1 for r in b)
    assert gam.classify(empty, labels).collect() == [] and chains.classify(empty, labels, ["toxic"]).collect() == []


def test_later_models_use_earlier_probabilities():
    rng = np.random.default_rng(4)
    first = rng.random(3000) < 0.4
    sets = [np.unique(np.r_[rng.integers(100, 2000, 20), [1 if f else 2]]) for f in first]
    y = np.c_[first, first].astype(float)
    y[::7, 0] = np.nan
    chain = chains.fit_chain(chains.Rows(sets), y, np.arange(3000) % 3)
    assert chain[1]["w"][len(chain[1]["words"])] > 0.5
    p = chains.apply_chain(chain, chains.Rows(sets))
    assert ((p[:, 1] > 0.5) == first).mean() > 0.99
