from collections import Counter

import corpus_pipeline
from llm.conftest import SF, clashing
from llm.test_rules_lines_mixing import plain_stats
from llm.test_simhash_substrings import closure, plain_simhash
from llm.test_tokens import plain
from panelcast.llm import lines, mixing, queries
from panelcast.sources.staging import write_once


def test_stages_on_odd_rows(spark, odd, empty):
    for docs in (clashing(odd, ["kept", "slot", "n_words", "n_tokens"]), empty):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF)
            if name != corpus_pipeline.STAGES[-1][0]:
                assert out.columns == docs.columns and out.dtypes == docs.dtypes
            assert out.count() >= 0


def test_each_stage_against_plain_python(spark):
    docs = queries.documents(spark, SF)
    rows = {r.doc_id: r for r in docs.collect()}
    kept = corpus_pipeline.quality_rules(spark, docs, SF)
    want = set()
    for i, r in rows.items():
        n, chars, sym, dup, rep = plain_stats(r.text)
        if n >= 20 and 100 * rep <= 30 * n and 10 * sym <= n and 20 * dup <= n and 2 * n <= chars <= 15 * n:
            want.add(i)
    assert {r.doc_id for r in kept.collect()} == want
    cut = corpus_pipeline.line_dedup(spark, kept, SF)
    dropped = {r.doc_id: set(r.lines) for r in lines.repeated_lines(kept).collect()}
    got = {r.doc_id: r for r in cut.collect()}
    for i in want:
        text = "\n".join(x for k, x in enumerate(rows[i].text.split("\n")) if k not in dropped.get(i, ()))
        assert (got[i].text, got[i].n_chars) == (text, len(text))
    single = corpus_pipeline.near_dedup(spark, cut, SF)
    ids = sorted(got)
    fp = [plain_simhash(got[i].text) for i in ids]
    label = closure(len(ids), [(a, b) for a in range(len(ids)) for b in range(a) if (fp[a] ^ fp[b]).bit_count() <= 4])
    least = {}
    for i, c in zip(ids, label):
        least[c] = min(least.get(c, i), i)
    left = {r.doc_id: r.text for r in single.collect()}
    assert set(left) == set(least.values())
    mixture = corpus_pipeline.mixing_sources(spark, single, SF)
    assert {r.doc_id: r.text for r in mixture.collect()} == left
    out = corpus_pipeline.tokens(spark, mixture, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in out} == {i: plain(t) for i, t in left.items()}
    assert {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, SF).collect()} == {r.doc_id: r.n_tokens for r in out}


def test_repeated_rows_leave_one(spark):
    docs = spark.createDataFrame([(4, "a few words of some text", "x")] * 3 + [(9, "a few words of some text", "y"), (None, "t", None)],
                                 "doc_id long, text string, source string")
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near_dedup(spark, docs, SF).collect()) == ["4", "None"]


def test_tokens_come_in_the_order_of_the_mixture(spark):
    rows = [(i, "a long text " * 2000 if i % 50 == 7 else f"text number {i}", "hot" if i % 10 else "b") for i in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(7)
    mixture = write_once(corpus_pipeline.mixing_sources(spark, docs, SF), "mixture")
    got = corpus_pipeline.tokens(spark, mixture, SF).collect()
    want = {r.doc_id: (r.units, r.block, r.slot, r.place) for r in mixing.mixed(docs).collect()}
    assert {r.doc_id: (r.units, r.block, r.slot, r.place) for r in got} == want and len(got) == len(rows)
    assert [r.place for r in got] == sorted(r.place for r in got)
    slots, units = {r.slot: r.source for r in got}, {r.source: r.units for r in got}
    blocks, run = Counter(slots.values()), Counter()
    for t in range(max(slots) + 1):
        run[slots.get(t)] += 1
        for s, u in units.items():
            if run[s] < blocks[s]:
                assert abs(run[s] - (t + 1) * u / mixing.PERIOD) < 1


def test_line_dedup_finds_every_template_of_a_leaf(spark):
    opening, tail = "the same eight words open each of them", " ".join(f"tail{'abcd'[k // 5]}{'vwxyz'[k % 5]}" for k in range(20))
    rows = [(0, f"{opening} " + " ".join(["first"] * 20), "a", 0)] + [(i, f"own start of {'abcdefg'[i]}\n{opening} {tail}", "a", 0) for i in range(1, 7)]
    out = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"), SF).collect()
    want = [(i, t if i < 2 else t.split("\n")[0]) for i, t, *_ in rows]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out) == [(i, t, len(t)) for i, t in want]


def test_line_dedup_counts_lines_of_the_first_template(spark):
    def line(*quarters):
        return "the same eight words open each of them " + " ".join(f"{q}{c}" for q in quarters for c in "vwxyz")
    held = [line("a", "b", "c", "d"), *[line("a", "b", "c", "e")] * 4, line("a", "b", "f", "e"), line("a", "b", "g", "e")]
    rows = [(i, f"own start of {'abcdefg'[i]}\n{t}", "a", 0) for i, t in enumerate(held)]
    out = corpus_pipeline.line_dedup(spark, spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long"), SF).collect()
    want = [(i, t if i in (0, 5) else t.split("\n")[0]) for i, t, *_ in rows]
    assert sorted((r.doc_id, r.text, r.n_chars) for r in out) == [(i, t, len(t)) for i, t in want]
