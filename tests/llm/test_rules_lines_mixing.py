import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

from llm.conftest import clashing
from panelcast.llm import lines, mixing, rules


def plain_stats(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    spans = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    count, hit = Counter(spans), set()
    for i, s in enumerate(spans):
        if count[s] > 1:
            hit |= set(range(i, i + 8))
    seen, dups = set(), 0
    for x in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", x):
            dups += x in seen
            seen.add(x)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dups, len(hit)


@pytest.mark.parametrize("table", ["odd", "small", "empty"])
def test_rules_equal_brute_force(request, table):
    docs = request.getfixturevalue(table)
    rows = docs.collect()
    stats = {i: plain_stats(r.text) for i, r in enumerate(rows)}
    fails = {i: (n < 20 or 100 * rep > 30 * n, 10 * sym > n, 20 * dup > n, chars < 2 * n or chars > 15 * n)
             for i, (n, chars, sym, dup, rep) in stats.items()}
    hosts = defaultdict(list)
    for i, r in enumerate(rows):
        hosts[r.source].append(i)
    worst = dict.fromkeys(hosts, 0.0)
    for k in range(4):
        n, f = [len(v) for v in hosts.values()], [sum(fails[i][k] for i in v) for v in hosts.values()]
        total, failed = sum(n), sum(f)
        p = failed / total if total else 0
        room = total - sum(x * x for x in n) / total - (len(n) - 1) if total else 0
        if 0 < p < 1 and room > 0:
            rho = min(max((sum(y * y / x for x, y in zip(n, f)) - failed * p) / (p * (1 - p)) - len(n) + 1, 0) / room, 0.5)
            a = p * (1 / max(rho, 1e-4) - 1)
            b = a / p - a
        else:
            a = (failed + 0.5) / (total + 1)
            b = 1 - a
        for h, x, y in zip(hosts, n, f):
            worst[h] = max(worst[h], (y + a) / (x + a + b))
    want = sorted(str((r.doc_id, *stats[i], fails[i][0], not any(fails[i]) and worst[r.source] <= 0.5)) for i, r in enumerate(rows))
    out = rules.apply_rules(clashing(docs, ["n_words", "kept", "host_rate", "n", "f_base", "__host"]))
    got = out.collect()
    assert sorted(str((r.doc_id, *(r[c] for c in rules.STATS), r.base_failed, r.kept)) for r in got) == want
    assert all(abs(r.host_rate - worst[r.source]) < 1e-9 for r in got)


def test_a_bad_host_takes_its_documents_with_it(spark):
    good = " ".join(f"word{i}" for i in range(40))
    rows = [(i, good if i % 10 else "# # #", "good") for i in range(200)] + [(1000 + i, good if i % 10 == 0 else "# #", "bad") for i in range(100)]
    rows += [(5000, "# #", "single")]
    out = rules.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, source string"))
    kept = {r.doc_id: r.kept for r in out.collect()}
    assert sum(kept[i] for i in range(200)) == 180 and not any(kept[1000 + i] for i in range(100))


def on_duckdb(docs, sql):
    con = duckdb.connect()
    con.register("frame", docs.toPandas())
    con.execute("CREATE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, text, lang, source FROM frame")
    cur = con.execute(sql)
    return sorted(str(sorted(dict(zip([d[0] for d in cur.description], r)).items())) for r in cur.fetchall())


def lines_of(docs, **kw):
    out = lines.drop_lines(clashing(docs, ["n_lines", "line", "leaf", "lines"]), **kw)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def test_lines_equal_sql(odd, small):
    one_each = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    for docs in (one_each, small):
        got = sorted(str(sorted(r.asDict().items())) for r in lines_of(docs).collect())
        assert got == on_duckdb(docs, lines.oracle())


def test_recurring_templates_stay_once(spark, odd, empty):
    rows = [(i, f"own text number {'abcdefgh'[i]} here\nPosted on 2020-0{i}-01 by the editors of this page\n\nend") for i in range(1, 8)]
    rows += [(1, "Posted on 1999 by the editors of this page"), (None, "Posted on 1999 by the editors of this page"), (9, None), (10, "")]
    out = lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = sorted((r.doc_id or 0, r.n_lines, r.n_dropped) for r in out)
    texts = [t for i, t in rows if i == 1]
    hashes = {r.t: r.h for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.xxhash64("t").alias("h")).collect()}
    first = min(texts, key=hashes.get)  # of two rows with the smallest id that with the smaller text hash keeps the line
    ones = [(1, t.count("\n") + 1, int(t != first)) for t in texts]
    assert got == sorted([(0, 1, 0), *ones, (9, 0, 0), (10, 1, 0)] + [(i, 4, 1) for i in range(2, 8)])
    assert lines_of(empty).collect() == []
    assert lines_of(odd).count() == odd.count()


def test_lines_with_words_of_their_own_stay(spark):
    rng = random.Random(3)

    def own(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    opening, tail = "the same eight words open each of them", own(50)
    rows = [(i, f"{opening} {own(50)}") for i in range(6)]
    out = lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.text, r.n_dropped) for r in out) == [(i, t, 0) for i, t in rows]
    # a field that varies in one place is one template, and lines beside it in the leaf stay
    rows = [(i, f"{opening} {tail.replace(tail.split()[3], own(1))}") for i in range(6)] + [(10 + i, f"{opening} {own(50)}") for i in range(6)]
    out = {r.doc_id: r.n_dropped for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {0: 0, **{i: 1 for i in range(1, 6)}, **{10 + i: 0 for i in range(6)}}
    # six documents in the leaf, but only three hold the first line's template
    rows = [(i, f"{opening} {tail}") for i in range(3)] + [(10 + i, f"{opening} {own(50)}") for i in range(3)]
    assert all(r.n_dropped == 0 for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())


def test_every_template_of_a_leaf_stays_once(spark):
    rng = random.Random(6)

    def own(n):
        return " ".join("".join(rng.choice("abcdefghij") for _ in range(7)) for _ in range(n))
    opening, one, two = "the same eight words open each of them", own(40), own(40)
    rows = [(0, f"{opening} {own(40)}")]  # the leaf's first line is like no other
    rows += [(10 + i, f"{opening} {one.replace(one.split()[3], own(1))}") for i in range(6)]
    rows += [(20 + i, f"{opening} {two.replace(two.split()[33], own(1))}") for i in range(5)]
    rows += [(30 + i, f"{opening} {' '.join(own(40).split()[:10] + two.split()[10:30])} {own(10)}") for i in range(6)]
    four = own(40)
    rows += [(40 + i, f"{opening} {four}") for i in range(4)] + [(43, f"{opening} {four}")]
    docs = spark.createDataFrame(rows[:-1], "doc_id long, text string")
    assert {r.doc_id: r.n_dropped for r in lines.drop_lines(docs).collect()} == {i: int(11 <= i < 16 or 21 <= i < 25) for i, _ in rows}
    # a document that holds a line twice counts once
    out = [r for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.doc_id >= 40]
    assert [r.n_dropped for r in out] == [0] * 5


def test_many_templates_in_few_leaves_equal_sql(spark):
    rng = random.Random(7)
    rows = [(i, "\n".join(" ".join(["w"] * 8 + [rng.choice("abc") for _ in range(n)]) for n in rng.choices([0, 1, 2, 4, 5, 7, 8], k=4))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(""), "source": F.lit("")})
    for kw in ({}, {"min_docs": 2}, {"min_docs": 12}):
        assert sorted(str(sorted(r.asDict().items())) for r in lines_of(docs, **kw).collect()) == on_duckdb(docs, lines.oracle(**kw))
    # plain Python: the first line's template, then the three quarters that most documents of the leaf share
    words = [(i, k, tuple(line.split())) for i, t in rows for k, line in enumerate(t.split("\n"))]
    leaves, dropped = defaultdict(list), Counter()
    for i, k, w in words:
        n = len(w) - 8
        leaves[len(w)].append((i, k, tuple(w[8 + n * j // 4:8 + n * (j + 1) // 4] for j in range(4))))
    for whole in leaves.values():
        leaf = whole
        like = [r for r in leaf if sum(a == b for a, b in zip(r[2], leaf[0][2])) >= 3]
        if len({i for i, *_ in like}) >= 5:
            dropped.update(i for i, *_ in like[1:])
            leaf = [r for r in leaf if r not in like]
        holders, seen = defaultdict(set), set()
        threes = {r: [(f, r[2][:f] + r[2][f + 1:]) for f in range(4)] for r in whole}
        for r in whole:
            for t in threes[r]:
                holders[t].add(r[0])
        for r in leaf:
            size, _, t = min((-len(holders[t]), t[0], t) for t in threes[r])
            dropped[r[0]] += size <= -5 and t in seen
            seen.add(t)
    assert {r.doc_id: r.n_dropped for r in lines_of(docs).collect()} == {i: dropped[i] for i, _ in rows}


def test_lines_of_the_first_template_count_for_others(spark):
    def line(*quarters):
        return "the same eight words open each of them " + " ".join(f"{q}{c}" for q in quarters for c in "vwxyz")
    rows = [(0, line("a", "b", "c", "d"))] + [(i, line("a", "b", "c", "e")) for i in range(1, 5)]
    # three quarters like those of four lines that the first template holds, two like the first line alone
    rows += [(10, line("a", "b", "f", "e")), (11, line("a", "b", "g", "e")), (12, line("a", "b", "h", "e")), (20, line("a", "i", "j", "d")), (21, line("a", "k", "l", "d"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(""), "source": F.lit("")})
    assert {r.doc_id: r.n_dropped for r in lines_of(docs).collect()} == {i: int(1 <= i < 5 or i in (11, 12)) for i, _ in rows}
    assert sorted(str(sorted(r.asDict().items())) for r in lines_of(docs).collect()) == on_duckdb(docs, lines.oracle())
    # with one document less that holds them, the three quarters do not recur
    fewer = docs.where("doc_id not in (3, 4, 12)").unionByName(docs.where("doc_id = 0").selectExpr("doc_id + 30 as doc_id", "text", "lang", "source"))
    fewer = fewer.unionByName(docs.where("doc_id = 0").selectExpr("doc_id + 31 as doc_id", "text", "lang", "source"))
    assert {r.doc_id for r in lines_of(fewer).where("n_dropped > 0").collect()} == {1, 2, 30, 31}


def test_rows_with_one_id_keep_their_own_lines(spark):
    line = "a line that many of the documents hold in common"
    rows = [(i, f"start {i}\n{line}") for i in range(1, 8)] + [(3, "start 3\na unique line that stands nowhere else at all"), (3, f"start 3\n{line}")]
    out = sorted((r.doc_id, r.text) for r in lines.drop_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert out == sorted([(1, f"start 1\n{line}")] + [(i, f"start {i}") for i in range(2, 8)] + [(3, "start 3"), (3, "start 3\na unique line that stands nowhere else at all")])


def test_quarters_of_any_length_equal_sql(spark):
    rng = random.Random(4)
    rows = [(i, "\n".join(" ".join(rng.choice(["a", "b", "7x"]) for _ in range(n)) for n in (3, 8, 9, 10, 11, 12, 13, 17, 30))) for i in range(60)]
    rows += [(100 + i, " ".join(["w"] * 8 + [f"v{'abc'[i % 3]}" if k == i % 7 else "w" for k in range(n)])) for i, n in enumerate([1, 2, 3, 4, 5, 6, 7, 9] * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit(""), "source": F.lit("")})
    for kw in ({}, {"depth": 3, "min_docs": 2}):
        assert sorted(str(sorted(r.asDict().items())) for r in lines_of(docs, **kw).collect()) == on_duckdb(docs, lines.oracle(**kw))


def test_documents_of_many_recurring_lines(spark):
    many = "\n".join(f"{w} recurring line with its words" for w in ("".join(chr(97 + (i // 26 ** k) % 26) for k in range(4)) for i in range(20_000)))
    out = lines.drop_lines(spark.createDataFrame([(i, many) for i in range(5)], "doc_id long, text string")).select("doc_id", "n_dropped", F.length("text").alias("n")).collect()
    assert sorted((r.doc_id, r.n_dropped, r.n) for r in out) == [(0, 0, len(many))] + [(i, 20_000, 0) for i in range(1, 5)]


def test_mixture_equals_sql(odd, small):
    one_each = odd.where("doc_id is not null").dropDuplicates(["doc_id"]).cache()
    for docs in (one_each, small):
        got = sorted(str(sorted(r.asDict().items())) for r in mixing.mixed(clashing(docs.select("doc_id", "source"), ["slot", "units", "turn"])).drop("turn").collect())
        assert got == on_duckdb(docs, mixing.oracle())


@pytest.mark.parametrize("period", [20, 97])
def test_no_source_is_off_by_a_block(spark, period):
    rows = [(i, ["hot", "hot", "hot", "b", "c", None][i % 6]) for i in range(3000)]
    out = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string"), block=4, period=period)
    got = out.collect()
    assert len(got) == 3000 and len({r.place for r in got}) == 3000
    slots, units, blocks = {}, {}, Counter()
    for r in got:
        assert slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)
        assert r.release <= r.slot < r.deadline
        units[r.source] = r.units
    blocks.update(s for s, _ in slots.values())
    assert sum(units.values()) == period
    run = Counter()
    for t in range(max(slots) + 1):
        if t in slots:
            run[slots[t][0]] += 1
        for s, u in units.items():
            if run[s] < blocks[s]:
                assert abs(run[s] - (t + 1) * u / period) < 1


def test_mixture_of_odd_rows(odd, empty):
    assert mixing.mixed(odd).count() == odd.count()
    assert mixing.mixed(empty).collect() == []


def test_more_sources_than_the_least_period(spark):
    rows = [(i, f"s{i}") for i in range(1200)] + [(2000 + i, "hot") for i in range(1200)] + [(9000 + i, f"s{i % 40}") for i in range(400)]
    got = mixing.mixed(spark.createDataFrame(rows, "doc_id long, source string"), F.count(F.lit(1)), block=4).collect()
    assert len(got) == len(rows) and len({r.place for r in got}) == len(rows)
    units, period = {r.source: r.units for r in got}, mixing.SLOTS * 1201
    assert sum(units.values()) == period
    size = Counter(s for _, s in rows)
    for s, u in units.items():
        assert abs(u - period * size[s] / len(rows)) <= size[s] / len(rows) * 1201 + 2
    slots = {}
    for r in got:
        assert r.release <= r.slot < r.deadline and slots.setdefault(r.slot, (r.source, r.block)) == (r.source, r.block)


def test_mixture_of_many_sources_equals_sql(spark):
    rows = [(i, f"s{i % (1 + i % 45)}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string").withColumns({"text": F.lit(""), "lang": F.lit("")})
    got = sorted(str(sorted(r.asDict().items())) for r in mixing.mixed(docs.select("doc_id", "source")).collect())
    assert got == on_duckdb(docs, mixing.oracle(period=mixing.SLOTS * 45))
