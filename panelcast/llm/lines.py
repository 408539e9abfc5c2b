"""Line dedup with a log-template tree, in DataFrame functions alone.

Lines descend a tree of fixed depth: first by their number of words, then by their leading words.
A word with a digit is a variable field and matches any other.  In its leaf a line is compared with
the leaf's first line, quarter by quarter of the words behind the leading ones; three equal quarters
make them one template, so a variable field in the fourth does not matter and a line with words of
its own is no copy.  Lines that the first one leaves are grouped by the three quarters that they share
with any lines of the leaf, so a leaf holds any number of templates.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once

DEPTH = 8
MIN_WORDS = 3
MIN_DOCS = 5
FIELD = "<*>"
SPACE = " \\t\\x0b\\f\\r"


def _quarter(k: int, depth: int) -> str:
    """SQL text of the ``k``-th quarter of the words behind the first ``depth``; fewer than four words leave quarters empty."""
    begin, end = (f"greatest(n_words, {depth}) - {depth}" if j == 4 else f"(greatest(n_words, {depth}) - {depth}) * {j} div 4" for j in (k - 1, k))
    size = f"CAST(({end}) - ({begin}) AS INT)"
    return f"IF({size} > 0, substring_index(substring_index(s, ' ', CAST({depth} + ({end}) AS INT)), ' ', -{size}), '')"


def templates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, line, n_words, path, q1 ... q4): every line with enough words, ``line`` counted from 0, its way
    through the tree and the hashes of its quarters; ``tag`` is the hash of the text."""
    lines = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("tag"), F.posexplode(F.split(F.col(text_col), "\n")).alias("line", "s"))
    odd = F.col("s").rlike(f"[{SPACE[1:]}]|  ")  # most lines need no replacement
    plain = lines.withColumn("s", F.trim(F.when(odd, F.regexp_replace("s", f"[{SPACE}]+", " ")).otherwise(F.col("s"))))
    n_words = F.length("s") - F.length(F.translate("s", " ", "")) + 1
    masked = F.when(F.col("s").rlike("[0-9]"), F.regexp_replace("s", "[^ ]*[0-9][^ ]*", FIELD)).otherwise(F.col("s"))
    words = plain.select("doc_id", "tag", "line", n_words.alias("n_words"), masked.alias("s")).where(F.col("n_words") >= min_words)
    return words.select("doc_id", "tag", "line", "n_words", F.substring_index("s", " ", depth).alias("path"),
                        *[F.hash(F.expr(_quarter(k, depth))).alias(f"q{k}") for k in range(1, 5)])


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, depth: int = DEPTH,
                   min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, tag, lines): the places of the lines to drop, ascending, for documents that have some.

    The first template of a leaf is its first line, that with the smallest id, then text hash, then place.
    It recurs if ``min_docs`` different documents hold it; it stays at its first place and is dropped
    elsewhere.  A line that no such template holds belongs to those of its three quarters that most documents
    have in the leaf, in lines of the first template as well, of equal ones to those with the earliest quarter left out;
    if ``min_docs`` documents have them, the first line that belongs there stays and the others are dropped.
    Other lines stay.  Rows without an id are left alone and not counted; rows with one id count as one
    document, and each text keeps its own places.
    """
    quarters = [f"q{k}" for k in range(1, 5)]
    found = write_once(templates(docs, id_col, text_col, depth, min_words).where("doc_id is not null")
                       .select("doc_id", "tag", "line", F.xxhash64("n_words", "path").alias("leaf"), F.xxhash64(F.lit(1), "path").alias("leaf2"), *quarters), "lines")
    keys, place = ["leaf", "leaf2"], F.struct("doc_id", "tag", "line", *quarters)
    # one row for each template and document first, so that counts of documents need no set of ids
    frequent = (found.groupBy(*keys, "doc_id").agg(F.min(place).alias("first")).groupBy(*keys)
                .agg(F.count(F.lit(1)).alias("docs"), F.min("first").alias("first"))
                .where(F.col("docs") >= min_docs).select(*keys, "first"))
    equal = sum(((F.col(q) == F.col(f"first.{q}")).cast("int") for q in quarters), F.lit(0))
    near = write_once(found.join(frequent, keys).select(*keys, "doc_id", "tag", "line", *quarters, (equal >= 3).alias("alike"),
                                                        (place == F.col("first")).alias("stays")), "near")
    # leaves all of whose lines the first template holds need no other
    leaves = (near.groupBy(*keys, "doc_id").agg(F.max("alike").alias("some"), F.min("alike").alias("whole")).groupBy(*keys)
              .agg((F.sum(F.col("some").cast("int")) >= min_docs).alias("recurs"), F.min("whole").alias("whole")))
    marked = near.join(leaves, keys).withColumn("taken", F.col("alike") & F.col("recurs"))
    copies = marked.where("taken and not stays").select("doc_id", "tag", "line")
    others = _shared_quarters(marked.where("not (recurs and whole)"), min_docs)
    return copies.unionByName(others).groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("line")).alias("lines"))


def _shared_quarters(near: DataFrame, min_docs: int) -> DataFrame:
    """(doc_id, tag, line) of the lines of ``near`` not ``taken`` by a first template that repeat three quarters of others of their leaf,
    as ``repeated_lines`` says; the taken ones count as others."""
    quarters, line = [f"q{k}" for k in range(1, 5)], ["doc_id", "tag", "line"]
    threes = [F.struct(F.lit(k).alias("free"), *[F.col(q).alias(c) for c, q in zip("abc", quarters[:k - 1] + quarters[k:])]) for k in range(1, 5)]
    template = ["leaf", "leaf2", "free", "a", "b", "c"]
    held = near.select("leaf", "leaf2", *line, "taken", F.explode(F.array(*threes)).alias("t")).select("leaf", "leaf2", *line, "taken", "t.*")
    common = (held.groupBy(*template, "doc_id").agg(F.lit(1).alias("one")).groupBy(*template).agg(F.count(F.lit(1)).alias("docs"))
              .where(F.col("docs") >= min_docs))
    best = F.min(F.struct((-F.col("docs")).alias("less"), "free", "a", "b", "c")).alias("t")
    own = write_once(held.where(~F.col("taken")).join(common, template).groupBy("leaf", "leaf2", *line).agg(best).select("leaf", "leaf2", *line, "t.*"), "shared")
    first = own.groupBy(*template).agg(F.min(F.struct(*line)).alias("first"))
    return own.join(first, template).where(F.struct(*line) != F.col("first")).select(*line)


def drop_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_docs: int = MIN_DOCS, depth: int = DEPTH,
               min_words: int = MIN_WORDS) -> DataFrame:
    """Every row of ``docs``, its text without recurring lines, with ``n_lines`` and ``n_dropped``.

    Lines are cut at U+000A and joined by it again, other lines as they were; words are cut at
    spaces and U+0009..U+000D.  Lines with fewer than ``min_words`` words are kept, so a blank line
    is.  A missing text stays missing with no lines; an empty one has one line.  Columns of
    ``docs`` named like a result are replaced.  Templates with equal hashes of 128 bits are one, and
    quarters with equal hashes of 32 bits.  What is kept is put together from the runs between dropped lines.
    """
    new = ["n_lines", "n_dropped"]
    drops = write_once(repeated_lines(docs, id_col, text_col, min_docs, depth, min_words), "drops").select(
        F.col("doc_id").alias("__id"), F.col("tag").alias("__tag"), F.col("lines").alias("__drop"))
    old = [c for c in docs.columns if c not in new]
    pieces, drop = F.split(F.col(text_col), "\n"), F.col("__drop")
    starts = F.concat(F.array(F.lit(0)), F.transform(drop, lambda i: i + 1))
    kept = F.flatten(F.zip_with(starts, F.concat(drop, F.array(F.size(pieces))), lambda a, b: F.slice(pieces, a + 1, b - a)))
    # the drops grow with the texts, so the join has one plan at every size
    own = docs.select(*old, F.xxhash64(text_col).alias("__own"))
    joined = own.join(drops.hint("merge"), (F.col(id_col) == F.col("__id")) & (F.col("__own") == F.col("__tag")), "left")
    text = F.when(drop.isNull(), F.col(text_col)).otherwise(F.array_join(kept, "\n"))
    n_lines = F.when(F.col(text_col).isNull(), 0).otherwise(F.size(pieces))
    n_dropped = F.when(drop.isNull(), 0).otherwise(F.size(drop))
    return joined.select(*[text.alias(c) if c == text_col else F.col(c) for c in old],
                         n_lines.cast("long").alias("n_lines"), n_dropped.cast("long").alias("n_dropped"))


def oracle(depth: int = DEPTH, min_words: int = MIN_WORDS, min_docs: int = MIN_DOCS) -> str:
    """The registered query in DuckDB's SQL."""
    behind = f"greatest(n_words - {depth}, 0)"
    quarters = ", ".join(f"m[{depth} + {behind} * {k} // 4 + 1:{depth} + {behind} * {k + 1} // 4]" for k in range(4))
    return f"""WITH cut AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS pieces FROM documents),
lines AS (
  SELECT doc_id, unnest(pieces) AS raw, unnest(range(len(pieces))) AS line FROM cut),
words AS (
  SELECT doc_id, line, list_filter(string_split(regexp_replace(raw, '[ \\t\\x0b\\f\\r]+', ' ', 'g'), ' '), lambda w: w <> '') AS w FROM lines),
masked AS (
  SELECT doc_id, line, len(w) AS n_words, list_transform(w, lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '{FIELD}' ELSE x END) AS m
  FROM words WHERE len(w) >= {min_words}),
leaves AS (
  SELECT doc_id, line, n_words, m[1:{depth}] AS path, [{quarters}] AS q FROM masked),
frequent AS (
  SELECT n_words, path, min((doc_id, line)) AS first, arg_min(q, (doc_id, line)) AS first_q
  FROM leaves GROUP BY n_words, path HAVING count(DISTINCT doc_id) >= {min_docs}),
near AS (
  SELECT n_words, path, doc_id, line, q, (doc_id, line) = first AS stays,
         len(list_filter(list_zip(q, first_q), lambda z: z[1] = z[2])) >= 3 AS alike FROM leaves JOIN frequent USING (n_words, path)),
recurring AS (
  SELECT n_words, path FROM near WHERE alike GROUP BY n_words, path HAVING count(DISTINCT doc_id) >= {min_docs}),
marked AS (
  SELECT n.*, alike AND r.path IS NOT NULL AS taken FROM near AS n LEFT JOIN recurring AS r ON n.n_words = r.n_words AND n.path = r.path),
held AS (
  SELECT n_words, path, doc_id, line, taken, free, q[:free - 1] || q[free + 1:] AS three FROM marked, (SELECT unnest([1, 2, 3, 4]) AS free)),
common AS (
  SELECT n_words, path, free, three, count(DISTINCT doc_id) AS docs FROM held GROUP BY n_words, path, free, three HAVING docs >= {min_docs}),
own AS (
  SELECT n_words, path, doc_id, line, arg_min((free, three), (-docs, free)) AS template
  FROM held JOIN common USING (n_words, path, free, three) WHERE NOT taken GROUP BY n_words, path, doc_id, line),
dropped AS (
  SELECT doc_id, line FROM marked WHERE taken AND NOT stays
  UNION SELECT doc_id, line FROM own QUALIFY (doc_id, line) <> min((doc_id, line)) OVER (PARTITION BY n_words, path, template)),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(d.line) AS n_dropped,
         coalesce(string_agg(raw, chr(10) ORDER BY l.line) FILTER (WHERE d.line IS NULL), '') AS text
  FROM lines AS l LEFT JOIN dropped AS d ON l.doc_id = d.doc_id AND l.line = d.line GROUP BY l.doc_id)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id)"""
