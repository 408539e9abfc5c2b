"""Byte-level BPE of whole texts, long ones by tree concatenation.

A long text is cut in halves until the parts are short; the parts are encoded by many tasks, and
neighbours are joined pair by pair.  A join encodes a window around the cut again and lets it grow
until both sides agree with it: on each side there must be a place from which the window's tokens
and the side's tokens are sure to be those of the joined text.  Such a place is

* a letter followed by an ASCII character that is no letter: no token spans it, and what follows is
  encoded without regard to what came before (places inside a special string are left out); or
* inside a run of letters without such a place, the edge of a token that both encodings have.
  A run's tokens are its encoding if each two neighbours are the encoding of the two together,
  and all neighbours in the joined row are neighbours in one of the two encodings.

If nothing agrees, the window grows to the whole of both sides, which is right by definition.
"""

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once

#: Code points of a text that one encoding takes at most; longer texts are cut.
LEAF = 16_384
#: Code points on each side of a cut that the first window holds.
WINDOW = 64
# Pattern of the vocabulary, and letters that every Unicode version calls letters.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
EDGE = re.compile(rf"(?<=[{LETTERS}])(?=[\x00-@\[-`{{-\x7f])")
RUN = re.compile(rf"[{LETTERS}]*")


class Codec:
    """Encoder of one vocabulary, and its tokens as bytes."""

    def __init__(self, path: str, special: dict[str, int]):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.special = special
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
        self.raw = {i: t for t, i in ranks.items()} | {i: t.encode() for t, i in special.items()}
        self.decimal = {i: str(i) for i in self.raw}

    def encode(self, text: str) -> list[int]:
        return self.encoding.encode(text, allowed_special="all")

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.raw.__getitem__, ids)).decode("utf-8", "replace")

    def digest(self, ids: list[int]) -> tuple[int, str, str]:
        """(tokens, hash of the decimal ids, hash of the decoded text)."""
        return (len(ids), hashlib.sha256(",".join(map(self.decimal.__getitem__, ids)).encode()).hexdigest(),
                hashlib.sha256(self.decode(ids).encode()).hexdigest())

    def ends(self, ids) -> np.ndarray:
        """Byte place after each token."""
        return np.cumsum(np.fromiter((len(self.raw[i]) for i in ids), np.int64, len(ids)))


@lru_cache(maxsize=2)
def codec(path: str, special: tuple) -> Codec:
    return Codec(path, dict(special))


def leaves(n: int, leaf: int) -> list[tuple[int, int]]:
    """Parts (start, end) of a text of ``n`` code points, halved until none is longer than ``leaf``."""
    parts = [(0, n)]
    while any(b - a > leaf for a, b in parts):
        parts = [x for a, b in parts for x in ([(a, (a + b) // 2), ((a + b) // 2, b)] if b - a > leaf else [(a, b)])]
    return parts


def _edges(text: str, lo: int, hi: int, special) -> list[int]:
    """Places in [lo, hi] that no token spans, whatever stands around."""
    out = [m.start() for m in EDGE.finditer(text, lo, hi + 1) if lo < m.start() < hi]
    for s in special:
        out = [p for p in out if (at := text.rfind(s, max(p - len(s) + 1, 0), p + len(s) - 1)) < 0 or not at < p < at + len(s)]
    return out


def _plain_run(text: str, a: int, b: int, special) -> bool:
    """Whether text[a:b] is letters only and no special string reaches into it."""
    return bool(RUN.fullmatch(text, a, b)) and not any(text.find(s, max(a - len(s) + 1, 0), b + len(s) - 1) >= 0 for s in special)


def join(c: Codec, text: str, at: int, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
    """Ids of ``text`` from those of ``text[:at]`` and ``text[at:]``."""
    left_end, right_end = c.ends(left), c.ends(right)
    n_left = int(left_end[-1]) if len(left) else 0
    left_place, right_place = {int(e): i + 1 for i, e in enumerate(left_end)}, {0: 0} | {int(e): i + 1 for i, e in enumerate(right_end)}
    while True:
        lo, hi = max(at - window, 0), min(at + window, len(text))
        if lo == 0 and hi == len(text):
            return c.encode(text)
        ids = c.encode(text[lo:hi])
        first = n_left - len(text[lo:at].encode())  # byte place of the window, in bytes of the text
        end = first + c.ends(ids)
        place = {first: 0} | {int(e): i + 1 for i, e in enumerate(end)}

        def byte(p):
            return first + len(text[lo:p].encode())

        def agreed_left():
            if lo == 0:
                return 0, 0
            for p in reversed(_edges(text, lo, at, c.special)):
                i, j = left_place.get(byte(p)), place.get(byte(p))
                if i and j and left[i - 1] == ids[j - 1]:
                    return i, j
            if _plain_run(text, lo, at, c.special):
                for j in range(len(ids) - 1, 1, -1):  # ids[j - 1] ends here, and is not the window's first
                    i = left_place.get(int(end[j - 1]))
                    if end[j - 1] < n_left and i and left[i - 1] == ids[j - 1]:
                        return i, j

        def agreed_right():
            if hi == len(text):
                return len(ids), len(right)
            for p in _edges(text, at, hi, c.special):
                j, i = place.get(byte(p)), right_place.get(byte(p) - n_left)
                if j is not None and i is not None and j < len(ids) and i < len(right) and right[i] == ids[j]:
                    return j, i
            if _plain_run(text, at, hi, c.special):
                for j in range(1, len(ids) - 1):
                    i = right_place.get(int(end[j - 1]) - n_left)
                    if end[j - 1] > n_left and i is not None and i < len(right) and right[i] == ids[j]:
                        return j, i

        a, b = agreed_left(), agreed_right()
        if a and b and a[1] <= b[0]:
            return left[:a[0]] + ids[a[1]:b[0]] + right[b[1]:]
        window *= 2


def concatenate(c: Codec, text: str, parts: list[tuple[int, int, list[int]]]) -> list[int]:
    """Ids of ``text`` from its leaves (start, end, ids), joined in the order in which they were halved."""
    def tree(a: int, b: int) -> list[int]:
        if (a, b) in known:
            return known[a, b]
        m = (a + b) // 2
        return join(c, text[a:b], m - a, tree(a, m), tree(m, b))

    known = {(a, b): ids for a, b, ids in parts}
    return tree(0, len(text)) if text else []


RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


def _digests(path, special, leaf, ids_out):
    def run(col: pd.Series) -> pd.DataFrame:
        c, out = codec(path, special), []
        for t in col:
            ids = c.encode(t or "")
            out.append((*c.digest(ids), *([ids] if ids_out else [])))
        return pd.DataFrame(out, columns=NAMES + ["ids"] * ids_out)
    return run


NAMES = ["n_tokens", "ids_sha256", "decoded_sha256"]


def encode(docs: DataFrame, path: str, special: dict[str, int], leaf: int = LEAF, with_ids: bool = False, text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``n_tokens``, ``ids_sha256``, ``decoded_sha256`` and, if asked for, ``ids``.

    ``path`` names a file of base64 tokens and ranks that every node can open; strings of
    ``special`` in a text become their token.  Texts of at most ``leaf`` code points are one leaf.
    Longer ones are taken once for each different text, cut into leaves that are encoded by tasks of
    their own, and joined by a tree.  Missing and empty texts have no tokens.  Columns of ``docs``
    that bear the name of a result are replaced; repeated rows stay repeated.
    """
    new = NAMES + ["ids"] * with_ids
    marks, kinds = tuple(sorted(special.items())), RESULT + ", ids array<int>" * with_ids
    old = [x for x in docs.columns if x not in new]
    docs, text = docs.select(*old), F.col(text_col)
    long = F.coalesce(F.length(text) > leaf, F.lit(False))
    short = (docs.where(~long).withColumn("__r", F.pandas_udf(_digests(path, marks, leaf, with_ids), kinds)(text))
             .select(*old, *[F.col(f"__r.{x}").alias(x) for x in new]))

    texts = docs.where(long).select(text.alias("text")).groupBy(F.sha2("text", 256).alias("key")).agg(F.any_value("text").alias("text"))

    @F.pandas_udf("array<struct<a: int, b: int, part: string>>")
    def halves(col: pd.Series) -> pd.Series:
        return col.map(lambda t: [{"a": a, "b": b, "part": t[a:b]} for a, b in leaves(len(t), leaf)])

    @F.pandas_udf("binary")
    def encoded(col: pd.Series) -> pd.Series:
        c = codec(path, marks)
        return col.map(lambda t: np.array(c.encode(t), np.int32).tobytes())

    def whole(pdf: pd.DataFrame) -> pd.DataFrame:
        c, pdf = codec(path, marks), pdf.sort_values("a")
        ids = concatenate(c, "".join(pdf["part"]), [(a, b, np.frombuffer(x, np.int32).tolist())
                                                   for a, b, x in zip(pdf["a"], pdf["b"], pdf["ids"])])
        return pd.DataFrame([(pdf["key"].iloc[0], *c.digest(ids), *([ids] if with_ids else []))], columns=["key", *new])

    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), 1)
    cut = texts.select("key", F.explode(halves("text")).alias("x")).select("key", "x.a", "x.b", "x.part")
    coded = cut.repartition(n, "key", "a").withColumn("ids", encoded("part"))
    joined = write_once(coded.groupBy("key").applyInPandas(whole, f"key string, {kinds}"), "long_texts")
    rest = (docs.where(long).withColumn("__key", F.sha2(text, 256)).join(joined.withColumnRenamed("key", "__key"), "__key")
            .select(*old, *new))
    return short.unionByName(rest)
