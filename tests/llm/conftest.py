import os
import random

import pytest

SF = "/root/testdata/sf0.001"
DOC = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the of and a to in is was for ünder naïve straße x1 42 2024-01-05 <b> # ** foo|bar".split()


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ing", ".", ",", "q", "zz", "ed"]) for _ in range(n))


def odd_documents():
    """Nulls in each column, empty and long texts, ties, copies, repeated rows, odd spaces and signs."""
    rng = random.Random(5)
    base = [prose(rng, n) for n in (1, 3, 7, 19, 20, 60, 130, 400)]
    passage = prose(rng, 70)
    line = "All rights are reserved by the owners of this page, 2020."
    texts = [None, "", " \t\n", "\n\n", *base, base[5], base[6], base[6][:-4] + " end", base[7] + " " + prose(rng, 3),
             f"{prose(rng, 30)}\n{passage}\n{prose(rng, 9)}", f"{passage} {prose(rng, 12)}", f"{prose(rng, 55)} {passage}",
             prose(rng, 3000), "a" * 40_000, "é" * 20_000 + " x" * 9_000, "tab\tand\x0bvertical\x0cfeed\r\nline", "no break space",
             "<|endoftext|> in a text<|endoftext|>", "spam " * 300, "\n".join([line] * 3 + [prose(rng, 5)])]
    texts += [f"{prose(rng, 25)}\n{line.replace('2020', str(2000 + i))}\n{prose(rng, 25)}" for i in range(8)]
    rows = [(i * 3, t, ["en", None, "de"][i % 3], [None, "hot", "hot", "hot", "b", ""][i % 6], None if t is None else len(t)) for i, t in enumerate(texts)]
    rows += [rows[9], rows[9], (rows[10][0], "same id, other text " + prose(rng, 60), "en", "b", 1), (None, base[7], "en", "hot", 5),
             (None, None, None, None, None), (-7, base[6], "en", "hot", 4)]
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    return spark.createDataFrame(odd_documents(), DOC).repartition(5).cache()


@pytest.fixture(scope="session")
def small(spark):
    if not os.path.isdir(SF):
        pytest.skip("test tables absent")
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], DOC)


def clashing(docs, names):
    """``docs`` with extra columns that bear the names of results and of helpers."""
    from pyspark.sql import functions as F

    return docs.select("*", *[F.lit("extra").alias(n) for n in names if n not in docs.columns])
