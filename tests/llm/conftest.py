"""Documents with every kind of odd row, for all operators."""

import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SF = "/root/testdata/sf0.001"
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, size int, fp string, block int, score string, "
    "label long, d int, body string"
)


def _words(rnd, n, alphabet="abcdefgh"):
    return " ".join("".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def odd_rows():
    rnd = random.Random(7)
    passage = _words(rnd, 60)
    texts = [
        (1, "The quick brown fox jumps over the lazy dog again and again"), (2, None), (3, ""), (4, " \t\n\x0b\x0c\r "),
        (5, "!!! ... 123 456"), (6, passage), (7, passage), (7, passage), (8, _words(rnd, 30) + " " + passage + "\n" + _words(rnd, 30)),
        (None, passage), (None, None), (9, _words(rnd, 9000)), (10, "x" * 70_000), (11, "a b " * 400),
        (11, "other text under the same id, MIT License here"), (12, "naïve café ÉCOLE ñandú ß 漢字 😀 ▁ <s> <|endoftext|> \x00  "),
        (13, "SPDX-License-Identifier: (MIT OR Apache-2.0) AND GPL-2.0-only WITH x\napache license\nGeneral Public License"),
        (14, passage.upper()), (15, "one two three"), (16, "line\nline\nline\n\nother # $ | >"),
    ]
    return [
        (i, t, ["en", None, "fr"][k % 3], ["a", None, "b", "a"][k % 4], None if t is None else len(t), k, "x", None, "s", 5, k % 2, "y")
        for k, (i, t) in enumerate(texts)
    ]


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    """Odd rows with extra columns whose names clash with those that the operators use inside."""
    return spark.createDataFrame(odd_rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(1, 1), (5, 0), (8, 1), (9, 1), (9, 1), (10, 0), (16, 0), (16, 1), (None, 1), (15, None), (14, 7)], "doc_id long, quality int")


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
