"""Small texts with copies, passages and odd cases, and plain Python for what the operators should find."""

import random
import re

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
                   StructField("source", StringType()), StructField("n_chars", LongType()), StructField("score", StringType()),
                   StructField("g", StringType())])


def plain_words(text, lower=False):
    return re.findall("[^\x20\x09-\x0d]+", (text or "").translate(LOW) if lower else text or "")


def corpus():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdeéß") for _ in range(draw.randint(2, 7))) for _ in range(300)]
    passage = " ".join(draw.choice(vocabulary) for _ in range(60))
    base = [draw.choice(vocabulary) for _ in range(150)]
    texts = [None, "", " \t\n", "one", "One", "two words", "a b c d", "A b C d", "x " * 400, "one\n\nline\nline", "\x0b tab\x0cfeed \r\n end"]
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(5, 120))) for _ in range(25)]
    for k in range(24):  # a family of near copies
        copy = list(base)
        for _ in range(k % 9):
            copy[draw.randrange(len(copy))] = draw.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 8
    for k in range(20):  # one passage in unlike texts
        words = [draw.choice(vocabulary) for _ in range(30)]
        texts.append(" ".join(words[:k]) + "\n" + passage + " " + " ".join(words[k:]))
    texts += [" ".join(draw.choice(vocabulary) for _ in range(6000))]
    rows = [(i, t, "en", None if i % 7 == 0 else f"src{i % 5}", len(t) if t else 0, "clash", "clash") for i, t in enumerate(texts)]
    draw.shuffle(rows)
    return rows


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture
def small_groups(monkeypatch):
    from skillframe.llm import groups

    monkeypatch.setattr(groups, "GROUP_BYTES", 4000)
    monkeypatch.setattr(groups, "BUCKET_BYTES", 9000)
