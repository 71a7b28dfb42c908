"""Documents with every kind of difficulty, as fixtures."""

import random

import pytest

SCHEMA = "n_words string, doc_id long, text string, lang string, source string, kept int, edge string"


def made_up():
    """Documents with each kind of difficulty: NULLs, empty and long texts, ties, repeated rows, shared passages."""
    pick = random.Random(5)
    word = lambda: "".join(pick.choice("abcdefgABC") for _ in range(pick.randint(1, 6)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, line = text(70), "A line that very many documents share \t"
    near = text(120).split(" ")
    docs = [(i, text(pick.randint(1, 150))) for i in range(40)]
    docs += [(100 + i, f"{text(30)}\n{line}\n{passage}\n{text(20)}") for i in range(12)]
    docs += [(200 + i, f"{text(3)}\n  {line.upper()}\r\nshort") for i in range(8)]
    for i in range(12):
        copy = list(near)
        copy[pick.randrange(len(copy))] = word()
        docs.append((300 + i, " ".join(copy)))
    docs += [(400 + i, " ".join(near)) for i in range(6)]
    docs += [(500, None), (501, ""), (502, " \t\n "), (503, "\n\n"), (504, "one"), (505, "ONE"), (None, passage), (None, None)]
    docs += [(None, " ".join(near)), (506, passage), (506, passage), (506, passage), (507, text(60)), (507, text(60) + " " + passage)]
    docs += [(600, text(20_000) + "\n" + passage), (601, "x" * 30_000), (602, "é ü 日本   " * 40), (603, passage + " " + passage)]
    docs += [(604, "\n".join([line] * 5 + [line.strip()])), (605, f"{line}\n\n{line}"), (-1, passage), (-2, " ".join(near[:60]))]
    return docs


@pytest.fixture(scope="session")
def docs():
    return made_up()


@pytest.fixture(scope="session")
def frame(spark, docs):
    """The documents with columns whose names the operators use themselves, over several partitions."""
    rows = [("w", i, t, pick, "s", 7, "e") for (i, t), pick in zip(docs, ["en", "de", None] * len(docs))]
    return spark.createDataFrame(rows, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def none(frame):
    return frame.where("false")

