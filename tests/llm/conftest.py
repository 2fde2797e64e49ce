import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id string, part int"


def row(doc_id, text, lang="en", source="a"):
    return (doc_id, text, lang, source, None if text is None else len(text), "clash", 7)


@pytest.fixture(scope="session")
def corpus():
    """Invented documents with nulls, empty and long texts, ties, copies, repeated rows and shared passages."""
    rng = random.Random(5)
    syllables = "ka lo mi ter an do vel sun ri po".split()
    vocabulary = ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 3))) for _ in range(200)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    passage, line = prose(60), "Same line of every page here."
    docs = [row(i, prose(rng.randint(1, 150)), rng.choice(["en", "fr", None]), rng.choice(["a", "b", "c", None])) for i in range(40)]
    docs += [row(100 + i, f"{prose(20)}\n{line}\n{passage} {prose(15)}\n{line}", "en", "a") for i in range(6)]
    copy = prose(80)
    docs += [row(200 + i, copy, "en", "hot") for i in range(12)]
    words = prose(120).split()
    for i in range(8):
        changed = list(words)
        changed[i * 7] = "odd"
        docs.append(row(300 + i, " ".join(changed), "fr", "b"))
    docs += [
        row(400, None), row(401, ""), row(402, " \t\n"), row(403, "x"), row(404, "é" * 150), row(405, "ab" * 400),
        row(406, "a" * 500 + prose(30)), row(407, prose(9000)), row(408, "漢字 仮名 😀 " * 30), row(409, "<|endoftext|> it's DON'T."),
        row(None, prose(40)), row(None, copy), row(410, "tie"), row(410, "tie"), row(410, "other tie"), row(411, prose(40), None, None),
    ]
    rng.shuffle(docs)
    return docs


@pytest.fixture(scope="session")
def docs(spark, corpus):
    return spark.createDataFrame(corpus, SCHEMA).repartition(5)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)
