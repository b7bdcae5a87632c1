"""Documents with every odd case, and plain Python versions of what operators compute."""

import random

import pytest

SCHEMA = "doc_id long, text string, lang string, h string, n int, rest string, d int, n_words string, shard string, length string"


def prose(rnd, n, vocabulary=400):
    return " ".join(f"w{int(rnd.random() ** 2 * vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    rnd = random.Random(4)
    out = [None, "", "   \n\t ", "one", "two words", "!!! ... 123", "É è ß 漢字 😀 <|endoftext|> x", "a" * 5000]
    base = [prose(rnd, rnd.choice([3, 12, 60, 200, 400])) for _ in range(60)]
    out += base
    out += [base[i] for i in (0, 3, 3, 7)] + [base[9].upper()]
    big = prose(rnd, 200, 100_000)
    for k in range(60):  # near copies, from hardly to heavily edited
        words = big.split(" ")
        for _ in range(k // 4):
            words[rnd.randrange(len(words))] = f"edit{rnd.random()}"
        out.append(" ".join(words))
    passage = prose(rnd, 55, 100_000)
    out += [f"{prose(rnd, 30, 100_000)} {passage} {prose(rnd, 30, 100_000)}" for _ in range(40)]
    out += [f"{prose(rnd, 25, 100_000)}\nThis page was printed on day {k}\n{prose(rnd, 25, 100_000)}" for k in range(30)]
    out += [prose(rnd, 20_000, 50_000), " ".join(["same"] * 3000), prose(rnd, 4, 10), prose(rnd, 5, 10)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    langs = ["en", "fr", None]
    rows = [(i * 3 + 1, t, langs[i % 3], "clash", i, "r", 0, "n", "s", "l") for i, t in enumerate(texts)]
    rows += [rows[9], rows[70], (None, prose(random.Random(8), 30), None, "x", 1, "r", 0, "n", "s", "l"), (None, None, None, "x", 1, "r", 0, "n", "s", "l")]
    return spark.createDataFrame(rows, SCHEMA).repartition(6)


@pytest.fixture(scope="session")
def rows(docs):
    return [(r["doc_id"], r["text"]) for r in docs.collect()]
