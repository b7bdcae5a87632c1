"""Cases in which a part of the job was once left out."""

import random

import numpy as np
import pytest

import corpus_pipeline
from quillwave.llm import language_id, line_templates


def name(k, n):
    return "".join(chr(97 + k // 26**i % 26) for i in range(n))


@pytest.mark.parametrize("k", [6, 40])
def test_line_fields_at_two_sizes(spark, k):
    """Two fields of k values each, in k * k documents: with 40, each value is frequent and each combination rare."""
    rows = [(i, f"{name(i, 4)} {name(i * 7, 5)} own words here {i} " * 12 + f"\nThis page was printed for N{name(i % k, 2)} of C{name(i // k, 2)}") for i in range(k * k)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert line_templates.line_dedup(docs, spare_copies=True).where("n_dropped = 1 and text not like '%printed%'").count() == k * k


def test_short_pages_lose_boilerplate_and_copies_stay(spark):
    """Pages that are half boilerplate lose it; near copies whose lines recur stay whole, as the next stage judges them."""
    head, foot = "Welcome to the pages of our club", "Released under the terms of some free license"
    pages = [(i, f"{head}\n" + " ".join(name(i * 31 + j * 977, 4) for j in range(16)) + f"\n{foot}") for i in range(40)]
    body = "\n".join(" ".join(f"{name(j * 53 + m, 3)}body" for m in range(12)) for j in range(8))
    copies = [(100 + i, f"{body}\nread by {name(i, 3)} only today") for i in range(20)]
    out = {r["doc_id"]: r for r in line_templates.line_dedup(spark.createDataFrame(pages + copies, "doc_id long, text string"), spare_copies=True).collect()}
    assert all(out[i]["text"] == t.split("\n")[1] and out[i]["n_dropped"] == 2 for i, t in pages)
    assert all(out[i]["text"] == t and out[i]["n_dropped"] == 0 for i, t in copies)


def test_unknown_languages_and_junk_are_rejected(spark):
    """Each language left out once, and noise: rejected, while held-out texts of the known ones stay."""
    rnd = random.Random(5)
    words = {k: ["".join(rnd.choice(a) for _ in range(rnd.randrange(2, 8))) for _ in range(300)] for k, a in {"aa": "abcdefgh", "bb": "fghijklm", "cc": "klmnopqr"}.items()}
    rows = [(i, " ".join(rnd.choice(words[k]) for _ in range(60)), k) for i, k in enumerate(rnd.choice(list(words)) for _ in range(1800))]
    junk = [(9000 + i, "".join(rnd.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(300)), None) for i in range(50)]
    for left in words:
        df = spark.createDataFrame([(i, t, k if k != left else None) for i, t, k in rows] + junk, "doc_id long, text string, lang string")
        out = {r["doc_id"]: r for r in language_id.language_id(df).collect()}
        assert np.mean([out[i]["rejected"] for i, _, k in rows if k == left]) > 0.95
        assert np.mean([out[i]["rejected"] for i, _, _ in junk]) > 0.95
        assert np.mean([out[i]["rejected"] for i, _, k in rows if k != left and out[i]["held_out"]]) < 0.02


def test_one_row_of_each_component(spark):
    """Repeated rows, null ids, and one id with two texts, one of them a copy of another document."""
    a, b, c, d = (" ".join(name(k * 10_007 + j * 631, 4) for j in range(40)) for k in range(4))
    rows = [(5, a), (5, a), (5, a), (None, b), (None, b), (None, c), (7, a), (7, d), (8, c), (9, f"{d} end")]
    got = corpus_pipeline.one_of_each(spark, spark.createDataFrame(rows, "doc_id long, text string").repartition(3), "")
    assert got.columns == ["doc_id", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(5, a), (None, b), (None, c), (7, d)], key=str)
