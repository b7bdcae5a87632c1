"""Different texts that weak hashes take for equal, and the shared folder."""

import pytest
from pyspark.sql import functions as F

from quillwave.llm import shared
from quillwave.llm.line_templates import line_dedup
from quillwave.llm.ngram_join import ngram_join
from quillwave.llm.substring_dedup import substring_dedup


def parities(n, letters):
    return "".join(letters[bin(i).count("1") % 2] for i in range(n))


ONE, OTHER = parities(1024, "ab"), parities(1024, "ba")  # equal under any polynomial hash modulo 2^64


def test_words_of_equal_polynomials(spark):
    rows = [(1, ONE), (2, OTHER), (3, " ".join([ONE] + [f"w{k}" for k in range(19)])), (4, " ".join([OTHER] + [f"w{k}" for k in range(19)]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert all(r["n_removed"] == 0 for r in substring_dedup(docs).collect())
    assert {r["doc_id"]: r["component_id"] for r in ngram_join(docs).collect()} == {1: 1, 2: 2, 3: 3, 4: 3}  # 3 and 4 share 15 of 17


def test_runs_of_equal_polynomials(spark):
    """The same with whole words in the place of letters, in windows longer than the sequence."""
    a, b = (" ".join({"a": "red", "b": "blue"}[x] for x in t) for t in (ONE, OTHER))
    docs = spark.createDataFrame([(1, f"{a} end"), (2, f"{b} end")], "doc_id long, text string")
    assert all(r["n_removed"] == 0 for r in substring_dedup(docs, window=1025).collect())


def test_rows_of_one_id_with_equal_short_hashes(spark):
    base = " ".join(f"w{k}" for k in range(19))
    twice, once = f"{base} x21449 {base} x21449", f"{base} y67629 {base} z67629"
    docs = spark.createDataFrame([(None, twice), (None, once)], "doc_id long, text string")
    assert docs.select(F.hash("text")).distinct().count() == 1
    got = {r["text"] == twice or r["n_removed"] > 0: r["n_removed"] for r in substring_dedup(docs).collect()}
    assert got == {True: 20, False: 0}
    lines = spark.createDataFrame([(None, t.replace(" w0 ", "\n")) for t in (twice, once)] + [(9, None), (9, "")], "doc_id long, text string")
    assert line_dedup(lines, min_docs=2).where("doc_id is null and n_dropped > 0").count() == 0
    assert {tuple(r) for r in line_dedup(lines, min_docs=2).where("doc_id = 9").select("text", "n_lines").collect()} == {(None, 0), ("", 1)}


class _Conf(dict):
    def set(self, k, v):
        self[k] = v


class _Session:
    def __init__(self, master):
        self.conf = _Conf()
        self.sparkContext = type("Context", (), {"master": master, "applicationId": "app"})()


def test_shared_folder_without_the_setting():
    here = _Session("local[4]")
    assert shared.shared_dir(here).rsplit("/", 1)[0] == shared.shared_dir(here).rsplit("/", 1)[0]
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            shared.shared_dir(_Session(master))
    named = _Session("yarn")
    named.conf[shared.SHARED_DIR] = "hdfs://x/y/"
    assert shared.shared_dir(named).startswith("hdfs://x/y/quillwave-")
    named.conf[shared.CHECKPOINT_DIR] = "hdfs://z"
    assert shared.shared_dir(named).startswith("hdfs://z/quillwave-")


def test_written_tables_without_the_setting(spark, monkeypatch, tmp_path):
    """The settings' absence in a real session: the operators still run, and finished tables go."""
    monkeypatch.setattr(shared, "CHECKPOINT_DIR", "quillwave.no.such.setting")
    spark.conf.set(shared.SHARED_DIR, f"file://{tmp_path}")
    try:
        docs = spark.createDataFrame([(i, "a b c d e f") for i in range(4)], "doc_id long, text string")
        assert {r["component_id"] for r in ngram_join(docs).collect()} == {0}
        path = shared.shared_dir(spark)
        shared.persisted(docs, path)
        shared.dropped(spark, path)
        assert not (tmp_path / path.rsplit("/", 1)[1]).exists() and len(list(tmp_path.iterdir())) > 3
    finally:
        spark.conf.unset(shared.SHARED_DIR)
