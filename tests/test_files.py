"""Files and renames of jobs that fail or lose their driver."""

import pytest
from pyspark.sql import functions as F

from quillwave.operators import naming
from quillwave.sinks import files


def names(folder):
    return {str(p.relative_to(folder)): p.read_text() for p in folder.rglob("*") if p.is_file()}


def test_nothing_of_failed_attempts(spark, tmp_path):
    """A failing task publishes nothing; what an attempt that doesn't count has written goes."""
    out = tmp_path / "out"
    rows = spark.range(40).selectExpr("concat('d', id % 3, '/f', id) name", "repeat(string(id), 5) content").repartition(4)
    bad = rows.unionByName(spark.createDataFrame([("../leaves", "x")], "name string, content string"))
    with pytest.raises(Exception, match="leaves its folder"):
        files.write_files(bad, str(out))
    assert names(out) == {}
    with pytest.raises(ValueError, match="have the name"):
        files.write_files(rows.unionByName(rows.limit(1)), str(out))
    assert names(out) == {}
    folder, wanted = f"file://{out}", rows.withColumn("content", F.col("content").cast("binary"))
    manifest = files.staged(wanted, folder, "t")
    files.staged(wanted.withColumn("content", F.lit(b"part")), folder + "/.quillwave-files-t", "late")  # another attempt's files
    files.publish(manifest, folder, "t")
    files.publish(manifest, folder, "t")  # once more, as a retried task would
    files._removed(f"{folder}/{files.STAGED}t")
    assert names(out) == {f"d{i % 3}/f{i}": str(i) * 5 for i in range(40)}
    assert files.write_files(rows.withColumn("content", F.lit("new")), folder) == (40, 120)
    assert set(names(out).values()) == {"new"} and len(names(out)) == 40
    assert files.write_files(rows.limit(0), str(out)) == (0, 0)


def test_bare_folder_on_a_cluster(spark):
    class Elsewhere:
        sparkContext = type("Context", (), {"master": "spark://host:7077"})()

    with pytest.raises(ValueError, match="own disk"):
        files.located(Elsewhere(), "/data")
    assert files.located(Elsewhere(), "hdfs://a/b/") == "hdfs://a/b"


def plan_of(spark, folder, asked):
    df = spark.createDataFrame([(f"d/{n}", i) for i, n in enumerate(asked)], "path string, pos long")
    return naming.rename_plan(df, df.select("path"))


OLD = ["a b.txt", "'a_c'.txt", "x.txt", " q.txt", "gone away.txt"]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "d").mkdir()
    for n in OLD[:4]:
        (tmp_path / "d" / n).write_text(n)
    return tmp_path


def test_names_taken_since(spark, folder):
    plan = plan_of(spark, folder, OLD)
    (folder / "d" / "a_b.txt").write_text("precious")
    got = files.apply_renames(plan, f"file://{folder}")
    assert got == {"renamed": 2, "exists": 1, "missing": 1, "unchanged": 1}
    assert names(folder) == {"d/a b.txt": "a b.txt", "d/a_b.txt": "precious", "d/a_c.txt": "'a_c'.txt", "d/x.txt": "x.txt", "d/q.txt": " q.txt"}


def chain(spark):
    """u -> v -> w -> x, and x is there: none can move; 1 -> 2 -> 3 can."""
    rows = [("d", "u", "v"), ("d", "v", "w"), ("d", "w", "x"), ("d", "1", "2"), ("d", "2", "3")]
    return spark.createDataFrame([(*r, r[2], "renamed") for r in rows], "folder string, old string, new string, target string, status string")


def test_refusals_pass_along(spark, tmp_path):
    (tmp_path / "d").mkdir()
    for n in "uvwx12":
        (tmp_path / "d" / n).write_text(n)
    assert files.apply_renames(chain(spark), str(tmp_path)) == {"renamed": 2, "exists": 3, "unchanged": 0}
    assert names(tmp_path) == {**{f"d/{n}": n for n in "uvwx"}, "d/2": "1", "d/3": "2"}


@pytest.mark.parametrize("back", [False, True])
@pytest.mark.parametrize("lost", ["before", "aside", "between", "into"])
def test_lost_driver(spark, tmp_path, monkeypatch, lost, back):
    """The driver goes at each step; what it began is ended or taken back, with chains of names."""
    (tmp_path / "d").mkdir()
    for n in "uvw12":
        (tmp_path / "d" / n).write_text(n)
    before, after = {f"d/{n}": n for n in "uvw12"}, {"d/v": "u", "d/w": "v", "d/x": "w", "d/2": "1", "d/3": "2"}

    class Lost(Exception):
        pass

    def gone(*_):
        raise Lost

    by_task, calls = files._by_task, []

    def half(rows, columns, root, act):
        """The job runs over some rows, and the driver goes."""
        calls.append(act)
        if (lost, act) in (("aside", files._aside), ("into", files._into)):
            by_task(rows.where("old in ('d/v', 'd/1')"), columns, root, act).collect()
            raise Lost
        return by_task(rows, columns, root, act)

    with monkeypatch.context() as m:
        m.setattr(files, "_by_task", half)
        mark = files._mark
        if lost == "before":
            m.setattr(files, "_mark", gone)
        elif lost == "between":
            m.setattr(files, "_mark", lambda root, token, phase: gone() if phase == "aside" else mark(root, token, phase))
        with pytest.raises(Lost):
            files.apply_renames(chain(spark), f"file://{tmp_path}")
    out = files.resume_renames(spark, f"file://{tmp_path}", back)
    if lost == "before":
        assert out == {} and names(tmp_path) == before
    else:
        assert out == ({"restored": 5} if back else {"renamed": 5})
        assert names(tmp_path) == (before if back else after)
    assert files.resume_renames(spark, str(tmp_path)) == {}
