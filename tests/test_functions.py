"""Scalar expressions against plain Python."""

import random

from pyspark.sql import functions as F

from quillwave.functions import paths, text, times

BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0       　"
QUOTES = "'\"‘’“”「」『』"


def values(spark, items, *columns):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(items)], "i int, x string")
    return [r[1:] for r in df.select("i", *columns).orderBy("i").collect()]


def hostile(n, alphabet, seed=1):
    rnd = random.Random(seed)
    return ["".join(rnd.choice(alphabet) for _ in range(rnd.randrange(12))) for _ in range(n)]


def test_strip_and_names(spark):
    items = hostile(1500, BLANKS + QUOTES + "ab_*(" + "​")

    def clean(x):
        out, run = [], False
        for c in x:
            if c in BLANKS or c in QUOTES:
                out += [] if run else ["_"]
                run = True
            else:
                out.append(c)
                run = False
        return "".join(out).strip("_") or "_"

    got = values(spark, items, text.strip("x"), text.clean_name("x"), text.skipped("x"))
    assert got == [(x.strip(), clean(x), x.strip().startswith(("*", "("))) for x in items]
    assert values(spark, [clean(x) for x in items], text.clean_name("x")) == [(clean(x),) for x in items]


def test_times(spark):
    ms = [0, 1, 999, 1000, 1001, 59_999, 3_600_000, 359_999_999, 360_000_000, 4_000_000_123]
    got = values(spark, map(str, ms), times.clock(F.col("x").cast("long")), times.srt_ms(times.clock(F.col("x").cast("long"))))
    assert got == [(f"{m // 3600000:02d}:{m // 60000 % 60:02d}:{m // 1000 % 60:02d},{m % 1000:03d}", m) for m in ms]
    assert values(spark, ["0:00:01.5", "1:02:03.50", "0:00:00.123", "0:00:07", "x", "1:2", None], times.ass_ms("x")) == [
        (1050,), (3723500,), (1230,), (7000,), (None,), (None,), (None,)
    ]


def test_paths(spark):
    items = [x for x in hostile(800, "a.b/ ", 2) if x.strip("/.") and not x.endswith("/") and "/./" not in f"/{x}" and not x.endswith("/.")]
    items += [".bashrc", "a.", "a.tar.gz", "..b", "x/y.wav", "wavs/é.WAV"]
    got = values(spark, items, paths.stem("x"), paths.suffix("x"))
    names = [x.rpartition("/")[2] for x in items]
    want = []
    for n in names:
        dot = n.rfind(".")
        ok = 0 < dot < len(n) - 1
        want.append((n[:dot], n[dot:]) if ok else (n, ""))
    assert got == want
    assert values(spark, ["x/y.wav", "z.srt"], paths.with_suffix("x", ".wav"), paths.parent("x")) == [("x/y.wav", "x"), ("z.wav", "")]


def test_small_texts(spark):
    assert values(spark, [r"{\an8}a\Nb {x}", "  c "], text.ass_text("x")) == [("a b",), ("c",)]
    assert values(spark, ["a(\nb\n)", "“\nx\n”"], text.tidy_breaks("x")) == [("a\n(b)\n",), ("\n“x”\n",)]
    assert values(spark, ["", "a ", "a(", "a"], text.breaks("x")) == [(True,), (True,), (True,), (False,)]
    halves = [(n + 0.5) for n in range(9)]
    assert [r[0] for r in values(spark, map(str, halves), text.half_even(F.col("x").cast("double")))] == [round(h) for h in halves]
    assert values(spark, ["/a/b", "c/d", "s3://x/y"], paths.absolute("x", "/r/"), paths.relative("x", "/a")) == [("/a/b", "b"), ("/r/c/d", "c/d"), ("s3://x/y", "s3://x/y")]
    assert values(spark, ["1.5", "0.0005", "3661.9996"], times.clock_of_seconds(F.col("x").cast("double"))) == [("00:00:01,500",), ("00:00:00,000",), ("01:01:02,000",)]
    assert values(spark, [None], text.strip("x"), text.clean_name("x")) == [(None, None)]
