"""Ordered computations against brute force, with one group holding most rows."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import ordering
from millrace.operators import aggregates, batches, windows
from millrace.ordering import with_running

random.seed(7)
ROWS = [("hot" if i % 4 else f"g{i % 7}", i // 3, i, random.choice([None, 1, 2, 5, 9])) for i in range(400)]
SLICES = {"hot slices": lambda: F.floor(F.col("t") / 40), "sliced": lambda: F.floor(F.col("t") / 10), "one slice": lambda: F.lit(0), "ranged": lambda: None}


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(random.sample(ROWS, len(ROWS)), "g string, t bigint, id bigint, v bigint")


def brute(descending):
    out = {}
    for g in {r[0] for r in ROWS}:
        total, top, last, before = None, None, None, None
        for n, (_, _, i, v) in enumerate(sorted((r for r in ROWS if r[0] == g), key=lambda r: r[1:3], reverse=descending)):
            total = total if v is None else (total or 0) + v
            top = top if v is None else max(v, top or v)
            last = last if v is None else v
            out[i] = (n, total or 0, top, last, before)
            before = v
    return out


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("slices", list(SLICES))
def test_running(df, slices, descending, monkeypatch):
    if slices == "hot slices":
        # Slices of the hot group hold about 90 rows, those of the others fewer than 10.
        monkeypatch.setattr(ordering, "SLICE_ROWS", 50)
    got = with_running(df, ["g"], [F.col("t"), F.col("id")], position="n", sums={"s": F.col("v")}, maxima={"m": F.col("v")},
                       latest={"l": F.col("v")}, previous={"p": F.col("v")}, slice_by=SLICES[slices](), descending=descending)
    assert {r["id"]: (r["n"], r["s"] or 0, r["m"], r["l"], r["p"]) for r in got.collect()} == brute(descending)


def test_running_keeps_columns_and_rows(df):
    got = with_running(df, ["g"], [F.col("t"), F.col("id")], position="n", slice_by=F.col("t"))
    assert got.columns == ["g", "t", "id", "v", "n"] and got.count() == len(ROWS)


def test_no_task_gets_a_hot_group(df, monkeypatch):
    monkeypatch.setattr(ordering, "SLICE_ROWS", 50)
    for slice_by in (F.lit(0), F.floor(F.col("t") / 40), None):
        rows = ordering._sliced(df, ["g"], [F.col("t"), F.col("id")], slice_by)
        sizes = [r["count"] for r in rows.groupBy("g", "_slice", "_part").count().collect()]
        assert sum(sizes) == len(ROWS) and max(sizes) < 100


def test_null_group_is_an_error(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2)], "g string, t bigint")
    with pytest.raises(Exception, match="a group column is null"):
        with_running(df, ["g"], [F.col("t")], position="n", slice_by=F.col("t")).collect()


@pytest.mark.parametrize("page_size", [1, 3, 1000])
def test_collect_is_whole(df, page_size):
    pages = aggregates.collect(df, ["g"], "id", [F.col("t"), F.col("id")], "list", page_size, F.col("t")).collect()
    assert all(len(p["items"]) <= page_size for p in pages)
    hot = [i for p in sorted((p for p in pages if p["g"] == "hot"), key=lambda p: p["page"]) for i in p["items"]]
    assert hot == [r[2] for r in sorted(ROWS, key=lambda r: r[1:3]) if r[0] == "hot"]


@pytest.mark.parametrize("page_size, levels", [(2, 10), (7, 4), (1000, 1)])
def test_fold(df, page_size, levels):
    text = df.withColumn("x", F.col("id").cast("string"))
    got = aggregates.fold(text, ["g"], "x", [F.col("t"), F.col("id")], lambda a, b: F.concat(a, F.lit(","), b),
                          slice_by=F.col("t"), page_size=page_size, levels=levels)
    for r in got.collect():
        assert r["x"] == ",".join(str(i) for g, _, i, _ in sorted(ROWS, key=lambda r: r[1:3]) if g == r["g"])


def buffered(sizes_and_times, count, limit, idle):
    """The sequential rule, one message at a time."""
    starts, open_count, used, last = [], 0, 0, None
    for n, (size, ms) in enumerate(sizes_and_times):
        need = size + 4
        if open_count and (ms - last >= idle or used + need > limit):
            open_count, used = 0, 0
        if not open_count:
            begin = n
        open_count, used, last = open_count + 1, used + need, ms
        starts.append(begin)
        if open_count >= count or used >= limit:
            open_count, used = 0, 0
    return starts


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("count, limit, idle, chunk", [(5, 60, 40, 7), (3, 10_000, 10_000, 3), (50, 90, 25, 50), (1, 30, 5, 20)])
def test_buffer(spark, seed, count, limit, idle, chunk):
    rng = random.Random(seed)
    rows, ms = {"hot": [], "cold": []}, 0
    for i in range(160):
        ms += rng.choice([0, 1, 5, 30])
        rows["cold" if i % 5 == 0 else "hot"].append((i, ms, rng.choice([0, 3, 10, 26, 80])))
    flat = [(g, i, ms, "x" * size) for g, rs in rows.items() for i, ms, size in rs]
    df = spark.createDataFrame(flat, "g string, id bigint, ms bigint, value string").withColumn("timestamp", F.timestamp_millis("ms"))
    got = batches.buffer(df, ["g"], [F.col("ms"), F.col("id")], count, limit, idle, F.floor(F.col("ms") / 50), chunk)
    found = {g: [r["batch"] for r in sorted(got.collect(), key=lambda r: r["position"]) if r["g"] == g] for g in rows}
    assert found == {g: buffered([(size, ms) for _, ms, size in rs], count, limit, idle) for g, rs in rows.items()}


def test_hello_windows(spark):
    """Three, none and four hellos in successive windows."""
    at = [0, 1, 2, 20, 21, 22, 23]
    df = spark.createDataFrame([("all", s, "Hello") for s in at], "k string, s int, text string")
    df = df.withColumn("timestamp", F.timestamp_seconds("s"))
    joined = windows.concat(df, "10 seconds", "text", [F.col("timestamp"), F.col("s")], keys=["k"], slice_by=F.col("s"))
    filled = windows.fill_gaps(joined, "10 seconds", {"text": "", "page": 0}, ["k"])
    assert [r["text"] for r in filled.orderBy("start").collect()] == ["Hello" * 3, "", "Hello" * 4]
