import random
import statistics

from pyspark.sql import functions as F

from sparkcurate.operators import scale, stats


def groups(seed, sizes, floats=False):
    rng = random.Random(seed)
    draw = (lambda: rng.choice([-1, 1]) * 10 ** rng.uniform(-6, 6)) if floats else (lambda: rng.randint(0, 60_000))
    return [(g, draw()) for g, n in sizes.items() for _ in range(n)]


def test_exact_median_matches_statistics(spark):
    for floats in (False, True):
        rows = groups(1, {"a": 1, "b": 2, "c": 3, "hot": 700}, floats)
        df = spark.createDataFrame(rows, "g string, x double" if floats else "g string, x bigint")
        got = {r.g: r.median for r in scale.exact_median(df, "g", "x", integral=not floats).collect()}
        want = {g: statistics.median([x for k, x in rows if k == g]) for g in got}
        assert len(got) == 4
        assert all(abs(got[g] - want[g]) < 1e-9 for g in want)


def test_exclusive_quartiles_match_statistics(spark):
    rows = groups(2, {"a": 3, "b": 4, "c": 5, "d": 101}) + [("one", 100), ("two", 10), ("two", 20)]
    df = spark.createDataFrame(rows, "g string, x bigint")
    got = {r.g: r for r in stats.five_number_summary(df, "g", "x").collect()}
    for g in "abcd":
        vals = [x for k, x in rows if k == g]
        q = statistics.quantiles(vals, n=4)
        assert (got[g].n, got[g].min, got[g].max) == (len(vals), min(vals), max(vals))
        for name, want in zip(("q1", "median", "q3"), q):
            assert abs(got[g][name] - want) <= 0.05 + 1e-9
    assert (got["one"].q1, got["one"].median, got["one"].q3, got["one"].iqr) == (100.0, 100.0, 100.0, 0.0)
    assert (got["two"].q1, got["two"].q3) == (15.0, 15.0)


def test_length_summary_cases(spark):
    df = spark.createDataFrame([("r", x) for x in (100, 200, 300)] + [("s", x) for x in range(1, 101)], "g string, x bigint")
    got = {r.g: r for r in stats.five_number_summary(df, "g", "x").collect()}
    assert (got["r"].q1, got["r"].median, got["r"].q3) == (100.0, 200.0, 300.0)
    assert got["s"].median == 50.5
    empty = spark.createDataFrame([("nothing",), ("r",)], "g string")
    full = {r.g: r.median for r in stats.summary_for_groups(stats.five_number_summary(df, "g", "x"), empty, "g").collect()}
    assert full == {"nothing": None, "r": 200.0}


def test_running_numbers_over_many_ranges(spark):
    rows = [(f, s, i) for i, (f, s) in enumerate([("x", "a"), ("x", "b"), ("y", "a"), (None, "c")] * 40)]
    df = spark.createDataFrame(rows, "f string, s string, o bigint").repartition(5)
    got = {r.o: r.n for r in scale.number_rows(df, "f", ["s"], "o", "n").collect()}
    for fam in ("x", "y", None):
        order = sorted((s, o) for f, s, o in rows if f == fam)
        assert [got[o] for _, o in order] == list(range(1, len(order) + 1))


def test_numbering_gathers_no_group(spark):
    """No window over the rows of a group: the only one runs over partitions."""
    df = spark.range(0, 20_000, numPartitions=8).selectExpr("id % 2 as f", "id % 7 as s", "id as o")
    out = scale.number_rows(df, "f", ["s"], "o", "n")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window ") <= 1 and out.agg(F.max("n")).first()[0] == 10_000


def test_first_k_beyond_the_group_limit(spark):
    df = spark.range(5000).withColumn("g", F.when(F.col("id") % 3 == 0, "hot").otherwise("b"))
    out = scale.first_k(df, "g", [F.desc("id")], 1200, spread=F.col("id"))
    got = sorted(r.id for r in out.filter("g = 'hot'").collect())
    assert got == sorted(range(0, 5000, 3))[-1200:]


def test_keep_first_drops_copies_before_the_shuffle(spark):
    df = spark.range(1000).withColumn("k", F.col("id") % 10)
    out = scale.keep_first(df, "k", [F.col("id")])
    assert sorted(r.id for r in out.collect()) == list(range(10))
    assert "WindowGroupLimit" in out._jdf.queryExecution().executedPlan().toString()


def test_histogram_last_bin_is_closed(spark):
    df = spark.createDataFrame([("g", float(x)) for x in (0, 5, 99, 100, 100)], "g string, x double")
    got = {r.bin: r.n_rows for r in stats.histogram(df, "g", "x", bins=20, low=0, high=100).collect()}
    assert got == {1: 1, 2: 1, 20: 3}


def test_box_needs_five_rows(spark):
    df = spark.createDataFrame([("few", x) for x in range(4)] + [("many", x) for x in (1, 2, 3, 4, 10)], "g string, x bigint")
    rows = stats.box_rows(df, "g", "x").collect()
    assert [(r.g, r.q1, r["median"], r.q3) for r in rows] == [("many", 2.0, 3.0, 4.0)]
