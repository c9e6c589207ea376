import pytest
from pyspark.sql import functions as F

from sparkcurate.operators import qc

SCHEMA = "accession string, species string, organism string, source string, description string, seq string, protected boolean, ordinal bigint"


def frame(spark, rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(accession=f"A{i}", species="s", organism="Real virus", source="", description="", seq="ATCGATCG" * 40, protected=False, ordinal=i)
        full.append({**base, **r})
    df = spark.createDataFrame(full, SCHEMA)
    return df.withColumn("length", F.length("seq").cast("bigint"))


def reasons(df, rules):
    return {r.accession: r.qc_reason for r in qc.assign_reason(df, "species", rules).collect()}


def test_reasons_and_their_order(spark):
    df = frame(spark, [
        {}, {"organism": "Synthetic Construct"}, {"source": "a metagenome"}, {"description": "clone of VECTOR x"},
        {"seq": "N" * 50}, {"seq": None}, {"seq": "ACGT" * 10}, {"organism": "syn", "source": "thetic construct"},
    ])
    got = reasons(df, qc.QualityRules())
    assert got == {
        "A0": "passed", "A1": "excluded_organism", "A2": "excluded_organism", "A3": "excluded_organism",
        "A4": "ambiguity", "A5": "undefined", "A6": "length", "A7": "passed",
    }


def test_fixed_minimum_is_raised_to_the_floor(spark):
    df = frame(spark, [{"seq": "A" * 150}, {"seq": "A" * 250}])
    assert reasons(df, qc.QualityRules(min_length=10)) == {"A0": "length", "A1": "passed"}
    assert reasons(df, qc.QualityRules(molecule="protein", min_length=10))["A0"] == "passed"


@pytest.mark.parametrize("usable,share", [(1100, 0.5), (900, 0.4), (700, 0.3)])
def test_share_of_the_median_relaxes(spark, usable, share):
    # the ambiguous rows set the median of 2000 and then drop out
    rows = [{"seq": "A" * usable}] + [{"seq": "N" * 2000} for _ in range(3)]
    row = qc.assign_reason(frame(spark, rows), "species", qc.QualityRules()).filter("accession = 'A0'").first()
    assert (row.qc_reason, row.share_used, row.min_length_used) == ("passed", share, int(2000 * share))


def test_no_share_keeps_a_row(spark):
    rows = [{"seq": "A" * 250}] + [{"seq": "N" * 4000} for _ in range(3)]
    row = qc.assign_reason(frame(spark, rows), "species", qc.QualityRules()).filter("accession = 'A0'").first()
    assert (row.qc_reason, row.share_used, row.min_length_used) == ("length", 0.3, 1200)


def test_duplicates_keep_the_first(spark):
    df = spark.createDataFrame([("a", 2, "late"), ("a", 1, "early"), ("b", 3, "only")], "acc string, ordinal bigint, v string")
    assert sorted(r.v for r in qc.deduplicate(df, ["acc"]).collect()) == ["early", "only"]
    assert qc.duplicate_counts(df.withColumn("g", F.lit(1)), ["g"], "acc").first().n_removed == 1


@pytest.mark.parametrize(
    "lengths,high,low,dropped",
    [
        ([1000, 1000, 1000, 4000], 3.0, 1 / 3, {3}),
        ([1000, 1000, 1000, 100], 3.0, 1 / 3, {3}),
        ([1000, 1000, 1000, 4000, 100], 3.0, 1 / 3, {3, 4}),
        ([1000, 1000, 1000, 4000, 100], 0, 1 / 3, {4}),
        ([1000, 1000, 1000, 4000, 100], 3.0, -1, {3}),
        ([1000, 3000, 1000], 3.0, 1 / 3, set()),
        ([5000], 3.0, 1 / 3, set()),
    ],
)
def test_length_outliers(spark, lengths, high, low, dropped):
    df = spark.createDataFrame([("g", i, x, False) for i, x in enumerate(lengths)], "g string, i int, length bigint, protected boolean")
    kept = qc.drop_length_outliers(qc.flag_length_outliers(df, "g", high=high, low=low))
    assert {r.i for r in kept.collect()} == set(range(len(lengths))) - dropped


def test_protected_outliers_stay(spark):
    rows = [("g", i, x, x == 9000) for i, x in enumerate([1000, 1000, 1000, 9000, 8000])]
    df = spark.createDataFrame(rows, "g string, i int, length bigint, protected boolean")
    flagged = qc.flag_length_outliers(df, "g")
    assert {r.i for r in qc.drop_length_outliers(flagged).collect()} == {0, 1, 2, 3}
    counts = qc.outlier_counts(flagged, "g").first()
    assert (counts.n_long, counts.n_short, counts.n_protected) == (1, 0, 1)


def test_small_groups_are_skipped(spark):
    df = spark.createDataFrame([("a",)] * 3 + [("b",)] * 4, "g string")
    few = qc.small_groups(df, "g", "too few")
    assert [(r.g, r.n, r.reason) for r in few.collect()] == [("a", 3, "too few")]
    assert {r.g for r in qc.without_groups(df, few, "g").collect()} == {"b"}


def test_totals_are_one_row_per_family(spark):
    df = frame(spark, [{"species": "s1"}, {"species": "s2", "seq": "N" * 500}]).withColumn("family", F.lit("f"))
    rows = {r.species: r for r in qc.breakdown(qc.assign_reason(df, ["family", "species"], qc.QualityRules())).collect()}
    assert set(rows) == {None, "s1", "s2"}
    assert (rows[None].n_passed, rows[None].n_excluded_ambiguity) == (1, 1)
