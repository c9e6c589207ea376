import pytest
from pyspark.sql import functions as F

from sparkcurate.operators import sample


def reps(spark, counts, protected=()):
    rows = [("f", sp, f"{sp}_{i}", f"{sp}_{i}" in protected) for sp, n in counts.items() for i in range(n)]
    return spark.createDataFrame(rows, "family string, species string, accession string, protected boolean")


def picked(spark, counts, target, mode="strict", protected=(), seed=42):
    out = sample.quota_sample(reps(spark, counts, protected), "family", "species", target, seed=seed, mode=mode).collect()
    per = {}
    for r in out:
        per[r.species] = per.get(r.species, 0) + 1
    return per, {r.accession for r in out}


def quota_by_hand(counts, target, strict):
    """The rule step by step, for comparison."""
    total = sum(counts.values())
    if total <= target:
        return dict(counts)
    if len(counts) > target:
        best = sorted(counts, key=lambda s: (-counts[s], s))[:target]
        return {s: int(s in best) for s in counts}
    quota = {s: max(1, round(n / total * target)) for s, n in counts.items()}
    order = sorted(sorted(counts), key=lambda s: -((counts[s] / total * target) % 1))
    diff = target - sum(quota.values())
    while diff:
        before = diff
        for s in order:
            if diff > 0:
                quota[s] += 1
                diff -= 1
            elif diff < 0 and quota[s] > 1:
                quota[s] -= 1
                diff += 1
            if not diff:
                break
        if not strict or before == diff:
            break
    return quota


def test_simple_quotas(spark):
    assert picked(spark, {"a": 50, "b": 30, "c": 20}, 10)[0] == {"a": 5, "b": 3, "c": 2}
    per, _ = picked(spark, {"a": 80, "b": 20}, 10)
    assert per == {"a": 8, "b": 2}
    assert picked(spark, {"a": 3, "b": 2}, 10)[0] == {"a": 3, "b": 2}


def test_more_species_than_places(spark):
    per, _ = picked(spark, {f"sp{i:02d}": 1 for i in range(20)}, 5)
    assert per == {f"sp{i:02d}": 1 for i in range(5)}
    per, _ = picked(spark, {"big": 10, "mid": 5, "small": 3, "less": 2, "least": 1}, 3)
    assert per == {"big": 1, "mid": 1, "small": 1}


def test_protected_rows_come_first(spark):
    _, ids = picked(spark, {"a": 4, "b": 4}, 2, protected={"a_3"})
    assert "a_3" in ids


@pytest.mark.parametrize("mode,want", [("compat", 83), ("strict", 51)])
def test_overshoot(spark, mode, want):
    counts = {"big": 100, **{f"s{i:02d}": 1 for i in range(50)}}
    plan = sample.quotas(sample.species_counts(reps(spark, counts), ["family"], "species"), "family", "species", 51, mode)
    assert plan.agg(F.sum("quota")).first()[0] == want


@pytest.mark.parametrize("seed", range(6))
def test_quotas_match_the_rule(spark, seed):
    import random

    rng = random.Random(seed)
    counts = {f"s{i:02d}": rng.choice([1, 1, 2, 5, 40]) for i in range(rng.randint(2, 30))}
    target = rng.randint(3, 40)
    for mode in ("compat", "strict"):
        plan = sample.quotas(sample.species_counts(reps(spark, counts), ["family"], "species"), "family", "species", target, mode)
        assert {r.species: r.quota for r in plan.collect()} == quota_by_hand(counts, target, mode == "strict")


def test_sample_ignores_row_order(spark):
    df = reps(spark, {"a": 30, "b": 9})
    one = {r.accession for r in sample.quota_sample(df, "family", "species", 12).collect()}
    two = {r.accession for r in sample.quota_sample(df.orderBy(F.desc("accession")).repartition(3), "family", "species", 12).collect()}
    assert one == two and len(one) == 12


def test_cap_keeps_all_protected_rows(spark):
    rows = [("s", i, i in (0, 9, 11)) for i in range(12)]
    df = spark.createDataFrame(rows, "species string, ordinal bigint, protected boolean")
    got = {r.ordinal for r in sample.protected_first_cap(df, "species", 5).collect()}
    assert got == {0, 9, 11, 1, 2}
    got = {r.ordinal for r in sample.protected_first_cap(df, "species", 2).collect()}
    assert got == {0, 9, 11}
