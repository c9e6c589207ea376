import pytest
from pyspark.sql import functions as F

from sparkcurate.operators import concat, markers, settings
from sparkcurate.plans.assemble import select_genomes
from sparkcurate.operators.cluster import ClusterRules
from sparkcurate.sources.dimensions import MARKER_SCHEMA, dna_families, marker_presets, segmented_families

PROTEINS = "family string, genome_id string, accession string, text string, length int, locus_tag string, subfamily string, isolate string, ordinal bigint"
POL = ("f", 1, "DNA polymerase", ["DNA-directed DNA polymerase", "DNA pol"], {"Entomo": ["polymerase B"]}, None, None, None)
MCP = ("f", 2, "major capsid protein", ["MCP"], {}, None, None, None)
HEL = ("f", 3, "DNA helicase", [], {}, None, None, None)


def specs(spark, *rows):
    return spark.createDataFrame(list(rows), MARKER_SCHEMA)


def proteins(spark, *rows):
    full = []
    for i, r in enumerate(rows):
        base = dict(family="f", genome_id="G1", accession=f"P{i}", text="DNA polymerase", length=100, locus_tag="", subfamily=None, isolate="", ordinal=i)
        full.append({**base, **r})
    return spark.createDataFrame(full, PROTEINS)


def chosen(spark, marker, *rows):
    out = markers.identify_markers(proteins(spark, *rows), specs(spark, marker)).collect()
    return [r.accession for r in out]


def with_(marker, **kw):
    names = ["family", "marker_order", "name", "aliases", "sub_aliases", "len_min", "len_max", "locus_tag_hint"]
    d = {**dict(zip(names, marker)), **kw}
    return tuple(d[n] for n in names)


@pytest.mark.parametrize(
    "marker,rows,want",
    [
        (with_(POL, locus_tag_hint="E9L"), [{"locus_tag": "A24R"}, {"locus_tag": "vacv-e9l"}], "P1"),
        (with_(POL, locus_tag_hint="E9L"), [{"length": 900}, {"length": 1100}], "P1"),
        (with_(POL, len_min=800, len_max=1200), [{"length": 950}, {"length": 1100}, {"length": 995}], "P2"),
        (POL, [{"length": 500}, {"length": 1000}, {"length": 800}], "P1"),
        (POL, [{"accession": "YP_3"}, {"accession": "YP_1"}, {"accession": "YP_2"}], "YP_1"),
        (with_(POL, locus_tag_hint="E9L", len_min=900, len_max=1100), [{"length": 1000}, {"length": 700, "locus_tag": "E9L"}], "P1"),
    ],
)
def test_choice_between_candidates(spark, marker, rows, want):
    assert chosen(spark, marker, *rows) == [want]


def test_names_match_inside_the_text_and_by_subfamily(spark):
    rows = [{"text": "putative dna POL, partial"}, {"text": "polymerase B", "genome_id": "G2"}, {"text": "polymerase B", "genome_id": "G3", "subfamily": "Entomo"}, {"text": "capsid", "genome_id": "G4"}]
    out = markers.identify_markers(proteins(spark, *rows), specs(spark, POL, MCP)).collect()
    assert {(r.genome_id, r.marker) for r in out} == {("G1", "DNA polymerase"), ("G3", "DNA polymerase")}


def test_coverage_rule(spark):
    rows = [{"text": t} for t in ("DNA polymerase", "MCP", "DNA helicase")] + [{"genome_id": "G2"}, {"genome_id": ""}]
    counters = markers.assembly_counters(proteins(spark, *rows), specs(spark, POL, MCP, HEL), 0.7).first()
    assert (counters.n_genomes_kept, counters.n_dropped, counters.n_required, counters.n_orphans, counters.n_genomes_found) == (1, 1, 2, 1, 2)
    many = specs(spark, *[with_(POL, name=f"m{i}") for i in range(5)])
    assert [markers.required_markers(many, f).first().n_required for f in (0.5, 0.7, 0.01)] == [2, 4, 1]


def test_split_submissions(spark):
    rows = [{"genome_id": "G1", "isolate": "iso"}, {"genome_id": "G2", "isolate": "iso"}, {"genome_id": "G3", "isolate": "other"}]
    c = markers.assembly_counters(proteins(spark, *rows), specs(spark, POL, MCP, HEL), 0.7).first()
    assert (c.n_genomes_kept, c.n_dropped, c.n_split) == (0, 3, 1)


def test_coverage_string(spark):
    out = markers.identify_markers(proteins(spark, {}, {"genome_id": "G2"}), specs(spark, POL, MCP))
    row = markers.coverage_summary(markers.marker_coverage(out, specs(spark, POL, MCP))).first()
    assert (row.n_markers_target, row.n_markers_used, row.marker_coverage) == (2, 1, "DNA polymerase:2,major capsid protein:0")


CELLS = "family string, genome_id string, marker string, length bigint, protected boolean"


@pytest.mark.parametrize("lengths,dropped", [([1000, 4500, 990], {1}), ([1000, 250, 990], {1}), ([1000], set()), ([0, 0, 5], set())])
def test_marker_outliers(spark, lengths, dropped):
    df = spark.createDataFrame([("f", str(i), "polB", x, False) for i, x in enumerate(lengths)], CELLS)
    flagged = concat.flag_marker_outliers(df)
    assert {int(r.genome_id) for r in flagged.filter("outlier is not null").collect()} == dropped


ALN = "family string, marker string, marker_order int, genome_id string, aln string"


def test_gap_padding_and_partitions(spark):
    df = spark.createDataFrame([("f", "polB", 1, "NC_001", "MAAAA"), ("f", "polB", 1, "NC_002", "MBBBB"), ("f", "MCP", 2, "NC_001", "QQQ"), ("f", "none", 3, "NC_001", "")], ALN)
    genomes = spark.createDataFrame([("f", "NC_001"), ("f", "NC_002"), ("f", "NC_003")], "family string, genome_id string")
    got = {r.genome_id: r.aln for r in concat.concatenate(df, genomes).collect()}
    assert got == {"NC_001": "MAAAAQQQ", "NC_002": "MBBBB---", "NC_003": "--------"}
    assert {r.marker: (r.start_col, r.end_col) for r in concat.marker_blocks(df).collect()} == {"polB": (1, 5), "MCP": (6, 8)}


def test_alignment_checks_and_statistics(spark):
    df = spark.createDataFrame(
        [("a", 1, "ATGC"), ("a", 2, "A-GC"), ("a", 3, "ATGC"), ("b", 1, "AT"), ("b", 2, "ATG"), ("c", 1, "---"), ("d", 1, "")], "m string, o int, aln string"
    )
    assert {(r.m, r.reason) for r in concat.alignment_violations(df, "m").collect()} == {("b", "unequal widths"), ("c", "too few rows"), ("d", "too few rows")}
    got = {r.m: (r.length, r.gap_pct) for r in concat.alignment_stats(df, "m", "o").collect()}
    assert (got["a"], got["c"], got["d"]) == ((4, 8.3), (3, 100.0), (0, 0.0))


def test_gap_trim(spark):
    df = spark.createDataFrame([("a", 1, "A--C"), ("a", 2, "AT-C"), ("a", 3, "A--G")], "m string, o int, aln string")
    got = {r.o: (r.aln, r.width_before, r.width_after) for r in concat.trim_gappy_columns(df, "m", 0.7).collect()}
    assert got == {1: ("A-C", 4, 3), 2: ("ATC", 4, 3), 3: ("A-G", 4, 3)}


def test_genome_selection(spark):
    import random

    rng = random.Random(1)
    rows = [
        ("f", f"sp{s}", f"{'NC_' if g == 0 else 'GB'}{s}{g}", m, "".join(rng.choice("ACDEFGHIKL") for _ in range(60)))
        for s in range(2) for g in range(3) for m in (1, 2)
    ]
    df = spark.createDataFrame(rows, "family string, species string, genome_id string, marker_order int, seq string")
    selected, stats = select_genomes(df, 4, 5, ClusterRules(k=8))
    got = selected.collect()
    assert len(got) == 4 and {r.genome_id for r in got} >= {"NC_00", "NC_10"}
    row = stats.first()
    assert (row.n_total_reps, row.n_species_with_reps, row.n_selected, row.cluster_thresh_max) == (6, 2, 4, 0.99)


def test_presets(spark):
    assert segmented_families(spark).count() == 28 and dna_families(spark).count() == 26
    sizes = {r.family: r["count"] for r in marker_presets(spark).groupBy("family").count().collect()}
    assert len(sizes) == 16 and (sizes["Poxviridae"], sizes["Herpesviridae"], sizes["Mimiviridae"], sizes["Asfarviridae"]) == (9, 7, 8, 6)


def test_marker_checks(spark):
    bad = specs(
        spark, POL, with_(POL, marker_order=2, name=" "), with_(POL, marker_order=3, aliases=None), with_(POL, marker_order=4, len_min=5, len_max=5), with_(POL, family="g"),
    )
    wanted = spark.createDataFrame([("f", 0.7), ("g", 0.0), ("h", 1.0)], "family string, min_fraction double")
    got = {(r.family, r.marker_order, r.problem) for r in settings.marker_violations(bad, wanted).collect()}
    assert got == {
        ("f", 2, "marker without a name"), ("f", 3, "aliases are not a list of strings"), ("f", 4, "length range is not increasing"),
        ("g", None, "min_fraction is not in (0, 1]"), ("h", None, "no markers"),
    }


def test_two_parts_of_one_marker(spark):
    rows = [("f", "g1", "m", 1, "AC"), ("f", "g1", "m", 1, "AA"), ("f", "g2", "n", 2, "TTT")]
    aligned = spark.createDataFrame(rows, "family string, genome_id string, marker string, marker_order int, aln string")
    genomes = aligned.select("family", "genome_id").distinct()
    got = {r.genome_id: r.aln for r in concat.concatenate(aligned, genomes).collect()}
    assert got == {"g1": "AA---", "g2": "--TTT"}


def test_changes_are_added_up_before_they_leave_a_task():
    """The edges of many equal rows leave as few sums, whatever the batches."""
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"g": ["a", None] * 200, "__aln": ["AC--GT-A", "A-"] * 200})
    out = list(concat._edges(["g"], 64)(iter([batch, batch])))
    assert sum(b.num_rows for b in out) < 100
    totals = {}
    for b in out:
        for g, pos, gaps, rows in zip(*(b.column(c).to_pylist() for c in ("g", "pos", "gaps", "rows"))):
            old = totals.get((g, pos), (0, 0))
            totals[g, pos] = old[0] + gaps, old[1] + rows
    assert {k: v for k, v in totals.items() if v != (0, 0)} == {
        ("a", 1): (0, 400), ("a", 3): (400, 0), ("a", 5): (-400, 0), ("a", 7): (400, 0), ("a", 8): (-400, 0), ("a", 9): (0, -400),
        (None, 1): (0, 400), (None, 2): (400, 0), (None, 3): (-400, -400)}


def test_trimming_in_slices(spark, monkeypatch):
    """Slices of a group are cut like the whole group; the plan does not go to every row."""
    rows = [("g", i, text) for i, text in enumerate(["A-C-é", "AB--", "A--\U0001F600x", "", None, "A"] * 5)] + [("h", 99, ""), (None, 98, "-A")]
    df = spark.createDataFrame(rows, "g string, i int, aln string")
    whole = {tuple(r) for r in concat.trim_gappy_columns(df, "g", 0.5).collect()}
    monkeypatch.setattr(concat, "SLICE_LETTERS", 20)
    cut = concat.trim_gappy_columns(df, "g", 0.5)
    assert {tuple(r) for r in cut.collect()} == whole
    assert whole >= {("g", 0, "Aé", 5, 2), ("g", 2, "Ax", 5, 2), ("g", 3, "", 0, 2), ("g", 4, None, None, 2), ("h", 99, "", 0, 0), (None, 98, "A", 2, 1)}
