import pytest
from pyspark.sql import functions as F

from sparkcurate.functions import ids, taxa, text
from sparkcurate.functions.kmers import edit_identity, kmer_set, lowest_jaccard


def one(spark, **cols):
    """Evaluate named expressions on a single row."""
    return spark.range(1).select(*[v.alias(k) for k, v in cols.items()]).first()


@pytest.mark.parametrize(
    "date,year",
    [("2009-12-21", "2009"), ("1985", "1985"), ("Sep-1985", "1985"), ("21-Dec-2009", "2009"), ("unknown", ""), ("1799", ""), ("2105", ""), (None, ""), ("12009", "")],
)
def test_year(spark, date, year):
    assert one(spark, y=text.year_of(F.lit(date).cast("string"))).y == year


def test_display_names(spark):
    name = lambda *a: one(spark, n=text.display_name(*[F.lit(x).cast("string") for x in a])).n
    assert name("Dengue virus", "DEN1", "NC_001477", "Homo sapiens") == "Dengue_virus|DEN1|NC_001477|Homo_sapiens"
    assert name("Dengue virus", "DEN1", "NC_001477", "unknown") == "Dengue_virus|DEN1|NC_001477"
    assert name(None, "", "ACC1", None) == "unknown|unknown|ACC1"


@pytest.mark.parametrize("family,prefix", [("Flaviviridae", "FLVV"), ("Poxviridae", "PXVR"), ("Aeiouba", "AEIO"), ("ab", "AB")])
def test_prefix(spark, family, prefix):
    assert one(spark, p=text.family_prefix(F.lit(family))).p == prefix


def test_slugs_and_regions(spark):
    got = one(
        spark, a=text.marker_slug(F.lit("poly(A) polymerase")), b=text.marker_slug(F.lit("***")), c=text.charset_name(F.lit("VLTF-3 x")),
        d=text.molecule_region(F.lit("protein"), F.lit("hexon"), F.lit(None).cast("string")),
        e=text.molecule_region(F.lit("x"), F.lit("whole_genome"), F.lit("")), f=text.molecule_region(F.lit("nucleotide"), F.lit("whole_genome"), F.lit("segment L")),
    )
    assert tuple(got) == ("poly_A_polymerase", "marker", "VLTF_3_x", "protein, gene: hexon", "nucleotide, whole genome", "nucleotide, segment L")


@pytest.mark.parametrize(
    "name,rank",
    [("Flaviviridae", "family"), ("Orthocoronavirinae", "subfamily"), ("Nidovirales", "order"), ("Pisoniviricetes", "class"), ("Pisuviricota", "phylum"),
     ("Riboviria", "realm"), ("Orthornavirae", "kingdom"), ("Flavivirus", "genus"), ("Dengue virus", ""), ("Haploviricotina", "subphylum"), ("Abcvira", "subrealm"), ("Homo", "")],
)
def test_suffix_rank(spark, name, rank):
    assert one(spark, r=taxa.suffix_rank(F.lit(name))).r == rank


def ranked(*pairs):
    return F.array(*[F.struct(F.lit(n).alias("name"), F.lit(r).alias("rank")) for n, r in pairs])


def test_lineage_depth(spark):
    deep = ranked(("F", "family"), ("G", "genus"), ("S", "species"))
    shallow, none = ranked(("F", "family"), ("Sub", "subfamily")), ranked(("X", "no rank"))
    got = one(
        spark, a=taxa.lineage_reaches(deep, "genus"), b=taxa.lineage_reaches(shallow, "genus"), c=taxa.lineage_reaches(none, "genus"),
        d=taxa.lineage_reaches(none, "none"), e=taxa.lineage_reaches(none, "bogus"), f=taxa.lineage_reaches(none, ""),
    )
    assert tuple(got) == (True, False, False, True, True, True)


def test_genus_stand_ins(spark):
    lin = ranked(("Flaviviridae", "family"), ("Flavivirus", "no rank"), ("Dengue virus", "species"))
    plain = ranked(("Flaviviridae", "family"), ("Clade X", "clade"), ("Dengue virus", "species"))
    got = one(
        spark, a=taxa.genus_of(lin, "none"), b=taxa.genus_of(lin, "suffix"), c=taxa.genus_of(plain, "suffix"), d=taxa.genus_of(plain, "deepest"),
        e=taxa.genus_of(ranked(("A", "genus"), ("B", "Genus")), "suffix"),
    )
    assert tuple(got) == (None, "Flavivirus", None, "Clade X", "B")


def test_realms_and_ranks(spark):
    got = one(
        spark, a=taxa.realm_group(F.lit("Viruses; Riboviria; Negarnaviricota")), b=taxa.realm_group(F.lit("Viruses; Riboviria")), c=taxa.realm_group(F.lit("x")),
        d=taxa.schema_rank(F.lit("genus")), e=taxa.schema_rank(F.lit("realm")), f=taxa.visible_label(F.lit("N"), F.lit("species"), F.lit(False)),
        g=taxa.visible_label(F.lit("N"), F.lit("genus"), F.lit(False)), h=taxa.visible_label(F.lit("N"), F.lit(None).cast("string"), F.lit(True)),
    )
    assert tuple(got) == ("–ssRNA", "+ssRNA / dsRNA", "other", "genus", "other", "", "N", "N")


@pytest.mark.parametrize("acc,want", [("NC_001477.1", True), (" NZ_1", True), ("MN908947.3", False), ("nc_1", False), ("", False), (None, False), ("N1_2", False)])
def test_protected_ids(spark, acc, want):
    assert one(spark, p=ids.is_protected_id(F.lit(acc).cast("string"))).p is want


def test_selection_predicates(spark):
    df = spark.createDataFrame(
        [(1, "X segment L, complete cds", "L", "polymerase", "virus", False), (2, "X segment L, partial", "L", "polymerase", "virus", False),
         (3, "X complete genome", "S", "other", "virus", True), (4, "X UL30 gene", "UL30", "DNA polymerase", "uncultured", False)],
        "id int, title string, gene string, protein string, organism string, patent boolean",
    )
    args = dict(title=F.col("title"), gene=F.col("gene"), protein_name=F.col("protein"), organism=F.col("organism"), reference=F.lit(True), patent=F.col("patent"))
    pick = lambda *a, **k: [r.id for r in df.filter(ids.record_selection(*a, **args, **k)).collect()]
    assert pick("nucleotide", "whole_genome", segment="segment L") == [1]
    assert pick("nucleotide", "whole_genome") == []
    assert pick("protein", "whole_genome") == [1, 2, 4]
    assert pick("protein", "polymerase") == [1, 2, 4]
    assert pick("protein", "polymerase", exclude=["Uncultured"]) == [1, 2]
    assert pick("nucleotide", "UL30") == [4]


def test_kmers_read_the_whole_text(spark):
    got = one(spark, k=kmer_set(F.lit("abcabcé\nz"), 3), s=kmer_set(F.lit("ab"), 3), e=edit_identity(F.lit("abcd"), F.lit("abxd")))
    assert set(got.k) == {"abc", "bca", "cab", "bcé", "cé\n", "é\nz"} and got.s == [] and got.e == 0.75
    assert lowest_jaccard(1.0, 12) == 1.0


def test_source_accessions(spark):
    feats = lambda t, **q: F.struct(F.lit(t).alias("type"), F.create_map(*[F.lit(x) if isinstance(x, str) else F.array(*map(F.lit, x)) for kv in q.items() for x in kv]).alias("qualifiers"))
    coded = F.array(feats("CDS", product=["x"]), feats("CDS", coded_by=["join(NC_001477.1:1..9)"]))
    got = one(
        spark, a=text.source_accession(coded, F.lit("accession AB1")), b=text.source_accession(F.array(feats("CDS", product=["x"])), F.lit("REFSEQ: Accession MN908947.3")),
        c=text.source_accession(F.array(feats("CDS", product=["x"])), F.lit(None).cast("string")),
        d=text.isolate_of(F.array(feats("gene", isolate=["no"]), feats("source", isolate=[" "], strain=[" S1 "]))), e=text.isolate_of(F.array(feats("gene", isolate=["no"]))),
    )
    assert tuple(got) == ("NC_001477.1", "MN908947.3", "", "S1", "")
