import datetime as dt

from pyspark.sql import functions as F

from sparkcurate.operators import ledger, report, settings
from sparkcurate.operators.qc import QualityRules
from sparkcurate.sources import dimensions, flatfile, tables
from sparkcurate.streaming.ingest import append_parquet, flag_rows, stream_flat_files

RECORD = """LOCUS       NC_001477              20 bp    RNA     linear   VRL 01-JAN-2000
DEFINITION  Dengue virus 1, a long title that runs
            over two lines, complete genome.
ACCESSION   NC_001477
VERSION     NC_001477.1
DBSOURCE    accession M87512.1
SOURCE      dengue virus 1
  ORGANISM  Dengue virus 1
            Viruses; Riboviria; Flaviviridae;
            Orthoflavivirus.
FEATURES             Location/Qualifiers
     source          1..20
                     /organism="Dengue virus 1"
                     /strain="45AZ5"
                     /host="Homo sapiens"
                     /collection_date="21-Dec-2009"
                     /country="Nauru:
                     Pacific"
                     /db_xref="taxon:11053"
     CDS             1..9
                     /product="capsid"
                     /product="second"
                     /locus_tag="E9L"
                     /ribosomal_slippage
ORIGIN
        1 atgcatgcat gcatgcatnn
//
"""
SECOND = "LOCUS       X\nDEFINITION  bare.\nVERSION     AB1.2\nSOURCE      s\n  ORGANISM  Some virus\nFEATURES             Location/Qualifiers\n     source          1..2\n                     /isolate=\"I 7\"\n//\n"


def test_flat_files(spark, tmp_path):
    (tmp_path / "a.gb").write_text(RECORD + SECOND)
    (tmp_path / "b.gb").write_text("")
    rows = {r.accession: r for r in flatfile.with_metadata(flatfile.read_flat_files(spark, str(tmp_path))).collect()}
    one, two = rows["NC_001477.1"], rows["AB1.2"]
    assert one.description == "Dengue virus 1, a long title that runs over two lines, complete genome"
    assert one.lineage == ["Viruses", "Riboviria", "Flaviviridae", "Orthoflavivirus"]
    assert (one.organism, one.source, one.db_source) == ("Dengue virus 1", "dengue virus 1", "accession M87512.1")
    assert (one.seq, one.length) == ("ATGCATGCATGCATGCATNN", 20)
    assert (one.strain, one.host, one.collection_date, one.location, one.taxon_id) == ("45AZ5", "Homo sapiens", "21-Dec-2009", "Nauru: Pacific", "11053")
    cds = one.features[1]
    assert cds.type == "CDS" and cds.qualifiers["product"] == ["capsid", "second"] and cds.qualifiers["ribosomal_slippage"] == [""]
    assert (two.seq, two.strain, two.host, two.taxon_id) == (None, "I 7", "unknown", "")


def test_marker_folder(spark, tmp_path):
    (tmp_path / "poly_A_polymerase.gb").write_text(RECORD + SECOND)
    (tmp_path / "MCP.gb").write_text("")
    found = flatfile.read_marker_folder(spark, str(tmp_path))
    specs = spark.createDataFrame([("poly(A) polymerase",), ("MCP",), ("absent",)], "name string")
    got = {r.name: r.n_records for r in flatfile.marker_folder_counts(found, specs).collect()}
    assert got == {"poly(A) polymerase": 2, "MCP": 0, "absent": 0}


def test_fasta_round_trip(spark, tmp_path):
    (tmp_path / "in.fasta").write_text(">a first one\nAC\nGT\n>b\nTT TT\n>c x\n")
    rows = {r.id: (r.description, r.seq) for r in flatfile.read_fasta(spark, str(tmp_path / "in.fasta")).collect()}
    assert rows == {"a": ("a first one", "ACGT"), "b": ("b", "TTTT"), "c": ("c x", "")}
    out = str(tmp_path / "out")
    flatfile.write_fasta(spark.createDataFrame([("x", "AC"), ("y", "GT")], "id string, seq string"), out)
    assert {(r.id, r.seq) for r in flatfile.read_fasta(spark, out).collect()} == {("x", "AC"), ("y", "GT")}


def test_annotations(spark, tmp_path):
    path = tmp_path / "ann.tsv"
    path.write_text("family\tbaltimore_class\nFlaviviridae\tIV\n \tV\nflaviviridae \tIVb\nPoxviridae\tI\n")
    notes = tables.read_family_annotations(spark, str(path))
    assert {r.family_key: r.baltimore_class for r in notes.collect()} == {"flaviviridae": "IVb", "poxviridae": "I"}
    asked = spark.createDataFrame([("FLAVIVIRIDAE",), ("Other",)], "family string")
    assert {r.family: r.baltimore_class for r in report.annotate_families(asked, notes).collect()} == {"FLAVIVIRIDAE": "IVb", "Other": ""}
    (tmp_path / "none.tsv").write_text("name\tx\na\tb\n")
    assert tables.read_family_annotations(spark, str(tmp_path / "none.tsv")) is None
    assert tables.read_family_annotations(spark, str(tmp_path / "missing.tsv")) is None
    assert report.annotate_families(asked, None).first().baltimore_class == ""


def test_summary_and_status_tables(spark, tmp_path):
    columns = tables.summary_columns()
    assert len(columns) == len(set(columns)) == 79
    assert columns[0] == "family" and columns[-1] == "tree100_marker_models" and "tree500_tree_model" not in columns
    path = str(tmp_path / "summary")
    for i, lin in enumerate(["old", "new"]):
        tables.append_summary(spark.createDataFrame([("F", lin, i)], "family string, lineage string, extra int"), path)
    back = spark.read.parquet(path)
    assert back.columns == columns and back.count() == 2


def test_request_list_and_id_map(spark, tmp_path):
    (tmp_path / "list.txt").write_text("# comment\n Flaviviridae \n\n   # more\nPoxviridae\n")
    got = [r.family for r in tables.request_list(spark.read.text(str(tmp_path / "list.txt"))).collect()]
    assert got == ["Flaviviridae", "Poxviridae"]
    rows = spark.createDataFrame([("A_1", "x", "a|b c"), ("A_2", "y", 'q"t')], tables.ID_MAP_SCHEMA)
    tables.write_tsv(rows, str(tmp_path / "ids"))
    assert sorted(tables.read_tsv(spark, str(tmp_path / "ids"), tables.ID_MAP_SCHEMA).collect()) == sorted(rows.collect())


def test_settings_layers(spark):
    fam = spark.createDataFrame([("Arenaviridae",), ("Poxviridae",), ("Hepadnaviridae",), ("Adenoviridae",), ("Plain",)], "family string")
    presets = settings.preset_rows(fam, dimensions.segmented_families(spark), dimensions.dna_families(spark), dimensions.marker_presets(spark))
    layers = settings.layer_rows(spark, "defaults", fam, settings.DEFAULTS).unionByName(presets)
    layers = layers.unionByName(settings.layer_rows(spark, "global", fam.filter("family = 'Plain'"), {"download": {"max_per_species": 7}, "sequence": {"segment": "mine"}}))
    layers = layers.unionByName(settings.layer_rows(spark, "family", fam.filter("family = 'Adenoviridae'"), {"sequence": {"region": "penton"}, "quality": {"exclude": ["a", "b"]}}))
    got = {(r.family, r.key): r.value for r in settings.resolve(layers).collect()}
    assert got[("Arenaviridae", "sequence.segment")] == "segment L"
    assert got[("Poxviridae", "sequence.region")] == "concatenated" and got[("Poxviridae", "sequence.type")] == "protein"
    assert got[("Hepadnaviridae", "sequence.type")] == "nucleotide"
    assert got[("Adenoviridae", "sequence.region")] == "penton" and got[("Adenoviridae", "quality.exclude")] == '["a", "b"]'
    assert got[("Plain", "download.max_per_species")] == "7" and got[("Plain", "sequence.segment")] == "mine"
    assert got[("Poxviridae", "download.max_per_species")] == "300"


def test_ledger(spark):
    now = dt.datetime(2024, 1, 31)
    entry = lambda key, days, size=10, empty=False, family="F": (key, 1, "nuccore", "r", None, 300, None, now - dt.timedelta(days=days), 1, size, family, empty)
    book = spark.createDataFrame(
        [entry("old", 2), entry("fresh", 0), entry("twice", 9), entry("twice", 0), entry("hollow", 0, 0), entry("neg", 0, 0, True), entry("negold", 2, 0, True), entry("gone", 0, family="G")],
        ledger.LEDGER_SCHEMA,
    )
    ask = spark.createDataFrame([(k,) for k in ("old", "fresh", "twice", "hollow", "neg", "negold", "never")], "request_key string")
    at = F.lit(now)
    missing = lambda ttl: {r.request_key for r in ledger.misses(ask, book, at, ttl).collect()}
    assert missing(1) == {"old", "hollow", "negold", "never"}
    assert missing(30) == {"hollow", "never"} == missing(None)
    assert {r.request_key: r.negative for r in ledger.hits(ask, book, at, 1).collect()} == {"fresh": False, "twice": False, "neg": True}
    row = ledger.stats(book).first()
    assert (row.entries, row.empty_entries, row.size_mb) == (5, 2, 0.0)
    assert ledger.without_family(book, "G").count() == 7
    assert ledger.without_requests(book, ask).count() == 1


def test_marker_hash_follows_every_field(spark):
    base = dimensions.marker_presets(spark).filter("family = 'Poxviridae'")
    one = ledger.marker_set_hash(base).first().marker_hash
    assert len(one) == 8 and ledger.marker_set_hash(base.repartition(5)).first().marker_hash == one
    for change in (F.concat("name", F.lit("x")), F.col("name")):
        order = F.lit(10) - F.col("marker_order")
        other = base.withColumns({"name": change, "marker_order": order})
        assert ledger.marker_set_hash(other).first().marker_hash != one


def test_status_and_progress(spark):
    fam = spark.createDataFrame(
        [("F", 1, ["V", "F"], "IV", "protein", "hexon", None), ("G", None, [], "", "nucleotide", "whole_genome", None)],
        "family string, ncbi_taxid int, lineage array<string>, baltimore_class string, molecule string, region string, segment string",
    )
    outcomes = spark.createDataFrame([("G", "too few genomes")], "family string, reason string")
    status = report.status_rows(fam, outcomes)
    assert status.columns == tables.STATUS_COLUMNS
    got = {r.family: (r.status, r.lineage, r.molecule_region) for r in status.collect()}
    assert got == {"F": ("OK", "V; F", "protein, gene: hexon"), "G": ("too few genomes", "", "nucleotide, whole genome")}
    asked = spark.createDataFrame([("F",), ("G",), ("H",)], "family string")
    board = {r.family: (r.state, r.note) for r in report.progress_board(asked, status).collect()}
    assert board == {"F": ("done", ""), "G": ("skipped", "too few genomes"), "H": ("pending", "")}


def test_stream_ingest(spark, tmp_path):
    source, out = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    (source / "a.gb").write_text(RECORD)
    for extra in (None, SECOND):
        if extra:
            (source / "b.gb").write_text(extra)
        stream = flag_rows(stream_flat_files(spark, str(source)), QualityRules())
        query = append_parquet(stream, str(out), str(tmp_path / "ckpt"))
        query.awaitTermination(120)
    rows = {r.accession: r for r in spark.read.parquet(str(out)).collect()}
    assert len(rows) == 2 and rows["NC_001477.1"].ambiguous and rows["AB1.2"].undefined


def test_carriage_returns_and_unmarked_ends(spark, tmp_path):
    lines = ["LOCUS       A1 10 bp", "ACCESSION   A1", "//", "LOCUS       A2 10 bp", "ACCESSION   A2", "//", ""]
    for name, end in (("unix", "\n"), ("dos", "\r\n")):
        (tmp_path / name).write_bytes(end.join(lines).encode())
        blocks = [r.value for r in flatfile.flat_blocks(spark, str(tmp_path / name)).collect()]
        assert [b.split("\n")[0] for b in blocks] == ["LOCUS       A1 10 bp", "LOCUS       A2 10 bp"]


def test_deleting_a_family_keeps_entries_without_one(spark):
    from sparkcurate.operators import ledger

    book = spark.createDataFrame([("a", None), ("b", "x"), ("c", "y")], "request_key string, family string")
    assert sorted(r.request_key for r in ledger.without_family(book, "x").collect()) == ["a", "c"]


def test_a_folder_of_leaf_metadata_has_one_file(spark, tmp_path, monkeypatch):
    fields = ["strain", "host", "collection_date", "location", "taxon_id", "length"]
    rows = spark.range(400).selectExpr(
        "concat('S', id) AS short_id", "concat('A', id) AS accession", "'x' AS species", *(f"'u' AS {f}" for f in fields),
        "concat('f', id % 3) AS family", "id % 2 AS target").repartition(8)
    names = spark.createDataFrame([("f0", "S0", "zero")], "family string, short_id string, display_name string")
    tables.write_leaf_metadata(rows, names, str(tmp_path / "one"))
    per_folder = lambda path: [len(list(d.glob("*.csv"))) for d in path.glob("family=*/target=*")]
    assert per_folder(tmp_path / "one") == [1] * 6
    monkeypatch.setattr(tables, "FILE_ROWS", 10)
    tables.write_leaf_metadata(rows, names, str(tmp_path / "many"))
    assert min(per_folder(tmp_path / "many")) > 1
    assert tables.read_tsv(spark, str(tmp_path / "many")).count() == 400
