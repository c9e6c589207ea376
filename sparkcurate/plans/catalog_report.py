"""Queries: sources and sinks read back, metadata, settings, ledger, summaries."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import text
from ..operators import ledger, markers, qc, report, sample, settings, stats
from ..session import cut_lineage, scratch_folder
from ..sources import dimensions, flatfile, newick, tables
from . import catalog_quality as quality
from .catalog_quality import CHECKED_SQL, exclusive_sql, quota_sql
from .registry import RECORDS_SQL, query, records, table

_LETTERS = "upper(regexp_replace(text, '[^A-Za-z]', '', 'g'))"

# ---- flat files and FASTA -------------------------------------------------


def _blocks(spark, folder):
    """Documents written out as flat-file records, whole text as the sequence."""
    docs = table(spark, folder, "documents")
    n = F.col("doc_id").cast("string")
    host = F.when(F.col("n_chars") % 2 == 0, F.lit('                     /host="Homo sapiens"\n')).otherwise("")
    value = F.concat(
        F.lit("LOCUS       DOC"), n, F.lit("\nDEFINITION  Document "), n, F.lit(" from\n            "), "source", F.lit(", complete genome."),
        F.lit("\nACCESSION   DOC"), n, F.lit("\nVERSION     DOC"), n, F.lit(".1\nDBSOURCE    REFSEQ: accession NC_"), n,
        F.lit(".2\nKEYWORDS    .\nSOURCE      "), "source", F.lit(" agent\n  ORGANISM  "), "source", F.lit(" virus\n            Viruses; Riboviria;\n            "),
        "lang", F.lit("viridae; "), "source", F.lit(".\nFEATURES             Location/Qualifiers\n     source          1.."), F.col("n_chars").cast("string"),
        F.lit('\n                     /organism="'), "source", F.lit(' virus"\n                     /mol_type="genomic RNA"\n                     /isolate="iso '), n,
        F.lit('"\n'), host, F.lit('                     /db_xref="taxon:'), n, F.lit('"\n                     /db_xref="other:1"\n                     /country="Land of\n                     '),
        "lang", F.lit('"\n     CDS             1..9\n                     /product="capsid ""'), "lang", F.lit('"" protein"\n                     /coded_by="NC_'), n,
        F.lit('.1:1..9"\n                     /pseudo\nORIGIN      \n        1 '), "text", F.lit("\n"),
    )
    return docs.select(value.alias("value"))


def _flat_records(spark, folder):
    path = scratch_folder(spark)
    _blocks(spark, folder).write.option("lineSep", "\n//\n").text(path)
    return flatfile.read_flat_files(spark, path)


@query(
    "a1_flat_files",
    f"""SELECT 'DOC' || doc_id || '.1' AS accession, 'Document ' || doc_id || ' from ' || source || ', complete genome' AS description, source || ' virus' AS organism,
        source || ' agent' AS source, 'REFSEQ: accession NC_' || doc_id || '.2' AS db_source, 'Viruses|Riboviria|' || lang || 'viridae|' || source AS lineage,
        2 AS n_features, 'capsid "' || lang || '" protein' AS product, md5({_LETTERS}) AS seq_md5, CAST(length({_LETTERS}) AS INTEGER) AS length FROM documents""",
)
def _a1(spark, folder):
    rec = _flat_records(spark, folder)
    product = F.filter("features", lambda f: f["type"] == "CDS")[0]["qualifiers"]["product"][0]
    return rec.select(
        "accession", "description", "organism", "source", "db_source", F.array_join("lineage", "|").alias("lineage"),
        F.size("features").alias("n_features"), product.alias("product"), F.md5(F.coalesce("seq", F.lit(""))).alias("seq_md5"), F.coalesce("length", F.lit(0)).alias("length"),
    )


@query(
    "g2_source_metadata",
    """SELECT 'DOC' || doc_id || '.1' AS accession, source || ' virus' AS species, 'iso ' || doc_id AS strain,
       CASE WHEN n_chars % 2 = 0 THEN 'Homo sapiens' ELSE 'unknown' END AS host, 'unknown' AS collection_date, 'Land of ' || lang AS location,
       CAST(doc_id AS VARCHAR) AS taxon_id FROM documents""",
)
def _g2(spark, folder):
    rec = flatfile.with_metadata(flatfile.parse_flat_records(_blocks(spark, folder)))
    return rec.select("accession", "species", "strain", "host", "collection_date", "location", "taxon_id")


@query(
    "g3_source_accession",
    """SELECT 'DOC' || doc_id || '.1' AS accession, 'NC_' || doc_id || '.1' AS coded, 'NC_' || doc_id || '.2' AS from_db, 'iso ' || doc_id AS isolate FROM documents""",
)
def _g3(spark, folder):
    rec = flatfile.parse_flat_records(_blocks(spark, folder))
    none = F.array().cast(rec.schema["features"].dataType)
    return rec.select(
        "accession", text.source_accession(F.col("features"), F.col("db_source")).alias("coded"),
        text.source_accession(none, F.col("db_source")).alias("from_db"), text.isolate_of(F.col("features")).alias("isolate"),
    )


@query(
    "a2_marker_folder",
    """SELECT p_type AS name, count(*) FILTER (WHERE p_size > 10) AS n_records FROM part GROUP BY p_type
       UNION ALL SELECT 'Missing ' || r_name, 0 FROM region""",
)
def _a2(spark, folder):
    path = scratch_folder(spark)
    part = table(spark, folder, "part")
    entry = F.concat(F.lit("LOCUS       P\nDEFINITION  "), "p_name", F.lit(".\nVERSION     P"), F.col("p_partkey").cast("string"), F.lit(".1\nORIGIN\n        1 acgt\n"))
    rows = part.filter("p_size > 10").select(entry.alias("value"), text.marker_slug(F.col("p_type")).alias("slug"))
    # one folder per marker; the reader takes the slug from the file path
    rows.write.partitionBy("slug").option("lineSep", "\n//\n").text(path)
    found = flatfile.flat_blocks(spark, path)
    missing = table(spark, folder, "region").select(F.concat(F.lit("Missing "), "r_name").alias("name"))
    specs = part.select(F.col("p_type").alias("name")).distinct().unionByName(missing)
    return flatfile.marker_folder_counts(flatfile.parse_flat_records(found, keep=["slug"]), specs).select("name", "n_records")


@query(
    "a3_fasta_source",
    f"""SELECT 'DOC' || doc_id AS id, 'DOC' || doc_id || ' ' || source AS description, md5(regexp_replace(text, '[\\s>]', '', 'g')) AS seq_md5 FROM documents""",
)
def _a3(spark, folder):
    path = scratch_folder(spark)
    docs = table(spark, folder, "documents")
    title = F.concat(F.lit(">DOC"), F.col("doc_id").cast("string"), F.lit(" "), "source")
    # long lines are kept as they are; ">" cannot occur inside a sequence
    docs.select(F.concat(title, F.lit("\n"), F.replace("text", F.lit(">"), F.lit(""))).alias("value")).write.text(path)
    return flatfile.read_fasta(spark, path).select("id", "description", F.md5("seq").alias("seq_md5"))


@query(
    "a4_fasta_sink",
    f"""SELECT lang AS family, 'DOC' || doc_id AS id, {_LETTERS} AS seq FROM documents""",
)
def _a4(spark, folder):
    path = scratch_folder(spark)
    docs = table(spark, folder, "documents")
    rows = docs.select(
        F.col("lang").alias("family"), F.concat(F.lit("DOC"), F.col("doc_id").cast("string")).alias("id"),
        F.upper(F.regexp_replace("text", "[^A-Za-z]", "")).alias("seq"),
    )
    flatfile.write_fasta(rows, path, partitions=["family"])
    lines = spark.read.option("lineSep", "\n>").text(path)
    return flatfile.parse_fasta(lines, keep=["family"]).select("family", "id", "seq")


# ---- small text tables ----------------------------------------------------


@query(
    "a5_annotations",
    """SELECT lower(c_name) AS family_key, arg_max(c_mktsegment, o_orderkey) AS baltimore_class FROM (
       SELECT trim(CASE WHEN o_orderstatus = 'P' THEN '' ELSE c_name END) AS c_name, c_mktsegment || o_orderpriority AS c_mktsegment, o_orderkey FROM orders JOIN customer ON o_custkey = c_custkey)
       WHERE c_name <> '' GROUP BY ALL""",
)
def _a5(spark, folder):
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select(
        F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.concat(F.lit(" "), F.upper("c_name"))).alias("family"),
        F.concat("c_mktsegment", "o_orderpriority").alias("baltimore_class"), F.col("o_orderkey").alias("ordinal"),
    )
    return tables.family_annotations(rows)


@query(
    "c5_annotated_families",
    """WITH a AS (SELECT n_nationkey, min(c_mktsegment) AS seg FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY n_nationkey HAVING count(*) FILTER (WHERE c_acctbal < 0) * 10 < count(*))
       SELECT s_suppkey, n_name AS family, coalesce(seg, '') AS baltimore_class FROM supplier JOIN nation ON s_nationkey = nation.n_nationkey LEFT JOIN a ON a.n_nationkey = nation.n_nationkey""",
)
def _c5(spark, folder):
    nation = table(spark, folder, "nation")
    cust = table(spark, folder, "customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    # nations with many customers in debt have no annotation
    notes = cust.groupBy(F.lower("n_name").alias("family_key")).agg(
        F.min("c_mktsegment").alias("baltimore_class"), F.count_if(F.col("c_acctbal") < 0).alias("debts"), F.count(F.lit(1)).alias("n")
    ).filter("debts * 10 < n")
    families = table(spark, folder, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", F.col("n_name").alias("family"))
    return report.annotate_families(families, notes)


@query(
    "a6_id_map_file",
    "SELECT 'ID_' || p_partkey AS short_id, p_name AS accession, p_name || '|' || p_brand AS display_name FROM part",
)
def _a6(spark, folder):
    path = scratch_folder(spark)
    part = table(spark, folder, "part")
    rows = part.select(
        F.concat(F.lit("ID_"), F.col("p_partkey").cast("string")).alias("short_id"), F.col("p_name").alias("accession"),
        F.concat_ws("|", "p_name", "p_brand").alias("display_name"),
    )
    tables.write_tsv(rows, path)
    return tables.read_tsv(spark, path, tables.ID_MAP_SCHEMA)


@query(
    "a7_summary_lineages",
    "SELECT c_name AS family, arg_max(o_orderpriority, o_orderkey) AS lineage FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY ALL",
)
def _a7(spark, folder):
    joined = table(spark, folder, "orders").join(table(spark, folder, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = joined.select(F.col("c_name").alias("family"), F.col("o_orderpriority").alias("lineage"), F.col("o_orderkey").alias("ordinal"))
    return tables.summary_lineages(rows)


@query(
    "a8_request_list",
    "SELECT c_name AS family FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'",
)
def _a8(spark, folder):
    path = scratch_folder(spark)
    line = F.when(F.col("c_acctbal") < 0, F.concat(F.lit("  # "), "c_name")).when(F.col("c_mktsegment") == "BUILDING", "   ").otherwise(F.concat(F.lit("  "), "c_name", F.lit(" ")))
    table(spark, folder, "customer").select(line.alias("value")).write.text(path)
    return tables.request_list(spark.read.text(path))


@query(
    "a10_status_sink",
    """SELECT c_name AS family, CAST(c_custkey AS VARCHAR) AS ncbi_taxid, CAST(NULL AS VARCHAR) AS molecule_region,
       CASE WHEN c_acctbal < 0 THEN 'too few' ELSE 'OK' END AS status, CAST(NULL AS VARCHAR) AS lineage, c_mktsegment AS baltimore_class FROM customer""",
)
def _a10(spark, folder):
    path = scratch_folder(spark)
    cust = table(spark, folder, "customer").select(
        F.col("c_name").alias("family"), F.col("c_custkey").alias("ncbi_taxid"), F.when(F.col("c_acctbal") < 0, "too few").otherwise("OK").alias("status"),
        F.col("c_mktsegment").alias("baltimore_class"), F.col("c_acctbal").alias("unknown_key"),
    )
    # two appends, as two runs would do
    tables.append_status(cust.filter("status = 'OK'"), path)
    tables.append_status(cust.filter("status <> 'OK'"), path)
    return spark.read.parquet(path)


@query(
    "a11_leaf_metadata",
    """SELECT 'C' || c_custkey % 100 AS short_id, CASE WHEN c_acctbal > 0 THEN c_name || '|x' ELSE '' END AS display_name, c_name AS accession, c_mktsegment AS species, c_nationkey % 2 AS target FROM customer""",
)
def _a11(spark, folder):
    path = scratch_folder(spark)
    cust = table(spark, folder, "customer")
    # Short ids repeat across families; the family tells them apart.
    sid = F.concat(F.lit("C"), (F.col("c_custkey") % 100).cast("string"))
    family = F.concat(F.lit("fam"), F.floor(F.col("c_custkey") / 100).cast("string"))
    none = F.lit("unknown")
    rows = cust.select(
        sid.alias("short_id"), F.col("c_name").alias("accession"), F.col("c_mktsegment").alias("species"), none.alias("strain"), none.alias("host"),
        none.alias("collection_date"), none.alias("location"), none.alias("taxon_id"), F.lit(1).alias("length"), family.alias("family"), (F.col("c_nationkey") % 2).alias("target"),
    )
    names = cust.filter("c_acctbal > 0").select(family.alias("family"), sid.alias("short_id"), F.concat("c_name", F.lit("|x")).alias("display_name"))
    tables.write_leaf_metadata(rows, names, path)
    back = tables.read_tsv(spark, path)
    return back.select("short_id", F.coalesce("display_name", F.lit("")).alias("display_name"), "accession", "species", F.col("target").cast("int").alias("target"))


# ---- Newick ---------------------------------------------------------------


def _newicks(spark, folder):
    """One small tree per part; parts of size 50 miss a parenthesis."""
    size = (F.col("p_size") / 10).cast("string")
    close = F.when(F.col("p_size") == 50, ";").otherwise(")Root;")
    value = F.concat(
        F.lit("("), "p_type", F.lit(":"), size, F.lit(",('"), "p_name", F.lit("':0.5,"), F.replace("p_brand", F.lit("#"), F.lit("_")), F.lit(":1e-1)"),
        F.col("p_size").cast("string"), F.lit(":0.25"), close,
    )
    return table(spark, folder, "part").select(F.col("p_partkey").alias("tree_id"), value.alias("newick"))


_NEWICK_SQL = """ok AS (SELECT *, p_partkey AS tree_id FROM part WHERE p_size <> 50),
nodes AS (SELECT tree_id, 0 AS node_id, NULL AS parent_id, false AS is_leaf, 'Root' AS name, CAST(NULL AS DOUBLE) AS branch_length, CAST(NULL AS DOUBLE) AS confidence FROM ok
 UNION ALL SELECT tree_id, 1, 0, true, p_type, p_size / 10.0::DOUBLE, NULL FROM ok
 UNION ALL SELECT tree_id, 2, 0, false, NULL, 0.25::DOUBLE, p_size::DOUBLE FROM ok
 UNION ALL SELECT tree_id, 3, 2, true, p_name, 0.5::DOUBLE, NULL FROM ok
 UNION ALL SELECT tree_id, 4, 2, true, replace(p_brand, '#', '_'), 0.1::DOUBLE, NULL FROM ok)"""


@query("a12_newick_nodes", f"WITH {_NEWICK_SQL} SELECT * FROM nodes")
def _a12(spark, folder):
    return newick.good_nodes(newick.parse_newick(_newicks(spark, folder))).drop("preorder")


@query("a12_newick_rejects", "SELECT p_partkey AS tree_id, 'no complete tree' AS reason FROM part WHERE p_size = 50")
def _a12r(spark, folder):
    return newick.rejects(newick.parse_newick(_newicks(spark, folder)))


# ---- names and keys -------------------------------------------------------

@query(
    "g1_year",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN '' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS year FROM orders""",
)
def _g1(spark, folder):
    d = F.col("o_orderdate")
    free = (
        F.when(F.col("o_orderstatus") == "O", F.date_format(d, "dd-MMM-yyyy"))
        .when(F.col("o_orderstatus") == "F", F.concat(F.lit("1799, 12345 or "), F.date_format(d, "yyyy-MM")))
        .otherwise("n/a 2100")
    )
    return table(spark, folder, "orders").select("o_orderkey", text.year_of(free).alias("year"))


@query(
    "g5_display_names",
    """SELECT c_custkey, replace(c_name, ' ', '_') || '|' || c_mktsegment || '|' || c_custkey || CASE WHEN c_nationkey > 12 THEN '|Homo_sapiens' ELSE '' END AS display_name,
       c_mktsegment || '|G' || c_custkey AS genome_name FROM (SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 'unknown' ELSE c_name || ' x' END AS c_name FROM customer)""",
)
def _g5(spark, folder):
    species = F.when(F.col("c_acctbal") >= 0, F.concat("c_name", F.lit(" x")))
    host = F.when(F.col("c_nationkey") > 12, "Homo sapiens").otherwise("unknown")
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        "c_custkey", text.display_name(species, F.col("c_mktsegment"), key, host).alias("display_name"),
        text.genome_display_name(F.col("c_mktsegment"), F.concat(F.lit("G"), key)).alias("genome_name"),
    )


@query(
    "g6_family_prefix",
    """SELECT p_partkey, CASE WHEN length(regexp_replace(upper(p_name), '[^A-Z]|[AEIOU]', '', 'g')) >= 4
         THEN substr(regexp_replace(upper(p_name), '[^A-Z]|[AEIOU]', '', 'g'), 1, 4) ELSE upper(substr(p_name, 1, 4)) END AS prefix FROM part""",
)
def _g6(spark, folder):
    return table(spark, folder, "part").select("p_partkey", text.family_prefix(F.col("p_name")).alias("prefix"))


@query(
    "g13_molecule_region",
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'P' THEN 'protein' ELSE 'nucleotide' END || ', ' || CASE WHEN o_orderpriority = '5-LOW' THEN 'segment L'
       WHEN o_orderstatus = 'O' THEN 'whole genome' ELSE 'gene: ' || o_orderpriority END AS molecule_region FROM orders""",
)
def _g13(spark, folder):
    kind = F.when(F.col("o_orderstatus") == "P", "protein").otherwise("nucleotide")
    region = F.when(F.col("o_orderstatus") == "O", "whole_genome").otherwise(F.col("o_orderpriority"))
    segment = F.when(F.col("o_orderpriority") == "5-LOW", "segment L")
    return table(spark, folder, "orders").select("o_orderkey", text.molecule_region(kind, region, segment).alias("molecule_region"))


@query(
    "g14_marker_slugs",
    "SELECT p_partkey, trim(regexp_replace('(' || p_name || ') ' || p_brand, '[^A-Za-z0-9_-]+', '_', 'g'), '_') AS slug FROM part",
)
def _g14(spark, folder):
    name = F.concat(F.lit("("), "p_name", F.lit(") "), "p_brand")
    return table(spark, folder, "part").select("p_partkey", text.marker_slug(name).alias("slug"))


@query(
    "g16_marker_hash_groups",
    """WITH n AS (SELECT DISTINCT p_brand AS family, split_part(p_name, ' ', 2) AS name, p_type FROM part),
       s AS (SELECT family, string_agg(name || p_type, ',' ORDER BY name, p_type) AS spec FROM n GROUP BY family)
       SELECT family, min(family) OVER (PARTITION BY spec) AS same_as, true AS well_formed FROM s""",
)
def _g16(spark, folder):
    nouns = table(spark, folder, "part").select(F.col("p_brand").alias("family"), F.split("p_name", " ")[1].alias("name"), "p_type").distinct()
    specs = nouns.select(
        "family", F.row_number().over(W.partitionBy("family").orderBy("name", "p_type")).alias("marker_order"), "name", F.array("p_type").alias("aliases"),
        F.create_map().cast("map<string,array<string>>").alias("sub_aliases"), F.lit(None).cast("int").alias("len_min"), F.lit(None).cast("int").alias("len_max"),
        F.lit(None).cast("string").alias("locus_tag_hint"),
    )
    hashed = ledger.marker_set_hash(specs)
    return hashed.select(
        "family", F.min("family").over(W.partitionBy("marker_hash")).alias("same_as"), F.col("marker_hash").rlike("^[0-9a-f]{8}$").alias("well_formed")
    )


@query(
    "g16_request_keys",
    """SELECT p_partkey, 'txid' || p_partkey || '_' || replace(p_name, ' ', '_') || '_' || CASE WHEN p_size > 25 THEN 'segment_L' ELSE 'none' END || '_' || p_size AS request_key FROM part""",
)
def _g16k(spark, folder):
    segment = F.when(F.col("p_size") > 25, "segment L")
    key = text.request_key(F.col("p_partkey").cast("string"), F.col("p_name"), segment, F.col("p_size"))
    return table(spark, folder, "part").select("p_partkey", key.alias("request_key"))


@query(
    "g17_lineage_string",
    "SELECT c_custkey, r_name || '; ' || n_name || '; ' || c_name AS lineage FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey",
)
def _g17(spark, folder):
    joined = (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select("c_custkey", text.lineage_string(F.array("r_name", "n_name", "c_name")).alias("lineage"))


@query(
    "g18_leaf_properties",
    """WITH b AS (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'unknown' ELSE o_orderpriority END AS host, strftime(o_orderdate, '%Y-%m') AS d, o_orderstatus AS sp, CAST(year(o_orderdate) AS VARCHAR) AS y FROM orders)
       SELECT o_orderkey, 'Host' AS property, host AS value FROM b WHERE host <> 'unknown' UNION ALL SELECT o_orderkey, 'Collection_Date', d FROM b
       UNION ALL SELECT o_orderkey, 'Year', y FROM b UNION ALL SELECT o_orderkey, 'Species', sp FROM b
       UNION ALL SELECT o_orderkey, 'Genus', sp || 'virus' FROM b WHERE sp <> 'P' UNION ALL SELECT o_orderkey, 'Subfamily', sp || 'virinae' FROM b""",
)
def _g18(spark, folder):
    status = F.col("o_orderstatus")
    entry = lambda name, rank: F.struct(name.alias("name"), rank.alias("rank"))
    leaves = table(spark, folder, "orders").select(
        "o_orderkey", F.when(status == "P", "unknown").otherwise(F.col("o_orderpriority")).alias("host"), F.date_format("o_orderdate", "yyyy-MM").alias("collection_date"),
        F.lit(" ").alias("location"), F.lit("unknown").alias("strain"), status.alias("species"),
        F.array(
            entry(F.concat(status, F.lit("virinae")), F.lit("Subfamily")),
            entry(F.concat(status, F.lit("virus")), F.when(status == "P", "no rank").otherwise("genus")),
        ).alias("lineage_ranked"),
    )
    return report.leaf_properties(leaves, ["o_orderkey"])


# ---- settings and dimensions ----------------------------------------------


@query(
    "c15_settings",
    """WITH s AS (SELECT p_brand AS family, p_type AS key, p_size % 4 AS layer, min(p_name) AS value FROM part GROUP BY ALL)
       SELECT family, key, arg_max(value, layer) AS value FROM s GROUP BY ALL""",
)
def _c15(spark, folder):
    rows = table(spark, folder, "part").groupBy(F.col("p_brand").alias("family"), F.col("p_type").alias("key"), (F.col("p_size") % 4).alias("layer"))
    return settings.resolve(rows.agg(F.min("p_name").alias("value")))


_FAMILIES = sorted({f for f, _ in [*dimensions.SEGMENTED_FAMILIES, *dimensions.DNA_FAMILIES]})


def _values(rows) -> str:
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else repr(v) for v in row) + ")" for row in rows) + ")"


_SEG_ROWS = dimensions.SEGMENTED_FAMILIES
_DNA_ROWS = [(f, r, "nucleotide" if r == "whole_genome" else "protein") for f, r in dimensions.DNA_FAMILIES]
_PRESET_ROWS = [(f, len(dimensions.preset_markers(f))) for f, _ in dimensions.PRESET_FAMILIES]


@query(
    "a13_dimension_defaults",
    f"""WITH f AS (SELECT p_partkey, ([{', '.join(repr(f) for f in _FAMILIES)}])[p_partkey % {len(_FAMILIES)} + 1] AS family FROM part)
    SELECT f.family, count(*) AS n, any_value(coalesce(s.segment, '')) AS segment,
      any_value(CASE WHEN p.n IS NOT NULL THEN 'concatenated' ELSE coalesce(d.region, 'whole_genome') END) AS region,
      any_value(CASE WHEN p.n IS NOT NULL THEN 'protein' WHEN d.region <> 'whole_genome' THEN d.kind ELSE 'nucleotide' END) AS molecule, any_value(coalesce(p.n, 0))::BIGINT AS n_markers
    FROM f LEFT JOIN {_values(_SEG_ROWS)} s(family, segment) ON s.family = f.family LEFT JOIN {_values(_DNA_ROWS)} d(family, region, kind) ON d.family = f.family
      LEFT JOIN {_values(_PRESET_ROWS)} p(family, n) ON p.family = f.family GROUP BY f.family""",
)
def _a13(spark, folder):
    # every part asks for one family; the presets decide its settings
    names = F.array(*[F.lit(f) for f in _FAMILIES])
    asked = table(spark, folder, "part").select(F.get(names, (F.col("p_partkey") % len(_FAMILIES)).cast("int")).alias("family"))
    counts = asked.groupBy("family").agg(F.count(F.lit(1)).alias("n"))
    families = counts.select("family")
    specs = dimensions.marker_presets(spark)
    layers = settings.layer_rows(spark, "defaults", families, settings.DEFAULTS).unionByName(
        settings.preset_rows(families, dimensions.segmented_families(spark), dimensions.dna_families(spark), specs)
    )
    best = settings.resolve(layers)
    pick = lambda key: F.max(F.when(F.col("key") == key, F.col("value")))
    wide = best.groupBy("family").agg(
        F.coalesce(pick("sequence.segment"), F.lit("")).alias("segment"), pick("sequence.region").alias("region"), pick("sequence.type").alias("molecule")
    )
    sizes = specs.groupBy("family").agg(F.count(F.lit(1)).alias("n_markers"))
    return counts.join(wide, "family").join(sizes, "family", "left").fillna(0, ["n_markers"])


# ---- ledger ---------------------------------------------------------------


def _ledger(spark, folder):
    events = table(spark, folder, "events")
    return events.select(
        F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("request_key"), F.col("ts").alias("downloaded"),
        F.when(F.col("value") < 3, 0).otherwise(F.floor(F.col("value") * 1000)).cast("bigint").alias("size_bytes"),
        F.get_json_object("props", "$.k").alias("family"), (F.col("event_type") == "error").alias("is_empty"),
    )


def _requests(spark, folder):
    cust = table(spark, folder, "customer").select(F.col("c_custkey").cast("string").alias("u"))
    kinds = F.explode(F.array(*[F.lit(x) for x in ("click", "error", "view")]))
    return cust.withColumn("k", kinds).select(F.concat_ws("|", "u", "k").alias("request_key"))


_NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_LEDGER_SQL = f"""led AS (SELECT user_id || '|' || event_type AS request_key, ts AS downloaded, CAST(CASE WHEN value < 3 THEN 0 ELSE floor(value * 1000) END AS BIGINT) AS size_bytes,
  json_extract_string(props, '$.k') AS family, event_type = 'error' AS is_empty FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_key, is_empty ORDER BY downloaded DESC, size_bytes DESC NULLS LAST, family DESC NULLS LAST) AS k FROM led) WHERE k = 1),
valid AS (SELECT * FROM latest WHERE downloaded >= {_NOW} - INTERVAL 2 DAY AND (is_empty OR size_bytes > 0)),
req AS (SELECT c_custkey || '|' || k AS request_key FROM customer CROSS JOIN (VALUES ('click'), ('error'), ('view')) t(k))"""


@query("c11_ledger_misses", f"WITH {_LEDGER_SQL} SELECT request_key FROM req WHERE request_key NOT IN (SELECT request_key FROM valid)")
def _c11(spark, folder):
    return ledger.misses(_requests(spark, folder), _ledger(spark, folder), F.expr(_NOW), 2)


@query("h11_ingest_plan", f"WITH {_LEDGER_SQL} SELECT req.request_key, CASE WHEN is_empty IS NULL THEN 'fetch' WHEN is_empty THEN 'negative' ELSE 'positive' END AS plan FROM req LEFT JOIN valid USING (request_key)")
def _h11(spark, folder):
    book, ask = _ledger(spark, folder), _requests(spark, folder)
    known = ledger.hits(ask, book, F.expr(_NOW), 2).select("request_key", F.when(F.col("negative"), "negative").otherwise("positive").alias("plan"))
    return known.unionByName(ledger.misses(ask, book, F.expr(_NOW), 2).withColumn("plan", F.lit("fetch")))


@query(
    "h11_ledger_deletes",
    f"WITH {_LEDGER_SQL} SELECT family, count(*) AS n FROM led WHERE family IS DISTINCT FROM '7' AND request_key NOT IN (SELECT request_key FROM valid) GROUP BY family",
)
def _h11d(spark, folder):
    book = _ledger(spark, folder)
    rest = ledger.without_requests(ledger.without_family(book, "7"), ledger.valid_entries(book, F.expr(_NOW), 2))
    return rest.groupBy("family").agg(F.count(F.lit(1)).alias("n"))


@query(
    "d17_ledger_stats",
    f"WITH {_LEDGER_SQL} SELECT count(*) FILTER (WHERE NOT is_empty) AS entries, count(*) FILTER (WHERE is_empty) AS empty_entries, round_even(sum(size_bytes) FILTER (WHERE NOT is_empty) / 1048576.0::DOUBLE, 1)::DOUBLE AS size_mb FROM latest",
)
def _d17(spark, folder):
    return ledger.stats(_ledger(spark, folder))


# ---- summaries ------------------------------------------------------------


def _family_rows(spark, folder):
    """Languages as families, with a lineage and a number made from the table."""
    docs = table(spark, folder, "documents")
    return docs.groupBy(F.col("lang").alias("family")).agg(F.min("doc_id").alias("ncbi_taxid")).select(
        "family", "ncbi_taxid", F.array(F.lit("Viruses"), F.col("family")).alias("lineage"), F.upper("family").alias("baltimore_class"),
        F.lit("nucleotide").alias("molecule"), F.when(F.col("family") == "en", "L1").otherwise("whole_genome").alias("region"), F.lit(None).cast("string").alias("segment"),
    )


_SUMMARY_VALUES = {
    "family": "f.family", "ncbi_taxid": "CAST(f.taxid AS VARCHAR)", "lineage": "'Viruses; ' || f.family", "baltimore_class": "upper(f.family)",
    "molecule_region": "'nucleotide, ' || CASE WHEN f.family = 'en' THEN 'gene: L1' ELSE 'whole genome' END",
    "species_discovered": "CAST(n_species AS VARCHAR)", "species_with_seqs": "CAST(n_with AS VARCHAR)", "species_relaxed_threshold": "CAST(n_relaxed AS VARCHAR)",
    "seqs_passing_qc": "CAST(n_passed AS VARCHAR)", "qc_excluded_organism": "CAST(n_org AS VARCHAR)", "qc_excluded_length": "CAST(n_len AS VARCHAR)",
    "qc_excluded_ambiguity": "CAST(n_amb AS VARCHAR)", "qc_undefined": "CAST(n_und AS VARCHAR)", "seqlen_min": "CAST(v[1] AS VARCHAR)",
    "seqlen_q1": "CAST(round_even(q1, 1)::DOUBLE AS VARCHAR)", "seqlen_median": "CAST(round_even(q2, 1)::DOUBLE AS VARCHAR)", "seqlen_mean": "CAST(round_even(mean, 1)::DOUBLE AS VARCHAR)",
    "seqlen_q3": "CAST(round_even(q3, 1)::DOUBLE AS VARCHAR)", "seqlen_max": "CAST(v[-1] AS VARCHAR)", "seqlen_iqr": "CAST(round_even(q3 - q1, 1)::DOUBLE AS VARCHAR)",
    "tree500_leaves": "CAST(l500 AS VARCHAR)", "tree100_leaves": "CAST(l100 AS VARCHAR)",
}
_D15 = f"""WITH {CHECKED_SQL}, good AS (SELECT * FROM flagged WHERE qc_reason = 'passed'), {exclusive_sql('good', 'family', 'length')},
f AS (SELECT lang AS family, min(doc_id) AS taxid FROM documents GROUP BY lang),
sp AS (SELECT family, species, count(*) FILTER (WHERE qc_reason = 'passed') AS p, max(share_used) AS s FROM flagged GROUP BY ALL),
c AS (SELECT family, count(*) AS n_species, count(*) FILTER (WHERE p > 0) AS n_with, count(*) FILTER (WHERE p > 0 AND s < 0.5) AS n_relaxed FROM sp GROUP BY family),
r AS (SELECT family, count(*) FILTER (WHERE qc_reason = 'passed') AS n_passed, count(*) FILTER (WHERE qc_reason = 'excluded_organism') AS n_org,
  count(*) FILTER (WHERE qc_reason = 'length') AS n_len, count(*) FILTER (WHERE qc_reason = 'ambiguity') AS n_amb, count(*) FILTER (WHERE qc_reason = 'undefined') AS n_und,
  least(500, count(*) FILTER (WHERE qc_reason = 'passed')) AS l500, least(100, count(*) FILTER (WHERE qc_reason = 'passed')) AS l100 FROM flagged GROUP BY family)
SELECT {', '.join(f"{_SUMMARY_VALUES.get(c, 'CAST(NULL AS VARCHAR)')} AS {c}" for c in tables.summary_columns())}
FROM f JOIN c USING (family) JOIN r USING (family) JOIN quart USING (family)"""


def _summary(spark, folder):
    flagged = cut_lineage(quality.flagged(spark, folder).drop("seq", "description"))
    good = qc.passed(flagged)
    counts = qc.breakdown(flagged)
    totals = counts.filter(F.col("species").isNull()).select(
        "family", F.col("n_relaxed").alias("species_relaxed_threshold"), F.col("n_passed").alias("seqs_passing_qc"), F.col("n_excluded_organism").alias("qc_excluded_organism"),
        F.col("n_excluded_length").alias("qc_excluded_length"), F.col("n_excluded_ambiguity").alias("qc_excluded_ambiguity"), F.col("n_undefined").alias("qc_undefined"),
    )
    species = counts.filter(F.col("species").isNotNull()).groupBy("family").agg(
        F.count(F.lit(1)).alias("species_discovered"), F.count_if(F.col("n_passed") > 0).alias("species_with_seqs")
    )
    lengths = stats.five_number_summary(good, "family", "length", prefix="seqlen_").drop("seqlen_n")
    wide = totals.join(species, "family").join(lengths, "family", "left")
    targets = None
    for target in (500, 100):
        picked = sample.quota_sample(good.select("family", "species", "accession", "protected"), "family", "species", target)
        leaves = picked.groupBy("family").agg(F.count(F.lit(1)).cast("string").alias("value")).select(
            "family", F.lit(target).alias("target"), F.lit("leaves").alias("key"), "value"
        )
        targets = leaves if targets is None else targets.unionByName(leaves)
    return report.summary_rows(_family_rows(spark, folder), report.long_stats(wide, ["family"]), targets)


@query("d15_summary_rows", _D15)
def _d15(spark, folder):
    return _summary(spark, folder)


@query("a9_summary_sink", _D15)
def _a9(spark, folder):
    path = scratch_folder(spark)
    rows = _summary(spark, folder).withColumn("not_a_column", F.lit(1))
    tables.append_summary(rows, path)
    return spark.read.parquet(path)


@query(
    "d16_status_rows",
    f"""WITH {CHECKED_SQL}, n AS (SELECT family, species, count(*) FILTER (WHERE qc_reason = 'passed') AS n, min(ordinal) AS t FROM flagged GROUP BY ALL)
        SELECT family || '/' || species AS family, CAST(t AS VARCHAR) AS ncbi_taxid, 'protein, segment L' AS molecule_region,
          CASE WHEN n < 4 THEN 'fewer than 4 sequences' ELSE 'OK' END AS status, family || '; ' || species AS lineage, '' AS baltimore_class FROM n""",
)
def _d16(spark, folder):
    flagged = quality.flagged(spark, folder)
    name = F.concat_ws("/", "family", "species")
    families = flagged.groupBy("family", "species").agg(F.min("ordinal").alias("ncbi_taxid")).select(
        name.alias("family"), "ncbi_taxid", F.array("family", "species").alias("lineage"), F.lit("protein").alias("molecule"),
        F.lit("x").alias("region"), F.lit("segment L").alias("segment"), F.lit("").alias("baltimore_class"),
    )
    few = flagged.groupBy(name.alias("family")).agg(F.count_if(F.col("qc_reason") == "passed").alias("n")).filter("n < 4")
    return report.status_rows(families, few.select("family", F.lit("fewer than 4 sequences").alias("reason")))


_H12 = """WITH s AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL), b AS (SELECT c_name AS family, CASE WHEN n IS NULL THEN 'pending' WHEN n >= 12 THEN 'done' ELSE 'skipped' END AS state,
  CASE WHEN n < 12 THEN 'too few orders' ELSE '' END AS note FROM customer LEFT JOIN s ON o_custkey = c_custkey)"""


def _board(spark, folder):
    cust = table(spark, folder, "customer")
    done = table(spark, folder, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    status = done.join(cust, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("c_name").alias("family"), F.when(F.col("n") >= 12, "OK").otherwise("too few orders").alias("status")
    )
    return report.progress_board(cust.select(F.col("c_name").alias("family")), status)


@query("h12_progress_board", f"{_H12} SELECT family, state, note FROM b")
def _h12(spark, folder):
    return _board(spark, folder)


@query("h12_progress_counts", f"{_H12} SELECT state, count(*) AS n FROM b GROUP BY state")
def _h12c(spark, folder):
    return report.progress_counts(_board(spark, folder))


@query(
    "f7_flattened_markers",
    """SELECT l_linestatus AS family, 'GB' || l_orderkey AS genome_id, split_part(p_name, ' ', 2) AS marker, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL""",
)
def _f7(spark, folder):
    joined = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    # nested genome -> markers, flattened back to one long table
    nested = joined.select(
        F.col("l_linestatus").alias("family"), F.concat(F.lit("GB"), F.col("l_orderkey").cast("string")).alias("genome_id"), F.array(F.split("p_name", " ")[1]).alias("markers")
    )
    return nested.select("family", "genome_id", F.explode("markers").alias("marker")).groupBy("family", "genome_id", "marker").agg(F.count(F.lit(1)).alias("n"))


@query(
    "e4_target_outliers",
    f"""WITH {RECORDS_SQL}, {quota_sql('records', 'family', 'species', 100, True)},
        s AS (SELECT r.* FROM (SELECT *, row_number() OVER (PARTITION BY family, species ORDER BY protected DESC, md5('42|' || accession), accession) AS k FROM records) r JOIN plan USING (family, species) WHERE k <= quota),
        m AS (SELECT *, median(length) OVER (PARTITION BY family) AS med FROM s)
        SELECT family, max(med)::DOUBLE AS median_length, count(*) AS n, count(*) FILTER (WHERE length > med * 3.0::DOUBLE AND NOT protected) AS n_long,
          count(*) FILTER (WHERE length < med * 0.333::DOUBLE AND NOT protected) AS n_short,
          count(*) FILTER (WHERE (length > med * 3.0::DOUBLE OR length < med * 0.333::DOUBLE) AND protected) AS n_protected FROM m GROUP BY family""",
)
def _e4t(spark, folder):
    rows = records(spark, folder).select("family", "species", "accession", "length", "protected")
    picked = sample.quota_sample(rows, "family", "species", 100)
    return qc.outlier_counts(qc.flag_length_outliers(picked, "family", low=0.333), "family")


@query(
    "g4_isolates",
    "SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'strain ' || c_mktsegment ELSE c_name END AS isolate FROM customer",
)
def _g4(spark, folder):
    blank = F.when(F.col("c_acctbal") < 0, "  ").otherwise(F.concat(F.lit(" "), "c_name"))
    qualifiers = F.create_map(F.lit("isolate"), F.array(blank), F.lit("strain"), F.array(F.concat(F.lit("strain "), "c_mktsegment")))
    gene = F.struct(F.lit("gene").alias("type"), F.create_map(F.lit("isolate"), F.array(F.lit("wrong"))).alias("qualifiers"))
    features = F.array(gene, F.struct(F.lit("source").alias("type"), qualifiers.alias("qualifiers")))
    return table(spark, folder, "customer").select("c_custkey", text.isolate_of(features).alias("isolate"))


@query(
    "c6_name_text",
    "SELECT p_partkey, p_name || ' ' || p_type || ' ' || p_brand AS text FROM part",
)
def _c6t(spark, folder):
    feature = lambda kind, key, value: F.struct(F.lit(kind).alias("type"), F.create_map(F.lit(key), F.array(value)).alias("qualifiers"))
    features = F.array(feature("CDS", "product", F.col("p_type")), feature("gene", "product", F.lit("no")), feature("Protein", "name", F.col("p_brand")))
    return table(spark, folder, "part").select("p_partkey", markers.name_text(F.col("p_name"), features).alias("text"))
