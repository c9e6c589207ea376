"""Queries: marker matching, genome assembly, concatenation, alignment statistics."""

from __future__ import annotations

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import charset_name
from ..operators import cluster, concat, markers
from ..operators.qc import drop_length_outliers, outlier_counts
from ..operators.settings import marker_violations
from ..session import cut_lineage
from .assemble import select_genomes
from .catalog_quality import quota_sql
from .cluster_sql import absorb_sql, adaptive_sql, ctes
from .registry import query, table

MIN_FRACTION = 0.2


def proteins(spark, folder):
    """Line items as proteins: the order is the genome, the part name the description."""
    items = table(spark, folder, "lineitem").join(table(spark, folder, "part"), F.col("l_partkey") == F.col("p_partkey"))
    prefix = F.when(F.col("l_orderkey") % 25 == 0, "NC_").otherwise("GB")
    return items.select(
        F.col("l_linestatus").alias("family"),
        F.col("l_returnflag").alias("species"),
        F.when(F.col("l_discount") >= 0.095, "").otherwise(F.concat(prefix, F.col("l_orderkey").cast("string"))).alias("genome_id"),
        F.concat_ws(".", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]).alias("accession"),
        F.col("p_name").alias("text"),
        F.floor("l_extendedprice").alias("length"),
        F.col("p_brand").alias("locus_tag"),
        F.col("p_type").alias("subfamily"),
        F.when(F.col("l_tax") < 0.005, "").otherwise(F.concat(F.lit("S"), F.col("l_suppkey").cast("string"))).alias("isolate"),
        (F.col("l_linenumber").cast("bigint") * 10**12 + F.col("l_partkey")).alias("ordinal"),
    )


def marker_specs(proteins_df):
    """Markers found in the data: the nouns of the part names, per family."""
    nouns = proteins_df.select("family", F.split("text", " ")[1].alias("name")).distinct()
    none = F.array().cast("array<string>")
    name = F.col("name")
    return nouns.select(
        "family",
        F.row_number().over(W.partitionBy("family").orderBy("name")).alias("marker_order"),
        "name",
        F.when(name == "bolt", F.array(F.lit("Hot"))).otherwise(none).alias("aliases"),
        F.when(name == "gear", F.create_map(F.lit("PROMO"), F.array(F.lit("old ")))).alias("sub_aliases"),
        F.when(name == "anvil", 20000).alias("len_min"),
        F.when(name == "anvil", 40000).alias("len_max"),
        F.when(name == "ring", "brand#1|BRAND#2$").alias("locus_tag_hint"),
    )


PROTEINS_SQL = """prot AS MATERIALIZED (
  SELECT l_linestatus AS family, l_returnflag AS species,
         CASE WHEN l_discount >= 0.095 THEN '' ELSE (CASE WHEN l_orderkey % 25 = 0 THEN 'NC_' ELSE 'GB' END) || l_orderkey END AS genome_id,
         l_orderkey || '.' || l_linenumber || '.' || l_partkey || '.' || l_suppkey AS accession, p_name AS text,
         CAST(floor(l_extendedprice) AS BIGINT) AS length, p_brand AS locus_tag, p_type AS subfamily,
         CASE WHEN l_tax < 0.005 THEN '' ELSE 'S' || l_suppkey END AS isolate, CAST(l_linenumber AS BIGINT) * 1000000000000 + l_partkey AS ordinal
  FROM lineitem JOIN part ON l_partkey = p_partkey),
mk AS MATERIALIZED (SELECT family, name, CAST(row_number() OVER (PARTITION BY family ORDER BY name) AS INTEGER) AS marker_order
       FROM (SELECT DISTINCT family, split_part(text, ' ', 2) AS name FROM prot)),
matched AS MATERIALIZED (SELECT p.*, m.name AS marker, m.marker_order, m.name = 'ring' AND regexp_matches(locus_tag, '(?i)(brand#1|brand#2$)') AS hit,
         CASE WHEN m.name = 'anvil' THEN abs(length - 30000) ELSE -length END AS fit
  FROM prot p JOIN mk m ON p.family = m.family AND (contains(lower(text), m.name) OR (m.name = 'bolt' AND contains(lower(text), 'hot'))
       OR (m.name = 'gear' AND subfamily = 'PROMO' AND contains(lower(text), 'old ')))),
chosen AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, genome_id, marker ORDER BY hit DESC, fit, accession, length) AS k
           FROM matched WHERE genome_id <> '') WHERE k = 1),
need AS MATERIALIZED (SELECT family, count(*) AS n_markers, CAST(greatest(1, round_even(0.2::DOUBLE * count(*), 0)) AS INTEGER) AS n_required FROM mk GROUP BY family),
cover AS MATERIALIZED (SELECT c.family, genome_id, count(*) AS n_covered, count(*) >= any_value(n_required) AS kept FROM chosen c JOIN need USING (family) GROUP BY ALL),
kept AS MATERIALIZED (SELECT chosen.* FROM chosen SEMI JOIN (SELECT * FROM cover WHERE kept) USING (family, genome_id))"""


@query("c6_marker_matches", f"WITH {PROTEINS_SQL} SELECT family, marker, subfamily, count(*) AS n, CAST(sum(length) AS BIGINT) AS total FROM matched GROUP BY ALL")
def _c6(spark, folder):
    prots = proteins(spark, folder)
    hits = markers.match_markers(prots, marker_specs(prots))
    return hits.groupBy("family", F.col("name").alias("marker"), "subfamily").agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("total"))


@query(
    "c7_effective_names",
    f"""WITH {PROTEINS_SQL} SELECT DISTINCT mk.family, name, subfamily, concat_ws(';', name, CASE WHEN name = 'bolt' THEN 'Hot' END,
        CASE WHEN name = 'gear' AND subfamily = 'PROMO' THEN 'old ' END) AS names FROM mk JOIN prot ON mk.family = prot.family""",
)
def _c7(spark, folder):
    prots = proteins(spark, folder)
    pairs = prots.select("family", "subfamily").distinct().join(marker_specs(prots), "family")
    return pairs.select("family", "name", "subfamily", F.array_join(markers.effective_names(F.col("subfamily")), ";").alias("names"))


@query("e3_paralog_choice", f"WITH {PROTEINS_SQL} SELECT family, genome_id, marker, marker_order, accession, length FROM chosen")
def _e3(spark, folder):
    prots = proteins(spark, folder).filter(F.length("genome_id") > 0)
    return markers.identify_markers(prots, marker_specs(proteins(spark, folder)))


@query("d7_minimum_coverage", f"WITH {PROTEINS_SQL} SELECT family, genome_id, n_covered, kept FROM cover")
def _d7(spark, folder):
    prots = proteins(spark, folder)
    specs = marker_specs(prots)
    chosen = markers.identify_markers(prots.filter(F.length("genome_id") > 0), specs)
    return markers.covered_genomes(chosen, specs, MIN_FRACTION)


@query("h5_assembly", f"WITH {PROTEINS_SQL} SELECT family, genome_id, marker, accession, length FROM kept")
def _h5(spark, folder):
    prots = proteins(spark, folder)
    return markers.assemble(prots, marker_specs(prots), MIN_FRACTION).drop("marker_order")


_SPLIT = """iso AS (SELECT family, genome_id, arg_min(isolate, (ordinal, isolate)) AS isolate FROM prot WHERE genome_id <> '' AND isolate <> '' GROUP BY ALL),
split AS (SELECT family, count(*) AS n_split FROM (SELECT family, isolate FROM iso GROUP BY ALL HAVING count(*) > 1) GROUP BY family)"""


@query("d9_split_submissions", f"WITH {PROTEINS_SQL}, {_SPLIT} SELECT * FROM split")
def _d9(spark, folder):
    return markers.split_submissions(proteins(spark, folder), ["family"])


@query(
    "d8_assembly_counters",
    f"""WITH {PROTEINS_SQL}, {_SPLIT}, b AS (SELECT family, count(*) AS n_proteins, count(*) FILTER (WHERE genome_id = '') AS n_orphans,
          count(DISTINCT nullif(genome_id, '')) AS n_genomes_found FROM prot GROUP BY family),
        k AS (SELECT family, count(*) AS n_genomes_kept, count(*) FILTER (WHERE genome_id LIKE 'NC!_%' ESCAPE '!') AS n_protected_kept FROM cover WHERE kept GROUP BY family)
        SELECT family, n_proteins, n_orphans, n_genomes_found, n_required, coalesce(n_genomes_kept, 0) AS n_genomes_kept,
               coalesce(n_protected_kept, 0) AS n_protected_kept, coalesce(n_split, 0) AS n_split, n_genomes_found - coalesce(n_genomes_kept, 0) AS n_dropped
        FROM b LEFT JOIN need USING (family) LEFT JOIN k USING (family) LEFT JOIN split USING (family)""",
)
def _d8(spark, folder):
    prots = proteins(spark, folder)
    return markers.assembly_counters(prots, marker_specs(prots), MIN_FRACTION)


@query(
    "d6_marker_coverage",
    f"""WITH {PROTEINS_SQL}, c AS (SELECT mk.family, mk.name, mk.marker_order, count(kept.genome_id) AS n FROM mk LEFT JOIN kept
          ON mk.family = kept.family AND mk.name = kept.marker GROUP BY ALL)
        SELECT family, count(*) AS n_markers_target, count(*) FILTER (WHERE n > 0) AS n_markers_used,
               string_agg(name || ':' || n, ',' ORDER BY marker_order) AS marker_coverage FROM c GROUP BY family""",
)
def _d6(spark, folder):
    prots = proteins(spark, folder)
    specs = marker_specs(prots)
    return markers.coverage_summary(markers.marker_coverage(markers.assemble(prots, specs, MIN_FRACTION), specs))


_E5 = f"""{PROTEINS_SQL}, m AS (SELECT *, genome_id LIKE 'NC!_%' ESCAPE '!' AS protected, median(length) OVER (PARTITION BY family, marker) AS med FROM kept),
f AS (SELECT *, CASE WHEN med > 0 AND length > med * 1.5::DOUBLE THEN 'long' WHEN med > 0 AND length < med * 0.333::DOUBLE THEN 'short' END AS side FROM m)"""


def _cells(spark, folder):
    prots = proteins(spark, folder)
    cells = markers.assemble(prots, marker_specs(prots), MIN_FRACTION)
    cells = cells.select("family", "genome_id", "marker", "length", F.col("genome_id").startswith("NC_").alias("protected"))
    # written once: the medians and the flags read them, and each would assemble all genomes again
    return concat.flag_marker_outliers(cut_lineage(cells), high=1.5)


@query("e5_marker_outliers", f"WITH {_E5} SELECT family, genome_id, marker, length FROM f WHERE side IS NULL OR protected")
def _e5(spark, folder):
    return drop_length_outliers(_cells(spark, folder)).select("family", "genome_id", "marker", "length")


@query(
    "e5_marker_outlier_counts",
    f"""WITH {_E5} SELECT family, marker, max(med)::DOUBLE AS median_length, count(*) AS n, count(*) FILTER (WHERE side = 'long' AND NOT protected) AS n_long,
        count(*) FILTER (WHERE side = 'short' AND NOT protected) AS n_short, count(*) FILTER (WHERE side IS NOT NULL AND protected) AS n_protected FROM f GROUP BY ALL""",
)
def _e5c(spark, folder):
    return outlier_counts(_cells(spark, folder), ["family", "marker"])


@query(
    "c9_restrict_genomes",
    """SELECT l_linestatus AS family, 'GB' || l_orderkey AS genome_id, l_returnflag AS species FROM lineitem
       WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT') GROUP BY ALL""",
)
def _c9(spark, folder):
    items = table(spark, folder, "lineitem").select(
        F.col("l_linestatus").alias("family"), F.concat(F.lit("GB"), F.col("l_orderkey").cast("string")).alias("genome_id"), F.col("l_returnflag").alias("species")
    )
    urgent = table(spark, folder, "orders").filter("o_orderpriority = '1-URGENT'")
    genome = F.concat(F.lit("GB"), F.col("o_orderkey").cast("string")).alias("genome_id")
    chosen = urgent.select(F.explode(F.array(F.lit("O"), F.lit("F"))).alias("family"), genome)
    return markers.genome_species(markers.restrict_genomes(items, chosen))


# ---- whole conversations as genomes ---------------------------------------


def _talks(spark, folder):
    """Turns as markers of a conversation; the number of turns is the species."""
    talk = table(spark, folder, "conversations")
    size = talk.groupBy("conv_id").agg(F.count(F.lit(1)).cast("string").alias("species"))
    prefix = F.when(F.col("conv_id") % 25 == 0, "NC_").otherwise("GB")
    return talk.join(size, "conv_id").select(
        F.lit("all").alias("family"), "species", F.concat(prefix, F.lpad(F.col("conv_id").cast("string"), 8, "0")).alias("genome_id"),
        F.col("turn").alias("marker_order"), F.col("text").alias("seq"),
    )


_TALKS_SQL = """talk AS (SELECT 'all' AS family, CAST(count(*) AS VARCHAR) AS species,
  (CASE WHEN conv_id % 25 = 0 THEN 'NC_' ELSE 'GB' END) || lpad(CAST(conv_id AS VARCHAR), 8, '0') AS accession,
  conv_id % 25 = 0 AS protected, string_agg(text, '' ORDER BY turn) AS seq FROM conversations GROUP BY conv_id)"""


@query("g15_raw_concat", f"WITH {_TALKS_SQL} SELECT family, species, accession AS genome_id, seq FROM talk")
def _g15(spark, folder):
    return concat.raw_concat(_talks(spark, folder))


_RULES = cluster.ClusterRules(molecule="text", hashing="md5")
_H6 = f"""WITH {_TALKS_SQL}, {ctes(absorb_sql('b_', 'talk', _RULES))},
  kept AS MATERIALIZED (SELECT * FROM talk ANTI JOIN b_absorbed USING (family, species, accession)),
  {ctes(adaptive_sql('a_', 'kept', [5], _RULES))},
  reps AS (SELECT t.* FROM talk t SEMI JOIN a_reps USING (family, species, accession)), {quota_sql('reps', 'family', 'species', 20, True)},
  sel AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY family, species ORDER BY protected DESC, md5('42|' || accession), accession) AS k FROM reps)
          JOIN plan USING (family, species) WHERE k <= quota)"""


@query("h6_genome_selection", f"{_H6} SELECT family, species, accession AS genome_id, protected FROM sel")
def _h6(spark, folder):
    return select_genomes(_talks(spark, folder), 20, 5, _RULES)[0].select("family", "species", "genome_id", "protected")


@query(
    "h6_selection_stats",
    f"""{_H6}, l AS (SELECT family, species, count(*) AS n FROM b_absorbed GROUP BY ALL)
    SELECT family, CAST(sum(coalesce(n, 0)) AS BIGINT) AS n_absorbed, min(threshold) AS cluster_thresh_min, max(threshold) AS cluster_thresh_max,
      (SELECT count(DISTINCT species) FROM reps) AS n_species_with_reps, (SELECT count(*) FROM reps) AS n_total_reps, (SELECT count(*) FROM sel) AS n_selected
    FROM a_used LEFT JOIN l USING (family, species) GROUP BY family""",
)
def _h6s(spark, folder):
    return select_genomes(_talks(spark, folder), 20, 5, _RULES)[1]


# ---- aligned parts --------------------------------------------------------


def _aligned(spark, folder):
    """Part names padded to the width of their block: brand = family, size = genome, type = marker."""
    part = table(spark, folder, "part")
    cells = part.groupBy(F.col("p_brand").alias("family"), F.col("p_size").alias("genome_id"), F.col("p_type").alias("marker")).agg(
        F.replace(F.min("p_name"), F.lit(" "), F.lit("-")).alias("aln")
    )
    order = F.row_number().over(W.partitionBy("family").orderBy("marker"))
    widths = cells.groupBy("family", "marker").agg(F.max(F.length("aln")).alias("w")).withColumn("marker_order", order)
    return cells.join(widths, ["family", "marker"]).withColumn("aln", F.expr("rpad(aln, w, '-')")).drop("w")


_ALIGNED_SQL = """cells AS (SELECT p_brand AS family, p_size AS genome_id, p_type AS marker, replace(min(p_name), ' ', '-') AS raw FROM part GROUP BY ALL),
widths AS (SELECT family, marker, max(length(raw)) AS w, row_number() OVER (PARTITION BY family ORDER BY marker) AS marker_order FROM cells GROUP BY family, marker),
blocks AS (SELECT *, sum(w) OVER (PARTITION BY family ORDER BY marker_order) AS e FROM widths),
aligned AS (SELECT c.family, genome_id, c.marker, marker_order, w, rpad(raw, CAST(w AS INTEGER), '-') AS aln FROM cells c JOIN widths USING (family, marker))"""


@query("e12_partitions", f"WITH {_ALIGNED_SQL} SELECT family, marker, CAST(e - w + 1 AS BIGINT) AS start_col, CAST(e AS BIGINT) AS end_col FROM blocks")
def _e12(spark, folder):
    return concat.marker_blocks(_aligned(spark, folder)).select("family", "marker", "start_col", "end_col")


for _name in ("c10_padded_grid", "h7_concatenation"):

    @query(
        _name,
        f"""WITH {_ALIGNED_SQL}, g AS (SELECT DISTINCT p_brand AS family, p_size AS genome_id FROM part)
        SELECT g.family, g.genome_id, string_agg(coalesce(a.aln, repeat('-', CAST(b.w AS INTEGER))), '' ORDER BY b.marker_order) AS aln
        FROM g JOIN blocks b ON g.family = b.family LEFT JOIN aligned a ON a.family = g.family AND a.genome_id = g.genome_id AND a.marker = b.marker GROUP BY ALL""",
    )
    def _grid(spark, folder, name=_name):
        genomes = table(spark, folder, "part").select(F.col("p_brand").alias("family"), F.col("p_size").alias("genome_id")).distinct()
        aligned = _aligned(spark, folder)
        if name == "h7_concatenation":
            # alignments that fail the width check do not take part
            bad = concat.alignment_violations(aligned, ["family", "marker"], min_rows=1)
            aligned = aligned.join(bad, ["family", "marker"], "left_anti")
        return concat.concatenate(aligned, genomes)


@query(
    "b17_alignment_checks",
    """WITH v AS (SELECT p_brand, p_type, count(*) AS n_rows, min(length(p_name)) AS lo, max(length(p_name)) AS hi FROM part GROUP BY ALL)
       SELECT p_brand, p_type, n_rows, CASE WHEN n_rows < 2 THEN 'too few rows' ELSE 'unequal widths' END AS reason FROM v WHERE n_rows < 2 OR lo <> hi""",
)
def _b17(spark, folder):
    bad = concat.alignment_violations(table(spark, folder, "part"), ["p_brand", "p_type"], "p_name")
    return bad.select("p_brand", "p_type", "n_rows", "reason")


@query(
    "d4_alignment_stats",
    """WITH a AS (SELECT p_brand, p_type, p_partkey, replace(p_name, ' ', '-') AS aln FROM part),
       s AS (SELECT p_brand, p_type, count(*) AS n, arg_min(length(aln), p_partkey) AS w, sum(length(aln) - length(replace(aln, '-', ''))) AS g FROM a GROUP BY ALL)
       SELECT p_brand, p_type, n AS n_rows, CAST(w AS INTEGER) AS length, round_even(100.0::DOUBLE * g / (w * n), 1)::DOUBLE AS gap_pct FROM s""",
)
def _d4(spark, folder):
    part = table(spark, folder, "part").withColumn("aln", F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
    return concat.alignment_stats(part, ["p_brand", "p_type"], "p_partkey")


def _written(spark, folder):
    """Whole documents as alignment rows of unequal width, blanks as gaps: language = family, source = marker."""
    docs = table(spark, folder, "documents")
    return docs.select(F.col("lang").alias("family"), F.col("source").alias("marker"), F.col("doc_id").alias("genome_id"),
                       F.replace(F.coalesce("text", F.lit("")), F.lit(" "), F.lit("-")).alias("aln"))


_COLS = """d AS (SELECT lang AS family, source AS marker, doc_id AS genome_id, replace(coalesce(text, ''), ' ', '-') AS aln FROM documents),
ch AS MATERIALIZED (SELECT family, marker, genome_id, unnest(string_split(aln, '')) AS c, generate_subscripts(string_split(aln, ''), 1) AS p FROM d WHERE aln <> ''),
pos AS MATERIALIZED (SELECT family, marker, p, count(*) FILTER (WHERE c = '-') / count(*)::DOUBLE AS gap FROM ch GROUP BY ALL)"""


@query("d18_column_profile", f"WITH {_COLS} SELECT family, marker, CAST(p AS INTEGER) AS pos, round(gap, 9) AS gap_fraction FROM pos")
def _d18(spark, folder):
    profile = concat.column_profile(_written(spark, folder), ["family", "marker"])
    return profile.withColumn("gap_fraction", F.round("gap_fraction", 9))


@query(
    "d18_gap_trim",
    f"""WITH {_COLS}, kept AS (SELECT family, marker, CAST(count(*) FILTER (WHERE gap <= 0.5) AS INTEGER) AS n FROM pos GROUP BY ALL),
        cut AS (SELECT genome_id, string_agg(c, '' ORDER BY p) AS aln FROM ch JOIN pos USING (family, marker, p) WHERE gap <= 0.5 GROUP BY genome_id)
        SELECT family, marker, genome_id, CAST(length(d.aln) AS INTEGER) AS width_before, coalesce(n, 0) AS width_after, coalesce(cut.aln, '') AS aln
        FROM d LEFT JOIN kept USING (family, marker) LEFT JOIN cut USING (genome_id)""",
)
def _d18t(spark, folder):
    trimmed = concat.trim_gappy_columns(_written(spark, folder), ["family", "marker"], 0.5)
    return trimmed.select("family", "marker", "genome_id", "width_before", "width_after", "aln")


@query(
    "g14_charset_names",
    "SELECT p_partkey, coalesce(nullif(trim(regexp_replace(p_name || '/' || p_brand || '#', '[^A-Za-z0-9_]+', '_', 'g'), '_'), ''), 'marker') AS charset FROM part",
)
def _g14(spark, folder):
    name = F.concat(F.col("p_name"), F.lit("/"), F.col("p_brand"), F.lit("#"))
    return table(spark, folder, "part").select("p_partkey", charset_name(name).alias("charset"))


@query(
    "b16_marker_checks",
    f"""WITH {PROTEINS_SQL}, w AS (SELECT family, n_required / 8.0::DOUBLE * 5 AS f FROM need)
        SELECT family, marker_order, 'length range is not increasing' AS problem FROM mk WHERE name = 'anvil' UNION ALL
        SELECT family, marker_order, 'length range is incomplete' FROM mk WHERE name = 'ring' UNION ALL
        SELECT family, NULL, 'min_fraction is not in (0, 1]' FROM w WHERE NOT (f > 0 AND f <= 1) """,
)
def _b16(spark, folder):
    prots = proteins(spark, folder)
    name = F.col("name")
    specs = marker_specs(prots).withColumns(
        {
            "len_min": F.when(name == "anvil", 400).when(name == "ring", 10),
            "len_max": F.when(name == "anvil", 300),
        }
    )
    wanted = markers.required_markers(specs, MIN_FRACTION).select(
        "family", (F.col("n_required") / F.lit(8.0) * 5).alias("min_fraction")
    )
    return marker_violations(specs, wanted)
