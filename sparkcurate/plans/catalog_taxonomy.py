"""Queries: lineages, ranks, common ancestors, taxon groups, trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import taxa as tx
from ..operators import lineage, stats, trees
from ..operators.scale import number_rows
from ..session import cut_lineage
from .catalog_quality import exclusive_sql
from .registry import query, table

# ---- taxa: region -> nation -> customer -----------------------------------


def taxa(spark, folder):
    region = table(spark, folder, "region").select(
        (F.col("r_regionkey") + 1).cast("bigint").alias("taxid"), F.lit(None).cast("bigint").alias("parent_taxid"),
        F.concat(F.initcap("r_name"), F.lit("viridae")).alias("name"), F.lit("family").alias("rank"),
    )
    nation = table(spark, folder, "nation").select(
        (F.col("n_nationkey") + 100).cast("bigint").alias("taxid"), (F.col("n_regionkey") + 1).cast("bigint").alias("parent_taxid"),
        F.concat("n_name", F.when(F.col("n_nationkey") % 3 == 0, "virinae").otherwise("virus")).alias("name"),
        F.when(F.col("n_nationkey") % 3 == 0, "subfamily").when(F.col("n_nationkey") % 3 == 1, "genus").otherwise("no rank").alias("rank"),
    )
    customer = table(spark, folder, "customer").select(
        (F.col("c_custkey") + 1000).alias("taxid"), (F.col("c_nationkey") + 100).cast("bigint").alias("parent_taxid"),
        F.when(F.col("c_acctbal") < 0, F.concat(F.lit("environmental samples "), "c_name")).otherwise(F.col("c_name")).alias("name"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "strain").otherwise("species").alias("rank"),
    )
    return region.unionByName(nation).unionByName(customer)


TAXA_SQL = """taxa AS (
  SELECT CAST(r_regionkey + 1 AS BIGINT) AS taxid, CAST(NULL AS BIGINT) AS parent, upper(r_name[1]) || lower(r_name[2:]) || 'viridae' AS name, 'family' AS rank FROM region
  UNION ALL SELECT n_nationkey + 100, n_regionkey + 1, n_name || CASE WHEN n_nationkey % 3 = 0 THEN 'virinae' ELSE 'virus' END,
    CASE n_nationkey % 3 WHEN 0 THEN 'subfamily' WHEN 1 THEN 'genus' ELSE 'no rank' END FROM nation
  UNION ALL SELECT c_custkey + 1000, c_nationkey + 100, CASE WHEN c_acctbal < 0 THEN 'environmental samples ' || c_name ELSE c_name END,
    CASE WHEN c_mktsegment = 'MACHINERY' THEN 'strain' ELSE 'species' END FROM customer),
region_names AS (SELECT taxid, CASE WHEN name = 'Middle eastviridae' THEN 'Middle Eastviridae' ELSE name END AS name FROM taxa),
lin AS (SELECT t.taxid, t.rank, t.name, p.taxid AS ptax, p.name AS pname, p.rank AS prank, g.taxid AS gtax,
          CASE WHEN g.name = 'Middle eastviridae' THEN 'Middle Eastviridae' ELSE g.name END AS gname, g.rank AS grank
        FROM (SELECT taxid, parent, rank, CASE WHEN name = 'Middle eastviridae' THEN 'Middle Eastviridae' ELSE name END AS name FROM taxa) t
        LEFT JOIN (SELECT taxid, parent, rank, CASE WHEN name = 'Middle eastviridae' THEN 'Middle Eastviridae' ELSE name END AS name FROM taxa) p ON p.taxid = t.parent
        LEFT JOIN taxa g ON g.taxid = p.parent)"""


@query(
    "c3_lineages",
    f"""WITH {TAXA_SQL} SELECT taxid, concat_ws('; ', gname || ':' || grank, pname || ':' || prank, name || ':' || rank) AS lineage FROM lin""",
)
def _c3(spark, folder):
    out = lineage.resolve_lineages(taxa(spark, folder))
    text = F.array_join(F.transform("lineage", lambda e: F.concat(e["name"], F.lit(":"), e["rank"])), "; ")
    return out.select("taxid", text.alias("lineage"))


@query(
    "c4_descendants",
    f"""WITH {TAXA_SQL} SELECT gtax AS root, taxid, name FROM lin WHERE gtax IS NOT NULL AND rank = 'species' AND NOT contains(lower(name), 'environmental samples')""",
)
def _c4(spark, folder):
    all_taxa = taxa(spark, folder)
    roots = lineage.taxid_of(all_taxa, all_taxa.filter("rank = 'family'").select("name"))
    roots = roots.select(F.col("taxid").alias("root"), F.col("name").alias("root_name"))
    return lineage.descendants_at_rank(lineage.resolve_lineages(all_taxa), roots)


@query(
    "c2_prefer_resolved",
    f"""WITH {TAXA_SQL} SELECT o_orderkey, CASE WHEN o_orderpriority <> '5-LOW' AND name IS NOT NULL THEN concat_ws('; ', gname, pname, name)
        ELSE o_orderstatus || '; ' || o_orderpriority END AS lineage FROM orders LEFT JOIN lin ON taxid = o_custkey + 1000""",
)
def _c2(spark, folder):
    orders = table(spark, folder, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_custkey") + 1000).alias("taxon_id"),
        F.array("o_orderstatus", "o_orderpriority").alias("lineage"),
    )
    out = lineage.prefer_resolved(orders, lineage.resolve_lineages(taxa(spark, folder)))
    return out.select("o_orderkey", F.array_join("lineage", "; ").alias("lineage"))


def _leaves(spark, folder):
    """Customers with their ranked lineage, grouped into one tree per market segment."""
    ranked = lineage.resolve_lineages(taxa(spark, folder)).withColumnRenamed("lineage", "lineage_ranked")
    cust = table(spark, folder, "customer").select(
        F.col("c_mktsegment").alias("tree_id"), "c_custkey", (F.col("c_custkey") + 1000).alias("taxid")
    )
    return cust.join(ranked, "taxid")


@query(
    "b11_reaches_rank",
    f"""WITH {TAXA_SQL} SELECT taxid, coalesce(rank IN ('genus', 'species', 'strain') OR prank = 'genus', false) AS genus_deep,
        coalesce(rank = 'strain', false) AS strain_deep, true AS any_deep FROM lin WHERE gtax IS NOT NULL""",
)
def _b11(spark, folder):
    leaves = _leaves(spark, folder)
    lin = F.col("lineage_ranked")
    return leaves.select(
        "taxid", tx.lineage_reaches(lin, "genus").alias("genus_deep"), tx.lineage_reaches(lin, "strain").alias("strain_deep"),
        tx.lineage_reaches(lin, "none").alias("any_deep"),
    )


@query(
    "d12_common_lineage",
    f"""WITH {TAXA_SQL}, m AS (SELECT floor(c_acctbal / 20) AS bin, gname, pname, name FROM customer JOIN lin ON taxid = c_custkey + 1000)
        SELECT CAST(bin AS BIGINT) AS bin, count(*) AS n, concat_ws('; ', CASE WHEN min(gname) = max(gname) THEN min(gname) END,
          CASE WHEN min(gname) = max(gname) AND min(pname) = max(pname) THEN min(pname) END,
          CASE WHEN min(gname) = max(gname) AND min(pname) = max(pname) AND min(name) = max(name) THEN min(name) END) AS common FROM m GROUP BY bin""",
)
def _d12(spark, folder):
    bins = table(spark, folder, "customer").select("c_custkey", F.floor(F.col("c_acctbal") / 20).alias("bin"))
    leaves = _leaves(spark, folder).join(bins, "c_custkey").withColumn("lineage", lineage.names_in(F.col("lineage_ranked")))
    return lineage.common_lineage(leaves, "bin").select("bin", "n", F.array_join("common", "; ").alias("common"))


_SUFFIX = """CASE {cases} WHEN lower({c}) LIKE '%virus' AND NOT contains(trim({c}), ' ') THEN 'genus' ELSE '' END"""


def suffix_sql(column: str) -> str:
    cases = " ".join(f"WHEN lower({column}) LIKE '%{s}' THEN '{r}'" for s, r in tx.RANK_SUFFIXES)
    return _SUFFIX.format(cases=cases, c=column)


_SUFFIX_NAMES = "p_name || CASE p_type " + " ".join(
    f"WHEN '{t}' THEN '{e}'" for t, e in [("STANDARD", "viridae"), ("LARGE", "virinae"), ("ECONOMY", "viricetes"), ("SMALL", "virus"), ("MEDIUM", "viria")]
) + " ELSE 'vira' END"


@query(
    "g7_suffix_rank",
    f"SELECT p_partkey, {suffix_sql('n')} AS rank FROM (SELECT p_partkey, CASE WHEN p_size < 25 THEN replace({_SUFFIX_NAMES}, ' ', '') ELSE {_SUFFIX_NAMES} END AS n FROM part)",
)
def _g7(spark, folder):
    ending = F.lit("vira")
    for kind, text in [("STANDARD", "viridae"), ("LARGE", "virinae"), ("ECONOMY", "viricetes"), ("SMALL", "virus"), ("MEDIUM", "viria")]:
        ending = F.when(F.col("p_type") == kind, text).otherwise(ending)
    full = F.concat("p_name", ending)
    name = F.when(F.col("p_size") < 25, F.replace(full, F.lit(" "), F.lit(""))).otherwise(full)
    return table(spark, folder, "part").select("p_partkey", tx.suffix_rank(name).alias("rank"))


@query(
    "g8_taxon_ranks",
    f"""WITH {TAXA_SQL}, e AS (SELECT gname AS n, grank AS r FROM lin WHERE gtax IS NOT NULL UNION SELECT pname, prank FROM lin WHERE gtax IS NOT NULL
          UNION SELECT name, rank FROM lin WHERE gtax IS NOT NULL)
        SELECT n AS name, coalesce(max(nullif(r, 'no rank')), {suffix_sql('n')}) AS rank FROM e GROUP BY n""",
)
def _g8(spark, folder):
    return lineage.taxon_ranks(_leaves(spark, folder), "taxid")


@query(
    "g9_schema_rank",
    f"SELECT p_partkey, CASE WHEN r IN ({', '.join(repr(r) for r in tx.SCHEMA_RANKS)}) THEN r ELSE 'other' END AS rank FROM (SELECT p_partkey, CASE p_size % 4 WHEN 0 THEN 'genus' WHEN 1 THEN 'realm' WHEN 2 THEN 'form' ELSE p_type END AS r FROM part)",
)
def _g9(spark, folder):
    size = F.col("p_size") % 4
    raw = F.when(size == 0, "genus").when(size == 1, "realm").when(size == 2, "form").otherwise(F.col("p_type"))
    return table(spark, folder, "part").select("p_partkey", tx.schema_rank(raw).alias("rank"))


@query(
    "g10_names_at_rank",
    f"""WITH {TAXA_SQL} SELECT taxid, CASE WHEN prank = 'genus' THEN pname END AS genus, CASE WHEN prank = 'subfamily' THEN pname END AS subfamily,
        gname AS family FROM lin WHERE gtax IS NOT NULL""",
)
def _g10(spark, folder):
    lin = F.col("lineage_ranked")
    return _leaves(spark, folder).select("taxid", *[tx.name_at_rank(lin, r).alias(r) for r in ("genus", "subfamily", "family")])


@query(
    "g11_genus_proxy",
    f"""WITH {TAXA_SQL} SELECT taxid, CASE WHEN prank = 'genus' THEN pname END AS none,
        CASE WHEN pname LIKE '%virus' THEN pname END AS suffix, pname AS deepest FROM lin WHERE gtax IS NOT NULL""",
)
def _g11(spark, folder):
    lin = F.col("lineage_ranked")
    return _leaves(spark, folder).select("taxid", *[tx.genus_of(lin, m).alias(m) for m in ("none", "suffix", "deepest")])


_REALM_CASES = " ".join(f"WHEN contains(l, '{f}') THEN '{g}'" for f, g in tx.REALM_GROUPS)


@query(
    "g12_realm_group",
    f"""SELECT c_custkey, CASE {_REALM_CASES} ELSE 'other' END AS realm FROM (SELECT c_custkey, lower('Viruses; ' || CASE c_nationkey % 5
        WHEN 0 THEN 'Riboviria; Negarnaviricota' WHEN 1 THEN 'Riboviria' WHEN 2 THEN 'Varidnaviria' WHEN 3 THEN 'Monodnaviria' ELSE c_mktsegment END) AS l FROM customer)""",
)
def _g12(spark, folder):
    k = F.col("c_nationkey") % 5
    text = (
        F.when(k == 0, "Riboviria; Negarnaviricota").when(k == 1, "Riboviria").when(k == 2, "Varidnaviria").when(k == 3, "Monodnaviria")
        .otherwise(F.col("c_mktsegment"))
    )
    return table(spark, folder, "customer").select("c_custkey", tx.realm_group(F.concat(F.lit("Viruses; "), text)).alias("realm"))


_GENUS = f"""{TAXA_SQL}, leaf AS (SELECT c_mktsegment AS tree_id, CASE WHEN prank <> 'subfamily' AND pname LIKE '%virus' THEN pname WHEN prank = 'subfamily' AND gname LIKE 'A%' THEN name END AS genus,
  CASE WHEN prank = 'subfamily' THEN pname END AS subfamily FROM customer JOIN lin ON taxid = c_custkey + 1000)"""


def _genus_leaves(spark, folder):
    """Give leaves of some subfamilies a genus, so that named groups have members."""
    leaves = _leaves(spark, folder)
    entry = F.element_at("lineage_ranked", -1)
    is_sub = F.exists("lineage_ranked", lambda e: e["rank"] == "subfamily")
    in_a = F.get("lineage_ranked", F.lit(0))["name"].startswith("A")
    genus = F.struct(entry["taxid"].alias("taxid"), entry["name"].alias("name"), F.lit("genus").alias("rank"))
    return leaves.withColumn(
        "lineage_ranked", F.when(is_sub & in_a, F.concat("lineage_ranked", F.array(genus))).otherwise(F.col("lineage_ranked"))
    )


@query(
    "e13_taxon_groups",
    f"""WITH {_GENUS}, g AS (SELECT tree_id, subfamily, genus, count(*) AS n_leaves FROM leaf WHERE genus IS NOT NULL GROUP BY ALL)
        SELECT tree_id, subfamily, genus, n_leaves, CAST(dense_rank() OVER (PARTITION BY tree_id ORDER BY subfamily IS NULL, subfamily) - 1 AS INTEGER) AS group_index,
          CAST(row_number() OVER (PARTITION BY tree_id, subfamily ORDER BY genus) - 1 AS INTEGER) AS genus_index, count(*) OVER (PARTITION BY tree_id, subfamily) AS group_size FROM g""",
)
def _e13(spark, folder):
    return lineage.taxon_groups(_genus_leaves(spark, folder), mode="suffix")


@query(
    "d11_taxon_counts",
    f"WITH {_GENUS} SELECT tree_id, count(DISTINCT genus) AS n_genera, count(DISTINCT subfamily) FILTER (WHERE genus IS NOT NULL) AS n_subfamilies FROM leaf GROUP BY tree_id",
)
def _d11(spark, folder):
    return lineage.taxon_counts(_genus_leaves(spark, folder), mode="suffix")


# ---- a forest: the orders of a customer as a binary tree ------------------


def forest(spark, folder):
    """One tree per customer; order i hangs below order i div 2."""
    orders = table(spark, folder, "orders")
    numbered = number_rows(orders, "o_custkey", [], "o_orderkey", "node_id")
    sizes = orders.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    node, leaf = F.col("node_id"), F.col("node_id") * 2 > F.col("n")
    return cut_lineage(
        numbered.join(sizes, "o_custkey").select(
            F.col("o_custkey").alias("tree_id"), "node_id",
            F.when(node > 1, F.floor(node / 2)).alias("parent_id"),
            node.alias("preorder"), leaf.alias("is_leaf"),
            F.when(leaf, F.concat(F.lit("L"), node.cast("string"))).alias("name"),
            F.when(node > 1, F.floor(F.col("o_totalprice")) / 1000).alias("branch_length"),
            F.when(~leaf & (F.col("o_orderstatus") != "P"), F.floor(F.col("o_totalprice") / 5000) / 100 * F.when(F.col("o_custkey") % 2 == 0, 1).otherwise(100)).alias("confidence"),
            F.col("o_orderpriority").alias("priority"),
        )
    )


FOREST_SQL = """nodes AS MATERIALIZED (SELECT tree_id, node_id, CASE WHEN node_id > 1 THEN node_id // 2 END AS parent_id, node_id AS preorder, node_id * 2 > n AS is_leaf,
  CASE WHEN node_id * 2 > n THEN 'L' || node_id END AS name, CASE WHEN node_id > 1 THEN floor(o_totalprice) / 1000 END AS branch_length,
  CASE WHEN node_id * 2 <= n AND o_orderstatus <> 'P' THEN floor(o_totalprice / 5000) / 100 * CASE WHEN tree_id % 2 = 0 THEN 1 ELSE 100 END END AS confidence, priority
  FROM (SELECT o_custkey AS tree_id, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS node_id, count(*) OVER (PARTITION BY o_custkey) AS n,
        o_totalprice, o_orderstatus, o_orderpriority AS priority FROM orders)),
clo AS MATERIALIZED (WITH RECURSIVE c(tree_id, node_id, leaf_id) AS (SELECT tree_id, node_id, node_id FROM nodes WHERE is_leaf
  UNION ALL SELECT c.tree_id, n.parent_id, c.leaf_id FROM c JOIN nodes n ON n.tree_id = c.tree_id AND n.node_id = c.node_id WHERE n.parent_id IS NOT NULL)
  SELECT * FROM c)"""


def leaf_lineages(nodes):
    """Lineages that follow the tree, with some leaves that do not vote."""
    leaves = nodes.filter("is_leaf")
    n = F.col("node_id")
    path = F.array(F.lit("root"), F.concat(F.lit("A"), F.floor(n / 4).cast("string")), F.concat(F.lit("B"), F.floor(n / 2).cast("string")), F.col("name"))
    path = F.when(F.col("priority") == "1-URGENT", F.array(F.lit("root"), F.lit("odd"))).otherwise(path)
    return leaves.filter("priority <> '5-LOW'").select("tree_id", "name", path.alias("lineage"))


VOTES_SQL = f"""{FOREST_SQL},
votes AS MATERIALIZED (SELECT tree_id, node_id AS leaf_id, name, CASE WHEN priority = '1-URGENT' THEN ['root', 'odd'] ELSE ['root', 'A' || (node_id // 4), 'B' || (node_id // 2), name] END AS lineage
  FROM nodes WHERE is_leaf AND priority <> '5-LOW'),
sizes AS MATERIALIZED (SELECT c.tree_id, c.node_id, count(*) AS n_leaves, count(v.leaf_id) AS n_voters FROM clo c LEFT JOIN votes v USING (tree_id, leaf_id) GROUP BY ALL),
levels AS (SELECT tree_id, node_id, d, min(v) AS taxon, min(v) = max(v) AND count(v) = any_value(n_voters) AS shared
  FROM (SELECT c.tree_id, c.node_id, s.n_voters, unnest(range(1, 5)) AS d, lineage[unnest(range(1, 5))] AS v FROM clo c JOIN votes USING (tree_id, leaf_id) JOIN sizes s USING (tree_id, node_id)) GROUP BY ALL),
depths AS MATERIALIZED (SELECT tree_id, node_id, coalesce(min(d) FILTER (WHERE NOT coalesce(shared, false)), 5) - 1 AS depth FROM levels GROUP BY ALL),
lab AS MATERIALIZED (SELECT n.tree_id, n.node_id, n.preorder, s.n_leaves, s.n_voters, CASE WHEN s.n_voters > 0 AND s.n_voters * 2 >= s.n_leaves THEN l.taxon END AS label
  FROM nodes n JOIN sizes s USING (tree_id, node_id) LEFT JOIN depths d USING (tree_id, node_id) LEFT JOIN levels l ON l.tree_id = n.tree_id AND l.node_id = n.node_id AND l.d = d.depth
  WHERE NOT n.is_leaf)"""


@query("c14_leaf_closure", f"WITH {FOREST_SQL} SELECT tree_id, node_id, leaf_id FROM clo")
def _c14(spark, folder):
    return trees.leaf_closure(forest(spark, folder))


@query("h8_node_labels", f"WITH {VOTES_SQL} SELECT tree_id, node_id, n_leaves, n_voters, label FROM lab")
def _h8(spark, folder):
    nodes = forest(spark, folder)
    out = trees.label_nodes(nodes, leaf_lineages(nodes))
    return out.select("tree_id", "node_id", "n_leaves", "n_voters", "label")


@query(
    "e10_crown_labels",
    f"""WITH {VOTES_SQL} SELECT tree_id, node_id, CASE WHEN row_number() OVER (PARTITION BY tree_id, label ORDER BY n_leaves DESC, preorder) = 1 THEN label END AS label FROM lab""",
)
def _e10(spark, folder):
    nodes = forest(spark, folder)
    return trees.crown_labels(trees.label_nodes(nodes, leaf_lineages(nodes))).select("tree_id", "node_id", "label")


@query(
    "e11_support_scale",
    f"""WITH {FOREST_SQL} SELECT tree_id, node_id, round_even(confidence * CASE WHEN max(confidence) OVER (PARTITION BY tree_id) <= 1 THEN 100 ELSE 1 END, 0)::DOUBLE AS confidence FROM nodes""",
)
def _e11(spark, folder):
    return trees.normalise_support(forest(spark, folder)).select("tree_id", "node_id", "confidence")


@query(
    "d3_support_summary",
    f"""WITH {FOREST_SQL}, scaled AS (SELECT tree_id, is_leaf, round_even(confidence * CASE WHEN max(confidence) OVER (PARTITION BY tree_id) <= 1 THEN 100 ELSE 1 END, 0)::DOUBLE AS confidence FROM nodes),
        inner_nodes AS (SELECT tree_id, confidence FROM scaled WHERE NOT is_leaf), {exclusive_sql('inner_nodes', 'tree_id', 'confidence')}
        SELECT tree_id, n, round_even(v[1], 1)::DOUBLE AS min, round_even(q1, 1)::DOUBLE AS q1, round_even(q2, 1)::DOUBLE AS median, round_even(q3, 1)::DOUBLE AS q3,
               round_even(v[-1], 1)::DOUBLE AS max, round_even(q3 - q1, 1)::DOUBLE AS iqr FROM quart""",
)
def _d3(spark, folder):
    return stats.support_summary(trees.normalise_support(forest(spark, folder)))


_BRANCH = f"""{FOREST_SQL}, bl AS (SELECT *, median(branch_length) OVER (PARTITION BY tree_id) AS med0, count(*) OVER (PARTITION BY tree_id) AS nb
  FROM nodes WHERE is_leaf AND branch_length > 0),
st AS (SELECT tree_id, CASE WHEN any_value(nb) >= 3 THEN any_value(med0) ELSE 0 END AS med, CASE WHEN any_value(nb) >= 3 THEN median(abs(branch_length - med0)) ELSE 0 END AS mad FROM bl GROUP BY tree_id)"""


@query("d5_branch_stats", f"WITH {_BRANCH} SELECT t.tree_id, round(coalesce(med, 0), 9)::DOUBLE AS median, round(coalesce(mad, 0), 9)::DOUBLE AS mad FROM (SELECT DISTINCT tree_id FROM nodes) t LEFT JOIN st USING (tree_id)")
def _d5(spark, folder):
    out = trees.branch_stats(forest(spark, folder))
    return out.select("tree_id", F.round("median", 9).alias("median"), F.round("mad", 9).alias("mad"))


_OUT = f"""{_BRANCH}, o AS (SELECT n.tree_id, n.name, n.priority, branch_length, (branch_length - med) / mad AS mads_above FROM nodes n JOIN st USING (tree_id)
  WHERE is_leaf AND med <> 0 AND mad <> 0 AND branch_length > med + 3.0::DOUBLE * mad)"""


@query("e6_branch_outliers", f"WITH {_OUT} SELECT tree_id, name, branch_length, round(mads_above, 6) AS mads_above FROM o")
def _e6(spark, folder):
    out = trees.branch_outliers(forest(spark, folder), 3.0)
    return out.select("tree_id", "name", "branch_length", F.round("mads_above", 6).alias("mads_above"))


@query(
    "e7_removal_guard",
    f"""WITH {_OUT}, z AS (SELECT tree_id, count(*) FILTER (WHERE is_leaf) AS n_leaves FROM nodes GROUP BY tree_id),
        x AS (SELECT o.*, n_leaves, count(*) FILTER (WHERE priority <> '1-URGENT') OVER (PARTITION BY tree_id) AS n_out FROM o JOIN z USING (tree_id))
        SELECT tree_id, name, CASE WHEN priority = '1-URGENT' THEN 'protected' WHEN n_leaves <= 8 OR n_leaves - n_out < 8 THEN 'kept' ELSE 'removed' END AS action FROM x""",
)
def _e7(spark, folder):
    nodes = forest(spark, folder)
    safe = nodes.filter("is_leaf AND priority = '1-URGENT'").select("tree_id", "name")
    return trees.guarded_outliers(nodes, safe, 3.0, 8).select("tree_id", "name", "action")


@query(
    "b13_visible_labels",
    f"""WITH {FOREST_SQL} SELECT tree_id, node_id, CASE WHEN is_leaf THEN name WHEN priority IN ('2-HIGH', '3-MEDIUM') THEN 'N' || node_id ELSE '' END AS label FROM nodes""",
)
def _b13(spark, folder):
    rank = F.when(F.col("priority") == "2-HIGH", "genus").when(F.col("priority") == "3-MEDIUM", "family").otherwise("species")
    name = F.coalesce("name", F.concat(F.lit("N"), F.col("node_id").cast("string")))
    return forest(spark, folder).select("tree_id", "node_id", tx.visible_label(name, rank, F.col("is_leaf")).alias("label"))


@query(
    "b15_same_species_pairs",
    f"""WITH {FOREST_SQL} SELECT tree_id, parent_id AS node_id FROM nodes WHERE parent_id IS NOT NULL GROUP BY tree_id, parent_id
        HAVING count(*) = 2 AND bool_and(is_leaf) AND min(priority) = max(priority)""",
)
def _b15(spark, folder):
    nodes = forest(spark, folder)
    species = nodes.filter("is_leaf").select("tree_id", "name", F.col("priority").alias("species"))
    return trees.same_species_pairs(nodes, species)


@query(
    "c12_restored_names",
    f"WITH {FOREST_SQL} SELECT tree_id, node_id, CASE WHEN is_leaf THEN coalesce(CASE WHEN node_id % 2 = 0 THEN tree_id || '|' || name END, name) END AS name FROM nodes",
)
def _c12(spark, folder):
    nodes = forest(spark, folder)
    # Trees share leaf names, so each has its own map.
    mapped = nodes.filter("is_leaf AND node_id % 2 = 0").select("tree_id", F.col("name").alias("short_id"))
    names = mapped.withColumn("display_name", F.concat(F.col("tree_id").cast("string"), F.lit("|"), "short_id"))
    return trees.restore_names(nodes, names).select("tree_id", "node_id", "name")


H9_SQL = f"""{VOTES_SQL},
below AS MATERIALIZED (WITH RECURSIVE b(tree_id, anc, via, node_id) AS (SELECT tree_id, parent_id, node_id, node_id FROM nodes WHERE parent_id IS NOT NULL
  UNION ALL SELECT b.tree_id, n.parent_id, b.anc, b.node_id FROM b JOIN nodes n ON n.tree_id = b.tree_id AND n.node_id = b.anc WHERE n.parent_id IS NOT NULL)
  SELECT * FROM b),
kids AS (SELECT tree_id, parent_id AS node_id, count(*) AS n_kids FROM nodes WHERE parent_id IS NOT NULL GROUP BY ALL),
cand AS (SELECT tree_id, node_id AS c, branch_length FROM nodes WHERE parent_id IS NOT NULL),
clade AS (
  SELECT tree_id, c, 'root' AS clade, leaf_id FROM cand JOIN clo USING (tree_id) WHERE clo.node_id = 1
  UNION ALL SELECT k.tree_id, c, 'd' || n.node_id, l.leaf_id FROM cand k JOIN nodes n ON n.tree_id = k.tree_id AND NOT n.is_leaf AND n.node_id <> k.c
    JOIN clo l ON l.tree_id = k.tree_id AND l.node_id = n.node_id
    WHERE NOT EXISTS (SELECT 1 FROM below b WHERE b.tree_id = k.tree_id AND b.anc = n.node_id AND b.node_id = k.c)
  UNION ALL SELECT k.tree_id, c, 'u' || b.via, l.leaf_id FROM cand k JOIN below b ON b.tree_id = k.tree_id AND b.node_id = k.c
    JOIN kids q ON q.tree_id = k.tree_id AND q.node_id = b.anc JOIN clo l ON l.tree_id = k.tree_id AND l.node_id = 1
    WHERE NOT (b.anc = 1 AND n_kids = 2) AND NOT EXISTS (SELECT 1 FROM clo x WHERE x.tree_id = k.tree_id AND x.node_id = b.via AND x.leaf_id = l.leaf_id)),
sz AS (SELECT g.tree_id, c, clade, count(*) AS n, count(v.leaf_id) AS nv FROM clade g LEFT JOIN votes v USING (tree_id, leaf_id) GROUP BY ALL),
lv AS (SELECT tree_id, c, clade, d, min(v) = max(v) AND count(v) = count(*) AS shared FROM (
  SELECT g.tree_id, c, clade, unnest(range(1, 5)) AS d, lineage[unnest(range(1, 5))] AS v FROM clade g JOIN votes USING (tree_id, leaf_id)) GROUP BY ALL),
dp AS (SELECT tree_id, c, clade, coalesce(min(d) FILTER (WHERE NOT coalesce(shared, false)), 5) - 1 AS depth FROM lv GROUP BY ALL)
SELECT k.tree_id, k.c AS node_id, round(coalesce(sum(depth * n) FILTER (WHERE nv > 0 AND nv * 2 >= n) / (sum(n) FILTER (WHERE nv > 0 AND nv * 2 >= n))::DOUBLE, 0), 9)::DOUBLE AS score
FROM cand k JOIN sz ON sz.tree_id = k.tree_id AND sz.c = k.c LEFT JOIN dp ON dp.tree_id = sz.tree_id AND dp.c = sz.c AND dp.clade = sz.clade GROUP BY k.tree_id, k.c"""


@query("h9_rooting_scores", f"WITH {H9_SQL}")
def _h9(spark, folder):
    nodes = forest(spark, folder)
    scores = trees.rooting_scores(nodes, leaf_lineages(nodes))
    return scores.select("tree_id", "node_id", F.round("score", 9).alias("score"))
