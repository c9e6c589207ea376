import random

import pytest

from sparkcurate.operators import lineage, trees
from sparkcurate.session import cut_lineage
from sparkcurate.sources.newick import good_nodes, parse_newick, rejects

NODES = "tree_id string, node_id int, parent_id int, preorder int, is_leaf boolean, name string, branch_length double, confidence double"


def parsed(spark, **newicks):
    df = spark.createDataFrame(list(newicks.items()), "tree_id string, newick string")
    return parse_newick(df)


def test_newick_nodes_and_rejects(spark):
    out = parsed(spark, a="((s1:.1,s2:.2)85 Flavivirus:.05,s3:.3)root;", b="((x,y);", c="", d="('a b''c':1e-2,B[note]:2)0.97;", e="(A,B):x;", f="(A,B))C;")
    rows = {(r.tree_id, r.node_id): r for r in good_nodes(out).collect()}
    inner = rows[("a", 1)]
    assert (inner.name, inner.confidence, inner.branch_length, inner.is_leaf, inner.parent_id) == ("Flavivirus", 85.0, 0.05, False, 0)
    assert [rows[("a", i)].name for i in (0, 2, 3, 4)] == ["root", "s1", "s2", "s3"]
    assert (rows[("d", 1)].name, rows[("d", 2)].branch_length, rows[("d", 0)].confidence) == ("a b'c", 2.0, 0.97)
    assert {r.tree_id for r in rejects(out).collect()} == {"b", "c", "e", "f"}


def test_branch_statistics(spark):
    nodes = good_nodes(parsed(spark, even="((p:2,q:2):1,r:2,s:2);", odd="(k:3,(m:5,n:70):1,(o:4,p:6):2);", pair="(u:7,v:8);"))
    got = {r.tree_id: (round(r.median, 6), round(r.mad, 6)) for r in trees.branch_stats(nodes).collect()}
    assert got == {"even": (2.0, 0.0), "odd": (5.0, 1.0), "pair": (0.0, 0.0)}
    for factor in (2.0, 10.0):
        assert [(r.tree_id, r.name) for r in trees.branch_outliers(nodes, factor).collect()] == [("odd", "n")]


def test_removal_guard(spark):
    leaves = ",".join(f"w{i}:{20 + i % 7}" for i in range(60))
    nodes = good_nodes(parsed(spark, wide=f"({leaves},far:900,kept:800);", few="(k:3,(m:5,n:70):1,(o:4,p:6):2);"))
    safe = spark.createDataFrame([("wide", "kept")], "tree_id string, name string")
    got = {(r.tree_id, r.name): r.action for r in trees.guarded_outliers(nodes, safe).collect()}
    assert got == {("wide", "far"): "removed", ("wide", "kept"): "protected", ("few", "n"): "kept"}


@pytest.mark.parametrize("values,want", [([0.5, 0.97], [50, 97]), ([55.4, 97.6], [55, 98]), ([0.2, 1.0], [20, 100])])
def test_support_scale(spark, values, want):
    rows = [("t", i, None, i, False, None, None, v) for i, v in enumerate(values)]
    out = trees.normalise_support(spark.createDataFrame(rows, NODES)).orderBy("node_id").collect()
    assert [r.confidence for r in out] == want


def test_labels_and_crowns(spark):
    nodes = good_nodes(parsed(spark, t="(((a,b),c),(d,e),f);"))
    base = ["V", "F"]
    lin = {"a": [*base, "G1", "s1"], "b": [*base, "G1", "s2"], "c": [*base, "G1", "s3"], "d": [*base, "G2"], "e": None, "f": ["V"]}
    leaves = spark.createDataFrame([("t", k, v) for k, v in lin.items() if v], "tree_id string, name string, lineage array<string>")
    ranks = spark.createDataFrame([("G1", "genus")], "name string, rank string")
    labelled = trees.label_nodes(nodes, leaves, ranks)
    got = {r.n_leaves: (r.label, r.rank, r.n_voters) for r in labelled.filter("label in ('G1', 'V')").collect()}
    assert got[3] == ("G1", "genus", 3) and got[6] == ("V", "", 5)
    crowns = {(r.label, r.n_leaves) for r in trees.crown_labels(labelled).filter("label is not null").collect()}
    assert crowns == {("G1", 3), ("G2", 2), ("V", 6)}


def test_half_of_the_leaves_must_vote(spark):
    nodes = good_nodes(parsed(spark, t="((a,b,c),d);"))
    leaves = spark.createDataFrame([("t", "a", ["V", "G"])], "tree_id string, name string, lineage array<string>")
    assert trees.label_nodes(nodes, leaves).filter("label is not null").isEmpty()


def test_same_species_pairs(spark):
    nodes = good_nodes(parsed(spark, t="((a,b),(c,d),(e,(f,g)));"))
    species = [("t", n, s) for n, s in zip("abcdefg", ["x", "x", "x", "y", "x", "", ""])]
    out = trees.same_species_pairs(nodes, spark.createDataFrame(species, "tree_id string, name string, species string"))
    assert [r.node_id for r in out.collect()] == [1]


def caterpillar(n):
    text = "(x0,x1)"
    for i in range(2, n):
        text = f"({text},x{i})"
    return text + ";"


def test_deep_trees_take_few_rounds(spark):
    nodes = good_nodes(parsed(spark, deep=caterpillar(200)))
    seeded = nodes.selectExpr("tree_id", "node_id", "parent_id", "cast(is_leaf as bigint) as n")
    got = {r.node_id: r.n for r in trees.subtree_aggregate(seeded, {"n": "sum"}).collect()}
    assert got[0] == 200 and sorted(v for v in got.values() if v > 1) == list(range(2, 201))
    assert trees.leaf_closure(nodes).count() == sum(range(2, 201)) + 200


def brute_scores(rows, votes):
    """Re-root at every branch with sets of leaves."""
    kids, parent, leaf = {}, {}, {}
    for r in rows:
        parent[r.node_id] = r.parent_id
        kids.setdefault(r.node_id, [])
        if r.parent_id is not None:
            kids.setdefault(r.parent_id, []).append(r.node_id)
        if r.is_leaf:
            leaf[r.node_id] = r.name

    def graph_side(node, frm):
        """Leaves reached from node without going back."""
        near = [x for x in [*kids[node], parent[node]] if x is not None and x != frm]
        out = {leaf[node]} if node in leaf else set()
        return out.union(*[graph_side(x, node) for x in near]) if near else out

    def clades(node, frm):
        near = [x for x in [*kids[node], parent[node]] if x is not None and x != frm]
        mine = [graph_side(node, frm)] if len(near) >= 2 else []
        return mine + [c for x in near for c in clades(x, node)]

    def weight(names):
        have = [votes[n] for n in names if n in votes]
        if not have or len(have) * 2 < len(names):
            return 0, 0
        depth = 0
        while all(len(h) > depth for h in have) and len({h[depth] for h in have}) == 1:
            depth += 1
        return depth * len(names), len(names)

    out = {}
    for c, p in parent.items():
        if p is None:
            continue
        parts = [set(leaf.values())]
        below = [] if c in leaf else [x for k in kids[c] for x in clades(k, c)]
        parts += below + clades(p, c)
        w = [weight(x) for x in parts]
        out[c] = sum(a for a, _ in w) / sum(b for _, b in w) if sum(b for _, b in w) else 0.0
    return out


@pytest.mark.parametrize("seed", range(4))
def test_rooting_scores_match_rerooting(spark, seed):
    rng = random.Random(seed)

    def grow(names):
        if len(names) == 1:
            return names[0]
        n = min(len(names), rng.choice([2, 2, 3]))
        cuts = sorted(rng.sample(range(1, len(names)), n - 1))
        return "(" + ",".join(grow(names[a:b]) for a, b in zip([0, *cuts], [*cuts, len(names)])) + ")"

    names = [f"n{i}" for i in range(12)]
    votes = {n: ["V", *rng.choice([["F", "G"], ["F", "H"], ["E"], ["F", "G", "s"]])] for n in names if rng.random() < 0.8}
    nodes = good_nodes(parsed(spark, t=grow(names) + ";"))
    leaves = spark.createDataFrame([("t", k, v) for k, v in votes.items()], "tree_id string, name string, lineage array<string>")
    got = {r.node_id: r.score for r in trees.rooting_scores(nodes, leaves).collect()}
    want = brute_scores(nodes.collect(), votes)
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-9 for k in want)
    best = trees.best_roots(trees.rooting_scores(nodes, leaves)).collect()
    assert len(best) == 1 and abs(best[0].score - max(want.values())) < 1e-9


def test_common_lineages(spark):
    rows = [("far", ["all", "left", "low", "last"]), ("far", ["all", "left", "low"]), ("far", ["all", "left", "up", "top"]),
            ("near", list("mnop")), ("near", list("mnopq")), ("lone", list("xy")), ("none", ["x"]), ("none", ["y", "x"])]
    out = lineage.common_lineage(spark.createDataFrame(rows, "g string, lineage array<string>"), "g")
    assert {r.g: r.common for r in out.collect()} == {"far": ["all", "left"], "near": list("mnop"), "lone": list("xy"), "none": []}


def test_lineages_and_cycles(spark):
    rows = [(1, 1, "root", "no rank"), (2, 1, "Fam", "family"), (3, 2, "Gen", "genus"), (4, 3, "unclassified Fam virus", "species"), (5, 3, "Good virus", "species"), (8, 9, "x", "genus"), (9, 8, "y", "genus"), (10, 99, "orphan", "species")]
    taxa = spark.createDataFrame(rows, "taxid bigint, parent_taxid bigint, name string, rank string")
    lin = lineage.resolve_lineages(taxa)
    got = {r.taxid: r.lineage and [e.name for e in r.lineage] for r in lin.collect()}
    assert got[5] == ["root", "Fam", "Gen", "Good virus"] and got[1] == ["root"] and got[10] == ["orphan"]
    assert got[8] is None and got[9] is None
    roots = spark.createDataFrame([(2, "Fam")], "root bigint, root_name string")
    assert [r.taxid for r in lineage.descendants_at_rank(lin, roots).collect()] == [5]


def test_restored_names_keep_unmapped_ids(spark):
    nodes = good_nodes(parsed(spark, t="((A_1,A_10)inner,B);"))
    names = spark.createDataFrame([("A_1", "acc", "one")], "short_id string, accession string, display_name string")
    got = sorted(r.name for r in trees.restore_names(nodes, names).filter("name is not null").collect())
    assert got == ["A_10", "B", "one"]


def test_short_ids_belong_to_their_tree(spark):
    nodes = good_nodes(parsed(spark, s="(RTRV_1,RTRV_2);", t="(RTRV_1,RTRV_3);"))
    names = spark.createDataFrame([("s", "RTRV_1", "first"), ("t", "RTRV_1", "second")], "tree_id string, short_id string, display_name string")
    got = sorted((r.tree_id, r.name) for r in trees.restore_names(nodes, names).filter("name is not null").collect())
    assert got == [("s", "RTRV_2"), ("s", "first"), ("t", "RTRV_3"), ("t", "second")]


def test_deep_lineages_are_whole(spark):
    taxa = spark.range(1, 2001).selectExpr("id AS taxid", "greatest(id - 1, 1) AS parent_taxid", "string(id) AS name", "'no rank' AS rank")
    got = lineage.resolve_lineages(taxa).selectExpr("max(size(lineage)) AS deepest", "count(lineage) AS n").first()
    assert (got.deepest, got.n) == (2000, 2000)


def test_a_cyclic_tree_is_refused(spark):
    rows = [("t", 0, 1, 0, False, None, None, None), ("t", 1, 0, 1, False, None, None, None)]
    nodes = spark.createDataFrame(rows, NODES).selectExpr("*", "1L AS n")
    with pytest.raises(ValueError, match="cycle"):
        trees.subtree_aggregate(nodes, {"n": "sum"})


def test_rooting_scores_shuffle_nodes_few_times(spark, monkeypatch):
    """Steps of a round share their shuffles; wide rows are not dealt anew for each statistic."""
    dealt = []

    def counted(df):
        dealt.append(df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning"))
        return cut_lineage(df)

    monkeypatch.setattr(trees, "cut_lineage", counted)
    rows = [(1, n, n // 2 or None, n, n > 7, f"L{n}" if n > 7 else None, 1.0, None) for n in range(1, 16)]
    nodes = spark.createDataFrame(
        rows, "tree_id int, node_id int, parent_id int, preorder int, is_leaf boolean, name string, branch_length double, confidence double")
    lineages = spark.createDataFrame([(1, f"L{n}", ["r", f"A{n % 3}"]) for n in range(8, 16)], "tree_id int, name string, lineage array<string>")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert trees.rooting_scores(nodes, lineages).count() == 14
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(dealt) <= 26, dealt  # 29 when each statistic had its own
