"""Tree corpus ingest: Newick strings to node tables. The one place that needs Python workers."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

NODE_SCHEMA = (
    "tree_id {id}, node_id INT, parent_id INT, preorder INT, is_leaf BOOLEAN, name STRING, "
    "branch_length DOUBLE, confidence DOUBLE, reason STRING"
)
_TOKEN = re.compile(r"\[[^\]]*\]|'(?:[^']|'')*'|[(),;:]|[^\s(),;:\[\]']+")


def _node_rows(text: str) -> list[list]:
    """[parent, name, length, confidence, has_children] per node in preorder."""
    nodes: list[list] = [[None, None, None, None, False]]
    here, after_colon, closed = 0, False, False
    for token in _TOKEN.findall(text.strip()):
        if closed:
            raise ValueError("text after the end of the tree")
        if token.startswith("["):
            continue
        if token == "(":
            nodes[here][4] = True
            nodes.append([here, None, None, None, False])
            here = len(nodes) - 1
        elif token in ",)":
            parent = nodes[here][0]
            if parent is None:
                raise ValueError("unbalanced parentheses")
            if token == ",":
                nodes.append([parent, None, None, None, False])
                here = len(nodes) - 1
            else:
                here = parent
        elif token == ":":
            after_colon = True
            continue
        elif token == ";":
            closed = True
        elif after_colon:
            nodes[here][2] = float(token)
        else:
            label = token[1:-1].replace("''", "'") if token.startswith("'") else token
            nodes[here][1] = label if nodes[here][1] is None else f"{nodes[here][1]} {label}"
        after_colon = False
    if here != 0 or (len(nodes) == 1 and nodes[0][1] is None):
        raise ValueError("no complete tree")
    for node in nodes:
        # a number on an inner node is its support, a following word its name
        if node[4] and node[1]:
            head, _, rest = node[1].partition(" ")
            try:
                node[3], node[1] = float(head), rest or None
            except ValueError:
                pass
    return nodes


def parse_newick(trees: DataFrame, tree_id: str = "tree_id", newick: str = "newick") -> DataFrame:
    """Node rows of every tree; a tree that cannot be read gives one row with its reason."""
    schema = NODE_SCHEMA.format(id=trees.schema[tree_id].dataType.simpleString())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for key, text in zip(batch[tree_id], batch[newick]):
                try:
                    if not isinstance(text, str) or not text.strip():
                        raise ValueError("empty text")
                    for i, (parent, name, length, support, inner) in enumerate(_node_rows(text)):
                        rows.append((key, i, parent, i, not inner, name, length, support, None))
                except ValueError as error:
                    rows.append((key, None, None, None, None, None, None, None, str(error)))
            yield pd.DataFrame(rows, columns=[
                "tree_id", "node_id", "parent_id", "preorder", "is_leaf", "name", "branch_length", "confidence", "reason",
            ]).astype({"node_id": "Int32", "parent_id": "Int32", "preorder": "Int32", "is_leaf": "boolean"})

    return trees.select(tree_id, newick).mapInPandas(run, schema)


def good_nodes(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNull()).drop("reason")


def rejects(parsed: DataFrame) -> DataFrame:
    return parsed.filter(F.col("reason").isNotNull()).select("tree_id", "reason")
