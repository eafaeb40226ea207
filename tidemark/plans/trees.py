"""Tree ensembles as column expressions.

An ensemble is plain data: a list of trees, each a nest of ``{"input", "most", "low", "high"}`` (rows whose
input is at most ``most`` go to ``low``) down to ``{"score"}``.  It can come from a file or from a
trained forest.  The compiler turns it into one native expression, so scoring needs no Python, no model
server and no vectors; the same data gives the expression as SQL text for other engines.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def load_ensemble(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def inputs_of(ensemble: dict) -> list[str]:
    """The inputs that occur in any tree, sorted."""
    found, left = set(), list(ensemble["trees"])
    while left:
        node = left.pop()
        if "score" not in node:
            found.add(node["input"])
            left += [node["low"], node["high"]]
    return sorted(found)


def _tree(node: dict, value: Callable[[str], Column]) -> Column:
    if "score" in node:
        return F.lit(float(node["score"]))
    return F.when(value(node["input"]) <= float(node["most"]), _tree(node["low"], value)).otherwise(_tree(node["high"], value))


def ensemble_score(ensemble: dict, value: Callable[[str], Column] | None = None) -> Column:
    """The mean score of the trees.  A missing input counts as 0; ``value`` gives the column of an input."""
    value = value or (lambda name: F.coalesce(F.col(name).cast("double"), F.lit(0.0)))
    trees = [_tree(tree, value) for tree in ensemble["trees"]]
    return reduce(add, trees) / F.lit(float(len(trees)))


def _tree_sql(node: dict) -> str:
    if "score" in node:
        return f"{float(node['score'])!r}::DOUBLE"
    test = f"COALESCE(CAST({node['input']} AS DOUBLE), 0) <= {float(node['most'])!r}::DOUBLE"
    return f"CASE WHEN {test} THEN {_tree_sql(node['low'])} ELSE {_tree_sql(node['high'])} END"


def ensemble_sql(ensemble: dict) -> str:
    """The same score as SQL text."""
    trees = " + ".join(f"({_tree_sql(tree)})" for tree in ensemble["trees"])
    return f"({trees}) / {float(len(ensemble['trees']))!r}::DOUBLE"


def score_by_trees(df: DataFrame, ensemble: dict, alias: str = "score") -> DataFrame:
    """The frame with the ensemble's score; each input is cast once, however many trees ask for it."""
    names = inputs_of(ensemble)
    ready = df.withColumns({f"__x_{c}": F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in names})
    return ready.withColumn(alias, ensemble_score(ensemble, lambda c: F.col(f"__x_{c}"))).drop(*[f"__x_{c}" for c in names])


def forest_ensemble(spark: SparkSession, folder: str, features: Sequence[str]) -> dict:
    """A saved binary forest as an ensemble; ``features`` are the inputs of its vector, in order.

    Reads the node table that a saved forest consists of, which fits on the driver as the forest itself
    does.  A leaf's score is the share of positive rows in it; all trees count alike.
    """
    trees: dict[int, dict[int, object]] = {}
    for row in spark.read.parquet(f"{folder}/data").collect():
        trees.setdefault(row["treeID"], {})[row["nodeData"]["id"]] = row["nodeData"]

    def nested(nodes: dict, at: int) -> dict:
        node = nodes[at]
        if node["leftChild"] < 0:
            negative, positive = node["impurityStats"]
            return {"score": positive / (negative + positive)}
        split = node["split"]
        if split["numCategories"] >= 0:
            raise ValueError("splits on categories are not supported")
        return {
            "input": features[split["featureIndex"]], "most": split["leftCategoriesOrThreshold"][0],
            "low": nested(nodes, node["leftChild"]), "high": nested(nodes, node["rightChild"]),
        }

    return {"trees": [nested(nodes, 0) for _, nodes in sorted(trees.items())]}
