"""Matchers: a boosted forest with its threshold, trained, scored, saved and loaded."""

from __future__ import annotations

import math
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.operators.boosting import Forest, Node, boost, with_codes
from kindred.operators.evaluate import DEFAULT_THRESHOLD, best_threshold, threshold_sweep
from kindred.operators.labels import with_split
from kindred.schemas import FEATURES

GROUP = 512  # codes of features that are looked up together
_PREFIX = "_bin_"

NODES = (
    "tree int, node int, feature int, bin int, missing_left boolean, gain double, left int, right int, "
    "n long, value double"
)
MANIFEST = "version long, folder string, threshold double, base double, features array<string>, edges array<array<double>>"


@dataclass(frozen=True)
class Matcher:
    """A fitted forest, which names the features it reads in order, and a threshold."""

    forest: Forest
    threshold: float = DEFAULT_THRESHOLD

    @property
    def features(self) -> list[str]:
        return self.forest.features


def fit_model(labelled: DataFrame, features: list[str] = FEATURES, **options) -> Forest:
    """Boosted trees on the sixteen features and ``label``; options as of ``boost``."""
    return boost(labelled, list(features), **options)


# --- scores ---------------------------------------------------------------------


def _leaves(nodes: list[Node], at: int = 0) -> list[int]:
    """The leaves under a node, from left to right."""
    node = nodes[at]
    return [at] if node.feature < 0 else _leaves(nodes, node.left) + _leaves(nodes, node.right)


def _masks(forest: Forest) -> tuple[list[list[int]], list[np.ndarray], list[list[float]]]:
    """Groups of features; for each of their joint codes and every tree the leaves that these
    features leave open, a bit each; and the values of the leaves of every tree.

    A row's leaf is the first that all groups leave open: a split that sends the row to the
    right shuts the leaves on its left.
    """
    sizes = [len(cuts) + 2 for cuts in forest.edges]
    trees = len(forest.trees)
    open_by = [np.full((size, trees), -1, np.int64) for size in sizes]
    values = []
    for t, nodes in enumerate(forest.trees):
        place = {leaf: k for k, leaf in enumerate(_leaves(nodes))}
        if len(place) > 63:
            raise ValueError("a tree may have 63 leaves at most to be scored")
        values.append([nodes[leaf].value for leaf in place])
        for node in nodes:
            if node.feature >= 0:
                shut = sum(1 << place[leaf] for leaf in _leaves(nodes, node.left))
                codes = np.arange(sizes[node.feature])
                right = np.where(codes == sizes[node.feature] - 1, not node.missing_left, codes > node.bin)
                open_by[node.feature][right, t] &= ~shut
    used = [f for f in range(len(sizes)) if (open_by[f] != -1).any()]
    groups: list[list[int]] = []
    for f in sorted(used, key=lambda f: sizes[f]):
        if groups and np.prod([sizes[k] for k in groups[-1]]) * sizes[f] <= GROUP:
            groups[-1].append(f)
        else:
            groups.append([f])
    tables = []
    for group in groups:
        table = np.full((1, trees), -1, np.int64)
        for f in group:
            table = (table[:, None, :] & open_by[f][None, :, :]).reshape(-1, trees)
        tables.append(table)
    return groups, tables, values


def score_pairs(matcher: Matcher | Forest, features: DataFrame) -> DataFrame:
    """``features`` with the ``probability`` of a match, by SQL functions, where the rows are.

    The tables of the forest are one row, which the plan reads once as scalar subqueries.
    """
    forest = matcher.forest if isinstance(matcher, Matcher) else matcher
    if not forest.trees:
        constant = F.lit(1 / (1 + math.exp(-forest.base)))
        return features.withColumn("probability", constant)
    groups, tables, values = _masks(forest)
    columns = {f"g{i}": pa.array([t.tolist()], pa.list_(pa.list_(pa.int64()))) for i, t in enumerate(tables)}
    columns["leaves"] = pa.array([values], pa.list_(pa.list_(pa.float64())))
    held = features.sparkSession.createDataFrame(pa.table(columns))
    sizes = [len(cuts) + 2 for cuts in forest.edges]

    def looked_up(i: int, group: list[int]) -> Column:
        code = F.lit(0)
        for f in group:
            code = code * sizes[f] + F.col(f"{_PREFIX}{f}")
        return F.get(held.select(f"g{i}").scalar(), code).alias(f"g{i}")

    # A list of one struct: what is looked up once per row is not worked out again per tree.
    once = F.struct(*[looked_up(i, g) for i, g in enumerate(groups)], held.select("leaves").scalar().alias("leaves"))
    coded = with_codes(features, forest.features, forest.edges, _PREFIX)
    rows = coded.select(*features.columns, F.array(once).alias(f"{_PREFIX}tables"))

    def margin(row: Column) -> Column:
        def value(mask: Column, tree: Column) -> Column:
            for i in range(1, len(groups)):
                mask = mask.bitwiseAND(F.get(row[f"g{i}"], tree))
            return F.get(F.get(row["leaves"], tree), F.bit_count(mask.bitwiseAND(-mask) - 1))

        return F.aggregate(F.transform(row["g0"], value), F.lit(forest.base), lambda a, x: a + x)

    total = F.get(F.transform(f"{_PREFIX}tables", margin), F.lit(0))
    return rows.select(*features.columns, (F.lit(1.0) / (F.lit(1.0) + F.exp(-total))).alias("probability"))


def train(labelled: DataFrame, **options) -> tuple[Matcher, DataFrame]:
    """Fit on the train entities, choose the threshold on the validation entities.

    Returns the matcher and the sweep table. Rows that already carry their ``split`` may
    be stored by it, so that each side reads only its own.
    """
    split = labelled if "split" in labelled.columns else with_split(labelled)
    forest = fit_model(split.filter("split = 'train'"), **options)
    sweep = threshold_sweep(score_pairs(forest, split.filter("split = 'validation'")))
    chosen = best_threshold(sweep).first().best_threshold
    return Matcher(forest, chosen), sweep


# --- artefacts --------------------------------------------------------------------


def node_table(spark: SparkSession, forest: Forest) -> DataFrame:
    """One row per node of every tree."""
    rows = [
        (t, i, n.feature, n.bin, n.missing_left, n.gain, n.left, n.right, n.n, n.value)
        for t, nodes in enumerate(forest.trees)
        for i, n in enumerate(nodes)
    ]
    return spark.createDataFrame(rows, NODES)


def _versions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(MANIFEST).parquet(f"{path}/manifest")


def save_matcher(matcher: Matcher, path: str) -> None:
    """Write the nodes to a folder of their own, then append the row that makes them the
    current version. A save that is broken off before that row leaves the last version as it was.
    """
    spark, forest = SparkSession.active(), matcher.forest
    folder = f"nodes-{uuid.uuid4().hex}"
    node_table(spark, forest).coalesce(1).write.parquet(f"{path}/{folder}")
    spark.createDataFrame([], MANIFEST).write.mode("append").parquet(f"{path}/manifest")
    last = _versions(spark, path).agg(F.max("version").alias("v")).first().v or 0
    row = (last + 1, folder, matcher.threshold, forest.base, forest.features, forest.edges)
    spark.createDataFrame([row], MANIFEST).coalesce(1).write.mode("append").parquet(f"{path}/manifest")


def load_matcher(spark: SparkSession, path: str) -> Matcher:
    """The matcher of the last version that the manifest lists."""
    row = _versions(spark, path).orderBy(F.desc("version")).first()
    if row is None:
        raise FileNotFoundError(f"no saved matcher in {path}")
    trees: list[list[Node]] = []
    for r in spark.read.schema(NODES).parquet(f"{path}/{row.folder}").orderBy("tree", "node").collect():
        if r.node == 0:
            trees.append([])
        trees[-1].append(Node(r.n, r.value, r.feature, r.bin, r.missing_left, r.gain, r.left, r.right))
    forest = Forest(list(row.features), [list(e) for e in row.edges], row.base, trees)
    return Matcher(forest, row.threshold)
