"""Fitted trees as native expressions.

A tree, forest or boosted model becomes one ``Column`` (or the same as SQL
text, for Spark or for another engine) over the vector slots, or over the
raw columns that went into the feature pipeline: text categories by name,
thresholds in full precision. Scoring then needs no model object, no vector
and no Python; it stays in generated code, and the SQL can run where the
data is.

Only the node table is read (model-sized); how it combines follows the
fitted model: a tree gives its leaf's value, a forest the mean of its trees
(regression) or the sum of its leaves' class shares (classification), a
boosted model the weighted sum of its trees, of which classification takes
the sign.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorIndexerModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sylvan import names
from sylvan.operators import features as FT
from sylvan.operators.explain import tree_nodes
from sylvan.operators.impute import FillMissingModel

#: Nodes beyond which one expression is no longer sensible; use the model itself.
MAX_NODES = 20_000


@dataclass(frozen=True)
class Split:
    """Left where the slot's value is at most ``threshold``, or one of ``left`` (of ``categories`` codes)."""

    slot: int
    threshold: float | None
    left: frozenset[int] = frozenset()
    categories: int = -1

    def goes_left(self, code: float) -> bool:
        """As the fitted split decides, codes it has never seen included: they follow the larger side."""
        if self.threshold is not None:
            return code <= self.threshold
        if len(self.left) <= self.categories // 2:
            return code in self.left
        return not 0 <= code < self.categories or code in self.left


@dataclass(frozen=True)
class Node:
    id: int
    n: int
    prediction: float
    stats: tuple[float, ...]
    split: Split | None = None
    children: tuple[Node, Node] | None = None


@dataclass(frozen=True)
class Ensemble:
    """The trees of a fitted model and how their leaves combine: ``tree``, ``mean``, ``votes`` or ``sum``."""

    trees: list[Node]
    weights: list[float]
    combine: str
    classes: int  # 0: regression
    slots: int


def ensemble(spark: SparkSession, model) -> Ensemble:
    """The node table of a fitted dt / rf / gbt model as linked nodes."""
    rows = tree_nodes(spark, model).collect()  # model-sized
    if len(rows) > MAX_NODES:
        raise ValueError(f"{len(rows)} nodes are too many for one expression; score with the model")
    tables: dict[int, dict] = {}
    for r in rows:
        tables.setdefault(r["treeID"], {})[r["id"]] = r

    def link(table: dict, nid: int) -> Node:
        r = table[nid]
        stats = tuple(float(x) for x in r["impurityStats"])
        if r["leftChild"] < 0:
            return Node(nid, int(r["rawCount"]), float(r["prediction"]), stats)
        values, k = r["categories"], int(r["numCategories"])
        split = Split(int(r["featureIndex"]), float(values[0])) if k < 0 else Split(int(r["featureIndex"]), None, frozenset(int(c) for c in values), k)
        return Node(nid, int(r["rawCount"]), float(r["prediction"]), stats, split, (link(table, r["leftChild"]), link(table, r["rightChild"])))

    trees = [link(t, min(t)) for _, t in sorted(tables.items())]
    kind = type(model).__name__
    classes = int(getattr(model, "numClasses", 0))
    weights = [float(w) for w in getattr(model, "treeWeights", [1.0])]
    combine = "sum" if kind.startswith("GBT") else "tree" if not kind.startswith("RandomForest") else "votes" if classes else "mean"
    return Ensemble(trees, weights, combine, classes, int(model.numFeatures))


# ---------------------------------------------------------------- what a slot stands for


@dataclass(frozen=True)
class Slot:
    """A raw column behind a vector slot.

    Without ``codes`` the slot is the column's number. With ``codes`` it is
    the code of the column's value (text, or a number kept as categories);
    any other value, NULL included, has the code ``other``.
    """

    column: str
    text: bool = False
    codes: dict = field(default_factory=dict)
    other: float | None = None


def raw_slots(auto: FT.AutoPipeline, fitted: PipelineModel) -> list[Slot]:
    """The raw column behind each slot of an auto pipeline (text indexed, not one-hot; numbers not scaled)."""
    indexer = auto.text_indexer(fitted)
    labels = dict(zip(auto.text_cols, indexer.labelsArray)) if indexer is not None else {}
    expected = [names.PREFIX + c for c in auto.text_cols] + list(auto.numeric_cols)
    if auto.assembled != expected or any(isinstance(s, FillMissingModel) for s in fitted.stages):
        raise ValueError("only pipelines without one-hot encoding, scaling and imputation map slots to raw columns")
    vector = next((s for s in fitted.stages if isinstance(s, VectorIndexerModel)), None)
    maps = {int(s): {float(v): int(i) for v, i in m.items()} for s, m in vector.categoryMaps.items()} if vector is not None else {}
    out = []
    for i, c in enumerate([*auto.text_cols, *auto.numeric_cols]):
        # an unknown value gets the index after the last one, in either indexer
        recode = lambda v, i=i: float(maps[i].get(v, len(maps[i]))) if i in maps else v
        if c in labels and c in auto.text_cols:
            out.append(Slot(c, True, {v: recode(float(k)) for k, v in enumerate(labels[c])}, recode(float(len(labels[c])))))
        elif i in maps:
            out.append(Slot(c, False, {v: float(k) for v, k in maps[i].items()}, float(len(maps[i]))))
        else:
            out.append(Slot(c))
    return out


class _Columns:
    """Expressions as Spark columns."""

    def number(self, x: float) -> Column:
        return F.lit(float(x))

    def at_most(self, value: Column, t: float) -> Column:
        return value <= F.lit(t)

    def value(self, slot: Slot) -> Column:
        return F.coalesce(F.col(_quoted(slot.column)).cast("double"), F.lit(float("nan")))

    def among(self, slot: Slot, some: list, inside: bool) -> Column:
        c = F.col(_quoted(slot.column)) if slot.text else self.value(slot)
        hit = F.coalesce(c.isin(some), F.lit(False)) if some else F.lit(False)
        return hit if inside else ~hit

    def choose(self, condition: Column, left: Column, right: Column) -> Column:
        return F.when(condition, left).otherwise(right)


class _Text(_Columns):
    """Expressions as SQL text; ``dialect`` is that of its string literals (Spark reads backslashes)."""

    def __init__(self, dialect: str):
        if dialect not in ("spark", "ansi"):
            raise ValueError("dialect must be 'spark' or 'ansi'")
        self.spark = dialect == "spark"

    def _string(self, s: str) -> str:
        return "'" + (s.replace("\\", "\\\\").replace("'", "\\'") if self.spark else s.replace("'", "''")) + "'"

    def _name(self, c: str) -> str:
        return _quoted(c) if self.spark else '"' + c.replace('"', '""') + '"'

    def number(self, x: float) -> str:
        return f"CAST('{float(x)!r}' AS DOUBLE)"

    def at_most(self, value: str, t: float) -> str:
        return f"{value} <= {self.number(t)}"

    def value(self, slot: Slot) -> str:
        return f"coalesce(CAST({self._name(slot.column)} AS DOUBLE), {self.number(float('nan'))})"

    def among(self, slot: Slot, some: list, inside: bool) -> str:
        c = self._name(slot.column) if slot.text else self.value(slot)
        shown = ", ".join(self._string(v) if slot.text else self.number(v) for v in some)
        hit = f"coalesce({c} IN ({shown}), FALSE)" if some else "FALSE"
        return hit if inside else f"NOT {hit}"

    def choose(self, condition: str, left: str, right: str) -> str:
        return f"CASE WHEN {condition} THEN {left} ELSE {right} END"


def _quoted(c: str) -> str:
    return "`" + c.replace("`", "``") + "`"


def _tree(node: Node, test: Callable, leaf: Callable, out):
    if node.children is None:
        return leaf(node)
    left, right = (_tree(c, test, leaf, out) for c in node.children)
    return out.choose(test(node.split), left, right)


def _raw_test(slots: list[Slot], out) -> Callable:
    def test(split: Split):
        slot = slots[split.slot]
        if slot.other is None:
            if split.threshold is None:
                raise ValueError(f"categories on the plain number {slot.column!r}")
            return out.at_most(out.value(slot), split.threshold)
        # the side that unknown values take is the one written as "not among the other's"
        inside = not split.goes_left(slot.other)
        return out.among(slot, [v for v, code in slot.codes.items() if split.goes_left(code) == inside], inside)

    return test


def _vector_test(vector: Column) -> Callable:
    def test(split: Split) -> Column:
        if split.threshold is not None:
            return vector[split.slot] <= F.lit(split.threshold)
        small = len(split.left) <= split.categories // 2
        some = sorted(split.left if small else set(range(split.categories)) - split.left)
        hit = vector[split.slot].isin([float(c) for c in some]) if some else F.lit(False)
        return hit if small else ~hit

    return test


def _total(parts: list, weights: list[float] | None, out):
    terms = parts if weights is None else [p * out.number(w) if isinstance(p, Column) else f"{p} * {out.number(w)}" for p, w in zip(parts, weights)]
    if isinstance(terms[0], Column):
        total = terms[0]
        for t in terms[1:]:
            total = total + t
        return total
    return "(" + " + ".join(terms) + ")"


def _class_scores(e: Ensemble, test: Callable, out) -> list:
    """Per class: what the model compares (leaf counts, or votes summed over the trees)."""
    share = lambda node, c: node.stats[c] / sum(node.stats) if sum(node.stats) else 0.0
    of = (lambda node, c: node.stats[c]) if e.combine == "tree" else share
    return [_total([_tree(t, test, lambda n, c=c: out.number(of(n, c)), out) for t in e.trees], None, out) for c in range(e.classes)]


def _prediction(e: Ensemble, test: Callable, out):
    value = [_tree(t, test, lambda n: out.number(n.prediction), out) for t in e.trees]
    if e.combine == "tree":
        return value[0]
    if e.combine == "mean":
        total = _total(value, None, out)
        return total / F.lit(float(len(e.trees))) if isinstance(total, Column) else f"{total} / {out.number(len(e.trees))}"
    if e.combine == "sum":
        total = _total(value, e.weights, out)
        if not e.classes:
            return total
        positive = total > 0 if isinstance(total, Column) else f"{total} > 0"
        return out.choose(positive, out.number(1.0), out.number(0.0))
    scores = _class_scores(e, test, out)
    best = out.number(float(e.classes - 1))  # the first of the greatest votes
    for c in range(e.classes - 2, -1, -1):
        rest = scores[c + 1 :]
        if isinstance(best, Column):
            wins = F.lit(True)
            for r in rest:
                wins = wins & (scores[c] >= r)
        else:
            wins = " AND ".join(f"{scores[c]} >= {r}" for r in rest)
        best = out.choose(wins, out.number(float(c)), best)
    return best


def predicted(e: Ensemble, slots: list[Slot]) -> Column:
    """The model's prediction as a column over raw columns."""
    out = _Columns()
    return _prediction(e, _raw_test(slots, out), out)


def predicted_sql(e: Ensemble, slots: list[Slot], dialect: str = "ansi") -> str:
    """The model's prediction as SQL text over raw columns (``ansi`` or ``spark`` literals)."""
    out = _Text(dialect)
    return _prediction(e, _raw_test(slots, out), out)


def predicted_from_vector(e: Ensemble, vector: Column) -> Column:
    """The model's prediction as a column over ``vector_to_array`` of the feature vector."""
    out = _Columns()
    return _prediction(e, _vector_test(vector), out)


def leaf_of(e: Ensemble, tree: int, slots: list[Slot]) -> Column:
    """Id of the leaf that a row reaches in one tree."""
    out = _Columns()
    return _tree(e.trees[tree], _raw_test(slots, out), lambda n: F.lit(n.id), out)


def probabilities(e: Ensemble, slots: list[Slot]) -> Column:
    """Class probabilities of a tree or forest as an array over raw columns."""
    if not e.classes or e.combine == "sum":
        raise ValueError("class probabilities come from classification trees and forests")
    out = _Columns()
    scores = _class_scores(e, _raw_test(slots, out), out)
    total = _total(scores, None, out)
    return F.array(*[F.when(total == 0, F.lit(0.0)).otherwise(s / total) for s in scores])


def score(df: DataFrame, e: Ensemble, slots: list[Slot], out: str = names.PREDICTION) -> DataFrame:
    """``df`` with the compiled prediction; reads raw columns only."""
    return df.withColumn(out, predicted(e, slots))


def rules(e: Ensemble, slots: list[Slot], tree: int = 0, dialect: str = "ansi") -> list[tuple[int, str, float, int]]:
    """(leaf, condition, prediction, training rows) of one tree; the conditions are SQL over raw columns, exact and disjoint."""
    out, found = _Text(dialect), []
    test = _raw_test(slots, out)

    def walk(node: Node, conditions: list[str]) -> None:
        if node.children is None:
            found.append((node.id, " AND ".join(f"({c})" for c in conditions) or "TRUE", node.prediction, node.n))
            return
        c = test(node.split)
        walk(node.children[0], [*conditions, c])
        walk(node.children[1], [*conditions, f"NOT ({c})"])

    walk(e.trees[tree], [])
    return found


def agreement(df: DataFrame, e: Ensemble, slots: list[Slot], key: str, tolerance: float = 0.0) -> DataFrame:
    """``key, same_raw, same_vector``: whether the two compiled forms equal ``prediction`` of a scored frame.

    ``tolerance`` is relative: a boosted model sums its trees in the order of its linear algebra library.
    """
    model = F.col(names.PREDICTION)
    close = lambda c: F.abs(c - model) <= F.greatest(F.abs(model), F.lit(1.0)) * tolerance
    wide = df.withColumn("__slots", vector_to_array(names.FEATURES))
    return wide.select(key, close(predicted(e, slots)).alias("same_raw"), close(predicted_from_vector(e, F.col("__slots"))).alias("same_vector"))
