"""Column-level lineage, read from the analysed plan of what is written.

A job declares nothing: the plan of the frame that it writes says which columns each
output comes from. Attributes in a plan have ids; Project, Aggregate, Window and Generate
define new ones by expressions over their inputs, Union pairs its children's by
position, and every other operator hands its inputs on. Following the ids from the
outputs to the leaves gives, for each output column, the source columns and the
expression that made it. Only columns that take part in the *value* count: a filter or
join condition is not lineage of the columns that pass it.

A job's edges are a small frame (a row a pair of columns); jobs that read each other's
tables are joined by the tables' qualified names and walked with
``quarry.operators.graph.walk_many``.

Defined results: an output that takes no column (a literal) has no edges; ``count(*)`` and the like come
from ``<table>.*`` (its rows) of the leaves below, and a table's rows from those of the leaves; an operator that maps rows in Python hands every
input column to every output; a leaf that is not one of the named tables is called by
its own kind (``LocalRelation``).
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators.graph import walk_many

ROWS = "*"
EDGES = "src string, dst string, expression string"
_IDS = re.compile(r"#\d+L?")


def _items(scala_seq) -> list:
    return [scala_seq.apply(i) for i in range(scala_seq.size())]


def _attribute_id(attribute) -> int:
    return attribute.exprId().id()


def _text(expression) -> str:
    return _IDS.sub("", expression.sql() if expression.resolved() else expression.toString()).replace("`", "")


@dataclass
class _Column:
    """What is known of an attribute: the (leaf, column) pairs it comes from and its expression."""
    sources: set = field(default_factory=set)
    expression: str = ""


class _Reader:
    def __init__(self, names: dict[str, str]):
        self.names = {_path(k): v for k, v in names.items()}  # where a table lies: its name
        self.known: dict[int, _Column] = {}
        self.ctes: dict[int, tuple[list[_Column], set[str]]] = {}  # WITH queries: their columns and leaves

    def leaf_name(self, node) -> str:
        try:
            paths = _items(node.relation().location().rootPaths())
        except Exception:  # no file relation
            return node.nodeName()
        for p in paths:
            place = _path(p.toString())
            for at, name in self.names.items():
                if place == at or place.startswith(at + "/"):
                    return name
        return _path(paths[0].toString()) if paths else node.nodeName()

    def read(self, node) -> set[str]:
        """Learns the attributes of ``node`` and all below; returns the leaves' names."""
        if node.nodeName() == "WithCTE":
            for d in _items(node.cteDefs()):  # each may refer to those before it
                leaves = self.read(d.child())
                self.ctes[d.id()] = [self.known[_attribute_id(a)] for a in _items(d.child().output())], leaves
            return self.read(node.plan())
        children = _items(node.children())
        if node.nodeName() == "CTERelationRef" and node.cteId() in self.ctes:
            columns, leaves = self.ctes[node.cteId()]
            for a, c in zip(_items(node.output()), columns):
                self.known[_attribute_id(a)] = c
            return leaves
        if not children:
            name = self.leaf_name(node)
            for a in _items(node.output()):
                self.known[_attribute_id(a)] = _Column({(name, a.name())}, a.name())
            return {name}
        leaves = set().union(*[self.read(c) for c in children])
        kind = node.nodeName()
        outputs = _items(node.output())
        if kind == "Union":
            columns = [[self.known[_attribute_id(a)] for a in _items(c.output())] for c in children]
            for i, a in enumerate(outputs):
                parts = [c[i] for c in columns]
                texts = list(dict.fromkeys(p.expression for p in parts))
                self.known[_attribute_id(a)] = _Column(set().union(*[p.sources for p in parts]), " | ".join(texts))
            return leaves
        for e in self.defining(node, kind):
            self.define(e, leaves)
        inputs = [self.known[_attribute_id(a)] for c in children for a in _items(c.output()) if _attribute_id(a) in self.known]
        for a in outputs:  # an operator that defines columns in a way not known here: all of its inputs
            if _attribute_id(a) not in self.known:
                self.known[_attribute_id(a)] = _Column(set().union(*[c.sources for c in inputs]) if inputs else set(), kind)
        return leaves

    def defining(self, node, kind: str) -> list:
        if kind == "Project":
            return _items(node.projectList())
        if kind == "Aggregate":
            return _items(node.aggregateExpressions())
        if kind == "Window":
            return _items(node.windowExpressions())
        if kind == "Generate":
            made, text = self.sources(node.generator()), _text(node.generator())
            for a in _items(node.generatorOutput()):
                self.known[_attribute_id(a)] = _Column(made, text)
        return []

    def sources(self, expression) -> set:
        return set().union(*[self.known[_attribute_id(a)].sources for a in _items(expression.references().toSeq())
                             if _attribute_id(a) in self.known])

    def define(self, e, leaves: set[str]) -> None:
        if e.nodeName() != "Alias":
            return  # handed on under its own id
        child = e.child()
        made = self.sources(child)
        references = _items(child.references().toSeq())
        if not references and not child.foldable():
            made = {(leaf, ROWS) for leaf in leaves}  # counts rows
        if child.nodeName() == "AttributeReference" and _attribute_id(child) in self.known:
            text = self.known[_attribute_id(child)].expression  # a new name only
        else:
            text = _text(child)
        self.known[_attribute_id(e)] = _Column(made, text)


def _path(place: str) -> str:
    return re.sub(r"^[a-z]+:/+", "/", place).rstrip("/")


def column_edges(df: DataFrame, target: str, names: dict[str, str]) -> list[tuple[str, str, str]]:
    """(source column, target column, expression) for the columns of ``df``, which is written as
    ``target``; ``names`` tells the qualified name of the table at each path."""
    plan = df._jdf.queryExecution().analyzed()
    reader = _Reader(names)
    out = [(f"{leaf}.{ROWS}", f"{target}.{ROWS}", ROWS) for leaf in sorted(reader.read(plan))]  # rows come from rows
    for a in _items(plan.output()):
        c = reader.known[_attribute_id(a)]
        out += [(f"{table}.{column}", f"{target}.{a.name()}", c.expression) for table, column in sorted(c.sources)]
    return out


def trace(spark: SparkSession, edges: list[tuple[str, str, str]], target: str, max_jobs: int = 64) -> DataFrame:
    """``target_column, source_column, depth``: every column upstream of the target table's, with
    the number of jobs between; the walk goes over the edges of all jobs at once. Columns that no
    job makes (``is_source``) are where the lineage ends."""
    frame = spark.createDataFrame(edges, EDGES)
    graph = frame.select(F.lit("columns").alias("graph"), "src", "dst")
    starts = (frame.where(F.col("dst").startswith(target + ".") & (F.col("dst") != f"{target}.{ROWS}")).select("dst").distinct()
              .select(F.col("dst").alias("walk"), F.lit("columns").alias("graph"), F.col("dst").alias("node"),
                      F.lit("IN").alias("direction"), F.lit(max_jobs).alias("max_depth")))
    made = frame.select(F.col("dst").alias("node")).distinct().withColumn("made", F.lit(True))
    walked = walk_many(graph, starts, settings=(max_jobs, {"IN"})).where("depth > 0")
    return (walked.join(made, "node", "left")
            .select(F.col("walk").alias("target_column"), F.col("node").alias("source_column"), F.col("depth").cast("int").alias("depth"),
                    F.col("made").isNull().alias("is_source")))
