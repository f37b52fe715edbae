"""Tables in relation: fan-out, orphans, coverage; and the graph of declared keys."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import none_null

#: Children of a parent from which on one bin holds all.
CAP = 50


def fanout(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """One row for each parent key: ``k`` children. Children are counted before they meet the parents."""
    counted = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("k"))
    return parent.select(F.col(pk).alias("key")).join(counted, F.col("key") == F.col("_k"), "left").select("key", F.coalesce("k", F.lit(0)).alias("k"))


def fanout_histogram(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """k, parents: how many parents have k children, zero included."""
    return fanout(child, parent, fk, pk).groupBy("k").agg(F.count(F.lit(1)).alias("parents"))


def orphans(child: DataFrame, parent: DataFrame, fk: list[str], pk: list[str]) -> DataFrame:
    """Child rows with a whole key that no parent has (MATCH SIMPLE)."""
    on = [child[f] == parent[p] for f, p in zip(fk, pk, strict=True)]
    return child.where(none_null(*[F.col(f) for f in fk])).join(parent.select(*pk), on, "left_anti")


def orphan_rate(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """One row: n (whole keys), orphans, orphan_rate; keys are counted before the join."""
    counted = child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k")).agg(F.count(F.lit(1)).alias("c"))
    keys = parent.select(F.col(pk).alias("_p")).distinct()
    met = counted.join(keys, F.col("_k") == F.col("_p"), "left")
    return met.agg(F.coalesce(F.sum("c"), F.lit(0)).alias("n"), F.coalesce(F.sum(F.when(F.col("_p").isNull(), F.col("c"))), F.lit(0)).alias("orphans")).withColumn("orphan_rate", F.round(F.col("orphans") / F.col("n"), 6))


def fanout_metrics(source: DataFrame, synthetic: DataFrame) -> DataFrame:
    """One row from two :func:`fanout` frames: TVD of the capped histograms, mean ratio, childless difference, adherence to the source range, coverage ratio."""
    both = source.withColumn("side", F.lit(0)).union(synthetic.withColumn("side", F.lit(1)))
    by = both.groupBy("side", F.least("k", F.lit(CAP)).alias("b")).agg(F.count(F.lit(1)).alias("c"), F.sum("k").alias("s"))
    bins = by.groupBy("b").agg(*[F.coalesce(F.sum(F.when(F.col("side") == s, F.col(x))), F.lit(0)).alias(f"{x}{s}") for x in ("c", "s") for s in (0, 1)])
    total = bins.agg(F.sum("c0").alias("n0"), F.sum("c1").alias("n1"), F.sum("s0").alias("t0"), F.sum("s1").alias("t1"))
    cross = bins.crossJoin(F.broadcast(total)).withColumn("p", F.col("c0") / F.col("n0")).withColumn("q", F.col("c1") / F.col("n1"))
    zero = lambda x: F.coalesce(F.sum(F.when(F.col("b") == 0, F.col(x))), F.lit(0.0))
    shape = cross.agg(
        F.round(F.sum(F.abs(F.col("p") - F.col("q"))) / 2, 6).alias("fanout_tvd"),
        F.round(F.max(F.col("t1") / F.col("n1")) / F.max(F.col("t0") / F.col("n0")), 6).alias("fanout_mean_ratio"),
        F.round(F.abs(zero("q") - zero("p")), 6).alias("zero_child_share_delta"),
        F.round((1 - zero("q")) / (1 - zero("p")), 6).alias("parent_coverage"),
    )
    span = source.agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    inside = synthetic.crossJoin(F.broadcast(span)).agg(F.round(F.avg(F.col("k").between(F.col("lo"), F.col("hi")).cast("double")), 6).alias("cardinality_adherence"))
    return shape.crossJoin(F.broadcast(inside))


def fanout_w1(source: DataFrame, synthetic: DataFrame) -> DataFrame:
    """One row: the Wasserstein distance of two :func:`fanout` frames, parents of CAP children or more at their side's own mean."""
    both = source.withColumn("side", F.lit(0)).union(synthetic.withColumn("side", F.lit(1)))
    bins = both.groupBy("side", F.least("k", F.lit(CAP)).alias("b")).agg(F.count(F.lit(1)).alias("c"), F.avg("k").alias("x"))
    sizes = bins.groupBy("side").agg(F.sum("c").alias("n"))
    mass = bins.join(F.broadcast(sizes), "side").groupBy("x").agg(*[F.sum(F.when(F.col("side") == s, F.col("c") / F.col("n")).otherwise(0.0)).alias(f"p{s}") for s in (0, 1)])
    w = Window.orderBy("x")  # of CAP + 2 rows at most
    up = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    gaps = mass.select((F.lead("x").over(w) - F.col("x")).alias("width"), F.abs(F.sum("p0").over(up) - F.sum("p1").over(up)).alias("gap"))
    return gaps.agg(F.round(F.sum(F.col("width") * F.col("gap")), 6).alias("fanout_w1"))


def broadcast_orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str, most: int = 10_000_000) -> DataFrame:
    """One row as :func:`orphan_rate`'s: the parent's keys are broadcast if there are ``most`` at most, shuffled if more."""
    keys = parent.select(F.col(pk).alias("_p")).where("_p IS NOT NULL").distinct()
    side = F.broadcast(keys) if keys.count() <= most else keys
    met = child.where(F.col(fk).isNotNull()).join(side, F.col(fk) == F.col("_p"), "left")
    return met.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("_p").isNull()).alias("orphans")).withColumn("orphan_rate", F.round(F.col("orphans") / F.col("n"), 6))


def cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """columns..., n: the joint counts of the columns that complete a key."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))


def distinct_tuples(df: DataFrame, columns: list[str]) -> DataFrame:
    """n_tuples: distinct tuples without NULL."""
    return df.select(*columns).na.drop().distinct().agg(F.count(F.lit(1)).alias("n_tuples"))


@dataclass(frozen=True)
class Edge:
    child: str
    parent: str
    columns: tuple[tuple[str, str], ...]  # child column, parent column
    enforced: bool = True
    drives: bool = False


@dataclass
class Model:
    """A declared graph of tables; few enough that plain Python walks it."""

    tables: list[str]
    edges: list[Edge] = field(default_factory=list)

    def __post_init__(self):
        for e in self.edges:
            if e.child not in self.tables or e.parent not in self.tables:
                raise ValueError(f"unknown table in {e.child} -> {e.parent}")

    def component(self, table: str) -> list[str]:
        """The tables connected with one, by any edge."""
        found, queue = {table}, [table]
        while queue:
            at = queue.pop()
            for e in self.edges:
                for a, b in ((e.child, e.parent), (e.parent, e.child)):
                    if a == at and b not in found:
                        found.add(b)
                        queue.append(b)
        return [t for t in self.tables if t in found]

    def waves(self) -> list[list[str]]:
        """Tables in the order in which they can be made: parents of enforced edges first."""
        left, done, out = list(self.tables), set(), []
        while left:
            ready = [t for t in left if all(e.parent in done or e.parent == t for e in self.edges if e.enforced and e.child == t)]
            if not ready:
                raise ValueError(f"a cycle among {left}")
            out.append(ready)
            done.update(ready)
            left = [t for t in left if t not in done]
        return out

    def driving(self, table: str) -> Edge | None:
        """The edge that decides how many rows a table gets: the only, the marked or the first enforced one."""
        own = [e for e in self.edges if e.child == table and e.enforced]
        marked = [e for e in own if e.drives]
        if len(marked) > 1:
            raise ValueError(f"{table} has two driving edges")
        return (marked or own or [None])[0]

    def roles(self, table: str) -> dict[Edge, str]:
        """driving; implied (its columns are all among the driving edge's); conditional (some are); independent."""
        main = self.driving(table)
        out = {}
        for e in (e for e in self.edges if e.child == table):
            own, drive = {c for c, _ in e.columns}, {c for c, _ in main.columns} if main else set()
            out[e] = "external" if not e.enforced else "driving" if e is main else "implied" if own <= drive else "conditional" if own & drive else "independent"
        return out

    def mermaid(self) -> str:
        return "\n".join(["erDiagram", *[f"  {e.parent} ||--o{{ {e.child} : {'-'.join(c for c, _ in e.columns)}" for e in self.edges]])

    def widened(self, table: str) -> dict[Edge, tuple[tuple[str, str], ...]]:
        """A table's edges with the column pairs that a child of it pins: where a child refers to a column of
        the table that the table itself takes from a parent, and to that parent by the same column, the pair
        belongs to the edge."""
        out = {}
        for e in (e for e in self.edges if e.child == table):
            pairs = list(e.columns)
            for low in (x for x in self.edges if x.parent == table):
                for up in (x for x in self.edges if x.child == low.child and x.parent == e.parent):
                    by_child = dict(low.columns)
                    pairs += [(by_child[c], p) for c, p in up.columns if c in by_child and (by_child[c], p) not in pairs]
            out[e] = tuple(pairs)
        return out

    def overlap(self, edge: Edge) -> tuple[list[str], list[str]]:
        """The child columns that an edge shares with the driving edge, and its others."""
        main = self.driving(edge.child)
        drive = {c for c, _ in main.columns} if main and main is not edge else set()
        own = [c for c, _ in edge.columns]
        return [c for c in own if c in drive], [c for c in own if c not in drive]

    def check_ownership(self) -> None:
        """Two edges that don't drive may not write one column."""
        for t in self.tables:
            owner: dict[str, Edge] = {}
            main = self.driving(t)
            for e in (e for e in self.edges if e.child == t and e.enforced and e is not main):
                for c in self.overlap(e)[1]:
                    if c in owner:
                        raise ValueError(f"{t}.{c} is written by the edges to {owner[c].parent} and to {e.parent}")
                    owner[c] = e

    def digest(self) -> str:
        """A name of the content: the same for the same tables and edges in any order."""
        import hashlib

        lines = [*sorted(self.tables), *sorted(repr(e) for e in self.edges)]
        return hashlib.sha256("\n".join(lines).encode()).hexdigest()[:16]

    def card(self) -> str:
        """Tables in the order in which they are made, with the roles of their edges."""
        lines = []
        for n, wave in enumerate(self.waves()):
            for t in wave:
                roles = "; ".join(f"{role} {e.parent} by {', '.join(c for c, _ in e.columns)}" for e, role in self.roles(t).items())
                lines.append(f"{n}. {t}" + (f": {roles}" if roles else ""))
        return "\n".join(lines)

    def launch(self, wanted: list[str], landed: list[str] = ()) -> list[str]:
        """The tables to make, in order: those wanted and the enforced parents that have not landed."""
        todo, found = list(wanted), set()
        while todo:
            t = todo.pop()
            if t not in found and t not in landed:
                found.add(t)
                todo += [e.parent for e in self.edges if e.child == t and e.enforced]
        return [t for wave in self.waves() for t in wave if t in found]


#: Families of key types; a key of one family can refer to one of the same.
FAMILIES = {"bigint": "integer", "int": "integer", "smallint": "integer", "tinyint": "integer", "string": "text", "double": "float", "float": "float", "date": "date", "timestamp": "time", "timestamp_ntz": "time", "boolean": "boolean", "binary": "bytes"}


def incompatible(edge: Edge, child: DataFrame, parent: DataFrame) -> list[str]:
    """The column pairs of an edge whose types are of different families: it can't be evaluated."""
    own, theirs = dict(child.dtypes), dict(parent.dtypes)
    family = lambda t: "decimal" if t.startswith("decimal") else FAMILIES.get(t, t)
    return [f"{c} {own.get(c)} and {p} {theirs.get(p)}" for c, p in edge.columns if own.get(c) is None or theirs.get(p) is None or family(own[c]) != family(theirs[p])]


def load_model(text: str) -> Model:
    """A model from YAML: ``tables`` and ``edges`` of child, parent, columns (child: parent), enforced, drives; other keys are errors."""
    import yaml

    given = yaml.safe_load(text) or {}
    if extra := set(given) - {"tables", "edges"}:
        raise ValueError(f"unknown keys {sorted(extra)}")
    edges = []
    for e in given.get("edges") or []:
        if extra := set(e) - {"child", "parent", "columns", "enforced", "drives"}:
            raise ValueError(f"unknown keys {sorted(extra)} of an edge")
        edges.append(Edge(e["child"], e["parent"], tuple(e["columns"].items()), e.get("enforced", True), e.get("drives", False)))
    return Model(list(given.get("tables") or []), edges)
