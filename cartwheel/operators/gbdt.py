"""Leaf-wise histogram trees for a binary label, grown as Spark aggregates (M5).

* A numeric column becomes at most ``MAX_BINS`` bins (its distinct values if there are no more, else percentiles); a
  categorical column's bins are its values, however many.
* Histograms are sums of gradients and hessians by (tree, node, feature, bin).  One aggregate gives the roots'.  A later round
  reads only the rows of the smaller child of every split that is new (the scan filters them by that split, a task by
  the way above it) and stores its histogram; the larger child's is that of the last stored node above it, less the stored
  ones split off since.  Sums are integers, so the difference is exact.
* Numeric bins are scanned in order.  Categories with ``CAT_SMOOTH`` rows in the node or more are ordered by gradient /
  (hessian + CAT_SMOOTH), and sets of up to ``MOST_CATEGORIES`` from either end are tried: the window that ranks them keeps
  that many rows a group before its exchange, so no group of millions of categories is ever sorted whole.  A category
  with fewer rows in a node has no more below it.
* Growth is best first: the leaf of largest gain splits next, until the tree has ``leaves`` leaves.  A leaf's best split
  does not depend on that order, so a round looks at the children of every leaf that may still be chosen, in all trees
  at once (the folds of a cross validation are trees of one job), and the driver replays the order.

Sums are 64-bit fixed point (2**-24 a row, good for 5e11 rows), so splits do not depend on the order of additions.
The driver and the tasks hold at most trees x leaves splits of up to MOST_CATEGORIES values.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cartwheel.operators.topn import top_n_per_group
from cartwheel.session import shared_path

# fixed values: the defaults of the reference's tree library, and its number of leaves
LEAVES = 100
RATE = 0.1
MAX_BINS = 255
MIN_ROWS = 20
CAT_SMOOTH = 10
CAT_L2 = 10.0
MOST_CATEGORIES = 32

SCALE = float(1 << 24)


@dataclass
class Bins:
    """How columns become bins: ``edges`` of the numeric ones; all other features are categories."""
    features: list[str]
    edges: dict[str, list[float]]

    def columns(self) -> list[Column]:
        """b0, b1 ..: a numeric column's bin number (0: missing), a category as it is."""
        out = []
        for k, c in enumerate(self.features):
            bin_ = F.col(c)
            if c in self.edges:
                value = F.col(c).cast("double")
                below = F.size(F.filter(F.array(*[F.lit(e) for e in self.edges[c]]).cast("array<double>"), lambda e: e < value))  # noqa: B023
                bin_ = F.when(F.col(c).isNull(), 0).otherwise(below + 1).cast("int")
            out.append(bin_.alias(f"b{k}"))
        return out

    def text(self, k: int) -> Column:
        """A bin as text: numbers have five digits, so they sort; a missing category is empty."""
        if self.features[k] in self.edges:
            return F.lpad(F.col(f"b{k}").cast("string"), 5, "0")
        return F.coalesce(F.col(f"b{k}").cast("string"), F.lit(""))


def fit_bins(table: DataFrame, features: Sequence[str], categorical: Sequence[str], max_bins: int = MAX_BINS) -> Bins:
    """Edges of the numeric columns: upper bounds of all bins but the last."""
    numeric = [c for c in features if c not in categorical]
    if not numeric:
        return Bins(list(features), {})
    few = table.agg(*[F.approx_count_distinct(c).alias(c) for c in numeric]).first()
    edges: dict[str, list[float]] = {}
    exact = [c for c in numeric if few[c] <= 2 * max_bins]
    for c in exact:  # the limit keeps a column of more values than thought from growing the result
        values = [r[0] for r in table.select(F.col(c).cast("double").alias("v")).where("v is not null").distinct().orderBy("v").limit(max_bins + 1).collect()]
        if len(values) <= max_bins:
            edges[c] = values[:-1]
    wide = [c for c in numeric if c not in edges]
    if wide:
        cuts = [k / max_bins for k in range(1, max_bins)]
        row = table.agg(*[F.percentile_approx(F.col(c).cast("double"), cuts, 100_000).alias(c) for c in wide]).first()
        edges |= {c: sorted(set(row[c] or [])) for c in wide}
    return Bins(list(features), edges)


@dataclass
class Split:
    gain: float
    feature: int
    categories: list[str] | None   # go left; None: numeric
    upto: str | None               # last numeric bin that goes left
    left: tuple[int, int, int]     # (gradient, hessian, rows), fixed point
    right: tuple[int, int, int]


@dataclass
class Tree:
    """Nodes are named by their way from the root ('' , 'L', 'LR' ..)."""
    total: tuple[int, int, int] = (0, 0, 0)
    best: dict[str, Split | None] = field(default_factory=dict)   # known best splits
    order: list[str] = field(default_factory=list)                # nodes split, in order

    def replay(self, leaves: int) -> list[str]:
        """Best-first order as far as it is known; returns the nodes whose children have to be looked at next."""
        heap: list[tuple[float, str]] = []

        def offer(node: str) -> None:
            if self.best.get(node) is not None:
                heapq.heappush(heap, (-self.best[node].gain, node))

        self.order = []
        offer("")
        while heap and len(self.order) < leaves - 1:
            _, node = heap[0]
            if node + "L" not in self.best and len(self.order) < leaves - 2:
                rest = leaves - 1 - len(self.order)
                return [n for _, n in heapq.nsmallest(rest, heap) if n + "L" not in self.best]
            heapq.heappop(heap)
            self.order.append(node)
            offer(node + "L")
            offer(node + "R")
        return []

    def sums(self, node: str) -> tuple[int, int, int]:
        if not node:
            return self.total
        s = self.best[node[:-1]]
        return s.left if node[-1] == "L" else s.right

    def smaller(self, node: str) -> str:
        """The child of a split node that has fewer rows (the left one of equal ones)."""
        s = self.best[node]
        return node + ("L" if s.left[2] <= s.right[2] else "R")

    def made_of(self, node: str) -> tuple[str, list[str]]:
        """The node's histogram: that of the nearest smaller child (or root) at or above it, less those of the smaller children between."""
        less: list[str] = []
        while node and node != self.smaller(node[:-1]):
            less.append(self.smaller(node[:-1]))
            node = node[:-1]
        return node, less

    def leaves(self) -> dict[str, tuple[int, int, int]]:
        out = {"": self.total}
        for node in self.order:
            s = self.best[node]
            del out[node]
            out[node + "L"], out[node + "R"] = s.left, s.right
        return out

    def numbers(self) -> dict[str, int]:
        """Leaf number of every node: a split's left child keeps its parent's, the right one takes the split's (1, 2 ..)."""
        out = {"": 0}
        for k, node in enumerate(self.order, 1):
            out[node + "L"], out[node + "R"] = out[node], k
        return out


def value_of(sums: tuple[int, int, int], reg: float = 0.0) -> float:
    """-G / (H + reg) of fixed-point sums."""
    g, h = sums[0] / SCALE, sums[1] / SCALE
    return -g / (h + reg) if h + reg > 0 else 0.0


class _Columns:
    """Bins of a block of rows: per feature the block's distinct bins and every row's place among them."""

    def __init__(self, batches: list[pa.RecordBatch], n_features: int):
        block = pa.Table.from_batches(batches).combine_chunks()
        self.label = block.column("label").to_numpy()
        self.fold = block.column("fold").to_numpy()
        self.bins, self.codes, self.place = [], [], []
        for k in range(n_features):
            column = block.column(f"b{k}").combine_chunks()
            column = (column.chunk(0) if isinstance(column, pa.ChunkedArray) else column).dictionary_encode()
            self.bins.append(np.array(column.dictionary.to_pylist(), dtype=object))
            self.codes.append(column.indices.to_numpy())
            self.place.append({b: i for i, b in enumerate(self.bins[-1])})

    def left(self, s: Split, rows: np.ndarray) -> np.ndarray:
        able = np.zeros(len(self.bins[s.feature]), bool)
        if s.categories is None:
            able[:] = self.bins[s.feature] <= s.upto
        else:
            able[[self.place[s.feature][c] for c in s.categories if c in self.place[s.feature]]] = True
        return able[self.codes[s.feature][rows]]

    def nodes(self, splits: dict[str, Split]) -> tuple[np.ndarray, list[str]]:
        """Every row's node as an index into the names, below all splits."""
        names, at = [""], np.zeros(len(self.label), np.int32)
        members = {"": np.arange(len(self.label))}
        for node in sorted(splits, key=len):
            rows = members.pop(node)
            left = self.left(splits[node], rows)
            for side, chosen in (("L", left), ("R", ~left)):
                members[node + side] = rows[chosen]
                at[rows[chosen]] = len(names)
                names.append(node + side)
        return at, names


def _blocks(batches: Iterator[pa.RecordBatch], n_features: int, rows: int = 1 << 16) -> Iterator[_Columns]:
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
        if sum(b.num_rows for b in held) >= rows:
            yield _Columns(held, n_features)
            held = []
    if held:
        yield _Columns(held, n_features)


@dataclass
class Data:
    """Rows as a written table (label, fold, b0 ..: bins as text); tree t trains on the rows whose fold is not t."""
    path: str
    bins: Bins
    shares: dict[int, float]              # of positive labels among a tree's training rows
    sizes: dict[int, tuple[int, int]]     # a tree's training rows, and the positive ones

    @staticmethod
    def write(rows: DataFrame, bins: Bins, trees: int = 1, label: str = "label") -> Data:
        """``rows``: the label, ``fold`` and the columns that ``bins`` were fitted on."""
        spark = rows.sparkSession
        path = shared_path(spark, "gbdt_rows")
        y = F.coalesce((F.col(label) > 0).cast("int"), F.lit(0))
        texts = [bins.text(k).alias(f"b{k}") for k in range(len(bins.features))]
        rows.select(y.alias("label"), F.col("fold").cast("int").alias("fold"), *bins.columns()).select("label", "fold", *texts).write.parquet(path)
        told = spark.read.parquet(path).groupBy("fold").agg(F.sum("label").alias("y"), F.count("*").alias("n")).collect()  # a row a fold
        sizes = {}
        for t in range(trees):
            n, y = sum(r["n"] for r in told if r["fold"] != t), sum(r["y"] for r in told if r["fold"] != t)
            if n:
                sizes[t] = n, y
        return Data(path, bins, {t: y / n for t, (n, y) in sizes.items()}, sizes)

    def read(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(self.path).select("label", "fold", *[f"b{k}" for k in range(len(self.bins.features))])

    def base(self, t: int) -> float:
        p = min(max(self.shares[t], 1e-15), 1 - 1e-15)
        return math.log(p / (1 - p))

    def gradients(self, t: int) -> tuple[np.ndarray, int]:
        """Fixed-point gradients of labels 0 and 1, and the hessian, of the log-loss at the base."""
        p = min(max(self.shares[t], 1e-15), 1 - 1e-15)
        return np.array([math.floor(p * SCALE), math.floor((p - 1) * SCALE)], np.int64), math.floor(p * (1 - p) * SCALE)

    def total(self, t: int) -> tuple[int, int, int]:
        """(gradient, hessian, rows) of a tree's training rows."""
        (g, h), (n, y) = self.gradients(t), self.sizes[t]
        return (n - y) * int(g[0]) + y * int(g[1]), n * h, n


CELL = "tree int, node string, feature int, bin string, g long, h long, n long"


def _small(spark: SparkSession, rows: list[tuple], shape: str) -> DataFrame:
    """A table of a few rows that needs no task of its own."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string()}
    names, types = zip(*[c.split() for c in shape.split(", ")], strict=True)
    return spark.createDataFrame(pa.table([pa.array(c, kinds[t]) for c, t in zip(zip(*rows, strict=True), types, strict=True)], list(names)))


def _kept(hist: DataFrame, numeric: Sequence[int]) -> DataFrame:
    """Without empty bins and categories of too few rows to be ordered, here or in any node below."""
    return hist.where(F.col("n") >= F.when(F.col("feature").isin(list(numeric)), 1).otherwise(CAT_SMOOTH))


def _root_histograms(data: Data, spark: SparkSession, trees: Sequence[int]) -> DataFrame:
    """``CELL`` rows of all roots: counts by (feature, bin) of the rows of all folds but the tree's."""
    cells = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f"b{f}").alias("bin")) for f in range(len(data.bins.features))]))
    counts = []
    for t in trees:
        mine = F.coalesce(F.col("fold") != t, F.lit(False))
        counts += [F.count_if(mine).alias(f"n{t}"), F.count_if(mine & (F.col("label") == 1)).alias(f"y{t}")]
    told = data.read(spark).select("label", "fold", cells.alias("cell")).groupBy("cell.feature", "cell.bin").agg(*counts)
    sums = []
    for t in trees:
        (g, h), n, y = data.gradients(t), F.col(f"n{t}"), F.col(f"y{t}")
        sums.append(F.struct(F.lit(t).alias("tree"), F.lit("").alias("node"), "feature", "bin",
                             ((n - y) * F.lit(int(g[0])) + y * F.lit(int(g[1]))).alias("g"), (n * F.lit(h)).alias("h"), n.alias("n")))
    return told.select(F.explode(F.array(*sums)).alias("cell")).select("cell.*")


def _histograms(data: Data, spark: SparkSession, trees: dict[int, Tree], wanted: dict[int, list[str]]) -> DataFrame:
    """``CELL`` rows of the wanted nodes, from their rows."""
    n_features = len(data.bins.features)
    steps = {t: data.gradients(t) for t in wanted}
    ways = {t: {n: [(trees[t].best[n[:k]], n[k]) for k in range(len(n) - 1, -1, -1)] for n in nodes} for t, nodes in wanted.items()}   # nearest split first

    def taken(t: int, s: Split, side: str) -> Column:
        bin_ = F.col(f"b{s.feature}")
        left = bin_ <= s.upto if s.categories is None else bin_.isin(s.categories)
        return (F.col("fold") != t) & (left if side == "L" else ~left)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, n_features):
            cells: list[tuple[np.ndarray, ...]] = []
            for t, nodes in ways.items():
                mine = np.flatnonzero(block.fold != t)
                for node, way in nodes.items():
                    rows = mine
                    for s, side in way:
                        if not len(rows):
                            break
                        rows = rows[block.left(s, rows) == (side == "L")]
                    if not len(rows):
                        continue
                    g, h = steps[t][0][block.label[rows]], steps[t][1]
                    for f in range(n_features):
                        cell, inverse, n = np.unique(block.codes[f][rows], return_inverse=True, return_counts=True)
                        sums = np.bincount(inverse, weights=g, minlength=len(cell)).astype(np.int64)   # below 2**53: a block has 2**17 rows at most
                        size = len(cell)
                        cells.append((np.full(size, t, np.int32), np.full(size, node, object), np.full(size, f, np.int32), block.bins[f][cell], sums, n * h, n))
            if cells:
                columns = [np.concatenate(c) for c in zip(*cells, strict=True)]
                yield pa.record_batch([pa.array(c, pa.string()) if c.dtype == object else pa.array(c) for c in columns], ["tree", "node", "feature", "bin", "g", "h", "n"])

    some = F.lit(False)
    for t, nodes in ways.items():
        for way in nodes.values():
            some = some | taken(t, *way[0])
    parts = data.read(spark).where(some).mapInArrow(add, CELL)
    return parts.groupBy("tree", "node", "feature", "bin").agg(F.sum("g").alias("g"), F.sum("h").alias("h"), F.sum("n").alias("n"))


class _Stored:
    """Histograms of the roots and of smaller children, written round by round."""

    def __init__(self, spark: SparkSession, numeric: Sequence[int]):
        self.spark, self.numeric = spark, list(numeric)
        self.top = shared_path(spark, "gbdt_histograms")
        self.round: dict[tuple[int, str], int] = {}
        self.rounds = 0

    def add(self, hist: DataFrame, nodes: dict[int, list[str]]) -> None:
        hist.write.parquet(f"{self.top}/{self.rounds}")
        self.round |= {(t, n): self.rounds for t, some in nodes.items() for n in some}
        self.rounds += 1

    def _read(self, wanted: dict[tuple[int, str], str]) -> DataFrame:
        """Cells of the stored nodes in ``wanted``, under the name of the node they are for."""
        paths = [f"{self.top}/{k}" for k in sorted({self.round[key] for key in wanted})]
        names = _small(self.spark, [(t, n, to) for (t, n), to in wanted.items()], "tree int, node string, to string")   # at most trees x leaves
        cells = self.spark.read.schema(CELL).parquet(*paths).join(F.broadcast(names), ["tree", "node"])
        return cells.select("tree", F.col("to").alias("node"), "feature", "bin", "g", "h", "n")

    def of(self, trees: dict[int, Tree], nodes: dict[int, list[str]]) -> DataFrame:
        """``CELL`` rows of the nodes."""
        base, less = {}, {}
        for t, some in nodes.items():
            for node in some:
                start, gone = trees[t].made_of(node)
                base[t, start] = node
                less |= {(t, n): node for n in gone}
        out, key = self._read(base), ["tree", "node", "feature", "bin"]
        if less:
            gone = self._read(less).groupBy(*key).agg(*[F.sum(c).alias(f"-{c}") for c in ("g", "h", "n")])
            out = out.join(gone, key, "left").select(*key, *[(F.col(c) - F.coalesce(F.col(f"-{c}"), F.lit(0))).alias(c) for c in ("g", "h", "n")])
        return _kept(out, self.numeric)


def _best_splits(hist: DataFrame, totals: DataFrame, numeric: Sequence[int], reg: float, min_rows: int, most: int) -> DataFrame:
    """(tree, node, feature, upto, categories, gain, lg, lh, ln) of the nodes that have a split of positive gain; ``totals``: (tree,
    node, tg, th, tn), a row a node."""
    hist = hist.withColumn("numeric", F.col("feature").isin(list(numeric)) if numeric else F.lit(False))
    group = ["tree", "node", "feature"]

    def running(df: DataFrame, way: int, order: list[Column], l2: float) -> DataFrame:
        w = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
        return df.select(*group, F.lit(way).alias("way"), F.row_number().over(Window.partitionBy(*group).orderBy(*order)).alias("pos"),
                         *[F.sum(c).over(w).alias(f"l{c}") for c in ("g", "h", "n")], F.lit(l2).alias("l2"),
                         (F.col("bin") if way == 0 else F.lit(None).cast("string")).alias("upto"),
                         (F.collect_list("bin").over(w) if way else F.lit(None).cast("array<string>")).alias("categories"))

    ratio = (F.col("g") / F.lit(SCALE)) / (F.col("h") / F.lit(SCALE) + F.lit(float(CAT_SMOOTH)))
    cats = hist.where(~F.col("numeric") & (F.col("n") >= CAT_SMOOTH)).withColumn("ratio", ratio)
    ends = []
    for way, order in ((1, [F.asc("ratio"), F.asc("bin")]), (2, [F.desc("ratio"), F.asc("bin")])):
        ends.append(running(top_n_per_group(cats, group, order, most), way, order, reg + CAT_L2))
    cuts = running(hist.where("numeric"), 0, [F.asc("bin")], reg).unionByName(ends[0]).unionByName(ends[1])
    c = cuts.join(F.broadcast(totals), ["tree", "node"]).where((F.col("ln") >= min_rows) & (F.col("tn") - F.col("ln") >= min_rows))

    def part(g: Column, h: Column, l2: Column) -> Column:
        g, h = g / F.lit(SCALE), h / F.lit(SCALE)
        return F.try_divide(g * g, h + l2)   # NULL, so no gain, without any hessian

    gain = (part(F.col("lg"), F.col("lh"), F.col("l2")) + part(F.col("tg") - F.col("lg"), F.col("th") - F.col("lh"), F.col("l2"))
            - part(F.col("tg"), F.col("th"), F.lit(float(reg))))
    c = c.withColumn("gain", gain).where("gain > 0")
    best = top_n_per_group(c, ["tree", "node"], [F.desc("gain"), F.asc("feature"), F.asc("way"), F.asc("pos")], 1)
    return best.drop("tg", "th", "tn", "rnk", "l2", "way", "pos")


def grow(data: Data, spark: SparkSession, leaves: int = LEAVES, reg: float = 0.0, min_rows: int = MIN_ROWS,
         most: int = MOST_CATEGORIES) -> dict[int, Tree]:
    """Grow one tree for every number in ``data.shares``."""
    numeric = [k for k, c in enumerate(data.bins.features) if c in data.bins.edges]
    trees = {t: Tree(data.total(t)) for t in data.sizes}
    stored = _Stored(spark, numeric)
    if trees:
        stored.add(_kept(_root_histograms(data, spark, list(trees)), numeric), {t: [""] for t in trees})
    wanted = {t: [""] for t in trees}
    while wanted:
        able = {t: some for t, nodes in wanted.items() if (some := [n for n in nodes if trees[t].sums(n)[2] >= 2 * min_rows])}
        for t, nodes in wanted.items():
            trees[t].best |= dict.fromkeys(nodes)
        if scanned := {t: some for t, nodes in able.items() if (some := sorted({trees[t].smaller(n[:-1]) for n in nodes if n}))}:
            stored.add(_histograms(data, spark, trees, scanned), scanned)
        if able:
            totals = _small(spark, [(t, n, *trees[t].sums(n)) for t, nodes in able.items() for n in nodes], "tree int, node string, tg long, th long, tn long")
            for r in _best_splits(stored.of(trees, able), totals, numeric, reg, min_rows, most).collect():  # a row a node
                total, left = trees[r["tree"]].sums(r["node"]), (r["lg"], r["lh"], r["ln"])
                trees[r["tree"]].best[r["node"]] = Split(r["gain"], r["feature"], r["categories"], r["upto"], left, tuple(a - b for a, b in zip(total, left, strict=True)))
        wanted = {t: [n + side for n in new for side in "LR"] for t, tree in trees.items() if (new := tree.replay(leaves))}
    return trees


def score(data: Data, spark: SparkSession, trees: dict[int, Tree], reg: float = 0.0, rate: float = RATE) -> DataFrame:
    """(fold, label, score) of every row by the tree of its fold; rows of folds without a tree have none and stay out."""
    n_features = len(data.bins.features)
    splits = {t: {n: tree.best[n] for n in tree.order} for t, tree in trees.items()}
    values = {t: {n: data.base(t) + rate * value_of(s, reg) for n, s in tree.leaves().items()} for t, tree in trees.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _blocks(batches, n_features):
            for t in splits:
                rows = np.flatnonzero(block.fold == t)
                if len(rows):
                    at, names = block.nodes(splits[t])
                    z = np.array([values[t].get(n, 0.0) for n in names])[at[rows]]
                    yield pa.record_batch([pa.array(block.fold[rows]), pa.array(block.label[rows]), pa.array(1.0 / (1.0 + np.exp(-z)))], ["fold", "label", "score"])

    return data.read(spark).mapInArrow(run, "fold int, label int, score double")


def cross_validated(table: DataFrame, features: Sequence[str], categorical: Sequence[str], folds: int, seed: int, keys: Sequence[str],
                    leaves: int = LEAVES, rate: float = RATE, label: str = "label") -> DataFrame:
    """(fold, label, score): every row scored by the tree of its fold, which trains on all other folds; all grow together."""
    from cartwheel.functions.exprs import h64

    spark = table.sparkSession
    fold = F.pmod(h64(F.lit(seed), *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]), F.lit(folds))
    data = Data.write(table.withColumn("fold", fold), fit_bins(table, features, categorical), folds, label)
    return score(data, spark, grow(data, spark, leaves), rate=rate)


def describe(tree: Tree, bins: Bins, spark, reg: float = 0.0, rate: float = RATE) -> DataFrame:
    """(row_kind, no, leaf, feature, rule, rows, value): splits in order with their gain, then leaves with their output."""
    numbers, out = tree.numbers(), []
    for k, node in enumerate(tree.order, 1):
        s = tree.best[node]
        rule = f"<= {s.upto}" if s.categories is None else "in " + ",".join(sorted(s.categories))
        out.append(("split", k, numbers[node], bins.features[s.feature], rule, s.left[2], round(s.gain, 6)))
    for node, sums in tree.leaves().items():
        out.append(("leaf", numbers[node], numbers[node], None, None, sums[2], round(rate * value_of(sums, reg), 6)))
    return spark.createDataFrame(out, "row_kind string, no int, leaf int, feature string, rule string, rows long, value double")
