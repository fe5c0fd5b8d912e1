"""Second-order boosted trees with L1 and L2 penalties, many settings in one pass (MLD-5, MLD-6).

``pyspark.ml``'s ``GBTClassifier`` has no ``reg_alpha`` / ``reg_lambda`` and samples columns per node.  Here
a tree is grown from sums of the logistic loss's gradients ``g = p - y`` and hessians ``h = p (1 - p)``:

* features are cut into at most ``MAX_BINS`` bins at quantiles;
* per level, every task adds its rows' g and h by (model, node, feature, bin); a shuffle on (model, node)
  brings a node's partial sums together, where they are added and the best split is found from running
  sums over the bins.  Only the best split per open node comes to the driver, which holds the trees;
* with ``T(G) = sign(G) * max(|G| - reg_alpha, 0)`` a leaf weighs ``-T(G) / (H + reg_lambda)``, and a split
  gains the children's ``T(G)^2 / (H + reg_lambda)`` less the parent's; it is made if it gains more than
  nothing and at least ``gamma``, and if both children's H reach ``min_child_weight``;
* ``subsample`` draws rows per tree by a hash of their key, ``colsample_bytree`` columns per tree.

All settings and folds of a search grow together: a pass over the rows adds the histograms of as many
models as fit ``HISTOGRAM_BYTES``, so a search takes (trees x depth) jobs, not that number per model.  Sums
are whole numbers (fixed point), so trees do not depend on the partitioning.  The binned rows are dealt evenly
over the cores.  A task takes its rows column by column: a model sees only the rows of its folds and its draw.
Margins of the models that still grow are landed in the shared folder every ``LAND_EVERY`` trees.

A fitted model is handed over as an ordinary ``GBTClassificationModel`` (the trees' sum is half the
log-odds there), so scoring, saving and loading run in the JVM like those of any other Spark model.
"""

from __future__ import annotations

import math
import random
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmart.session import scratch_path

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers need not have this package

MAX_BINS = 256
HISTOGRAM_BYTES = 64 << 20
LAND_EVERY = 17
#: Elements (models x rows) that a task works on at a time.
CHUNK = 1 << 22
#: Rows of a state file, unless the cores are more than such files.
FILE_ROWS = 1 << 18
DEFAULTS = {"n_estimators": 100, "max_depth": 6, "learning_rate": 0.3, "subsample": 1.0, "colsample_bytree": 1.0,
            "gamma": 0.0, "min_child_weight": 1.0, "reg_alpha": 0.0, "reg_lambda": 1.0}


@dataclass
class Tree:
    """A binary tree by heap position: split feature (-1 at leaves), split bin, weight of the node."""

    feature: np.ndarray
    bin: np.ndarray
    weight: np.ndarray


@dataclass
class Boosted:
    """One model in growth: its setting, the fold it leaves out (-1: none), its base margin and trees."""

    setting: dict
    fold: int
    base: float
    trees: list[Tree] = field(default_factory=list)


def bin_edges(df: DataFrame, feature_cols: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Upper edges of the bins of each feature: its quantiles (one aggregate for all features)."""
    at = F.array(*[F.lit((i + 1) / max_bins) for i in range(max_bins - 1)])
    row = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), at, F.lit(10_000)).alias(f"q{i}")
                   for i, c in enumerate(feature_cols)]).first()
    return [np.unique(np.array(row[f"q{i}"] or [], float)) for i in range(len(feature_cols))]


# --- inside tasks ----------------------------------------------------------------------------

def _positions(bins, feature, cut, levels: int, node: int = 0):
    """Heap position of every row after some levels of a tree; one number if no row is parted.

    ``bins`` are arrays by feature; ``feature`` and ``cut`` lists by heap position.
    """
    if levels == 0 or feature[node] < 0:
        return np.min_scalar_type(len(feature)).type(node)
    left, right = (_positions(bins, feature, cut, levels - 1, 2 * node + 1 + side) for side in (0, 1))
    return left ^ (left ^ right) * (bins[feature[node]] > cut[node])  # the right one where the bin is above the cut


def _add_trees(margin: np.ndarray, bins, trees, levels: int) -> np.ndarray:
    """The margins of a model after more of its trees (feature, bin and weight: a row per tree)."""
    for feature, cut, weight in zip(trees[0].tolist(), trees[1].tolist(), trees[2]):
        margin += weight.take(_positions(bins, feature, cut, levels), mode="clip")
    return margin


def _drawn(key: np.ndarray, seed: int, share: float) -> np.ndarray:
    """Whether a row takes part in a tree: a hash of its key below the share."""
    with np.errstate(over="ignore"):
        x = key ^ np.uint64(seed)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
    return (x >> np.uint64(11)) * 2.0**-53 < share


def _rows(batches, n_features: int, n_margins: int, n_models: int):
    """Arrays of the state's rows, a bounded number of rows at a time; bins and margins by column."""
    def arrays(parts):
        whole = pa.Table.from_batches(parts).combine_chunks()
        column = lambda c: whole.column(c).to_numpy()
        packed = lambda c, t, n: (
            np.frombuffer(b"".join(whole.column(c).to_pylist()), t).reshape(whole.num_rows, n).T.copy())
        bins = packed("bins", "<u2", n_features)
        return (bins.astype(np.min_scalar_type(bins.max(initial=0))), column("label").astype(float), column("fold"),
                column("key").view(np.uint64), packed("margins", "<f8", n_margins))

    step, parts, held = max(1, CHUNK // max(n_models, 1)), [], 0
    for batch in batches:
        for i in range(0, batch.num_rows, step):
            parts.append(batch.slice(i, step))
            held += parts[-1].num_rows
            if held >= step:
                yield arrays(parts)
                parts, held = [], 0
    if held:
        yield arrays(parts)


# --- growth ----------------------------------------------------------------------------------

class _Growth:
    """The state table and the models that grow over it."""

    def __init__(self, state: DataFrame, models: list[Boosted], edges, n_rows: int, seed: int):
        self.state, self.models, self.edges, self.seed = state, models, edges, seed
        self.n_features, self.depth = len(edges), max(m.setting["max_depth"] for m in models)
        self.fresh = 0  # trees of the growing models since the margins were landed
        self.kept = np.array([], np.int64)  # models whose margins are landed; none: all stand at their base
        # Whole-number sums: n rows of |g| <= 1 stay below 2**62; a task's chunk stays exact in a double.
        self.scale = 2.0 ** min(32, 61 - math.ceil(math.log2(max(n_rows, 2))))
        column = lambda k: np.array([float(m.setting[k]) for m in models])
        self.rate, self.share = column("learning_rate"), column("subsample")
        self.fold, self.base = np.array([m.fold for m in models]), np.array([m.base for m in models])
        self.penalties = np.stack([column(k) for k in ("reg_alpha", "reg_lambda", "gamma", "min_child_weight")], 1)

    def _columns(self, tree: int) -> np.ndarray:
        """Columns of each model's tree: bool matrix (model, feature), drawn by the setting alone."""
        out = np.zeros((len(self.models), self.n_features), bool)
        for i, m in enumerate(self.models):
            k = max(1, int(self.n_features * m.setting["colsample_bytree"]))
            out[i, random.Random(f"{self.seed}|{tree}|{k}").sample(range(self.n_features), k)] = True
        return out

    def _trees(self, models, last: int | None) -> list[tuple]:
        """Features, bins and weights of the last trees of each model (None: all): a row per tree."""
        size, kinds = 2 ** (self.depth + 1) - 1, {"feature": np.int32, "bin": np.int32, "weight": float}
        own = lambda m: m.trees if last is None else m.trees[len(m.trees) - last:]
        return [tuple(np.array([getattr(t, k) for t in own(self.models[i])], kind).reshape(-1, size) for k, kind in kinds.items()) for i in models]

    def _histograms(self, block: np.ndarray, level: int, tree, columns, seed: int) -> DataFrame:
        """(model, node, sums): a task's sums of g and h by feature and bin, for a block of models at a level."""
        first, width = 2**level - 1, 2**level
        n_bins = max(len(e) for e in self.edges) + 1
        f_count, depth, scale, n_kept = self.n_features, self.depth, self.scale, len(self.kept)
        fresh, at = self._trees(block, self.fresh), np.searchsorted(self.kept, block)
        feature, cut, _ = (x[block] for x in tree)
        base, columns, shape = self.base[block], columns[block], (len(block), width + 1, f_count, n_bins)
        alike = {}  # models by the rows they see
        for i, m in enumerate(block.tolist()):
            alike.setdefault((float(self.share[m]), int(self.fold[m])), []).append(i)
        place = np.full(2 ** (self.depth + 1), width)  # rows of closed nodes are put last
        place[first:first + width] = np.arange(width)

        def add(batches):
            total = np.zeros((2, *shape), np.int64)
            for bins, label, folds, key, start in _rows(batches, f_count, n_kept, len(block)):
                for (share, fold), members in alike.items():
                    seen = np.flatnonzero((folds != fold) & _drawn(key, seed, share))
                    if not len(seen):
                        continue
                    own, y = [b.take(seen) for b in bins], label.take(seen)
                    slots = [b.astype(np.intp) for b in own]
                    for i in members:
                        margin = start[at[i]].take(seen) if n_kept else np.full(len(seen), base[i])
                        p = 1 / (1 + np.exp(-_add_trees(margin, own, fresh[i], depth)))
                        g, h = np.rint((p - y) * scale), np.rint(p * (1 - p) * scale)
                        node = place.take(_positions(own, feature[i].tolist(), cut[i].tolist(), level), mode="clip") * n_bins
                        for f in np.flatnonzero(columns[i]):
                            for k, x in enumerate((g, h)):
                                sums = np.bincount(slots[f] + node, x, (width + 1) * n_bins)
                                total[k, i, :, f] += sums.reshape(width + 1, n_bins).astype(np.int64)
            every = total[:, :, :width].transpose(1, 2, 0, 3, 4)
            m, n = np.nonzero(every[:, :, 1].any(axis=(2, 3)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(block[m].astype(np.int32)), pa.array((n + first).astype(np.int32)),
                 pa.array([every[i, j].tobytes() for i, j in zip(m, n)], pa.binary())], names=["model", "node", "sums"])

        return self.state.mapInArrow(add, "model int, node int, sums binary")

    def _best(self, histograms: DataFrame):
        """Per open node: its G and H, and its best split (``feature`` -1 if there is none)."""
        scale, shape, penalties = self.scale, (2, self.n_features, -1), self.penalties

        def choose(batches):
            sums = {}
            for batch in batches:
                for key, packed in zip(zip(*(batch.column(c).to_pylist() for c in ("model", "node"))), batch.column("sums").to_pylist()):
                    part = np.frombuffer(packed, np.int64).reshape(shape)
                    sums[key] = sums[key] + part if key in sums else part
            if not sums:
                return
            model, node = (np.array(x, np.int32) for x in zip(*sums))
            every = np.stack(list(sums.values()))
            below = np.cumsum(every, axis=3)
            whole = below[:, :, :, -1]
            most = whole[:, 1].argmax(axis=1)  # a drawn column; the others have no sums
            at = np.arange(len(model))
            total = (whole[at, :, most] / scale).T[:, :, None, None]
            left, right = below / scale, (whole[:, :, :, None] - below) / scale
            alpha, lambda_, gamma, least = (penalties[model, i][:, None, None] for i in range(4))

            def worth(g, h):
                top = np.maximum(np.abs(g) - alpha, 0) ** 2
                return np.divide(top, h + lambda_, out=np.zeros(np.broadcast(top, h).shape), where=h + lambda_ > 0)

            gain = worth(left[:, 0], left[:, 1]) + worth(right[:, 0], right[:, 1]) - worth(*total)
            lighter = np.minimum(left[:, 1], right[:, 1])
            fits = (lighter >= least) & (lighter > 0) & (gain > 1e-6) & (gain >= gamma)
            # Equal gains up to rounding: the first feature, then the least bin.
            place = np.where(fits, np.round(gain, 9), -1.0).reshape(len(model), -1).argmax(axis=1)
            f, b = np.divmod(place, every.shape[3])
            parts = [total[0].ravel(), total[1].ravel(), left[at, 0, f, b], left[at, 1, f, b], right[at, 0, f, b], right[at, 1, f, b]]
            yield pa.RecordBatch.from_arrays(
                [pa.array(model), pa.array(node), pa.array(np.where(fits[at, f, b], f, -1).astype(np.int32)), pa.array(b.astype(np.int32)),
                 *map(pa.array, parts)], names=["model", "node", "feature", "bin", "g", "h", "gl", "hl", "gr", "hr"])

        return histograms.repartition("model", "node").mapInArrow(
            choose, "model int, node int, feature int, bin int, g double, h double, gl double, hl double, gr double, hr double").collect()

    def add_tree(self, number: int) -> None:
        """Grow the next tree of every model that still has trees to grow."""
        active = np.array([i for i, m in enumerate(self.models) if number < m.setting["n_estimators"]])
        size, n = 2 ** (self.depth + 1) - 1, len(self.models)
        feature, cut, weight = np.full((n, size), -1, np.int32), np.zeros((n, size), np.int32), np.zeros((n, size))
        columns = self._columns(number)
        seed = random.Random(f"{self.seed}|{number}|rows").getrandbits(64)
        n_bins = max(len(e) for e in self.edges) + 1
        open_ = {(int(i), 0) for i in active}
        for level in range(self.depth):
            growing = np.array(sorted({m for m, _ in open_ if self.models[m].setting["max_depth"] > level}), np.int64)
            per_pass = max(1, HISTOGRAM_BYTES // (16 * 2**level * self.n_features * n_bins))
            now, open_ = open_, set()
            for i in range(0, len(growing), per_pass):
                block = growing[i:i + per_pass]
                for r in self._best(self._histograms(block, level, (feature, cut, weight), columns, seed)):
                    m, node = r["model"], r["node"]
                    if (m, node) not in now:
                        continue
                    if level == 0:
                        weight[m, 0] = self._weight(m, r["g"], r["h"])
                    if r["feature"] >= 0:
                        feature[m, node], cut[m, node] = r["feature"], r["bin"]
                        for child, g, h in ((2 * node + 1, r["gl"], r["hl"]), (2 * node + 2, r["gr"], r["hr"])):
                            weight[m, child] = self._weight(m, g, h)
                            open_.add((m, child))
            if not open_:
                break
        for i in active:
            self.models[i].trees.append(Tree(feature[i], cut[i], weight[i]))
        self.fresh += 1
        growing = np.array([i for i in active if number + 1 < self.models[i].setting["n_estimators"]], np.int64)
        if self.fresh >= LAND_EVERY and len(growing):
            self.land(growing)

    def _weight(self, m: int, g: float, h: float) -> float:
        s = self.models[m].setting
        bottom = h + s["reg_lambda"]
        return -math.copysign(max(abs(g) - s["reg_alpha"], 0.0), g) / bottom * self.rate[m] if bottom > 0 else 0.0

    def land(self, growing: np.ndarray | None = None) -> None:
        """Write the rows with the margins of the models that still grow (None: all kept) to the shared folder."""
        if growing is None:
            growing = self.kept if len(self.kept) else np.arange(len(self.models))
        f_count, n_kept, depth, n_models = self.n_features, len(self.kept), self.depth, len(self.models)
        fresh, at, base = self._trees(growing, self.fresh), np.searchsorted(self.kept, growing), self.base[growing]

        def update(batches):
            for batch in batches:
                parts = []
                for bins, label, _, _, start in _rows([batch], f_count, n_kept, n_models):
                    margins = (start[at[i]] if n_kept else np.full(len(label), base[i]) for i in range(len(at)))
                    after = np.stack([_add_trees(x, bins, fresh[i], depth) for i, x in enumerate(margins)], 1).astype("<f8")
                    parts += [r.tobytes() for r in after]
                yield batch.set_column(batch.schema.get_field_index("margins"), "margins", pa.array(parts, pa.binary()))

        self.state = _landed(self.state.mapInArrow(update, self.state.schema), "boost-state")
        self.fresh, self.kept = 0, growing

    def held_out(self) -> DataFrame:
        """(model, fold, label, score) of every row under the models that left its fold out."""
        f_count, n_kept, depth, n_models, base = self.n_features, len(self.kept), self.depth, len(self.models), self.base
        members = {k: np.flatnonzero(self.fold == k) for k in set(self.fold.tolist())}
        trees = self._trees(range(n_models), None)

        def emit(batches):
            for bins, label, folds, _, _ in _rows(batches, f_count, n_kept, n_models):
                for fold, models in members.items():
                    rows = np.flatnonzero(folds == fold)
                    if not len(rows):
                        continue
                    own = [b.take(rows) for b in bins]
                    margin = np.concatenate([_add_trees(np.full(len(rows), base[m]), own, trees[m], depth) for m in models])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.repeat(models, len(rows)).astype(np.int32)), pa.array(np.full(len(margin), fold, np.int32)),
                         pa.array(np.tile(label[rows], len(models))), pa.array(1 / (1 + np.exp(-margin)))], names=["model", "fold", "label", "score"])

        return self.state.mapInArrow(emit, "model int, fold int, label double, score double")


def _landed(df: DataFrame, name: str) -> DataFrame:
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def grow(rows: DataFrame, feature_cols: Sequence[str], label_col: str, settings: Sequence[Mapping], key_col: str,
         fold: str | None = None, folds: int = 0, seed: int = 88, max_bins: int = MAX_BINS) -> _Growth:
    """Fit every setting: on all rows, or with ``folds`` on the rows outside each fold (column ``fold``).
    The models stand setting by setting, folds inside.  Feature values must not be null.
    """
    settings = [{**DEFAULTS, **s} for s in settings]
    outs = list(range(folds)) if folds else [-1]
    in_fold = (F.col(fold) if fold else F.lit(-2)).cast("int")
    seen = {r["fold"]: (r["n"], r["pos"] or 0.0) for r in rows.groupBy(in_fold.alias("fold")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col(label_col).cast("double")).alias("pos")).collect()}  # a row per fold
    n_rows = sum(n for n, _ in seen.values())

    def base(out):
        """Log-odds of the label outside a fold, kept finite."""
        n, pos = (sum(v[i] for k, v in seen.items() if k != out) for i in (0, 1))
        p = min(max(pos / n if n else 0.5, 1e-6), 1 - 1e-6)
        return math.log(p / (1 - p))

    bases = {k: base(k) for k in outs}
    models = [Boosted(s, k, bases[k]) for s in settings for k in outs]
    edges = bin_edges(rows, feature_cols, max_bins)

    def prepare(batches):
        for batch in batches:
            x = np.stack([np.asarray(batch.column(f"x{i}")).astype(float) for i in range(len(edges))], 1)
            if np.isnan(x).any():
                raise ValueError("features must not be null")
            bins = np.stack([np.searchsorted(e, x[:, i], "left") for i, e in enumerate(edges)], 1).astype("<u2")
            yield pa.RecordBatch.from_arrays(
                [pa.array([b.tobytes() for b in bins], pa.binary()), *(batch.column(c) for c in ("label", "fold", "key")),
                 pa.array([b""] * batch.num_rows, pa.binary())], names=["bins", "label", "fold", "key", "margins"])

    source = rows.select(*[F.col(f"`{c}`").cast("double").alias(f"x{i}") for i, c in enumerate(feature_cols)],
                         F.col(label_col).cast("double").alias("label"), in_fold.alias("fold"), F.xxhash64(F.col(key_col)).alias("key"))
    # few small files would be read by few tasks: the rows are dealt over the cores
    files = max(math.ceil(n_rows / FILE_ROWS), min(rows.sparkSession.sparkContext.defaultParallelism, math.ceil(n_rows / 1024)), 1)
    state = _landed(source.repartition(files).mapInArrow(prepare, "bins binary, label double, fold int, key long, margins binary"), "boost-state")
    growth = _Growth(state, models, edges, n_rows, seed)
    for number in range(max(m.setting["n_estimators"] for m in models)):
        growth.add_tree(number)
    return growth


def as_spark_model(spark: SparkSession, model: Boosted, edges: Sequence[np.ndarray], features_col: str = "features"):
    """The trees as a ``GBTClassificationModel``: P(1) = 1 / (1 + exp(-2 * sum)), so all weights are halved."""
    from pyspark.ml.classification import GBTClassificationModel

    jvm = spark.sparkContext._jvm
    tree_ns, gateway = jvm.org.apache.spark.ml.tree, spark.sparkContext._gateway

    def stats(weight):
        values = gateway.new_array(jvm.double, 3)
        values[0], values[1], values[2] = 1.0, weight, weight * weight
        return jvm.org.apache.spark.mllib.tree.impurity.VarianceCalculator(values, 1)

    def node(t: Tree, i: int):
        w = float(t.weight[i])
        if t.feature[i] < 0:
            return tree_ns.LeafNode(w, 0.0, stats(w))
        f = int(t.feature[i])
        split = tree_ns.ContinuousSplit(f, float(edges[f][t.bin[i]]))
        return tree_ns.InternalNode(w, 0.0, 0.0, node(t, 2 * i + 1), node(t, 2 * i + 2), split, stats(w))

    base = Tree(np.array([-1]), np.array([0]), np.array([model.base]))
    every = [base, *model.trees]
    regressor = jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel
    trees, weights = gateway.new_array(regressor, len(every)), gateway.new_array(jvm.double, len(every))
    for i, t in enumerate(every):
        trees[i], weights[i] = regressor(f"boosted_{i}", node(t, 0), len(edges)), 0.5
    java = jvm.org.apache.spark.ml.classification.GBTClassificationModel("boosted_trees", trees, weights, len(edges), 2)
    out = GBTClassificationModel(java)
    out._resetUid(java.uid())
    return out.setFeaturesCol(features_col)


def fit(rows: DataFrame, feature_cols: Sequence[str], label_col: str, params: Mapping, key_col: str, seed: int = 88):
    """One setting on all rows, as a ``GBTClassificationModel`` over the assembled ``features``."""
    growth = grow(rows, feature_cols, label_col, [params], key_col, seed=seed)
    return as_spark_model(rows.sparkSession, growth.models[0], growth.edges)
