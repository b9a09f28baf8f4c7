"""Why a model predicts what it does: importances, learning curve, attributions."""

from __future__ import annotations

import math
import random
import re
from collections.abc import Iterator, Sequence
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.ml.feature import OneHotEncoderModel, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casefile.functions.values import col
from casefile.operators.features import Preprocessor, feature_names
from casefile.operators.logistic import Fit, shared_rows
from casefile.operators.models import ModelSpec
from casefile.operators.ranking import order_hash
from casefile.operators.sampling import assign_folds
from casefile.operators.training import metric_value
from casefile.session import durable, scratch_folder

BLOCK_ROWS = 5_000
# The deepest trees whose decisions fit into one word.
CODED_DEPTH = 6


def model_importance(model: PipelineModel, df: DataFrame) -> DataFrame:
    """(feature, importance) of the last stage: tree importances, or the mean absolute
    coefficient over classes. Empty for other models."""
    last = model.stages[-1]
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficientMatrix"):
        values = np.abs(last.coefficientMatrix.toArray()).mean(axis=0)
    elif hasattr(last, "models") and all(hasattr(m, "featureImportances") for m in last.models):
        values = np.mean([m.featureImportances.toArray() for m in last.models], axis=0)
    else:
        values = []
    names = feature_names(model.transform(df.limit(0))) if len(values) else []
    rows = [(n, float(v)) for n, v in zip(names, values)]
    return df.sparkSession.createDataFrame(rows, "feature string, importance double")


def _with_partner(df: DataFrame, key, copies: int, seed: int, n_rows: int, block_rows: int, keep: Sequence[str] | None = None) -> DataFrame:
    """Every row `copies` times (`_copy`), each next to another random row (`_other`).

    Rows fall into hash blocks of bounded size; inside a block each row takes the
    next one in hash order, the last one takes the first. Every row is a partner
    exactly once per copy, so `_other` is a permutation of the table. Rows hold the columns `keep`
    only, and the order travels as sixteen bytes, since all copies of all rows are exchanged.
    """
    blocks = max(1, math.ceil(n_rows / block_rows))
    rows = df.withColumn("_id", order_hash(df, key, seed)).withColumn("_row", F.struct(*[col(c) for c in keep or df.columns]))
    rows = rows.select("_id", "_row", F.explode(F.sequence(F.lit(1), F.lit(copies))).alias("_copy"))
    rows = rows.withColumn("_order", F.md5(F.concat_ws(":", "_copy", "_id")))
    rows = rows.withColumn("_block", F.pmod(F.xxhash64("_order"), F.lit(blocks)))
    # equal orders have equal ids, so the id need not travel
    rows = rows.select("_row", "_copy", "_block", F.unhex("_order").alias("_order"))
    block = Window.partitionBy("_copy", "_block").orderBy("_order")
    whole = block.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    other = F.coalesce(F.lead("_row").over(block), F.first("_row").over(whole))
    return rows.withColumn("_other", other).drop("_order", "_block")


def permutation_importance(
    model: PipelineModel, df: DataFrame, features: Sequence[str], label: str = "label", repeats: int = 5,
    key=None, seed: int = 42, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(feature, importance, sd): mean drop in accuracy when one column is shuffled.

    All features of all repeats are scored in one job; the rows as they are, once.
    """
    needed = df.select(*[col(c) for c in dict.fromkeys([*features, label, *([key] if isinstance(key, str) else [])])])
    n = needed.count()
    kept = list(dict.fromkeys([*features, label]))
    partner = _with_partner(needed, key, repeats, seed, n, block_rows, kept)

    def shuffled(feature: str) -> F.Column:
        values = [(F.col("_other") if c == feature else F.col("_row"))[c].alias(c) for c in kept]
        return F.struct(F.lit(feature).alias("_feature"), F.struct(*values).alias("_v"))

    hit = F.avg((F.col("prediction") == col(label)).cast("double"))
    # every copy holds the same rows, so their own accuracy is the same in all
    base = model.transform(needed.select(*[col(c) for c in kept])).agg(hit).first()[0]
    rows = partner.select("_copy", F.inline(F.array(*[shuffled(f) for f in features]))).select("_copy", "_feature", "_v.*")
    scores = model.transform(rows).groupBy("_copy", "_feature").agg(hit.alias("acc"))
    drops = scores.withColumn("drop", F.lit(base).cast("double") - F.col("acc"))
    return drops.groupBy(F.col("_feature").alias("feature")).agg(
        F.avg("drop").alias("importance"), F.stddev_pop("drop").alias("sd")
    )


def top_features(importances: DataFrame, k: int = 20) -> DataFrame:
    """The k most important features of every method (column `method`, if present)."""
    table = importances if "method" in importances.columns else importances.withColumn("method", F.lit("model_importance"))
    place = F.row_number().over(Window.partitionBy("method").orderBy(F.desc("importance"), "feature"))
    return table.withColumn("place", place).filter(F.col("place") <= k).select("method", "feature", "importance", "place")


def learning_curve(
    df: DataFrame, preprocessor: Preprocessor, spec: ModelSpec, params: dict, scoring: str = "accuracy",
    sizes: Sequence[float] = tuple(np.linspace(0.1, 1.0, 10)), folds: int = 5, key=None, seed: int = 42, parallelism: int = 4,
) -> DataFrame:
    """(size, train_mean, train_sd, valid_mean, valid_sd) over growing, nested parts of
    the training folds. Needs columns label and weight. Logistic regressions of all folds and sizes share their scans."""
    rows = assign_folds(df, "label", folds, key, seed, "_fold")
    word = F.conv(F.substring(order_hash(df, key, seed + 1), 1, 12), 16, 10).cast("double")
    rows = durable(rows.withColumn("_share", word / float(16**12)))
    schema = "size double, train double, valid double"
    # a row is in the parts of the sizes above its share
    steps = sorted({float(s) for s in sizes})
    step = sum(((F.col("_share") >= s).cast("int") for s in steps), F.lit(0))
    shared = shared_rows(rows, preprocessor, spec, F.col("_fold") * (len(steps) + 1) + step, folds * (len(steps) + 1), scoring)
    if shared is not None:
        with shared:
            fold_of, step_of = np.divmod(np.arange(shared.cells), len(steps) + 1)
            wanted = [(fold, float(size)) for size in sizes for fold in range(folds)]
            fits = [Fit((fold_of != fold) & (step_of <= steps.index(size)), params.get("C", 1.0)) for fold, size in wanted]
            shared.fit(fits, parallelism)
            judged = [(f, part) for f, (fold, _) in zip(fits, wanted, strict=True) for part in (f.cells, fold_of == fold)]
            found = shared.scores(judged, scoring)
        scores = [(size, *found[2 * i : 2 * i + 2]) for i, (_, size) in enumerate(wanted)]
        return _curve(df.sparkSession.createDataFrame(scores, schema))

    def one(task: tuple[int, float]) -> tuple[float, float, float]:
        fold, size = task
        part = rows.filter((F.col("_fold") != fold) & (F.col("_share") < size))
        prepared = preprocessor.fit(part)
        train = prepared.transform(part).persist()
        fitted = spec.on(train).build(params).fit(train)
        train_score = metric_value(fitted.transform(train), scoring)
        valid = prepared.transform(rows.filter(F.col("_fold") == fold))
        train.unpersist()
        return float(size), float(train_score), float(metric_value(fitted.transform(valid), scoring))

    tasks = [(fold, float(size)) for size in sizes for fold in range(folds)]
    with ThreadPool(parallelism) as pool:
        scores = pool.map(inheritable_thread_target(df.sparkSession)(one), tasks)
    return _curve(df.sparkSession.createDataFrame(scores, schema))


def _curve(scores: DataFrame) -> DataFrame:
    return scores.groupBy("size").agg(
        F.avg("train").alias("train_mean"), F.stddev_pop("train").alias("train_sd"),
        F.avg("valid").alias("valid_mean"), F.stddev_pop("valid").alias("valid_sd"),
    ).orderBy("size")


def linear_attributions(model: PipelineModel, df: DataFrame, row_key: str) -> DataFrame:
    """(row_key, feature, attribution) of a two-class linear model, exact:
    coefficient x (value - mean). The parts of a row add up to its margin less the
    mean margin."""
    weights = model.stages[-1].coefficientMatrix.toArray()[-1]
    rows = PipelineModel(model.stages[:-1]).transform(df)
    mean = rows.select(Summarizer.mean(F.col("features"))).first()[0].toArray()
    names = feature_names(rows)
    slots = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(float(w)).alias("w"), F.lit(float(m)).alias("m")) for n, w, m in zip(names, weights, mean)])
    parts = F.zip_with(vector_to_array("features"), slots, lambda x, s: F.struct(s["feature"].alias("feature"), (s["w"] * (x - s["m"])).alias("attribution")))
    return rows.select(col(row_key), F.inline(parts))


class CodedForest:
    """A random forest whose trees are tables: a row is one word for each tree, with a bit for each of its decisions.

    A decision looks at one slot and a slot at one input column, so words of two rows mix by bits as the rows mix by columns.
    Trees are numbered like a heap, as deep as the deepest; what lies below an early leaf has its share.
    """

    def __init__(self, column: str, depth: int, splits: list[dict], shares: np.ndarray, owner: list[str]):
        self.column, self.depth, self.splits, self.shares, self.owner = column, depth, splits, shares, owner
        self.word = np.uint32 if depth < CODED_DEPTH else np.uint64

    @classmethod
    def of(cls, model: PipelineModel, df: DataFrame, features: Sequence[str], class_index: int) -> CodedForest | None:
        """The last stage of `model`, or nothing if it is no forest of shallow trees behind the stages of `Preprocessor`."""
        *before, forest = model.stages
        kinds = (SQLTransformer, StringIndexerModel, OneHotEncoderModel, VectorAssembler)
        if not isinstance(forest, RandomForestClassificationModel) or not all(isinstance(s, kinds) for s in before):
            return None
        depth = max(t.depth for t in forest.trees)
        owner = _owners(PipelineModel(before).transform(df.limit(0)), forest.getFeaturesCol(), before[-1], features) if before else None
        if owner is None or depth > CODED_DEPTH or not 0 <= class_index < forest.numClasses:
            return None
        path = scratch_folder(df.sparkSession)
        forest.write().save(path)
        trees: list[dict] = [{} for _ in forest.trees]
        # 127 short rows a tree at most
        for r in df.sparkSession.read.parquet(f"{path}/data").select("treeID", "nodeData.*").collect():
            trees[r["treeID"]][r["id"]] = r
        shares, splits = np.zeros((len(trees), 2**depth)), []
        for tree, share in zip(trees, shares, strict=True):
            decisions, open_ = {}, [(0, 0, 0)]
            while open_:
                node, place, level = open_.pop()
                r = tree[node]
                if r["leftChild"] < 0:
                    stats = np.array(r["impurityStats"])
                    if not stats.sum():
                        return None
                    wide = 2 ** (depth - level)
                    first = (place + 1) * wide - 2**depth
                    share[first : first + wide] = stats[class_index] / stats.sum()
                    continue
                decisions[place] = r["split"]
                open_ += [(r["leftChild"], 2 * place + 1, level + 1), (r["rightChild"], 2 * place + 2, level + 1)]
            splits.append({p: (d["featureIndex"], d["leftCategoriesOrThreshold"], d["numCategories"] >= 0) for p, d in decisions.items()})
        return cls(forest.getFeaturesCol(), depth, splits, shares, owner)

    def code(self, vectors: F.Column) -> F.Column:
        splits, word = self.splits, self.word

        @F.arrow_udf("binary")
        def codes(parts: pa.Array) -> pa.Array:
            x = parts.flatten().to_numpy(zero_copy_only=False).reshape(len(parts), -1).T
            out = np.zeros((len(parts), len(splits)), word)
            for tree, decisions in enumerate(splits):
                for place, (slot, left, listed) in decisions.items():
                    taken = np.isin(x[slot], left) if listed else x[slot] <= left[0]
                    out[:, tree] |= taken.astype(word) << word(place)
            offsets = np.arange(len(parts) + 1, dtype=np.int32) * (len(splits) * out.itemsize)
            return pa.BinaryArray.from_buffers(pa.binary(), len(parts), [None, pa.py_buffer(offsets), pa.py_buffer(out)])

        return codes(vector_to_array(vectors))

    def predict(self, words: np.ndarray) -> np.ndarray:
        """The probability of the class for rows of words."""
        at, one, two = np.zeros_like(words), self.word(1), self.word(2)
        for _ in range(self.depth):
            left = (words >> at) & one
            at = at * two + two - left
        at += (np.arange(len(self.splits)) * 2**self.depth - (2**self.depth - 1)).astype(self.word)
        return self.shares.ravel()[at].sum(axis=1) / len(self.splits)

    def changes(self, partner: DataFrame, features: Sequence[str], paths: list[list[str]]) -> DataFrame:
        """(_key, parts): for every row and order, by how much each feature moves the probability on the way from the other row."""
        place = {f: i for i, f in enumerate(features)}
        trees, word = len(self.splits), self.word
        masks = {}
        for f in features:
            own = [sum(1 << p for p, (slot, _, _) in decisions.items() if self.owner[slot] == f) for decisions in self.splits]
            masks[f] = np.array(own, word)

        def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                # a word of each tree, row by row
                own, other = (np.frombuffer(b"".join(batch.column(i).to_pylist()), word).reshape(-1, trees) for i in (2, 3))
                copy = batch.column(1).to_numpy()
                parts = np.zeros((len(copy), len(features)))
                for number in np.unique(copy):
                    rows = np.flatnonzero(copy == number)
                    mixed, mine = other[rows], own[rows]
                    last = self.predict(mixed)
                    for f in paths[number - 1]:
                        if masks[f].any():
                            mixed = (mine & masks[f]) | (mixed & ~masks[f])
                            now = self.predict(mixed)
                            parts[rows, place[f]] = now - last
                            last = now
                offsets = np.arange(len(copy) + 1, dtype=np.int32) * len(features)
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, parts.ravel())], names=["_key", "parts"])

        rows = partner.select(F.col("_row._key").alias("_key"), "_copy", F.col("_row._code").alias("own"), F.col("_other._code").alias("other"))
        return rows.mapInArrow(moved, T.StructType([rows.schema["_key"], T.StructField("parts", T.ArrayType(T.DoubleType()))]))


def _owners(rows: DataFrame, column: str, assembler, features: Sequence[str]) -> list[str] | None:
    """The feature that each slot of `Preprocessor`'s vectors comes from, or nothing if that is not known of all."""
    known = rows.schema[column].metadata.get("ml_attr", {})
    slots = sorted((a for g in known.get("attrs", {}).values() for a in g), key=lambda a: a["idx"])
    if not isinstance(assembler, VectorAssembler) or not slots or len(slots) != known.get("num_attrs"):
        return None
    # kind and number, which no two inputs share, stand before the name
    named = {re.match(r"(num|hot)\d+_", c).group(): c for c in assembler.getInputCols() if re.match(r"(num|hot)\d+_", c)}
    owner = []
    for slot in slots:
        kind = re.match(r"(num|hot)\d+_", slot.get("name", ""))
        source = named.get(kind.group(), "")[kind.end() :] if kind else ""
        fitting = [f for f in features if re.sub(r"[.`]", "_", f) == source]
        if len(fitting) != 1:
            return None
        owner.append(fitting[0])
    return owner


def sampled_attributions(
    model: PipelineModel, df: DataFrame, features: Sequence[str], row_key: str, orders: int = 8, class_index: int = 1,
    seed: int = 42, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(row_key, feature, attribution) of any model by sampled Shapley values
    (Strumbelj and Kononenko, 2014).

    For each of several random feature orders a row turns, feature by feature, into
    another random row; the changes in the class probability are its parts. They add
    up to the prediction less the mean prediction of the partners. Forests of shallow trees
    prepare a row once and carry its decisions; other models predict every mixed row.
    """
    rng = random.Random(seed)
    paths = []
    for _ in range(orders):
        order = list(features)
        rng.shuffle(order)
        paths.append(order)
    needed = df.select(col(row_key), *[col(f) for f in features])
    coded = CodedForest.of(model, needed, features, class_index)
    if coded is not None:
        rows = PipelineModel(model.stages[:-1]).transform(needed).select(col(row_key).alias("_key"), coded.code(F.col(coded.column)).alias("_code"))
        partner = _with_partner(rows, "_key", orders, seed, needed.count(), block_rows)
        parts = coded.changes(partner, features, paths)
        sums = parts.groupBy("_key").agg(*[F.sum(F.get("parts", i)).alias(f"s{i}") for i in range(len(features))])
        found = F.array(*[F.struct(F.lit(f).alias("feature"), (F.col(f"s{i}") / orders).alias("attribution")) for i, f in enumerate(features)])
        return sums.select(F.col("_key").alias(row_key), F.inline(found))
    partner = _with_partner(needed, row_key, orders, seed, needed.count(), block_rows)

    def hybrid(path: list[str], k: int) -> F.Column:
        taken = set(path[:k])
        values = [(F.col("_row") if f in taken else F.col("_other"))[f].alias(f) for f in features]
        gained, lost = (path[k - 1] if k else None), (path[k] if k < len(path) else None)
        return F.struct(F.lit(gained).cast("string").alias("_gained"), F.lit(lost).cast("string").alias("_lost"), F.struct(*values).alias("_v"))

    chosen = None
    for i, path in enumerate(paths):
        steps = F.array(*[hybrid(path, k) for k in range(len(path) + 1)])
        chosen = F.when(F.col("_copy") == i + 1, steps) if chosen is None else chosen.when(F.col("_copy") == i + 1, steps)
    rows = partner.select(F.col("_row")[row_key].alias("_key"), F.inline(chosen)).select("_key", "_gained", "_lost", "_v.*")
    scored = model.transform(rows).select("_key", "_gained", "_lost", F.get(vector_to_array("probability"), class_index).alias("p"))
    changes = F.array(
        F.struct(F.col("_gained").alias("feature"), F.col("p").alias("d")),
        F.struct(F.col("_lost").alias("feature"), (-F.col("p")).alias("d")),
    )
    parts = scored.select("_key", F.inline(changes)).filter("feature is not null")
    return parts.groupBy(F.col("_key").alias(row_key), "feature").agg((F.sum("d") / orders).alias("attribution"))
