"""Imputing, scaling, one-hot coding and assembling mixed tables into vectors."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, PipelineModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexerModel, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col, is_floating, long_form, missing, present_number
from casefile.operators.dictionaries import MODEL_SLOTS, Classes, JoinedOneHot, classes_of, dictionary_of, dictionary_sizes, with_slot
from casefile.operators.quantiles import number_summaries, quantiles
from casefile.operators.schema import bool_to_int, constant_columns, drop_columns, low_cardinality, split_by_kind
from casefile.session import broadcast_if_small



def median_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing numbers become the exact column median; results are doubles."""
    medians = {c: q[0] for c, q in quantiles(df, list(columns), [0.5]).items()}
    filled = {c: F.coalesce(present_number(df, c), F.lit(m)) for c, m in medians.items()}
    return df.select(*[filled[c].alias(c) if c in filled else col(c) for c in df.columns])


def most_frequent(df: DataFrame, columns: Sequence[str]) -> dict[str, str | None]:
    """The most frequent present text of each column, the smallest one on ties.

    Values are counted over all tasks; only one row per column is gathered.
    """
    if not columns:
        return {}
    texts = df.select(*[col(c).cast("string").alias(c) for c in columns])
    counts = long_form(texts, columns).filter("value is not null").groupBy("column", "value").count()
    best = counts.groupBy("column").agg(F.min(F.struct(-F.col("count"), F.col("value").alias("value"))).alias("b"))
    found = {r["column"]: r["value"] for r in best.select("column", "b.value").collect()}
    return {c: found.get(c) for c in columns}


def mode_impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    modes = most_frequent(df, columns)
    return df.select(
        *[F.coalesce(col(c), F.lit(modes[c]).cast(df.schema[c].dataType)).alias(c) if c in modes else col(c) for c in df.columns]
    )


def standardize(df: DataFrame, columns: Sequence[str], with_mean: bool = True) -> DataFrame:
    """Divide by the population standard deviation (0 counts as 1), after centring
    if asked."""
    stats = []
    for i, c in enumerate(columns):
        x = present_number(df, c)
        stats += [F.avg(x).alias(f"m{i}"), F.stddev_pop(x).alias(f"s{i}")]
    row = df.agg(*stats).first()
    new = {}
    for i, c in enumerate(columns):
        centre = (row[f"m{i}"] or 0.0) if with_mean else 0.0
        new[c] = (present_number(df, c) - F.lit(centre)) / F.lit(row[f"s{i}"] or 1.0)
    return df.select(*[new[c].alias(c) if c in new else col(c) for c in df.columns])


def one_hot(df: DataFrame, columns: Sequence[str], in_model: int = MODEL_SLOTS) -> DataFrame:
    """Append `<column>_vec`: categories in sorted order, unknown or missing as zeros.

    Dictionaries of more than `in_model` values are joined as tables.
    """
    known = dictionary_of(df, columns)
    sizes = dictionary_sizes(known)
    narrow = [c for c in columns if sizes.get(c, 0) <= in_model]
    out = _short_one_hot(df, narrow, known, [f"{c}_vec" for c in narrow])[0] if narrow else df
    for c in columns:
        if c not in narrow:
            out = JoinedOneHot(None, 0, [c], known, sizes, f"{c}_vec").transform(out)
    return out


def _short_one_hot(df: DataFrame, columns: Sequence[str], known: DataFrame, outputs: Sequence[str], tag: str = "_idx") -> tuple[DataFrame, list]:
    """The coded table and the stages that code it, for dictionaries short enough to be held in a model."""
    names = {c: i for i, c in enumerate(columns)}
    labels: list[list[str]] = [[] for _ in columns]
    for r in known.filter(F.col("column").isin(list(columns))).orderBy("column", "slot").collect():
        labels[names[r["column"]]].append(r["value"])
    index = [f"{c}{tag}" for c in outputs]
    # one model for each column: joint ones want label lists of equal length
    indexers = [StringIndexerModel.from_labels(x or ["(none)"], inputCol=c, outputCol=i, handleInvalid="keep") for x, c, i in zip(labels, columns, index)]
    coded = PipelineModel(indexers).transform(df)
    # the slot dropped is the last one, which the indexer reserves for the unknown
    encoder = OneHotEncoder(inputCols=index, outputCols=list(outputs), dropLast=True).fit(coded)
    return encoder.transform(coded).drop(*index), [*indexers, encoder]


def target_classes(df: DataFrame, target: str) -> Classes:
    """Sorted distinct present target values."""
    return classes_of(df, target)


def encode_target(df: DataFrame, target: str, name: str = "label") -> tuple[DataFrame, Classes]:
    """Append the class number 0..k-1 of the target, in sorted order, as a double.

    Rows without target are left out. The classes are a table of any length; they are also the
    way back.
    """
    known = classes_of(df, target)
    table = broadcast_if_small(known.table.select(F.col("value").cast("string").alias("value"), F.col("slot").cast("double").alias("slot")))[0]
    return with_slot(df.filter(~missing(df, target)), target, table, name), known


class Preprocessor(Estimator):
    """Median / mode imputing, scaling and one-hot coding into one vector column.

    Fitting takes a few shared passes; the result is a plain pipeline of built-in
    stages.
    """

    numericCols = Param(Params._dummy(), "numericCols", "numeric inputs", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "text inputs", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "vector output", TypeConverters.toString)
    withMean = Param(Params._dummy(), "withMean", "centre the numbers", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, outputCol="features", withMean=True):
        super().__init__()
        # dictionaries of more values are joined as tables
        self.inModel = MODEL_SLOTS
        self._setDefault(outputCol="features", withMean=True, numericCols=[], categoricalCols=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, df: DataFrame) -> PipelineModel:
        numeric, categorical = self.getOrDefault("numericCols"), self.getOrDefault("categoricalCols")
        output = self.getOrDefault("outputCol")
        exprs, inputs = [], []
        summaries = number_summaries(df, numeric)
        for i, c in enumerate(numeric):
            found = summaries[c]
            mean = found.filled_mean if self.getOrDefault("withMean") else 0.0
            source = f"nanvl({_quoted(c)}, null)" if is_floating(df.schema[c].dataType) else _quoted(c)
            value = f"coalesce(cast({source} as double), {found.median or 0.0!r}D)"
            exprs.append(f"({value} - {mean or 0.0!r}D) / {found.filled_deviation or 1.0!r}D as {_quoted(_slot('num', i, c))}")
            inputs.append(_slot('num', i, c))
        stages, wide = [], []
        if categorical:
            # one count of all values gives the modes, the slots and their number
            known = dictionary_of(df, categorical)
            sizes = dictionary_sizes(known)
            best = known.groupBy("column").agg(F.min(F.struct(-F.col("n"), "value")).alias("b"))
            modes = {r["column"]: r["value"] for r in best.select("column", "b.value").collect()}
            texts = {c: _slot("cat", i, c) for i, c in enumerate(categorical)}
            for c, text in texts.items():
                fallback = modes.get(c, "").replace("\\", "\\\\").replace("'", "\\'")
                exprs.append(f"coalesce(cast({_quoted(c)} as string), '{fallback}') as {_quoted(text)}")
            wide = [c for c in categorical if sizes.get(c, 0) > self.inModel]
        if exprs:
            stages.append(SQLTransformer(statement=f"SELECT *, {', '.join(exprs)} FROM __THIS__"))
        prepared = stages[0].transform(df) if stages else df
        short = [c for c in categorical if c not in wide]
        if categorical:
            coded = known.withColumn("column", F.element_at(F.create_map(*[F.lit(v) for pair in texts.items() for v in pair]), F.col("column")))
        if short:
            hot = [_slot("hot", categorical.index(c), c) for c in short]
            stages += _short_one_hot(prepared, [texts[c] for c in short], coded, hot)[1]
            inputs += hot
        if wide:
            base = f"_{output}_short" if inputs else None
            if base:
                stages.append(VectorAssembler(inputCols=inputs, outputCol=base, handleInvalid="error"))
            width = len(numeric) + sum(max(1, sizes.get(c, 0)) for c in short)
            stages.append(JoinedOneHot(base, width, [texts[c] for c in wide], coded, {texts[c]: sizes[c] for c in wide}, output))
        else:
            stages.append(VectorAssembler(inputCols=inputs, outputCol=output, handleInvalid="error"))
        return PipelineModel(stages)


def _slot(kind: str, number: int, name: str) -> str:
    """A column name that the feature stages accept, whatever the original name holds."""
    return f"{kind}{number}_" + re.sub(r"[.`]", "_", name)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def build_preprocessor(df: DataFrame, exclude: Sequence[str] = (), with_mean: bool = True) -> Preprocessor:
    """The preprocessor for a table: constant columns out, booleans as numbers."""
    narrow = df.drop(*exclude)
    numeric, categorical = split_by_kind(narrow, bool_as_numeric=True)
    simple = {f.name for f in narrow.schema.fields if f.dataType.typeName() in _SIMPLE_TYPES or f.dataType.typeName().startswith("decimal")}
    constant = set(constant_columns(narrow.select(*[col(c) for c in narrow.columns if c in simple])))
    keep = [c for c in narrow.columns if c in simple and c not in constant]
    return Preprocessor(
        numericCols=[c for c in numeric if c in keep], categoricalCols=[c for c in categorical if c in keep], withMean=with_mean
    )


_SIMPLE_TYPES = {
    "byte", "short", "integer", "long", "float", "double", "decimal", "boolean",
    "string", "date", "timestamp", "timestamp_ntz",
}


def feature_names(vectors: DataFrame, column: str = "features") -> list[str]:
    """Names of the vector's slots, from the attribute metadata; vectors with joined dictionaries have numbers."""
    known = vectors.schema[column].metadata["ml_attr"]
    if "attrs" not in known:
        return [f"{column}_{i}" for i in range(known["num_attrs"])]
    groups = known["attrs"].values()
    slots = sorted((a for g in groups for a in g), key=lambda a: a["idx"])
    return [_plain_name(a["name"]) for a in slots]


def _plain_name(name: str) -> str:
    return re.sub(r"^(num|hot)\d+_", "", name)


def build_matrix(
    df: DataFrame, exclude: Sequence[str] | None = None, max_categories: int = 30, output: str = "features", key: str | None = None
) -> DataFrame:
    """Append the vector used for clustering: numbers divided by their standard
    deviation, text columns with few values one-hot coded. The key is no feature."""
    work = bool_to_int(drop_columns(df, exclude))
    numeric, other = split_by_kind(work.drop(key) if key else work)
    usable = set(low_cardinality(work, [c for c in other if work.schema[c].dataType.typeName() in _SIMPLE_TYPES], max_categories))
    simple = [c for c in work.columns if c in usable or c in set(numeric)]
    constant = set(constant_columns(work.select(*[col(c) for c in simple])))
    estimator = Preprocessor(
        numericCols=[c for c in numeric if c not in constant],
        categoricalCols=[c for c in other if c in usable and c not in constant],
        outputCol=output,
        withMean=False,
    )
    return estimator.fit(work).transform(work)
