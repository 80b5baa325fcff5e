"""Boosted-tree forecasts with Spark ML.

A text column becomes a nominal input: its most frequent categories have codes, all others share the
unknown code, and trees split on sets of codes. A column with more categories than codes is also
described by smoothed target means, so the rare ones are not lost. Codes and means are tables,
fitted by aggregation and applied by joins: no list of categories passes through the driver.

Trees are trained without the validation rows. Every prefix of the trees is then measured on these in
one aggregation, and the number of rounds is where the absolute error stops falling for as long as
the patience lasts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import NumericType, StringType

from paxflow.config import Roles
from paxflow.functions.numbers import whole_count
from paxflow.plans.stage import staged
from paxflow.sources import store

# Below every count, ratio and sine, so a tree can set missing values apart.
MISSING = -1.0e6


#: Parts of the training rows; a part is described by the means of the others.
FOLDS = 5

#: Rows of a partition that trees are trained on. Spark ML keeps a partition as objects, some 450 bytes
#: a row, and a task reads one whole in every level of every round.
TREE_ROWS = 200_000


@dataclass(frozen=True)
class Boosting:
    """Settings of the trees. One boosting round is a chain of Spark jobs, so rounds are few and
    the step is large; 8 levels give about 255 leaves. ``patience`` is the number of rounds without
    a smaller validation error after which no more count. A text has ``max_bins`` codes, the
    unknown one among them."""

    rounds: int = 50
    step: float = 0.1
    depth: int = 8
    min_rows: int = 5
    feature_share: str = "0.8"
    seed: int = 42
    patience: int = 10
    max_bins: int = 64
    smoothing: float = 20.0


@dataclass(frozen=True)
class Forecaster:
    """Trees, how many of them count, their inputs, and the tables that describe texts.

    ``means`` is (source, category, mean); the row with an empty source holds the overall mean, for
    categories unseen in training. ``index`` is (source, category, rows, code). ``meant`` names the
    texts that have a mean beside their code. ``errors`` is (round, mae) over the validation rows.
    """

    trees: GBTRegressionModel
    rounds: int
    means: DataFrame
    index: DataFrame
    numeric: tuple[str, ...]
    text: tuple[str, ...]
    meant: tuple[str, ...]
    codes: int
    errors: DataFrame | None = None

    @property
    def inputs(self) -> list[str]:
        """Numbers, codes of texts, then means of texts, as the trees number them."""
        return [*self.numeric, *self.text, *(f"{c}_mean" for c in self.meant)]

    def describe(self, df: DataFrame) -> DataFrame:
        return with_inputs(
            df, self.means, self.index, list(self.numeric), list(self.text), list(self.meant), self.codes
        )

    def save(self, path: str) -> store.Version:
        """Publishes a version of the store at ``path``: whole, or not there for :meth:`load`."""
        session = self.means.sparkSession
        kinds = [("number", c) for c in self.numeric] + [("text", c) for c in self.text]
        kinds += [("mean", c) for c in self.meant]
        rows = [(i, kind, c, self.rounds, self.codes) for i, (kind, c) in enumerate(kinds)]
        inputs = session.createDataFrame(rows, "place INT, kind STRING, name STRING, rounds INT, codes INT")

        def write(folder: str) -> None:
            inputs.coalesce(1).write.parquet(f"{folder}/inputs")
            self.means.write.parquet(f"{folder}/means")
            self.index.write.parquet(f"{folder}/index")
            if self.errors is not None:
                self.errors.write.parquet(f"{folder}/errors")
            self.trees.write().overwrite().save(f"{folder}/trees")

        return store.publish(session, path, write)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Forecaster | None":
        """The forecaster published last at ``path``, or None where there is none."""
        version = store.latest(spark, path)
        if version is None:
            return None
        folder = version.folder
        listed = spark.read.parquet(f"{folder}/inputs").orderBy("place").collect()  # a row per input
        named = {k: tuple(r.name for r in listed if r.kind == k) for k in ("number", "text", "mean")}
        return cls(
            GBTRegressionModel.load(f"{folder}/trees"),
            listed[0].rounds,
            spark.read.parquet(f"{folder}/means"),
            spark.read.parquet(f"{folder}/index"),
            named["number"],
            named["text"],
            named["mean"],
            listed[0].codes,
            store.stored(spark, f"{folder}/errors"),
        )


def feature_columns(df: DataFrame, leave_out: list[str]) -> tuple[list[str], list[str]]:
    """(numeric, text) columns a model may use. Times are left out: date features stand for them."""
    kinds = [(f.name, f.dataType) for f in df.schema.fields if f.name not in leave_out]
    return (
        [name for name, kind in kinds if isinstance(kind, NumericType)],
        [name for name, kind in kinds if isinstance(kind, StringType)],
    )


def _overall(train: DataFrame, target: str) -> float:
    found = train.select(F.avg(F.col(target).cast("double"))).first()[0]
    if found is None:
        raise ValueError(f"no training row has a {target}")
    return found


def category_counts(train: DataFrame, text: list[str]) -> DataFrame:
    """(source, category, rows) of every category of the text columns; missing texts are not counted."""
    places = [F.struct(F.lit(c).alias("source"), F.col(c).alias("category")) for c in text]
    if not text:
        return train.sparkSession.createDataFrame([], "source STRING, category STRING, rows LONG")
    listed = train.select(F.inline(F.array(*places))).where(F.col("category").isNotNull())
    return listed.groupBy("source", "category").agg(F.count("*").alias("rows"))


def category_index(counts: DataFrame, codes: int) -> DataFrame:
    """(source, category, rows, code): codes from 1 by falling frequency, then by name; below ``codes``.

    Code 0 is the unknown one: missing, unseen, or beyond the last code. Only the rows that keep a
    code are ranked across the cluster; Spark cuts each part to those first.
    """
    order = Window.partitionBy("source").orderBy(F.desc("rows"), "category")
    return counts.withColumn("code", F.row_number().over(order)).where(F.col("code") < codes)


def target_means(
    train: DataFrame, text: list[str], target: str, smoothing: float = 20.0
) -> DataFrame:
    """(source, category, mean): each category's mean, drawn to the overall mean where rows are few."""
    y = F.col(target).cast("double")
    overall = _overall(train, target)
    per_category = (
        train.select(
            y.alias("_y"),
            F.inline(
                F.array(
                    F.struct(F.lit("").alias("source"), F.lit("").alias("category")),
                    *[
                        F.struct(
                            F.lit(c).alias("source"), F.coalesce(c, F.lit("")).alias("category")
                        )
                        for c in text
                    ],
                )
            ),
        )
        .groupBy("source", "category")
        .agg(F.sum("_y").alias("_sum"), F.count("_y").alias("_n"))
    )
    return per_category.select(
        "source",
        "category",
        (
            (F.col("_sum") + F.lit(smoothing) * F.lit(overall))
            / (F.col("_n") + F.lit(smoothing))
        ).alias("mean"),
    )


def held_out_means(
    train: DataFrame, text: list[str], target: str, row_id: str, smoothing: float = 20.0
) -> DataFrame:
    """(source, category, fold, mean): each category's mean over the rows of all other folds.

    A row that is trained on must not be described by its own target. Its fold is a hash of its id.
    """
    y = F.col(target).cast("double")
    overall = _overall(train, target)
    places = [F.struct(F.lit(c).alias("source"), F.coalesce(c, F.lit("")).alias("category")) for c in text]
    if not text:
        places = [F.struct(F.lit("").alias("source"), F.lit("").alias("category"))]
    folds = (
        train.select(y.alias("_y"), fold_of(row_id).alias("fold"), F.inline(F.array(*places)))
        .groupBy("source", "category", "fold")
        .agg(F.sum("_y").alias("_sum"), F.count("_y").alias("_n"))
    )
    all_folds = folds.groupBy("source", "category").agg(
        F.sum("_sum").alias("_sums"), F.sum("_n").alias("_ns")
    )
    others = (F.col("_sums") - F.col("_sum"), F.col("_ns") - F.col("_n"))
    mean = (others[0] + F.lit(smoothing * overall)) / (others[1] + F.lit(smoothing))
    return folds.join(all_folds, ["source", "category"]).select(
        "source", "category", "fold", mean.alias("mean")
    )


def fold_of(row_id: str) -> Column:
    return F.pmod(F.xxhash64(row_id), F.lit(FOLDS)).cast("int")


def with_inputs(
    df: DataFrame,
    means: DataFrame,
    index: DataFrame,
    numeric: list[str],
    text: list[str],
    meant: list[str],
    codes: int,
    held_out: DataFrame | None = None,
    row_id: str | None = None,
) -> DataFrame:
    """Adds ``features``: numbers with gaps marked, texts as nominal codes, those in ``meant`` as means
    too; with ``held_out`` as the means of the row's fold.

    Each text is looked up by equi joins. An index has fewer than ``codes`` rows a text and is
    broadcast; means have a row a category, and Spark broadcasts those only if they are small.
    """
    overall = means.where(F.col("source") == "").select("mean").first()[0]
    out = df
    for name in text:
        lookup = index.where(F.col("source") == name).select(
            F.col("category").alias("_category"), F.col("code").alias(f"_code_{name}")
        )
        out = out.join(F.broadcast(lookup), F.col(name) == F.col("_category"), "left").drop("_category")
    for name in meant:
        source = means if held_out is None else held_out
        columns = [F.col("category").alias("_category"), F.col("mean").alias(f"_mean_{name}")]
        match = F.coalesce(name, F.lit("")) == F.col("_category")
        if held_out is not None:
            columns.append(F.col("fold").alias("_fold"))
            match = match & (fold_of(row_id) == F.col("_fold"))
        lookup = source.where(F.col("source") == name).select(*columns)
        out = out.join(lookup, match, "left").drop("_category", "_fold")
    nominal = {"ml_attr": {"type": "nominal", "num_vals": codes}}
    ready = out.select(
        *df.columns,
        *[F.coalesce(F.col(c).cast("double"), F.lit(MISSING)).alias(f"_in_{c}") for c in numeric],
        *[
            F.coalesce(f"_code_{c}", F.lit(0)).cast("double").alias(f"_in_{c}", metadata=nominal)
            for c in text
        ],
        *[F.coalesce(f"_mean_{c}", F.lit(overall)).alias(f"_in_{c}_mean") for c in meant],
    )
    inputs = [f"_in_{c}" for c in (*numeric, *text, *(f"{c}_mean" for c in meant))]
    assembled = VectorAssembler(inputCols=inputs, outputCol="features").transform(ready)
    return assembled.drop(*inputs)


def prefix_sums(trees: GBTRegressionModel, df: DataFrame, rounds: int) -> DataFrame:
    """Adds ``by_round``: what the first 1, 2, ... ``rounds`` trees predict together."""
    out, names = df, []
    for number, (tree, weight) in enumerate(zip(trees.trees[:rounds], trees.treeWeights)):
        name = f"_tree_{number}"
        out = tree.copy().setFeaturesCol("features").setPredictionCol(name).transform(out)
        names.append(F.lit(weight) * F.col(name))
    start = F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("path"))

    def step(done: Column, own: Column) -> Column:
        now = done["sum"] + own
        return F.struct(now.alias("sum"), F.concat(done["path"], F.array(now)).alias("path"))

    path = F.aggregate(F.array(*names), start, step, lambda done: done["path"])
    return out.select(*[c for c in df.columns], path.alias("by_round"))


def round_errors(trees: GBTRegressionModel, rows: DataFrame) -> DataFrame:
    """(round, mae) of every prefix of the trees over ``rows`` with ``features`` and ``label``, in one
    aggregation: each row carries its absolute errors as one array, summed up before the shuffle."""
    scored = prefix_sums(trees, rows, len(trees.trees))
    errors = F.transform("by_round", lambda p: F.abs(F.col("label") - p))
    return (
        scored.select(F.posexplode(errors).alias("place", "error"))
        .groupBy((F.col("place") + 1).alias("round"))
        .agg(F.avg("error").alias("mae"))
    )


def stopping(errors: DataFrame, patience: int, by: list[str] = (), error: str = "mae") -> DataFrame:
    """``errors`` with ``best_round`` so far, ``stopped``, and the ``chosen`` round.

    Rounds run until none of the last ``patience`` has a smaller error than the best one before;
    chosen is the best round up to there, the first of equal ones. A row a round, so the window of
    one curve is small.
    """
    curve = Window.partitionBy(*by).orderBy("round")
    so_far = curve.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = curve.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    record = F.col(error) < F.coalesce(F.min(error).over(before), F.lit(float("inf")))
    found = errors.withColumn("_record", record)
    found = found.withColumn("best_round", F.max(F.when(F.col("_record"), F.col("round"))).over(so_far))
    over = F.col("round") - F.col("best_round") >= patience
    found = found.withColumn("_stop", F.min(F.when(over, F.col("round"))).over(whole))
    inside = F.col("_stop").isNull() | (F.col("round") <= F.col("_stop"))
    chosen = F.max(F.when(inside, F.col("best_round"))).over(whole)
    stopped = F.coalesce(F.col("round") >= F.col("_stop"), F.lit(False))
    return found.withColumns({"chosen": chosen, "stopped": stopped}).drop("_record", "_stop")


def even_parts(rows: DataFrame, order: list[str]) -> DataFrame:
    """Stored rows in partitions of about ``TREE_ROWS`` rows, whatever the files they come from.

    A file's row group is one partition, and small ones are read together, so partitions else grow
    with the input. The order in a partition is fixed, as Spark ML draws its candidate splits by it.
    """
    parts = -(-rows.count() // TREE_ROWS)
    return rows.repartition(parts).sortWithinPartitions(*order) if parts > 1 else rows


def fit(
    train: DataFrame,
    valid: DataFrame | None,
    target: str,
    settings: Boosting = Boosting(),
    roles: Roles = Roles(),
) -> Forecaster:
    """Train on ``train``; the rows of ``valid`` choose how many rounds count."""
    numeric, text = feature_columns(train, [roles.row_id, target])
    known = train.where(F.col(target).isNotNull())
    # Staged: every boosting round reads these again.
    means = staged(target_means(known, text, target, settings.smoothing), "target-means")
    counts = staged(category_counts(known, text), "categories")
    index = staged(category_index(counts, settings.max_bins), "category-index")
    kinds = counts.groupBy("source").agg(F.count("*").alias("n")).collect()  # one row a text
    meant = [c for c in text if any(r.source == c and r.n >= settings.max_bins for r in kinds)]
    others = staged(
        held_out_means(known, meant, target, roles.row_id, settings.smoothing), "held-out-means"
    )
    label = F.col(target).cast("double").alias("label")
    described = (means, index, numeric, text, meant, settings.max_bins)
    rows = with_inputs(known, *described, others, roles.row_id)
    rows = rows.select(F.col(roles.row_id).alias("_row"), "features", label)
    table = even_parts(staged(rows, "training-rows"), ["_row", "label"])
    trees = GBTRegressor(
        labelCol="label",
        featuresCol="features",
        lossType="squared",
        maxIter=settings.rounds,
        stepSize=settings.step,
        maxDepth=settings.depth,
        minInstancesPerNode=settings.min_rows,
        featureSubsetStrategy=settings.feature_share,
        seed=settings.seed,
        maxBins=settings.max_bins,
    ).fit(table)
    rounds, errors = len(trees.trees), None
    if valid is not None:
        held = with_inputs(valid.where(F.col(target).isNotNull()), *described)
        errors = staged(round_errors(trees, held.select("features", label)), "round-errors")
        best = stopping(errors, settings.patience).select("chosen").first()
        rounds = best["chosen"] if best else rounds  # no validation row: all rounds
    return Forecaster(
        trees, rounds, means, index, tuple(numeric), tuple(text), tuple(meant), settings.max_bins, errors
    )


def fit_or_load(
    path: str,
    train: DataFrame,
    valid: DataFrame | None,
    target: str,
    force: bool = False,
    settings: Boosting = Boosting(),
    roles: Roles = Roles(),
) -> Forecaster:
    """The forecaster stored at ``path``; trains and stores it if there is none or ``force`` is set."""
    saved = None if force else Forecaster.load(train.sparkSession, path)
    if saved is not None:
        return saved
    fitted = fit(train, valid, target, settings, roles)
    fitted.save(path)
    return fitted


def predict(model: Forecaster, df: DataFrame, name: str) -> DataFrame:
    """Rows with the rounded, non-negative prediction in ``name``."""
    scored = prefix_sums(model.trees, model.describe(df), model.rounds)
    prediction = F.element_at("by_round", -1)
    return scored.select(*df.columns, whole_count(prediction).alias(name))


def feature_importance(model: Forecaster) -> DataFrame:
    """(feature, importance), most important first; one row per model input. Each tree that counts
    has the same say, as each is trained on what the ones before left."""
    shares = [tree.featureImportances.toArray() for tree in model.trees.trees[: model.rounds]]
    sums = sum(shares)
    weights = (sums / sums.sum() if sums.sum() else sums).tolist()
    table = model.means.sparkSession.createDataFrame(
        list(zip(model.inputs, weights)), "feature STRING, importance DOUBLE"
    )
    return table.orderBy(F.desc("importance"), "feature")


def top_features(model: Forecaster, n: int = 20) -> DataFrame:
    return feature_importance(model).limit(n)
