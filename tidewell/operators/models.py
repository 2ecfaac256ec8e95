"""Model fitting, selection and scoring with Spark ML, and anomaly and series models built on Spark jobs."""

from __future__ import annotations

import math
import random
from collections.abc import Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml.classification import GBTClassifier, LogisticRegression, MultilayerPerceptronClassifier, RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import det
from ..functions import strings as S
from ..session import kept_in_worker, read_folder, settle, spread
from .features import bootstrap, class_report, confusion, fit_medians, impute, label_encode, ranking_metrics, regression_report, split, stratified_folds
from .forest import Forest
from .gram import add_up, gram_by_key, solve
from .ordered import with_position
from .relational import numeric_columns
from .retrieval import knn_blocks
from .series import explode_range, supervised_windows

MANY_CLASSES = 20
#: Rows that an isolation forest scores together, and nodes of a tree that compare whole columns (four levels).
SCORED, FLAT = 20_000, 15


def text_features(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """Plain numeric features of a text, computed without leaving the JVM."""
    t = F.col(text)
    df = spread(df.select(id_col, text)).withColumn("__w", S.blank_split(t))
    words = F.col("__w")
    n = F.greatest(F.length(t), F.lit(1))
    share = lambda p: F.regexp_count(t, F.lit(p)) / n
    return df.select(
        id_col,
        F.length(t).cast("double").alias("n_chars"),
        F.size(words).cast("double").alias("n_words"),
        (F.length(t) / F.greatest(F.size(words), F.lit(1))).alias("word_length"),
        F.try_divide(F.size(F.array_distinct(words)), F.size(words)).alias("distinct_share"),
        share("[0-9]").alias("digit_share"),
        share(r"[^\w\s]").alias("symbol_share"),
        F.regexp_count(t, F.lit(r"\n")).cast("double").alias("n_lines"),
    ).na.fill(0.0)


def _gap(c: str) -> Column:
    number = F.col(c).cast("double")
    return number.isNull() | F.isnan(number)


def assemble(df: DataFrame, features: Sequence[str], keep: Sequence[str], medians: DataFrame | None = None) -> DataFrame:
    """Feature vectors of all rows; a null or NaN takes its column's value in ``medians`` (by default those of ``df``).

    A column without any number there becomes 0.
    """
    if medians is None:
        # Only columns with gaps need their median.
        gaps = df.agg(*[F.bool_or(_gap(c)).alias(c) for c in features]).first() if features else {}
        open_ = [c for c in features if gaps[c]]
        filled = impute(df, fit_medians(df, open_), open_) if open_ else df
        filled = filled.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in features})
    else:
        filled = impute(df, medians, features).na.fill(0.0, list(features))
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(filled).select(*keep, "features")


def task_of(df: DataFrame, target: str) -> str:
    """regression for a number with more than ten values, else classification, or single_class."""
    distinct = df.select(target).filter(F.col(target).isNotNull()).distinct().limit(11).count()
    if distinct <= 1:
        return "single_class"
    return "regression" if distinct > 10 and isinstance(df.schema[target].dataType, T.NumericType) else "classification"


@dataclass(frozen=True)
class ModelSize:
    """Trees and depth of forests (Spark grows 30 levels at most), rounds and depth of boosted trees.

    ``balanced`` weighs the rows of a class by the inverse of its share, except in the perceptron, which takes no weights.
    """

    trees: int = 300
    depth: int = 30
    rounds: int = 20
    boost_depth: int = 4
    balanced: bool = True


def balance(train: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Adds the weight of each row's class: rows / (classes * rows of the class)."""
    counts = train.groupBy(F.col(label).alias("__class")).agg(F.count(F.lit(1)).alias("__n"))
    total = counts.agg(F.struct(F.sum("__n").alias("n"), F.count(F.lit(1)).alias("k"))).scalar()
    share = counts.withColumn("__all", total).select("__class", (F.col("__all.n") / (F.col("__all.k") * F.col("__n"))).alias(name))
    return train.join(share, F.col(label) == F.col("__class")).drop("__class")


def _classifiers(n_features: int, n_classes: int, seed: int, size: ModelSize) -> dict:
    weight = {"weightCol": "weight"} if size.balanced else {}
    out = {
        "logistic": LogisticRegression(maxIter=30, **weight),
        "random_forest": Forest(n_classes, n_features, size.trees, size.depth, seed),
    }
    if n_classes == 2:
        out["gradient_boosting"] = GBTClassifier(maxIter=size.rounds, maxDepth=size.boost_depth, seed=seed, **weight)
    out["perceptron"] = MultilayerPerceptronClassifier(layers=[n_features, 8, n_classes], maxIter=50, seed=seed)
    return out


def _regressors(n_features: int, seed: int, size: ModelSize) -> dict:
    return {
        "linear": LinearRegression(),
        "random_forest": Forest(0, n_features, size.trees, size.depth, seed),
        "gradient_boosting": GBTRegressor(maxIter=size.rounds, maxDepth=size.boost_depth, seed=seed),
    }


def side_by_side(work, items: Sequence, at_once: int = 4) -> list:
    """What ``work`` gives for each item, ``at_once`` of them running as Spark jobs beside each other."""
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        return list(pool.map(inheritable_thread_target(SparkSession.active())(work), items))


def _report(spark: SparkSession, rows: list[tuple[str, str, float]]) -> DataFrame:
    return spark.createDataFrame(rows, "model string, metric string, value double")


def _binary_metrics(scored: DataFrame) -> dict[str, float]:
    cells = {(r[0], r[1]): r[2] for r in confusion(scored, "label", "prediction").collect()}
    tp, fp, fn = cells.get((1.0, 1.0), 0), cells.get((0.0, 1.0), 0), cells.get((1.0, 0.0), 0)
    total = sum(cells.values())
    return {
        "accuracy": sum(n for (a, p), n in cells.items() if a == p) / max(total, 1),
        "f1": 2 * tp / (2 * tp + fp + fn) if tp + fp + fn else 0.0,
    }


def supervised_report(
    df: DataFrame, id_col: str, features: Sequence[str], target: str | None, models: Sequence[str] | None = None, seed: int = 42,
    time_col: str | None = None, size: ModelSize = ModelSize(),
) -> DataFrame:
    """Hold out a fifth (the latest by ``time_col`` if given), fit the models of the task and report their metrics.

    Nulls take the medians of the training rows.  With more than two classes ``f1`` is the mean over classes.

    Without a usable target (missing, one class) or feature the rows get anomaly scores instead,
    summarised in the same table.
    """
    spark = df.sparkSession
    # Features may be costly; every later pass reads them from the settled rows.
    df = settle(df.select(id_col, *features, *([target] if target in df.columns else []), *([time_col] if time_col else [])))
    task = task_of(df, target) if target and target in df.columns and features else "single_class"
    if task == "single_class":
        feats = list(features) or numeric_columns(df, [id_col, target or ""])
        if not feats:
            return _report(spark, [("none", "skipped", 1.0)])
        s = isolation_scores(df, id_col, feats).agg(F.avg("score"), F.max("score")).first()
        return _report(spark, [("isolation_forest", "mean_score", s[0]), ("isolation_forest", "max_score", s[1])])
    rows = df.filter(F.col(target).isNotNull())
    n_classes = 0
    if task == "classification":
        n_classes = rows.select(target).distinct().count()
        rows = label_encode(rows, target, "label").withColumn("label", F.col("label").cast("double"))
    else:
        rows = rows.withColumn("label", F.col(target).cast("double"))
    stratify = "label" if 0 < n_classes <= MANY_CLASSES else None
    parts = settle(split(rows.select(id_col, *features, "label", *([time_col] if time_col else [])), id_col, stratify, time_col, seed=seed))
    data = assemble(parts, features, [id_col, "label", "part"], fit_medians(parts.filter("part = 'train'"), features))
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True).fit(data.filter("part = 'train'"))
    data = scaler.transform(data).drop("features").withColumnRenamed("scaled", "features")
    train, test = data.filter("part = 'train'"), data.filter("part = 'test'")
    train = (balance(train, "label") if task == "classification" else train).persist()
    every = _classifiers(len(features), n_classes, seed, size) if task == "classification" else _regressors(len(features), seed, size)
    out: list[tuple[str, str, float]] = []

    def judge(name: str) -> list[tuple[str, str, float]]:
        if isinstance(every[name], Forest):
            scored = settle(every[name].scores(train if size.balanced else train.drop("weight"), test, id_col))
        else:
            scored = every[name].fit(train).transform(test)
            if task == "classification":
                scored = scored.withColumn("probability", vector_to_array("probability"))
        if task == "regression":
            r = regression_report(scored, "label", "prediction").first()
            return [(name, m, r[m]) for m in ("r2", "mae", "rmse")]
        if n_classes > 2:
            scored = settle(scored.select("label", "prediction"))
            accuracy = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0]
            return [(name, "accuracy", accuracy), (name, "f1", class_report(scored, "label", "prediction").agg(F.avg("f1")).first()[0])]
        scored = settle(scored.select("label", "prediction", F.col("probability")[1].alias("p")))
        ranked = ranking_metrics(scored, "label", "p").first()
        return [*((name, m, v) for m, v in _binary_metrics(scored).items()), *((name, m, ranked[m]) for m in ("roc_auc", "avg_precision"))]

    for rows_of in side_by_side(judge, [name for name in every if not models or name in models]):
        out += rows_of
    train.unpersist()
    return _report(spark, out)


def model_select(
    df: DataFrame, id_col: str, features: Sequence[str], label: str, grid: dict[str, Sequence], k: int = 5, seed: int = 42, draws: int | None = None,
    at_once: int = 4,
) -> DataFrame:
    """Cross-validated F1 of class 1 for every forest setting of ``grid``, or for ``draws`` of them, best first."""
    spark = df.sparkSession
    base = settle(df.select(id_col, *features, F.col(label).cast("double").alias("label")))
    folds = stratified_folds(base, id_col, "label", k, seed)
    data = settle(assemble(folds, features, ["label", F.col("fold").cast("int").alias("fold")]))
    forest = RandomForestClassifier(seed=seed)
    builder = ParamGridBuilder()
    for name, values in grid.items():
        builder = builder.addGrid(forest.getParam(name), list(values))
    settings = builder.build()
    if draws is not None and draws < len(settings):
        settings = random.Random(seed).sample(settings, draws)
    judge = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
    cv = CrossValidator(estimator=forest, estimatorParamMaps=settings, evaluator=judge, numFolds=k, foldCol="fold", parallelism=at_once)
    scores = cv.fit(data).avgMetrics
    text = [", ".join(f"{p.name}={v}" for p, v in sorted(s.items(), key=lambda x: x[0].name)) for s in settings]
    ranked = sorted(zip(text, scores), key=lambda x: (-x[1], x[0]))
    return spark.createDataFrame([(i + 1, t, float(f)) for i, (t, f) in enumerate(ranked)], "place int, settings string, f1 double")


def importance_prune(
    df: DataFrame, features: Sequence[str], label: str, ratio: float = 0.20, seed: int = 42, trees: int = 20, depth: int = 5
) -> DataFrame:
    """Features by importance of one forest; the bottom ``int(n * ratio)`` are not kept."""
    spark = df.sparkSession
    data = assemble(spread(df.select(*features, F.col(label).cast("double").alias("label"))), features, ["label"])
    weights = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=seed).fit(data).featureImportances.toArray()
    order = sorted(range(len(features)), key=lambda i: (weights[i], i))
    cut = int(len(features) * ratio)
    rows = [(features[i], float(weights[i]), place + 1, place >= cut) for place, i in enumerate(order)]
    return spark.createDataFrame(rows, "feature string, importance double, place int, kept boolean")


def oof_scores(
    df: DataFrame, id_col: str, features: Sequence[str], label: str, k: int = 5, n_models: int = 2, seed: int = 42, oversample: bool = False,
    trees: int = 10, depth: int = 5, at_once: int = 4,
) -> DataFrame:
    """Mean held-out probability per row from ``n_models`` bagged forests per fold.

    ``oversample`` adds synthetic minority rows to the training part of each fold.  Folds are prepared and models
    fitted ``at_once`` beside each other; every draw depends on its own seed, so the order makes no difference.
    """
    base = settle(df.select(id_col, *features, F.col(label).cast("double").alias("label")))
    data = settle(stratified_folds(base, id_col, "label", k, seed))

    def prepare(fold: int) -> tuple[DataFrame, DataFrame, DataFrame]:
        train = data.filter(F.col("fold") != fold - 1).drop("fold")
        medians = settle(fit_medians(train, features))
        held = assemble(data.filter(F.col("fold") == fold - 1), features, [id_col, "label"], medians)
        if oversample:
            packed = train.select(F.col(id_col).cast("string").alias("row_id"), "label", F.array(*features).alias("x"))
            train = settle(smote(packed, "row_id", "label", "x", seed=seed))
            train = train.select(F.col("row_id").alias(id_col), "label", *[F.col("x")[i].alias(c) for i, c in enumerate(features)])
        return train, medians, held

    parts = side_by_side(prepare, range(1, k + 1), at_once)

    def fit(task: tuple[int, int]) -> DataFrame:
        fold, m = task
        train, medians, held = parts[fold - 1]
        s = seed + 1000 * fold + m
        forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=s, weightCol="weight")
        fitted = forest.fit(assemble(bootstrap(train, id_col, [s]), features, ["label", F.col("weight").cast("double").alias("weight")], medians))
        return fitted.transform(held).select(id_col, "label", vector_to_array("probability")[1].alias("p"))

    scored = side_by_side(fit, [(fold, m) for fold in range(1, k + 1) for m in range(n_models)], at_once)
    out = reduce(DataFrame.unionByName, scored)
    return out.groupBy(id_col, "label").agg(F.avg("p").alias("proba"), F.count(F.lit(1)).alias("n_models"))


# -- oversampling ------------------------------------------------------------------------


def smote(df: DataFrame, id_col: str, label: str, features: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Rows plus synthetic ones until every class is as large as the largest.

    A synthetic row lies between a drawn row and one of its ``k`` nearest of the same class.
    Draws come from hashes of the class and the number of the new row; ids are text.
    """
    rows = settle(df.select(F.col(id_col).cast("string").alias(id_col), label, F.col(features).cast("array<double>").alias("x")))
    counts = rows.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    most = counts.agg(F.max("n")).scalar()
    short = counts.withColumn("need", most - F.col("n")).filter("need > 0")
    placed = with_position(rows.join(short.select(label), label, "left_semi"), [id_col], label, "pos")
    draws = explode_range(short, F.lit(1).cast("bigint"), F.col("need"), "j")
    mark = F.concat_ws(":", F.col(label).cast("string"), F.col("j").cast("string"))
    draw = lambda salt: det.uniform(mark, f"{seed}{salt}")
    draws = draws.select(
        label, "j", (F.floor(draw("a") * F.col("n")) + 1).alias("pos"),
        (F.floor(draw("b") * F.least(F.lit(k), F.col("n") - 1)) + 1).cast("int").alias("rank"), draw("c").alias("gap"),
    )
    bases = draws.join(placed, [label, "pos"])
    drawn = draws.select(label, "pos").distinct().join(placed, [label, "pos"])  # the rows that neighbours are asked of
    near = knn_blocks(drawn.withColumnsRenamed({id_col: "__base", "x": "__bx"}), placed, k, "l2", id_col, "x", "__base", "__bx", label, True)
    friends = near.select(F.col("__base").alias(id_col), "rank", F.col(id_col).alias("__friend"))
    made = bases.join(friends, [id_col, "rank"], "left")
    other = placed.select(F.col(id_col).alias("__friend"), F.col("x").alias("__y"))
    made = made.join(other, "__friend", "left")
    blend = F.transform(F.arrays_zip("x", F.coalesce("__y", "x").alias("y")), lambda p: p["x"] + (p["y"] - p["x"]) * F.col("gap"))
    new = made.select(
        F.concat_ws("-", F.lit("new"), F.col(label).cast("string"), F.col("j").cast("string")).alias(id_col), label, blend.alias("x")
    )
    return rows.unionByName(new).withColumnRenamed("x", features)


# -- isolation forest --------------------------------------------------------------------


def _expected_path(n: np.ndarray) -> np.ndarray:
    """Mean depth of an unsuccessful search in a random tree over n rows."""
    n = np.asarray(n, dtype=np.float64)
    out = np.zeros_like(n)
    out[n == 2] = 1.0
    big = n > 2
    out[big] = 2.0 * (np.log(n[big] - 1.0) + np.euler_gamma) - 2.0 * (n[big] - 1.0) / n[big]
    return out


def _grow_tree(x: np.ndarray, rng: np.random.Generator, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Random isolation tree of full depth: node i has children 2i+1 and 2i+2.

    Below a leaf every row keeps left, so that after ``limit`` steps each row stands on a
    last-level node holding its path length.
    """
    nodes = 2 ** (limit + 1) - 1
    feature, cut, path = np.zeros(nodes, np.int32), np.full(nodes, np.inf), np.zeros(nodes)

    def fill(me: int, rows: np.ndarray, depth: int) -> None:
        part = x[rows]
        usable = np.flatnonzero(part.max(axis=0) > part.min(axis=0)) if len(rows) > 1 and depth < limit else []
        if not len(usable):
            last = me
            for _ in range(limit - depth):
                last = 2 * last + 1
            path[last] = depth + float(_expected_path(np.array([len(rows)]))[0])
            return
        f = int(rng.choice(usable))
        feature[me], cut[me] = f, rng.uniform(part[:, f].min(), part[:, f].max())
        below = part[:, f] <= cut[me]
        fill(2 * me + 1, rows[below], depth + 1)
        fill(2 * me + 2, rows[~below], depth + 1)

    fill(0, np.arange(len(x)), 0)
    return feature, cut, path


def _together(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.RecordBatch]:
    """Batches put together to about ``rows`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.concat_batches(held)
            held, size = [], 0
    if size:
        yield pa.concat_batches(held)


def _ranked(trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]], features: int) -> tuple[list[np.ndarray], list[tuple]]:
    """The sorted cuts of each feature, and the trees with the numbers of their cuts; a leaf has the number above all."""
    cuts = [np.unique(np.concatenate([np.zeros(0), *(c[(f == i) & np.isfinite(c)] for f, c, _ in trees)])) for i in range(features)]
    out = []
    for feature, cut, path in trees:
        number = np.zeros(len(cut), np.uint32)
        for i, known in enumerate(cuts):
            number[feature == i] = np.searchsorted(known, cut[feature == i])
        out.append((feature, number, feature[:FLAT].tolist(), number[:FLAT].tolist(), path))
    return cuts, out


def _paths(tree: tuple, columns: list[np.ndarray], flat: np.ndarray, rows: np.ndarray, limit: int) -> np.ndarray:
    """Path length of each row.  In the first levels all nodes compare whole columns and earlier turns say which one counts."""
    feature, number, features, numbers, path = tree
    turns: list[np.ndarray] = []
    at = np.zeros(len(rows), np.int64)
    for level in range(limit):
        if 2 ** (level + 1) - 1 <= FLAT:
            sides = [columns[features[n]] > numbers[n] for n in range(2**level - 1, 2 ** (level + 1) - 1)]
            for turn in turns:
                half = len(sides) // 2
                sides = [low ^ ((low ^ high) & turn) for low, high in zip(sides[:half], sides[half:])]
            above = sides[0]
            turns.append(above)
        else:
            above = flat.take(rows + feature.take(at)) > number.take(at)
        at += at
        at += 1
        at += above
    return path.take(at)


def deal_to_trees(numbers: DataFrame, ids: Sequence[str], feats: Sequence[str], trees: int, sample: int, seed: int) -> DataFrame:
    """Rows tree, draw and features: somewhat more than ``sample`` rows, drawn by hash, for each tree.

    A draw falls into one of the trees or into none, so a row is looked at a bounded number of times and the
    rows handed on are about ``trees * sample``, whatever the table's size.
    """
    n = max(1, numbers.count())
    share = min(1.0, (sample + 6 * math.sqrt(sample)) / n)  # of the rows, for one tree
    mark = F.concat_ws("|", *[F.col(c).cast("string") for c in [*ids, *feats]])
    if share >= 1:
        every = numbers.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        return every.select("tree", det.hash52(F.concat_ws("#", mark, F.col("tree")), str(seed)).alias("draw"), *feats)
    rounds = math.ceil(trees * share)
    dealt = numbers.withColumn("round", F.explode(F.sequence(F.lit(0), F.lit(rounds - 1)))) if rounds > 1 else numbers.withColumn("round", F.lit(0))
    draw = det.hash52(F.concat_ws("#", mark, F.col("round")), str(seed))
    at = F.floor(draw / 2**52 * rounds / share).cast("int")
    return dealt.select(at.alias("tree"), draw.alias("draw"), *feats).filter(F.col("tree") < trees)


def isolation_forest(dealt: DataFrame, feats: Sequence[str], sample: int, limit: int, seed: int) -> DataFrame:
    """A row per tree (tree, feature, cut, path), each grown in a task of its own group from its ``sample`` first draws."""

    def grow(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        order = rows.sort_values(["draw", *feats], kind="stable").drop_duplicates(["draw", *feats])[: sample]
        made = _grow_tree(order[list(feats)].to_numpy(np.float64), np.random.default_rng([seed, int(key[0])]), limit)
        return pd.DataFrame({"tree": [key[0]], "feature": [made[0]], "cut": [made[1]], "path": [made[2]]})

    return dealt.groupBy("tree").applyInPandas(grow, "tree int, feature array<int>, cut array<double>, path array<double>")


def isolation_scores(
    df: DataFrame, id_cols: str | Sequence[str], features: Sequence[str], trees: int = 300, sample: int = 256, seed: int = 42
) -> DataFrame:
    """Anomaly score in (0, 1) per row, higher for rows that random cuts isolate early.

    Rows are dealt to trees by hash and each tree grows in its group; the forest, a table of fixed size in the
    shared folder, is read by the tasks that score Arrow batches.
    """
    ids = [id_cols] if isinstance(id_cols, str) else list(id_cols)
    feats = [f"__x{i}" for i in range(len(features))]
    number = lambda c: F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(None)), F.lit(0.0))
    numbers = df.select(*ids, *[number(c).alias(n) for c, n in zip(features, feats)])
    limit = max(1, math.ceil(math.log2(max(sample, 2))))
    dealt = settle(deal_to_trees(numbers, ids, feats, trees, sample, seed))  # the draws of trees, read twice
    forest = settle(isolation_forest(dealt, feats, sample, limit, seed))
    size = dealt.groupBy("tree").count().agg(F.max("count")).first()[0] or 1
    norm = float(_expected_path(np.array([min(sample, size)]))[0]) or 1.0
    path = forest.settled_path
    schema = T.StructType([*[numbers.schema[c] for c in ids], T.StructField("score", T.DoubleType())])

    def load() -> tuple[list[np.ndarray], list[tuple]]:
        rows = sorted(read_folder(path).to_pylist(), key=lambda r: r["tree"])
        return _ranked([(np.array(r["feature"], np.int64), np.array(r["cut"]), np.array(r["path"])) for r in rows], len(feats))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cuts, grown = kept_in_worker(path, load)
        for b in _together(batches, SCORED):
            columns = [np.searchsorted(c, b.column(len(ids) + i).to_numpy()).astype(np.uint32) for i, c in enumerate(cuts)]
            flat, rows = np.stack(columns, axis=1).ravel(), np.arange(b.num_rows) * len(feats)
            depth = np.zeros(b.num_rows)
            for tree in grown:
                depth += _paths(tree, columns, flat, rows, limit)
            made = pa.array(2.0 ** (-depth / (len(grown) * norm)))
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(ids))), made], schema.names)

    return spread(numbers).mapInArrow(score, schema)


# -- lag-linear series model -------------------------------------------------------------


def lag_statistics(df: DataFrame, value: str, order_by, by: str, seq_len: int, part: str | None = None) -> DataFrame:
    """Sums of products of (1, lags, value) per series (``gram``): all a least-squares fit needs, and additive."""
    made = supervised_windows(df, value, order_by, by, seq_len)
    return gram_by_key(made, [by, *([part] if part else [])], "x", "y")


def merge_statistics(a: DataFrame, b: DataFrame, by: str) -> DataFrame:
    """Statistics of both row sets together; refitting from them is a warm start without old rows."""
    return add_up(a.unionByName(b), [by])


def solve_lag_linear(stats: DataFrame, by: str) -> DataFrame:
    """Intercept, lag weights and training RMSE per series; one small system per row."""
    schema = T.StructType(
        [stats.schema[by], T.StructField("n", T.LongType()), T.StructField("weights", T.ArrayType(T.DoubleType())), T.StructField("rmse", T.DoubleType())]
    )

    def fit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            fits = [solve(gram) for gram in b["gram"]]
            yield pd.DataFrame({by: b[by], "n": [f[0] for f in fits], "weights": [f[1].tolist() for f in fits], "rmse": [f[2] for f in fits]})

    return stats.select(by, "gram").mapInPandas(fit, schema)


def retrain_lag_linear(df: DataFrame, value: str, order_by, by: str, seq_len: int, cut: str) -> DataFrame:
    """Fit on rows before the boolean column ``cut`` turns true, then update with the rest; one row per series and phase."""
    stats = settle(lag_statistics(df, value, order_by, by, seq_len, cut))
    old, new = stats.filter(~F.col(cut)).drop(cut), stats.filter(cut).drop(cut)
    first = solve_lag_linear(old, by).withColumn("phase", F.lit("original"))
    second = solve_lag_linear(merge_statistics(old, new, by), by).withColumn("phase", F.lit("retrained"))
    return first.unionByName(second)
