"""Class-weighted logistic regression and random forest with probability calibration.

Everything is MLlib inside pipelines, so assembly and scaling are fitted and saved with the model.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom import spec
from caseloom.functions.text import lookup
from caseloom.operators.ranking import top_ranked
from caseloom.sources.scratch import Scratch
from caseloom.sources.writers import checkpointed

WEIGHT = "class_weight"


def assemble(df: DataFrame, features: Sequence[str] = tuple(spec.FEATURES), name: str = "features") -> DataFrame:
    """Add the feature vector; NULL in a feature is an error."""
    return VectorAssembler(inputCols=list(features), outputCol=name).transform(df)


def class_weights(df: DataFrame, label: str = spec.LABEL) -> DataFrame:
    """Row counts and the weight of each class: the other class's share of all rows."""
    return df.agg(
        F.count_if(F.col(label) == 1).alias("positives"),
        F.count_if(F.col(label) == 0).alias("negatives"),
        F.count_if(F.col(label).isin(0, 1)).alias("rows"),
    ).withColumns(
        {
            "weight_positive": F.try_divide("negatives", "rows"),
            "weight_negative": F.try_divide("positives", "rows"),
        }
    )


def with_class_weight(df: DataFrame, label: str = spec.LABEL, name: str = WEIGHT) -> DataFrame:
    """Attach each row's class weight; the two weights are a scalar subquery, nothing is joined.

    They are stored, as a fit makes many passes and each would count the classes again.
    """
    weights = checkpointed(class_weights(df, label)).select(F.struct("weight_positive", "weight_negative")).scalar()
    return df.withColumn(
        name,
        F.when(F.col(label) == 1, weights.getField("weight_positive")).otherwise(weights.getField("weight_negative")),
    )


def standardized(df: DataFrame, columns: Sequence[str] = tuple(spec.FEATURES), train: DataFrame | None = None) -> DataFrame:
    """Columns centred and scaled by the mean and sample deviation of `train` (by default the table)."""
    fitted = (df if train is None else train).agg(
        *[F.avg(name).alias(f"mean_{name}") for name in columns],
        *[F.stddev_samp(name).alias(f"sd_{name}") for name in columns],
    )
    stats = fitted.select(F.struct(*fitted.columns)).scalar()
    scaled = {
        name: F.try_divide(F.col(name) - stats.getField(f"mean_{name}"), stats.getField(f"sd_{name}"))
        for name in columns
    }
    return df.withColumns(scaled)


def fit_logistic(
    train: DataFrame,
    features: Sequence[str] = tuple(spec.FEATURES),
    label: str = spec.LABEL,
    max_iter: int = 20,
    tol: float = 1e-6,
) -> PipelineModel:
    """Assemble, standardise on the training rows, and fit class-weighted logistic regression."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True),
        LogisticRegression(
            featuresCol="scaled_features", labelCol=label, weightCol=WEIGHT, maxIter=max_iter, tol=tol
        ),
    ]
    return Pipeline(stages=stages).fit(with_class_weight(train, label))


def convergence(model: PipelineModel) -> int:
    """Iterations the optimiser of a freshly fitted logistic model took."""
    return model.stages[-1].summary.totalIterations


def score_rows(model: PipelineModel, df: DataFrame, keep: Sequence[str], name: str = "prob_diabetic") -> DataFrame:
    """Positive-class probability next to the kept columns; feature columns end here."""
    return model.transform(df).select(*keep, vector_to_array("probability")[1].alias(name))


def fit_platt(
    scored: DataFrame,
    score: str = "prob_diabetic_raw",
    label: str = spec.LABEL,
    max_iter: int = 25,
    tol: float = 1e-4,
) -> PipelineModel:
    """Unweighted logistic regression of the label on the raw probability.

    The two needed columns are checkpointed first, so the fit's passes do not score again.
    """
    stages = [
        VectorAssembler(inputCols=[score], outputCol="platt_features"),
        LogisticRegression(
            featuresCol="platt_features",
            labelCol=label,
            predictionCol="platt_prediction",
            probabilityCol="platt_probability",
            rawPredictionCol="platt_raw_prediction",
            maxIter=max_iter,
            tol=tol,
        ),
    ]
    return Pipeline(stages=stages).fit(checkpointed(scored.select(label, score)))


def platt_newton(
    scored: DataFrame, score: str = "prob_diabetic_raw", label: str = spec.LABEL, max_iter: int = 50, tol: float = 1e-10
) -> tuple[float, float, int]:
    """Slope and shift of P(label = 1) = 1 / (1 + exp(-(slope * score + shift))), and the steps taken.

    Unweighted maximum likelihood by Newton's method. A step is one aggregate of six sums over the
    stored label and score, of which two numbers are solved for at the driver; a step that would lower
    the likelihood is halved. Rows without a 0/1 label or a number as score take no part. A single class
    or constant scores have no finite optimum and are an error.
    """
    x, y = F.col("x"), F.col("y")
    with Scratch(scored.sparkSession, "platt") as run:
        usable = F.col(label).cast("int").isin(0, 1) & F.col(score).isNotNull() & ~F.isnan(F.col(score).cast("double"))
        rows = run.keep(scored.where(usable).select(F.col(score).cast("double").alias("x"), F.col(label).cast("double").alias("y")), "pairs")

        def sums(slope: float, shift: float):
            z = F.lit(slope) * x + F.lit(shift)
            p = 1 / (1 + F.exp(-z))
            # ln(1 + e^z), without overflow.
            rise = F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))
            w = p * (1 - p)
            terms = {"fit": y * z - rise, "ga": (y - p) * x, "gb": y - p, "haa": w * x * x, "hab": w * x, "hbb": w}
            return rows.agg(*[F.sum(term).alias(name) for name, term in terms.items()]).first()

        slope = shift = 0.0
        now = sums(slope, shift)
        for step in range(max_iter):
            whole = now["hbb"] and now["haa"] * now["hbb"] - now["hab"] ** 2
            if not whole or whole <= 1e-12 * now["haa"] * now["hbb"]:
                raise ValueError("no finite calibration: one class only, constant scores, or classes apart")
            da = (now["hbb"] * now["ga"] - now["hab"] * now["gb"]) / whole
            db = (now["haa"] * now["gb"] - now["hab"] * now["ga"]) / whole
            after = sums(slope + da, shift + db)
            while after["fit"] < now["fit"] - 1e-9 * abs(now["fit"]):
                da, db = da / 2, db / 2
                after = sums(slope + da, shift + db)
            slope, shift, now = slope + da, shift + db, after
            if max(abs(da), abs(db)) <= tol * max(1.0, abs(slope), abs(shift)):
                break
    return slope, shift, step + 1


def apply_platt(df: DataFrame, slope: float, shift: float, score: str = "prob_diabetic_raw", name: str = "prob_diabetic") -> DataFrame:
    """Add the calibrated probability of a score; an expression of the scan, no model object needed."""
    return df.withColumn(name, 1 / (1 + F.exp(-(F.lit(slope) * F.col(score) + F.lit(shift)))))


def apply_calibration(
    model: PipelineModel, platt: PipelineModel, df: DataFrame, ids: Sequence[str] = (), label: str = spec.LABEL
) -> DataFrame:
    """Raw and calibrated probability and the calibrated class of each row."""
    raw = score_rows(model, df, [*ids, label], "prob_diabetic_raw")
    return platt.transform(raw).select(
        *ids,
        label,
        "prob_diabetic_raw",
        vector_to_array("platt_probability")[1].alias("prob_diabetic"),
        "platt_prediction",
    )


def fit_forest(
    train: DataFrame,
    features: Sequence[str] = tuple(spec.FEATURES),
    label: str = spec.LABEL,
    trees: int = 20,
    depth: int = 3,
    bins: int = 16,
    subsampling: float = 0.7,
    seed: int = 42,
) -> PipelineModel:
    """Class-weighted random forest on the raw features."""
    stages = [
        VectorAssembler(inputCols=list(features), outputCol="features"),
        RandomForestClassifier(
            featuresCol="features",
            labelCol=label,
            weightCol=WEIGHT,
            numTrees=trees,
            maxDepth=depth,
            maxBins=bins,
            subsamplingRate=subsampling,
            seed=seed,
        ),
    ]
    return Pipeline(stages=stages).fit(with_class_weight(train, label))


def load_model(path: str) -> PipelineModel:
    """Load a saved fitted pipeline."""
    return PipelineModel.load(path)


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str] = tuple(spec.FEATURES)) -> DataFrame:
    """Gini importance per feature with its rank; one row per feature of the model."""
    scores = model.stages[-1].featureImportances.toArray()
    rows = [
        F.struct(F.lit(name).alias("feature"), F.lit(float(score)).alias("raw"), F.lit(i).alias("ord"))
        for i, (name, score) in enumerate(zip(features, scores))
    ]
    table = df.sparkSession.range(1).select(F.inline(F.array(*rows)))
    ranked = top_ranked(table, len(rows), F.desc("raw"), F.col("ord"))
    return ranked.select("feature", F.round("raw", 4).alias("importance"), "rank")


def shown_importance(importance: DataFrame, titles: Mapping[str, str] = spec.FEATURE_TITLES) -> DataFrame:
    """Known features with importance above zero, display names added, least important first."""
    kept = importance.where(F.col("feature").isin(*titles) & (F.col("importance") > 0))
    return kept.withColumn("label", lookup(F.col("feature"), titles)).orderBy("importance", "feature")
