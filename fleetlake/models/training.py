"""Spark ML pipelines: driver profile, demand, maintenance, pricing, and their reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import IndexToString, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.scalar import rows
from fleetlake.models import features
from fleetlake.operators.sets import union_all
from fleetlake.session import materialise

#: Share of the rows kept for testing, by model.
TEST_SHARES = {"safety": 0.2, "demand": 0.15, "maintenance": 0.2, "pricing": 0.2}
SAFETY_FEATURES = ["harsh_brakes", "harsh_accels", "idle_minutes", "speeding_km", "distance_km", "duration_min", "max_speed", "mean_speed"]
DEMAND_FEATURES = ["dow", "month", "year", "is_weekend", "day_of_month", "city_code"]
MAINTENANCE_FEATURES = ["vehicle_age", "odometer_km", "days_since_last", "type_code"]
PRICING_FEATURES = ["month", "dow", "is_weekend", "city_code", "type_code", "distance_km"]

#: Rows that a tree model learns one by one; of a larger frame, rows of one cell of bins are learnt together.
MOST_INSTANCES = 500_000
#: Quantiles looked at per bin: where one value fills many of them, the others still give edges.
FINER = 8


def _codes(column: str, name: str) -> StringIndexer:
    """Alphabetical codes; unseen values get their own code."""
    return StringIndexer(inputCol=column, outputCol=name, stringOrderType="alphabetAsc", handleInvalid="keep")


def _vector(cols: Sequence[str]) -> VectorAssembler:
    return VectorAssembler(inputCols=list(cols), outputCol="features", handleInvalid="keep")


def _bins(df: DataFrame, columns: Sequence[str], least: int = 32) -> int:
    """Split candidates: trees need at least one per category."""
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    return max(least, *[int(sizes[c] * 1.1) + 2 for c in columns])


def _edges(df: DataFrame, columns: Sequence[str], bins: int) -> dict[str, list[float]]:
    """Split candidates per numeric column from all rows: between any two values where they are few, else at quantiles."""
    if not columns:
        return {}
    sizes = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns]).first()
    few = [c for c in columns if sizes[c] <= bins]
    many = [c for c in columns if c not in few]
    edges = {}
    if few:
        known = df.agg(*[F.array_sort(F.collect_set(F.nanvl(F.col(c).cast("double"), F.lit(None)))).alias(c) for c in few]).first()
        edges |= {c: [a / 2 + b / 2 for a, b in zip(known[c], known[c][1:])] for c in few}
    if many:
        steps = FINER * bins
        for c, found in zip(many, df.approxQuantile(many, [i / steps for i in range(1, steps)], 0.25 / steps)):
            values = sorted(set(found))
            kept = min(bins - 1, len(values))
            edges[c] = [values[(i + 1) * len(values) // (kept + 1)] for i in range(kept)] if kept < len(values) else values
    return edges


def _bin_sql(column: str, edges: Sequence[float]) -> str:
    """SQL for the number of edges below a value. NULL, NaN and infinities stay as they are: a fit refuses them, scoring does not."""
    value = f"CAST(`{column}` AS DOUBLE)"

    def among(low: int, high: int) -> str:
        if low == high:
            return f"{low}.0D"
        middle = (low + high) // 2
        return f"IF({value} <= CAST('{float(edges[middle])!r}' AS DOUBLE), {among(low, middle)}, {among(middle + 1, high)})"

    return f"IF({value} - {value} = 0, {among(0, len(edges))}, {value})"


def _fit(df: DataFrame, train: DataFrame, codes: Sequence[Estimator | Transformer], columns: Sequence[str], trees: Estimator, most: int, regression: bool = False) -> PipelineModel:
    """Codes, feature vector and tree model fitted on ``train`` (``label``, and ``weight`` if the model has a weight column), a part of ``df``.

    Up to ``most`` rows are instances of their own. Beyond that, numeric features are cut into the bins a tree looks at, by
    edges from all rows, and rows that are equal in all bins and codes form a cell. For a regression a cell is one
    instance, its mean label weighed by its rows: the sums a tree compares are the same. For classes a cell and
    label becomes instances of up to rows / ``most`` rows each, so a forest's bootstrap still draws among at least
    ``most``. Every row counts; there are at most ``most`` plus as many instances as cells, and cells cannot exceed the
    product of the bins.
    """
    total = df.count()
    if total <= most:
        return Pipeline(stages=[*codes, _vector(columns), trees]).fit(train)
    coded = Pipeline(stages=list(codes)).fit(train)
    data = coded.transform(train)
    nominal = {s.getOutputCol() for s in codes}
    numeric = [c for c in columns if c not in nominal]
    edges = _edges(data, numeric, min(32, trees.getMaxBins()))
    names = [c if c in nominal else f"{c}_bin" for c in columns]
    cut = SQLTransformer(statement=f"SELECT *, {', '.join(f'{_bin_sql(c, edges[c])} AS `{c}_bin`' for c in numeric)} FROM __THIS__")
    weight = F.col("weight") if trees.isSet("weightCol") else F.lit(1.0)
    binned = cut.transform(data)
    n, weights = rows().alias("_n"), F.sum(weight).alias("weight")
    if regression:
        mean = F.when(F.count("label") == rows(), F.sum(F.col("label") * weight) / F.sum(weight))
        cells = binned.groupBy(*names).agg(n, weights, mean.alias("label"))
    else:
        each = -(-total // most)
        cells = binned.groupBy(*names, "label").agg(n, weights).withColumn("_parts", F.ceil(F.col("_n") / each).cast("int"))
        cells = cells.select("*", F.explode(F.sequence(F.lit(1), "_parts")).alias("_part")).withColumn("weight", F.col("weight") / F.col("_parts"))
    instances = materialise(cells.repartition(df.sparkSession.sparkContext.defaultParallelism), "instances")
    vector = _vector(names)
    model = trees.copy().setWeightCol("weight").fit(vector.transform(instances))
    return PipelineModel([*coded.stages, PipelineModel([cut, vector]), model])


def train_safety(df: DataFrame, trees: int = 150, depth: int = 8, columns: Sequence[str] | None = None, most: int = MOST_INSTANCES) -> tuple[PipelineModel, DataFrame]:
    """Behaviour profile from trip measures; returns the model and the scored test rows.

    ``columns`` are the features; by default all columns of ``df`` but the key and the label.
    """
    columns = columns or [c for c in df.columns if c not in ("telem_id", "profile")]
    df = materialise(df, "safety-frame")
    train, test = features.hash_split(df, "telem_id", TEST_SHARES["safety"])
    label = StringIndexer(inputCol="profile", outputCol="label", stringOrderType="alphabetAsc").fit(df)
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42)
    names = IndexToString(inputCol="prediction", outputCol="predicted_profile", labels=label.labels)
    model = PipelineModel([*_fit(df, train, [label], columns, forest, most).stages, names])
    return model, model.transform(test)


def class_probabilities(model: PipelineModel, rows_to_score: DataFrame) -> DataFrame:
    """Predicted profile and the probability (percent) of every class for new trips."""
    labels = model.stages[0].labels
    scored = rows_to_score
    for stage in model.stages[1:]:
        scored = stage.transform(scored)
    p = vector_to_array("probability")
    return scored.select(
        *rows_to_score.columns, "predicted_profile", *[F.round(p[i] * 100, 1).alias(f"p_{name}") for i, name in enumerate(labels)]
    )


def train_demand(df: DataFrame, trees: int = 200, depth: int = 4, step: float = 0.08) -> tuple[PipelineModel, DataFrame]:
    """Daily trips per city."""
    df = materialise(df, "demand-frame")
    data = df.withColumn("_key", F.concat_ws("|", "day", "city")).withColumn("label", F.col("trip_count").cast("double"))
    train, test = features.hash_split(data, "_key", TEST_SHARES["demand"])
    gbt = GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=step, maxBins=_bins(df, ["city"]), seed=42)
    model = Pipeline(stages=[_codes("city", "city_code"), _vector(DEMAND_FEATURES), gbt]).fit(train)
    return model, model.transform(test)


def forecast_demand(model: PipelineModel, cities: DataFrame, after: str, days: int = 30) -> DataFrame:
    """Predicted trips per city for the next days, never below 0."""
    start = F.lit(after).cast("date")
    future = cities.select("city", F.explode(F.sequence(F.date_add(start, 1), F.date_add(start, days))).alias("day"))
    scored = model.transform(future.withColumns(features.calendar("day")))
    return scored.select("city", "day", F.greatest(F.lit(0.0), F.col("prediction")).alias("predicted_trips"))


def train_maintenance(df: DataFrame, trees: int = 100, depth: int = 5, most: int = MOST_INSTANCES) -> tuple[PipelineModel, DataFrame]:
    """Service due soon; classes weigh the same whatever their size."""
    df = materialise(df, "maintenance-frame")
    train, test = features.hash_split(df.withColumn("label", F.col("upcoming").cast("double")), "maint_id", TEST_SHARES["maintenance"])
    sizes = train.groupBy("label").agg(rows().alias("_n"))
    total, classes = sizes.agg(F.sum("_n")).scalar(), sizes.agg(rows()).scalar()
    weights = sizes.select("label", (total / (classes * F.col("_n"))).alias("weight"))
    # two rows, one per class
    weighted = train.join(F.broadcast(weights), "label")
    forest = RandomForestClassifier(numTrees=trees, maxDepth=depth, weightCol="weight", maxBins=_bins(df, ["maintenance_type"]), seed=42)
    model = _fit(df, weighted, [_codes("maintenance_type", "type_code")], MAINTENANCE_FEATURES, forest, most)
    return model, model.transform(test)


def at_risk(scored: DataFrame, threshold: float = 0.6) -> DataFrame:
    """Rows whose probability of a service soon exceeds the threshold."""
    risk = vector_to_array("probability")[1]
    return scored.withColumn("risk", risk).where(F.col("risk") > threshold)


def train_pricing(df: DataFrame, trees: int = 200, depth: int = 5, step: float = 0.07, most: int = MOST_INSTANCES) -> tuple[PipelineModel, DataFrame]:
    """Fare per day."""
    df = materialise(df, "pricing-frame")
    train, test = features.hash_split(df.withColumn("label", F.col("fare_per_day")), "trip_id", TEST_SHARES["pricing"])
    gbt = GBTRegressor(maxIter=trees, maxDepth=depth, stepSize=step, maxBins=_bins(df, ["city", "booking_type"]), seed=42)
    codes = [_codes("city", "city_code"), _codes("booking_type", "type_code")]
    model = _fit(df, train, codes, PRICING_FEATURES, gbt, most, regression=True)
    return model, model.transform(test)


def price_surface(model: PipelineModel, cities: DataFrame, booking_type: str, distance_km: float, dow: int = 2) -> DataFrame:
    """Predicted rate per city and month for one kind of trip."""
    grid = cities.select("city", F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month")).withColumns(
        {"dow": F.lit(dow), "is_weekend": F.lit(int(dow >= 5)), "booking_type": F.lit(booking_type), "distance_km": F.lit(float(distance_km))}
    )
    return model.transform(grid).select("city", "month", F.col("prediction").alias("rate"))


def regression_report(scored: DataFrame) -> DataFrame:
    """MAE, RMSE and R2 of scored test rows."""
    values = [(m, float(RegressionEvaluator(metricName=m).evaluate(scored))) for m in ("mae", "rmse", "r2")]
    return scored.sparkSession.createDataFrame(values, "metric string, value double")


def classification_report(scored: DataFrame) -> DataFrame:
    """Accuracy plus precision, recall and F1 per class, from one confusion count."""
    spark = scored.sparkSession
    accuracy = float(MulticlassClassificationEvaluator(metricName="accuracy").evaluate(scored))
    confusion = scored.groupBy("label", "prediction").agg(rows().alias("n"))
    actual = confusion.groupBy("label").agg(F.sum("n").alias("support"), F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("hits"))
    called = confusion.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("called"))
    per = actual.join(called, "label", "left")
    precision, recall = F.coalesce(F.try_divide("hits", "called"), F.lit(0.0)), F.try_divide("hits", "support")
    f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
    cells = F.array(*[F.struct(F.concat(F.lit(f"{n}_"), F.col("label").cast("int")).alias("metric"), c.alias("value")) for n, c in (("precision", precision), ("recall", recall), ("f1", f1))])
    overall = spark.createDataFrame([("accuracy", accuracy)], "metric string, value double")
    return union_all(overall, per.select(F.inline(cells)))


def feature_importance(scored: DataFrame, model: PipelineModel, names: Sequence[str], stage: int) -> DataFrame:
    """Importance per feature of the tree model at ``stage``."""
    values = model.stages[stage].featureImportances.toArray()
    return scored.sparkSession.createDataFrame([(n, float(v)) for n, v in zip(names, values)], "feature string, importance double")
