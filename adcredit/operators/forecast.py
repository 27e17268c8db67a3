"""Next-day ROAS forecast with Spark ML (random forest regression).

Training, evaluation and scoring are distributed Spark ML jobs; the only
driver-side objects are the fitted model and its nine importances.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from adcredit.schemas import FEATURE_ORDER
from adcredit.session import checkpoint_root

LABEL = "target_next_day_roas"

# The reference's model settings (every feature is a split
# candidate at every node, bootstrap rows, 80/20 split).
NUM_TREES = 200
MAX_DEPTH = 12
SEED = 42
TEST_FRACTION = 0.2
FEATURE_SUBSET = "all"


def is_test(keys: tuple[str, ...], test_fraction: float = TEST_FRACTION, seed: int = SEED):
    """The first 32 bits of md5("seed|key|..."), mod 10,000, at or above the cut.

    Any engine can recompute it, so the membership of every row can be checked.
    """
    text = F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys])
    h = F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint") % 10_000
    return h >= int(round((1.0 - test_fraction) * 10_000))


def split(frame: DataFrame, keys: tuple[str, ...] = ("campaign_id", "metric_date"),
          test_fraction: float = TEST_FRACTION, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """M3: 80/20 split by a hash of the row keys: the same rows land on the
    same side whatever the partitioning (``randomSplit`` is layout-dependent)."""
    test = is_test(keys, test_fraction, seed)
    return frame.filter(~test), frame.filter(test)


def fit_forecast(train: DataFrame, num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH,
                 seed: int = SEED) -> PipelineModel:
    """M4: VectorAssembler(FEATURE_ORDER) -> RandomForestRegressor.

    The training frame is persisted for the forest's passes over it. More
    nodes are split per pass (``maxMemoryInMB``) and node ids are cached and
    checkpointed to the shared folder (``cacheNodeIds``), which shortens
    deep-tree training without changing the trees.
    """
    checkpoint_root(train.sparkSession)
    pipe = Pipeline(stages=[
        VectorAssembler(inputCols=FEATURE_ORDER, outputCol="features", handleInvalid="keep"),
        RandomForestRegressor(featuresCol="features", labelCol=LABEL, numTrees=num_trees,
                              maxDepth=max_depth, seed=seed,
                              featureSubsetStrategy=FEATURE_SUBSET, maxMemoryInMB=1024,
                              cacheNodeIds=True, checkpointInterval=10),
    ])
    # the frame is small (campaign-days) but each row costs every tree:
    # spread it over the cores, placed by a hash of its values (stable)
    spark = train.sparkSession
    spread = train.repartition(spark.sparkContext.defaultParallelism,
                               *[F.col(c) for c in ("metric_date", *FEATURE_ORDER[:2])])
    cached = spread.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return pipe.fit(cached)
    finally:
        cached.unpersist()


def evaluate(model: PipelineModel, test: DataFrame) -> DataFrame:
    """One row with MSE, R2 and the number of test rows."""
    return evaluate_predictions(model.transform(test))


def evaluate_predictions(pred: DataFrame) -> DataFrame:
    """MSE and R2 of any ``prediction`` column against the label."""
    err = F.col("prediction") - F.col(LABEL)
    agg = pred.agg(F.avg(err * err).alias("mse"),
                   F.sum(err * err).alias("sse"),
                   F.var_pop(LABEL).alias("var"),
                   F.count(F.lit(1)).alias("rows"))
    r2 = F.when(F.col("var") > 0, 1 - F.col("sse") / (F.col("var") * F.col("rows")))
    return agg.select("mse", r2.alias("r2"), F.col("rows").cast("bigint").alias("rows"))


def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """(feature, importance) sorted descending; length checked."""
    forest = model.stages[-1]
    imp = forest.featureImportances.toArray().tolist()
    if len(imp) != len(FEATURE_ORDER):
        raise ValueError(f"feature count mismatch: model {len(imp)}, names {len(FEATURE_ORDER)}")
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    df = spark.createDataFrame(list(zip(FEATURE_ORDER, [float(x) for x in imp])), schema)
    return df.orderBy(F.col("importance").desc(), F.col("feature"))


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """M7 / M8: batch prediction (NULL features are scored as 0)."""
    filled = features.na.fill(0.0, subset=FEATURE_ORDER)
    out = model.transform(filled)
    keep = [c for c in features.columns]
    return out.select(*keep, F.col("prediction").alias("predicted_next_day_roas"))


def save_model(model: PipelineModel, path: str) -> str:
    """Spark ML persistence (overwrite)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
