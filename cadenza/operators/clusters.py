"""Audio-feature clusters of tracks: K-Means, profiles, elbow, PCA."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, MinMaxScaler, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadenza.operators.features import drop_incomplete
from cadenza.session import stored
from cadenza.sources.schemas import TRACK_FEATURES


def feature_vectors(
    tracks: DataFrame, features: Sequence[str] = TRACK_FEATURES, scaling: Sequence[str] = ("standard",)
) -> DataFrame:
    """Tracks with all features and their scaled vector ``features``, stored once.

    ``scaling`` lists the steps, of ``minmax`` and ``standard``, in order.
    """
    assembler = VectorAssembler(inputCols=list(features), outputCol="v0", handleInvalid="skip")
    frame = assembler.transform(drop_incomplete(tracks, features))
    for i, step in enumerate(scaling):
        columns = {"inputCol": f"v{i}", "outputCol": f"v{i + 1}"}
        scaler = MinMaxScaler(**columns) if step == "minmax" else StandardScaler(withMean=True, withStd=True, **columns)
        frame = scaler.fit(frame).transform(frame).drop(f"v{i}")
    return stored(frame.withColumnRenamed(f"v{len(scaling)}", "features"))


def fit_clusters(
    vectors: DataFrame, k: int = 6, seed: int = 42, max_iter: int = 20, starts: int = 1
) -> KMeansModel:
    """K-Means; with several ``starts`` the fit of lowest cost is kept."""
    fits = [KMeans(k=k, seed=seed + i, maxIter=max_iter, predictionCol="cluster").fit(vectors) for i in range(starts)]
    return min(fits, key=lambda m: m.summary.trainingCost)


def track_clusters(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    return model.transform(vectors).select("track_id", "name", "artist_name", "genre", "cluster")


def cluster_profile(
    vectors: DataFrame, model: KMeansModel, features: Sequence[str] = TRACK_FEATURES, digits: int = 3
) -> DataFrame:
    """Size of each cluster and the mean of every feature in it, by falling size."""
    means = {f"mean_{f}": F.round(F.avg(f), digits) for f in features}
    sized = model.transform(vectors).groupBy("cluster").agg(F.count("*").alias("track_count"), *[m.alias(n) for n, m in means.items()])
    return sized.orderBy(F.desc("track_count"), "cluster")


def cluster_labels(
    model: KMeansModel, vectors: DataFrame, features: Sequence[str] = TRACK_FEATURES,
    labels: dict[int, str] | None = None,
) -> DataFrame:
    """(cluster, label): the given labels, else the feature each centre is highest in."""
    centres = model.clusterCenters()
    if labels is None:
        labels = {i: f"high {features[int(c.argmax())]}" for i, c in enumerate(centres)}
    rows = [(i, labels.get(i, "Unknown")) for i in range(len(centres))]
    return vectors.sparkSession.createDataFrame(rows, "cluster int, label string")


def silhouette(vectors: DataFrame, model: KMeansModel) -> DataFrame:
    clustered = model.transform(vectors)
    value = ClusteringEvaluator(predictionCol="cluster").evaluate(clustered)
    return vectors.sparkSession.createDataFrame([(model.getK(), float(value))], "k int, silhouette double")


def elbow(
    vectors: DataFrame, ks: Sequence[int] = range(2, 12), seed: int = 42, max_iter: int = 20, parallelism: int = 4
) -> DataFrame:
    """Within-cluster sum of squares for each number of clusters, several fits at a time."""
    spark = vectors.sparkSession

    def cost(k: int) -> tuple[int, float]:
        return k, float(fit_clusters(vectors, k, seed, max_iter).summary.trainingCost)

    with ThreadPoolExecutor(parallelism) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(cost), ks))
    return spark.createDataFrame(rows, "k int, inertia double")


def principal_components(vectors: DataFrame, k: int = 2) -> tuple[DataFrame, DataFrame]:
    """(track_id, pc1 …) of the centred vectors and (component, explained_variance)."""
    centred = StandardScaler(withMean=True, withStd=False, inputCol="features", outputCol="centred")
    frame = centred.fit(vectors).transform(vectors)
    model = PCA(k=k, inputCol="centred", outputCol="pcs").fit(frame)
    parts = vector_to_array("pcs")
    scores = model.transform(frame).select("track_id", *[parts[i].alias(f"pc{i + 1}") for i in range(k)])
    rows = [(i + 1, float(v)) for i, v in enumerate(model.explainedVariance)]
    return scores, vectors.sparkSession.createDataFrame(rows, "component int, explained_variance double")
