"""Text classification with Spark ML: features, five classifiers, comparison, scoring."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.ml import classification as K
from pyspark.ml import feature as FT
from pyspark.ml.feature import StringIndexerModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomstat.constants import TREE_SEED
from loomstat.functions.nested import label_map
from loomstat.functions.text import clean_text
from loomstat.operators.metrics import classification_metrics
from loomstat.session import durable


TOKEN_COLUMNS = ("terms", "ngrams")
# Vectors of a file. A tree learner keeps 4 bytes for each feature of a vector, 80 KB where there are 20,000.
VECTOR_ROWS = 4096
# Vectors that a task of a linear learner passes over: it keeps them sparse, 12 bytes for each feature that a text has.
PASS_ROWS = 1 << 15
TREES = (K.DecisionTreeClassifier, K.RandomForestClassifier)


@dataclass(frozen=True)
class TextFeatures:
    """How text becomes a vector and which column is the class.

    ``vocabulary`` "hashed" counts tokens and n-grams in ``buckets`` hash buckets each; "counted" keeps the
    ``buckets`` most frequent terms that occur in ``min_df`` documents. Both are weighted by inverse document
    frequency. ``invalid_labels`` "keep" adds a class for unseen labels, "skip" drops such rows.
    """

    text: str = "clean_text"
    label: str = "Sentiment"
    vocabulary: str = "hashed"
    buckets: int = 10_000
    min_df: int = 3
    ngram: int = 2
    invalid_labels: str = "keep"

    def token_stages(self) -> list:
        if self.vocabulary == "hashed":
            tokenizer = FT.Tokenizer(inputCol=self.text, outputCol="tokens")
        else:
            tokenizer = FT.RegexTokenizer(inputCol=self.text, outputCol="tokens", pattern=r"\s+")
        return [
            tokenizer,
            FT.StopWordsRemover(inputCol="tokens", outputCol="terms"),
            FT.NGram(n=self.ngram, inputCol="terms", outputCol="ngrams"),
        ]

    def count_stages(self) -> list:
        """Tokens and n-grams to count vectors: fixed hash buckets, or a vocabulary that has to be fitted."""
        if self.vocabulary == "hashed":
            return [FT.HashingTF(numFeatures=self.buckets, inputCol=c, outputCol=f"{c}_tf") for c in TOKEN_COLUMNS]
        return [
            FT.CountVectorizer(vocabSize=self.buckets, minDF=self.min_df, inputCol=c, outputCol=f"{c}_tf")
            for c in TOKEN_COLUMNS
        ]

    def weight_stages(self) -> list:
        rare = self.min_df if self.vocabulary == "hashed" else 0
        weighted = [f"{c}_tfidf" for c in TOKEN_COLUMNS]
        stages = [
            FT.IDF(minDocFreq=rare, inputCol=f"{c}_tf", outputCol=out) for c, out in zip(TOKEN_COLUMNS, weighted)
        ]
        return [*stages, FT.VectorAssembler(inputCols=weighted, outputCol="features")]

    def label_stage(self):
        return FT.StringIndexer(inputCol=self.label, outputCol="label", handleInvalid=self.invalid_labels)

    def stages(self) -> list:
        return [*self.token_stages(), *self.count_stages(), *self.weight_stages(), self.label_stage()]


def logistic_regression(max_iter: int = 50, reg: float = 0.05, elastic_net: float = 0.0) -> Estimator:
    return K.LogisticRegression(maxIter=max_iter, regParam=reg, elasticNetParam=elastic_net)


def linear_svm(max_iter: int = 600, reg: float = 0.01, parallelism: int = 3) -> Estimator:
    """One linear support vector machine per class against the rest, fitted side by side.

    600 iterations at most, as in the published comparison; each is a pass over the vectors.
    """
    return K.OneVsRest(classifier=K.LinearSVC(maxIter=max_iter, regParam=reg), parallelism=parallelism)


def naive_bayes(smoothing: float = 1.0) -> Estimator:
    return K.NaiveBayes(smoothing=smoothing, modelType="multinomial")


def decision_tree(max_depth: int = 6, seed: int = TREE_SEED) -> Estimator:
    return K.DecisionTreeClassifier(maxDepth=max_depth, seed=seed)


def random_forest(trees: int = 100, max_depth: int = 7, seed: int = TREE_SEED) -> Estimator:
    return K.RandomForestClassifier(numTrees=trees, maxDepth=max_depth, seed=seed)


def neural_network(layers: list[int], max_iter: int = 60, seed: int = TREE_SEED) -> Estimator:
    return K.MultilayerPerceptronClassifier(layers=layers, maxIter=max_iter, seed=seed)


CLASSIFIERS: dict[str, Callable[[], Estimator]] = {
    "Linear SVM (OvR)": linear_svm,
    "Logistic Regression": logistic_regression,
    "Naive Bayes": naive_bayes,
    "Random Forest": random_forest,
    "Decision Tree": decision_tree,
}


def text_pipeline(classifier: Estimator, features: TextFeatures = TextFeatures()) -> Pipeline:
    return Pipeline(stages=[*features.stages(), classifier])


def stored_vectors(rows: DataFrame) -> DataFrame:
    """``features, label`` of ``rows``, written without the names of single features.

    The assembler names each of them in the column's metadata, some 45 bytes apiece, and all plans above it carry these
    to every task of every pass. The number of features stays. Files are of few rows, so that a task never holds many.
    """
    known = rows.schema["features"].metadata.get("ml_attr", {})
    group = {"ml_attr": {"num_attrs": known["num_attrs"]}} if "num_attrs" in known else {}
    return durable(rows.select(F.col("features").alias("features", metadata=group), "label"), "vectors", file_rows=VECTOR_ROWS)


def featurize(train: DataFrame, features: TextFeatures = TextFeatures()) -> tuple[PipelineModel, DataFrame]:
    """Fitted feature stages and the training vectors.

    Text is tokenised once: the stages that need no fitting run first, their result is written, and every fit reads the
    written table. The vectors are written in turn, so that learners that pass over them many times do not weigh them
    again.
    """
    fixed = features.token_stages()
    columns = [*TOKEN_COLUMNS, features.label]
    if features.vocabulary == "hashed":
        fixed += features.count_stages()
        columns = [*[f"{c}_tf" for c in TOKEN_COLUMNS], features.label]
        fitted_stages = features.weight_stages()
    else:
        fitted_stages = [*features.count_stages(), *features.weight_stages()]
    counted = durable(PipelineModel(fixed).transform(train).select(*columns), "features")
    fitted = Pipeline(stages=[*fitted_stages, features.label_stage()]).fit(counted)
    return PipelineModel([*fixed, *fitted.stages]), stored_vectors(fitted.transform(counted))


def fit(classifier: Estimator, vectors: DataFrame):
    """``classifier`` fitted on stored vectors.

    Every pass of a linear learner sends its weights to each task and gets a sum as long as they are from it, and makes
    hundreds of passes. So its tasks are as many as the cores, or one for ``PASS_ROWS`` vectors, not one per file. Trees
    keep dense rows and read the files as they are.
    """
    if not isinstance(classifier, TREES):
        cores = vectors.sparkSession.sparkContext.defaultParallelism
        vectors = vectors.coalesce(max(cores, -(-vectors.count() // PASS_ROWS)))
    return classifier.fit(vectors)


def train(
    data: DataFrame, classifier: Estimator, features: TextFeatures = TextFeatures()
) -> PipelineModel:
    """Fit features and classifier on ``data``."""
    feature_model, vectors = featurize(data, features)
    return PipelineModel([*feature_model.stages, fit(classifier, vectors)])


def compare_models(
    train_rows: DataFrame,
    test_rows: DataFrame,
    classifiers: dict[str, Callable[[], Estimator]] = CLASSIFIERS,
    features: TextFeatures = TextFeatures(),
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Metrics of every classifier on the test rows, best F1 first, and the fitted models by name.

    The features are fitted and computed once for all classifiers; each model's four metrics come from one
    aggregate over its predictions.
    """
    spark = train_rows.sparkSession
    feature_model, vectors = featurize(train_rows, features)
    test = stored_vectors(feature_model.transform(test_rows))
    models, rows = {}, []
    for name, make in classifiers.items():
        fitted = fit(make(), vectors)
        models[name] = PipelineModel([*feature_model.stages, fitted])
        metrics = classification_metrics(fitted.transform(test).select("label", "prediction")).first()
        rows.append((name, *metrics))
    schema = "model string, accuracy double, f1 double, weightedPrecision double, weightedRecall double"
    table = spark.createDataFrame(rows, schema)  # one row per classifier
    return table.orderBy(F.desc("f1"), "model"), models


def best_model(metrics: DataFrame, models: dict[str, PipelineModel]) -> tuple[str, PipelineModel]:
    name = metrics.orderBy(F.desc("f1"), "model").first()["model"]
    return name, models[name]


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def class_names(model: PipelineModel) -> list[str]:
    """Class names in index order, from the label stage."""
    return next(stage.labels for stage in model.stages if isinstance(stage, StringIndexerModel))


def score_rows(
    model: PipelineModel, rows: DataFrame, *, text: str = "text", model_name: str = "model",
    labels: Iterable[str] | None = None,
) -> DataFrame:
    """Unlabelled ``rows`` with ``predicted_sentiment``, ``prediction_index``, ``model_name`` and ``scored_at``.

    The label stage is left out. Text is cleaned the way the training text was.
    """
    names = list(labels) if labels is not None else class_names(model)
    scorer = PipelineModel([s for s in model.stages if not isinstance(s, StringIndexerModel)])
    scored = scorer.transform(rows.withColumn("clean_text", clean_text(F.col(text))))
    index = F.col("prediction").cast("int")
    return scored.select(
        *rows.columns,
        label_map(dict(enumerate(names)))[index].alias("predicted_sentiment"),
        index.alias("prediction_index"),
        F.lit(model_name).alias("model_name"),
        F.current_timestamp().alias("scored_at"),
    )
