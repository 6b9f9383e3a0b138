"""Labelled-sheet cleaning and a trainable text classifier.

Fine-tuning a transformer is re-aimed at Spark ML: tokenise -> hashed term
frequencies -> IDF -> multinomial logistic regression, trained and evaluated
on executors. The labelled sample plays the reference's spreadsheet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skein.functions import dims
from skein.functions.text import clean_post, label_text


def clean_labelled(df: DataFrame, label_col: str = "manual classification") -> DataFrame:
    """M5: class "Researchers" -> "environmental research" (only the class column;
    the reference overwrote whole rows), posts cleaned (X7), token text built (P12)."""
    lab = F.col(f"`{label_col}`")
    return df.withColumn(label_col, F.when(lab == "Researchers", F.lit("environmental research")).otherwise(lab)) \
        .withColumn("tweets", clean_post("tweets")) \
        .withColumn("token", label_text("description", "tweets"))


def label_index(label: Column, labels: list[str] = dims.FINETUNE_LABELS) -> Column:
    """M6: label -> its position in the label list; unknown -> null."""
    pos = F.array_position(dims.lit_array(labels), label)
    return F.when(pos > 0, (pos - 1).cast("int"))


def train_text_classifier(df: DataFrame, text: str, label: str, test_share: float = 0.2, seed: int = 42,
                          key: str = "doc_id", num_features: int = 1 << 16, max_iter: int = 30, labels: list[str] | None = None,
                          save_to: str | None = None):
    """M7: train on a hash split, evaluate on the held-out part.

    ``label`` is a number, or with ``labels`` a text that is indexed by its place in the list (M6; others take no part).
    ``save_to`` keeps the fitted pipeline and the list at any Hadoop URI, from where ``load_text_classifier`` reads it.
    Returns (fitted pipeline model, metrics DataFrame with accuracy, f1 and the accuracy of always giving the
    training part's most frequent label).
    """
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.evaluation import MulticlassClassificationEvaluator
    from pyspark.ml.feature import HashingTF, IDF, RegexTokenizer

    from skein.operators.analysis import train_test_split

    number = F.col(label).cast("double") if labels is None else label_index(F.col(label), labels).cast("double")
    data = df.select(key, F.coalesce(F.col(text), F.lit("")).alias("__text"), number.alias("label")) \
        .filter(F.col("label").isNotNull())
    train, test = train_test_split(data, test_share, seed, key)
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="__text", outputCol="__tok", pattern=r"\s+", toLowercase=True),
        HashingTF(inputCol="__tok", outputCol="__tf", numFeatures=num_features),
        IDF(inputCol="__tf", outputCol="features"),
        LogisticRegression(maxIter=max_iter, regParam=0.01, featuresCol="features", labelCol="label"),
    ])
    model = pipe.fit(train)
    pred = model.transform(test)
    acc = MulticlassClassificationEvaluator(metricName="accuracy").evaluate(pred)
    f1 = MulticlassClassificationEvaluator(metricName="f1").evaluate(pred)
    spark = df.sparkSession
    sizes = train.groupBy("label").count().join(
        test.groupBy("label").agg(F.count(F.lit(1)).alias("held")), "label", "full_outer") \
        .select("label", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("count", "held")])
    top = sizes.agg(F.sum("count").alias("n_train"), F.sum("held").alias("n_test"),
                    F.max_by("held", F.struct("count", -F.col("label"))).alias("major")).first()
    metrics = spark.createDataFrame([(float(acc), float(f1), top["major"] / max(top["n_test"], 1), top["n_train"], top["n_test"])],
                                    "accuracy DOUBLE, f1 DOUBLE, majority_accuracy DOUBLE, n_train BIGINT, n_test BIGINT")
    if save_to:
        model.write().overwrite().save(f"{save_to.rstrip('/')}/model")
        spark.createDataFrame([(labels,)], "labels ARRAY<STRING>").write.mode("overwrite").parquet(f"{save_to.rstrip('/')}/labels")
    return model, metrics


def load_text_classifier(spark: SparkSession, path: str):
    """(model, labels or None) as ``train_text_classifier`` saved them."""
    from pyspark.ml import PipelineModel
    return (PipelineModel.load(f"{path.rstrip('/')}/model"),
            spark.read.parquet(f"{path.rstrip('/')}/labels").first()["labels"])


def predict_labels(df: DataFrame, text: str, model, labels: list[str] | None = None, out: str = "predicted") -> DataFrame:
    """Every row with the model's label (its name where there is a list) and the probability of it; a null text is empty."""
    from pyspark.ml.functions import vector_to_array

    narrow = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("__row"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    found = model.transform(narrow)
    name = F.get(dims.lit_array(labels), F.col("prediction").cast("int")) if labels else F.col("prediction")
    kept = [F.col("__row")[c].alias(c) for c in df.columns if c != out]
    return found.select(*kept, name.alias(out), F.array_max(vector_to_array("probability")).alias(f"{out}_probability"))
