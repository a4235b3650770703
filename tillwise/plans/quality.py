"""Which product traits go with a good or poor price model: a decision tree."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TEXT = ["store", "calculation_group"]
NUMBERS = ["cannibalization_ind", "unique_prices", "total_qty", "avg_qty", "days_with_sales"]
LABEL = "r_squared_group_simple"
SPLIT = 1000
#: The deepest tree Spark grows; 5 is the depth of the tree for drawing.
FULL_DEPTH, DRAWN_DEPTH = 30, 5


def is_test_row(test_share: float = 0.2, seed: int = 42) -> Column:
    """Which side a product is on: its digest decides, so no recomputed task can move a row."""
    digest = F.md5(F.concat_ws("|", "store", "calculation_group", "product", F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % SPLIT < int(test_share * SPLIT)


def split_rows(comparison: DataFrame, test_share: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows."""
    on_test = is_test_row(test_share, seed)
    return comparison.filter(~on_test), comparison.filter(on_test)


def feature_names(comparison: DataFrame) -> list[str]:
    """Numbers first, then the levels of each text column but its first, in descending order."""
    names = list(NUMBERS)
    for column in TEXT:
        levels = sorted((r[0] for r in comparison.select(column).distinct().collect()), reverse=True)
        names += [f"{column}_{level}" for level in levels[:-1]]
    return names


def support(comparison: DataFrame) -> DataFrame:
    """Test rows of every label there is."""
    return comparison.groupBy(F.col(LABEL).alias("label")).agg(
        F.sum(is_test_row().cast("bigint")).alias("support")
    )


@dataclass(frozen=True)
class QualityTree:
    model: PipelineModel
    labels: tuple[str, ...]
    features: tuple[str, ...]

    def importances(self) -> DataFrame:
        """Importance of each encoded feature."""
        weights = self.model.stages[-1].featureImportances.toArray()
        rows = [(i, name, float(w)) for i, (name, w) in enumerate(zip(self.features, weights))]
        return SparkSession.active().createDataFrame(rows, "feature_idx int, feature string, importance double")

    def report(self, test: DataFrame) -> DataFrame:
        """Precision, recall, F1 and support per label, and their averages.

        Labels are those that occur in the test rows or are predicted for them;
        below them stand accuracy, macro avg and weighted avg.
        """
        predicted = F.element_at(F.array(*[F.lit(x) for x in self.labels]), F.col("prediction").cast("int") + 1)
        cells = (
            self.model.transform(test)
            .select(F.col(LABEL).alias("actual"), predicted.alias("predicted"))
            .groupBy("actual", "predicted")
            .agg(F.count(F.lit(1)).alias("n"))
        )
        hit = F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0)
        sides = cells.select(F.col("actual").alias("label"), hit.alias("hits"), F.col("n").alias("support"), F.lit(0).alias("guesses"))
        sides = sides.unionByName(cells.select(F.col("predicted").alias("label"), F.lit(0).alias("hits"), F.lit(0).alias("support"), F.col("n").alias("guesses")))
        sums = sides.groupBy("label").agg(*[F.sum(c).alias(c) for c in ("hits", "support", "guesses")])
        precision = F.coalesce(F.try_divide("hits", "guesses"), F.lit(0.0))
        recall = F.coalesce(F.try_divide("hits", "support"), F.lit(0.0))
        f1 = F.coalesce(F.try_divide(2 * precision * recall, precision + recall), F.lit(0.0))
        measures = {"precision": precision, "recall": recall, "f1": f1}
        per_label = sums.select("label", *[m.alias(n) for n, m in measures.items()], "support", "hits")
        everything = F.sum("support")
        macro = per_label.agg(F.lit("macro avg").alias("label"), *[F.avg(n).alias(n) for n in measures], everything.alias("support"))
        weighted = per_label.agg(
            F.lit("weighted avg").alias("label"),
            *[F.try_divide(F.sum(F.col(n) * F.col("support")), everything).alias(n) for n in measures],
            everything.alias("support"),
        )
        share = F.try_divide(F.sum("hits"), everything)
        accuracy = per_label.agg(F.lit("accuracy").alias("label"), *[share.alias(n) for n in measures], everything.alias("support"))
        return per_label.drop("hits").unionByName(accuracy).unionByName(macro).unionByName(weighted)


def fit_quality_tree(
    comparison: DataFrame, train: DataFrame, max_depth: int = FULL_DEPTH, seed: int = 42
) -> QualityTree:
    """Tree for the R-squared band, grown on ``train``.

    Levels and labels come from all rows of ``comparison``. The first level of a
    text column (in alphabetical order) is what the others are compared with and
    has no feature of its own, so a column with one level has none.
    """
    text = [c for c in TEXT if comparison.select(c).distinct().limit(2).count() > 1]
    label = StringIndexer(inputCol=LABEL, outputCol="__label", stringOrderType="alphabetAsc")
    # the encoder leaves out the last level: in descending order that is the first
    indexers = [StringIndexer(inputCol=c, outputCol=f"{c}_idx", stringOrderType="alphabetDesc") for c in text]
    vectors = [f"{c}_vec" for c in text]
    encoders = [OneHotEncoder(inputCols=[f"{c}_idx" for c in text], outputCols=vectors)] if text else []
    assembler = VectorAssembler(inputCols=[*NUMBERS, *vectors], outputCol="features", handleInvalid="keep")
    encoding = Pipeline(stages=[label, *indexers, *encoders, assembler]).fit(comparison)
    tree = DecisionTreeClassifier(labelCol="__label", featuresCol="features", maxDepth=max_depth, seed=seed)
    grown = tree.fit(encoding.transform(train))
    names = list(NUMBERS)
    for column, indexer in zip(text, encoding.stages[1:]):
        names += [f"{column}_{level}" for level in indexer.labels[:-1]]
    return QualityTree(PipelineModel([*encoding.stages, grown]), tuple(encoding.stages[0].labels), tuple(names))
