"""Boosted trees grown in stored rounds.

A round starts from the stored rows with their predictions so far, grows some trees on what is left to explain, and
stores the trees, the losses on the validation part after each tree, and the rows with their new predictions. A run
that was cut off goes on from its last complete round. Every round reads stored rows, so a run that was stopped and
resumed computes what an uninterrupted one does.

Growing stops after a round when the smallest validation loss is ``patience`` trees old.
"""

from __future__ import annotations

from pyspark.ml.regression import DecisionTreeRegressionModel, DecisionTreeRegressor, GBTRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripweave.operators.models import SEED, BestIteration, first_trees, trees_as_model
from tripweave.sources.files import Folder

COLUMNS = ["features", "label", "prediction"]


class Rounds:
    """What a boosting run has stored: ``round-N`` with trees, rows, validation rows and losses."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.folder = spark, Folder(spark, path)

    def path(self, number: int, part: str) -> str:
        return f"{self.folder.path}/round-{number}/{part}"

    def complete(self) -> int:
        """The last complete round, counted from 0, the start; -1 before that. Losses are stored last."""
        number = -1
        while self.folder.exists(f"{self.path(number + 1, 'losses')}/_SUCCESS"):
            number += 1
        return number

    def read(self, number: int, part: str) -> DataFrame:
        return self.spark.read.parquet(self.path(number, part))

    def losses(self) -> list[float]:
        found = []
        for number in range(1, self.complete() + 1):
            found += [r["loss"] for r in self.read(number, "losses").orderBy("tree").collect()]
        return found

    def trees(self, n: int) -> list[DecisionTreeRegressionModel]:
        """The first ``n`` trees."""
        found: list[DecisionTreeRegressionModel] = []
        number = 1
        while len(found) < n:
            inside = len(self.folder.names(self.path(number, "trees")))
            found += [DecisionTreeRegressionModel.load(self.path(number, f"trees/{i}")) for i in range(inside)]
            number += 1
        return found[:n]

    def store(self, number: int, trees: list, parts: dict[str, DataFrame], losses: list[float]) -> None:
        for i, tree in enumerate(trees):
            tree.write().overwrite().save(self.path(number, f"trees/{i}"))
        for name, part in parts.items():
            part.select(*COLUMNS).write.mode("overwrite").parquet(self.path(number, name))
        rows = self.spark.createDataFrame(list(enumerate(losses)), "tree int, loss double")
        rows.coalesce(1).write.mode("overwrite").parquet(self.path(number, "losses"))


def weight_of(tree: int, step: float) -> float:
    """The first tree counts whole, every other one by the step."""
    return 1.0 if tree == 0 else step


def grow_round(rounds: Rounds, number: int, first: int, n: int, step: float, depth: int, seed: int) -> None:
    """Grow ``n`` trees from the rows of the round before, and store them as a round."""
    parts = {name: rounds.read(number - 1, name) for name in ("rows", "validation")}
    trees = []
    for i in range(first, first + n):
        tree = DecisionTreeRegressor(
            featuresCol="features", labelCol="rest", predictionCol="grown", maxDepth=depth, seed=seed + i
        )
        rest = parts["rows"].select("features", (F.col("label") - F.col("prediction")).alias("rest"))
        trees.append(tree.fit(rest))
        for name, part in parts.items():
            more = F.lit(weight_of(i, step)) * F.col("grown")
            after = (F.col("prediction") + more).alias("prediction")
            others = [c for c in part.columns if c != "prediction"]
            parts[name] = trees[-1].transform(part).select(*others, after)
        error = (F.col("label") - F.col("prediction")) ** 2
        parts["validation"] = parts["validation"].withColumn(f"error_{i}", error)
    found = parts["validation"].agg(*[F.avg(f"error_{i}") for i in range(first, first + n)]).first()
    rounds.store(number, trees, parts, list(found))


def boost(
    train: DataFrame,
    validation: DataFrame,
    path: str,
    iterations: int = 20,
    per_round: int = 5,
    patience: int | None = None,
    step: float = 0.1,
    depth: int = 5,
    seed: int = SEED,
    most_rounds: int | None = None,
) -> BestIteration:
    """Grow up to ``iterations`` trees, going on from what ``path`` holds; the model of the smallest validation loss.

    Both parts have ``features`` and ``label``. ``most_rounds`` ends the run early, to be gone on with later.
    """
    spark = train.sparkSession
    rounds = Rounds(spark, path)
    if rounds.complete() < 0:
        begun = {name: p.withColumn("prediction", F.lit(0.0)) for name, p in (("rows", train), ("validation", validation))}
        rounds.store(0, [], begun, [])
    done = 0
    while most_rounds is None or done < most_rounds:
        losses = rounds.losses()
        if len(losses) >= iterations:
            break
        if patience is not None and losses and len(losses) - 1 - losses.index(min(losses)) >= patience:
            break
        n = min(per_round, iterations - len(losses))
        grow_round(rounds, rounds.complete() + 1, len(losses), n, step, depth, seed)
        done += 1
    losses = rounds.losses()
    trees = rounds.trees(len(losses))
    full = trees_as_model(spark, trees, [weight_of(i, step) for i in range(len(trees))])
    return BestIteration(first_trees(full, 1 + losses.index(min(losses)), spark), losses)


def loss_after(model: GBTRegressionModel, validation: DataFrame) -> list[float]:
    """The validation loss after each tree of a model, for comparison."""
    return list(model.evaluateEachIteration(validation.select("features", "label"), "squared"))
