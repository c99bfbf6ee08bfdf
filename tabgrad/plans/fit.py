"""Mini-batch training: the loop runs on the driver, every pass over data is a Spark job."""

from __future__ import annotations

import time
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tabgrad.functions.seeded import permuted_from
from tabgrad.operators.batching import BatchTable
from tabgrad.operators.layers import softmax
from tabgrad.operators.metrics import flag, loss_and_accuracy, score_samples
from tabgrad.operators.optim import momentum_update, update_biases, update_weights
from tabgrad.plans.forward import (
    checked_vector,
    choose_strategy,
    forward,
    gather_entries,
    gather_vectors,
    score_labelled,
)
from tabgrad.plans.kernels import Matrices
from tabgrad.plans.model import Model
from tabgrad.plans.step import gradient_blocks, labelled_samples, train_step, unflatten
from tabgrad.schema import BATCH_METRICS, HISTORY, known_elements
from tabgrad.sources.readers import features_from_vectors
from tabgrad.sources.store import ModelStore, discard, materialize, scratch_path, scratch_scope


HELD_STEPS = 1024


@dataclass(frozen=True)
class TrainConfig:
    """``shuffle`` is None, "batches" (their order) or "samples" (their membership), both seeded.

    ``validate_every`` 0 never validates. ``early_stopping`` is the number of validations without a
    better loss after which training ends.
    """

    epochs: int = 10
    batch_size: int = 16
    lr: float = 0.01
    momentum: float = 0.0
    shuffle: str | None = None
    validate_every: int = 1
    early_stopping: int | None = None
    seed: int = 42
    strategy: str = "auto"
    cache: bool = False
    store_path: str | None = None


@dataclass
class FitResult:
    model: Model
    history: DataFrame
    batch_metrics: DataFrame
    stopped_early: bool = False
    best_epoch: int | None = None


@dataclass
class _Progress:
    best_loss: float | None = None
    best_epoch: int | None = None
    waited: int = 0
    epochs: list[tuple] = field(default_factory=list)

    def note_validation(self, epoch: int, loss: float | None) -> None:
        if loss is None:
            return
        if self.best_loss is None or loss < self.best_loss:
            self.best_loss, self.best_epoch, self.waited = loss, epoch, 0
        else:
            self.waited += 1


class _StepLog:
    """Step metrics: a table that grows by ``HELD_STEPS`` rows at a time, and the sums of one epoch."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.path = scratch_path(spark, "batch_metrics")
        self.held: list[tuple] = []
        self.written = False
        self.start_epoch()

    def start_epoch(self) -> None:
        self.sums = np.zeros(6)

    def add(self, epoch: int, step: int, batch_num: int, n: int, loss: float, accuracy: float) -> None:
        self.sums += (1, n, loss, accuracy, loss * n, accuracy * n)
        self.held.append((epoch, step, batch_num, n, loss, accuracy))
        if len(self.held) >= HELD_STEPS:
            self.flush()

    def flush(self) -> None:
        if self.held:
            rows = self.spark.createDataFrame(self.held, BATCH_METRICS).coalesce(1)
            rows.write.mode("append").parquet(self.path)
            self.held, self.written = [], True

    def epoch_means(self) -> tuple[float, float, float, float]:
        """Mean loss and accuracy of the epoch's batches, plain and weighted by their size."""
        steps, n, loss, accuracy, weighted_loss, weighted_accuracy = self.sums.tolist()
        return loss / steps, accuracy / steps, weighted_loss / n, weighted_accuracy / n

    def table(self) -> DataFrame:
        if not self.written:
            return self.spark.createDataFrame(self.held, BATCH_METRICS)
        self.flush()
        return self.spark.read.schema(BATCH_METRICS).parquet(self.path)


def fit(
    train: DataFrame, model: Model, config: TrainConfig, validation: DataFrame | None = None
) -> FitResult:
    """Train on ``(sample_id, x, true_label)`` rows and return the model with its history.

    Rows may carry ``entries``, an array of ``(idx, value)``, in place of ``x``; see ``fit_features``.
    ``arrow`` broadcasts the model each step and brings back one summed gradient, the size of the
    model. ``hybrid`` and ``relational`` keep parameters in tables, one written version per step, and
    free what a step has written. A failing step fails the run. With ``store_path`` each epoch's
    model is committed as a version. The order of batches is computed step by step, and step metrics
    go to a table in parts, so the driver holds nothing that grows with the number of batches.
    """
    spark = train.sparkSession
    strategy = _checked_strategy(model, config)
    trainer = _ArrowTrainer(model, config) if strategy == "arrow" else _TableTrainer(model, config, strategy)
    store = ModelStore(spark, config.store_path) if config.store_path else None
    progress, log = _Progress(), _StepLog(spark)
    stopped = False
    table = None
    try:
        for epoch in range(1, config.epochs + 1):
            started = time.monotonic()
            if table is None or config.shuffle == "samples":
                _release(table, config)
                seed = config.seed if config.shuffle == "samples" else None
                table = BatchTable(train, config.batch_size, seed, epoch)
                if config.cache:
                    table.table.persist()
            log.start_epoch()
            for step in range(table.n_batches):
                batch_num = step
                if config.shuffle == "batches":
                    batch_num = permuted_from(step, table.n_batches, config.seed, epoch)
                log.add(epoch, step, batch_num, *trainer.step(table.read(batch_num)))
            elapsed = time.monotonic() - started
            val_loss = val_accuracy = None
            if validation is not None and config.validate_every and epoch % config.validate_every == 0:
                val_loss, val_accuracy = validate(validation, trainer.model()).first()
                progress.note_validation(epoch, val_loss)
            progress.epochs.append((epoch, *log.epoch_means(), val_loss, val_accuracy, elapsed))
            if store is not None:
                store.save(trainer.model().params, trainer.model().biases)
            if config.early_stopping and progress.waited >= config.early_stopping:
                stopped = True
                break
    finally:
        _release(table, config)
        trainer.close()
    return FitResult(
        trainer.model(),
        spark.createDataFrame(progress.epochs, HISTORY),
        log.table(),
        stopped,
        progress.best_epoch,
    )


def _checked_strategy(model: Model, config: TrainConfig) -> str:
    strategy = choose_strategy(model) if config.strategy == "auto" else config.strategy
    if strategy not in ("arrow", "hybrid", "relational"):
        raise ValueError(f"unknown training strategy {strategy!r}")
    if config.shuffle not in (None, "batches", "samples"):
        raise ValueError(f"unknown shuffle {config.shuffle!r}")
    return strategy


def fit_features(
    features: DataFrame,
    labels: DataFrame,
    model: Model,
    config: TrainConfig,
    validation: tuple[DataFrame, DataFrame] | None = None,
) -> FitResult:
    """Train from long tables: ``(sample_id, idx, value)`` and ``(sample_id, true_label)``.

    The elements of a sample are gathered once and written, so that a batch is a range of samples;
    ``validation`` is such a pair of tables, gathered once as well, or the same pair. What was
    written is deleted at the end.
    """
    spark = features.sparkSession
    strategy = _checked_strategy(model, config)
    written: list[str] = []

    def rows(pair: tuple[DataFrame, DataFrame]) -> DataFrame:
        if strategy == "arrow":
            samples = gather_vectors(pair[0], model.layers[0])
        else:
            samples = gather_entries(known_elements(pair[0], model.layers[0]))
        written.append(scratch_path(spark, "samples"))
        return materialize(labelled_samples(samples, pair[1], model.n_classes), path=written[-1])

    if not 0 < abs(config.validate_every) <= config.epochs:
        validation = None  # never read
    try:
        train = rows((features, labels))
        if validation is not None:
            same = validation[0] is features and validation[1] is labels
            validation = train if same else rows(validation)
        return fit(train, model, config, validation)
    finally:
        for path in written:
            discard(spark, path)


def _elements(rows: DataFrame, model: Model) -> DataFrame:
    """Feature rows of samples that carry ``x`` or ``entries``."""
    if "entries" in rows.columns:
        return rows.select("sample_id", F.explode("entries").alias("_e")).select("sample_id", "_e.idx", "_e.value")
    return features_from_vectors(rows, "sample_id", checked_vector("x", model.layers[0]))


def batch_order(spark: SparkSession, n_batches: int, seed: int, epoch: int) -> list[int]:
    """The order that ``shuffle_batches`` gives the batches of an epoch, as a list for inspection."""
    return [permuted_from(step, n_batches, seed, epoch) for step in range(n_batches)]


def _release(table: BatchTable | None, config: TrainConfig) -> None:
    """Free a batch table that no later step reads."""
    if table is not None:
        if config.cache:
            table.table.unpersist()
        table.discard()


class _ArrowTrainer:
    """Holds the dense model on the driver; its size is checked by ``Model.matrices``."""

    def __init__(self, model: Model, config: TrainConfig):
        self.spark = model.params.sparkSession
        self.config = config
        self.matrices: Matrices = model.matrices()
        self.velocity = [(np.zeros_like(w), np.zeros_like(b)) for w, b in self.matrices]

    def step(self, batch: DataFrame) -> tuple[int, float, float]:
        shared = self.spark.sparkContext.broadcast(self.matrices)
        blocks = gradient_blocks(batch, shared).toArrow().sort_by("block")
        shared.destroy()
        n, loss, correct = (sum(blocks[c].to_pylist()) for c in ("n", "loss_sum", "correct"))
        flat = np.concatenate([chunk.flatten().to_numpy() for chunk in blocks["grad"].chunks]) / n
        self.matrices = [
            self._move(k, current, grads)
            for k, (current, grads) in enumerate(zip(self.matrices, unflatten(flat, self.matrices)))
        ]
        return n, loss / n, correct / n

    def _move(self, k: int, current, grads):
        if self.config.momentum:
            grads = tuple(self.config.momentum * v + g for v, g in zip(self.velocity[k], grads))
            self.velocity[k] = grads
        return tuple(p - self.config.lr * g for p, g in zip(current, grads))

    def model(self) -> Model:
        return Model.from_matrices(self.spark, self.matrices)

    def close(self) -> None:
        pass


class _TableTrainer:
    """Holds the model in versioned tables, for models that no single task should hold."""

    def __init__(self, model: Model, config: TrainConfig, strategy: str):
        self.spark = model.params.sparkSession
        self.current = model
        self.config = config
        self.strategy = strategy
        self.velocity: list[DataFrame | None] = [None, None]
        self.written: list[str] = []

    def step(self, batch: DataFrame) -> tuple[int, float, float]:
        paths = [scratch_path(self.spark, name) for name in ("params", "biases", "velocity", "velocity")]
        with scratch_scope(self.spark):
            labels = batch.select("sample_id", "true_label")
            step = train_step(_elements(batch, self.current), labels, self.current, self.strategy)
            metrics = step.metrics.first()
            n = batch.count()
            tables = (self.current.params, self.current.biases)
            grads = (step.weight_grads, step.bias_grads)
            moved = [self._move(k, *pair, value) for k, (*pair, value) in enumerate(zip(tables, grads, "wb"))]
            params, biases = (materialize(df.drop("velocity"), path=path) for df, path in zip(moved, paths))
            if self.config.momentum:
                self.velocity = [
                    materialize(df.drop("w", "b"), path=path) for df, path in zip(moved, paths[2:])
                ]
        self._free()
        self.written = paths if self.config.momentum else paths[:2]
        self.current = Model(self.current.layers, params, biases)
        return n, metrics["loss"], metrics["accuracy"]

    def _move(self, k: int, table: DataFrame, grads: DataFrame, value: str) -> DataFrame:
        lr, momentum = self.config.lr, self.config.momentum
        if momentum:
            moved = momentum_update(table, self.velocity[k], grads, lr, momentum, value)
            return materialize(moved, "moved")
        return (update_weights if value == "w" else update_biases)(table, grads, lr)

    def _free(self) -> None:
        """Delete the tables of the step before."""
        for path in self.written:
            discard(self.spark, path)
        self.written = []

    def model(self) -> Model:
        return self.current

    def close(self) -> None:
        """Delete what is not the model."""
        for path in self.written[2:]:
            discard(self.spark, path)


def validate(rows: DataFrame, model: Model, strategy: str = "auto") -> DataFrame:
    """One row ``(loss, accuracy)`` over ``(x, true_label)`` rows: a scan and one small aggregate.

    Rows with ``entries`` in place of ``x`` are scored by the joins of ``forward``.
    """
    if "entries" in rows.columns:
        logits = forward(_elements(rows, model), model)
        return loss_and_accuracy(score_samples(softmax(logits), rows.select("sample_id", "true_label")))
    return loss_and_accuracy(score_labelled(rows, model, strategy))


def epoch_metrics(batch_metrics: DataFrame) -> DataFrame:
    """Mean batch loss and accuracy per epoch, unweighted and weighted by batch size."""
    weighted = F.sum(F.col("loss") * F.col("n")) / F.sum("n")
    weighted_accuracy = F.sum(F.col("accuracy") * F.col("n")) / F.sum("n")
    return batch_metrics.groupBy("epoch").agg(
        F.avg("loss").alias("train_loss"),
        F.avg("accuracy").alias("train_accuracy"),
        weighted.alias("weighted_loss"),
        weighted_accuracy.alias("weighted_accuracy"),
    )


def best_epoch(history: DataFrame) -> DataFrame:
    """Mark epochs whose validation loss beats every earlier one. History has one row per epoch."""
    earlier = Window.orderBy("epoch").rowsBetween(Window.unboundedPreceding, -1)
    best_before = F.min("val_loss").over(earlier)
    improved = F.col("val_loss").isNotNull() & (best_before.isNull() | (F.col("val_loss") < best_before))
    return history.select("epoch", "val_loss", flag(improved).alias("is_best"))


def history_summary(history: DataFrame) -> DataFrame:
    return history.agg(
        F.count(F.lit(1)).alias("epochs"),
        F.sum("time").alias("total_time"),
        F.avg("time").alias("mean_time"),
        F.min("val_loss").alias("best_val_loss"),
        F.max_by("train_loss", "epoch").alias("final_train_loss"),
        F.max_by("train_accuracy", "epoch").alias("final_train_accuracy"),
    )
