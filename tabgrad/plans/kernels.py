"""Arrow-batched matrix kernels that run inside tasks."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle

# Ship these functions with the task, so that executors need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

Matrices = Sequence[tuple[np.ndarray, np.ndarray]]

GRADIENT_SCHEMA = "block int, slice int, n bigint, loss_sum double, correct bigint, grad array<double>"
LOG_FLOOR = 1e-10
VECTOR_BYTES = 8 << 20  # vectors that a gathering task holds at once


def to_matrix(column: pa.Array, width: int) -> np.ndarray:
    """``list<double>`` column as an (n, width) matrix, without copying elements; NULL becomes 0.0."""
    lengths = pc.list_value_length(column)
    if column.null_count or pc.any(pc.not_equal(lengths, width)).as_py():
        raise ValueError(f"every sample needs a vector of {width} elements")
    flat = column.flatten()
    if flat.null_count:
        flat = flat.fill_null(0.0)
    return np.asarray(flat.cast(pa.float64())).reshape(len(column), width)


def place_entries(
    idx: pa.Array, value: pa.Array, width: int, owner: np.ndarray | None = None
) -> np.ndarray:
    """Lists of (idx, value) per sample as an (n, width) matrix; gaps are 0.0, repeats are summed.

    ``owner`` is each list's row of the matrix, ascending, where samples have several lists.
    """
    owner = np.arange(len(idx)) if owner is None else owner
    n = int(owner[-1]) + 1 if len(owner) else 0
    rows = np.repeat(owner, np.asarray(pc.list_value_length(idx)))
    columns = np.asarray(idx.flatten()).astype(np.int64)
    values = value.flatten()
    values = np.asarray(values.fill_null(0.0) if values.null_count else values)
    inside = (columns >= 0) & (columns < width)
    if not inside.all():
        rows, columns, values = rows[inside], columns[inside], values[inside]
    flat = np.bincount(rows * width + columns, weights=values, minlength=n * width)
    return flat.reshape(n, width)


def to_lists(matrix: np.ndarray) -> pa.Array:
    n, width = matrix.shape
    offsets = np.arange(0, (n + 1) * width, width, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.ascontiguousarray(matrix).ravel()))


def run_layers(x: np.ndarray, matrices: Matrices) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Inputs of every layer and pre-activations of every layer."""
    inputs, pre = [], []
    for layer, (w, b) in enumerate(matrices):
        inputs.append(x)
        z = x @ w.T + b
        pre.append(z)
        if layer < len(matrices) - 1:
            x = np.maximum(z, 0.0)
    return inputs, pre


def partial_products(
    batches: Iterator[pa.RecordBatch], weights_by_input: np.ndarray, block_width: int
) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch and sample, ``SUM(value * weights_by_input[idx])`` over the batch's elements.

    One row for each block of ``block_width`` outputs, the last filled up with zeros, so memory
    follows the block and not the layer. Elements outside the layer and NULL values add nothing. A
    sample that spans batches gives several rows, to be summed after the shuffle.
    """
    width = weights_by_input.shape[1]
    for batch in batches:
        samples = np.asarray(batch.column("sample_id"))
        idx = np.asarray(batch.column("idx")).astype(np.int64)
        value = batch.column("value")
        value = np.asarray(value.fill_null(0.0) if value.null_count else value)
        inside = (idx >= 0) & (idx < len(weights_by_input))
        if not inside.all():
            samples, idx, value = samples[inside], idx[inside], value[inside]
        if not len(samples):
            continue
        if (np.diff(samples) < 0).any():
            order = np.argsort(samples, kind="stable")
            samples, idx, value = samples[order], idx[order], value[order]
        starts = np.append(0, np.flatnonzero(np.diff(samples)) + 1)
        owners = pa.array(samples[starts])
        for block, at in enumerate(range(0, width, block_width)):
            products = value[:, None] * weights_by_input[idx, at : at + block_width]
            sums = np.add.reduceat(products, starts, axis=0)
            sums = np.pad(sums, ((0, 0), (0, block_width - sums.shape[1])))
            yield pa.RecordBatch.from_arrays(
                [owners, pa.array(np.full(len(starts), block, np.int32)), to_lists(sums)],
                names=["sample_id", "block", "ws"],
            )


def partial_entries(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Per Arrow batch and sample, the elements as lists ``(sample_id, idx, value)``, repeats summed.

    Elements lie inside the layer and are not NULL. A sample that spans batches gives several rows.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        samples = batch.column("sample_id").dictionary_encode("encode")
        key = np.asarray(samples.indices).astype(np.int64) * width + np.asarray(batch.column("idx"))
        value = np.asarray(batch.column("value"))
        if (np.diff(key) <= 0).any():
            order = np.argsort(key, kind="stable")
            key, value = key[order], value[order]
            firsts = np.append(0, np.flatnonzero(np.diff(key)) + 1)
            key, value = key[firsts], np.add.reduceat(value, firsts)
        owner = key // width
        # Every number of the dictionary occurs, so the runs are its samples in their order.
        starts = np.flatnonzero(np.diff(owner, prepend=-1))
        offsets = pa.array(np.append(starts, len(owner)).astype(np.int32))
        idx = pa.array((key - owner * width).astype(np.int32))
        yield pa.RecordBatch.from_arrays(
            [
                samples.dictionary,
                pa.ListArray.from_arrays(offsets, idx),
                pa.ListArray.from_arrays(offsets, pa.array(value)),
            ],
            names=["sample_id", "idx", "value"],
        )


def merge_entries(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """``(sample_id, x)`` from rows of ``partial_entries`` that arrive sorted by sample.

    Holds one sample's sum and ``VECTOR_BYTES`` of others, however many rows a sample has.
    """
    at_once = max(1, VECTOR_BYTES // (8 * width))
    held = None

    def vectors(ids: pa.Array, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([ids, to_lists(x)], names=["sample_id", "x"])

    for batch in batches:
        if not batch.num_rows:
            continue
        samples = batch.column("sample_id").dictionary_encode("encode")
        ids, owner = samples.dictionary, np.asarray(samples.indices).astype(np.int64)
        edges = np.append(np.flatnonzero(np.diff(owner, prepend=-1)), len(owner))
        for low in range(0, len(ids), at_once):
            high = min(low + at_once, len(ids))
            start, end = int(edges[low]), int(edges[high])
            part = batch.slice(start, end - start)
            x = place_entries(part.column("idx"), part.column("value"), width, owner[start:end] - low)
            if held is not None:
                if held[0].equals(ids.slice(low, 1)):
                    x[0] += held[1][0]
                else:
                    yield vectors(*held)
            held = ids.slice(high - 1, 1), x[-1:].copy()
            if high - low > 1:
                yield vectors(ids.slice(low, high - low - 1), x[:-1])
    if held is not None:
        yield vectors(*held)


def softmax_rows(logits: np.ndarray) -> np.ndarray:
    shifted = np.exp(logits - logits.max(axis=1, keepdims=True))
    return shifted / shifted.sum(axis=1, keepdims=True)


def predict_rows(logits: np.ndarray) -> pa.StructArray:
    """Prediction, its logit and its probability per row; ties go to the lowest class."""
    prediction = logits.argmax(axis=1)
    rows = np.arange(len(logits))
    return pa.StructArray.from_arrays(
        [
            pa.array(prediction.astype(np.int32)),
            pa.array(logits[rows, prediction]),
            pa.array(softmax_rows(logits)[rows, prediction]),
        ],
        names=["prediction", "logit", "probability"],
    )


def grade_rows(logits: np.ndarray, label: pa.Array) -> pa.StructArray:
    """Prediction and probability of the true class per row, NULL where the label is no class."""
    labels = np.asarray(label.fill_null(-1))
    known = (labels >= 0) & (labels < logits.shape[1])
    p_true = softmax_rows(logits)[np.arange(len(logits)), np.where(known, labels, 0)]
    return pa.StructArray.from_arrays(
        [pa.array(logits.argmax(axis=1).astype(np.int32)), pa.array(p_true, mask=~known)],
        names=["prediction", "p_true"],
    )


def batch_statistics(probabilities: np.ndarray, labels: np.ndarray) -> tuple[float, int]:
    """Sum of clamped cross-entropy losses and number of top-1 hits."""
    p_true = probabilities[np.arange(len(labels)), labels]
    loss = -np.log(np.maximum(p_true, LOG_FLOOR)).sum()
    return float(loss), int((probabilities.argmax(axis=1) == labels).sum())


def gradient_sums(
    x: np.ndarray, labels: np.ndarray, matrices: Matrices
) -> tuple[np.ndarray, float, int]:
    """Flat gradient sum (W then b, layer by layer), loss sum and hits of one Arrow batch."""
    inputs, pre = run_layers(x, matrices)
    probabilities = softmax_rows(pre[-1])
    loss, correct = batch_statistics(probabilities, labels)
    delta = probabilities
    delta[np.arange(len(labels)), labels] -= 1.0
    parts = []
    for layer in range(len(matrices) - 1, -1, -1):
        parts.append(delta.sum(axis=0))
        parts.append((delta.T @ inputs[layer]).ravel())
        if layer:
            delta = np.where(pre[layer - 1] > 0, delta @ matrices[layer][0], 0.0)
    return np.concatenate(parts[::-1]), loss, correct


def hidden_deltas(z: np.ndarray, labels: np.ndarray, tail: Matrices) -> np.ndarray:
    """Gradient with respect to ``z``, the pre-activations that feed the layers ``tail`` through ReLU."""
    _, pre = run_layers(np.maximum(z, 0.0), tail)
    delta = softmax_rows(pre[-1])
    delta[np.arange(len(labels)), labels] -= 1.0
    for layer in range(len(tail) - 1, 0, -1):
        delta = np.where(pre[layer - 1] > 0, delta @ tail[layer][0], 0.0)
    return np.where(z > 0, delta @ tail[0][0], 0.0)


def partial_gradients(
    batches: Iterator[pa.RecordBatch], matrices: Matrices, block_size: int
) -> Iterator[pa.RecordBatch]:
    """Sum gradients over a whole partition, then emit them once, cut into blocks."""
    width = matrices[0][0].shape[1]
    n_classes = matrices[-1][0].shape[0]
    total, n, loss_sum, hits = None, 0, 0.0, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        labels = np.asarray(batch.column("true_label"))
        if batch.column("true_label").null_count or labels.min() < 0 or labels.max() >= n_classes:
            raise ValueError(f"labels must be in 0..{n_classes - 1}")
        grad, loss, correct = gradient_sums(to_matrix(batch.column("x"), width), labels, matrices)
        total = grad if total is None else total + grad
        n, loss_sum, hits = n + batch.num_rows, loss_sum + loss, hits + correct
    if total is not None:
        yield gradient_rows(TaskContext.get().partitionId(), n, loss_sum, hits, total, block_size)


def gradient_rows(
    part: int, n: int, loss_sum: float, correct: int, grad: np.ndarray, block_size: int
) -> pa.RecordBatch:
    """Blocks of one flat gradient; the counters travel with block 0 only."""
    starts = np.arange(0, len(grad), block_size, dtype=np.int32)
    k = len(starts)
    first = np.arange(k) == 0
    offsets = np.append(starts, len(grad)).astype(np.int32)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(np.arange(k, dtype=np.int32)),
            pa.array(np.full(k, part, dtype=np.int32)),
            pa.array(np.where(first, n, 0).astype(np.int64)),
            pa.array(np.where(first, loss_sum, 0.0)),
            pa.array(np.where(first, correct, 0).astype(np.int64)),
            pa.ListArray.from_arrays(pa.array(offsets), pa.array(grad)),
        ],
        names=["block", "slice", "n", "loss_sum", "correct", "grad"],
    )


def sum_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up rows that arrive sorted by block, holding one block's sum at a time."""
    return _sum_runs(batches, None)


def sum_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Add up rows that arrive sorted by block and group; a sum's slice is its group."""
    return _sum_runs(batches, "group")


def _sum_runs(batches: Iterator[pa.RecordBatch], group: str | None) -> Iterator[pa.RecordBatch]:
    current, counters, total = None, None, None

    def flush() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [
                pa.array([current[0]], pa.int32()),
                pa.array([current[1]], pa.int32()),
                pa.array([int(counters[0])], pa.int64()),
                pa.array([counters[1]], pa.float64()),
                pa.array([int(counters[2])], pa.int64()),
                pa.array([total], pa.list_(pa.float64())),
            ],
            names=["block", "slice", "n", "loss_sum", "correct", "grad"],
        )

    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = np.asarray(batch.column("block"))
        groups = np.asarray(batch.column(group)) if group else np.zeros_like(blocks)
        edges = np.flatnonzero(np.diff(blocks) | np.diff(groups)) + 1
        for start, end in zip([0, *edges], [*edges, len(blocks)]):
            run = batch.slice(start, end - start)
            grad = np.asarray(run.column("grad").flatten()).reshape(end - start, -1).sum(axis=0)
            added = [np.asarray(run.column(c)).sum() for c in ("n", "loss_sum", "correct")]
            key = int(blocks[start]), int(groups[start])
            if key == current:
                counters = [a + b for a, b in zip(counters, added)]
                total = total + grad
            else:
                if current is not None:
                    yield flush()
                current, counters, total = key, added, grad
    if current is not None:
        yield flush()
