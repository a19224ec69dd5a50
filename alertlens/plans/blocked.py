"""Exact fold medians and all fold models of a logistic regression, over rows that stay where they are.

A row of the input holds its id, its label, the columns and ``_parts``, how often
it lies in each part (repeat, fold): once in one fold of every repeat, unless ids
repeat.  Nothing is exploded to the folds that a row trains.

* ``Sampled.of`` and ``fold_medians``: evenly spaced order statistics of chunks give a
  bracket around the median of each column; rows are counted below it and the
  values inside are counted by value and part.  A median outside its bracket
  widens it, at last to all values, so the medians are exact.
* ``fit_blocked``: the gradients of all models come from one pass, two matrix
  products a batch.  The models differ in training rows, medians, scales and
  columns; margins are those of the columns, of flags of their missing values and
  of a constant, so each model is one column of coefficients.  L-BFGS runs for
  all models side by side, preconditioned with the curvature at the base rate.  A
  pass returns one matrix (columns x models) a task, whatever the rows.
"""
from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.folds import N_SPLITS
from ..schema import ALERT_ID

PARTS = "_parts"
#: rows of a chunk whose order statistics are kept, and their number
CHUNK, POINTS = 1 << 16, 256
#: passes at most, remembered steps, and the squared Newton step (in units of the loss) at which a model is done
MAX_PASSES, MEMORY, DONE = 300, 12, 1e-14
#: a column whose variance is below this share of its second moment is constant
CONSTANT = 1e-12


def with_parts(frame: DataFrame, folds: DataFrame, columns: Sequence[str], label: str, n_repeats: int,
               n_splits: int = N_SPLITS) -> DataFrame:
    """``alert_id, label, columns..., _parts``; the rows of ``frame`` that have folds, in an order that never changes."""
    part = F.col("repeat") * n_splits + F.col("fold")
    counts = folds.groupBy(ALERT_ID).agg(
        F.array(*[F.count(F.when(part == p, 1)).cast("int") for p in range(n_repeats * n_splits)]).alias(PARTS))
    rows = frame.select(ALERT_ID, F.col(label).cast("double").alias(label), *[F.col(c).cast("double").alias(c) for c in columns])
    tasks = 2 * frame.sparkSession.sparkContext.defaultParallelism
    return rows.join(counts, ALERT_ID).repartition(tasks, ALERT_ID).sortWithinPartitions(ALERT_ID).checkpoint()


def _values(batch: pa.RecordBatch, columns: Sequence[str]) -> np.ndarray:
    """The columns of a batch as a matrix; missing values are NaN."""
    out = np.empty((batch.num_rows, len(columns)))
    for j, c in enumerate(columns):
        out[:, j] = batch.column(c).to_numpy(zero_copy_only=False)
    return out


def _parts(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column(PARTS).flatten().to_numpy().reshape(batch.num_rows, -1)


def _each(rows: DataFrame, columns: Sequence[str], run: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    def batches(found):
        for row in run(found):
            yield pa.RecordBatch.from_pydict({k: pa.array(v) for k, v in row.items()})
    return rows.select(*columns).mapInArrow(batches, schema)


# ------------------------------------------------------------------- medians

@dataclass(frozen=True)
class Sampled:
    """Order statistics of the columns: values in order and the share of the values up to each."""

    columns: tuple[str, ...]
    values: list[np.ndarray]
    upto: list[np.ndarray]
    counts: np.ndarray                 # values of each column, repeats by part counted once a row
    chunks: np.ndarray                 # chunks that they come from

    @classmethod
    def of(cls, rows: DataFrame, columns: Sequence[str]) -> Sampled:
        columns = list(columns)

        def run(batches):
            held, n = [], 0

            def points():
                x = np.concatenate(held)
                at, kept, size = [], [], []
                for j in range(len(columns)):
                    v = x[:, j]
                    v = np.sort(v[~np.isnan(v)])
                    if len(v):
                        take = np.unique(np.linspace(0, len(v) - 1, min(POINTS, len(v))).astype(np.int64))
                        at.append(j), kept.append(v[take].tobytes()), size.append(len(v))
                return {"at": pa.array(at, pa.int32()), "points": pa.array(kept, pa.binary()), "n": pa.array(size, pa.int64())}

            for batch in batches:
                held.append(_values(batch, columns))
                n += batch.num_rows
                if n >= CHUNK:
                    yield points()
                    held, n = [], 0
            if n:
                yield points()

        values, weights = [[] for _ in columns], [[] for _ in columns]
        counts, chunks = np.zeros(len(columns)), np.zeros(len(columns))
        for r in _each(rows, columns, run, "at int, points binary, n long").collect():      # 256 numbers a column and chunk
            v = np.frombuffer(r["points"])
            values[r["at"]].append(v)
            weights[r["at"]].append(np.full(len(v), r["n"] / len(v)))
            counts[r["at"]] += r["n"]
            chunks[r["at"]] += 1
        merged, upto = [], []
        for v, w in zip(values, weights):
            v, w = (np.concatenate(v), np.concatenate(w)) if v else (np.zeros(0), np.zeros(0))
            order = np.argsort(v, kind="stable")
            merged.append(v[order])
            upto.append(np.cumsum(w[order]) / max(w.sum(), 1.0))
        return cls(tuple(columns), merged, upto, counts, chunks)

    def around(self, j: int, share: float, margin: float) -> tuple[float, float]:
        v, upto = self.values[j], self.upto[j]
        lo, hi = np.searchsorted(upto, share - margin) - 1, np.searchsorted(upto, share + margin) + 1
        return (-np.inf if lo < 0 else v[lo], np.inf if hi >= len(v) else v[hi])

    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """A value of each column near its median, and the spread of the middle values."""
        centre, scale = np.zeros(len(self.columns)), np.ones(len(self.columns))
        for j, v in enumerate(self.values):
            if len(v):
                centre[j] = v[np.searchsorted(self.upto[j], 0.5).clip(0, len(v) - 1)]
                spread = np.sqrt(np.mean((v - centre[j]) ** 2))
                scale[j] = spread if spread > 0 and np.isfinite(spread) else 1.0
        return centre, scale


def fold_medians(rows: DataFrame, columns: Sequence[str], n_repeats: int, n_splits: int = N_SPLITS,
                 sampled: Sampled | None = None) -> dict[tuple[int, int], dict[str, float]]:
    """Exact medians of every column over the training part of every (repeat, fold); 0 without values."""
    sampled = sampled or Sampled.of(rows, columns)
    out = {(r, k): {} for r in range(n_repeats) for k in range(n_splits)}
    todo = {c: j for j, c in enumerate(sampled.columns) if c in set(columns)}
    margin = 1.0 / POINTS
    while todo:
        names = list(todo)
        share = [margin + 4 / np.sqrt(max(sampled.counts[j], 1.0)) for j in todo.values()]
        brackets = [(-np.inf, np.inf) if s >= 0.5 else sampled.around(j, 0.5, s) for j, s in zip(todo.values(), share)]
        got = _medians_between(rows, names, brackets, n_repeats, n_splits)
        for c, bracket in zip(names, brackets):
            found = got.get(c)
            if found is not None and np.isinf(bracket).all() or found is not None and not np.isnan(found).any():
                found = np.nan_to_num(found, nan=0.0)
            elif found is None and np.isinf(bracket).all():
                found = np.zeros((n_repeats, n_splits))
            else:
                continue                       # a median lies outside: a wider bracket next
            for r in range(n_repeats):
                for k in range(n_splits):
                    out[(r, k)][c] = float(found[r, k])
            del todo[c]
        margin *= 8
    return out


def _medians_between(rows, names, brackets, n_repeats, n_splits) -> dict[str, np.ndarray]:
    """Medians of the training parts that lie within a column's bracket; NaN where one does not."""
    n_parts = n_repeats * n_splits

    def run(batches):
        below, all_, inside = np.zeros((len(names), n_parts), np.int64), np.zeros((len(names), n_parts), np.int64), [[] for _ in names]

        def collapse(held):
            v, parts = np.concatenate([a for a, _ in held]), np.concatenate([b for _, b in held])
            order = np.argsort(v, kind="stable")
            v, parts = v[order], parts[order]
            first = np.flatnonzero(np.r_[True, v[1:] != v[:-1]])
            return v[first], np.add.reduceat(parts, first, axis=0)

        for batch in batches:
            x, parts = _values(batch, names), _parts(batch).astype(np.int64)
            for j, (lo, hi) in enumerate(brackets):
                v = x[:, j]
                there = ~np.isnan(v)
                all_[j] += there @ parts
                below[j] += (v < lo) @ parts
                mid = there & (v >= lo) & (v <= hi)
                if mid.any():
                    inside[j].append((v[mid], parts[mid]))
                    if len(inside[j]) > 16:
                        inside[j] = [collapse(inside[j])]
        for j, name in enumerate(names):
            if all_[j].any():
                v, parts = collapse(inside[j]) if inside[j] else (np.zeros(0), np.zeros((0, n_parts), np.int64))
                yield {"column": [name], "below": [below[j].tobytes()], "n": [all_[j].tobytes()], "value": [v.tobytes()], "parts": [parts.astype("<i4").tobytes()]}

    def merged(pdf: pd.DataFrame) -> pd.DataFrame:
        add = lambda col: sum(np.frombuffer(b, np.int64) for b in pdf[col]).reshape(n_repeats, n_splits)
        below, n = add("below"), add("n")
        v = np.concatenate([np.frombuffer(b) for b in pdf["value"]])
        parts = np.concatenate([np.frombuffer(b, "<i4").reshape(-1, n_parts) for b in pdf["parts"]])
        order = np.argsort(v, kind="stable")
        v, parts = v[order], parts[order].astype(np.int64)
        out = np.full((n_repeats, n_splits), np.nan)
        for r in range(n_repeats):
            of = parts[:, r * n_splits:(r + 1) * n_splits]
            for k in range(n_splits):
                total, before = n[r].sum() - n[r, k], below[r].sum() - below[r, k]
                upto = before + np.cumsum(of.sum(axis=1) - of[:, k])
                pos = 0.5 * (total - 1)
                if total > 0 and len(v) and before <= np.floor(pos) and np.ceil(pos) < upto[-1]:
                    lo, hi = v[np.searchsorted(upto, [np.floor(pos), np.ceil(pos)], "right")]
                    out[r, k] = lo + (hi - lo) * (pos - np.floor(pos))
        return pd.DataFrame({"column": [pdf["column"].iloc[0]], "medians": [out.ravel().tolist()]})

    got = (_each(rows, [*names, PARTS], run, "column string, below binary, n binary, value binary, parts binary")
           .groupBy("column").applyInPandas(merged, "column string, medians array<double>"))
    return {r["column"]: np.array([np.nan if x is None else x for x in r["medians"]]).reshape(n_repeats, n_splits) for r in got.collect()}


# -------------------------------------------------------------------- models

@dataclass(frozen=True)
class Design:
    """How a batch becomes a matrix: centred columns (0 where missing), flags of missing values, a constant."""

    columns: tuple[str, ...]
    centre: np.ndarray
    scale: np.ndarray
    missing: np.ndarray                # positions of the columns that have missing values

    def matrix(self, batch: pa.RecordBatch) -> np.ndarray:
        x = _values(batch, self.columns)
        flags = np.isnan(x[:, self.missing])
        x = np.nan_to_num((x - self.centre) / self.scale, nan=0.0)
        return np.hstack([x, flags.astype(float), np.ones((len(x), 1))])

    @property
    def width(self) -> int:
        return len(self.columns) + len(self.missing) + 1


@dataclass(frozen=True)
class Model:
    """A fold model: its columns, and what its standardized coefficients are in the matrix of the design."""

    name: str
    part: int
    at: np.ndarray                     # its columns in the design
    sd: np.ndarray
    mean: np.ndarray
    median: np.ndarray                 # centred and scaled like the columns
    flags: np.ndarray                  # the design's flag of each column, -1 without one
    width: int

    def spread(self, theta: np.ndarray) -> np.ndarray:
        """Coefficients of the design's matrix for (standardized coefficients..., intercept)."""
        out = np.zeros(self.width)
        u = theta[:-1] / self.sd
        out[self.at] = u
        has = self.flags >= 0
        out[self.flags[has]] = (self.median * u)[has]
        out[-1] = theta[-1] - self.mean @ u
        return out

    def gathered(self, grad: np.ndarray) -> np.ndarray:
        """The transposed map, for a gradient (or the columns of a matrix)."""
        own = grad[self.at]
        has = self.flags >= 0
        own = own.copy()
        own[has] += (self.median[has] * grad[self.flags[has]].T).T
        own -= np.multiply.outer(self.mean, grad[-1]) if grad.ndim > 1 else self.mean * grad[-1]
        own = (own.T / self.sd).T
        return np.concatenate([own, grad[-1:]])


def _labels(batch: pa.RecordBatch, labels: Sequence[str]) -> np.ndarray:
    y = _values(batch, labels)
    if np.isnan(y).any():
        raise ValueError(f"{', '.join(dict.fromkeys(labels))} must not be null")
    return y


def _moments(rows: DataFrame, design: Design, labels: Sequence[str], n_splits: int):
    """Sums and sums of squares of the design by part, positive rows by part, and the design's cross products."""
    def run(batches):
        first = second = cross = pos = 0
        for batch in batches:
            a, parts, y = design.matrix(batch), _parts(batch).astype(float), _labels(batch, labels)
            first, second, cross = first + parts.T @ a, second + parts.T @ (a * a), cross + a.T @ a
            pos = pos + (parts * y.repeat(n_splits, axis=1)).sum(axis=0)
        if not isinstance(first, int):
            yield {"first": [first.tobytes()], "second": [second.tobytes()], "cross": [cross.tobytes()], "pos": [pos.tobytes()]}

    got = _each(rows, [*dict.fromkeys(labels), *design.columns, PARTS], run, "first binary, second binary, cross binary, pos binary").collect()
    if not got:
        raise ValueError("no rows to train on")
    add = lambda col: sum(np.frombuffer(r[col]) for r in got)
    return add("first").reshape(-1, design.width), add("second").reshape(-1, design.width), add("cross").reshape(design.width, -1), add("pos")


def _gradients(rows: DataFrame, design: Design, labels: Sequence[str], coefs: np.ndarray, part: np.ndarray, n_splits: int) -> np.ndarray:
    """Gradient of the summed log loss of each model over its training rows: one matrix a task."""
    def run(batches):
        total = np.zeros(coefs.shape)
        for batch in batches:
            a, y = design.matrix(batch), _labels(batch, labels)
            parts = _parts(batch).astype(float)
            trained = parts.reshape(len(y), -1, n_splits).sum(axis=2).repeat(n_splits, axis=1) - parts
            rest = a @ coefs
            np.exp(-np.clip(rest, -700, 700), out=rest)
            rest += 1.0
            np.reciprocal(rest, out=rest)
            rest -= y[:, part // n_splits]
            rest *= trained[:, part]
            total += a.T @ rest
        yield {"total": [total.tobytes()]}

    got = _each(rows, [*dict.fromkeys(labels), *design.columns, PARTS], run, "total binary").collect()
    return sum(np.frombuffer(r["total"]) for r in got).reshape(coefs.shape)


class _Steps:
    """L-BFGS of one model: the direction from its last steps, started from the inverse curvature."""

    def __init__(self, inverse: np.ndarray, theta: np.ndarray):
        self.inverse, self.theta, self.pairs = inverse, theta, []
        self.grad = self.direction = None
        self.slope, self.length = 0.0, 1.0

    def aim(self, penalty_grad: np.ndarray) -> bool:
        """The next direction; False when the model is done."""
        q, kept = self.grad + penalty_grad, []
        g = q
        for s, y in reversed(self.pairs):
            a = s @ q / (s @ y)
            q = q - a * y
            kept.append(a)
        q = self.inverse @ q
        for (s, y), a in zip(self.pairs, reversed(kept)):
            q = q + (a - y @ q / (s @ y)) * s
        self.direction, self.slope, self.length = -q, -(g @ q), 1.0
        return -self.slope > DONE * len(q)

    def trial(self) -> np.ndarray:
        return self.theta + self.length * self.direction


def fit_blocked(rows: DataFrame, columns: Sequence[str], medians: dict[tuple[int, int], dict[str, float]], C: float, label: str | Sequence[str],
                candidates: dict[str, list[str]], c_values: dict[str, float] | None = None, n_splits: int = N_SPLITS,
                sampled: Sampled | None = None, fitted_parts: Sequence[int] | None = None) -> tuple[Design, list[Model], np.ndarray]:
    """All (candidate, repeat, fold) L2 logistic regressions: the design, the models and their coefficients in it.

    Minimized is, over all models together, the summed log loss plus
    ``(|w_m|^2 + (a_m - b)^2) / (2 C)``: coefficients of standardized columns, and
    intercepts a_m about a shared one b, which is free.  A list of labels, one a
    repeat, makes models of different targets: each has a free intercept of its own.
    ``fitted_parts`` are the parts whose models are wanted, all if not given."""
    columns = list(columns)
    sampled = sampled or Sampled.of(rows, columns)
    centre, scale = sampled.centre()
    n_rows = rows.count()
    design = Design(tuple(columns), centre, scale, np.flatnonzero(sampled.counts < n_rows))
    n_parts = len(rows.select(PARTS).first()[0]) if n_rows else 0
    alone = not isinstance(label, str)
    labels = list(label) if alone else [label] * (n_parts // n_splits)
    first, second, cross, positive = _moments(rows, design, labels, n_splits)
    flag_of = {int(j): len(columns) + i for i, j in enumerate(design.missing)}
    flags = np.array([flag_of.get(j, -1) for j in range(len(columns))], np.int64)
    trained = lambda t: t.reshape(-1, n_splits, *t.shape[1:]).sum(axis=1).repeat(n_splits, axis=0) - t
    first, second, positive = trained(first), trained(second), trained(positive)
    index = {c: j for j, c in enumerate(columns)}

    models, steps, penalty = [], [], []
    for name, cols in candidates.items():
        c_own = (c_values or {}).get(name, C)
        at = np.array([index[c] for c in dict.fromkeys(cols)], np.int64)
        for part in range(n_parts) if fitted_parts is None else fitted_parts:
            n = max(first[part, -1], 1.0)
            median = (np.array([medians[divmod(part, n_splits)][columns[j]] for j in at]) - centre[at]) / scale[at]
            none = np.where(flags[at] >= 0, first[part, flags[at]], 0.0)
            mean = (first[part, at] + median * none) / n
            square = (second[part, at] + median ** 2 * none) / n
            var = square - mean ** 2
            sd = np.where(var > CONSTANT * square, np.sqrt(np.maximum(var, 0.0)), 0.0)
            own = sd > 0
            m = Model(name, part, at[own], sd[own], mean[own], median[own], flags[at][own], design.width)
            rate = np.clip(positive[part] / n, 0.5 / (n + 1), 1 - 0.5 / (n + 1))
            curve = m.gathered(m.gathered(cross).T) * (rate * (1 - rate) * n / max(n_rows, 1))
            start = np.zeros(len(m.at) + 1)
            start[-1] = np.log(rate / (1 - rate))
            models.append(m)
            penalty.append(1.0 / c_own)
            steps.append(_Steps(np.linalg.inv((curve + curve.T) / 2 + np.eye(len(start)) / c_own), start))
    weight = np.array(penalty)

    def shared() -> float:
        return float(np.average([s.theta[-1] for s in steps], weights=weight))

    def penalty_grad(i: int, theta: np.ndarray, b: float) -> np.ndarray:
        g = theta * weight[i]
        g[-1] = 0.0 if alone else g[-1] - b * weight[i]
        return g

    def loss_grads(live: list[int], at: list[np.ndarray]) -> list[np.ndarray]:
        coefs = np.stack([models[i].spread(t) for i, t in zip(live, at)], axis=1)
        got = _gradients(rows, design, labels, coefs, np.array([models[i].part for i in live]), n_splits)
        return [models[i].gathered(got[:, c]) for c, i in enumerate(live)]

    everyone = list(range(len(models)))
    for i, g in zip(everyone, loss_grads(everyone, [s.theta for s in steps])):
        steps[i].grad = g
    b = shared()
    live = [i for i in everyone if steps[i].aim(penalty_grad(i, steps[i].theta, b))]
    for _ in range(MAX_PASSES):
        if not live:
            break
        trials = [steps[i].trial() for i in live]
        again, moved = [], []
        for i, t, g in zip(live, trials, loss_grads(live, trials)):
            s = steps[i]
            slope = s.direction @ (g + penalty_grad(i, t, b))
            if slope > 0.5 * -s.slope and s.length > 1e-6:            # too far: the loss is convex along the line
                s.length *= float(np.clip(s.slope / (s.slope - slope), 0.1, 0.7))
                again.append(i)
                continue
            step = t - s.theta
            change = g - s.grad + step * weight[i]
            if alone:
                change[-1] = g[-1] - s.grad[-1]
            if step @ change > 0:
                s.pairs = [*s.pairs[-MEMORY + 1:], (step, change)]
            s.theta, s.grad = t, g
            moved.append(i)
        if not again:                                                 # one shared intercept for all steps of a round
            b = shared()
            live = [i for i in everyone if steps[i].aim(penalty_grad(i, steps[i].theta, b))]
        else:
            live = again + [i for i in moved if steps[i].aim(penalty_grad(i, steps[i].theta, b))]
    return design, models, np.stack([m.spread(s.theta) for m, s in zip(models, steps)], axis=1)


def oof_scores(rows: DataFrame, design: Design, models: list[Model], coefs: np.ndarray, n_splits: int = N_SPLITS) -> DataFrame:
    """``cand, alert_id, repeat, fold, score`` of the rows of each model's validation part."""
    names = list(dict.fromkeys(m.name for m in models))
    column = {(m.name, m.part): i for i, m in enumerate(models)}
    kind = rows.schema[ALERT_ID].dataType.simpleString()

    def run(batches):
        for batch in batches:
            a, parts = design.matrix(batch), _parts(batch)
            row, part = np.nonzero(parts)
            times = parts[row, part]
            row, part = row.repeat(times), part.repeat(times)
            ids = batch.column(ALERT_ID).take(pa.array(row))
            for name in names:
                own = coefs[:, [column[name, p] for p in range(parts.shape[1])]]
                margins = np.zeros(len(row))          # term by term: a matrix product may round equal rows unequally
                for j in np.flatnonzero(own.any(axis=1)):
                    margins += a[row, j] * own[j, part]
                yield {"cand": pa.array([name] * len(row), pa.string()), ALERT_ID: ids, "repeat": (part // n_splits).astype(np.int32),
                       "fold": (part % n_splits).astype(np.int32), "score": 1.0 / (1.0 + np.exp(-np.clip(margins, -700, 700)))}
    return _each(rows, [ALERT_ID, *design.columns, PARTS], run, f"cand string, {ALERT_ID} {kind}, repeat int, fold int, score double")
