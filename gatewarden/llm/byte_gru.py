"""A bidirectional gated recurrent network over bytes, in numpy.

Both directions are gated recurrent units of ``HIDDEN`` cells that read a window
of bytes; a linear layer over both states labels every position. Training is
backpropagation through time over padded windows with Adam. Arrays are laid out
(cells, windows), so that every step is a few contiguous operations for thousands
of windows at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

HIDDEN = 8
WINDOW = 64
PAD = 256
#: Windows run at once when predicting.
BLOCK = 2048
_CLOSED = 30.0  # a gate's input that keeps the state unchanged at padding


@dataclass
class ByteGru:
    """Weights: per direction byte table (3H, 257), recurrent (3H, H), bias; output (C, 2H) and bias.

    Rows of a direction are update gate, reset gate and candidate.
    """

    table: list[np.ndarray]
    recur: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray
    labels: tuple[str, ...] = ()

    @classmethod
    def fresh(cls, labels: tuple[str, ...], seed: int = 11) -> ByteGru:
        rng = np.random.default_rng(seed)
        h = HIDDEN
        table = [rng.normal(0, 0.3, (3 * h, 257)).astype(np.float32) for _ in range(2)]
        recur = [rng.normal(0, 0.4, (3 * h, h)).astype(np.float32) for _ in range(2)]
        out = rng.normal(0, 0.2, (len(labels), 2 * h)).astype(np.float32)
        model = cls(table, recur, out, np.zeros((len(labels), 1), np.float32), labels)
        model.close_padding()
        return model

    def close_padding(self) -> None:
        for table in self.table:
            table[:, PAD] = 0
            table[:HIDDEN, PAD] = _CLOSED

    def weights(self) -> list[np.ndarray]:
        return [*self.table, *self.recur, self.out, self.bias]


def _steps(direction: int, length: int) -> range:
    return range(length) if direction == 0 else range(length - 1, -1, -1)


def states(model: ByteGru, windows: np.ndarray, keep: bool = False):
    """States (2H, T, N) after each byte of ``windows`` (T, N); ``keep`` also returns the gates."""
    length, n = windows.shape
    h = HIDDEN
    windows = windows.astype(np.intp)
    out = np.empty((2 * h, length, n), np.float32)
    kept = []
    for d in range(2):
        table, recur = model.table[d], model.recur[d]
        state = np.zeros((h, n), np.float32)
        gates = {}
        buffer = np.empty((3 * h, n), np.float32)
        for t in _steps(d, length):
            # "clip" needs no bounds pass; every byte and PAD is in the table.
            x = np.take(table, windows[t], axis=1, mode="clip", out=None if keep else buffer)
            u = recur @ state
            zr = x[: 2 * h]
            zr += u[: 2 * h]
            zr *= 0.5
            np.tanh(zr, out=zr)
            zr += 1
            zr *= 0.5
            z, r = zr[:h], zr[h:]
            own = u[2 * h :].copy() if keep else u[2 * h :]
            cand = x[2 * h :] + r * own
            np.tanh(cand, out=cand)
            new = cand + z * (state - cand)
            if keep:
                gates[t] = (state, z, r, own, cand)
            state = new
            out[d * h : (d + 1) * h, t] = state
        kept.append(gates)
    return (out, kept) if keep else out


def position_probabilities(model: ByteGru, windows: np.ndarray) -> np.ndarray:
    """Label probabilities (C, T, N) of every position."""
    length, n = windows.shape
    logits = model.out @ states(model, windows).reshape(2 * HIDDEN, -1) + model.bias
    logits -= logits.max(0, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(0, keepdims=True)
    return logits.reshape(-1, length, n)


def gradients(model: ByteGru, windows: np.ndarray, target: np.ndarray, weight: np.ndarray):
    """(loss, gradients in the order of ``weights``) of the weighted mean cross-entropy.

    ``target`` has a label per window, ``weight`` one weight per label. Padding has no loss.
    """
    length, n = windows.shape
    h, classes = HIDDEN, len(model.labels)
    hidden, kept = states(model, windows, keep=True)
    flat = hidden.reshape(2 * h, -1)
    logits = model.out @ flat + model.bias
    logits -= logits.max(0, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(0, keepdims=True)
    mask = (windows != PAD).reshape(-1) * np.tile(weight[target], length)
    total = max(float(mask.sum()), 1e-9)
    labels = np.tile(target, length)
    at = np.arange(length * n)
    loss = float(-(np.log(p[labels, at] + 1e-12) * mask).sum() / total)
    p[labels, at] -= 1
    p *= mask / total
    d_out, d_bias = p @ flat.T, p.sum(1, keepdims=True)
    d_hidden = (model.out.T @ p).reshape(2 * h, length, n).astype(np.float32)
    d_table, d_recur = [], []
    for d in range(2):
        recur = model.recur[d]
        grad_in = np.empty((3 * h, length, n), np.float32)
        grad_recur = np.zeros_like(recur)
        later = np.zeros((h, n), np.float32)
        for t in reversed(_steps(d, length)):
            state, z, r, own, cand = kept[d][t]
            dh = later + d_hidden[d * h : (d + 1) * h, t]
            d_cand = dh * (1 - z) * (1 - cand * cand)
            d_z = dh * (state - cand) * z * (1 - z)
            d_r = d_cand * own * r * (1 - r)
            through = np.concatenate([d_z, d_r, d_cand * r])
            grad_in[: h, t], grad_in[h : 2 * h, t], grad_in[2 * h :, t] = d_z, d_r, d_cand
            grad_recur += through @ state.T
            later = dh * z + recur.T @ through
        flat_bytes = windows.reshape(-1)
        d_table.append(np.stack([
            np.bincount(flat_bytes, weights=row, minlength=257) for row in grad_in.reshape(3 * h, -1)
        ]).astype(np.float32))
        d_table[-1][:, PAD] = 0
        d_recur.append(grad_recur)
    return loss, [*d_table, *d_recur, d_out.astype(np.float32), d_bias.astype(np.float32)]


def train(
    windows: np.ndarray, target: np.ndarray, labels: tuple[str, ...], steps: int = 500,
    batch: int = 256, rate: float = 0.02, seed: int = 5,
) -> ByteGru:
    """Adam over random batches of windows (rows, WINDOW); labels weigh alike however rare they are."""
    model = ByteGru.fresh(labels)
    rng = np.random.default_rng(seed)
    count = np.bincount(target, minlength=len(labels))
    weight = (len(target) / np.maximum(count, 1) / len(labels)).astype(np.float32)
    first = [np.zeros_like(w) for w in model.weights()]
    second = [np.zeros_like(w) for w in model.weights()]
    for step in range(1, steps + 1):
        chosen = rng.integers(0, len(target), batch)
        _, grads = gradients(model, np.ascontiguousarray(windows[chosen].T), target[chosen], weight)
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        scale = min(1.0, 1.0 / max(norm, 1e-9))
        now = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for w, g, m, v in zip(model.weights(), grads, first, second):
            g = g * scale
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= now * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
        model.close_padding()
    return model


def cut_windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(windows (n, WINDOW), row of each): the rows' bytes in pieces, the last one padded."""
    lengths = np.diff(offsets)
    pieces = -(-lengths // WINDOW)
    row = np.repeat(np.arange(len(lengths)), pieces)
    begin = np.zeros(len(lengths), np.int64)
    np.cumsum(pieces[:-1], out=begin[1:])
    within = (np.arange(len(row)) - begin[row]) * WINDOW
    at = (offsets[:-1][row] + within)[:, None] + np.arange(WINDOW)
    inside = at < offsets[1:][row][:, None]
    windows = np.full(at.shape, PAD, np.int16)
    windows[inside] = data[at[inside]]
    return windows, row


def pooled(model: ByteGru, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per row: mean label probabilities over all bytes, and the bytes labelled with each label."""
    rows, classes = len(offsets) - 1, len(model.labels)
    sums, labelled = np.zeros((rows, classes)), np.zeros((rows, classes), np.int64)
    windows, row = cut_windows(data, offsets)
    for k in range(0, len(windows), BLOCK):
        own = np.ascontiguousarray(windows[k : k + BLOCK].T)
        p = position_probabilities(model, own)
        real = own != PAD
        best = p.argmax(0)
        rows_here = row[k : k + BLOCK]
        for c in range(classes):
            sums[:, c] += np.bincount(rows_here, weights=(p[c] * real).sum(0), minlength=rows)
            labelled[:, c] += np.bincount(
                rows_here, weights=((best == c) & real).sum(0), minlength=rows
            ).astype(np.int64)
    lengths = np.maximum(np.diff(offsets), 1)[:, None]
    return sums / lengths, labelled
