"""ProbMinHash signatures of weighted shingle sets, and their exact probability Jaccard.

Every element of a set sends a Poisson process of arrivals whose rate is its weight;
each arrival falls on a random register, and a register keeps the element of its
first arrival. Arrivals depend on the element alone, so two sets agree on a register
with the probability Jaccard similarity of their weights. An element stops as soon
as its next arrival is later than every register's first one.
"""

from __future__ import annotations

import numpy as np

from gatewarden.llm.text_batches import Slice, mixed, shingles

SHINGLE_WORDS = 5
_STEP = np.uint64(0x9E3779B97F4A7C15)


def weighted_shingles(part: Slice, width: int = SHINGLE_WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, element, weight), sorted by row and element.

    The weight of a shingle that occurs n times is 1 + ln n: repeats count, but a
    text of one repeated line still looks like the text of that line.
    """
    row, element = shingles(part, width)
    order = np.lexsort((element, row))
    row, element = row[order], element[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (element[1:] != element[:-1])
    first = np.flatnonzero(new)
    count = np.diff(np.append(first, len(row)))
    return row[first], element[first], 1 + np.log(count)


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, rows: int, registers: int) -> np.ndarray:
    """(rows, registers) element of the first arrival at each register; 0 where a row has no element."""
    time = np.full(rows * registers, np.inf)
    holder = np.zeros(rows * registers, np.uint64)
    seed = element.copy()
    now = np.zeros(len(element))
    while len(element):
        seed = seed + _STEP
        draw = mixed(seed)
        now = now - np.log(((draw >> np.uint64(11)) + np.uint64(1)).astype(float) * 2.0**-53) / weight
        at = row * registers + (mixed(draw) % np.uint64(registers)).astype(np.int64)
        np.minimum.at(time, at, now)
        won = time[at] == now
        holder[at[won]] = element[won]
        last = time.reshape(rows, registers).max(1)
        left = now < last[row]
        row, element, weight, seed, now = row[left], element[left], weight[left], seed[left], now[left]
    return holder.reshape(rows, registers)


def band_keys(signature: np.ndarray, bands: int) -> np.ndarray:
    """(rows, bands) one hash of the registers of each band."""
    rows, registers = signature.shape
    width = registers // bands
    parts = signature[:, : bands * width].reshape(rows, bands, width)
    total = np.zeros((rows, bands), np.uint64)
    for k in range(width):
        total = mixed(total + parts[:, :, k] * np.uint64(2 * k + 1))
    return total.view(np.int64)


def probability_jaccard(
    a: np.ndarray, a_weight: np.ndarray, b: np.ndarray, b_weight: np.ndarray
) -> float:
    """Exact similarity of two sorted sets with weights; plain Jaccard if all weights are equal.

    Sum over common d of 1 / sum over all e of max(a_e / a_d, b_e / b_d).
    """
    _, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(i):
        return 0.0
    own_a, own_b = a_weight[i], b_weight[j]
    only_a, only_b = a_weight.sum() - own_a.sum(), b_weight.sum() - own_b.sum()
    ratio = own_a / own_b
    total = 0.0
    for r in np.unique(ratio):
        here = own_a[ratio == r]
        total += here.sum() / (only_a + only_b * r + np.maximum(own_a, own_b * r).sum())
    return float(total)
