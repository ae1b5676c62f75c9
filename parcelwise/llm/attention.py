"""A small causal self-attention model over symbols, in numpy.

One layer, one head. A window holds ``2 * half`` symbols; the second half of the places are scored, each from
the symbols before it, so consecutive windows overlap by half and every place is scored once.

The class that follows is predicted in two levels: first its group of neighbouring class numbers, then the class in
the group. Both are small, so a place costs two short sums instead of one over all classes.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import ceil

import numpy as np

#: A bias this low leaves no probability.
NEVER = np.float32(-1e4)
#: So many windows are worked on at a time that their arrays stay in a core's cache.
SLICE = 128


def _column_exp(scores: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """e to the scores plus ``mask``, but for a factor by column, and the sums of the columns (over the last axis but one);
    ``scores`` are used up."""
    ones = np.ones(scores.shape[1], scores.dtype)
    scores += mask
    with np.errstate(over="ignore"):
        out = np.exp(scores)
    sums = ones @ out
    if not (sums.min(initial=1) > 1e-20 and sums.max(initial=1) < 1e20):
        scores -= scores.max(axis=1, keepdims=True)
        out = np.exp(scores)
        sums = ones @ out
    return out, sums


def _row_exp(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """e to the scores, but for a factor by row; the rows' sums, and the logarithms of the sums without that factor; ``scores`` are used up."""
    ones = np.ones(scores.shape[1], scores.dtype)
    with np.errstate(over="ignore"):
        out = np.exp(scores)
    sums = out @ ones
    if sums.min(initial=1) > 1e-20 and sums.max(initial=1) < 1e20:
        return out, sums, np.log(sums)
    low = scores.max(axis=1)
    scores -= low[:, None]
    out = np.exp(scores)
    sums = out @ ones
    return out, sums, np.log(sums) + low


def _softmax(scores: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities by row and the logarithm of each row's sum; ``scores`` are used up."""
    out, sums, logs = _row_exp(scores.reshape(-1, scores.shape[-1]))
    out /= sums[:, None]
    return out.reshape(scores.shape), logs.reshape(scores.shape[:-1])


def _turned(rows: np.ndarray) -> np.ndarray:
    """Columns for rows in every window."""
    return np.ascontiguousarray(rows.transpose(0, 2, 1))


@dataclass
class Attention:
    half: int
    embed: np.ndarray  # symbols x width; symbol 0 stands before the start
    place: np.ndarray  # 2 * half x width
    query: np.ndarray
    key: np.ndarray
    value: np.ndarray
    mix: np.ndarray
    top: np.ndarray  # width x groups
    top_bias: np.ndarray
    out: np.ndarray  # groups x width x classes of a group
    bias: np.ndarray  # groups x classes of a group

    NAMES = ("embed", "place", "query", "key", "value", "mix", "top", "top_bias", "out", "bias")

    @classmethod
    def fresh(cls, symbols: int, classes: int, width: int, half: int, seed: int) -> Attention:
        rng = np.random.default_rng(seed)
        draw = lambda *shape: (rng.normal(size=shape) * width**-0.5).astype(np.float32)
        size = ceil(classes**0.5)
        groups = ceil(classes / size)
        model = cls(
            half, draw(symbols, width), 0.1 * draw(2 * half, width), *(draw(width, width) for _ in range(4)),
            draw(width, groups), np.zeros(groups, np.float32), draw(groups, width, size), np.zeros((groups, size), np.float32),
        )
        model.start_from(np.ones(classes))
        return model

    def start_from(self, mass: np.ndarray) -> None:
        """Classes begin with probabilities near their shares of ``mass``; those without any have none for good."""
        shares = np.zeros(self.bias.shape)
        shares.reshape(-1)[: len(mass)] = mass
        with np.errstate(divide="ignore"):
            self.bias[...] = np.maximum(np.log(shares), NEVER)
            self.top_bias[...] = np.maximum(np.log(shares.sum(axis=1)), NEVER)
        used = shares.sum(axis=1) > 0
        self.bias[used] = np.maximum(self.bias[used] - self.top_bias[used, None], NEVER)
        self.top_bias[used] -= np.float32(np.log(shares.sum()))

    def _mask(self) -> np.ndarray:
        """0 where the scored place of the column may look at the place of the row, a large negative number elsewhere."""
        ahead = np.arange(2 * self.half)[:, None] > self.half + np.arange(self.half)[None, :]
        return np.where(ahead, NEVER, np.float32(0))

    def _by_group(self, rows: np.ndarray, targets: np.ndarray):
        """Rows in the order of their class's group: (order, limits of the groups, rows, places of the target's group and of its
        class in arrays of all scores, scores of the groups, of the group's classes)."""
        groups, size = self.bias.shape
        group, inner = np.divmod(targets.astype(np.int16), np.int16(size))
        order = np.argsort(group, kind="stable")
        limits = np.concatenate([[0], np.cumsum(np.bincount(group, minlength=groups))])
        rows = rows.take(order, axis=0)
        scores = np.empty((len(rows), size), rows.dtype)
        for g in range(groups):
            own = slice(limits[g], limits[g + 1])
            np.matmul(rows[own], self.out[g], out=scores[own])
            scores[own] += self.bias[g]
        number = np.arange(len(rows))
        first = rows @ self.top
        first += self.top_bias
        return order, limits, rows, number * groups + group.take(order), number * size + inner.take(order), first, scores

    def log_probabilities(self, symbols: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """windows x half: log P(class of the next symbol | the symbols so far)."""
        width, mask, mixed = self.query.shape[0], self._mask(), self.value @ self.mix
        query = self.query * self.embed.dtype.type(width**-0.5)
        # Projections are linear, so they are taken of the tables once instead of at every place.
        keys, values = self.embed @ self.key, self.embed @ mixed
        at_keys, at_values = self.place @ self.key, self.place @ mixed
        rows = np.empty((*targets.shape, width), self.embed.dtype)
        for at in range(0, len(symbols), SLICE):
            own, here = symbols[at : at + SLICE], rows[at : at + SLICE]
            np.add(self.embed.take(own[:, self.half :], axis=0), self.place[self.half :], out=here)
            k, v = keys.take(own, axis=0), values.take(own, axis=0)
            k += at_keys
            v += at_values
            weights, sums = _column_exp(k @ _turned(here @ query), mask)
            seen = weights.transpose(0, 2, 1) @ v
            seen /= sums[:, :, None]
            here += seen
        order, _, _, groups, classes, first, scores = self._by_group(rows.reshape(-1, width), targets.ravel())
        logs = first.ravel().take(groups) + scores.ravel().take(classes)
        logs -= _row_exp(first)[2]
        logs -= _row_exp(scores)[2]
        out = np.empty_like(logs)
        out[order] = logs
        return out.reshape(targets.shape)

    def step(self, symbols: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss over ``counted`` places and its gradients."""
        half, width, mask = self.half, self.query.shape[0], self._mask()
        scale = self.embed.dtype.type(width**-0.5)
        query, both = self.query * scale, np.concatenate([self.key, self.value @ self.mix], axis=1)
        back = np.ascontiguousarray(both.T)
        rows = np.empty((*targets.shape, width), self.embed.dtype)
        slices, held = [slice(at, at + SLICE) for at in range(0, len(symbols), SLICE)], []
        for own in slices:
            x = self.embed.take(symbols[own], axis=0)
            x += self.place
            k_v, q = x @ both, x[:, half:] @ query
            weights, sums = _column_exp(k_v[..., :width] @ _turned(q), mask)
            seen = weights.transpose(0, 2, 1) @ k_v[..., width:]
            seen /= sums[:, :, None]
            np.add(x[:, half:], seen, out=rows[own])
            held.append((x, k_v, q, weights, sums, seen))

        loss, d_rows, slopes = self._output_slopes(rows.reshape(-1, width), targets.ravel(), counted.ravel())
        d_rows = d_rows.reshape(rows.shape)
        d_x, d_both, d_query = np.empty((*symbols.shape, width), rows.dtype), np.zeros_like(both), np.zeros_like(query)
        for own, (x, k_v, q, weights, sums, seen) in zip(slices, held):
            d_here = d_rows[own]
            d_seen = d_here / sums[:, :, None]  # as ``weights`` are not divided by their sums
            d_scores = k_v[..., width:] @ _turned(d_seen)
            d_scores -= np.einsum("bij,bij->bi", d_seen, seen)[:, None]
            d_scores *= weights
            d_q = d_scores.transpose(0, 2, 1) @ k_v[..., :width]
            d_k_v = np.empty_like(k_v)
            np.matmul(d_scores, q, out=d_k_v[..., :width])
            np.matmul(weights, d_seen, out=d_k_v[..., width:])
            np.matmul(d_k_v, back, out=d_x[own])
            d_x[own, half:] += d_here
            d_x[own, half:] += d_q @ query.T
            d_both += (x.transpose(0, 2, 1) @ d_k_v).sum(axis=0)
            d_query += (x[:, half:].transpose(0, 2, 1) @ d_q).sum(axis=0)
        flat, columns = symbols.ravel(), d_x.reshape(-1, width).T.astype(np.float64, order="C")
        d_embed = np.stack([np.bincount(flat, column, len(self.embed)) for column in columns], axis=1)
        return loss, slopes | {
            "embed": d_embed.astype(self.embed.dtype), "place": d_x.sum(axis=0), "query": d_query * scale, "key": d_both[:, :width],
            "value": d_both[:, width:] @ self.mix.T, "mix": self.value.T @ d_both[:, width:],
        }

    def _output_slopes(self, rows: np.ndarray, targets: np.ndarray, counted: np.ndarray) -> tuple[float, np.ndarray, dict[str, np.ndarray]]:
        """(mean loss, slope of each row, those of the two levels of classes)."""
        order, limits, rows, groups, classes, first, p = self._by_group(rows, targets)
        share = (counted / max(1, counted.sum())).astype(rows.dtype).take(order)
        logs = first.ravel().take(groups) + p.ravel().take(classes)
        first, sums, low = _row_exp(first)
        logs -= low
        first *= (share / sums)[:, None]
        p, sums, low = _row_exp(p)
        logs -= low
        p *= (share / sums)[:, None]
        first.ravel()[groups] -= share
        p.ravel()[classes] -= share
        d_sorted, ones = first @ self.top.T, np.ones(len(rows), rows.dtype)
        d_out, d_bias = np.empty_like(self.out), np.empty_like(self.bias)
        for g in range(len(self.bias)):
            own = slice(limits[g], limits[g + 1])
            d_sorted[own] += p[own] @ self.out[g].T
            d_out[g] = rows[own].T @ p[own]
            d_bias[g] = ones[own] @ p[own]
        back = np.empty_like(order)
        back[order] = np.arange(len(order))
        return -float(logs @ share), d_sorted.take(back, axis=0), {"top": rows.T @ first, "top_bias": ones @ first, "out": d_out, "bias": d_bias}

    def train(self, symbols: np.ndarray, targets: np.ndarray, counted: np.ndarray, *, steps: int, batch: int, rate: float, seed: int) -> list[float]:
        """Adam over random windows, the rate falling to nothing; the losses of the steps."""
        rng = np.random.default_rng(seed)
        trainer, losses = Adam(self), []
        for t in range(1, steps + 1):
            own = rng.integers(0, len(symbols), min(batch, len(symbols)))
            losses.append(trainer.step(symbols[own], targets[own], counted[own], rate * (1 - (t - 1) / steps)))
        return losses


class Adam:
    """Steps on a model's weights."""

    def __init__(self, model: Attention):
        self.model, self.t = model, 0
        self.sizes = [getattr(model, name).size for name in model.NAMES]
        self.first, self.second = (np.zeros(sum(self.sizes), model.embed.dtype) for _ in range(2))

    def step(self, symbols: np.ndarray, targets: np.ndarray, counted: np.ndarray, rate: float) -> float:
        loss, slopes = self.model.step(symbols, targets, counted)
        self.t += 1
        g = np.concatenate([slopes[name].ravel() for name in self.model.NAMES])
        self.first += 0.1 * (g - self.first)
        g *= g
        g -= self.second
        g *= 0.01
        self.second += g
        move = np.sqrt(self.second / (1 - 0.99**self.t))
        move += 1e-8
        np.divide(self.first, move, out=move)
        move *= rate / (1 - 0.9**self.t)
        for name, own in zip(self.model.NAMES, np.split(move, np.cumsum(self.sizes)[:-1])):
            weights = getattr(self.model, name)
            weights -= own.reshape(weights.shape)
        return loss


def overlapping(ids: list[np.ndarray], half: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows over several texts: (places of what is read, places of what is scored, owner of each window).

    The texts are taken as one array with a 0 before each and after the last; places index into that array.
    A scored place of -1 lies behind the end of its text; a read place of 0 before its start.
    """
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    n_windows = -(-sizes // half)
    owners = np.repeat(np.arange(len(ids)), n_windows)
    begin = half * (np.arange(len(owners)) - np.repeat(np.cumsum(n_windows) - n_windows, n_windows))
    at = begin + np.repeat(1 + np.cumsum(sizes) - sizes, n_windows)
    goal = np.arange(half)
    scored, read = at[:, None] + goal, at[:, None] + np.arange(-half - 1, half - 1)
    # Only a text's first two windows reach before its start, and only its last behind its end.
    read[begin == 0, : half + 1] = 0
    read[begin == half, 0] = 0
    left = (sizes[owners] - begin)[:, None]
    last = np.flatnonzero(left[:, 0] < half)
    scored[last] = np.where(goal < left[last], scored[last], -1)
    read[last, half:] = np.where(goal <= left[last], read[last, half:], 0)
    return read, scored, owners


def pieces(ids: list[np.ndarray], half: int, most: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Long texts in pieces: (pieces, text of each, whether its first ``2 * half`` ids repeat the end of the piece before)."""
    parts, owners, goes_on = [], [], []
    for k, own in enumerate(ids):
        for at in range(0, max(1, len(own)), most):
            parts.append(own[max(0, at - 2 * half) : at + most])
            owners.append(k)
            goes_on.append(at > 0)
    return parts, np.array(owners, int), np.array(goes_on, bool)


def windows(ids: list[np.ndarray], half: int, most: int = 1 << 17) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(ids of all pieces, ``overlapping`` of them with owners among the texts); every id of a text is scored once.

    ``most`` is a multiple of ``half`` and at least twice it, so a later piece's windows are those of the whole text.
    """
    parts, owner, goes_on = pieces(ids, half, most)
    read, scored, piece = overlapping(parts, half)
    first = np.searchsorted(piece, np.flatnonzero(goes_on))
    scored[first] = scored[first + 1] = -1
    return np.concatenate([[0], *parts]).astype(np.int64), read, scored, owner[piece]
