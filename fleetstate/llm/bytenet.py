"""A byte convolutional network: embeddings, filters of several widths, max pooling, softmax. Numpy only."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Bytes of a window, numbers per byte, widths of the filters, filters per width.
WINDOW, DEPTH, WIDTHS, FILTERS = 192, 8, (2, 3, 4), 12
_REACH = max(WIDTHS)


@dataclass
class ByteNet:
    """`conv` holds all filters over _REACH bytes; those of lesser width are zero beyond it. Byte 0 pads."""

    embed: np.ndarray
    conv: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def new(cls, classes: int, seed: int) -> ByteNet:
        r = np.random.default_rng(seed)
        filters = FILTERS * len(WIDTHS)
        conv = r.normal(0, 0.2, (_REACH * DEPTH, filters)) * _mask()
        embed = r.normal(0, 0.5, (256, DEPTH))
        embed[0] = 0
        parts = (embed, conv, np.zeros(filters), r.normal(0, 0.2, (filters, classes)), np.zeros(classes))
        return cls(*(p.astype(np.float32) for p in parts))

    def parts(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.bias, self.out, self.out_bias]

    def _slices(self, windows: np.ndarray) -> np.ndarray:
        """All stretches of _REACH bytes of each window, embedded: (windows, places, _REACH * DEPTH)."""
        x = self.embed[windows].reshape(len(windows), -1)
        shape = (len(windows), WINDOW, _REACH * DEPTH)
        return np.lib.stride_tricks.as_strided(x, shape, (x.strides[0], DEPTH * x.strides[1], x.strides[1]), writeable=False)

    def pooled(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window and filter the greatest response and its place."""
        seen = np.ascontiguousarray(self._slices(windows)).reshape(-1, _REACH * DEPTH) @ self.conv
        seen = seen.reshape(len(windows), WINDOW, -1)
        place = seen.argmax(axis=1) if len(windows) else np.zeros((0, seen.shape[2]), np.int64)
        top = np.take_along_axis(seen, place[:, None, :], axis=1)[:, 0]
        return np.maximum(top + self.bias, 0), place

    def slopes(self, x: np.ndarray, want: np.ndarray) -> list[np.ndarray]:
        """Slopes of the mean cross-entropy of windows `x` of classes `want`, for each of `parts`."""
        top, place = self.pooled(x)
        p = softmax(top @ self.out + self.out_bias)
        p[np.arange(len(x)), want] -= 1
        p /= len(x)
        back = (p @ self.out.T) * (top > 0)
        seen = np.take_along_axis(self._slices(x), place[:, :, None], axis=1)  # (row, filter, stretch)
        to_conv = np.einsum("rfk,rf->kf", seen, back, optimize=True) * _mask().astype(np.float32)
        to_bytes = (self.conv.T[None] * back[:, :, None]).reshape(len(x), -1, _REACH, DEPTH)
        which = np.take_along_axis(x[:, None, :].repeat(place.shape[1], axis=1), place[:, :, None] + np.arange(_REACH), axis=2)
        to_embed = np.zeros_like(self.embed)
        np.add.at(to_embed, which.reshape(-1), to_bytes.reshape(-1, DEPTH))
        to_embed[0] = 0
        return [to_embed, to_conv, back.sum(axis=0), top.T @ p, p.sum(axis=0)]

    def logits(self, windows: np.ndarray) -> np.ndarray:
        """Class scores of windows of WINDOW + _REACH - 1 bytes each."""
        out = np.empty((len(windows), len(self.out_bias)), dtype=np.float32)
        for lo in range(0, len(windows), 512):
            part = windows[lo : lo + 512]
            seen = np.ascontiguousarray(self._slices(part)).reshape(-1, _REACH * DEPTH) @ self.conv
            top = seen.reshape(len(part), WINDOW, -1).max(axis=1)
            out[lo : lo + 512] = np.maximum(top + self.bias, 0) @ self.out + self.out_bias
        return out


def _mask() -> np.ndarray:
    """1 where a filter of a width may look."""
    mask = np.zeros((_REACH * DEPTH, FILTERS * len(WIDTHS)))
    for i, width in enumerate(WIDTHS):
        mask[: width * DEPTH, i * FILTERS : (i + 1) * FILTERS] = 1
    return mask


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, y: np.ndarray, classes: int, steps: int = 900, batch: int = 128, rate: float = 4e-3, seed: int = 1) -> ByteNet:
    """Adam on cross-entropy; classes are drawn evenly. Half of each batch is cut short, so that short texts are known.

    From batch / 2 classes on there are more steps, so that each is drawn 2 * steps times or more however many there are;
    a batch draws some of the classes where it has no room for all.
    """
    steps = max(steps, -(-steps * 2 * classes // batch))
    net, r = ByteNet.new(classes, seed), np.random.default_rng(seed)
    first, second = ([np.zeros_like(p) for p in net.parts()] for _ in range(2))
    places = [np.flatnonzero(y == c) for c in range(classes)]
    for step in range(1, steps + 1):
        drawn = places if classes <= batch else [places[c] for c in r.permutation(classes)[:batch]]
        rows = np.concatenate([r.choice(p, -(-batch // classes)) for p in drawn])
        x, want = windows[rows].copy(), y[rows]
        stop = np.where(r.random(len(x)) < 0.5, r.integers(8, x.shape[1], len(x)), x.shape[1])
        x[np.arange(x.shape[1])[None, :] >= stop[:, None]] = 0
        slopes = net.slopes(x, want)
        pace = rate * (1 - step / (steps + 1)) + 1e-4
        for part, slope, m, v in zip(net.parts(), slopes, first, second):
            m += 0.1 * (slope - m)
            v += 0.01 * (slope * slope - v)
            part -= (pace * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
    return net
