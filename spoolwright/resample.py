"""Rational resampling by a polyphase windowed sinc, in one piece or chunk by chunk with the phase and history carried over."""

from __future__ import annotations

import math

import numpy as np

#: Zero crossings of the sinc on either side, and the Kaiser window's shape: the stop band lies 80 dB below.
CROSSINGS, BETA = 32, 8.6
#: The pass band ends at so much of the lower half rate, so that the transition ends at it.
ROLL_OFF = 0.92


def kernel(up: int, down: int, crossings: int = CROSSINGS, beta: float = BETA) -> np.ndarray:
    """The low-pass filter at `up` times the input rate: odd length, symmetric, gain up."""
    cut = ROLL_OFF / max(up, down)
    half = math.ceil(crossings / cut)
    t = np.arange(-half, half + 1)
    h = cut * np.sinc(cut * t) * np.kaiser(2 * half + 1, beta)
    return h * (up / h.sum())


class Resampler:
    """push() samples as they come, finish() at the end; what comes out, joined, is the whole signal at the new rate.

    n samples give ceil(n * new / old). Output sample m lies at m * old / new of the input; beyond both ends the input counts as zero.
    """

    def __init__(self, old: int, new: int):
        if old < 1 or new < 1:
            raise ValueError("rates must be positive")
        d = math.gcd(old, new)
        self.up, self.down = new // d, old // d
        h = kernel(self.up, self.down) if self.up != self.down else np.ones(1)
        self.half = len(h) // 2
        # tap k of phase p is h[p + k * up]: what input sample i - k adds to an output whose place is i * up + p - half
        self.taps = -(-len(h) // self.up)
        padded = np.zeros(self.taps * self.up)
        padded[: len(h)] = h
        self.phases = padded.reshape(self.taps, self.up).T[:, ::-1].copy()
        self.held = np.zeros(self.taps - 1)  # input before the first held sample is zero
        self.first = -(self.taps - 1)  # index of the first held sample
        self.told = self.taken = 0

    def _until(self, most: int, known: int) -> np.ndarray:
        """Outputs up to a number, as far as the input, known up to an index, reaches."""
        end = min(most, max(self.told, (known * self.up - 1 - self.half) // self.down + 1))  # place m needs inputs up to (m * down + half) div up
        m = np.arange(self.told, end, dtype=np.int64)
        if not len(m):
            return np.empty(0)
        place = m * self.down + self.half
        i, p = place // self.up - self.first, place % self.up
        windows = np.lib.stride_tricks.sliding_window_view(self.held, self.taps)
        out = np.empty(len(m))
        for at in range(0, len(m), 4096):
            s = slice(at, at + 4096)
            out[s] = np.einsum("ij,ij->i", windows[i[s] - self.taps + 1], self.phases[p[s]])
        self.told = end
        keep = (end * self.down + self.half) // self.up - self.taps + 1 - self.first  # what the next output still needs
        if keep > 0:
            keep = min(keep, len(self.held) - self.taps + 1)
            self.held, self.first = self.held[keep:], self.first + keep
        return out

    def push(self, samples: np.ndarray) -> np.ndarray:
        self.held = np.concatenate([self.held, np.asarray(samples, float)])
        self.taken += len(samples)
        return self._until(-(-self.taken * self.up // self.down), self.taken)

    def finish(self) -> np.ndarray:
        most = -(-self.taken * self.up // self.down)
        tail = (most * self.down + self.half) // self.up + 1
        self.held = np.concatenate([self.held, np.zeros(max(0, tail - self.taken))])
        return self._until(most, max(tail, self.taken))


def resample(samples: np.ndarray, old: int, new: int, chunk: int = 1 << 18) -> np.ndarray:
    """A whole signal at a new rate, with bounded memory beside input and output."""
    if old == new:
        return np.asarray(samples, float)
    r = Resampler(old, new)
    return np.concatenate([*[r.push(samples[at : at + chunk]) for at in range(0, len(samples), chunk)], r.finish()])
