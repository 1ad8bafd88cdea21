"""Codecs turn waveforms into token matrices and back. The one here is a deterministic residual quantiser; neural ones can be plugged in."""

from __future__ import annotations

import io
import wave
from typing import Protocol

import numpy as np

from .headers import Counted, metadata
from .resample import resample


class Codec(Protocol):
    sample_rate: int
    samples_per_token: int

    def encode(self, samples: np.ndarray) -> np.ndarray: ...  # (8, T) whole numbers, T = ceil(samples / samples_per_token)

    def decode(self, tokens: np.ndarray) -> np.ndarray: ...  # T * samples_per_token floats


def lifted(tokens) -> np.ndarray:
    """A token matrix; a vector stands for a single frame, that is a column."""
    t = np.asarray(tokens)
    return t[:, None] if t.ndim == 1 else t


def measured_samples_per_token(codec: Codec, stages: int = 8) -> int:
    """What one frame of zero tokens decodes to."""
    return len(codec.decode(np.zeros((stages, 1), np.int32)))


class ResidualCodec:
    """Each token covers `samples_per_token` samples by their mean, quantised by 8 stages that each split what is left into 16 steps."""

    stages, levels = 8, 16

    def __init__(self, sample_rate: int = 24_000, samples_per_token: int = 960):
        self.sample_rate, self.samples_per_token = sample_rate, samples_per_token

    def encode(self, samples: np.ndarray) -> np.ndarray:
        p = self.samples_per_token
        n = -(-len(samples) // p)
        padded = np.zeros(n * p)
        padded[: len(samples)] = samples
        rest, scale = np.clip(padded.reshape(n, p).mean(1), -1, 1), 1.0
        out = np.zeros((self.stages, n), np.int32)
        for s in range(self.stages):
            q = np.clip(np.floor((rest + scale) / (2 * scale) * self.levels), 0, self.levels - 1)
            out[s] = q
            rest = rest - ((q + 0.5) / self.levels * 2 - 1) * scale
            scale /= self.levels
        return out

    def decode(self, tokens: np.ndarray) -> np.ndarray:
        tokens = lifted(tokens)
        if tokens.ndim != 2 or tokens.shape[0] != self.stages:
            raise ValueError(f"expected {self.stages} rows of tokens")
        scales = (1.0 / self.levels) ** np.arange(self.stages)
        values = (((tokens + 0.5) / self.levels * 2 - 1) * scales[:, None]).sum(0)
        return np.repeat(values, self.samples_per_token)


def cleaned(x: np.ndarray, rate: int, sample_rate: int | None = None, trim: bool = True) -> np.ndarray:
    """Decoded samples, one row a channel or one channel, as a codec takes them: mixed, resampled, divided by their peak if that is above 1, and
    without zeros at either end."""
    x = np.asarray(x, float)
    if x.ndim not in (1, 2):
        raise ValueError(f"audio has one or two dimensions, not {x.ndim}")
    x = x.mean(0) if x.ndim == 2 else x
    if sample_rate and len(x):
        x = resample(x, rate, sample_rate)
    if not len(x):
        raise ValueError("no samples")
    top = np.abs(x).max()
    x = x / top if top > 1 else x
    if trim:
        at = np.flatnonzero(x)
        x = x[at[0] : at[-1] + 1] if len(at) else x[:0]
    return x


def read_audio(data: bytes, name: str, sample_rate: int | None = None, decoders: dict | None = None) -> tuple[np.ndarray, dict]:
    """Cleaned samples and metadata of an audio file. decoders: by suffix, functions from a file's bytes to (samples, rate), samples as of
    cleaned(); metadata of what they decode come from the file's headers. Other files must be WAV."""
    for suffix, decode in (decoders or {}).items():
        if name.lower().endswith(suffix):
            meta = metadata(Counted(io.BytesIO(data), 0, len(data)), len(data))
            samples, rate = decode(data)
            return cleaned(samples, rate, sample_rate), meta
    return read_wave(data, sample_rate)


def read_wave(data: bytes, sample_rate: int | None = None, trim: bool = True) -> tuple[np.ndarray, dict]:
    """Mono samples in [-1, 1] of a PCM WAV file, resampled by a windowed sinc, and what its header says."""
    with wave.open(io.BytesIO(data)) as w:
        rate, channels, width, n = w.getframerate(), w.getnchannels(), w.getsampwidth(), w.getnframes()
        raw = w.readframes(n)
    if width == 3:  # the highest bytes of 32 bits
        wide = np.zeros((len(raw) // 3, 4), np.uint8)
        wide[:, 1:] = np.frombuffer(raw, np.uint8).reshape(-1, 3)
        x = (wide.view("<i4").ravel() >> 8).astype(float)
    elif width in (1, 2, 4):
        x = np.frombuffer(raw, {1: "u1", 2: "<i2", 4: "<i4"}[width]).astype(float)
    else:
        raise ValueError(f"unsupported sample width {width}")
    x = (x - 128) / 128 if width == 1 else x / 2.0 ** (8 * width - 1)
    x = cleaned(x.reshape(-1, channels).T, rate, sample_rate, trim)
    meta = {"sample_rate": rate, "num_channels": channels, "duration_seconds_from_header": n / rate, "begin_stream_seconds_from_header": 0.0, "bit_rate": float(rate * channels * width * 8), "codec": f"pcm_{'u' if width == 1 else 's'}{8 * width}", "stream_index": 0, "sample_format": f"{'u' if width == 1 else 's'}{8 * width}"}
    return x, meta


def write_wave(samples: np.ndarray, rate: int) -> bytes:
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.clip(samples, -1, 1) * 32767).round().astype("<i2").tobytes())
    return out.getvalue()


def encode_piecewise(codec: Codec, x: np.ndarray, most: int = 25_000, overlap: int = 250) -> np.ndarray:
    """Fragments by the closed form of operators.fragments, encoded one by one and trimmed; step by step for a codec that is not regular."""
    if not getattr(codec, "regular", True):
        return encode_walk(codec, x, most, overlap)
    if overlap < 0 or most <= 2 * overlap:
        raise ValueError("most must exceed twice the overlap")
    p, step = codec.samples_per_token, most - 2 * overlap
    n = 1 if len(x) <= most * p else -(-(len(x) - most * p) // (step * p)) + 1
    out = []
    for k in range(n):
        t = codec.encode(x[k * step * p : k * step * p + most * p])
        out.append(t[:, overlap if k else 0 : t.shape[1] - (overlap if k < n - 1 else 0)])
    return np.concatenate(out, 1)


def save_codec(codec, path: str) -> None:
    """What a built-in codec is made of, as JSON, in any store."""
    import json

    from pyarrow import fs

    store, inner = fs.FileSystem.from_uri(path if "://" in path else f"file://{path}")
    with store.open_output_stream(inner, compression=None) as f:
        f.write(json.dumps({"kind": type(codec).__name__, "sample_rate": codec.sample_rate, "samples_per_token": codec.samples_per_token}).encode())


def codec_at(path: str, kinds: dict | None = None):
    """A maker of the codec that a file describes, to be handed to encode and decode: each worker reads the file once, when it needs it.

    kinds: makers by kind, of sample_rate, samples_per_token and what else the file has; the built-in one if none are given.
    """

    def make():
        import json

        from .sources.tar import open_stream

        if path not in _loaded:
            with open_stream(path) as f:
                said = json.loads(f.read())
            kind = said.pop("kind", None)
            if kind not in (known := kinds or {"ResidualCodec": ResidualCodec}):
                raise ValueError(f"{path}: no codec of kind {kind}")
            _loaded[path] = known[kind](**said)
        return _loaded[path]

    return make


_loaded: dict[str, Codec] = {}


class Adapter:
    """A codec out of any model's two functions. encode: samples -> (codebooks, T) whole numbers; decode: such a matrix -> samples.

    regular tells whether n samples always give ceil(n / samples_per_token) tokens; if not, fragments follow one another by the tokens
    that they really gave. samples_per_token is measured where it is not given.
    """

    def __init__(self, encode, decode, sample_rate: int, stages: int = 8, samples_per_token: int | None = None, regular: bool = True):
        self.encode, self.decode, self.sample_rate, self.stages, self.regular = encode, decode, sample_rate, stages, regular
        self.samples_per_token = samples_per_token or measured_samples_per_token(self, stages)


def walk_fragments(codec: Codec, x: np.ndarray, most: int = 25_000, overlap: int = 250, place: tuple[int, bool] = (0, True)):
    """Fragments one after another, each from where the tokens of those before it really end: yields (tokens kept, place behind them).

    A place is (samples behind, whether nothing was kept yet); the walk goes on from any that it gave, so that it can be taken up elsewhere.
    """
    if overlap < 0 or most <= 2 * overlap:
        raise ValueError("most must exceed twice the overlap")
    p, (at, first) = codec.samples_per_token, place
    while True:
        begin = max(at - overlap * p, 0)
        end = begin + most * p
        t = codec.encode(x[begin:end])
        kept = t[:, 0 if first else overlap : t.shape[1] - (overlap if end < len(x) else 0)]
        if not kept.shape[1] and end < len(x):
            raise ValueError("a fragment gives no tokens beyond its overlap")
        at, first = at + kept.shape[1] * p, False
        yield kept, (at, first)
        if end >= len(x):
            return


def encode_walk(codec: Codec, x: np.ndarray, most: int = 25_000, overlap: int = 250) -> np.ndarray:
    """As encode_piecewise(), for codecs whose number of tokens follows no rule."""
    return np.concatenate([t for t, _ in walk_fragments(codec, x, most, overlap)], 1)


def decode_piecewise(codec: Codec, tokens: np.ndarray, block: int = 10_000, context: int = 50, tail: int = 50) -> np.ndarray:
    tokens, p, carry = np.asarray(tokens), codec.samples_per_token, context + tail
    n, out = tokens.shape[1], []
    for k in range(-(-n // block)):
        so_far, last, first = min((k + 1) * block, n), (k + 1) * block >= n, k * block < carry
        if so_far < carry and not last:
            continue
        read = 0 if first else k * block - carry
        emit = 0 if first else k * block - tail
        y = codec.decode(tokens[:, read:so_far])
        out.append(y[(emit - read) * p : ((n if last else so_far - tail) - read) * p])
    return np.concatenate(out) if out else np.empty(0)
