"""What the headers of audio say, read by seeking: some kilobytes of a file, whatever its length. MPEG audio and WAV; no payload is decoded."""

from __future__ import annotations

import struct
from collections.abc import Callable

Read = Callable[[int, int], bytes]  # (place, length) -> bytes, fewer at the end

#: Fixed values of the MPEG audio format: bit rates in kbit/s by (version 1 or 2, layer), sampling rates in Hz, samples of a frame.
BIT_RATES = {
    (1, 1): (32, 64, 96, 128, 160, 192, 224, 256, 288, 320, 352, 384, 416, 448),
    (1, 2): (32, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320, 384),
    (1, 3): (32, 40, 48, 56, 64, 80, 96, 112, 128, 160, 192, 224, 256, 320),
    (2, 1): (32, 48, 56, 64, 80, 96, 112, 128, 144, 160, 176, 192, 224, 256),
    (2, 2): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
    (2, 3): (8, 16, 24, 32, 40, 48, 56, 64, 80, 96, 112, 128, 144, 160),
}
RATES = {1: (44100, 48000, 32000), 2: (22050, 24000, 16000), 2.5: (11025, 12000, 8000)}
FRAME_SAMPLES = {(1, 1): 384, (1, 2): 1152, (1, 3): 1152, (2, 1): 384, (2, 2): 1152, (2, 3): 576}
#: Samples that a layer III decoder is late by, beside the encoder's own delay.
DECODER_DELAY = 529
#: Junk between a tag and the first frame may be so long; so many frames in a row make sure that a frame is one.
MOST_JUNK, LINKS = 64 << 10, 3


def _meta(rate: int, channels: int, seconds: float, begin: float, bit_rate: float, codec: str, fmt: str) -> dict:
    return {"sample_rate": rate, "num_channels": channels, "duration_seconds_from_header": seconds, "begin_stream_seconds_from_header": begin, "bit_rate": bit_rate, "codec": codec, "stream_index": 0, "sample_format": fmt}


def frame(head: bytes) -> dict | None:
    """An MPEG audio frame's header of four bytes: version, layer, kbps, rate, channels, mono, protected, samples and length in bytes; None if it is none."""
    if len(head) < 4 or head[0] != 0xFF or head[1] & 0xE0 != 0xE0:
        return None
    version, layer = {3: 1, 2: 2, 0: 2.5}.get(head[1] >> 3 & 3), 4 - (head[1] >> 1 & 3)
    index, rate_index = head[2] >> 4, head[2] >> 2 & 3
    if version is None or layer == 4 or index in (0, 15) or rate_index == 3:
        return None
    family = (1 if version == 1 else 2, layer)
    kbps, rate, samples = BIT_RATES[family][index - 1], RATES[version][rate_index], FRAME_SAMPLES[family]
    padding = head[2] >> 1 & 1
    length = (12 * kbps * 1000 // rate + padding) * 4 if layer == 1 else samples // 8 * kbps * 1000 // rate + padding
    mono = head[3] >> 6 == 3
    return {"version": version, "layer": layer, "kbps": kbps, "rate": rate, "channels": 1 if mono else 2, "mono": mono, "protected": not head[1] & 1, "samples": samples, "length": length}


def _first_frame(read: Read, at: int, end: int) -> tuple[int, dict]:
    """Place and header of the first frame from which frames of the same kind follow one another, to the end if there are few."""
    data = read(at, min(MOST_JUNK, end - at))
    i = data.find(b"\xff")
    while i >= 0:
        f = frame(data[i : i + 4])
        place, links, g = at + i, 0, f
        while g and (g["version"], g["layer"], g["rate"]) == (f["version"], f["layer"], f["rate"]):
            place, links = place + g["length"], links + 1
            if links > LINKS or place == end:
                return at + i, f
            g = frame(read(place, 4)) if place < end else None
        i = data.find(b"\xff", i + 1)
    raise ValueError("no MPEG audio frame")


def mpeg(read: Read, size: int) -> dict:
    """Metadata of an MPEG audio file: tags are stepped over; a Xing, Info or VBRI header tells frames and bytes, else the bit rate holds throughout."""
    at, end = 0, size
    while (head := read(at, 10))[:3] == b"ID3" and len(head) == 10 and max(head[6:10]) < 128:
        at += 10 + (head[6] << 21 | head[7] << 14 | head[8] << 7 | head[9]) + (10 if head[5] & 0x10 else 0)
    if size >= 128 and read(size - 128, 3) == b"TAG":
        end -= 128
    if end >= 32 and read(end - 32, 8) == b"APETAGEX":
        length, flags = struct.unpack("<4xI4xI", read(end - 24, 16)[:16])
        end -= length + (32 if flags >> 31 else 0)
    if at >= end:
        raise ValueError("no MPEG audio frame")
    at, f = _first_frame(read, at, end)
    data = read(at, 512)
    side = 4 + 2 * f["protected"] + ((17 if f["mono"] else 32) if f["version"] == 1 else (9 if f["mono"] else 17))
    frames = total = None
    begin, trimmed = 0.0, 0
    if f["layer"] == 3 and data[side : side + 4] in (b"Xing", b"Info"):
        (flags,), p = struct.unpack(">I", data[side + 4 : side + 8]), side + 8
        if flags & 1:
            (frames,), p = struct.unpack(">I", data[p : p + 4]), p + 4
        if flags & 2:
            (total,), p = struct.unpack(">I", data[p : p + 4]), p + 4
        p += (100 if flags & 4 else 0) + (4 if flags & 8 else 0)
        if data[p : p + 4].strip(b"\0") and len(data) >= p + 24:  # the encoder's name, then its delay and padding, 12 bits each
            delay, padding = data[p + 21] << 4 | data[p + 22] >> 4, (data[p + 22] & 15) << 8 | data[p + 23]
            begin, trimmed = (delay + DECODER_DELAY) / f["rate"], delay + padding
    elif f["layer"] == 3 and data[36:40] == b"VBRI":
        total, frames = struct.unpack(">II", data[46:54])
    if frames:
        seconds = max(0, frames * f["samples"] - trimmed) / f["rate"]
        whole = frames * f["samples"] / f["rate"]
        rate = 8 * (total or end - at) / whole
    else:
        rate = 1000.0 * f["kbps"]
        seconds = 8 * (end - at) / rate
    return _meta(f["rate"], f["channels"], seconds, begin, rate, f"mp{f['layer']}", "fltp")


def riff(read: Read, size: int) -> dict:
    """Metadata of a WAV file, from its chunks' headers; a data chunk that breaks off counts as far as it goes."""
    head = read(0, 12)
    if head[:4] != b"RIFF" or head[8:12] != b"WAVE":
        raise ValueError("no RIFF header")
    at, fmt = 12, None
    while len(chunk := read(at, 8)) == 8:
        name, length = chunk[:4], int.from_bytes(chunk[4:], "little")
        if name == b"fmt ":
            fmt = struct.unpack("<HHIIHH", read(at + 8, 16))
        elif name == b"data":
            if fmt is None or fmt[2] == 0 or fmt[4] == 0:
                raise ValueError("no format before the data")
            kind, channels, rate, _, block, bits = fmt
            frames = min(length, max(0, size - at - 8)) // block
            is_float = kind == 3
            letter = "flt" if is_float else "u" if bits == 8 else "s"
            codec = f"pcm_{'f' if is_float else letter}{bits}{'' if bits == 8 else 'le'}" if kind in (1, 3, 0xFFFE) else f"wav_{kind:#06x}"
            return _meta(rate, channels, frames / rate, 0.0, float(8 * rate * block), codec, letter if is_float else f"{letter}{bits}")
        at += 8 + length + (length & 1)
    raise ValueError("no data chunk")


def metadata(read: Read, size: int) -> dict:
    """Metadata of an audio file by its first bytes. Raises ValueError for what is neither."""
    return riff(read, size) if read(0, 4) == b"RIFF" else mpeg(read, size)


class Counted:
    """A reader of an open file between two places, which counts the bytes it was asked for."""

    def __init__(self, raw, offset: int, size: int):
        self.raw, self.offset, self.size, self.bytes = raw, offset, size, 0

    def __call__(self, at: int, length: int) -> bytes:
        length = max(0, min(length, self.size - at))
        self.bytes += length
        self.raw.seek(self.offset + at)
        return self.raw.read(length) if length else b""
