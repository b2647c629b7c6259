"""Audio features: polyphase resampling, overlapped log-mel filterbanks and hysteresis energy segmentation.

A media column holds 8-bit unsigned mono PCM in a RIFF/WAVE container. Features come out as an Arrow IPC stream
whose batches hold one row per window: start and end in seconds, and a fixed-shape tensor of WINDOW frames by
MELS bands. Everything is computed in blocks, so a long recording needs no more memory than a short one beyond
its own bytes and features.
"""

from __future__ import annotations

import hashlib
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from inkmill.llm.common import documents, id_and_text, slices, texts

RATE, UP, DOWN = 8000, 3, 5  # samples are 8 kHz; features are made at RATE * UP / DOWN, by a filter of UP phases
TAPS = 16  # filter taps for each phase
FRAME, HOP, FFT, MELS = 120, 48, 128, 20  # 25 ms frames every 10 ms at 4.8 kHz
WINDOW = 50  # frames in a tensor
ENTER, LEAVE, HANG = 0.6, 0.4, 2  # of the way from a recording's 10th to its 95th percentile of energy; frames below
BLOCK = 1 << 14  # frames computed at once
PAD = 64


def payload(text: str) -> tuple[bytes, int]:
    """UTF-8 of the text with bytes 0 up to a positive multiple of 64, and the unpadded length."""
    raw = text.encode("utf-8", "surrogatepass")
    return raw + bytes(-len(raw) % PAD if raw else PAD), len(raw)


def wave(samples: bytes, rate: int = RATE) -> bytes:
    """8-bit unsigned mono PCM as a RIFF/WAVE file."""
    head = struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(samples), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(samples))
    return head + samples + b"\0" * (len(samples) % 2)


def read_wave(media: bytes) -> tuple[bytes, int]:
    """Samples and rate of an 8-bit mono PCM file, walking its chunks."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a RIFF/WAVE file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        kind, n = struct.unpack_from("<4sI", media, at)
        if kind == b"fmt ":
            form, channels, rate, _, _, bits = struct.unpack_from("<HHIIHH", media, at + 8)
            if (form, channels, bits) != (1, 1, 8):
                raise ValueError("only 8-bit mono PCM is read")
        elif kind == b"data":
            return media[at + 8 : at + 8 + n], rate
        at += 8 + n + n % 2
    raise ValueError("no data chunk")


def lowpass(up: int = UP, down: int = DOWN, taps: int = TAPS) -> np.ndarray:
    """Hamming-windowed sinc for rational resampling, (phase, tap); each phase sums to 1."""
    n = taps * up
    x = np.arange(n) - (n - 1) / 2
    h = np.sinc(x / max(up, down)) * np.hamming(n)
    h = h.reshape(taps, up).T
    return (h / h.sum(axis=1, keepdims=True)).astype(np.float32)


def resampled(x: np.ndarray, start: int, stop: int, filters: np.ndarray, up: int = UP, down: int = DOWN) -> np.ndarray:
    """Output samples start..stop of the polyphase resampler; x counts as 0 beyond its ends.

    Output m takes phase m*down mod up over the inputs that end at m*down // up, so only the taps that meet input
    samples are ever multiplied. Of one phase every up-th output is made, which steps over down inputs: each tap is one
    pass over a strided view, always in the same order, so a value doesn't depend on where a block starts."""
    taps = filters.shape[1]
    out = np.empty(stop - start, np.float32)
    low, high = start * down // up + taps // 2 - taps + 1, (stop - 1) * down // up + taps // 2 + 1
    part = np.zeros(high - low, np.float32)
    a, b = max(low, 0), min(high, len(x))
    if b > a:
        part[a - low : b - low] = x[a:b]
    for first in range(start, min(start + up, stop)):
        n = -(-(stop - first) // up)
        last = first * down // up + taps // 2 - low
        phase = filters[first * down % up]
        total = np.zeros(n, np.float32)
        for k in range(taps):
            total += phase[k] * part[last - k : last - k + (n - 1) * down + 1 : down]
        out[first - start :: up] = total
    return out


def mel_bank(rate: float, fft: int = FFT, mels: int = MELS) -> np.ndarray:
    """Triangular filters, (bins, mels)."""
    mel = lambda f: 2595 * np.log10(1 + f / 700)
    edges = 700 * (10 ** (np.linspace(mel(20), mel(rate / 2), mels + 2) / 2595) - 1)
    f = np.arange(fft // 2 + 1) * rate / fft
    up, down = (f[:, None] - edges[:-2]) / np.diff(edges)[:-1], (edges[2:] - f[:, None]) / np.diff(edges)[1:]
    return np.maximum(0, np.minimum(up, down)).astype(np.float32)


_FILTERS, _HANN, _BANK = lowpass(), np.hanning(FRAME).astype(np.float32), mel_bank(RATE * UP / DOWN)


def log_mel(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(frames x MELS log-mel in dB, frame energies in dB), rounded to 0.01 dB."""
    n = -(-len(samples) * UP // DOWN)
    frames = 1 + max(0, -(-(n - FRAME) // HOP))
    mel, energy = np.empty((frames, MELS), np.float32), np.empty(frames, np.float32)
    x = (samples.astype(np.float32) - 128) / 128
    for at in range(0, frames, BLOCK):
        end = min(frames, at + BLOCK)
        y = resampled(x, at * HOP, (end - 1) * HOP + FRAME, _FILTERS)
        cut = np.lib.stride_tricks.sliding_window_view(y, FRAME)[::HOP]
        energy[at:end] = 10 * np.log10(np.einsum("ij,ij->i", cut, cut) / FRAME + 1e-10)
        spectrum = np.fft.rfft(cut * _HANN, FFT)
        mel[at:end] = 10 * np.log10((spectrum.real**2 + spectrum.imag**2).astype(np.float32) @ _BANK + 1e-10)
    return np.round(mel, 2) + np.float32(0), np.round(energy, 2) + np.float32(0)


def segments(energy: np.ndarray, enter: float = ENTER, leave: float = LEAVE, hang: int = HANG) -> list[tuple[int, int]]:
    """Frame spans [a, b) by hysteresis between two levels, set in the recording's own range of energies.

    A span starts at a frame of at least the upper level and ends before the first of ``hang`` frames in a row
    below the lower one (or at the end). A recording of constant energy is one span."""
    floor, top = np.percentile(energy, [10, 95])
    enter, leave = floor + enter * (top - floor), floor + leave * (top - floor)
    low = energy < leave
    run = np.convolve(low, np.ones(hang, int))[: len(low)] == hang  # at the last of hang low frames
    ends, starts = np.flatnonzero(run), np.flatnonzero(energy >= enter)
    out, at = [], 0
    while (i := np.searchsorted(starts, at)) < len(starts):
        a = int(starts[i])
        j = np.searchsorted(ends, a + hang)
        at = int(ends[j]) + 1 if j < len(ends) else len(energy)
        out.append((a, at - hang if j < len(ends) else at))
    return out


TENSOR = pa.fixed_shape_tensor(pa.float32(), [WINDOW, MELS])


def tensors(mel: np.ndarray, rate: float = RATE * UP / DOWN) -> pa.RecordBatch:
    """start_s, end_s and log_mel (WINDOW x MELS); the last window is filled up with the floor of -100 dB."""
    n = -(-len(mel) // WINDOW)
    full = np.full((n * WINDOW, MELS), -100, np.float32)
    full[: len(mel)] = mel
    start = np.arange(n) * WINDOW * HOP / rate
    end = (np.minimum((np.arange(n) + 1) * WINDOW, len(mel)) - 1) * HOP / rate + FRAME / rate
    flat = pa.FixedSizeListArray.from_arrays(pa.array(full.ravel()), WINDOW * MELS)
    return pa.RecordBatch.from_arrays([pa.array(start), pa.array(end), pa.ExtensionArray.from_storage(TENSOR, flat)], ["start_s", "end_s", "log_mel"])


def ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def features(media: bytes) -> tuple[pa.RecordBatch, list[tuple[float, float]]]:
    """Tensors with their spans, and the active segments in seconds, of a stored recording."""
    samples, rate = read_wave(media)
    mel, energy = log_mel(np.frombuffer(samples, np.uint8))
    second = HOP * DOWN / UP / rate
    return tensors(mel, rate * UP / DOWN), [(round(a * second, 4), round(b * second, 4)) for a, b in segments(energy)]


SCHEMA = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_windows long, n_segments long"


def audio_features(docs: DataFrame, keep: bool = False) -> DataFrame:
    """One row per document: the stored form's digests and a digest of its features.

    With keep also media (WAVE bytes), tensors (Arrow IPC stream) and segments (seconds). Null or empty text is
    64 bytes of 0. feature is windows:segments:sha256 of the IPC stream and the segments. Equal texts give equal
    values; repeated rows and null ids come out as they go in; an empty table gives no rows. Texts of any length are
    read whole; further columns, whatever their names, are not read.
    """

    def mapped(batches):
        for whole in batches:
            for batch in slices(whole):
                rows = []
                for text in texts(batch):
                    data, n = payload(text)
                    media = wave(data)
                    back, _ = read_wave(media)
                    found, spans = features(media)
                    stream = ipc(found)
                    mark = hashlib.sha256(stream + repr(spans).encode()).hexdigest()
                    row = (n, len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-PAD:]), len(media), hashlib.sha256(media).hexdigest(), f"{found.num_rows}:{len(spans)}:{mark}", found.num_rows, len(spans))
                    rows.append((*row, media, stream, spans) if keep else row)
                cols = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                if keep:
                    kinds += [pa.binary(), pa.binary(), pa.list_(pa.list_(pa.float64()))]
                    names += ["media", "tensors", "segments"]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))], names)

    return id_and_text(docs).mapInArrow(mapped, SCHEMA + (", media binary, tensors binary, segments array<array<double>>" if keep else ""))


def op1_audio_features(spark, sf_dir: str) -> DataFrame:
    return audio_features(documents(spark, sf_dir))
