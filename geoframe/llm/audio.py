"""Media columns: lossless 8-bit audio, polyphase resampling, log-mel patches and energy segments with time spans."""

from __future__ import annotations

import hashlib
import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache
from math import gcd
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoframe.llm.common import stored, table, text_bytes

RATE, TARGET = 16000, 8000
FRAME, HOP, FFT, MELS = 200, 80, 256, 24
#: A patch is so many frames by MELS bands; the last one of a clip is padded with the floor.
PATCH = 16
FLOOR = 1e-6
#: Samples that are worked off at once.
SLICE = 1 << 18
#: Decibels over the clip's median at which a segment begins, and under which it ends.
BEGIN_DB, END_DB = 1.5, 0.5
ALIGN = 64


def to_wav(payload: bytes, rate: int = RATE) -> bytes:
    """A mono WAV file of unsigned 8-bit samples, the payload's bytes."""
    return struct.pack("<4sI4s4sIHHIIHH4sI", b"RIFF", 36 + len(payload), b"WAVE", b"fmt ", 16, 1, 1, rate, rate, 1, 8, b"data", len(payload)) + payload


def from_wav(media: bytes) -> tuple[int, bytes]:
    """(rate, payload) of a mono 8-bit WAV file."""
    if media[:4] != b"RIFF" or media[8:12] != b"WAVE":
        raise ValueError("not a WAV file")
    at, rate = 12, 0
    while at + 8 <= len(media):
        name, size = struct.unpack("<4sI", media[at : at + 8])
        if name == b"fmt ":
            kind, channels, rate, _, _, bits = struct.unpack("<HHIIHH", media[at + 8 : at + 24])
            if (kind, channels, bits) != (1, 1, 8):
                raise ValueError("not mono 8-bit samples")
        elif name == b"data":
            return rate, media[at + 8 : at + 8 + size]
        at += 8 + size + size % 2
    raise ValueError("a WAV file without samples")


def padded(text: bytes) -> bytes:
    """The text and zero bytes up to a positive multiple of ALIGN."""
    return text + bytes(max(ALIGN, -(-len(text) // ALIGN) * ALIGN) - len(text))


@lru_cache(8)
def _phases(up: int, down: int) -> np.ndarray:
    """Windowed-sinc low-pass taps, one row for each of ``up`` phases, in the order in which they meet rising samples."""
    wide = 8 * max(up, down)
    t = np.arange(-wide, wide + 1)
    taps = np.sinc(t / max(up, down)) * np.hanning(2 * wide + 3)[1:-1]
    taps *= up / taps.sum()
    per = -(-len(taps) // up)
    table = np.zeros((up, per))
    for phase in range(up):
        own = taps[phase::up]
        table[phase, per - len(own) :] = own[::-1]
    return table


def resample(x: np.ndarray, rate: int, target: int) -> np.ndarray:
    """Polyphase resampling by a rational factor: each output sample is a dot product with the taps of its own phase only.

    x are float samples, or unsigned 8-bit ones, which are brought to -1..1. Long clips are worked off in slices.
    """
    level = (lambda y: (y.astype(np.float32) - 128) / 128) if x.dtype == np.uint8 else (lambda y: y.astype(np.float32))
    g = gcd(rate, target)
    up, down = target // g, rate // g
    if up == down or not len(x):
        return level(x)
    table = _phases(up, down)
    per = table.shape[1]
    delay = 8 * max(up, down)
    n = -(-len(x) * up // down)
    out = np.empty(n, np.float32)
    for begin in range(0, n, SLICE):
        place = np.arange(begin, min(n, begin + SLICE)) * down + delay
        newest, phase = place // up, place % up
        first = int(newest[0]) - per + 1
        held = np.zeros(int(newest[-1]) + 1 - first, np.float32)
        part = level(x[max(0, first) : int(newest[-1]) + 1])
        held[max(0, -first) : max(0, -first) + len(part)] = part
        windows = np.lib.stride_tricks.sliding_window_view(held, per)
        for p in range(up):
            own = np.flatnonzero(phase == p)
            # in double precision, so that what kernels round otherwise is gone in the single precision of the samples
            out[begin + own] = windows[newest[own] - per + 1 - first].astype(np.float64) @ table[p]
    return out


@lru_cache(4)
def _mel(rate: int) -> np.ndarray:
    """Triangular filters, evenly spaced in mel from 0 to half the rate."""
    top = 2595 * np.log10(1 + rate / 2 / 700)
    hertz = 700 * (10 ** (np.linspace(0, top, MELS + 2) / 2595) - 1)
    bins = np.fft.rfftfreq(FFT, 1 / rate)
    rise = (bins[None] - hertz[:-2, None]) / (hertz[1:-1] - hertz[:-2])[:, None]
    fall = (hertz[2:, None] - bins[None]) / (hertz[2:] - hertz[1:-1])[:, None]
    return np.maximum(0, np.minimum(rise, fall)).T


class Features(NamedTuple):
    patches: np.ndarray  # (patches, PATCH, MELS) float16
    spans: np.ndarray  # (patches, 2) seconds
    segments: np.ndarray  # (segments, 2) seconds


def features(media: bytes, target: int = TARGET) -> Features:
    """Log-mel patches of the resampled clip and its energetic segments. A clip shorter than a frame is padded to one.

    Sums are taken in double precision and kept in half, for which it doesn't matter in which order a
    processor's kernels add. Memory is about ten bytes a sample, however long the clip.
    """
    rate, payload = from_wav(media)
    x = resample(np.frombuffer(payload, np.uint8), rate, target)
    n = 1 + max(0, -(-(len(x) - FRAME) // HOP))
    held = np.zeros((n - 1) * HOP + FRAME, np.float32)
    held[: min(len(x), len(held))] = x[: len(held)]
    window = np.hanning(FRAME + 2)[1:-1]
    count = -(-n // PATCH)
    mel = np.full((count * PATCH, MELS), np.log(FLOOR), np.float16)
    energy = np.empty(n, np.float32)
    for begin in range(0, n, SLICE // 2 // HOP):
        end = min(n, begin + SLICE // 2 // HOP)
        frames = np.lib.stride_tricks.sliding_window_view(held[begin * HOP : (end - 1) * HOP + FRAME], FRAME)[::HOP] * window
        spectrum = np.fft.rfft(frames, FFT)
        power = spectrum.real**2 + spectrum.imag**2
        mel[begin:end] = np.log(power @ _mel(target) + FLOOR)
        energy[begin:end] = 10 * np.log10(np.square(frames).mean(1) + FLOOR)
    energy -= np.median(energy)
    # a segment is a run of frames over the lower threshold that reaches the upper one
    weak = np.concatenate(([0], energy >= END_DB, [0])).astype(np.int8)
    begin, end = np.flatnonzero(np.diff(weak) == 1), np.flatnonzero(np.diff(weak) == -1)
    strong = np.concatenate(([0], np.cumsum(energy >= BEGIN_DB)))
    loud = strong[end] > strong[begin]
    segments = np.stack((begin[loud] * HOP, (end[loud] - 1) * HOP + FRAME), 1) / target
    first = np.arange(count) * PATCH
    spans = np.stack((first * HOP, (np.minimum(first + PATCH, n) - 1) * HOP + FRAME), 1) / target
    return Features(mel.reshape(count, PATCH, MELS), spans, segments)


def media_column(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, media): each whole text's UTF-8 bytes, padded, as an 8-bit WAV file. Null text is empty; rows stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, sizes, media, held = batch.column(0), [], [], 0
            begin = 0
            for text in text_bytes(batch.column(1)):
                sizes.append(len(text))
                media.append(to_wav(padded(text)))
                held += len(text)
                if held >= 1 << 23:
                    yield pa.record_batch([ids.slice(begin, len(sizes)), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])
                    begin, sizes, media, held = begin + len(sizes), [], [], 0
            yield pa.record_batch([ids.slice(begin), pa.array(sizes, pa.int64()), pa.array(media, pa.binary())], ["doc_id", "n_bytes", "media"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_bytes long, media binary")


def audio_patches(media: DataFrame, target: int = TARGET) -> DataFrame:
    """(doc_id, patch, start_s, end_s, logmel): one row for each PATCH x MELS tensor with its time span; null media gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if data.is_valid:
                    got = features(data.as_py(), target)
                    n = len(got.patches)
                    tensor = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * PATCH * MELS, pa.int32()), pa.array(got.patches.ravel().astype(np.float32)))
                    yield pa.record_batch([pa.array([doc] * n, pa.int64()), pa.array(np.arange(n)), pa.array(got.spans[:, 0]), pa.array(got.spans[:, 1]), tensor], ["doc_id", "patch", "start_s", "end_s", "logmel"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, patch long, start_s double, end_s double, logmel array<float>")


def audio_segments(media: DataFrame, target: int = TARGET) -> DataFrame:
    """(doc_id, segment, start_s, end_s) of the energetic segments of each clip."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if data.is_valid:
                    got = features(data.as_py(), target).segments
                    yield pa.record_batch([pa.array([doc] * len(got), pa.int64()), pa.array(np.arange(len(got))), pa.array(got[:, 0]), pa.array(got[:, 1])], ["doc_id", "segment", "start_s", "end_s"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, segment long, start_s double, end_s double")


TENSOR = pa.fixed_shape_tensor(pa.float16(), (PATCH, MELS), dim_names=["frame", "mel"])


def to_tensors(got: Features) -> bytes:
    """An Arrow stream of the patches (start_s, end_s, logmel as fixed-shape tensors), then of the segments (start_s, end_s)."""
    storage = pa.FixedSizeListArray.from_arrays(pa.array(got.patches.ravel()), PATCH * MELS)
    patches = pa.table({"start_s": got.spans[:, 0], "end_s": got.spans[:, 1], "logmel": pa.ExtensionArray.from_storage(TENSOR, storage)})
    segments = pa.table({"start_s": got.segments[:, 0], "end_s": got.segments[:, 1]})
    out = pa.BufferOutputStream()
    for part in (patches, segments):
        with pa.ipc.new_stream(out, part.schema) as writer:
            writer.write_table(part)
    return out.getvalue().to_pybytes()


def from_tensors(data: bytes) -> Features:
    """What to_tensors has written; the patches are a view of the data."""
    source = pa.BufferReader(data)
    patches, segments = (pa.ipc.open_stream(source).read_all().combine_chunks() for _ in range(2))
    spans = [np.stack((x.column("start_s").to_numpy(), x.column("end_s").to_numpy()), 1) for x in (patches, segments)]
    return Features(patches.column("logmel").chunk(0).to_numpy_ndarray(), *spans)


def audio_tensors(media: DataFrame, target: int = TARGET) -> DataFrame:
    """(doc_id, tensors): each clip's Arrow stream of fixed-shape tensors with their time spans; null media gives no row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if data.is_valid:
                    yield pa.record_batch([pa.array([doc], pa.int64()), pa.array([to_tensors(features(data.as_py(), target))], pa.binary())], ["doc_id", "tensors"])

    return media.select("doc_id", "media").mapInArrow(run, "doc_id long, tensors binary")


def _describe(got: Features) -> str:
    """Shape, number of segments and their seconds, mean and spread, and a digest of the values."""
    return f"{len(got.patches)}x{PATCH}x{MELS};segments={len(got.segments)};loud_s={float(np.diff(got.segments).sum()):.3f};mean={got.patches.mean(dtype=np.float64):.3f};std={got.patches.std(dtype=np.float64):.3f};sha256={hashlib.sha256(np.ascontiguousarray(got.patches).tobytes()).hexdigest()[:16]}"


def op6_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Media are written and read, from what is read tensors are written, and from the tensors that are read comes the feature."""
    media = stored(media_column(table(spark, sf_dir, "documents")), "media")
    kinds = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "payload_bytes": pa.int64(), "payload_sha256": pa.string(), "tail_crc32": pa.int64(), "media_bytes": pa.int64(), "media_sha256": pa.string(), "tensors": pa.binary()}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, held = [], 0
            for doc, n, data in zip(*(batch.column(k) for k in range(3))):
                doc, n, data = doc.as_py(), n.as_py(), data.as_py()
                payload = from_wav(data)[1]
                rows.append((doc, n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-ALIGN:]), len(data), hashlib.sha256(data).hexdigest(), to_tensors(features(data))))
                held += len(data)
                if held >= 1 << 23:
                    yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))
                    rows, held = [], 0
            if rows:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*rows), kinds.values())], list(kinds))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            told = [_describe(from_tensors(x.as_py())) for x in batch.column(7)]
            yield pa.record_batch([*batch.columns[:7], pa.array(told, pa.string())], [*list(kinds)[:7], "feature"])

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, "
    tensors = stored(media.mapInArrow(measure, schema + "tensors binary"), "tensors")
    return tensors.mapInArrow(describe, schema + "feature string")
