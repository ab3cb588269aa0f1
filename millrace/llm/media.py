"""Chroma audio fingerprints of a column of WAV recordings, and search by aligning them.

A recording becomes frames of energy by pitch class; over their integral image, filters compare the sums of two areas;
each comparison gives two bits, and the filters at one time step a packed integer. Recordings that share two integers
in a row, at one offset, are candidates: a histogram of offsets picks the alignment, and the share of differing bits
over the overlap decides. Recordings with equal fingerprints are one class, so copies are searched once.

Recordings are decoded, resampled and turned into frames block by block, so that long ones need no more memory than
their fingerprints.
"""

from __future__ import annotations

import functools
import hashlib
import io
import itertools
import wave
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, small

#: Samples a second at which chroma is taken: enough for pitches up to A7. Rates outside KNOWN_RATES are no audio.
RATE = 11_025
KNOWN_RATES = (2_000, 400_000)
FRAME = 4096
HOP = 1024
LOW_HZ, HIGH_HZ = 55.0, 3520.0
SMOOTH = np.array([1.0, 2.0, 3.0, 2.0, 1.0]) / 3
BLOCK = 2**18
#: Frames that a packed integer looks at.
SPAN = 16
#: Filters (kind, first pitch class, pitch classes, frames) by rule: four kinds over the lower and the upper half of the
#: octave, over the whole span and half of it. Kinds: the area against the rest of the octave ("all"), its upper against
#: its lower half ("pitch"), its second against its first half in time ("time"), both crossed ("cross").
FILTERS = tuple((kind, low, 6, frames) for frames in (SPAN, SPAN // 2) for low in (0, 6) for kind in ("all", "pitch", "time", "cross"))
#: Log ratios that part the four levels of a comparison; the levels are Gray-coded.
LEVELS = np.array([-0.25, 0.0, 0.25])
GRAY = np.array([0, 1, 3, 2], np.uint32)


def _decoded(w: wave.Wave_read) -> Iterator[np.ndarray]:
    """Mono blocks from -1 to 1 of a file's samples."""
    width, channels = w.getsampwidth(), w.getnchannels()
    while raw := w.readframes(BLOCK // channels + 1):
        raw = raw[: len(raw) // (width * channels) * width * channels]
        if width == 1:
            x = (np.frombuffer(raw, np.uint8).astype(np.float32) - 128) / 128
        elif width == 3:
            b = np.frombuffer(raw, np.uint8).reshape(-1, 3).astype(np.int32)
            x = (((b[:, 0] | b[:, 1] << 8 | b[:, 2] << 16) ^ 0x800000) - 0x800000).astype(np.float32) / 2**23
        else:
            x = np.frombuffer(raw, f"<i{width}").astype(np.float32) / 2 ** (8 * width - 1)
        yield x.reshape(-1, channels).mean(axis=1)


def _filtered(blocks: Iterable[np.ndarray], rate: int) -> Iterator[np.ndarray]:
    """Without what lies over half of RATE, which sampling at RATE would fold into lower pitches."""
    half = 16 * -(-rate // RATE)
    at = np.arange(-half, half + 1)
    taps = np.sinc(at * RATE / rate * 0.95) * np.hamming(len(at))
    taps /= taps.sum()
    held = np.zeros(half)
    for part in itertools.chain(blocks, [np.zeros(half)]):
        held = np.concatenate((held, part))
        if len(held) >= len(taps):
            size = 1 << (len(held) - 1).bit_length()
            both = np.fft.irfft(np.fft.rfft(held, size) * np.fft.rfft(taps, size), size)
            out = both[len(taps) - 1 : len(held)]
            held = held[len(out) :]
            yield out


def _resampled(blocks: Iterable[np.ndarray], rate: int) -> Iterator[np.ndarray]:
    if rate == RATE:
        yield from blocks
        return
    step, base, k, last = rate / RATE, 0, 0, np.zeros(0)
    for part in _filtered(blocks, rate) if rate > RATE else blocks:
        x = np.concatenate((last, part))
        first, past = base - len(last), base + len(part) - 1
        n = max(0, int(np.floor(past / step)) + 1 - k)
        yield np.interp((k + np.arange(n)) * step, first + np.arange(len(x)), x)
        base, k, last = base + len(part), k + n, x[-1:]


def wav_blocks(data: bytes | None) -> Iterator[np.ndarray]:
    """Mono samples at RATE, from -1 to 1, in blocks; none if the bytes aren't a PCM WAV file of a known rate."""
    try:
        with wave.open(io.BytesIO(data or b"")) as w:
            rate = w.getframerate()
            if w.getsampwidth() in (1, 2, 3, 4) and KNOWN_RATES[0] <= rate <= KNOWN_RATES[1]:
                yield from _resampled(_decoded(w), rate)
    except (wave.Error, EOFError):
        return


def read_wav(data: bytes | None) -> np.ndarray:
    return np.concatenate([np.zeros(0), *wav_blocks(data)])


def _pitch_map() -> np.ndarray:
    hz = np.arange(FRAME // 2 + 1) * RATE / FRAME
    out = np.zeros((len(hz), 12), np.float32)
    good = np.nonzero((hz >= LOW_HZ) & (hz <= HIGH_HZ))[0]
    out[good, np.round(12 * np.log2(hz[good] / 440.0) + 69).astype(int) % 12] = 1
    return out


PITCH = _pitch_map()
WINDOW = np.hanning(FRAME).astype(np.float32)


def _energies(blocks: Iterable[np.ndarray]) -> Iterator[np.ndarray]:
    held = np.zeros(0, np.float32)
    for block in blocks:
        held = np.concatenate((held, np.asarray(block, np.float32)))
        if len(held) < FRAME:
            continue
        frames = np.lib.stride_tricks.sliding_window_view(held, FRAME)[::HOP]
        for i in range(0, len(frames), 128):
            yield np.abs(np.fft.rfft(frames[i : i + 128] * WINDOW)).astype(np.float32) ** 2 @ PITCH
        held = held[len(frames) * HOP :]


def chroma(samples: np.ndarray | Iterable[np.ndarray]) -> np.ndarray:
    """Frames of energy by pitch class, smoothed in time and of unit length, from samples or blocks of them."""
    out = np.concatenate([np.zeros((0, 12)), *_energies([samples] if isinstance(samples, np.ndarray) else samples)])
    if len(out) < len(SMOOTH):
        return np.zeros((0, 12))
    out = np.stack([np.convolve(out[:, k], SMOOTH, "valid") for k in range(12)], axis=1)
    size = np.linalg.norm(out, axis=1, keepdims=True)
    return np.where(size > 1e-3, out / np.maximum(size, 1e-3), 0.0)


def fingerprint(samples: np.ndarray | Iterable[np.ndarray]) -> np.ndarray:
    """A packed 32-bit integer for each frame that has SPAN frames after it."""
    return packed(chroma(samples))


def packed(frames: np.ndarray) -> np.ndarray:
    n = len(frames) - SPAN + 1
    if n < 1:
        return np.zeros(0, np.uint32)
    image = np.zeros((len(frames) + 1, 13))
    image[1:, 1:] = frames.cumsum(axis=0).cumsum(axis=1)

    def area(t0: int, t1: int, p0: int, p1: int) -> np.ndarray:
        """Sums of the frames t0 to t1 after each, pitch classes p0 to p1."""
        return image[t1 : t1 + n, p1] - image[t0 : t0 + n, p1] - image[t1 : t1 + n, p0] + image[t0 : t0 + n, p0]

    code = np.zeros(n, np.uint32)
    for i, (kind, p, h, w) in enumerate(FILTERS):
        q, t, s = p + h, w // 2, p + h // 2
        if kind == "all":
            a = area(0, w, p, q) * (12 - h) / h
            b = area(0, w, 0, 12) - area(0, w, p, q)
        elif kind == "pitch":
            a, b = area(0, w, s, q), area(0, w, p, s)
        elif kind == "time":
            a, b = area(t, w, p, q), area(0, t, p, q)
        else:
            a, b = area(0, t, p, s) + area(t, w, s, q), area(0, t, s, q) + area(t, w, p, s)
        level = np.searchsorted(LEVELS, np.round(np.log((0.01 + np.maximum(a, 0)) / (0.01 + np.maximum(b, 0))), 9))
        code |= GRAY[level] << np.uint32(2 * i)
    return code


@functools.cache
def _silence() -> int:
    return int(packed(np.zeros((SPAN, 12)))[0])


def marks(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and values of two integers in a row, joined: where a value begins, and not of silence.

    So a long note or pause, which is one value at many positions, doesn't meet another at each pair of them.
    """
    both = codes.astype(np.int64)
    joined = both[:-1] << 32 | both[1:]
    new = np.ones(len(joined), bool)
    new[1:] = joined[1:] != joined[:-1]
    at = np.nonzero(new & (joined != (_silence() << 32 | _silence())))[0]
    return at, joined[at]


def bit_error(a: np.ndarray, b: np.ndarray, offset: int, least: int) -> float:
    """Share of differing bits where ``a`` shifted by ``offset`` lies over ``b``; 1 if fewer than ``least`` integers do."""
    i, j = max(0, -offset), max(0, offset)
    n = min(len(a) - i, len(b) - j)
    return 1.0 if n < least else float(np.bitwise_count(a[i : i + n] ^ b[j : j + n]).sum()) / (32 * n)


def fingerprints(audio: DataFrame, *, id_col: str, audio_col: str) -> DataFrame:
    """Per row: id, codes (array of long), print (hex digest of the codes), places and marks (see ``marks``).

    Null, broken or too short audio, and audio of unlikely rates, has no codes.
    """

    def run(frames):
        for frame in frames:
            for i in range(0, len(frame), 64):
                part = frame.iloc[i : i + 64]
                codes = [fingerprint(wav_blocks(x)) for x in part["audio"]]
                found = [marks(c) for c in codes]
                yield pd.DataFrame(
                    {
                        "id": part["id"].array,
                        "codes": [c.astype(np.int64) for c in codes],
                        "print": [hashlib.sha256(c.astype("<u4").tobytes()).hexdigest() for c in codes],
                        "places": [at for at, _ in found],
                        "marks": [x for _, x in found],
                    }
                )

    return audio.select(F.col(id_col).cast("long").alias("id"), F.col(audio_col).alias("audio")).mapInPandas(run, "id long, codes array<long>, print string, places array<int>, marks array<long>")


def align(
    audio: DataFrame, *, id_col: str, audio_col: str, query_every: int = 50, max_error: float = 0.2, least_overlap: int = 8
) -> DataFrame:
    """One row per row of ``audio``: id, n_codes, print, class_id, is_query, matches.

    class_id: smallest id of the recordings with the same codes. Queries are the rows whose id is divisible by
    ``query_every``, against all rows. matches, for queries: the classes (class_id, offset, bit_error, votes) that share
    two integers in a row and, at the offset with most votes (ties: the smallest in size), differ in at most
    ``max_error`` of the bits of at least ``least_overlap`` integers; by error, then class; its own class is not listed.
    Rows without codes have a class_id of their own (their id), match nothing and are no copies of each other. Null
    ids are no queries. Repeated rows stay. No rows in, no rows out.
    """
    rows = cut(fingerprints(audio, id_col=id_col, audio_col=audio_col))
    first = F.first(F.struct("codes", "places", "marks")).alias("first")  # of equal codes they are equal
    asked = F.max((F.col("id") % query_every == 0).cast("int")).alias("asked")
    classes = cut(rows.where(F.size("codes") > 0).groupBy("print").agg(F.min("id").alias("class_id"), asked, first).select("print", "class_id", "asked", "first.*"))

    def exploded(df: DataFrame, name: str) -> DataFrame:
        both = F.explode(F.arrays_zip("places", "marks")).alias("x")
        return df.select(F.col("print").alias(name), both).select(name, F.col("x.places").alias(f"at_{name}"), F.col("x.marks").alias("mark"))

    queries = classes.where("asked = 1")
    met = exploded(queries, "q").join(exploded(classes, "c"), "mark").where("q <> c")
    votes = met.groupBy("q", "c", (F.col("at_c") - F.col("at_q")).alias("offset")).agg(F.count("*").alias("votes"))
    best = votes.groupBy("q", "c").agg(F.max(F.struct("votes", (-F.abs("offset")).alias("near"), "offset")).alias("b")).select("q", "c", "b.votes", "b.offset")
    pairs = best.join(queries.select(F.col("print").alias("q"), F.col("codes").alias("a")), "q").join(classes.select(F.col("print").alias("c"), F.col("codes").alias("b"), "class_id"), "c")

    def judge(frames):
        for f in frames:
            error = [bit_error(np.asarray(a, np.uint32), np.asarray(b, np.uint32), o, least_overlap) for a, b, o in zip(f["a"], f["b"], f["offset"])]
            yield pd.DataFrame({"q": f["q"], "class_id": f["class_id"], "offset": f["offset"], "bit_error": np.round(error, 6), "votes": f["votes"]})

    near = pairs.mapInPandas(judge, "q string, class_id long, offset int, bit_error double, votes long").where(F.col("bit_error") <= max_error)
    listed = near.groupBy("q").agg(F.sort_array(F.collect_list(F.struct("bit_error", "class_id", "offset", "votes"))).alias("matches"))
    named = cut(classes.select("print", "class_id").join(listed.withColumnRenamed("q", "print"), "print", "left"))
    out = rows.join(named, "print", "left")
    asked = F.coalesce(F.col("id") % query_every == 0, F.lit(False))
    return out.select(
        "id",
        F.greatest(F.size("codes"), F.lit(0)).cast("long").alias("n_codes"),
        "print",
        F.when(F.size("codes") > 0, F.col("class_id")).otherwise(F.col("id")).alias("class_id"),
        asked.alias("is_query"),
        F.when(asked, F.coalesce("matches", F.array().cast("array<struct<bit_error:double,class_id:long,offset:int,votes:long>>"))).alias("matches"),
    )


def render(values, note_s: float = 0.08, rate: int = RATE) -> bytes:
    """A WAV file with a note for each value: the value moves the pitch by semitones from A3. Null or empty: no samples."""
    values = np.asarray(values if values is not None else [], float)
    pitch = np.clip(np.round(12 * np.nan_to_num(values) / 0.25), -24, 24)
    hz = np.repeat(220.0 * 2 ** (pitch / 12), int(note_s * rate))
    phase = np.cumsum(2 * np.pi * hz / rate)
    samples = (0.5 * np.sin(phase) + 0.2 * np.sin(2 * phase)) if len(hz) else np.zeros(0)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((samples * 32767).astype("<i2").tobytes())
    return out.getvalue()


def take(data: bytes, seed: int, cut_frames: int = 0, noise: float = 0.02) -> bytes:
    """Another recording of a WAV file at RATE: without its first frames, and with noise."""
    x = read_wav(data)[cut_frames * HOP :]
    x = np.clip(x + np.random.default_rng(seed).normal(0, noise, len(x)), -1, 1)
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes((x * 32767).astype("<i2").tobytes())
    return out.getvalue()


def rendered(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", every: int = 50) -> DataFrame:
    """(id, audio): the vectors as recordings of their values' melodies. The tables hold no audio; this makes some.

    Rows whose id leaves 3 by 5 are noisy, cut takes of the melody of the row at which their ``every`` ids begin, if
    there is one; all others are of their own vector. So what a search should find is known.
    """
    own = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    head = own.where(F.col("vec_id") % every == 0).groupBy(F.col("vec_id").alias("head")).agg(F.first("v").alias("head_v"))
    is_take = F.col("vec_id") % 5 == 3
    rows = own.withColumn("head", F.when(is_take, F.col("vec_id") - F.col("vec_id") % every)).join(small(head, 20_000), "head", "left")  # a table of that many vectors is some 10 MB

    def run(frames):
        for f in frames:
            for i in range(0, len(f), 64):
                part = f.iloc[i : i + 64]
                audio = [render(v) if h is None else take(render(h), int(k), int(k) // 5 % 4 * 3) for k, v, h in zip(part["vec_id"], part["v"], part["head_v"])]
                yield pd.DataFrame({"vec_id": part["vec_id"].array, "audio": audio})

    return rows.select("vec_id", "v", "head_v").mapInPandas(run, "vec_id long, audio binary")
