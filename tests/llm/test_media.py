import io
import wave

import numpy as np
import pytest
from millrace.llm.media import HOP, RATE, align, bit_error, chroma, fingerprint, marks, read_wav, render, rendered, wav_blocks


def tune(seed, n=60):
    return np.random.default_rng(seed).normal(0, 0.2, n)


def noisy(data, seed, level=0.02, cut=0):
    x = read_wav(data)[cut:]
    x = x + np.random.default_rng(seed).normal(0, level, len(x))
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(2)
        w.setframerate(RATE)
        w.writeframes((np.clip(x, -1, 1) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def test_chroma_finds_the_pitch():
    t = np.arange(RATE * 2) / RATE
    for name, hz in ((9, 440.0), (0, 261.63), (4, 329.63)):
        assert set(chroma(np.sin(2 * np.pi * hz * t)).argmax(axis=1)) == {name}


def test_fingerprint_by_plain_sums():
    from millrace.llm.media import FILTERS, GRAY, LEVELS, SPAN

    x = read_wav(render(tune(1)))
    f, got = chroma(x), fingerprint(x)
    assert len(got) == len(f) - SPAN + 1
    t0 = 5
    for i, (kind, p, h, w) in enumerate(FILTERS):
        part = f[t0 : t0 + w, p : p + h]
        lower, upper, first, second = part[:, : h // 2], part[:, h // 2 :], part[: w // 2], part[w // 2 :]
        a, b = {
            "all": (part.sum() * (12 - h) / h, f[t0 : t0 + w].sum() - part.sum()),
            "pitch": (upper.sum(), lower.sum()),
            "time": (second.sum(), first.sum()),
            "cross": (first[:, : h // 2].sum() + second[:, h // 2 :].sum(), first[:, h // 2 :].sum() + second[:, : h // 2].sum()),
        }[kind]
        assert (int(got[t0]) >> 2 * i) & 3 == GRAY[np.searchsorted(LEVELS, np.log((0.01 + a) / (0.01 + b)))]


@pytest.mark.parametrize("width", [1, 2, 3, 4])
def test_read_wav_widths(width):
    out = io.BytesIO()
    x = np.array([0.0, 0.5, -0.5, 0.25])
    with wave.open(out, "wb") as w:
        w.setnchannels(2)
        w.setsampwidth(width)
        w.setframerate(RATE)
        both = np.repeat(x, 2)
        raw = ((both * 128 + 128).astype(np.uint8).tobytes() if width == 1 else b"".join(int(v * 2 ** (8 * width - 1)).to_bytes(width, "little", signed=True) for v in both))
        w.writeframes(raw)
    assert np.allclose(read_wav(out.getvalue()), x, atol=0.01)


def test_broken_audio():
    assert all(len(read_wav(x)) == 0 for x in (None, b"", b"RIFF", b"nonsense" * 9, render([]), render(None)))
    assert len(fingerprint(read_wav(render(tune(3, 3))))) == 0


def brute(codes, query_every=50, max_error=0.2, least=8):
    """Best offset of all, over classes; the true matches of each query."""
    out = {}
    classes = {}
    for i, c in sorted(codes.items()):
        classes.setdefault(c.tobytes(), (i, c))
    for i, c in codes.items():
        if i % query_every == 0 and len(c):
            out[i] = set()
            for k, d in classes.values():
                if len(d) and d.tobytes() != c.tobytes() and min((bit_error(c, d, o, least) for o in range(-len(c), len(d) + 1)), default=1) <= max_error:
                    out[i].add(k)
    return out


def test_search_against_brute_force(spark):
    rows = [(i, render(tune(i % 17 + 100))) for i in range(40)]
    rows += [(100 + i, noisy(render(tune(i + 100)), i)) for i in range(17)]
    rows += [(200 + i, noisy(render(tune(i + 100)), i, cut=HOP * 3 * (i % 4))) for i in range(17)]
    rows += [(300, None), (None, b"x"), (350, b""), (0, rows[0][1])]
    df = spark.createDataFrame(rows, "vec_id long, audio binary").repartition(4)
    got = align(df, id_col="vec_id", audio_col="audio", query_every=5).collect()
    assert len(got) == len(rows)
    codes = {i: fingerprint(read_wav(a)) for i, a in rows if i is not None}
    want = brute(codes, 5)
    found = {r.id: {m.class_id for m in r.matches} for r in got if r.is_query and r.n_codes}
    assert set(found) == set(want)
    hit, total = sum(len(found[i] & want[i]) for i in want), sum(map(len, want.values()))
    assert total > 15 and hit / total >= 0.9
    assert all(m.bit_error <= 0.2 for r in got for m in r.matches or [])
    assert all(r.class_id == min(k for k, c in codes.items() if np.array_equal(c, codes[r.id])) for r in got if r.n_codes)
    assert {r.class_id for r in got if not r.n_codes} == {300, None, 350}
    shift = {m.class_id: m.offset for r in got if r.id == 5 for m in r.matches}
    assert shift.get(205) == -3


def test_good_audio_under_null_ids_and_clashing_columns(spark):
    """A class all of whose ids are null is found, by codes and marks of its own; extra columns do no harm."""
    rows = [(50, render(tune(3))), (None, noisy(render(tune(3)), 1)), (None, render(tune(4))), (7, render(tune(5)))]
    df = spark.createDataFrame([(*r, 1, "p", [2]) for r in rows], "vec_id long, audio binary, id int, print string, codes array<int>").repartition(2)
    got = align(df, id_col="vec_id", audio_col="audio").collect()
    (asked,) = [r for r in got if r.is_query]
    assert [m.class_id for m in asked.matches] == [None] and asked.matches[0].bit_error < 0.2
    assert sorted(str(r.class_id) for r in got) == ["50", "7", "None", "None"] and all(r.n_codes for r in got)


def test_table_rows(spark, sf):
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").limit(60)
    extra = spark.createDataFrame([(900, None, 0), (901, [], 0)], "vec_id long, embedding array<float>, label int")
    rows = align(rendered(vectors.union(extra)), id_col="vec_id", audio_col="audio").collect()
    assert len(rows) == 62 and sum(r.n_codes == 0 for r in rows) == 2 and all((r.matches is None) == (r.id % 50 != 0) for r in rows)
    assert align(rendered(vectors.limit(0)), id_col="vec_id", audio_col="audio").count() == 0


def wav(x, rate, channels=1):
    out = io.BytesIO()
    with wave.open(out, "wb") as w:
        w.setnchannels(channels)
        w.setsampwidth(2)
        w.setframerate(rate)
        w.writeframes((np.repeat(np.clip(x, -1, 1), channels) * 32767).astype("<i2").tobytes())
    return out.getvalue()


def with_rate(data, rate):
    return data[:24] + rate.to_bytes(4, "little") + data[28:]


def test_unlikely_rates_are_no_audio():
    data = wav(np.zeros(5000), RATE)
    assert all(len(read_wav(with_rate(data, r))) == 0 for r in (0, 1, 1999, 2**31)) and len(read_wav(with_rate(data, 22_050))) == 2500


def test_resampled_copies_align():
    t = np.arange(44_100 * 6) / 44_100
    x = 0.4 * np.sin(2 * np.pi * 440 * 2 ** (np.floor(t * 4) % 7 / 12) * t) + 0.2 * np.sin(2 * np.pi * 9000 * t)
    a, b, c = (fingerprint(read_wav(wav(x[:: 44_100 // r], r))) for r in (44_100, 44_100, 22_050))
    assert np.array_equal(a, b)
    clean = fingerprint(read_wav(wav(x - 0.2 * np.sin(2 * np.pi * 9000 * t), 44_100)))
    assert bit_error(a, clean, 0, 8) < 0.05 and c is not None


def test_blocks_give_what_the_whole_gives(monkeypatch):
    from millrace.llm import media

    x = np.random.default_rng(1).normal(0, 0.2, 50_000)
    for rate in (8000, RATE, 44_100):
        whole = read_wav(wav(x, rate, 2))
        monkeypatch.setattr(media, "BLOCK", 1000)
        assert np.allclose(read_wav(wav(x, rate, 2)), whole, atol=1e-6)
        assert np.array_equal(fingerprint(wav_blocks(wav(x, rate, 2))), fingerprint(whole))
        monkeypatch.undo()


def test_two_hours_in_bounded_memory():
    import tracemalloc

    data = wav(np.resize(0.3 * np.sin(np.arange(80_000) * 0.3), 7200 * RATE), RATE)
    tracemalloc.start()
    codes = fingerprint(wav_blocks(data))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(codes) > 70_000 and peak < 120e6


def test_long_notes_and_silence_make_few_marks():
    codes = fingerprint(np.concatenate((np.zeros(RATE * 20), 0.5 * np.sin(np.arange(RATE * 20) * 0.25), np.zeros(RATE * 20))))
    assert len(codes) > 500 and len(marks(codes)[0]) < 80


def test_known_takes_are_found(spark):
    """Recall against brute force and against what the table's rows are made of."""
    vectors = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(200)
    audio = rendered(vectors)
    rows = align(audio, id_col="vec_id", audio_col="audio").collect()
    codes = {r.vec_id: fingerprint(read_wav(bytes(r.audio))) for r in audio.collect()}
    want = brute(codes)
    found = {r.id: {m.class_id for m in r.matches} for r in rows if r.is_query and r.n_codes}
    hit, total = sum(len(found[i] & want[i]) for i in want), sum(map(len, want.values()))
    made = {(i - i % 50, i) for i in codes if i % 5 == 3 and i - i % 50 in codes}
    assert total >= 9 and hit / total >= 0.9
    assert len([1 for q, i in made if i in found[q]]) >= 0.9 * len(made)
