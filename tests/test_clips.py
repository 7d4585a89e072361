from __future__ import annotations

import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward import schemas as S
from clipward.functions import signal
from clipward.operators import clip_jobs, quality
from clipward.sources import fingerprints, tables


def sine(rate=22050, seconds=0.2, hz=440.0, level=0.5):
    return (level * np.sin(2 * np.pi * hz * np.arange(int(rate * seconds)) / rate)).astype(np.float32)


def test_wav_round_trip_mono_and_stereo():
    y, rate = signal.decode_wav(signal.encode_wav(sine(), 22050))
    assert rate == 22050 and y.shape == (4410,) and np.abs(y - sine()).max() < 1e-4
    stereo, _ = signal.decode_wav(signal.encode_wav(np.stack([sine(), sine(hz=880.0)], 1), 22050))
    assert stereo.shape == (4410, 2)


@pytest.mark.parametrize("bits, kind", [(8, 1), (24, 1), (32, 1), (32, 3), (64, 3)])
def test_wav_sample_formats(bits, kind):
    import struct

    y = np.array([0.0, 0.5, -0.5, 0.25])
    if kind == 3:
        body = y.astype(f"<f{bits // 8}").tobytes()
    elif bits == 8:
        body = (y * 128 + 128).astype(np.uint8).tobytes()
    else:
        whole = (y * (1 << (bits - 1))).astype(np.int64)
        body = b"".join(int(v).to_bytes(bits // 8, "little", signed=True) for v in whole)
    width = bits // 8
    head = struct.pack("<4sI4s4sIHHIIHH", b"RIFF", 36 + len(body), b"WAVE", b"fmt ", 16, kind, 1, 8000, 8000 * width, width, bits)
    got, rate = signal.decode_wav(head + b"data" + struct.pack("<I", len(body)) + body)
    assert rate == 8000 and np.allclose(got, y, atol=1e-6)


def test_rejects():
    for data, reason in [(b"", "missing"), (b"text", "undecodable"), (b"RIFF0000WAVE", "undecodable")]:
        with pytest.raises(signal.RejectedClip, match=reason):
            signal.decode_wav(data)
    with pytest.raises(signal.RejectedClip, match="empty"):
        signal.clean(np.array([]), 16000)
    with pytest.raises(signal.RejectedClip, match="silent"):
        signal.clean(np.zeros(1000, np.float32), 16000)
    with pytest.raises(signal.RejectedClip, match="shape"):
        signal.clean(np.zeros((2, 2, 2)), 16000)


def test_clean_gives_mono_target_rate_full_peak():
    y = signal.clean(np.stack([sine(), sine(hz=880.0)], 1), 22050)
    assert y.ndim == 1 and y.dtype == np.float32 and len(y) == 3200
    assert np.abs(y).max() == pytest.approx(1.0, abs=1e-5)


def test_resampling_keeps_a_tone():
    y = signal.resample(sine(22050, 1.0), 22050, 16000)
    assert np.argmax(np.abs(np.fft.rfft(y))) == 440
    assert np.abs(y).max() == pytest.approx(0.5, abs=0.02)


def test_augmentation_is_seeded_and_changes_the_signal():
    y = sine(16000, 0.5)
    a, b, c = (signal.augment(y, seed, chance=1.0) for seed in (7, 7, 8))
    assert np.array_equal(a, b) and (len(a) != len(c) or not np.allclose(a, c))
    assert np.abs(a).max() == pytest.approx(1.0)
    assert np.array_equal(signal.augment(y, 7, chance=0.0), y / np.abs(y).max())


def test_stretch_changes_length_and_shift_changes_pitch():
    y = sine(16000, 1.0)
    slow = signal.time_stretch(y, 0.9)
    assert len(slow) == round(16000 / 0.9)
    peak = np.argmax(np.abs(np.fft.rfft(slow))) * 16000 / len(slow)
    assert peak == pytest.approx(440, abs=4)
    up = signal.pitch_shift(y, 2.0)
    assert len(up) == 16000
    assert np.argmax(np.abs(np.fft.rfft(up))) == pytest.approx(440 * 2 ** (2 / 12), abs=6)


def test_84_finite_features_and_mel_shape():
    y = signal.fit_length(sine(16000, 4.0, level=0.25), 64000)
    values = signal.tabular_features(y, 16000)
    assert len(values) == len(S.feature_names()) == 84 and np.isfinite(values).all()
    mel = signal.log_mel(y, 16000)
    assert mel.shape == (128, 126) and mel.max() == 0.0 and mel.min() >= -80.0
    short = signal.log_mel(y[:32000], 16000)
    assert short.shape == (128, 126) and (short[:, 63:] == 0.0).all()


def test_tone_features():
    y = sine(16000, 4.0)
    got = dict(zip(S.feature_names(), signal.tabular_features(y, 16000), strict=True))
    chroma = [got[f"chroma_{i}_mean"] for i in range(12)]
    assert int(np.argmax(chroma)) == 9  # A, counted from C
    assert got["spectral_centroid_mean"] == pytest.approx(440, rel=0.05)
    assert got["zcr_mean"] == pytest.approx(2 * 440 / 16000, rel=0.02)


def test_only_the_wanted_features_are_computed(monkeypatch):
    y = signal.fit_length(sine(16000, 1.0), 64000)
    every = dict(zip(S.feature_names(), signal.tabular_features(y, 16000), strict=True))
    wanted = ["zcr_std", "chroma_9_mean", "chroma_9_std"]
    monkeypatch.setattr(signal, "decibels", None)  # only the cepstrum needs it
    assert signal.tabular_features(y, 16000, wanted=wanted) == [every[n] for n in wanted]


@pytest.mark.parametrize("seconds", [0.0, 0.01, 1.0, 4.0])
def test_silent_frames_are_zero_without_a_transform(seconds):
    y = signal.fit_length(sine(16000, seconds), 64000)
    sounding, total = signal.power_spectrum(y, 2048, 512)
    whole = np.abs(signal.spectrum(y, 2048, 512))
    assert total == whole.shape[1] and (whole[:, sounding.shape[1] :] == 0).all()
    assert np.array_equal(whole[:, : sounding.shape[1]], sounding)
    assert seconds == 4.0 or sounding.shape[1] < total


def test_clip_steps_bound_their_batches(spark, raw):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        for step in (clip_jobs.clean_and_augment, clip_jobs.decode_report):
            spark.conf.set(key, str(64 << 20))
            step(raw)
            assert int(spark.conf.get(key)) <= 8 << 20
        spark.conf.set(key, "1000")
        clip_jobs.decode_report(raw)
        assert spark.conf.get(key) == "1000"  # a smaller setting stays
        for given, kept in (("64m", str(4 << 20)), ("2mb", "2mb"), ("100k", "100k")):
            spark.conf.set(key, given)
            clip_jobs.decode_report(raw)
            assert spark.conf.get(key) == kept
    finally:
        spark.conf.set(key, before)


def test_mfcc_against_direct_sums():
    """Spectrum, mel triangles, decibels and cosine transform written out as plain loops."""
    rng = np.random.default_rng(0)
    y, size, hop, bands = rng.standard_normal(600), 128, 64, 10
    padded = np.concatenate([np.zeros(64), y, np.zeros(64)])
    window = [0.5 - 0.5 * np.cos(2 * np.pi * k / size) for k in range(size)]
    power = []
    for t in range(1 + len(y) // hop):
        part = padded[t * hop : t * hop + size] * window
        power.append([abs(sum(part * np.exp(-2j * np.pi * b * np.arange(size) / size))) ** 2 for b in range(65)])
    power = np.array(power).T
    assert np.allclose(np.abs(signal.spectrum(y, size, hop)) ** 2, power)
    mels = signal.mel_filters(8000, size, bands) @ power
    db = signal.decibels(mels)
    want = [
        [
            np.sqrt((1 if c == 0 else 2) / bands)
            * sum(db[m, t] * np.cos(np.pi * c * (2 * m + 1) / (2 * bands)) for m in range(bands))
            for t in range(db.shape[1])
        ]
        for c in range(4)
    ]
    assert np.allclose(signal.dct_rows(4, bands) @ db, want)


def test_mel_triangles_have_equal_area():
    filters = signal.mel_filters(16000, 8192, 20)
    assert np.allclose(filters.sum(axis=1) * 16000 / 8192, 1.0, rtol=0.03)


def test_delta_is_a_fitted_slope():
    line = np.arange(20.0)[None, :] * 3
    assert np.allclose(signal.delta(line), 3.0)
    parabola = (np.arange(20.0) ** 2)[None, :]
    assert np.allclose(signal.delta(parabola, order=2), 2.0)
    with pytest.raises(signal.RejectedClip):
        signal.delta(np.zeros((1, 8)))


@pytest.fixture(scope="module")
def raw(spark):
    rows = []
    for i in range(4):
        name = f"clip{i}.wav"
        audio = (bytearray(signal.encode_wav(sine(), 22050)), name)
        rows.append((audio, name, 100 + i, 0.0, 0.2, 1, 10 if i == 3 else 1, i % 2, ["dog_bark", "siren"][i % 2]))
    rows.append(((bytearray(b""), "bad.wav"), "bad.wav", 1, 0.0, 0.2, 1, 1, 0, "siren"))
    return spark.createDataFrame(rows, S.RAW_CLIP)


def test_interim_stage(spark, raw, tmp_path):
    processed = clip_jobs.clean_and_augment(raw).persist()
    kept = quality.good_rows(processed)
    tables.write_interim(kept, str(tmp_path / "interim"))
    row = quality.interim_manifest(tables.read_interim(spark, str(tmp_path / "interim")), dropped=1).first()
    assert (row["num_rows_written"], row["num_original"], row["num_augmented"]) == (7, 4, 3)
    assert (row["num_train_rows"], row["num_eval_rows"]) == (6, 1)
    assert row["class_counts_all"] == {"dog_bark": 2, "siren": 2}
    assert [r["reject_reason"] for r in quality.quarantine(processed).collect()] == ["missing audio bytes"]
    assert kept.where("fold = 10 AND is_augmented").count() == 0
    assert {r["path"] for r in kept.where("is_augmented").collect()} == {
        f"audio/fold1/clip{i}_aug0.wav" for i in range(3)
    }


def test_feature_stage(spark, raw, tmp_path):
    clips = quality.good_rows(clip_jobs.clean_and_augment(raw)).withColumn("aug_index", F.col("aug_index").cast("long"))
    features = quality.good_rows(clip_jobs.extract_features(clips)).persist()
    tabular, mels = str(tmp_path / "tabular"), str(tmp_path / "mels")
    tables.write_features(features, tabular, mels, S.feature_names())
    a = tables.read_features(spark, tabular, schema=S.tabular_schema())
    b = tables.read_features(spark, mels, schema=S.MEL_TABLE)
    assert {r["path"] for r in a.collect()} == {r["path"] for r in b.collect()}
    assert a.count() == b.count() == 7
    assert a.select(*S.feature_names()).dropna().count() == 7


def test_compaction_fills_its_files(spark, tmp_path):
    """Partitions cut by bytes hold a little more than a file may, and each left a small second file."""
    many, few = str(tmp_path / "many"), str(tmp_path / "few")
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("x")).repartition(40).write.parquet(many)
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    spark.conf.set(key, "110k")
    try:
        tables.compact(spark.read.parquet(many), few, max_records_per_file=1_100)
    finally:
        spark.conf.set(key, before)
    sizes = [r["count"] for r in spark.read.parquet(few).groupBy(F.input_file_name()).count().collect()]
    assert sum(sizes) == 40_000 and len(sizes) < 40 and 1_000 < min(sizes) and max(sizes) <= 1_100


def test_results_do_not_depend_on_partitioning(raw):
    digest = lambda n: fingerprints.content_fingerprint(
        clip_jobs.clean_and_augment(raw.repartition(n)).drop("reject_reason")
    ).first()
    assert digest(1) == digest(5)


def test_all_rejected_is_an_error(raw):
    broken = clip_jobs.clean_and_augment(raw.where("slice_file_name = 'bad.wav'"))
    with pytest.raises(Exception, match="every clip was rejected"):
        quality.reject_counts(broken).collect()


def test_class_folders(spark, tmp_path):
    for name in ("siren/b.wav", "siren/a.wav", "dog_bark/c.wav", "cat/d.wav", "orphan.wav", "siren/n.txt"):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_bytes(signal.encode_wav(sine(), 16000))
    rows = tables.read_class_folders(spark, str(tmp_path)).select("expected", "file_name").collect()
    assert [tuple(r) for r in rows] == [("dog_bark", "c.wav"), ("siren", "a.wav"), ("siren", "b.wav")]


def test_file_fingerprints(spark, tmp_path):
    mib = 1 << 20
    want = {}
    for name, size in (("small", 10), ("middle", mib + 5), ("large", 3 * mib)):
        data = np.random.default_rng(size).bytes(size)
        (tmp_path / name).write_bytes(data)
        rest = data[-mib:] if size > 2 * mib else data[mib:]
        want[str(tmp_path / name)] = hashlib.sha256(data[:mib] + rest).hexdigest()
    paths = [(p,) for p in [*want, str(tmp_path / "none")]]
    rows = fingerprints.fingerprint_files(spark.createDataFrame(paths, "path string")).collect()
    assert {r["path"]: r["sha256"] for r in rows if r["exists"]} == want
    assert [r["path"] for r in rows if not r["exists"]] == [str(tmp_path / "none")]
