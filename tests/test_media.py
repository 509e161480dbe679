import struct
import zlib

import numpy as np
import pytest

from millrace.operators import media
from millrace.queries.media import png_file, wav_file


def filtered_png(pixels, kinds):
    """A PNG whose rows use the given filters."""
    height, width, channels = pixels.shape
    flat = pixels.reshape(height, -1).astype(int)
    packed = b""
    for y in range(height):
        above = flat[y - 1] if y else np.zeros(width * channels, int)
        left = np.concatenate([np.zeros(channels, int), flat[y][:-channels]])
        corner = np.concatenate([np.zeros(channels, int), above[:-channels]])
        near = left + above - corner
        paeth = [min((a, b, c), key=lambda v, p=p: abs(p - v)) for a, b, c, p in zip(left, above, corner, near, strict=True)]
        guess = [0, left, above, (left + above) // 2, np.array(paeth)][kinds[y]]
        packed += bytes([kinds[y]]) + ((flat[y] - guess) % 256).astype(np.uint8).tobytes()

    def chunk(kind, body):
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    colour = {1: 0, 2: 4, 3: 2, 4: 6}[channels]
    return (b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", width, height, 8, colour, 0, 0, 0))
            + chunk(b"IDAT", zlib.compress(packed)) + chunk(b"IEND", b""))


@pytest.mark.parametrize("channels", [1, 2, 3, 4])
def test_png_filters(channels):
    pixels = np.random.default_rng(1).integers(0, 256, (5, 7, channels), dtype=np.uint8)
    out = media._png_pixels(filtered_png(pixels, [0, 1, 2, 3, 4]))
    assert (out == pixels).all()


def test_modes():
    grey = np.arange(6, dtype=np.uint8).reshape(2, 3)
    assert media.decode_image(png_file(grey), "RGB").shape == (2, 3, 3)
    assert (media.decode_image(png_file(grey), "L") == grey).all()
    white = np.full((1, 1, 3), 255, np.uint8)
    assert media._to_mode(white, "L")[0, 0] == 255


def test_pixel_limit_before_decode():
    header = b"\x89PNG\r\n\x1a\n" + struct.pack(">I", 13) + b"IHDR" + struct.pack(">IIBBBBB", 9000, 9000, 8, 0, 0, 0, 0) + b"crc_"
    with pytest.raises(ValueError, match="exceeds"):
        media.decode_image(header, "L")


def test_resize():
    flat = np.full((4, 6), 77, np.uint8)
    assert (media.resize(flat, 3, 9) == 77).all()
    ramp = np.tile(np.arange(8, dtype=np.uint8) * 10, (2, 1))
    # halving averages with the triangle 1/8, 3/8, 3/8, 1/8 inside the row
    assert media.resize(ramp, 2, 4)[0, 1] == 25
    assert media.resize(ramp, 2, 4, nearest=True)[0].tolist() == [10, 30, 50, 70]
    assert media.resize(np.zeros((4, 4, 1), np.uint8), 2, 2).shape == (2, 2, 1)


def test_clips():
    frames = np.full((3, 2, 2), 255, np.uint8)
    clip = media.clip_tensor(frames, None, 5)
    assert clip.shape == (5, 2, 2, 1) and clip[2].min() == 1 and clip[3].max() == 0
    assert media.clip_tensor(frames, (4, 4), 2).shape == (2, 4, 4, 1)
    assert media.clip_tensor(frames, None, True).shape == (3, 2, 2, 1)
    with pytest.raises(ValueError, match="axes"):
        media.clip_tensor(np.zeros((2, 2)), None)


def test_waveform():
    sound = wav_file(np.array([0, 16384, 0, -16384]), 8000)
    assert media.waveform(sound, 8000, 3).tolist() == [0, 0.5, 0]
    assert media.waveform(sound, 16000, 9).tolist() == [0, 0.25, 0.5, 0.25, 0, -0.25, -0.5, -0.5, 0]
    assert len(media.waveform(sound, 16000)) == 80000


def test_mel():
    rate = 16000
    tone = np.sin(2 * np.pi * 1000 * np.arange(rate) / rate).astype(np.float32)
    bands = media.mel_spectrogram(tone, rate)
    assert bands.shape == (64, rate // 512 + 1)
    peak = bands.mean(axis=1).argmax()
    top = 2595 * np.log10(1 + 8000 / 700)
    centre = 700 * (10 ** (np.linspace(0, top, 66)[peak + 1] / 2595) - 1)
    assert abs(centre - 1000) < 60
    assert media.mel_bank(rate).shape == (513, 64) and (media.mel_bank(rate) >= 0).all()


def test_few_files_of_a_batch_are_unpacked_at_a_time(spark):
    from millrace.queries.media import wav_file

    rows = [(i, "k", wav_file(np.full(100, i), 16000)) for i in range(100)]
    files = spark.createDataFrame(rows, "i bigint, kind string, content binary").coalesce(1)
    seen = []

    class Held:
        schema = files.schema

        @staticmethod
        def mapInArrow(run, schema):
            seen.append((run, schema))

    media._per_row(Held, "content", "audio", lambda c: media.waveform(c, 16000, 100))
    run, schema = seen[0]
    batch = files.toArrow().combine_chunks().to_batches()[0]
    taken = [part.num_rows for part in run(iter([batch]))]
    assert max(taken) == media.ROWS_OUT and sum(taken) == 100
    made = media.prepare_audio(files, length=100).orderBy("i").collect()
    assert [round(r["audio"]["data"][0] * 32768) for r in made] == list(range(100))
    assert all(r["kind"] == "k" and r["audio"]["shape"] == [100] for r in made)
