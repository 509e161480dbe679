"""Media jobs on files made from the given vectors."""

from __future__ import annotations

import io
import struct
import wave
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.functions.arrays import channels_first
from millrace.operators import media
from millrace.queries.registry import joined, query, table


def png_file(pixels: np.ndarray) -> bytes:
    """A grey 8-bit PNG."""

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    height, width = pixels.shape
    rows = b"".join(b"\0" + row.tobytes() for row in pixels.astype(np.uint8))
    header = struct.pack(">IIBBBBB", width, height, 8, 0, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows)) + chunk(b"IEND", b"")


def wav_file(samples: np.ndarray, rate: int) -> bytes:
    """A mono 16-bit WAV."""
    out = io.BytesIO()
    with wave.open(out, "wb") as sound:
        sound.setnchannels(1)
        sound.setsampwidth(2)
        sound.setframerate(rate)
        sound.writeframes(samples.astype("<i2").tobytes())
    return out.getvalue()


def _files(spark, folder, make):
    """``(vec_id, content)``: one file per vector."""

    def work(chunks: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in chunks:
            # a file is far larger than its vector: few of them leave a task at a time
            for start in range(0, len(chunk), media.ROWS_OUT):
                part = chunk.iloc[start : start + media.ROWS_OUT]
                content = [make(np.asarray(v)) for v in part["v"]]
                yield pd.DataFrame({"vec_id": part["vec_id"], "content": content})

    byte = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * 100).cast("int"))
    rows = table(spark, folder, "embeddings").select("vec_id", byte.alias("v"))
    return rows.mapInPandas(work, "vec_id bigint, content binary")


def _images(spark, folder):
    return _files(spark, folder, lambda v: png_file(v.reshape(8, 8)))


@query(
    "md1_prepare_images",
    """with b as (select vec_id, [floor((e::double + 1) * 100) for e in embedding] as v from embeddings)
    select vec_id, i as at, round((v[i // 3 + 1] / 255.0::double - [0.5, 0.25, 0][i % 3 + 1]::double) / [0.5, 1, 2][i % 3 + 1]::double, 5) as value
    from (select *, unnest(range(192)) as i from b)""",
)
def prepare_images(spark, folder):
    tensors = media.prepare_images(_images(spark, folder), None, [0.5, 0.25, 0.0], [0.5, 1.0, 2.0])
    values = tensors.select("vec_id", F.posexplode("image.data").alias("at", "value"))
    return values.select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.round(F.col("value").cast("double"), 5).alias("value")
    )


@query("md1_resize_images")
def resize_images(spark, folder):
    tensors = media.prepare_images(_images(spark, folder), (4, 6))
    return tensors.select("vec_id", joined(F.col("image.shape")).alias("shape"), F.size("image.data").alias("n"))


@query(
    "md1_prepare_masks",
    """with b as (select vec_id, [floor((e::double + 1) * 100) for e in embedding] as v from embeddings)
    select vec_id, y * 4 + x as at, v[(2 * y + 1) * 8 + 2 * x + 2]::double as value
    from (select *, unnest(range(4)) as x from (select *, unnest(range(4)) as y from b))""",
)
def prepare_masks(spark, folder):
    tensors = media.prepare_masks(_images(spark, folder), (4, 4))
    values = tensors.select("vec_id", F.posexplode("mask.data").alias("at", "value"))
    return values.select("vec_id", F.col("at").cast("bigint").alias("at"), F.col("value").cast("double").alias("value"))


@query(
    "md2_prepare_clips",
    """with b as (select vec_id, [floor((e::double + 1) * 100) for e in embedding] as v from embeddings)
    select vec_id, i as at, round(coalesce(v[i + 1], 0) / 255.0::double, 5) as value
    from (select *, unnest(range(96)) as i from b)""",
)
def prepare_clips(spark, folder):
    byte = F.transform("embedding", lambda e: F.floor((e.cast("double") + 1) * 100).cast("float"))
    shape = F.array(F.lit(4), F.lit(4), F.lit(4))
    clips = table(spark, folder, "embeddings").select(
        "vec_id", F.struct(shape.alias("shape"), byte.alias("data")).alias("video")
    )
    tensors = media.prepare_clips(clips, frame_count=6)
    values = tensors.select("vec_id", F.posexplode("video.data").alias("at", "value"))
    return values.select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.round(F.col("value").cast("double"), 5).alias("value")
    )


@query(
    "md3_prepare_audio",
    """with b as (select vec_id, [floor((e::double + 1) * 100) for e in embedding] as v from embeddings)
    select vec_id, i as at, round(case when i % 2 = 0 then coalesce(v[i // 2 + 1], 0)
        when i < 127 then (v[i // 2 + 1] + v[i // 2 + 2]) / 2 when i = 127 then v[64] else 0 end / 32768.0::double, 7) as value
    from (select *, unnest(range(140)) as i from b)""",
)
def prepare_audio(spark, folder):
    sounds = _files(spark, folder, lambda v: wav_file(v, 8000))
    tensors = media.prepare_audio(sounds, 16000, 140)
    values = tensors.select("vec_id", F.posexplode("audio.data").alias("at", "value"))
    return values.select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.round(F.col("value").cast("double"), 7).alias("value")
    )


@query("md4_mel_spectrogram")
def mel_spectrogram(spark, folder):
    sounds = _files(spark, folder, lambda v: wav_file(np.tile(v - 100, 50), 16000))
    tensors = media.prepare_audio(sounds, 16000, 4096, spectrogram=True)
    return tensors.select("vec_id", joined(F.col("audio.shape")).alias("shape"), F.size("audio.data").alias("n"))


@query(
    "ud5_audio_hooks",
    """with b as (select vec_id, [floor((e::double + 1) * 100) for e in embedding] as v from embeddings)
    select vec_id, i as at, round(-2 * v[64 - i] / 32768.0::double, 7) as value
    from (select *, unnest(range(64)) as i from b)""",
)
def audio_hooks(spark, folder):
    sounds = _files(spark, folder, lambda v: wav_file(v, 16000))
    tensors = media.prepare_audio(sounds, 16000, 64, waveform_transform=lambda w: -2 * w[::-1])
    values = tensors.select("vec_id", F.posexplode("audio.data").alias("at", "value"))
    return values.select(
        "vec_id", F.col("at").cast("bigint").alias("at"), F.round(F.col("value").cast("double"), 7).alias("value")
    )


@query(
    "md5_channels_first",
    """select vec_id, i as at, cast(embedding[(i % 16) * 4 + i // 16 + 1] as double) as v
       from (select *, unnest(range(64)) as i from embeddings)""",
)
def to_channels_first(spark, folder):
    rows = table(spark, folder, "embeddings").select(
        "vec_id", F.posexplode(channels_first(F.col("embedding"), 4, 4, 4)).alias("at", "v")
    )
    return rows.select("vec_id", F.col("at").cast("bigint").alias("at"), F.col("v").cast("double").alias("v"))
