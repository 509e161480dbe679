"""JSON, timestamp, image-cell and artifact columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.functions.text import safe_basename, safe_component

# Leading bytes of the image formats, as hex.
IMAGE_MAGIC = [
    ("89504E470D0A1A0A", "png"),
    ("FFD8FF", "jpg"),
    ("474946383761", "gif"),
    ("474946383961", "gif"),
    ("424D", "bmp"),
]
# Fixed value: longest base64 text that is decoded.
MAX_IMAGE_TEXT = 24 * 1024 * 1024
# Artifact types by file name.
ARTIFACT_TYPES = {
    "adapter_model.safetensors": "adapter",
    "adapter_config.json": "adapter",
    "tokenizer.json": "tokenizer",
    "tokenizer_config.json": "tokenizer",
    "special_tokens_map.json": "tokenizer",
    "config.json": "architecture_config",
    "README.md": "readme",
}


def is_json_object(text: Column) -> Column:
    """True when ``text`` is exactly one JSON object.

    Spark's readers stop after the first value; as the only element of an array, trailing text
    makes the parse fail.
    """
    alone = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    return F.coalesce(alone & F.json_object_keys(text).isNotNull(), F.lit(False))


def json_or_text(text: Column) -> Column:
    """``struct(object, text)``: the parsed object, or the raw text when it is none.

    Empty text is the empty object.
    """
    filled = F.when(F.coalesce(text, F.lit("")) == "", "{}").otherwise(text)
    good = is_json_object(filled)
    return F.struct(
        F.when(good, F.try_parse_json(filled)).alias("object"),
        F.when(~good, filled).alias("text"),
    )


def retry_or_null(value: Column) -> Column:
    """An integer, or null when the field holds none."""
    return value.cast("string").try_cast("int")


def parse_timestamp(text: Column) -> Column:
    """ISO-8601 to a timestamp; a value without an offset is UTC; null when malformed."""
    shape = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}:?\d{2})?)?$"
    zoned = text.rlike(r"[T ].*(Z|[+-]\d{2}:?\d{2})$")
    full = F.when(zoned, text).when(F.length(text) > 10, F.concat(text, F.lit("Z"))).otherwise(
        F.concat(text, F.lit("T00:00:00Z"))
    )
    return F.when(text.rlike(shape), F.try_to_timestamp(full))


def format_day(text: Column, zone: str = "UTC") -> Column:
    """The day of a timestamp text in ``zone``: ``-`` when absent, the part before ``T`` when
    malformed."""
    wall = parse_timestamp(text).cast("timestamp_ntz")
    day = F.date_format(F.convert_timezone(F.current_timezone(), F.lit(zone), wall), "yyyy-MM-dd")
    return (
        F.when(F.coalesce(text, F.lit("")) == "", "-")
        .when(day.isNull(), F.substring_index(text, "T", 1))
        .otherwise(day)
    )


def image_payload(cell: Column) -> Column:
    """The base64 part of a cell, a data link's header removed."""
    is_link = cell.startswith("data:") & cell.contains(";base64,")
    at = F.instr(cell, ";base64,")
    return F.when(is_link, cell.substr(at + 8, F.length(cell))).otherwise(cell)


def image_refusal(cell: Column, most: int | None = MAX_IMAGE_TEXT) -> Column:
    """Why a cell is not decoded: ``too long`` or ``not base64``; null if it is.

    The alphabet and the padding are checked, as Spark's decoder skips foreign characters.
    """
    payload = image_payload(cell)
    shaped = (
        (F.length(payload) % 4 == 0) & payload.rlike(r"^[A-Za-z0-9+/]*={0,2}$") & (F.length(cell) >= 8)
    )
    kind = F.when(cell.isNull() | ~shaped, "not base64")
    return kind if most is None else kind.when(F.length(payload) > most, "too long")


def image_bytes(cell: Column, most: int | None = MAX_IMAGE_TEXT) -> Column:
    """Decoded bytes of a base64 cell, null when it is not valid base64 or longer than ``most``."""
    return F.when(image_refusal(cell, most).isNull(), F.unbase64(image_payload(cell)))


def sniff_image(content: Column) -> Column:
    """Extension of an image by its leading bytes, null when it is no known image."""
    head = F.hex(F.substring(content, 1, 12))
    kind = F
    for magic, extension in IMAGE_MAGIC:
        kind = kind.when(head.startswith(magic), extension)
    webp = head.startswith("52494646") & (F.substring(head, 17, 8) == "57454250")
    return kind.when(webp, "webp")


def artifact_type(filename: Column) -> Column:
    """Registry type of a file name; unknown names are weights."""
    kind = F
    for name, value in ARTIFACT_TYPES.items():
        kind = kind.when(filename == name, value)
    return kind.otherwise("weights")


def artifact_name(filename: Column, logical_key: Column, artifact_id: Column) -> Column:
    """The local file name of an artifact: that of its file, else of its key, else its id.

    Empty text counts as absent; a name that isn't safe falls back to the id.
    """
    own = F.concat(safe_component(artifact_id.cast("string")), F.lit(".bin"))
    given = F.coalesce(F.nullif(filename, F.lit("")), F.nullif(logical_key, F.lit("")))
    return safe_basename(given, own)


def checksum(content: Column) -> Column:
    return F.sha2(content, 256)


def bare_checksum(value: Column) -> Column:
    """A stored checksum without its algorithm prefix."""
    return F.regexp_replace(value, "^sha256:", "")


def event_id(given: Column, run: Column, offset: Column) -> Column:
    """The event's own id, else one made of the run and the byte offset."""
    return F.coalesce(given, F.concat_ws(":", run.cast("string"), offset.cast("string")))
