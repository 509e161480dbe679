"""Text columns: tokens, hash ids, lines, cleaning, file names and redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters between two tokens: Unicode white space and the separators U+001C to
# U+001F. Java's own \s is ASCII only.
TOKEN_BREAK = r"[\p{IsWhite_Space}\x1c-\x1f]+"
# The line ends.
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x85\u2028\u2029]"
# Control characters other than tab and newline.
CONTROL_CHARS = r"[\x00-\x08\x0b-\x1f\x7f-\x9f]"
# What the name of a parameter that carries credentials holds, and headers that do.
SECRET_NAMES = ("token", "signature", "credential", "sig", "key")
SECRET_HEADERS = ("authorization", "x-api-key", "idempotency-key")
# Device names that may not be used as a file stem.
RESERVED_STEMS = (
    ["con", "prn", "aux", "nul"]
    + [f"com{i}" for i in range(1, 10)]
    + [f"lpt{i}" for i in range(1, 10)]
)

DEFAULT_LENGTH = 200
DEFAULT_VOCABULARY = 20000


def positive_int(value: object, default: int) -> int:
    """``value`` if it is a positive integer (booleans are not), else ``default``."""
    if isinstance(value, bool) or not isinstance(value, int) or value <= 0:
        return default
    return value


def tokens(text: Column) -> Column:
    """Whitespace tokens of ``text``; null text has none."""
    parts = F.array_remove(F.split(text, TOKEN_BREAK), "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def token_id(token: Column, num_words: int) -> Column:
    """Hash id of one token, 1 .. num_words-1; 0 is kept for padding."""
    span = max(2, num_words) - 1
    return (F.crc32(token.cast("binary")) % F.lit(span) + 1).cast("int")


def pad_right(values: Column, length: int, zero: Column) -> Column:
    """Cut ``values`` to ``length`` and fill up with ``zero`` on the right."""
    kept = F.slice(values, 1, length)
    return F.concat(kept, F.array_repeat(zero, F.lit(length) - F.size(kept)))


def hash_tokens(
    text: Column, maxlen: object = DEFAULT_LENGTH, num_words: object = DEFAULT_VOCABULARY
) -> Column:
    """Token ids of ``text`` as ``array<int>`` of exactly ``maxlen`` entries.

    A bad parameter falls back to its default. Null text gives all padding.
    """
    length = positive_int(maxlen, DEFAULT_LENGTH)
    words = positive_int(num_words, DEFAULT_VOCABULARY)
    # the split stops behind the tokens that are kept; one more may be the empty piece in front
    parts = F.array_remove(F.split(text, TOKEN_BREAK, length + 2), "")
    kept = F.coalesce(F.slice(parts, 1, length), F.array().cast("array<string>"))
    ids = F.transform(kept, lambda token: token_id(token, words))
    return pad_right(ids, length, F.lit(0))


def lines(text: Column) -> Column:
    """The non-empty lines of ``text`` in order."""
    return F.array_remove(F.split(text, LINE_BREAK), "")


def strip_control(text: Column) -> Column:
    """Drop control characters, escape sequences included."""
    return F.regexp_replace(text, CONTROL_CHARS, "")


def truncate(text: Column, width: int) -> Column:
    """Cleaned text within ``width`` characters, cut text ending in dots."""
    clean = strip_control(text)
    cut = F.concat(F.substring(clean, 1, max(width - 3, 0)), F.lit("..."[: max(width, 0)]))
    return F.when(F.length(clean) <= width, clean).otherwise(cut)


def _secret_parameters(before: str, ends: str) -> str:
    """Pattern of ``name=value`` with a secret name: group 1 is the name, a value runs to ``ends``."""
    holds = f"(?=[\\w.-]*?(?:{'|'.join(SECRET_NAMES)})[\\w.-]*=)"
    return f"(?i){before}{holds}([\\w.-]+)=[^{ends}]+"


def redact(message: Column, mark: str = "<redacted>") -> Column:
    """Blank credential parameters of links and, to the end of the line, credential headers."""
    hidden = F.regexp_replace(message, _secret_parameters(r"(?<=[?&])", r"&\s"), f"$1={mark}")
    header = f"(?i)(?<={'|'.join(SECRET_HEADERS)})(['\"]?\\s*[:=]\\s*)\\S.*"
    return F.regexp_replace(hidden, header, f"$1{mark}")


def redact_error(message: Column, mark: str = "<redacted>") -> Column:
    """Blank credential parameters in error text: also outside of links, and up to a quote."""
    return F.regexp_replace(message, _secret_parameters(r"(?<![\w.-])", r"&\s'\""), f"$1={mark}")


def redact_url(url: Column, show: bool = False, mark: str = "<redacted>") -> Column:
    """A download link is shown only on request."""
    return url if show else F.when(url.isNotNull(), F.lit(mark))


def _unsafe_name(name: Column) -> Column:
    """Whether a bare name means no file, or one of the device names, whatever its extension."""
    bare = F.regexp_replace(F.lower(name), r"[ .]+$", "")
    return name.isNull() | name.isin("", ".", "..") | F.substring_index(bare, ".", 1).isin(RESERVED_STEMS)


def safe_basename(raw: Column, default: Column) -> Column:
    """The bare file name in ``raw``, or ``default`` when nothing safe is left.

    Both slashes separate; a drive or stream prefix ends at the last colon.
    """
    # a path ends at its last segment that is neither empty nor "."
    path = F.regexp_replace(F.translate(raw, "\\", "/"), r"(/+\.?)+$", "")
    name = F.regexp_extract(path, r"([^/:]*)$", 1)
    return F.when(_unsafe_name(name), default).otherwise(name)


def _behind(text: Column, mark: str) -> Column:
    """What follows the first ``mark``; null without one."""
    at = F.locate(mark, text)
    return F.when(at > 0, F.substring(text, at + len(mark), F.length(text)))


def disposition_filename(header: Column) -> Column:
    """The raw file name in a Content-Disposition header, null when it names none.

    A name in quotes counts before one without, which ends at a blank or semicolon.
    """
    opened = _behind(header, 'filename="')
    quoted = F.when(F.contains(opened, F.lit('"')), F.substring_index(opened, '"', 1))
    bare = F.regexp_substr(_behind(header, "filename="), F.lit(r"^[^\s;]+"))
    return F.coalesce(quoted, bare)


def checked_filename(raw: Column) -> Column:
    """A file name without blanks around it; a path, drive, dot or device name fails the job."""
    name = F.trim(raw)
    message = F.concat(F.lit("unsafe file name: "), raw)
    refused = name.rlike(r"[/\\:]") | _unsafe_name(name)
    return F.when(raw.isNull(), name).when(refused, F.raise_error(message).cast("string")).otherwise(name)


def safe_component(text: Column) -> Column:
    """``text`` reduced to characters that are safe inside a file name."""
    cleaned = F.regexp_replace(text, r"[^A-Za-z0-9._-]+", "_")
    bare = F.regexp_replace(cleaned, r"^[._]+|[._]+$", "")
    return F.when(bare == "", "x").otherwise(bare)
