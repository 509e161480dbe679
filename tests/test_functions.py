import zlib

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import arrays, labels, records, text

V = F.col("v")


def test_hash_tokens_fixed_length(values):
    out = values(text.hash_tokens(V, 4, 50), ["hello world foo", "bar", None, " \t "], "string")
    assert [len(x) for x in out] == [4, 4, 4, 4]
    ids = [zlib.crc32(w) % 49 + 1 for w in (b"hello", b"world", b"foo")]
    assert out[0] == [*ids, 0]
    assert out[1][1:] == [0, 0, 0] and out[2] == out[3] == [0] * 4
    assert max(map(max, out)) < 50


def test_tokens_follow_python_split(values):
    texts = ["a b", "a\x1cb\x1f c", "\x85x y　", "​z", "", "  lead", "a᠎b", "x y﻿z"]
    assert values(text.tokens(V), texts, "string") == [t.split() for t in texts]


@pytest.mark.parametrize("bad", [0, -5, True, "200", None])
def test_bad_sequence_length_is_default(bad):
    assert text.positive_int(bad, 200) == 200


def test_lines_follow_python_splitlines(values):
    texts = ["alpha\nbeta\n\ngamma\n", "a\r\nb\rc\x0bd\x0ce\x1cf\x85g h i", ""]
    assert values(text.lines(V), texts, "string") == [[x for x in t.splitlines() if x] for t in texts]


def test_safe_basename(values):
    given = ["../../.bashrc", "a\\b\\c.txt", "C:evil.exe", "dir/", "..", ".", "", "CON.txt", "x/nul", "a/./", None, "lpt1 ."]
    expected = [".bashrc", "c.txt", "evil.exe", "dir", "d", "d", "d", "d", "d", "a", "d", "d"]
    assert values(text.safe_basename(V, F.lit("d")), given, "string") == expected


def test_disposition_and_component(values):
    given = ['attachment; filename="a b.csv"', "attachment; filename=x.csv; size=1", "inline", None, 'filename=""']
    assert values(text.disposition_filename(V), given, "string") == ["a b.csv", "x.csv", None, None, ""]
    assert values(text.safe_component(V), ["a b/c", "..", "_x.", "é"], "string") == ["a_b_c", "x", "x", "x"]


def test_redact(values):
    given = [
        "GET https://api/x?token=SECRET&a=1",
        "Authorization: Bearer sk_live_ABC",
        "url?AWSAccessKeyId=AAA&x-amz-signature=BBB",
        "plain",
    ]
    out = values(text.redact(V), given, "string")
    assert not any(s in "".join(out) for s in ("SECRET", "sk_live", "AAA", "BBB"))
    assert out[0].endswith("&a=1") and out[3] == "plain"


def test_truncate_and_control(values):
    assert values(text.truncate(V, 8), ["short", "a longer text", "\x1b[1mx"], "string") == ["short", "a lon...", "[1mx"]
    assert values(text.truncate(V, 2), ["abc"], "string") == [".."]


def test_three_rules_for_unknown_ids(values):
    ids = [[3, 50000, 9999, 10000]]
    assert values(arrays.clip_token_ids(V, None, 10000), ids, "array<bigint>") == [[3, 9999, 9999, 9999]]
    assert values(arrays.clamp_token_ids(V, 10000), ids, "array<bigint>") == [[3, 0, 9999, 0]]
    assert values(arrays.pad_sequences(V, 5, 10000), ids, "array<bigint>") == [[3, 0, 9999, 0, 0]]


def test_clip_pads(values):
    assert values(arrays.clip_token_ids(V, 5), [[5, 6, 7]], "array<bigint>") == [[5, 6, 7, 0, 0]]
    assert values(arrays.clip_token_ids(V, 2, True), [[5, 6, 7]], "array<bigint>") == [[5, 6]]


def test_remap(values):
    assert values(arrays.remap_contiguous(V, [1, 2, 3]), [[1, 2, 3, 0, 9, 1]], "array<int>") == [[0, 1, 2, 0, 0, 0]]
    assert values(arrays.remap_contiguous(V), [[2, 4, 4, 2]], "array<int>") == [[0, 1, 1, 0]]
    assert values(arrays.remap_contiguous(V, [5, 100000]), [[5, 100000, 7]], "array<int>") == [[0, 1, 0]]


@pytest.mark.parametrize("target", [None, True, 0, -3, "4"])
def test_fit_length_ignores_bad_target(values, target):
    assert values(arrays.fit_length(V, target), [[1.0, 2.0]], "array<float>") == [[1.0, 2.0]]


def test_fit_normalize_channels(values):
    assert values(arrays.fit_length(V, 3), [[1.0], [1.0, 2.0, 3.0, 4.0]], "array<float>") == [[1, 0, 0], [1, 2, 3]]
    assert values(arrays.normalize(V, [1, 2], [2, 4]), [[3.0, 6.0, 1.0, 2.0]], "array<float>") == [[1, 1, 0, 0]]
    assert values(arrays.mean_channels(V, 2), [[1.0, 3.0, 5.0, 7.0], []], "array<float>") == [[2, 6], []]
    assert values(arrays.channels_first(V, 1, 2, 3), [list(range(6))], "array<int>") == [[0, 3, 1, 4, 2, 5]]


def test_labels_by_text(values):
    assert values(labels.encode_label(V, T.LongType(), ["0", "1", "2"]), [0, 1, 0, 2], "bigint") == [0, 1, 0, 2]
    assert values(labels.encode_label(V, T.StringType(), ["cat", "dog"]), ["dog", "cat", "dog"], "string") == [1, 0, 1]
    assert values(labels.encode_label(V, T.BooleanType(), ["True", "False"]), [True, False], "boolean") == [0, 1]
    assert values(labels.encode_label(V, T.DoubleType(), ["1.0", "2.5"]), [2.5, 1.0], "double") == [1, 0]


@pytest.mark.parametrize("bad", ["unknown", None])
def test_unknown_label_fails_and_is_named(values, bad):
    with pytest.raises(Exception, match=bad or "None"):
        values(labels.encode_label(V, T.StringType(), ["cat"]), [bad], "string")


def test_json_object(values):
    given = ['{"a":1}', '{"a":1} x', "[1]", "{not}", "", '"s"', '{"a":1}{"b":2}', '{"a":1},{"b":2}', None, " {} "]
    expected = [True, False, False, False, False, False, False, False, False, True]
    assert values(records.is_json_object(V), given, "string") == expected
    assert values(records.json_or_text(V)["text"], ["", "x", '{"a":1}'], "string") == [None, "x", None]
    assert values(records.retry_or_null(V), ["5", "soon", None], "string") == [5, None, None]


def test_timestamps(values):
    given = ["2026-01-01T23:30:00", "2026-01-01T23:30:00-05:00", "2026-01-01", "junkT1", "", None, "2026-13-01T00:00:00", "2026-01-01T10:00:00.123456Z"]
    assert values(records.format_day(V), given, "string") == [
        "2026-01-01", "2026-01-02", "2026-01-01", "junk", "-", "-", "2026-13-01", "2026-01-01",
    ]


def test_images_and_artifacts(values):
    import base64

    png = base64.b64encode(b"\x89PNG\r\n\x1a\nrest").decode()
    given = [png, "data:image/png;base64," + png, "plain text", "aGVsbG8=", "QUJD!!!!", "short"]
    assert values(records.sniff_image(records.image_bytes(V)), given, "string") == ["png", "png", None, None, None, None]
    webp = base64.b64encode(b"RIFF\0\0\0\0WEBP").decode()
    assert values(records.sniff_image(records.image_bytes(V)), [webp], "string") == ["webp"]
    names = ["adapter_config.json", "README.md", "x.bin"]
    assert values(records.artifact_type(V), names, "string") == ["adapter", "readme", "weights"]
    assert values(records.bare_checksum(V), ["sha256:ab", "ab"], "string") == ["ab", "ab"]


def test_redact_error_text(values):
    given = ["error 'stream_token=abc' seen", "token=A&b=1", 'url "https://h/x?sig=Q" failed', "monkey=1 b=2", None]
    out = values(text.redact_error(V), given, "string")
    assert out == ["error 'stream_token=<redacted>' seen", "token=<redacted>&b=1", 'url "https://h/x?sig=<redacted>" failed', "monkey=<redacted> b=2", None]


def test_unsafe_file_names_are_refused(values):
    assert values(text.checked_filename(V), [" a.csv ", "con1.txt"], "string") == ["a.csv", "con1.txt"]
    for bad in ("a/b", "c:x", "..", "", "NUL.txt", "a\\b"):
        with pytest.raises(Exception, match="unsafe file name"):
            values(text.checked_filename(V), [bad], "string")


def test_negative_values_become_zero_on_every_path(values):
    rows = [[-3, -1, 2]]
    assert values(arrays.remap_contiguous(V), rows, "array<bigint>") == [[0, 0, 2]]
    assert values(arrays.remap_contiguous(V, [-3, -1, 2]), rows, "array<bigint>") == [[0, 0, 2]]
    assert values(arrays.remap_contiguous(V, [-3, -1, 2, 100_000]), rows, "array<bigint>") == [[0, 0, 2]]
