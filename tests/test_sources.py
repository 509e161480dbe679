import io
import json
import tarfile
import zipfile

import numpy as np
import pandas as pd
import pytest

from millrace.queries.media import png_file, wav_file
from millrace.sources import archives, arrays, eventlog, folders, metadata, registry, tabular, text


def test_semicolon_csv(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("Username; Identifier;One-time password\nbooker12;9012;12se74\ngrey07;2070;04ap67\n")
    out = tabular.scan_csv(spark, str(file))
    assert out.columns == ["Username", " Identifier", "One-time password"]
    assert [r[1] for r in out.collect()] == [9012, 2070]


@pytest.mark.parametrize("sep,name", [(",", "a"), ("\t", "b"), ("|", "c"), (";", "d")])
def test_separators(spark, tmp_path, sep, name):
    file = tmp_path / f"{name}.csv"
    file.write_text(sep.join("xy") + "\n" + sep.join("12") + "\n" + sep.join("34") + "\n")
    assert [tuple(r) for r in tabular.scan_csv(spark, str(file)).collect()] == [(1, 2), (3, 4)]


def test_dates_stay_text(spark, tmp_path):
    file = tmp_path / "a.csv"
    file.write_text("d,f,b\n2024-01-01,1.5,true\n2024-01-02,2,false\n")
    kinds = dict(tabular.scan_csv(spark, str(file)).dtypes)
    assert kinds == {"d": "string", "f": "double", "b": "boolean"}


def test_json_array_ignores_metadata(spark, tmp_path):
    (tmp_path / "data.json").write_text(json.dumps([{"x": 1, "y": 2}, {"x": 3, "y": 4}]))
    (tmp_path / "meta.json").write_text(json.dumps({"id": "d", "x": 9}))
    rows = tabular.scan_json(spark, str(tmp_path)).select("x", "y").orderBy("x").collect()
    assert [tuple(r) for r in rows] == [(1, 2), (3, 4)]


def test_layout_columns(spark, tmp_path):
    table = spark.createDataFrame([(10, 2), (20, 3)], "price int, rooms int")
    assert tabular.project_layout(table, {"p": {"column": "price"}, "rooms": {}}).columns == ["p", "rooms"]
    with pytest.raises(ValueError, match="size"):
        tabular.project_layout(table, {"size": {}})


def test_row_index_over_files(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).repartitionByRange(7, "id").write.parquet(path)
    out = tabular.scan_indexed(spark, path).orderBy("row_index").collect()
    assert [r["row_index"] for r in out] == list(range(100))
    assert [r["id"] for r in out] == list(range(100))


def test_text_lines(spark, tmp_path):
    (tmp_path / "c.txt").write_bytes("alpha\nbeta\r\n\ngamma\x0bdelta\n".encode())
    rows = text.scan_text_lines(spark, str(tmp_path / "c.txt")).collect()
    assert [r["text"] for r in rows] == ["alpha", "beta", "gamma", "delta"]


def test_npz(spark, tmp_path):
    rows = [[1, 88586, 4], [7], [0, 2, 3]]
    np.savez(
        tmp_path / "a.npz", x=np.arange(24).reshape(3, 2, 2, 2).astype(np.uint8), y=np.arange(3), test_x=np.ones((2, 2)),
        seq_values=np.concatenate(rows), seq_offsets=np.array([0, 3, 4, 7]), odd_values=np.arange(3), odd_offsets=np.array([0, 2, 1, 3]),
        obj=np.array([[1], [2, 3]], dtype=object),
    )
    layout = {"x": {"key": "x", "test_key": "test_x"}, "y": {"key": "y"}, "s": {"key": "seq", "ragged": True}}
    out = arrays.scan_npz(spark, str(tmp_path), layout, rows_per_chunk=2).orderBy("row_index").collect()
    assert [list(map(int, r["s"])) for r in out] == rows
    assert out[1]["x"] == list(range(8, 16)) and out[1]["x_shape"] == [2, 2, 2] and out[2]["y"] == [2.0]
    assert arrays.scan_npz(spark, str(tmp_path), {"x": layout["x"]}, "test").count() == 2
    for bad, message in (({"a": {"key": "odd", "ragged": True}}, "fall"), ({"a": {"key": "obj"}}, "object"),
                         ({"a": {"key": "nope"}}, "nope"), (layout | {"z": {"key": "test_x"}}, "length")):
        with pytest.raises(Exception, match=message):
            arrays.scan_npz(spark, str(tmp_path), bad).collect()
    with pytest.raises(ValueError, match="key"):
        arrays.scan_npz(spark, str(tmp_path), {"a": {}})


def tree(root, names, content=b"x"):
    for name in names:
        path = root / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def test_class_folders(spark, tmp_path):
    tree(tmp_path, ["dog/b.PNG", "dog/a.jpg", "cat/c.webp", "cat/notes.txt", ".git/x.png", "emu/readme.md", "top.png", "cat/deep/z.png"])
    files = folders.sort_files(folders.scan_image_folder(spark, str(tmp_path)))
    found = [(r["class_name"], r["label"], r["file_name"]) for r in files.collect()]
    assert found == [("cat", 0, "c.webp"), ("dog", 1, "a.jpg"), ("dog", 1, "b.PNG")]


def test_declared_folders(spark, tmp_path):
    tree(tmp_path, ["audio/yes/a.wav", "audio/no/b.wav", "audio/no/c.WAV", "audio/_noise_/d.wav"])
    rows = folders.scan_declared_folder(spark, str(tmp_path), "audio", [".wav"], "audio")
    assert sorted((r["class_name"], r["label"]) for r in rows.collect()) == [("no", 0), ("yes", 1)]
    with pytest.raises(ValueError):
        folders.scan_declared_folder(spark, str(tmp_path), "audio", [".mp3"], "audio")
    # Spark lists no folder whose name starts with an underscore
    assert folders.scan_audio_folder(spark, str(tmp_path), "audio").count() == 3


def test_pairs(spark, tmp_path):
    tree(tmp_path, ["im/a.jpg", "im/b.jpg", "im/c.jpg", "ma/a.bmp", "ma/a.png", "ma/b.bmp", "ma/x.png"])
    pairs = folders.scan_image_mask_pairs(spark, str(tmp_path), "im", "ma", [".jpg"], [".png", ".bmp"])
    assert sorted((r["image"], r["mask"]) for r in pairs.collect()) == [("a.jpg", "a.png"), ("b.jpg", "b.bmp")]
    with pytest.raises(ValueError):
        folders.scan_image_mask_pairs(spark, str(tmp_path), "im", "ma", [".jpg"], [".gif"])


def layout_of(spark, names):
    table = spark.createDataFrame([("r", n) for n in names], "root string, relative string")
    row = folders.discover_layout(table).first()
    return row["has_explicit_splits"], row["splits"], row["class_names"]


def test_discover_layout(spark):
    assert layout_of(spark, ["train/dog/1.png", "val/cat/2.png", "test/readme.txt"]) == (True, ["train", "val"], ["cat", "dog"])
    assert layout_of(spark, ["dog/1.png", "cat/sub/2.png", ".x/3.png", "test/a.png"]) == (False, [], ["dog"])
    assert layout_of(spark, ["dog/.hidden", "a.txt"]) == (False, [], [])


def test_split_folder_choice(spark):
    def chosen(names, split):
        table = spark.createDataFrame([("r", n, f"{n}/x") for n in names], "root string, folder string, path string")
        return {r["folder"] for r in folders.filter_split_files(table, split).collect()}

    assert chosen(["train", "validation", "dev"], "val") == {"validation"}
    assert chosen(["train", "dev"], "test") == {"dev"}
    assert chosen(["train", "x"], "val") == {"train"}
    with pytest.raises(Exception, match="answers"):
        chosen(["x"], "val")


def zip_with(path, members, link=None):
    with zipfile.ZipFile(path, "w") as archive:
        for name in members:
            archive.writestr(name, name.encode())
        if link:
            info = zipfile.ZipInfo(link)
            info.external_attr = 0o120777 << 16
            archive.writestr(info, "target")


def test_archives(spark, tmp_path):
    zip_with(tmp_path / "a.zip", ["top/dog/1.png", "top/cat/2.png"])
    with tarfile.open(tmp_path / "b.tar.gz", "w:gz") as archive:
        for name in ("x/1.txt", "y/2.txt"):
            info = tarfile.TarInfo(name)
            info.size = 3
            archive.addfile(info, io.BytesIO(b"abc"))
    rows = archives.scan_archive_members(spark, str(tmp_path)).collect()
    assert sorted(r["relative"] for r in rows) == ["cat/2.png", "dog/1.png", "x/1.txt", "y/2.txt"]
    for limits in ({"max_members": 1}, {"max_bytes": 5}):
        with pytest.raises(Exception, match="more than"):
            archives.scan_archive_members(spark, str(tmp_path), **limits).collect()


@pytest.mark.parametrize("kind", ["parent", "absolute", "link", "tarlink", "fifo"])
def test_bad_archives(spark, tmp_path, kind):
    if kind in ("parent", "absolute", "link"):
        members = {"parent": ["../x"], "absolute": ["/x"], "link": ["a"]}[kind]
        zip_with(tmp_path / "a.zip", members, "ln" if kind == "link" else None)
    else:
        with tarfile.open(tmp_path / "a.tar", "w") as archive:
            info = tarfile.TarInfo("x")
            info.type = tarfile.SYMTYPE if kind == "tarlink" else tarfile.FIFOTYPE
            info.linkname = "/etc/passwd"
            archive.addfile(info)
    with pytest.raises(Exception, match="archive member"):
        archives.scan_archive_members(spark, str(tmp_path)).collect()


def test_event_log(spark, tmp_path):
    lines = [b'\xef\xbb\xbf{"a":1}', b"", b"{not json}", b"[1, 2, 3]", '{"b":"ä"}\r'.encode(), b'{"c":3}', b'{"partial"']
    log = tmp_path / "m.jsonl"
    log.write_bytes(b"\n".join(lines))
    offsets, at = [], 0
    for line in lines:
        offsets.append(at)
        at += len(line) + 1
    rows = eventlog.scan_events(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r["offset"] for r in rows] == [offsets[0], offsets[4], offsets[5]]
    assert [r["line"] for r in rows] == ['{"a":1}', '{"b":"ä"}', '{"c":3}']
    assert eventlog.scan_events(spark, str(tmp_path), replay=False).count() == 0
    seen = spark.createDataFrame([(rows[0]["file"], offsets[5])], "file string, size bigint")
    log.write_bytes(b"\n".join(lines) + b":1}\n")
    later = eventlog.scan_events(spark, str(tmp_path), seen=seen).orderBy("offset").collect()
    assert [r["line"] for r in later] == ['{"c":3}', '{"partial":1}']


def test_event_log_in_many_pieces(spark, tmp_path):
    lines = [json.dumps({"n": i, "pad": "x" * (i % 90)}).encode() for i in range(4000)]
    (tmp_path / "m.jsonl").write_bytes(b"\n".join(lines) + b"\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        rows = eventlog.scan_events(spark, str(tmp_path)).orderBy("offset").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    at, expected = 0, []
    for line in lines:
        expected.append(at)
        at += len(line) + 1
    assert [r["offset"] for r in rows] == expected


def test_metadata(spark):
    good = {"id": "d", "name": "n", "format": "csv", "dataset_type": "tabular", "num_samples": 5, "num_classes": 2}
    cases = [
        (good, None), (good | {"class_names": ["a"], "feature_schema": {"columns": [{"name": "x", "type": "numeric"}]}}, None),
        (good | {"num_samples": True}, "num_samples"), (good | {"num_classes": "2"}, "num_classes"),
        ({k: v for k, v in good.items() if k != "name"}, "name"), (good | {"class_names": [1]}, "class_names"),
        (good | {"class_names": None, "feature_schema": None}, None), (good | {"feature_schema": 3}, "feature_schema"),
    ]
    table = spark.createDataFrame([(i, json.dumps(c)) for i, (c, _) in enumerate(cases)] + [(99, "{")], "i int, meta string")
    rows = metadata.read_metadata(table).orderBy("i").collect()
    assert [r["problem"] for r in rows] == [p for _, p in cases] + ["not JSON"]
    assert rows[1]["class_names"] == ["a"] and rows[1]["feature_columns"][0]["name"] == "x"
    assert rows[2]["num_samples"] is None


def test_registry(spark, tmp_path):
    with pytest.raises(ValueError, match="tabular"):
        registry.reader_for("parchment")
    (tmp_path / "c.txt").write_text("a b c d\ne f g h\n")
    plain = registry.reader_for("text")(spark, str(tmp_path), {"text": {"file": "c.txt"}}, "train")
    assert plain.count() == 2
    spec = {"file": "c.txt", "self_supervised": "next_token", "sequence_length": 3}
    assert registry.reader_for("text")(spark, str(tmp_path), {"text": spec}, "train").count() == 2
    for bad in ("../x", "/x", "a\\..\\..\\x", ""):
        with pytest.raises(ValueError):
            registry.inside(str(tmp_path), bad)


def test_media_files(spark, tmp_path):
    pixels = np.arange(64, dtype=np.uint8).reshape(8, 8)
    tree(tmp_path, ["im/a/1.png"], png_file(pixels))
    tree(tmp_path, ["au/b/1.wav"], wav_file(np.array([0, 16384, -16384]), 16000))
    from millrace.operators import media

    image = media.prepare_images(folders.scan_image_folder(spark, str(tmp_path), "im").select("label", "content")).first()
    assert image["image"]["shape"] == [8, 8, 3] and image["image"]["data"][3] == pytest.approx(1 / 255)
    sound = media.prepare_audio(folders.scan_audio_folder(spark, str(tmp_path), "au").select("content"), length=4).first()
    assert sound["audio"]["data"] == [0, 0.5, -0.5, 0]


def test_native_image_source_agrees(spark, tmp_path):
    from millrace.operators import media

    pixels = (np.arange(64, dtype=np.uint8) * 3).reshape(8, 8)
    tree(tmp_path, ["1.png"], png_file(pixels))
    row = spark.read.format("image").load(str(tmp_path)).select("image.data").first()
    own = media.decode_image(png_file(pixels), "L")
    assert list(row["data"])[:64] == own.reshape(-1).tolist()[:64] or len(row["data"]) == 192


def test_csv_with_line_breaks_and_doubled_quotes(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,t\n1,"two\nlines"\n2,"say ""hi"", ok"\n3,plain\n')
    rows = tabular.scan_csv(spark, str(tmp_path / "a.csv")).orderBy("id").collect()
    assert [r["t"] for r in rows] == ["two\nlines", 'say "hi", ok', "plain"]


def test_json_inference_leaves_out_the_metadata(spark, tmp_path):
    (tmp_path / "meta.json").write_text('{"format": "json", "id": "q"}')
    for name in ("a", "m", "meta2", "metadata", "meta.part", "me"):
        (tmp_path / f"{name}.json").write_text('[{"x": 1, "y": "u"}]')
    table = tabular.scan_json(spark, str(tmp_path))
    assert sorted(table.columns) == ["x", "y"] and table.count() == 6


def test_tabular_folder_opens_its_first_table(spark, tmp_path):
    (tmp_path / "b.csv").write_text("x,y\n1,2\n")
    (tmp_path / "c.csv").write_text("x,y\n3,4\n")
    (tmp_path / "a.txt").write_text("no table")
    rows = tabular.scan_tabular(spark, str(tmp_path), {"x": {}, "z": {"column": "y"}}).collect()
    assert [tuple(r) for r in rows] == [(1, 2)]


def test_a_line_that_was_being_written_is_read_later(spark, tmp_path):
    log = tmp_path / "log.jsonl"
    log.write_bytes(b'{"a":1}\n{"a":2')
    listed = eventlog.log_files(spark, str(tmp_path)).collect()
    before = spark.createDataFrame([tuple(r) for r in listed], "file string, size bigint")
    with log.open("ab") as more:
        more.write(b'2}\n')
    rows = eventlog.scan_events(spark, str(tmp_path), seen=before).collect()
    assert [(r["offset"], r["line"]) for r in rows] == [(8, '{"a":22}')]


def test_files_are_listed_by_tasks(spark, tmp_path):
    names = ["a/b c%20.png", "a/deep/er/ü.wav", "_hidden/x.png", "a/.y", "a/_z", "k=v/_p=1", "top.txt", "_metadata/m.png"]
    tree(tmp_path, [*names, "a/_metadata"], b"data")
    tree(tmp_path, ["a/empty.png"], b"")
    (tmp_path / "bare").mkdir()
    (tmp_path / "broken").symlink_to(tmp_path / "nothing")
    files = folders.list_files(spark, str(tmp_path))
    plain = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path))
    found = sorted((r["path"], r["size_bytes"], bytes(r["content"])) for r in files.collect())
    assert found == sorted((r["path"], r["length"], bytes(r["content"])) for r in plain.collect())
    assert {r["relative"] for r in files.collect()} == set(names) - {"_hidden/x.png", "a/.y", "a/_z"}
    # the driver holds no list of the files: what is read is the stored listing
    assert files.select("path").inputFiles() and not any(str(tmp_path / "a") in f for f in files.inputFiles())
    # without content no file is opened
    (tmp_path / "top.txt").unlink()
    assert files.select("relative", "size_bytes").count() == len(found)
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        folders.list_files(spark, str(tmp_path / "nowhere"))


def test_contents_are_read_a_few_at_a_time(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(folders, "CONTENT_BYTES", 10)
    tree(tmp_path, [f"a/{i}.png" for i in range(9)], b"0123456")
    paths = pd.Series([f"file:{tmp_path}/a/{i}.png" for i in range(9)])
    assert [len(part) for part in folders._content.func(iter([paths]))] == [2, 2, 2, 2, 1]


def test_pairs_meet_without_a_broadcast(spark, tmp_path):
    tree(tmp_path, ["im/a.jpg", "ma/a.png"])
    pairs = folders.scan_image_mask_pairs(spark, str(tmp_path), "im", "ma", [".jpg"], [".png"])
    assert "Broadcast" not in pairs._jdf.queryExecution().executedPlan().toString()
