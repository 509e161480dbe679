"""Readers: each query stores a given table in the format and reads it back."""

from __future__ import annotations

import io
import os
import tarfile
import zipfile

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from millrace.operators.encode import rows_from_offsets, spans_of, words_of
from millrace.operators.position import ordered_position
from millrace.queries.registry import LINE_CLASS, indexed, joined, query, sql_tokens, table
from millrace.session import fresh_path, spread
from millrace.sources import archives, arrays, eventlog, folders, metadata, tabular, text


def write_named(files, path, ending):
    """Each row ``(name, value)`` as one file, in folders if the name has any, written by its task."""
    target = path.removeprefix("file:")

    def write(batches):
        for batch in batches:
            for name, value in zip(batch["name"], batch["value"], strict=True):
                place = f"{target}/{name}.{ending}" if ending else f"{target}/{name}"
                os.makedirs(os.path.dirname(place), exist_ok=True)
                with open(place, "w", encoding="utf-8") as file:
                    file.write(value or "")
            yield batch[["name"]]

    spread(files).mapInPandas(write, "name string").write.format("noop").mode("overwrite").save()


@query(
    "sc1_scan_csv",
    "select cast(c_custkey as bigint) c_custkey, c_name, cast(c_nationkey as bigint) c_nationkey,"
    " c_acctbal, c_mktsegment || chr(10) || 'a \"' || c_name || '\"; b' as c_mktsegment from customer",
)
def scan_csv(spark, folder):
    # fields with line breaks, separators and quotes in them
    path = fresh_path(spark, "csv")
    odd = F.concat("c_mktsegment", F.lit('\na "'), "c_name", F.lit('"; b'))
    customers = table(spark, folder, "customer").withColumn("c_mktsegment", odd)
    customers.write.csv(path, sep=";", header=True, escape='"')
    return tabular.scan_csv(spark, path, ";")


@query(
    "sc1_scan_large_csv",
    "select cast(c_custkey as bigint) c_custkey, c_name, cast(c_nationkey as bigint) c_nationkey,"
    " c_acctbal, case when c_custkey % 3 = 0 then null else c_mktsegment || chr(10) || 'a \"' || c_name || '\", ' || chr(10) || ' b' end as c_mktsegment from customer",
)
def scan_large_csv(spark, folder):
    # one file, its quoted line breaks across the borders of many blocks
    path = fresh_path(spark, "csv")
    odd = F.concat("c_mktsegment", F.lit('\na "'), "c_name", F.lit('", \n b'))
    customers = table(spark, folder, "customer").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 3 != 0, odd))
    customers.coalesce(1).write.csv(path, header=True, escape='"')
    return tabular.scan_large_csv(spark, path, ",", block_bytes=1 << 13)


@query(
    "sc2_scan_tsv",
    "select p_partkey, p_name, p_brand, p_type, cast(p_size as bigint) p_size, p_retailprice from part",
)
def scan_tsv(spark, folder):
    path = fresh_path(spark, "tsv")
    table(spark, folder, "part").write.csv(path, sep="\t", header=True)
    return tabular.scan_tsv(spark, path)


@query(
    "sc3_scan_json",
    "select s_suppkey, s_name, cast(s_nationkey as bigint) s_nationkey, s_acctbal from supplier",
)
def scan_json(spark, folder):
    path = fresh_path(spark, "json")
    rows = table(spark, folder, "supplier")
    records = F.to_json(F.collect_list(F.struct(*rows.columns)))
    # one array per file, 50 records each, and a file of metadata beside them
    part = F.expr("s_suppkey div 50").alias("part")
    arrays_ = rows.groupBy(part).agg(records.alias("value"))
    meta = spark.range(1).select(F.lit("meta").alias("name"), F.lit('{"rows": 1}').alias("value"))
    write_named(arrays_.select(F.concat(F.lit("m"), "part").alias("name"), "value").union(meta), path, "json")
    return tabular.scan_json(spark, path).select(*rows.columns)


@query(
    "sc3_scan_large_json",
    """select c_custkey, c_name || ' a }, {' || chr(34) || c_mktsegment || chr(92) as about_text, c_acctbal from customer""",
)
def scan_large_json(spark, folder):
    # one file with one array; braces, quotes and backslashes within strings, objects within objects
    path = fresh_path(spark, "json")
    note = F.concat(F.lit('a }, {"'), "c_mktsegment", F.lit("\\"))
    about = F.struct(F.col("c_name").alias("name"), note.alias("note"))
    rows = table(spark, folder, "customer").select("c_custkey", about.alias("about"), "c_acctbal")
    key = F.col("c_custkey")
    first, last = rows.agg(F.min("c_custkey"), F.max("c_custkey")).first()
    line = F.concat(
        F.when(key == first, "[\n").otherwise(""), F.to_json(F.struct(*rows.columns)), F.when(key == last, "]").otherwise(", ")
    )
    rows.select("c_custkey", line.alias("value")).coalesce(1).sortWithinPartitions("c_custkey").select("value").write.text(path)
    found = tabular.scan_large_json(spark, path, files="*.txt", block_bytes=1 << 13)
    return found.select("c_custkey", F.concat_ws(" ", "about.name", "about.note").alias("about_text"), "c_acctbal")


@query(
    "sc4_scan_jsonl",
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    " strftime(o_orderdate, '%Y-%m-%d') o_orderdate, o_orderpriority from orders",
)
def scan_jsonl(spark, folder):
    path = fresh_path(spark, "jsonl")
    orders = table(spark, folder, "orders")
    orders.withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd")).write.json(path)
    return tabular.scan_jsonl(spark, path).select(*orders.columns)


@query(
    "sc5_scan_tabular",
    "select l_extendedprice price, l_quantity l_quantity, l_returnflag flag from lineitem",
)
def scan_tabular(spark, folder):
    layout = {
        "price": {"column": "l_extendedprice"},
        "l_quantity": {},
        "flag": {"column": "l_returnflag"},
    }
    return tabular.scan_tabular(spark, f"{folder}/lineitem.parquet", layout)


@query(
    "sc6_scan_text_lines",
    f"""with l as (select doc_id, list_filter(regexp_split_to_array(text, '{LINE_CLASS}'),
                          lambda t: t <> '') as ls from documents)
    select doc_id, cast(i as bigint) as line_no, ls[i + 1] as line
    from (select doc_id, ls, unnest(range(len(ls))) as i from l)""",
)
def scan_text_lines(spark, folder):
    docs = table(spark, folder, "documents")
    return text.explode_lines(docs, "doc_id").withColumn("line_no", F.col("line_no").cast("bigint"))


@query(
    "sc6_scan_text_files",
    f"""with l as (select unnest(list_filter(regexp_split_to_array(text, '{LINE_CLASS}'), lambda t: t <> '')) as text from documents)
    select text, cast(count(*) as bigint) as n from l group by text""",
)
def scan_text_files(spark, folder):
    path = fresh_path(spark, "corpus")
    table(spark, folder, "documents").select("text").write.text(path)
    lines = text.scan_text_lines(spark, path)
    return lines.groupBy("text").agg(F.count(F.lit(1)).alias("n"))


@query(
    "sc9_list_class_folders",
    """with c as (select lang, row_number() over (order by lang) - 1 as label from (select distinct lang from documents))
    select 'lang=' || lang as class_name, cast(label as bigint) as label, cast(sum(octet_length(encode(text)) + 1) as bigint) as size_bytes
    from documents join c using (lang) group by all""",
)
def list_class_folders(spark, folder):
    # real files, a folder per class; however many files a class has, its bytes are the same
    path = fresh_path(spark, "classes")
    table(spark, folder, "documents").select("lang", "text").write.partitionBy("lang").text(path)
    files = folders.class_folder_files(folders.list_files(spark, path), [".txt"])
    return files.groupBy("class_name", "label").agg(F.sum("size_bytes").alias("size_bytes"))


@query(
    "sc7_scan_arrays",
    """select vec_id, cast(label as bigint) as y, cast(i as bigint) as at,
              cast(embedding[i + 1] as double) as v
       from (select *, unnest(range(len(embedding))) as i from embeddings)""",
)
def scan_arrays(spark, folder):
    layout = {
        "vec_id": {"key": "vec_id"},
        "x": {"key": "train_x", "test_key": "embedding"},
        "y": {"key": "label"},
    }
    rows = arrays.scan_arrays(table(spark, folder, "embeddings"), layout, "test")
    return rows.select(
        "vec_id", F.col("y").cast("bigint").alias("y"), F.posexplode("x").alias("at", "v")
    ).select("vec_id", "y", F.col("at").cast("bigint").alias("at"), F.col("v").cast("double").alias("v"))


@query(
    "sc8_ragged_from_offsets",
    f"select doc_id as row, array_to_string({sql_tokens('text')}, ' ') as words from documents",
)
def ragged_from_offsets(spark, folder):
    docs = words_of(table(spark, folder, "documents"), "text", ["doc_id"])
    placed = ordered_position(docs.select("doc_id", "n"), ["doc_id"], "i", {"offset": "n"})
    # the flat form: all words with their place in the corpus, and the row boundaries
    flat = docs.join(placed, "doc_id").select("offset", F.posexplode("words").alias("at", "value"))
    values = flat.select((F.col("offset") + F.col("at")).alias("pos"), "value")
    starts = placed.select("i", "offset")
    end = placed.agg((F.max("i") + 1).alias("i"), F.sum("n").alias("offset"))
    spans = spans_of(starts.unionByName(end))
    rows = rows_from_offsets(values, spans)
    named = rows.join(placed.select(F.col("i").alias("row"), "doc_id"), "row")
    return named.select(F.col("doc_id").alias("row"), joined(F.col("values")).alias("words"))


@query(
    "sc7_scan_npz",
    """select vec_id, cast(label as bigint) as y, i as at, cast(embedding[i + 1] as double) as v,
         cast(vec_id % 5 + 1 as bigint) as ragged_size
       from (select *, unnest(range(len(embedding))) as i from embeddings)""",
)
def scan_npz(spark, folder):
    def pack(chunk: pd.DataFrame) -> pd.DataFrame:
        sizes = (chunk["vec_id"] % 5 + 1).to_numpy()
        out = io.BytesIO()
        np.savez(
            out, ids=chunk["vec_id"], x=np.stack(chunk["embedding"]), y=chunk["label"],
            r_values=np.arange(sizes.sum()), r_offsets=np.concatenate([[0], np.cumsum(sizes)]),
        )
        return pd.DataFrame({"path": [str(chunk["vec_id"].iloc[0])], "content": [out.getvalue()]})

    # one file per fifty vectors
    files = table(spark, folder, "embeddings").groupBy(F.expr("vec_id div 50")).applyInPandas(
        pack, "path string, content binary"
    )
    layout = {"id": {"key": "ids"}, "x": {"key": "x"}, "y": {"key": "y"}, "r": {"key": "r", "ragged": True}}
    rows = arrays.decode_npz(files, layout).select(
        F.get("id", F.lit(0)).cast("bigint").alias("vec_id"),
        F.get("y", F.lit(0)).cast("bigint").alias("y"),
        F.posexplode("x").alias("at", "v"),
        F.size("r").cast("bigint").alias("ragged_size"),
    )
    return rows.withColumn("at", F.col("at").cast("bigint"))


def _class_paths(spark, folder, endings):
    docs = table(spark, folder, "documents")
    part = (F.col("doc_id") % len(endings)).cast("int")
    name = F.concat(F.lit("f"), F.col("doc_id"), F.get(F.lit(endings), part))
    # some folders are hidden, some files lie a folder too deep
    place = F.when(F.col("source") == "src3", F.concat(F.lit("."), "lang")).otherwise(F.col("lang"))
    deep = F.when(F.col("source") == "src4", F.concat_ws("/", place, F.lit("more"), name))
    return docs.select("doc_id", F.coalesce(deep, F.concat_ws("/", place, name)).alias("relative"))


@query(
    "sc9_scan_image_folder",
    """with c as (select lang, row_number() over (order by lang) - 1 as label
                  from (select distinct lang from documents where source <> 'src3'))
    select doc_id, lang as class_name, cast(label as bigint) as label from documents join c using (lang)
    where doc_id % 4 in (0, 1) and source not in ('src3', 'src4')""",
)
def scan_image_folder(spark, folder):
    files = _class_paths(spark, folder, [".jpg", ".WebP", ".txt", ""])
    return folders.class_folder_files(files).select("doc_id", "class_name", "label")


@query(
    "sc10_scan_audio_folder",
    """with c as (select lang, row_number() over (order by lang) - 1 as label
                  from (select distinct lang from documents where source <> 'src3'))
    select doc_id, lang as class_name, cast(label as bigint) as label from documents join c using (lang)
    where doc_id % 4 = 0 and source not in ('src3', 'src4')""",
)
def scan_audio_folder(spark, folder):
    # a declared layout matches its extensions exactly
    files = _class_paths(spark, folder, [".wav", ".WAV", ".mp3", ".md"])
    found = folders.class_folder_files(files, [".wav"], any_case=False)
    return found.select("doc_id", "class_name", "label")


@query(
    "sc10_list_audio_folder",
    """with f as (select doc_id, lang, case doc_id % 3 when 0 then '.wav' when 1 then '.MP3' else '.txt' end as ext,
        cast(octet_length(encode(text)) as bigint) as size_bytes from documents),
    c as (select lang, row_number() over (order by lang) - 1 as label from (select distinct lang from f))
    select lang as class_name, cast(label as bigint) as label, doc_id || ext as file_name, size_bytes
    from f join c using (lang) where ext <> '.txt'""",
)
def list_audio_folder(spark, folder):
    # real files; the bytes are no audio, which a listing does not open
    path = fresh_path(spark, "audio")
    ending = F.when(F.col("doc_id") % 3 == 0, ".wav").when(F.col("doc_id") % 3 == 1, ".MP3").otherwise(".txt")
    name = F.concat_ws("/", "lang", F.concat(F.col("doc_id").cast("string"), ending))
    write_named(table(spark, folder, "documents").select(name.alias("name"), F.col("text").alias("value")), path, "")
    found = folders.scan_audio_folder(spark, path)
    return found.select("class_name", "label", "file_name", "size_bytes")


@query(
    "sc11_list_image_mask_pairs",
    """select 'img' || doc_id as stem, 'img' || doc_id || '.jpg' as image,
        'img' || doc_id || case when lang in ('en', 'fr') then '.png' else '.bmp' end as mask
       from documents where lang <> 'es'""",
)
def list_image_mask_pairs(spark, folder):
    # real files in two folders; en has masks of two kinds, es only one that is not declared
    path = fresh_path(spark, "pairs")
    docs = table(spark, folder, "documents")
    kinds = (
        F.when(F.col("lang") == "en", F.array(F.lit("masks/.bmp"), F.lit("masks/.png")))
        .when(F.col("lang") == "fr", F.array(F.lit("masks/.png")))
        .when(F.col("lang") == "de", F.array(F.lit("masks/.bmp"), F.lit("masks/.txt")))
        .otherwise(F.array(F.lit("masks/.gif")))
    )
    places = F.explode(F.concat(F.array(F.lit("images/.jpg")), kinds)).alias("place")
    files = docs.select("doc_id", places).select(
        F.concat(F.substring_index("place", ".", 1), F.lit("img"), "doc_id", F.lit("."), F.substring_index("place", ".", -1)).alias("name"),
        F.lit("x").alias("value"),
    )
    write_named(files, path, "")
    pairs = folders.scan_image_mask_pairs(spark, path, "images", "masks", [".jpg"], [".png", ".bmp"])
    return pairs.select("stem", F.substring_index("image", "/", -1).alias("image"), F.substring_index("mask", "/", -1).alias("mask"))


@query(
    "sc14_scan_archive_members",
    """select cast(doc_id // 50 as bigint) as archive, lang || '/' || doc_id || '.txt' as relative, sha256(text) as checksum
       from documents""",
)
def scan_archive_members(spark, folder):
    def pack(chunk: pd.DataFrame) -> pd.DataFrame:
        number = int(chunk["doc_id"].iloc[0]) // 50
        out = io.BytesIO()
        names = [f"set/{r.lang}/{r.doc_id}.txt" for r in chunk.itertuples()]
        contents = [t.encode() for t in chunk["text"]]
        if number % 2:
            with tarfile.open(fileobj=out, mode="w:gz") as archive:
                for name, content in zip(names, contents, strict=True):
                    info = tarfile.TarInfo(name)
                    info.size = len(content)
                    archive.addfile(info, io.BytesIO(content))
        else:
            with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as archive:
                for name, content in zip(names, contents, strict=True):
                    archive.writestr(name, content)
        return pd.DataFrame({"path": [str(number)], "content": [out.getvalue()]})

    # one archive per fifty documents, zip and tar in turn
    packed = table(spark, folder, "documents").groupBy(F.expr("doc_id div 50")).applyInPandas(
        pack, "path string, content binary"
    )
    return archives.unpack(packed).select(
        F.col("archive").cast("bigint").alias("archive"), "relative", F.sha2("content", 256).alias("checksum")
    )


FOLDERS = """
f as (select source, cast(substr(source, 4) as bigint) % 4 as kind, doc_id, lang,
             doc_id % 3 as part from documents)
"""


def _path_table(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select(
        F.col("source").alias("root"),
        (F.substring("source", 4, 9).cast("bigint") % 4).alias("kind"),
        "doc_id",
        "lang",
        (F.col("doc_id") % 3).alias("part"),
    )


@query(
    "sc12_discover_layout",
    f"""with {FOLDERS}
    select source as root, kind in (0, 1) as has_explicit_splits,
      case when kind in (0, 1) then array_to_string(list_sort(list(distinct
        case when kind = 0 then case part when 0 then 'train' when 1 then 'val' else 'test' end
             else 'Train' end)), ' ') else '' end as splits,
      case when kind < 3 then array_to_string(list_sort(list(distinct lang)), ' ') else '' end
        as class_names
    from f group by source, kind""",
)
def discover_layout(spark, folder):
    split = F.element_at(F.array(F.lit("train"), F.lit("val"), F.lit("test")), (F.col("part") + 1).cast("int"))
    file = F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))
    # split folders; one capitalised split; plain classes; files at the top and in hidden folders
    path = (
        F.when(F.col("kind") == 0, F.concat_ws("/", split, F.col("lang"), file))
        .when(F.col("kind") == 1, F.concat_ws("/", F.lit("Train"), F.col("lang"), file))
        .when(F.col("kind") == 2, F.concat_ws("/", F.col("lang"), file))
        .otherwise(F.when(F.col("part") == 0, file).otherwise(F.concat_ws("/", F.lit(".cache"), file)))
    )
    found = folders.discover_layout(_path_table(spark, folder).withColumn("relative", path))
    return found.withColumns({"splits": joined(F.col("splits")), "class_names": joined(F.col("class_names"))})


@query(
    "sc13_filter_split_files",
    f"""with {FOLDERS}, g as (select *, case when part = 0 or kind = 3 then 'train'
        when kind = 0 then case part when 1 then 'val' else 'validation' end
        when kind = 1 then case part when 1 then 'validation' else 'dev' end
        else 'dev' end as folder from f)
    select source as root, folder, doc_id from g
    where folder = case kind when 0 then 'val' when 1 then 'validation' when 2 then 'dev' else 'train' end""",
)
def filter_split_files(spark, folder):
    files = _path_table(spark, folder)
    part, kind = F.col("part"), F.col("kind")
    name = (
        F.when((part == 0) | (kind == 3), "train")
        .when(kind == 0, F.when(part == 1, "val").otherwise("validation"))
        .when(kind == 1, F.when(part == 1, "validation").otherwise("dev"))
        .otherwise("dev")
    )
    chosen = folders.filter_split_files(files.withColumn("folder", name), "val")
    return chosen.select("root", "folder", "doc_id")


def write_logs(events, line, path):
    """One log file per ten users, in event order."""
    log = F.expr("user_id div 10").alias("log")
    lines = events.select(log, "event_id", line.alias("value")).repartition("log")
    ordered = lines.sortWithinPartitions("log", "event_id").drop("event_id")
    ordered.write.partitionBy("log").text(path)


def log_of(file):
    return F.regexp_extract(file, r"log=(\d+)", 1).cast("bigint")


@query(
    "sc15_scan_events",
    """with l as (
      select user_id // 10 as log, event_id,
        case event_type when 'error' then '{not json}' when 'signup' then '[1, 2, 3]'
             when 'view' then '' else '{"seq":' || event_id || ',"kind":"' || event_type || '"}' end
          || case when event_type = 'purchase' then chr(13) else '' end as line
      from events),
    o as (select *, sum(octet_length(encode(line)) + 1)
             over (partition by log order by event_id) - octet_length(encode(line)) - 1 as off
          from l)
    select cast(log as bigint) as log, cast(off as bigint) as "offset",
           event_id as seq from o where line like '{"seq"%'""",
)
def scan_events(spark, folder):
    events = table(spark, folder, "events")
    kind = F.col("event_type")
    good = F.to_json(F.struct(F.col("event_id").alias("seq"), kind.alias("kind")))
    line = (
        F.when(kind == "error", "{not json}")
        .when(kind == "signup", "[1, 2, 3]")
        .when(kind == "view", "")
        .when(kind == "purchase", F.concat(good, F.lit("\r")))
        .otherwise(good)
    )
    path = fresh_path(spark, "log")
    write_logs(events, line, path)
    found = eventlog.scan_events(spark, path)
    return found.select(
        log_of("file").alias("log"), "offset", F.get_json_object("line", "$.seq").cast("bigint").alias("seq")
    )


@query(
    "sc16_scan_catalog",
    """select 'ds' || p_partkey as id, p_name as name,
        case when p_size = 7 then null else 'csv' end as format,
        p_type as dataset_type,
        case when p_size = 5 then null else cast(p_partkey as bigint) end as num_samples,
        case when p_size = 6 then null else cast(p_size as bigint) end as num_classes,
        case when p_size > 25 then array_to_string(string_split(p_name, ' '), ' ') end as class_names,
        case when p_size = 7 then 'format' when p_size = 5 then 'num_samples'
             when p_size = 6 then 'num_classes' end as problem
       from part""",
)
def scan_catalog(spark, folder):
    part = table(spark, folder, "part")
    size = F.col("p_size")
    optional = F.when(size > 25, F.concat(F.lit(',"class_names":'), F.to_json(F.split("p_name", " "))))
    record = F.concat(
        F.lit('{"id":"ds'), F.col("p_partkey"), F.lit('","name":"'), F.col("p_name"),
        F.when(size == 7, '"').otherwise('","format":"csv"'),
        F.lit(',"dataset_type":"'), F.col("p_type"), F.lit('","num_samples":'),
        F.when(size == 5, "true").otherwise(F.col("p_partkey").cast("string")),
        F.lit(',"num_classes":'),
        F.when(size == 6, F.lit('"six"')).otherwise(size.cast("string")),
        F.coalesce(optional, F.lit("")),
        F.lit("}"),
    )
    rows = metadata.read_metadata(part.select(record.alias("meta"))).drop("feature_columns")
    return rows.withColumn("class_names", joined(F.col("class_names")))


@query(
    "sc0_row_index",
    "with li as (select row_number() over () - 1 as row_index, * from lineitem)"
    " select cast(row_index as bigint) as row_index, l_orderkey, l_linenumber, l_partkey from li",
)
def row_index(spark, folder):
    return indexed(spark, folder, "lineitem").select(
        "row_index", "l_orderkey", "l_linenumber", "l_partkey"
    )
