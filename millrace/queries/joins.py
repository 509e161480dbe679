"""Relational matches."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import catalog, joins
from millrace.operators.encode import encode_labels, token_ids, vocabulary, words_of
from millrace.queries.registry import LINEITEM, indexed, query, sql_tokens, table


@query(
    "jn1_class_lookup",
    """select l_returnflag, l_linestatus, cast(case l_returnflag when 'R' then 0 when 'N' then 1 else 2 end as bigint) as code,
       count(*) as n from lineitem group by all""",
)
def class_lookup(spark, folder):
    rows = table(spark, folder, "lineitem").select("l_returnflag", "l_linestatus")
    coded = encode_labels(rows, "l_returnflag", ["R", "N", "A"])
    return coded.groupBy("l_returnflag", "l_linestatus", "code").agg(F.count(F.lit(1)).alias("n"))


@query(
    "jn1_class_lookup_many",
    "select c_custkey, cast(24 - c_nationkey as bigint) as code from customer",
)
def class_lookup_many(spark, folder):
    # more names than are matched inline; nation keys count down, the rest match nothing
    names = [str(24 - i) for i in range(25)] + [f"other {i}" for i in range(300)]
    rows = table(spark, folder, "customer").select("c_custkey", "c_nationkey")
    return encode_labels(rows, "c_nationkey", names).select("c_custkey", "code")


@query(
    "jn2_membership_join",
    f"""with {LINEITEM}, m as (select 5 * o_orderkey as row_index, o_orderpriority as split_name, o_custkey as pos from orders)
    select cast(row_index as bigint) as row_index, split_name, pos, l_partkey from li join m using (row_index)""",
)
def membership_join(spark, folder):
    rows = indexed(spark, folder, "lineitem").select("row_index", "l_partkey")
    members = table(spark, folder, "orders").select(
        (F.col("o_orderkey") * 5).alias("row_index"),
        F.col("o_orderpriority").alias("split_name"),
        F.col("o_custkey").alias("pos"),
    )
    return joins.rows_at(rows, members).select("row_index", "split_name", "pos", "l_partkey")


PAIRS = """select 'img' || doc_id as stem, 'img' || doc_id || '.jpg' as image,
        'img' || doc_id || case when lang in ('en', 'fr') then '.png' else '.bmp' end as mask
       from documents where lang <> 'es'"""


@query("jn3_pair_by_stem", PAIRS)
def pair_by_stem(spark, folder):
    from millrace.sources.folders import pair_by_stem as pair

    docs = table(spark, folder, "documents")
    name = F.concat(F.lit("img"), F.col("doc_id").cast("string"))
    images = docs.select(F.concat(name, F.lit(".jpg")).alias("file_name"))
    # en has both masks, fr the first, de the second, es only an undeclared one
    kinds = (
        F.when(F.col("lang") == "en", F.array(F.lit(".bmp"), F.lit(".png")))
        .when(F.col("lang") == "fr", F.array(F.lit(".png")))
        .when(F.col("lang") == "de", F.array(F.lit(".bmp"), F.lit(".txt")))
        .otherwise(F.array(F.lit(".gif")))
    )
    masks = docs.select(name.alias("n"), F.explode(kinds).alias("e")).select(
        F.concat("n", "e").alias("file_name")
    )
    return pair(images, masks, [".jpg"], [".png", ".bmp"])


@query(
    "jn4_pending_uploads",
    """select l_orderkey, l_linenumber, l_partkey from lineitem
       where l_orderkey not in (select o_orderkey from orders where o_orderstatus = 'F')""",
)
def pending_uploads(spark, folder):
    offered = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    committed = table(spark, folder, "orders").filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("l_orderkey")
    )
    return joins.pending_uploads(offered, committed, ["l_orderkey"])


@query(
    "jn5_verify_checksums",
    """select doc_id as file, case when lang = 'en' then null when lang = 'de' then sha256(text || '!') else sha256(text) end as expected,
        case when lang <> 'es' then sha256(text) end as actual,
        case lang when 'en' then 'unexpected' when 'de' then 'mismatch' when 'es' then 'missing' else 'ok' end as status
       from documents""",
)
def verify_checksums(spark, folder):
    docs = table(spark, folder, "documents")
    digest = F.sha2(F.col("text").cast("binary"), 256)
    other = F.sha2(F.concat("text", F.lit("!")).cast("binary"), 256)
    expected = docs.filter("lang <> 'en'").select(
        F.col("doc_id").alias("file"),
        F.concat(F.lit("sha256:"), F.when(F.col("lang") == "de", other).otherwise(digest)).alias("checksum"),
    )
    actual = docs.filter("lang <> 'es'").select(F.col("doc_id").alias("file"), digest.alias("checksum"))
    return joins.verify_checksums(expected, actual)


@query(
    "jn6_descriptor_lookup",
    """with e as (select vec_id, i, embedding[i + 1]::double as v from
                  (select *, unnest(range(len(embedding))) as i from embeddings))
    select vec_id, 'c' || i as name, round((v - i / 100.0::double) / (1 + i / 10.0::double), 6) as v from e where i < 32
    union all select vec_id, 'c' || i, round(v, 6) from e where i >= 32""",
)
def descriptor_lookup(spark, folder):
    values = table(spark, folder, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v"))
    values = values.withColumn("name", F.concat(F.lit("c"), "i"))
    # one descriptor per declared column, taken from the data's own width
    declared = values.select("i", "name").distinct().filter("i < 32").select(
        "name", (F.col("i") / 100.0).alias("mean"), (1 + F.col("i") / 10.0).alias("std")
    )
    scaled = joins.normalize_by_descriptor(values, declared)
    return scaled.select("vec_id", "name", F.round("v", 6).alias("v"))


@query(
    "jn7_vocabulary_lookup",
    f"""with w as (select doc_id, i as ix, t[i + 1] as token from
      (select doc_id, t, unnest(range(len(t))) as i from (select doc_id, {sql_tokens('text')} as t from documents))),
    v as (select token, row_number() over (order by count(*) desc, min({{'a': doc_id, 'b': ix}})) as id
          from w group by token order by id limit 299)
    select doc_id, sum(coalesce(id, 0))::bigint as id_sum, count(*) - count(id) as unknown,
           count(*) as n_tokens from w left join v using (token) group by doc_id""",
)
def vocabulary_lookup(spark, folder):
    words = words_of(table(spark, folder, "documents"), "text", ["doc_id"])
    vocab = vocabulary(words, ["doc_id"], 300)
    return token_ids(words.select("doc_id", F.explode("words").alias("token")), vocab).groupBy("doc_id").agg(
        F.sum("id").alias("id_sum"),
        F.count_if(F.col("id") == 0).alias("unknown"),
        F.count(F.lit(1)).alias("n_tokens"),
    )


@query(
    "jn8_compare_scores",
    """with s as (select source, round(avg(quality), 9) as score from documents join labels using (doc_id)
                  where lang <> 'de' group by source),
    b as (select source, round(avg(toxic), 9) as score from documents join labels using (doc_id)
          where lang = 'de' group by source)
    select source, s.score as subject_score, b.score as baseline_score, round(s.score - b.score, 6) as delta
    from s full join b using (source)""",
)
def compare_scores(spark, folder):
    rows = table(spark, folder, "documents").join(table(spark, folder, "labels"), "doc_id")

    def score(where, column):
        return rows.filter(where).groupBy("source").agg(F.round(F.avg(column), 9).alias("score"))

    out = catalog.compare_scores(score("lang <> 'de'", "quality"), score("lang = 'de'", "toxic"), ["source"])
    return out.withColumn("delta", F.round("delta", 6))
