"""Source / sink round trips (SRC-1..12, SNK-1..12).

Each query writes a table that Spark derives from the given data, in the
reference's on-disk layout, below the shared checkpoint folder, and reads it
back with the schema-first reader; the oracle is the SQL of the view.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from cinerank.functions.scalar import r6
from cinerank.operators import knn
from cinerank.plans import q_binary, q_cf, q_content, q_prep
from cinerank.plans.oracle_views import with_views
from cinerank.plans.registry import query
from cinerank.session import scratch_path
from cinerank.sources import io, views

_EPOCH = "cast(epoch(ts) as bigint)"


def _epoch(c="ts"):
    return F.col(c).cast("timestamp").cast("long")


def _ratings_text(spark, sf_dir, sep):
    r = views.ratings(spark, sf_dir).select("user_id", "item_id", "score", _epoch().alias("ts"))
    path = scratch_path(spark, "ratings_text")
    io.write_delimited(r, path, sep=sep)
    return path


@query("src1_ratings_tsv", with_views("ratings") + f"select user_id, item_id, score, {_EPOCH} as ts from ratings")
def src1_ratings_tsv(spark, sf_dir):
    """SRC-1 / SNK-9 / SCL-1: tab-separated headerless ratings, split and cast by an explicit schema."""
    return io.read_ratings(spark, _ratings_text(spark, sf_dir, "\t"), "\t")


@query("src1_ratings_csv", with_views("ratings") + f"select user_id, item_id, score, {_EPOCH} as ts from ratings")
def src1_ratings_csv(spark, sf_dir):
    """SRC-1: the comma-separated layout."""
    return io.read_ratings(spark, _ratings_text(spark, sf_dir, ","), ",")


@query("src2_ratings_double_colon", with_views("ratings")
       + f"select user_id, item_id, score, {_EPOCH} as ts from ratings")
def src2_ratings_double_colon(spark, sf_dir):
    """SRC-2: '::'-separated ratings."""
    return io.read_ratings(spark, _ratings_text(spark, sf_dir, "::"), "::")


@query("src3_tags_csv", with_views("tags") + "select user_id, item_id, tag from tags")
def src3_tags_csv(spark, sf_dir):
    """SRC-3: tags csv with header in ISO-8859-1, quoted fields."""
    t = views.tags(spark, sf_dir).select("user_id", "item_id", "tag", F.lit(0).cast("long").alias("ts"))
    path = scratch_path(spark, "tags_csv")
    t.write.mode("overwrite").option("header", True).option("encoding", "ISO-8859-1").option("escape", '"').csv(path)
    return io.read_tags(spark, path).select("user_id", "item_id", "tag")


@query("src4_movies_csv", with_views("movies", extra=[
    ("g", "select item_id, trim(x) as genre from movies, unnest(string_split(genres, '|')) as t(x)")])
       + "select item_id, genre from g")
def src4_movies_csv(spark, sf_dir):
    """SRC-4 / PRJ-8: movies csv (title may hold commas), genres split and trimmed."""
    m = views.movies(spark, sf_dir).select("item_id", F.concat("title", F.lit(", The")).alias("title"), "genres")
    path = scratch_path(spark, "movies_csv")
    m.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    r = io.read_movies(spark, path)
    return r.select("item_id", F.explode("genre_list").alias("genre"))


META = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("title", T.StringType()),
                     T.StructField("year", T.StringType()), T.StructField("country", T.StringType())])


@query("src5_metadata_tsv", with_views("movies") + "select item_id, title, year, country from movies")
def src5_metadata_tsv(spark, sf_dir):
    """SRC-5 / SNK-10: metadata TSV with header, PERMISSIVE parse and reject count."""
    m = views.movies(spark, sf_dir).select("item_id", "title", "year", "country")
    path = scratch_path(spark, "metadata_tsv")
    io.write_delimited(m, path, sep="\t", header=True)
    good, _ = io.read_metadata(spark, path, META)
    return good


@query("src6_folksonomy_ragged", q_prep._folk_sql() + "select item_id, tag from surviving "
       "where item_id in (select item_id from kept)")
def src6_folksonomy_ragged(spark, sf_dir):
    """SRC-6 / SNK-6 / SCL-9: ragged 'item<TAB>tag...' rows (concat_ws / array_join) written in
    bounded chunks, read back to long form."""
    f = q_prep.build_folksonomy(spark, sf_dir)
    path = scratch_path(spark, "folksonomy")
    io.write_ragged(f.item_tags.select("item_id", "user_id", "tag"), path, chunk=8)
    return io.read_ragged(spark, path)


@query("src7_active_users_list", q_prep._folk_sql() + "select user_id from active")
def src7_active_users_list(spark, sf_dir):
    """SRC-7 / SNK-6: one id per line."""
    f = q_prep.build_folksonomy(spark, sf_dir)
    path = scratch_path(spark, "active_users")
    io.write_list(f.active_users, path, "user_id")
    return io.read_list(spark, path, "user_id")


@query("src8_users_pipe", with_views("users") + "select user_id, age, gender, occupation, "
       "cast(user_id * 13 % 100000 as varchar) as zip from users")
def src8_users_pipe(spark, sf_dir):
    """SRC-8: 'id|age|gender|occupation|zip' demographics."""
    u = views.users(spark, sf_dir).withColumn(
        "zip", F.pmod(F.col("user_id") * 13, F.lit(100000)).cast("string"))
    path = scratch_path(spark, "users_pipe")
    io.write_delimited(u, path, sep="|")
    return io.read_users(spark, path)


@query("src9_links_csv", "select p_partkey as item_id, lpad(cast(p_partkey as varchar), 7, '0') as imdb_id, "
       "cast(p_partkey + 1000 as varchar) as tmdb_id from part")
def src9_links_csv(spark, sf_dir):
    """SRC-9 / FLT-2: links csv; imdb ids keep their leading zeros."""
    p = views.table(spark, sf_dir, "part")
    links = p.select(F.col("p_partkey").alias("item_id"),
                     F.lpad(F.col("p_partkey").cast("string"), 7, "0").alias("imdb_id"),
                     (F.col("p_partkey") + 1000).cast("string").alias("tmdb_id"))
    path = scratch_path(spark, "links_csv")
    links.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    from cinerank.operators.prep import skip_empty_key
    return skip_empty_key(io.read_links(spark, path), "imdb_id")


@query("src10_json_documents", "select event_id, cast(json_extract(props, '$.k') as integer) as k from events")
def src10_json_documents(spark, sf_dir):
    """SRC-10: JSON documents, one per line, read with an explicit schema."""
    ev = views.table(spark, sf_dir, "events")
    docs = ev.select("event_id", F.from_json("props", q_prep.PROPS_SCHEMA).alias("j")).select("event_id", "j.*")
    path = scratch_path(spark, "json_docs")
    io.write_json_docs(docs, path)
    return io.read_json_docs(spark, path, q_prep.PROPS_SCHEMA)


@query("src11_binary_tsv", with_views("ratings_binary")
       + f"select user_id, item_id, label, {_EPOCH} as ts from ratings_binary")
def src11_binary_tsv(spark, sf_dir):
    """SRC-11 / SNK-5: binarised ratings as TSV, label read as int."""
    b = views.ratings_binary(spark, sf_dir).withColumn("ts", _epoch())
    path = scratch_path(spark, "binary_tsv")
    io.write_delimited(b, path)
    return io.read_ratings(spark, path, binary=True)


@query("src12_item_profiles_parquet", q_content._content_sql() + "select item_id, idx, weight from iprof")
def src12_item_profiles_parquet(spark, sf_dir):
    """SRC-12 / SNK-8: profile triples stored range-clustered by row id, read back."""
    _, iprof, _ = q_content.content_tables(spark, sf_dir)
    path = scratch_path(spark, "profiles")
    io.write_profiles(iprof, path, "item_id")
    return io.read_profiles(spark, path)


@query("snk1_predictions_tsv", q_cf.cf_sql("item", "pears", only=1, cells_k=20))
def snk1_predictions_tsv(spark, sf_dir):
    """SNK-1 / PRJ-2: fold-1 item-item predictions for the largest k, as TSV."""
    p = q_cf.fold1_predictions(spark, sf_dir)
    path = scratch_path(spark, "predictions")
    io.write_delimited(p, path)
    schema = T.StructType([T.StructField("user_id", T.LongType()), T.StructField("item_id", T.LongType()),
                           T.StructField("pred", T.DoubleType())])
    return spark.read.schema(schema).option("sep", "\t").csv(path)


@query("snk2_eval_table", q_cf.cf_sql("item", "pears", only=1))
def snk2_eval_table(spark, sf_dir):
    """SNK-2: evaluation table with header (fold, k, rmse, mae, sqrt_mae, n)."""
    m = q_cf.job2_item_item_pears_fold1(spark, sf_dir)
    path = scratch_path(spark, "eval")
    io.write_delimited(m, path, header=True)
    schema = "fold int, k int, rmse double, mae double, sqrt_mae double, n bigint"
    return spark.read.schema(schema).option("sep", "\t").option("header", True).csv(path)


@query("snk3_content_predictions", q_content._content_sql(*q_content._CB_CTES)
       + "select user_id, item_id, round(cos, 6) + 0.0 as pred_raw, round(pred, 6) + 0.0 as pred "
         "from scored where fold = 1")
def snk3_content_predictions(spark, sf_dir):
    """SNK-3 / PRJ-3: raw and rescaled content scores of fold 1, one file."""
    s = q_content._cb_scores(spark, sf_dir, only=1)
    out = s.select("user_id", "item_id", r6("pred_raw").alias("pred_raw"), r6("pred").alias("pred"))
    path = scratch_path(spark, "cb_predictions")
    io.write_delimited(out, path)
    schema = "user_id bigint, item_id bigint, pred_raw double, pred double"
    return spark.read.schema(schema).option("sep", "\t").csv(path)


@query("snk4_fold_files", with_views("folds") + "select user_id, item_id, score, fold from folds")
def snk4_fold_files(spark, sf_dir):
    """SNK-4: folds written as one directory per fold and read back (fold from the path)."""
    f = views.folds(spark, sf_dir).select("user_id", "item_id", "score", "fold")
    path = scratch_path(spark, "folds")
    io.write_folds(f, path)
    return spark.read.parquet(path).select("user_id", "item_id", "score", F.col("fold").cast("int"))


@query("snk7_vocabulary_files", q_content._content_sql() + "select kind, value, idx from vocab")
def snk7_vocabulary_files(spark, sf_dir):
    """SNK-7: vocabulary (kind, value, idx) stored and reloaded."""
    voc, _, _ = q_content.content_tables(spark, sf_dir)
    path = scratch_path(spark, "vocab")
    voc.select("kind", "value", "idx").write.mode("overwrite").partitionBy("kind").parquet(path)
    return spark.read.parquet(path).select("kind", "value", "idx")


@query("snk11_like_dislike_tsv", with_views("folds", extra=q_binary._LD_CTES + [
    ("agg", "select user_id, item_id, avg(lv * sim) as pred from s2 group by 1, 2")])
       + "select round(coalesce(cast(agg.pred as double), 0.0), 6) + 0.0 as pred, te.label from test te "
         "left join agg on agg.user_id = te.user_id and agg.item_id = te.item_id")
def snk11_like_dislike_tsv(spark, sf_dir):
    """SNK-11: 'pred<TAB>label' lines of the like/dislike scorer (fold 1)."""
    s = q_binary.job8_like_dislike_fold1(spark, sf_dir).select("pred", "label")
    path = scratch_path(spark, "ld_pred")
    io.write_delimited(s, path)
    return spark.read.schema("pred double, label int").option("sep", "\t").csv(path)


@query("flt1_reader_skips_bad_lines", with_views("ratings")
       + f"select user_id, item_id, score, {_EPOCH} as ts from ratings")
def flt1_reader_skips_bad_lines(spark, sf_dir):
    """FLT-1 / SCL-1: the ratings folder also holds every document's text as
    lines; the PERMISSIVE reader turns them into null keys, which are dropped."""
    path = _ratings_text(spark, sf_dir, "\t")
    views.table(spark, sf_dir, "documents").select("text").write.mode("append").text(path)
    return io.read_ratings(spark, path, "\t")


@query("flt1_reject_count", "select count(*) as rejects from (select unnest(string_split(text, chr(10))) as line "
       "from documents) t where trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) <> ''")
def flt1_reject_count(spark, sf_dir):
    """FLT-1: how many lines the reader rejects when the ratings folder also holds every document's lines."""
    path = _ratings_text(spark, sf_dir, "\t")
    views.table(spark, sf_dir, "documents").select("text").write.mode("append").text(path)
    return io.count_rejects(spark, path, "\t")


@query("stream_item_running_means", with_views("ratings")
       + "select item_id, round(avg(score), 6) + 0.0 as mean, count(*) as n from ratings group by item_id")
def stream_item_running_means(spark, sf_dir):
    """AGG-3 maintained by Structured Streaming over SRC-1 rating files (the
    whole ratings table written as text, consumed with an availableNow trigger)."""
    import uuid

    from cinerank.streaming.ratings import start_running_means
    path = _ratings_text(spark, sf_dir, "\t")
    table = f"running_means_{uuid.uuid4().hex[:8]}"
    q, out = start_running_means(spark, path, key="item_id", table=table)
    q.awaitTermination()
    return spark.read.parquet(out).select("item_id", r6("mean").alias("mean"), "n")
