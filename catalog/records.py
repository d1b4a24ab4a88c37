"""Deduplication, state, API, record, log and stream queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalog.registry import query, sql_chunks, table
from catalog.text import CHUNK_ROWS_SQL, PAGE_ENTRIES_SQL, PROMPT_SQL
from quillspark.functions import text as T
from quillspark.operators import firstwins, progress, records
from quillspark.operators.ordering import limit_first
from quillspark.runtime import scratch_path
from quillspark.sources import state
from quillspark.sources.api import explode_docs
from quillspark.sources.tables import read_records, require, union_sources
from quillspark.streaming.ingest import (
    first_of_visits,
    generation_folders,
    reset_ingest,
    retry_failed,
    start_ingest,
    stream_unseen,
)
from quillspark.streaming.progress import start_progress
from quillspark.streaming.training import start_training


@query(
    "dedup_first",
    """WITH r AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents)
    SELECT sha256(text) AS digest, doc_id, lang, source, n_chars FROM r WHERE k = 1""",
)
def dedup_first(spark, sf_dir):
    """Copies are matched by a digest, so texts are not shuffled."""
    narrow = table(spark, sf_dir, "documents").select(
        F.sha2("text", 256).alias("digest"), "doc_id", "lang", "source", "n_chars"
    )
    return firstwins.dedup_first(narrow, ["digest"], ["doc_id"])


_SEARCH_SQL = """WITH q AS (
    SELECT 1 AS query_pos, 'economy' AS query, * FROM part WHERE p_type = 'ECONOMY'
    UNION ALL SELECT 2, 'brand', * FROM part WHERE p_brand IN ('Brand#2', 'Brand#4', 'Brand#17')
    UNION ALL SELECT 3, 'large', * FROM part WHERE p_size > 25
    UNION ALL SELECT 4, 'ring', * FROM part WHERE contains(p_name, 'ring')),
  r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY query_pos) AS k FROM q),
  s AS (SELECT query, count(*)::BIGINT AS total_found, count(*) FILTER (WHERE k = 1)::BIGINT AS new_repos
    FROM r GROUP BY query)"""


def _search(spark, sf_dir):
    """Four overlapping searches over parts, in one scan."""
    hits = F.filter(
        F.array(
            F.when(F.col("p_type") == "ECONOMY", F.struct(F.lit(1).alias("query_pos"), F.lit("economy").alias("query"))),
            F.when(
                F.col("p_brand").isin("Brand#2", "Brand#4", "Brand#17"),
                F.struct(F.lit(2).alias("query_pos"), F.lit("brand").alias("query")),
            ),
            F.when(F.col("p_size") > 25, F.struct(F.lit(3).alias("query_pos"), F.lit("large").alias("query"))),
            F.when(
                F.contains("p_name", F.lit("ring")),
                F.struct(F.lit(4).alias("query_pos"), F.lit("ring").alias("query")),
            ),
        ),
        lambda x: x.isNotNull(),
    )
    return table(spark, sf_dir, "part").select(
        F.explode(hits).alias("_q"), F.col("p_partkey").alias("id"), "p_name", "p_size",
        F.floor(F.col("p_partkey") / 100).alias("page"), (F.col("p_partkey") % 100).alias("rank"),
    ).select("_q.*", "id", "p_name", "p_size", "page", "rank")


@query("search_query_stats", f"{_SEARCH_SQL} SELECT query, total_found, new_repos FROM s")
def search_query_stats(spark, sf_dir):
    return firstwins.query_stats(_search(spark, sf_dir))


@query(
    "search_totals",
    f"""{_SEARCH_SQL}, t AS (SELECT sum(total_found)::BIGINT AS f, sum(new_repos)::BIGINT AS u FROM s)
    SELECT '2001-02-03' AS timestamp, (SELECT count(*) FROM s)::BIGINT AS queries, f AS total_found,
      u AS unique_repos, printf('%d/%d (%.1f%%)', u, f, u::DOUBLE / f * 100) AS deduplication_ratio FROM t""",
)
def search_totals(spark, sf_dir):
    stats = firstwins.search_stats(
        firstwins.query_stats(_search(spark, sf_dir)), timestamp="2001-02-03"
    )
    return stats.withColumn("queries", F.size("queries").cast("bigint"))


@query(
    "first_query_attribution",
    f"{_SEARCH_SQL} SELECT p_partkey AS id, query, p_name FROM r WHERE k = 1",
)
def first_query_attribution(spark, sf_dir):
    return firstwins.first_by_query(_search(spark, sf_dir)).select("id", "query", "p_name")


@query(
    "repo_manifest",
    """SELECT 'o/' || p_name || '-' || p_partkey AS name,
      CASE WHEN p_partkey % 5 = 0 THEN 'No description' ELSE p_type END AS description,
      'https://h/' || p_partkey AS clone_url, p_size::BIGINT AS stars, 0::BIGINT AS forks,
      CASE WHEN p_size > 40 THEN 'Unknown' ELSE p_brand END AS language, '' AS created_at, '' AS updated_at,
      p_partkey AS size, p_type AS topics, CASE WHEN p_partkey % 7 = 0 THEN 'No license' ELSE p_brand END AS license,
      false AS archived, false AS private FROM part""",
)
def repo_manifest(spark, sf_dir):
    k = F.col("p_partkey")
    repos = table(spark, sf_dir, "part").select(
        F.concat(F.lit("o/"), "p_name", F.lit("-"), k.cast("string")).alias("full_name"),
        F.when(k % 5 != 0, F.col("p_type")).alias("description"),
        F.concat(F.lit("https://h/"), k.cast("string")).alias("clone_url"),
        F.col("p_size").alias("stargazers_count"),
        F.when(F.col("p_size") <= 40, F.col("p_brand")).alias("language"),
        k.alias("size"),
        F.array("p_type").alias("topics"),
        F.when(k % 7 != 0, F.struct(F.col("p_brand").alias("name"))).alias("license"),
    )
    manifest = records.by_stars(records.repo_manifest(repos))
    return manifest.withColumn("topics", F.array_join("topics", "|"))


def _doc_ids(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "lang")
    return docs, table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))


@query("unseen", "SELECT doc_id AS id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def unseen(spark, sf_dir):
    return firstwins.unseen(*_doc_ids(spark, sf_dir), "id", ["lang"])


@query("seen_only", "SELECT doc_id AS id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def seen_only(spark, sf_dir):
    return firstwins.seen_only(*_doc_ids(spark, sf_dir))


@query("seen_state", "SELECT DISTINCT doc_id::VARCHAR AS id FROM labels")
def seen_state(spark, sf_dir):
    """Save twice, load once: the state is a set."""
    path = scratch_path(spark, "seen")
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"))
    state.save_seen(ids, path)
    state.save_seen(ids, path)
    return state.load_seen(spark, path)


@query(
    "field_cascade",
    """SELECT o_orderkey, coalesce(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus END,
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority END, 'none') AS first_field,
      trim(CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE '' END || ' ' ||
        CASE WHEN o_orderkey % 3 = 0 THEN o_orderpriority ELSE '' END) AS all_fields
    FROM orders""",
)
def field_cascade(spark, sf_dir):
    a = F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderstatus")).otherwise("")
    b = F.when(F.col("o_orderkey") % 3 == 0, F.col("o_orderpriority"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.coalesce(T.first_non_empty(a, b), F.lit("none")).alias("first_field"),
        T.concat_fields(a, b).alias("all_fields"),
    )


@query(
    "string_or_list",
    """SELECT event_id, CASE event_id % 3 WHEN 0 THEN event_type WHEN 1 THEN event_type || '|7' ELSE '' END
      AS subject, json_extract_string(props, '$.k')::BIGINT AS k FROM events""",
)
def string_or_list(spark, sf_dir):
    kind = F.col("event_id") % 3
    subject = (
        F.when(kind == 0, F.format_string('"%s"', "event_type"))
        .when(kind == 1, F.format_string('["%s", 7]', "event_type"))
        .otherwise("7")
    )
    doc = F.parse_json(F.concat(F.lit('{"subject": '), subject, F.lit("}")))
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.array_join(records.as_string_array(doc, "$.subject"), "|").alias("subject"),
        F.try_variant_get(F.try_parse_json("props"), "$.k", "bigint").alias("k"),
    )


@query(
    "recordings",
    """SELECT c_custkey::VARCHAR AS identifier, c_name AS title,
      CASE WHEN c_custkey % 2 = 0 THEN '1977' ELSE c_mktsegment END AS date, c_mktsegment AS venue,
      'a b c' AS setlist, 'about ' || c_name AS description, 'x|7' AS subject, c_name AS creator, '' AS source
    FROM customer""",
)
def recordings(spark, sf_dir):
    year = F.when(F.col("c_custkey") % 2 == 0, '"year": 1977, ').otherwise("")
    doc = F.concat(
        F.lit('{"title": "'), F.col("c_name"), F.lit('", "date": "", '), year,
        F.lit('"coverage": "'), F.col("c_mktsegment"),
        F.lit('", "notes": ["a", "b"], "lineage": "<b>c</b>", "subject": ["x", 7], "description": "<p>about</p>'),
        F.col("c_name"), F.lit('", "creator": "'), F.col("c_name"), F.lit('"}'),
    )
    items = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("identifier"), F.parse_json(doc).alias("metadata")
    )
    return records.extract_recording(items).select(
        "identifier", "title", "date", "venue", "setlist", "description",
        F.array_join("subject", "|").alias("subject"), "creator", "source",
    )


@query(
    "recordings_old",
    """SELECT c_custkey::VARCHAR AS identifier, c_name AS title, 'a b' AS setlist,
      c_custkey AS downloads, 0.0::DOUBLE AS avg_rating, 'm' AS mediatype, NULL::VARCHAR AS error FROM customer""",
)
def recordings_old(spark, sf_dir):
    doc = F.concat(
        F.lit('{"title": "'), F.col("c_name"),
        F.lit('", "tracklist": ["a", "b"], "lineage": "c", "mediatype": "m", "downloads": '),
        F.col("c_custkey").cast("string"), F.lit("}"),
    )
    items = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("identifier"), F.parse_json(doc).alias("metadata")
    )
    return records.extract_recording_old(items).select(
        "identifier", "title", "setlist", "downloads", "avg_rating", "mediatype", "error"
    )


@query(
    "recordings_old_lists",
    """SELECT o_custkey::VARCHAR AS identifier,
      string_agg('No ' || o_orderkey || ' & ' || trim(o_orderpriority), '|' ORDER BY o_orderkey) AS setlist,
      count(*)::INT AS n, 'at ' || o_custkey AS description
    FROM orders GROUP BY o_custkey""",
)
def recordings_old_lists(spark, sf_dir):
    """Recordings whose track lists hold markup in every element, cleaned one by one."""
    track = F.concat(
        F.lit(" <b>No "), F.col("o_orderkey").cast("string"), F.lit("</b> &amp; <i>"),
        F.trim("o_orderpriority"), F.lit("</i>\n"),
    )
    tracks = F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", track.alias("t")))), lambda x: x["t"])
    doc = F.to_json(F.struct(
        tracks.alias("tracklist"), F.concat(F.lit("<p>at "), F.col("o_custkey").cast("string")).alias("description")))
    items = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(doc.alias("doc")).select(
        F.col("o_custkey").cast("string").alias("identifier"), F.parse_json("doc").alias("metadata")
    )
    return records.extract_recording_old(items, lists=True).select(
        "identifier", F.array_join("setlist", "|").alias("setlist"), F.size("setlist").alias("n"),
        F.get("description", F.lit(0)).alias("description"),
    )


@query(
    "api_pages",
    """SELECT floor(o_orderkey / 100)::BIGINT AS page, (o_orderkey % 100)::INT AS rank,
      o_orderkey AS identifier, o_orderpriority AS title
    FROM orders WHERE o_orderstatus = 'F'""",
)
def api_pages(spark, sf_dir):
    """Orders nested a hundred to a response page, then exploded with pruning and a filter."""
    doc = F.struct(
        F.col("o_orderkey").alias("identifier"), F.col("o_orderpriority").alias("title"),
        F.col("o_orderstatus").alias("collection"), F.col("o_totalprice").alias("price"),
    )
    responses = table(spark, sf_dir, "orders").groupBy(
        F.floor(F.col("o_orderkey") / 100).alias("page")
    ).agg(F.struct(F.array_sort(F.collect_list(doc)).alias("docs")).alias("response"))
    return explode_docs(
        responses, columns=["identifier", "title", "collection"],
        where=F.col("collection") == "F", order=["identifier"], keep=["page"],
    ).drop("collection")


@query(
    "listing_limit",
    "SELECT page_id, url FROM (SELECT page_id, url FROM pages UNION ALL SELECT page_id, url FROM pages) ORDER BY page_id, url LIMIT 25",
)
def listing_limit(spark, sf_dir):
    p = table(spark, sf_dir, "pages").select("page_id", "url")
    return limit_first(union_sources(p, p), 25, "page_id", "url")


_TITLES_SQL = """SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0
    THEN 'Live at ' || o_orderpriority || ' on ' || o_orderdate::DATE
    ELSE o_orderpriority || CASE WHEN o_orderkey % 3 = 1 THEN ' ' || o_orderdate::DATE ELSE '' END END AS title,
    o_orderpriority AS p, (o_orderdate::DATE)::VARCHAR AS d FROM orders"""


def _titles(spark, sf_dir):
    p, d = F.col("o_orderpriority"), F.date_format("o_orderdate", "yyyy-MM-dd")
    kind = F.col("o_orderkey") % 3
    title = (
        F.when(kind == 0, F.concat(F.lit("Live at "), p, F.lit(" on "), d))
        .when(kind == 1, F.concat(p, F.lit(" "), d))
        .otherwise(p)
    )
    return table(spark, sf_dir, "orders").select("o_orderkey", title.alias("title"))


@query(
    "first_date",
    f"SELECT o_orderkey, CASE WHEN o_orderkey % 3 < 2 THEN d END AS date FROM ({_TITLES_SQL})",
)
def first_date(spark, sf_dir):
    return _titles(spark, sf_dir).select("o_orderkey", T.first_date(F.col("title")).alias("date"))


@query(
    "tags_append",
    f"""SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN p END AS venue,
      CASE WHEN o_orderkey % 3 = 0 THEN 'order|Venue: ' || p ELSE 'order' END AS tags FROM ({_TITLES_SQL})""",
)
def tags_append(spark, sf_dir):
    venue = T.venue_of(F.col("title"))
    tags = F.array(F.lit("order"))
    return _titles(spark, sf_dir).select(
        "o_orderkey",
        venue.alias("venue"),
        F.array_join(
            F.when(venue.isNotNull(), F.array_append(tags, F.concat(F.lit("Venue: "), venue)))
            .otherwise(tags), "|",
        ).alias("tags"),
    )


@query(
    "page_count",
    """SELECT o_orderkey, o_orderkey AS total, ((o_orderkey + 24) // 25)::BIGINT AS pages FROM orders""",
)
def page_count(spark, sf_dir):
    line = F.format_string("1–25 of %s results", F.format_number("o_orderkey", 0))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", T.result_total(line).alias("total"), T.page_count(line).alias("pages")
    )


@query(
    "status_counts",
    """SELECT CASE WHEN value < 1 THEN 'failed' WHEN event_type = 'view' THEN 'skipped' ELSE 'ok' END AS status,
      count(*)::BIGINT AS n FROM events GROUP BY 1""",
)
def status_counts(spark, sf_dir):
    status = (
        F.when(F.col("value") < 1, "failed").when(F.col("event_type") == "view", "skipped").otherwise("ok")
    )
    return firstwins.status_counts(table(spark, sf_dir, "events").withColumn("status", status))


@query(
    "split_errors",
    """SELECT '2001-02-03 04:05:06' AS ts, event_id::VARCHAR AS id, 'bad ' || event_type AS error,
      '2001-02-03 04:05:06 | ' || event_id || ' | bad ' || event_type AS line FROM events WHERE value < 1""",
)
def split_errors(spark, sf_dir):
    marked = table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        F.when(F.col("value") < 1, F.concat(F.lit("bad "), "event_type")).alias("error"),
    )
    _, failed = firstwins.split_errors(marked)
    return firstwins.dead_letters(failed, timestamp="2001-02-03 04:05:06")


@query("require_fields", "SELECT doc_id, lang FROM documents WHERE length(text) > 0 AND length(source) > 0")
def require_fields(spark, sf_dir):
    return require(table(spark, sf_dir, "documents"), "text", "source").select("doc_id", "lang")


# Log lines from events: one log per user, with noise lines in between.
_LOG_SQL = """SELECT event_id AS line_no, user_id AS job,
    CASE WHEN event_type = 'error' THEN 'noise ' || event_id
      ELSE floor(value)::BIGINT || '%|###  | ' || event_id || '/' || (event_id + 7) END AS value,
    CASE WHEN event_type <> 'error' THEN floor(value)::BIGINT END AS percent FROM events"""


def _log(events):
    line = F.format_string(
        "%d%%|###  | %d/%d", F.floor("value").cast("bigint"), F.col("event_id"), F.col("event_id") + 7
    )
    noise = F.format_string("noise %d", "event_id")
    return events.select(
        F.col("event_id").alias("line_no"), F.col("user_id").alias("job"),
        F.when(F.col("event_type") == "error", noise).otherwise(line).alias("value"),
    )


@query(
    "progress_parse",
    f"""SELECT line_no, job, percent, line_no AS current_step, line_no + 7 AS total_steps, percent >= 100 AS completed
    FROM ({_LOG_SQL}) WHERE percent IS NOT NULL""",
)
def progress_parse(spark, sf_dir):
    return progress.parse_progress(_log(table(spark, sf_dir, "events")))


_RISES_SQL = f"""WITH l AS (SELECT * FROM ({_LOG_SQL}) WHERE percent IS NOT NULL),
  m AS (SELECT *, coalesce(max(percent) OVER (PARTITION BY job ORDER BY line_no
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l)
  SELECT job, percent, line_no, line_no AS current_step, line_no + 7 AS total_steps, percent >= 100 AS completed
  FROM m WHERE percent > before AND before < 100"""


@query("progress_increases", _RISES_SQL)
def progress_increases(spark, sf_dir):
    return progress.progress_increases(
        progress.parse_progress(_log(table(spark, sf_dir, "events"))), ["job"]
    )


@query(
    "latest_progress",
    f"""WITH t AS (SELECT * FROM ({_LOG_SQL}) QUALIFY row_number() OVER (PARTITION BY job ORDER BY line_no DESC) <= 20)
    SELECT job, max(line_no) AS line_no, arg_max(percent, line_no) AS percent, max(line_no) AS current_step,
      max(line_no) + 7 AS total_steps, arg_max(percent, line_no) >= 100 AS completed
    FROM t WHERE percent IS NOT NULL GROUP BY job""",
)
def latest_progress(spark, sf_dir):
    recent = progress.tail_lines(_log(table(spark, sf_dir, "events")), 20, ["job"])
    return progress.latest_progress(progress.parse_progress(recent), ["job"])


@query("log_tail", f"SELECT line_no, job, value FROM ({_LOG_SQL}) ORDER BY line_no DESC LIMIT 20")
def log_tail(spark, sf_dir):
    return progress.tail_lines(_log(table(spark, sf_dir, "events")), 20)


# --- streams -----------------------------------------------------------------

def _stream(spark, sf_dir, name):
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}*.parquet")


def _drain(frame, path):
    """Run a stream over what is there and give back what it wrote."""
    query_ = (
        frame.writeStream.format("parquet")
        .option("path", f"{path}/out")
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return frame.sparkSession.read.schema(frame.schema).parquet(f"{path}/out")


@query("stream_unseen", "SELECT DISTINCT user_id AS id FROM events")
def stream_unseen_query(spark, sf_dir):
    ids = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("id"))
    return _drain(stream_unseen(ids), scratch_path(spark, "unseen"))


@query("stream_dedup_watermark", "SELECT DISTINCT user_id AS id FROM events")
def stream_dedup_watermark(spark, sf_dir):
    timed = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "ts")
    fresh = stream_unseen(timed, event_time="ts", watermark="3650 days")
    return _drain(fresh.select("id"), scratch_path(spark, "watermark"))


@query("stream_progress", _RISES_SQL)
def stream_progress(spark, sf_dir):
    path = scratch_path(spark, "progress")
    start_progress(
        _log(_stream(spark, sf_dir, "events")), f"{path}/out", f"{path}/checkpoint"
    ).awaitTermination()
    return spark.read.parquet(f"{path}/out").drop("run", "batch_id")


@query(
    "open_ranges",
    """WITH d AS (SELECT o_orderkey AS p FROM orders WHERE o_orderstatus = 'F' UNION SELECT 0
      UNION SELECT max(o_orderkey) + 11 FROM orders),
    g AS (SELECT lag(p) OVER (ORDER BY p) AS before, p FROM d)
    SELECT (before + 1)::BIGINT AS first, (p - 1)::BIGINT AS last FROM g WHERE p > before + 1""",
)
def open_ranges(spark, sf_dir):
    """Pages are order keys; those of finished orders are done."""
    orders = table(spark, sf_dir, "orders")
    last = orders.agg(F.max("o_orderkey")).first()[0] + 10
    return state.open_ranges(orders.where("o_orderstatus = 'F'"), last, "o_orderkey", block=1024)


def _in_parts(frame, order, parts, path, start):
    """Append ``frame`` in ``parts`` slices of ``order``; ``start`` runs its query again after each."""
    low, high = frame.agg(F.min(order), F.max(order)).first()
    slice_of = F.least(F.floor((F.col(order) - low) * parts / F.lit(max(high - low, 1))), F.lit(parts - 1))
    for k in range(parts):
        frame.filter(slice_of == k).write.mode("append").parquet(path)
        start().awaitTermination()


@query("stream_progress_restarted", _RISES_SQL)
def stream_progress_restarted(spark, sf_dir):
    """Three parts of the log, in order; the query is started anew for each and goes on from its state."""
    path, log = scratch_path(spark, "progress"), _log(table(spark, sf_dir, "events"))
    _in_parts(log, "line_no", 3, f"{path}/log", lambda: start_progress(
        spark.readStream.schema(log.schema).parquet(f"{path}/log"), f"{path}/out", f"{path}/checkpoint"))
    return spark.read.parquet(f"{path}/out").drop("run", "batch_id")


@query(
    "stream_watermark_expiry",
    """WITH s AS (SELECT user_id, ts, event_id, CASE WHEN ts - lag(ts) OVER w < INTERVAL 12 HOUR THEN 0 ELSE 1 END AS new
      FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
    v AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS visit FROM s)
    SELECT user_id AS id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_at,
      strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_at, count(*)::BIGINT AS n, arg_min(event_id, ts) AS event_id
    FROM v GROUP BY user_id, visit
    HAVING max(ts) + INTERVAL 12 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 1 DAY""",
)
def stream_watermark_expiry(spark, sf_dir):
    """Visits over four parts in time order, the last with old rows again, which come too late."""
    path = scratch_path(spark, "visits")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("id"), F.col("ts").cast("timestamp").alias("ts"), "event_id")
    rows = rows.withColumn("second", F.unix_seconds("ts"))
    late = rows.filter(F.col("second") < rows.agg(F.min("second") + 86400).first()[0])
    late = late.withColumn("second", F.lit(rows.agg(F.max("second")).first()[0]))

    def start():
        stream = spark.readStream.schema(rows.schema).parquet(f"{path}/rows")
        visits = first_of_visits(stream, "id", "ts", "12 hours", "1 day", ["event_id"])
        return (
            visits.writeStream.format("parquet").option("path", f"{path}/out")
            .option("checkpointLocation", f"{path}/checkpoint").trigger(availableNow=True).start())

    _in_parts(rows.union(late), "second", 4, f"{path}/rows", start)
    text = lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS").alias(c)
    return spark.read.parquet(f"{path}/out").select("id", text("first_at"), text("last_at"), "n", "event_id")


@query(
    "stream_training",
    rf"""WITH e AS ({PAGE_ENTRIES_SQL}),
    c AS (SELECT *, {sql_chunks('content')} AS chunks FROM e WHERE length(content) >= 100),
    r AS ({CHUNK_ROWS_SQL} FROM c)
    SELECT repo, path, part::INT AS part, parts::INT AS parts, {PROMPT_SQL} || chunk AS text FROM r""",
)
def stream_training(spark, sf_dir):
    path = scratch_path(spark, "training")
    start_training(_stream(spark, sf_dir, "pages"), f"{path}/out", f"{path}/checkpoint").awaitTermination()
    schema = "repo string, path string, part int, parts int, text string"
    return read_records(spark, f"{path}/out", schema)


@query(
    "stream_ingest",
    """WITH f AS (SELECT user_id AS id, arg_min(value, event_id) AS value, min(event_id) AS event_id
      FROM events GROUP BY user_id)
    SELECT id, value, event_id, CASE WHEN value < 10 THEN 'low' END AS error FROM f""",
)
def stream_ingest(spark, sf_dir):
    """Good rows and dead letters of a resumable ingest, put together."""
    path = scratch_path(spark, "ingest")
    arrivals = _stream(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "value", "event_id")
    start_ingest(
        arrivals,
        lambda b: b.withColumn("error", F.when(F.col("value") < 10, F.lit("low"))),
        path, f"{path}/checkpoint", order=["event_id"],
    ).awaitTermination()
    ok, failed = spark.read.parquet(f"{path}/records"), spark.read.parquet(f"{path}/errors")
    return union_sources(ok, failed).drop("run", "batch_id")


@query(
    "stream_ingest_reset",
    """SELECT user_id AS id, arg_min(value, event_id) AS value, min(event_id) AS event_id
    FROM events GROUP BY user_id""",
)
def stream_ingest_reset(spark, sf_dir):
    """The later half of the events, a reset, then all of them: nothing of the first run is left."""
    path = scratch_path(spark, "reset")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "value", "event_id")
    middle = rows.agg(F.median("event_id")).first()[0] or 0
    good = lambda batch: batch.withColumn("error", F.lit(None).cast("string"))
    for k, part in enumerate([rows.filter(F.col("event_id") >= middle), rows]):
        part.write.parquet(f"{path}/source{k}")
        data, mark = reset_ingest(spark, f"{path}/out") if k else generation_folders(spark, f"{path}/out")
        arrivals = spark.readStream.schema(rows.schema).parquet(f"{path}/source{k}")
        start_ingest(arrivals, good, data, mark, order=["event_id"]).awaitTermination()
    return spark.read.parquet(f"{data}/records").select("id", "value", "event_id")


@query(
    "stream_ingest_resumed",
    """WITH e AS (SELECT user_id AS id, value, event_id, event_id % 2 AS half FROM events),
    one AS (SELECT id, arg_min(value, event_id) AS value, min(event_id) AS event_id FROM e WHERE half = 0 GROUP BY id),
    two AS (SELECT id, arg_min(value, event_id) AS value, min(event_id) AS event_id FROM e
      WHERE half = 1 AND id NOT IN (SELECT id FROM one WHERE value >= 10) GROUP BY id),
    good AS (SELECT *, 1 AS k FROM one WHERE value >= 10 UNION ALL SELECT *, 2 FROM two WHERE value >= 10),
    bad AS (SELECT * FROM (SELECT * FROM one UNION ALL SELECT * FROM two) WHERE value < 10
      AND id NOT IN (SELECT id FROM good))
    SELECT id, value, event_id, false AS retried FROM good
    UNION ALL SELECT id, arg_min(value, event_id), min(event_id), true FROM bad GROUP BY id""",
)
def stream_ingest_resumed(spark, sf_dir):
    """Two halves of the events by two runs with checkpoints of their own, then a replay of what failed."""
    path = scratch_path(spark, "ingest")
    rows = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), "value", "event_id")

    def low(batch):
        return batch.withColumn("error", F.when(F.col("value") < 10, F.lit("low")))

    for half in (0, 1):
        source = f"{path}/source{half}"
        rows.filter(F.col("event_id") % 2 == half).write.parquet(source)
        arrivals = spark.readStream.schema(rows.schema).parquet(source)
        start_ingest(arrivals, low, f"{path}/out", f"{path}/checkpoint{half}", order=["event_id"]).awaitTermination()
    retry_failed(spark, lambda b: b.withColumn("error", F.lit(None).cast("string")), f"{path}/out", order=["event_id"])
    done = spark.read.parquet(f"{path}/out/records")
    return done.select("id", "value", "event_id", F.col("run").startswith("retry-").alias("retried"))
