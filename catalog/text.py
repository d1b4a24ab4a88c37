"""Text, file and corpus queries."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from catalog.registry import (
    FILES_SQL,
    documents,
    pages,
    query,
    sql_chunks,
    sql_clean,
    sql_strip,
    sql_text,
    sql_unescape,
    sql_visible,
    table,
)
from quillspark.functions import html
from quillspark.functions import text as T
from quillspark.operators import corpus, files, packing, training
from quillspark.plans.training import page_entries, pages_to_training
from quillspark.runtime import scratch_path
from quillspark.sources import text as text_source

PROMPT_SQL = """'The following is content from ' || path || ' in the ' || repo || ' repository'
    || CASE WHEN parts > 1 THEN ' (part ' || part || ' of ' || parts || ')' ELSE '' END
    || ':' || chr(10) || chr(10)"""
CHUNK_ROWS_SQL = """SELECT *, len(chunks) AS parts, unnest(chunks) AS chunk,
    unnest(range(1, len(chunks) + 1)) AS part"""

# Paragraphs by a list of tokens: each piece of text between two tags, and a break per block tag.
_BLOCK_NAMES = "|".join(html.BLOCKS)
_TOKENS = rf"""list_transform(regexp_extract_all({sql_visible("html")}, '<[a-zA-Z/!][^>]*>|[^<]+|<'),
    lambda t: CASE WHEN regexp_matches(t, '(?i)^</?({_BLOCK_NAMES})[\s/>]') THEN chr(2)
      WHEN regexp_matches(t, '^<[a-zA-Z/!]') THEN chr(1) ELSE t END)"""
PAGE_ENTRIES_SQL = rf"""
  SELECT page_id, regexp_extract(url, '^[^:]+://([^/?#]*)', 1) AS repo,
    regexp_extract(url, '^([^?#]*)', 1) AS path,
    {sql_clean(
        "array_to_string(list_filter(list_transform(string_split("
        + sql_unescape(f"array_to_string({_TOKENS}, '')")
        + r", chr(2)), lambda p: trim(regexp_replace(p, '[\s\x01]+', ' ', 'g'))), lambda p: p <> ''), chr(10) || chr(10))"
    )} AS content
  FROM pages"""


def doc_files(spark, sf_dir):
    """Documents as repository files, paragraphs separated by blank lines."""
    return documents(spark, sf_dir).select(
        "doc_id",
        F.col("source").alias("repo"),
        F.concat(
            F.lit("f/"), F.col("doc_id").cast("string"),
            F.when(F.col("doc_id") % 2 == 0, ".md").otherwise(".txt"),
        ).alias("path"),
        F.replace("text", F.lit("\n"), F.lit("\n\n")).alias("content"),
    )


@query(
    "entry_pages_to_training",
    rf"""WITH e AS ({PAGE_ENTRIES_SQL}),
    c AS (SELECT *, {sql_chunks('content')} AS chunks FROM e WHERE length(content) >= 100),
    r AS ({CHUNK_ROWS_SQL} FROM c)
    SELECT repo, path, part::INT AS part, parts::INT AS parts, {PROMPT_SQL} || chunk AS text
    FROM r""",
)
def entry_pages_to_training(spark, sf_dir):
    return pages_to_training(pages(spark, sf_dir))


@query(
    "clean_text",
    rf"SELECT doc_id, {sql_clean('''replace(text, '. ', chr(10) || '  ' || chr(10) || chr(10) || chr(9))''')} AS clean FROM documents",
)
def clean_text(spark, sf_dir):
    # Sentence ends become ragged blank lines, so that every rule has work to do.
    ragged = F.replace("text", F.lit(". "), F.lit("\n  \n\n\t"))
    return documents(spark, sf_dir).select("doc_id", T.clean_text(ragged).alias("clean"))


@query(
    "clean_markdown",
    rf"""WITH d AS (SELECT doc_id, '# T' || chr(10) || '[![b](x)](y)' || chr(10) || text
        || '<!-- n' || chr(10) || text || ' -->' || chr(10) || chr(10) || chr(10) || 'end  ' AS m
      FROM documents)
    SELECT doc_id, {sql_strip(
        "regexp_replace(regexp_replace(" + sql_clean("m")
        + r", '(?m)^\s*\[!\[.*?\]\(.*?\)\]\(.*?\)\s*$', '', 'g'), '(?s)<!--.*?-->', '', 'g')"
    )} AS clean FROM d""",
)
def clean_markdown(spark, sf_dir):
    noisy = F.concat(
        F.lit("# T\n[![b](x)](y)\n"), F.col("text"), F.lit("<!-- n\n"), F.col("text"),
        F.lit(" -->\n\n\nend  "),
    )
    return documents(spark, sf_dir).select("doc_id", T.clean_text(noisy, True).alias("clean"))


@query(
    "min_length_filter",
    "SELECT doc_id, length(text)::BIGINT AS n FROM documents WHERE length(text) >= 100",
)
def min_length_filter(spark, sf_dir):
    return (
        table(spark, sf_dir, "documents")
        .where(T.min_length(F.col("text"), 100))
        .select("doc_id", F.length("text").cast("bigint").alias("n"))
    )


_WORDS = ("show", "date", "the", "que")


@query(
    "keyword_relevance",
    f"""SELECT doc_id,
      {' OR '.join(f"contains(lower(text), '{w}')" for w in _WORDS)} AS anywhere,
      {' OR '.join(f"contains(lower(substr(text, 1, 40)), '{w}')" for w in _WORDS)} AS at_start,
      {' OR '.join(f"contains(lower(text), '{w}')" for w in T.RELEVANCE_KEYWORDS)} AS standard
    FROM documents""",
)
def keyword_relevance(spark, sf_dir):
    c = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        T.keyword_relevant(c, _WORDS).alias("anywhere"),
        T.keyword_relevant(c, _WORDS, 40).alias("at_start"),
        T.keyword_relevant(c).alias("standard"),
    )


@query(
    "word_counts",
    r"""SELECT doc_id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT
      AS words FROM documents""",
)
def word_counts(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", T.word_count(F.col("text")).alias("words")
    )


_NAMES = (
    "a.md", "b.TXT", "c.csv", "d.PNG", "LICENSE.md", ".gitignore", "sub/e.json", ".git/f.yml",
    "requirements.txt", "g.tar.gz", "noext",
)
_NAME_SQL = f"[{', '.join(repr(n) for n in _NAMES)}][doc_id % {len(_NAMES)} + 1]"


@query(
    "file_filter",
    f"""WITH f AS (SELECT doc_id, CASE WHEN lang = 'en' THEN '.' ELSE '' END || source AS repo,
        doc_id || '/' || {_NAME_SQL} AS path FROM documents)
    SELECT doc_id, repo, path FROM f
    WHERE lower(regexp_extract(path, '[^/](\\.[^./]+)$', 1))
        IN ('.md', '.txt', '.csv', '.json', '.yaml', '.yml')
      AND lower(regexp_extract(path, '([^/]*)$', 1)) NOT IN ('license.md', 'requirements.txt')
      AND repo NOT LIKE '.%' AND path NOT LIKE '%/.git/%'""".replace("\\\\", "\\"),
)
def file_filter(spark, sf_dir):
    names = F.array(*(F.lit(n) for n in _NAMES))
    named = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.concat(F.when(F.col("lang") == "en", ".").otherwise(""), "source").alias("repo"),
        F.concat(
            F.col("doc_id").cast("string"), F.lit("/"),
            F.element_at(names, (F.col("doc_id") % len(_NAMES) + 1).cast("int")),
        ).alias("path"),
    )
    return files.filter_files(named)


_OK_FILES_SQL = rf"""SELECT repo, path, clean AS content FROM (
    SELECT repo, path, {sql_clean('content')} AS clean FROM ({FILES_SQL})) WHERE length(clean) >= 50"""


@query(
    "corpus_entries",
    f"""SELECT repo, path, '[' || repo || '] :: [' || path || ']' || chr(10) || content || chr(10)
      AS entry FROM ({_OK_FILES_SQL})""",
)
def corpus_entries(spark, sf_dir):
    ok = files.corpus_files(files.extract_files(doc_files(spark, sf_dir), structured=False))
    return ok.select(
        "repo", "path",
        corpus.format_entry(F.col("repo"), F.col("path"), F.col("content")).alias("entry"),
    )


@query(
    "corpus_split_roundtrip",
    f"SELECT repo, path, content FROM ({_OK_FILES_SQL}) WHERE length(content) >= 100",
)
def corpus_split_roundtrip(spark, sf_dir):
    """Write the text corpus, read it back in splits, cut at headers and parse."""
    ok = files.corpus_files(files.extract_files(doc_files(spark, sf_dir), structured=False))
    path = scratch_path(spark, "corpus")
    text_source.write_corpus_text(ok, path)
    entries = text_source.read_corpus_text(spark, path)
    return corpus.parse_entries(entries.select("entry"))


@query(
    "chunk_documents",
    rf"""WITH c AS (SELECT doc_id, {sql_chunks('content')} AS chunks FROM ({FILES_SQL})),
    r AS ({CHUNK_ROWS_SQL} FROM c)
    SELECT doc_id, part::BIGINT AS part, parts::BIGINT AS parts, chunk FROM r""",
)
def chunk_documents(spark, sf_dir):
    def counted(chunks):
        return F.transform(
            chunks, lambda x: F.struct(F.size(chunks).cast("bigint").alias("parts"), x.alias("chunk"))
        )

    rows = T.let(T.chunk_text(F.col("content")), counted)
    return doc_files(spark, sf_dir).select(
        "doc_id", F.posexplode(rows).alias("_i", "_r")
    ).select("doc_id", (F.col("_i") + 1).cast("bigint").alias("part"), "_r.parts", "_r.chunk")


@query(
    "chunk_pages",
    rf"""WITH e AS ({PAGE_ENTRIES_SQL}),
    c AS (SELECT page_id, {sql_chunks('content', 400)} AS chunks FROM e)
    SELECT page_id, len(chunks)::BIGINT AS parts, coalesce(list_sum(list_transform(chunks, lambda c: length(c))), 0)::BIGINT
      AS chars, md5(array_to_string(chunks, '|')) AS digest FROM c""",
)
def chunk_pages(spark, sf_dir):
    entries = page_entries(pages(spark, sf_dir), "page_id")
    return entries.select(
        "page_id", T.chunk_text(F.col("content"), 400).alias("_c")
    ).select(
        "page_id",
        F.size("_c").cast("bigint").alias("parts"),
        F.aggregate("_c", F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("chars"),
        F.md5(F.array_join("_c", "|")).alias("digest"),
    )


@query(
    "training_examples",
    rf"""WITH c AS (SELECT *, {sql_chunks('content')} AS chunks FROM ({_OK_FILES_SQL})
      WHERE length(content) >= 100),
    r AS ({CHUNK_ROWS_SQL} FROM c)
    SELECT {PROMPT_SQL} || chunk AS text FROM r""",
)
def training_examples(spark, sf_dir):
    ok = files.corpus_files(files.extract_files(doc_files(spark, sf_dir), structured=False))
    return training.to_training(ok).select("text")


@query(
    "conversion_stats",
    rf"""WITH c AS (SELECT *, CASE WHEN length(content) >= 100 THEN len({sql_chunks('content')}) ELSE 0 END AS n
      FROM ({_OK_FILES_SQL}))
    SELECT count(*)::BIGINT AS total_entries, sum(n)::BIGINT AS processed_entries FROM c""",
)
def conversion_stats(spark, sf_dir):
    ok = files.corpus_files(files.extract_files(doc_files(spark, sf_dir), structured=False))
    return training.conversion_stats(ok)


@query(
    "extraction_stats",
    rf"""WITH f AS (SELECT repo, doc_id % 100 = 7 AS broken,
          doc_id % 10 <> 0 AND doc_id % 100 <> 7 AND length({sql_clean('content')}) >= 50 AS ok
        FROM ({FILES_SQL}))
    SELECT repo, count(DISTINCT repo)::BIGINT AS repos_processed,
      count(*) FILTER (WHERE ok)::BIGINT AS files_processed,
      count(*) FILTER (WHERE NOT ok)::BIGINT AS files_skipped,
      count(*) FILTER (WHERE broken)::BIGINT AS errors
    FROM f GROUP BY ROLLUP (repo)""",
)
def extraction_stats(spark, sf_dir):
    """A tenth of the files are ignored by name; some JSON files are nested too deep to parse."""
    k = F.col("doc_id")
    named = lambda suffix: F.concat(k.cast("string"), F.lit(suffix))
    tree = doc_files(spark, sf_dir).withColumn(
        "path",
        F.when(k % 10 == 0, named("/LICENSE.md")).when(k % 100 == 7, named(".json")).otherwise(F.col("path")),
    ).withColumn("content", F.when(k % 100 == 7, F.repeat(F.lit("["), F.lit(50_000))).otherwise(F.col("content")))
    return files.extraction_stats(files.extract_files(tree))


_TRANSCRIPTS_SQL = r"""
  SELECT doc_id, regexp_extract(text, '^([^\n]*)', 1) AS title, 'https://h/e/' || doc_id AS url,
    CASE WHEN doc_id % 3 = 0 THEN '2001-02-03' ELSE '' END AS date, text AS transcript,
    len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS word_count
  FROM documents"""


def transcripts(spark, sf_dir):
    """Documents as transcripts titled by their first line."""
    c = F.col("text")
    return documents(spark, sf_dir).select(
        "doc_id",
        F.substring_index(c, "\n", 1).alias("title"),
        F.concat(F.lit("https://h/e/"), F.col("doc_id").cast("string")).alias("url"),
        F.when(F.col("doc_id") % 3 == 0, "2001-02-03").otherwise("").alias("date"),
        c.alias("transcript"),
        T.word_count(c).alias("word_count"),
    )


@query(
    "episodes_numbered",
    f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY title, doc_id) AS episode
      FROM ({_TRANSCRIPTS_SQL}))
    SELECT doc_id, episode::BIGINT AS episode, 'EPISODE ' || episode || ': ' || title || chr(10)
      || 'URL: ' || url || chr(10) || CASE WHEN date <> '' THEN 'Date: ' || date || chr(10) ELSE '' END
      || 'Word Count: ' || word_count || chr(10) || chr(10) || transcript AS text FROM t""",
)
def episodes_numbered(spark, sf_dir):
    numbered = corpus.number_episodes(transcripts(spark, sf_dir), "doc_id")
    return numbered.select("doc_id", "episode", corpus.episode_text(with_rule=False).alias("text"))


@query(
    "episode_parse",
    f"""WITH t AS (SELECT *, row_number() OVER (ORDER BY title, doc_id) AS episode
      FROM ({_TRANSCRIPTS_SQL}))
    SELECT {sql_strip("'EPISODE ' || episode || ': ' || title")} AS title, url, word_count,
      {sql_strip('transcript')} AS content
    FROM t WHERE length({sql_strip('transcript')}) >= 200""",
)
def episode_parse(spark, sf_dir):
    """Number, render, write one ordered document, read it by its rule and parse it."""
    numbered = corpus.number_episodes(transcripts(spark, sf_dir), "doc_id")
    path = scratch_path(spark, "episodes")
    text_source.write_transcripts(
        corpus.render_transcripts(numbered, "TRANSCRIPTS", "https://h/", "talks", "2001-02-03"),
        path,
    )
    return corpus.parse_episodes(text_source.read_separated(spark, path))


@query(
    "transcript_totals",
    f"""SELECT count(*)::BIGINT AS transcripts, sum(word_count)::BIGINT AS total_words,
      format('{{:,}}', sum(word_count)::BIGINT) AS total_words_text FROM ({_TRANSCRIPTS_SQL})""",
)
def transcript_totals(spark, sf_dir):
    return corpus.transcript_totals(transcripts(spark, sf_dir).select("word_count"))


@query(
    "union_training",
    """WITH b AS (SELECT text FROM documents),
    a AS (SELECT text FROM conversations UNION ALL SELECT text FROM documents WHERE lang = 'en'),
    k AS (SELECT text FROM a WHERE text NOT IN (SELECT text FROM b))
    SELECT (SELECT count(*) FROM b)::BIGINT AS before,
      ((SELECT count(*) FROM b) + (SELECT count(*) FROM k))::BIGINT AS after,
      (SELECT count(*) FROM k)::BIGINT AS added""",
)
def union_training(spark, sf_dir):
    base = table(spark, sf_dir, "documents")
    repeated = base.where(F.col("lang") == "en").select("text")
    added = table(spark, sf_dir, "conversations").select("text").unionByName(repeated)
    return training.union_delta(training.build_training_set(base, added, existing=True))


@query(
    "train_val_split",
    """SELECT doc_id, CASE WHEN substr(md5(doc_id::VARCHAR), 1, 4) < '0ccd' THEN 'validation'
      ELSE 'train' END AS split FROM documents""",
)
def train_val_split(spark, sf_dir):
    return training.train_val_split(table(spark, sf_dir, "documents").select("doc_id"), "doc_id")


_PACK_SQL = r"""
  WITH n AS (SELECT doc_id AS id,
      len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS n_tokens FROM documents),
  s AS (SELECT *, id // 256 AS shard FROM n),
  l AS (SELECT shard, list({'id': id, 'n': n_tokens} ORDER BY id) AS xs FROM s GROUP BY shard),
  f AS (SELECT shard, xs, list_reduce(
      list_transform(xs, lambda x: [{'bin': 0::BIGINT, 'start': 0::BIGINT, 'n': x.n}]),
      lambda a, b: list_concat(a, [CASE
        WHEN a[len(a)].start + a[len(a)].n > 0 AND a[len(a)].start + a[len(a)].n + b[1].n > 2048
        THEN {'bin': a[len(a)].bin + 1, 'start': 0::BIGINT, 'n': b[1].n}
        ELSE {'bin': a[len(a)].bin, 'start': a[len(a)].start + a[len(a)].n, 'n': b[1].n} END])) AS bs
    FROM l),
  p AS (SELECT shard, unnest(xs) AS x, unnest(bs) AS b FROM f),
  packed AS (SELECT shard, x.id AS id, x.n AS n_tokens, b.bin AS bin, b.start AS start FROM p)"""


def _lengths(spark, sf_dir):
    return documents(spark, sf_dir).select(
        F.col("doc_id").alias("id"), training.token_count(F.col("text")).alias("n_tokens")
    )


@query("pack_sequences", f"{_PACK_SQL} SELECT shard, id, n_tokens, bin, start FROM packed")
def pack_sequences(spark, sf_dir):
    return training.pack_sequences(_lengths(spark, sf_dir), per_shard=256)


@query(
    "packing_summary",
    f"""{_PACK_SQL} SELECT shard, bin, count(*)::BIGINT AS n_rows, sum(n_tokens)::BIGINT AS fill,
      greatest(2048 - sum(n_tokens), 0)::BIGINT AS padding FROM packed GROUP BY shard, bin""",
)
def packing_summary(spark, sf_dir):
    return training.packing_summary(
        training.pack_sequences(_lengths(spark, sf_dir), per_shard=256)
    )


_HASHED_SQL = r"""
  SELECT md5(doc_id::VARCHAR) AS id, len(list_filter(regexp_split_to_array(text, '\s+'), lambda w: w <> ''))::BIGINT AS n_tokens
  FROM documents"""


def _packed_hashed(spark, sf_dir):
    lengths = _lengths(spark, sf_dir).withColumn("id", F.md5(F.col("id").cast("string")))
    return packing.pack_by_length(lengths)


@query(
    "pack_sequences_hashed_ids",
    f"""SELECT id, n_tokens, n_tokens > 0 AS placed, true AS in_sample, true AS in_line FROM ({_HASHED_SQL})""",
)
def pack_sequences_hashed_ids(spark, sf_dir):
    """Every row once; no sample overfull; rows of a sample follow each other without gap or overlap."""
    ahead = Window.partitionBy("sample").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fits = (F.col("start") + F.col("n_tokens") <= 2048) | (F.col("start") == 0)
    checked = _packed_hashed(spark, sf_dir).where("sample IS NOT NULL").select(
        "id", "n_tokens", F.lit(True).alias("placed"), fits.alias("in_sample"),
        (F.col("start") == F.coalesce(F.sum("n_tokens").over(ahead), F.lit(0))).alias("in_line"))
    rest = _packed_hashed(spark, sf_dir).where("sample IS NULL").select(
        "id", "n_tokens", F.lit(False), F.lit(True), F.lit(True))
    return checked.union(rest)


@query(
    "packing_fill",
    f"""WITH n AS ({_HASHED_SQL})
    SELECT sum(n_tokens) FILTER (WHERE n_tokens <= 2048)::BIGINT AS tokens,
      count(*) FILTER (WHERE n_tokens > 2048)::BIGINT AS overlong, true AS well_filled FROM n""",
)
def packing_fill(spark, sf_dir):
    """At least 0.97 of the samples' room is filled (but for the last two samples)."""
    fill = packing.sample_fill(_packed_hashed(spark, sf_dir))
    packed = F.col("fill") <= 2048
    return fill.agg(
        F.sum(F.when(packed, F.col("fill"))).alias("tokens"), F.count(F.when(~packed, 1)).alias("overlong"),
        (F.sum(F.when(packed, F.col("fill"))) >= 0.97 * 2048 * (F.count(F.when(packed, 1)) - 2)).alias("well_filled"))


@query(
    "csv_rows",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE
      '{"date": "' || o_orderdate::DATE || '", "venue": "' || o_orderpriority || '"}' END AS row_json
    FROM orders""",
)
def csv_rows(spark, sf_dir):
    cells = F.concat_ws(
        ",", F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderpriority"),
        F.when(F.col("o_orderkey") % 4 == 0, F.lit("extra")),
    )
    header = F.split(F.lit("date,venue"), ",")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", files.csv_rows_to_json(header, F.split(cells, ",")).alias("row_json")
    )


@query(
    "file_normalise",
    """WITH c AS (SELECT c_custkey AS k, c_name AS n, c_mktsegment AS s,
        'set list of a long evening in ' || c_mktsegment AS venue FROM customer)
    SELECT 'r' AS repo, k || CASE k % 3 WHEN 0 THEN '.json' WHEN 1 THEN '.csv' ELSE '.yaml' END AS path,
      CASE WHEN k % 3 <> 1 AND s = 'BUILDING' THEN NULL
        WHEN k % 3 = 0 THEN '{' || chr(10) || ' "venue": "' || venue || '",' || chr(10)
          || ' "n": [' || chr(10) || ' 1,' || chr(10) || ' "' || n || '"' || chr(10) || ' ]' || chr(10) || '}'
        WHEN k % 3 = 1 THEN '{"venue": "' || venue || '", "n": "' || n || '"}' || chr(10)
          || '{"venue": "a,b", "n": "c"}'
        ELSE 'n: ' || n || chr(10) || 'venue: ' || venue END AS content,
      CASE WHEN k % 3 <> 1 AND s = 'BUILDING' THEN 'skipped' ELSE 'ok' END AS status FROM c""",
)
def file_normalise(spark, sf_dir):
    """JSON, CSV and YAML files written from customers; some have no keyword."""
    k, n = F.col("c_custkey"), F.col("c_name")
    key = F.when(F.col("c_mktsegment") == "BUILDING", "place").otherwise("venue")
    venue = F.concat(F.lit("set list of a long evening in "), F.col("c_mktsegment"))
    as_json = F.format_string('{"%s":"%s","n":[1,"%s"]}', key, venue, n)
    as_csv = F.format_string('venue,n\n%s,%s\nshort\n"a,b",c\n', venue, n)
    as_yaml = F.format_string("%s: %s\nn: '%s'\n", key, venue, n)
    kind = k % 3
    # The table is a few megabytes where parsing takes minutes: rows go to every core, not by bytes.
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    tree = customers.repartition(4 * spark.sparkContext.defaultParallelism).select(
        F.lit("r").alias("repo"),
        F.concat(
            k.cast("string"),
            F.when(kind == 0, ".json").when(kind == 1, ".csv").otherwise(".yaml"),
        ).alias("path"),
        F.when(kind == 0, as_json).when(kind == 1, as_csv).otherwise(as_yaml).alias("content"),
    )
    return files.extract_files(tree, keywords=("venue", "setlist"))
