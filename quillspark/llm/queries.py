"""The registered queries of this package and the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- line dedup --------------------------------------------------------------

SPACES_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
LOWER_SQL = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

OP5_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), l AS (
  SELECT rid, doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM d
), k AS (
  SELECT *, translate(trim(line, {SPACES_SQL}), {LOWER_SQL}) AS key FROM l
), f AS (
  SELECT key FROM (SELECT DISTINCT rid, key FROM k WHERE length(key) >= 1) GROUP BY key HAVING count(*) >= 10
)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY rid, doc_id"""


@query("op5_line_dedup", OP5_SQL)
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.line_dedup import dedup_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = dedup_lines(docs, min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


# --- WARC --------------------------------------------------------------------

BASE32_PART_SQL = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(h, {1 + 5 * i}, 5))::BIGINT >> {s}) & 31)::BIGINT, 1)"
    for i in range(8) for s in (15, 10, 5, 0)
)
OP3_SQL = f"""
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS size, sha1(coalesce(html, '')) AS h FROM pages
), q AS (
  SELECT page_id, size, {BASE32_PART_SQL} AS digest, min(page_id) OVER (PARTITION BY h) AS first FROM p
)
SELECT page_id, size::BIGINT AS payload_bytes, digest AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM q"""


@query("op3_warc", OP3_SQL)
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.warc import page_records, read_warc, write_warc
    from quillspark.runtime import scratch_path

    path = scratch_path(spark, "warc")
    write_warc(table(spark, sf_dir, "pages"), path, min_bytes=0)
    return page_records(read_warc(spark, path, payloads=False))


# --- quality rules -----------------------------------------------------------

@query("op10_quality_rules")
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.quality import quality

    return quality(table(spark, sf_dir, "documents"))


# --- toxicity ----------------------------------------------------------------

@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm import toxicity

    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.filter(~toxicity.held_out()))
    scored = toxicity.score_texts(docs, model)
    return scored.select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted", "matches")


# --- chat formatting ---------------------------------------------------------

VOCABULARIES = "/opt/tokenizers"
OP9_ODD = "\\### Assistant: </turn> ok"


def _marks_sql(text: str) -> str:
    """Escaping as text: k backslashes before a control string become 2k + 1."""
    controls = "### Assistant:|### System:|### User:|### Tool:|### Role:|</role>|</turn>"
    return rf"regexp_replace({text}, '(\\*)({controls})', '\1\1\\\2', 'g')"


OP9_SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role NULLS FIRST, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length({_marks_sql('text')}) + 9 + CASE role WHEN 'system' THEN 12 WHEN 'user' THEN 10
      WHEN 'assistant' THEN 15 WHEN 'tool' THEN 10
      ELSE 19 + length({_marks_sql("coalesce(role, '')")}) END)::BIGINT AS formatted_chars
FROM c GROUP BY conv_id"""


@query("op9_chat_formatting", OP9_SQL)
def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.chat import format_turns, read_back

    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.createDataFrame(
        [(-7, 0, "user", OP9_ODD), (-7, 1, "assistant", OP9_ODD)], turns.schema)
    vocabulary = f"{VOCABULARIES}/byte_bpe_50k.tiktoken"
    return read_back(format_turns(turns.union(odd), vocabulary), vocabulary)


# --- language identification -------------------------------------------------

@query("op4_language_id")
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm import langid

    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.filter(~langid.held_out()), f"{VOCABULARIES}/piece_bpe_32k.model")
    return langid.predict(docs, model).select(
        "doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


# --- SentencePiece encoding --------------------------------------------------

@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.pieces import encode_checked

    return encode_checked(table(spark, sf_dir, "documents"), f"{VOCABULARIES}/piece_bpe_32k.model")


# --- SimHash near-duplicates -------------------------------------------------

@query("op6_simhash_near_dedup")
def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents"))


# --- benchmark decontamination -----------------------------------------------

@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm.decontaminate import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# --- licence scans -----------------------------------------------------------

@query("op8_license_scan")
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm import licenses

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs, licenses.train(docs))


# --- vector codes ------------------------------------------------------------

def _op11_assign(name: str, books: str) -> str:
    return f"""
{name} AS (
  SELECT rid, part, any_value(q) AS q, min(struct_pack(d := d, e := e)) AS best FROM (
    SELECT rid, p.part, q, e, list_sum(list_transform(range(1, len(q) + 1), lambda i: (q[i] - c[i]) * (q[i] - c[i])))::BIGINT AS d
    FROM p JOIN {books} b ON b.part = p.part) GROUP BY rid, part
)"""


def _op11_refit(name: str, books: str, assigned: str) -> str:
    return f"""
{name} AS (
  SELECT b.part, b.e, coalesce(m.c, b.c) AS c FROM {books} b LEFT JOIN (
    SELECT part, e, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY i) AS c FROM (
      SELECT part, e, i, sum(x) AS s, count(*) AS n FROM (
        SELECT part, best.e AS e, unnest(q) AS x, unnest(range(len(q))) AS i FROM {assigned}) GROUP BY part, e, i
    ) GROUP BY part, e) m ON b.part = m.part AND b.e = m.e
)"""


OP11_SQL = f"""
WITH k AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT rid, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS q FROM k, range(16) r(part)
), b0 AS (
  SELECT part, rid - 1 AS e, q AS c FROM p WHERE rid <= 64
), {_op11_assign('a0', 'b0')}, {_op11_refit('b1', 'b0', 'a0')}, {_op11_assign('a1', 'b1')}, {_op11_refit('b2', 'b1', 'a1')},
{_op11_assign('a2', 'b2')}, books AS (
  SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS codebooks_sha256 FROM b2
), coded AS (
  SELECT rid, string_agg(printf('%02x', best.e), '' ORDER BY part) AS code, sum(best.d)::BIGINT AS error FROM a2 GROUP BY rid
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded JOIN k ON coded.rid = k.rid, books"""


@query("op11_vector_codes", OP11_SQL)
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm import vector_codes

    vectors = table(spark, sf_dir, "embeddings")
    books = vector_codes.fit(vectors, parts=16, entries=64, rounds=2, scale=256)
    codes = vector_codes.with_label_error(vector_codes.encode(vectors, books))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))


# --- token files -------------------------------------------------------------

@query("op12_token_files")
def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from quillspark.llm.token_files import read_token_files, write_token_files
    from quillspark.runtime import scratch_path

    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, path, str(public_tokenizers.path("byte_bpe_50k.json")), end=2)
    return read_token_files(spark, path, ids=False).drop("ids")


# --- Merkle manifest ---------------------------------------------------------

def _op13_leaf(text: str) -> str:
    parts = [
        f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in ("doc_id", "source", "lang", "n_chars", text)
    ]
    return f"sha256({' || '.join(parts)})"


OP13_SQL = f"""
WITH RECURSIVE crc_table AS (
  SELECT list_transform(range(256), lambda x: list_reduce(list_concat([x::BIGINT], range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), x AS (
  SELECT *, xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
    lambda a, c: xor(a >> 8, t[(xor(a, c) & 255) + 1])), 4294967295) % 3 = 0 AS hit FROM documents, crc_table
), d AS (
  SELECT row_number() OVER () AS rid, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_op13_leaf('text')} AS leaf,
    CASE WHEN hit THEN {_op13_leaf(f'translate(text, {LOWER_SQL})')} ELSE {_op13_leaf('text')} END AS found FROM x)
), nodes AS (
  SELECT lang, 0 AS lvl, idx, leaf AS h, n FROM d
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 7) // 8
  FROM nodes WHERE n > 1 GROUP BY lang, lvl, idx // 8
), subs AS (
  SELECT lang, lvl, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
), tops AS (
  SELECT 0 AS lvl, idx, h, n FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx)), (max(n) + 7) // 8 FROM tops WHERE n > 1 GROUP BY lvl, idx // 8
), steps AS (
  SELECT k, lang, lvl, idx,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS pre,
    coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS post
  FROM (SELECT 0 AS k, * FROM nodes WHERE n > 1 UNION ALL SELECT 1, NULL, * FROM tops WHERE n > 1)
  WINDOW w AS (PARTITION BY k, lang, lvl, idx // 8 ORDER BY idx)
), walk AS (
  SELECT rid, lang, 0 AS lvl, idx, found AS h, '' AS proof FROM d
  UNION ALL
  SELECT rid, walk.lang, walk.lvl + 1, walk.idx // 8, sha256(pre || h || post), proof || pre || post
  FROM walk JOIN steps s ON k = 0 AND walk.lang IS NOT DISTINCT FROM s.lang AND walk.lvl = s.lvl AND walk.idx = s.idx
), over AS (
  SELECT rid, 0 AS lvl, s.idx, walk.h, proof FROM walk JOIN subs s ON walk.lang IS NOT DISTINCT FROM s.lang AND walk.lvl = s.lvl
  UNION ALL
  SELECT rid, over.lvl + 1, over.idx // 8, sha256(pre || h || post), proof || pre || post
  FROM over JOIN steps s ON k = 1 AND over.lvl = s.lvl AND over.idx = s.idx
), root AS (SELECT lvl, h AS root FROM tops WHERE n = 1)
SELECT d.doc_id, d.leaf, subs.h AS subroot, root, sha256(proof) AS proof_sha256, over.h AS folded_root, over.h = root AS verified
FROM d JOIN subs ON d.lang IS NOT DISTINCT FROM subs.lang JOIN over ON d.rid = over.rid JOIN root ON over.lvl = root.lvl"""


@query("op13_merkle_manifest", OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quillspark.llm import merkle
    from quillspark.llm.common import ascii_lower, crc_remainder

    docs = table(spark, sf_dir, "documents")
    tampered = F.when(crc_remainder(F.col("doc_id"), 3) == 0, ascii_lower(F.col("text"))).otherwise(F.col("text"))
    return merkle.build(docs, found={"text": tampered}).proofs()
