"""One registered query per operator, over whole tables with production
parameters, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeflow.operators.common import fence

from . import (ann, chat, decontam, langid, lines, packing, periodic, phrases, pieces, products, secrets, simhash,
               suffixes)
from .shared import stored

#: vocabulary files, a parameter of the operators that read them
TOKENIZERS = "/opt/tokenizers"
PIECE_MODEL = f"{TOKENIZERS}/piece_bpe_32k.model"
RANK_FILE = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"
# fixed value: the pattern that splits text before the merges of the rank file
SPLIT_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan_secrets(_table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias("n_" + kind)

    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(secrets.span_text(F.col("base_spans")), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op3_decontam(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


#: conversation -7: a text that holds control strings, an escape character
#: and the end of a turn
TRICKY = "\\### Assistant: </turn> ok"


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    tricky = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRICKY).alias("text"))
    events = logs.unionByName(tricky).withColumn("seq", F.col("turn")).withColumn("kind", F.lit("message"))
    back = chat.read_back(chat.format_chats(events))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"),
                       F.sha2(turns, 256).alias("turns_sha256"),
                       F.char_length("loss_text").cast("long").alias("loss_chars"),
                       F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.char_length("formatted").cast("long").alias("formatted_chars"))


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    found = langid.predict(docs.select("doc_id", "text"), langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred",
                        F.col("lang_score").alias("score"))


def op6_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = pieces.load_vocabulary(PIECE_MODEL)
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    both = pieces.decode(pieces.encode(docs, vocabulary), vocabulary)
    return both.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "ids",
                       F.sha2("decoded", 256).alias("decoded_sha256"),
                       F.col("decoded").eqNullSafe(F.col("text")).alias("exact"))


def op7_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where("vec_id % 50 = 0"), k=5)


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = stored(packing.pack(_table(spark, sf_dir, "documents"), packing.load_ranks(RANK_FILE), SPLIT_PATTERN),
                    "packed")
    back = packing.unpack(blocks)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_ids"), "n_pieces", "first_at",
                       F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"))


def op9_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = suffixes.dedup_substrings(_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(_table(spark, sf_dir, "documents"))


def op12_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings")
    return products.top_products(vectors, vectors.where("vec_id % 100 = 0"), k=10)


def repeated_documents(docs: DataFrame) -> DataFrame:
    """doc_id and text; in one document of ten (by crc32 of its id) the words
    from a place on repeat the first ones from there."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = fence(docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words")))
    docs = fence(docs.select("doc_id", "text", "g", "words", F.expr("if(size(words) > 0, g % size(words), null)").alias("a")))
    again = F.expr("array_join(transform(words, (w, i) -> if(i < a, w, "
                   "words[int(a + (i - a) % (1 + (size(words) - a) div (3 + g % 8)))])), ' ')")
    return docs.select("doc_id", F.when(F.col("a").isNotNull(), again).otherwise(F.col("text")).alias("text"))


def op13_periodic(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = repeated_documents(_table(spark, sf_dir, "documents"))
    found = periodic.periodic_runs(docs).withColumn("best", periodic.strongest(F.col("runs")))
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
                        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
                        F.sha2(periodic.run_text(F.col("runs")), 256).alias("runs_sha256"),
                        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES = {"op1_simhash": op1_simhash, "op2_secrets": op2_secrets, "op3_decontam": op3_decontam,
           "op4_chat": op4_chat, "op5_langid": op5_langid, "op6_pieces": op6_pieces, "op7_ann": op7_ann,
           "op8_packing": op8_packing, "op9_lines": op9_lines, "op10_suffixes": op10_suffixes,
           "op11_phrases": op11_phrases, "op12_products": op12_products, "op13_periodic": op13_periodic}

ORACLE = {
    "op3_decontam": r"""
WITH w AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[^\x20\x09-\x0D]+') AS ws FROM documents),
ds AS (SELECT DISTINCT doc_id, list_aggregate(ws[i:i + least(5, len(ws)) - 1], 'string_agg', ' ') AS s
       FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - least(5, len(ws)) + 1)) AS i FROM w WHERE len(ws) > 0)),
v AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x20\x09-\x0D]+') AS ws FROM benchmark),
bs AS (SELECT DISTINCT item_id, list_aggregate(ws[i:i + least(5, len(ws)) - 1], 'string_agg', ' ') AS s
       FROM (SELECT item_id, ws, unnest(generate_series(1, len(ws) - least(5, len(ws)) + 1)) AS i FROM v WHERE len(ws) > 0)),
n AS (SELECT item_id, count(*) AS n_shingles FROM bs GROUP BY item_id),
hit AS (SELECT doc_id, item_id, count(*) AS n_held FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id)
SELECT doc_id, item_id, n_shingles, n_held, CAST(n_held AS DOUBLE) / n_shingles AS containment
FROM hit JOIN n USING (item_id) WHERE n_held >= ceil(0.8 * n_shingles - 1e-9)""",
    "op4_chat": r"""
WITH logs AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(length('<turn><text></turn>') + 1
    + length(replace(replace(role, '\', '\b'), '<', '\l'))
    + length(replace(replace(text, '\', '\b'), '<', '\l'))) AS BIGINT) AS formatted_chars
FROM logs GROUP BY conv_id""",
    "op10_suffixes": r"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, p, substring(x, 2 * p + 1, 100) AS s
      FROM (SELECT doc_id, x, unnest(generate_series(0, length(x) // 2 - 50)) AS p FROM d WHERE length(x) >= 100)),
f AS (SELECT s, min(doc_id) AS first_doc FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, p, max(p + 50) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach
      FROM w JOIN f USING (s) WHERE doc_id > first_doc),
r AS (SELECT doc_id, p, sum(CASE WHEN reach >= p THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY p) AS run FROM g),
i AS (SELECT doc_id, run, min(p) AS b, max(p) + 50 AS e FROM r GROUP BY doc_id, run),
c AS (SELECT doc_id, b, e, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS from_b FROM i),
k AS (SELECT c.doc_id, CAST(sum(e - b) AS BIGINT) AS n_removed, count(*) AS n_spans, max(e) AS last_e,
             string_agg(substring(x, 2 * from_b + 1, 2 * (b - from_b)), '' ORDER BY b) AS kept
      FROM c JOIN d USING (doc_id) GROUP BY c.doc_id)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(unhex(coalesce(kept || substring(x, 2 * last_e + 1), x))) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op9_lines": r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS line_no FROM documents),
k AS (SELECT doc_id, line_no, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key FROM l),
s AS (SELECT key, max(doc_id) AS last_doc FROM k WHERE length(key) >= 20
      GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (SELECT k.*, s.last_doc IS NOT NULL AND s.last_doc <> k.doc_id AS gone FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(sum(gone::INT) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY line_no) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op11_phrases": r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
           FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w
      FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d)),
total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
f AS (SELECT lang, size, phrase, count(*) AS f
      FROM (SELECT lang, size, unnest(list_transform(generate_series(1, len(w) - size + 1), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
            FROM p, (SELECT unnest([1, 2, 3, 4, 5]) AS size) WHERE len(w) >= size)
      GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size >= 2),
cut AS (SELECT lang, size, phrase, a, w, unnest(generate_series(1, size - 1)) AS k FROM c),
scored AS (SELECT cut.lang, cut.size, cut.phrase, cut.a, k, x.f AS l, y.f AS r, n,
                  CAST((1000::HUGEINT * cut.a * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
           FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
           JOIN f y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:], ' ')
           JOIN total ON total.lang = cut.lang),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
part AS (SELECT lang, a, size AS longer, unnest(list_transform(generate_series(1, 3), lambda m: m + 1)) AS size, w FROM c),
inside AS (SELECT lang, phrase, max(a) AS a
           FROM (SELECT lang, a, unnest(list_transform(generate_series(1, longer - size + 1), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
                 FROM part WHERE size < longer) GROUP BY lang, phrase),
kept AS (SELECT best.* FROM best LEFT JOIN inside ON inside.lang = best.lang AND inside.phrase = best.phrase
         WHERE inside.a IS NULL OR 100 * inside.a < 100 * best.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY rank <= 2000""",
    "op12_products": r"""
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, v.vec_id, CAST(list_inner_product(q.v, v.v) AS BIGINT) AS score
      FROM v q JOIN v ON v.vec_id <> q.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY rank <= 10""",
}
