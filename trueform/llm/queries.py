"""Queries of the operators over the driver tables, and their SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from trueform.llm import (alignment, chat, decontaminate, embed_dedup, langid, licenses, merkle, minhash, packing, quality, substring,
                          suffix_dedup, token_counts)
from trueform.llm.common import on_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    on_path(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary_file(name: str) -> str:
    """Place of a public tokenizer's vocabulary file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(sql: str | None = None):
    def register(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLE[fn.__name__] = sql
        return fn
    return register


@query()
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.placed_pieces(packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary_file("word_bpe_49k.json")))


OP2_SQL = r"""
WITH doc AS (SELECT row_number() OVER () AS k, doc_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT CAST(item_id AS VARCHAR) AS item_id,
               regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
sized AS (SELECT *, least(13, len(w)) AS n FROM item WHERE len(w) > 0),
iw AS (SELECT DISTINCT item_id, n, array_to_string(w[p:p + n - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS p FROM sized)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT k, n, p, array_to_string(w[p:p + n - 1], ' ') AS win
       FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM doc, sizes WHERE len(w) >= n)),
hit AS (SELECT dw.k, dw.n, dw.p, iw.item_id FROM dw JOIN iw USING (n, win)),
cov AS (SELECT k, count(DISTINCT q) AS n_hit FROM (SELECT k, unnest(range(p, p + n)) AS q FROM hit) GROUP BY k),
its AS (SELECT k, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hit GROUP BY k)
SELECT doc.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN cov USING (k) LEFT JOIN its USING (k)
"""


@query(OP2_SQL)
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("removed_spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


OP4_SQL = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sh AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS p FROM words WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
inter AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM sh a JOIN sh b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT a, b FROM inter JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
comp AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT words.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, component_id, words.doc_id = component_id AS kept
FROM words LEFT JOIN n USING (doc_id) JOIN comp USING (doc_id)
"""


@query(OP4_SQL)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4)


OP5_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
t AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS no, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
f AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY no) AS plain,
             coalesce(string_agg(text, '' ORDER BY no) FILTER (role = 'assistant'), '') AS loss,
             CAST(sum(length(role) + 4 * (length(role) - length(replace(role, '&', ''))) + 3 * (length(role) - length(replace(role, '<', ''))) + 4 * (length(role) - length(replace(role, '[', ''))) + 4 * (length(role) - length(replace(role, chr(10), '')))
               + length(text) + 4 * (length(text) - length(replace(text, '&', ''))) + 3 * (length(text) - length(replace(text, '<', ''))) + 4 * (length(text) - length(replace(text, '[', ''))) + 24) AS BIGINT) AS formatted_chars
      FROM t GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(plain) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM f
"""


@query(OP5_SQL)
def op5_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    probe = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return chat.digests(chat.format_conversations(rows))


@query()
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP7_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS k, doc_id, string_split(text, chr(10)) AS parts FROM documents),
lines AS (SELECT k, doc_id, no, line, unit, CASE WHEN unit = '' THEN 0 ELSE len(string_split(unit, ' ')) END AS n
  FROM (SELECT k, doc_id, no, line, trim(regexp_replace(lower(line), '\s+', ' ', 'g')) AS unit
        FROM (SELECT k, doc_id, unnest(parts) AS line, unnest(range(1, len(parts) + 1)) AS no FROM docs))),
placed AS (SELECT *, coalesce(sum(length(line) + 1) OVER w, 0) AS pos, coalesce(sum(n) OVER w, 0) AS before FROM lines
           WINDOW w AS (PARTITION BY k ORDER BY no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
texts AS (SELECT k, list(unit ORDER BY no) AS forms FROM lines GROUP BY k),
ends AS (SELECT a.k, a.doc_id, a.no AS i, b.no AS j FROM (SELECT *, before + 13 AS need FROM placed WHERE n > 0) a
         ASOF JOIN (SELECT k, no, before + n AS upto FROM placed WHERE n > 0) b ON a.k = b.k AND a.need <= b.upto),
unit AS (SELECT k, doc_id, i, j, array_to_string(list_filter(forms[i:j], lambda x: x <> ''), ' ') AS words FROM ends JOIN texts USING (k)),
judged AS (SELECT *, doc_id > min(doc_id) OVER (PARTITION BY words) OR row_number() OVER (PARTITION BY words, k ORDER BY i) > 1 AS later FROM unit),
gone AS (SELECT DISTINCT k, unnest(range(i, j + 1)) AS no FROM judged WHERE later),
kept AS (SELECT placed.*, gone.no IS NULL AS keep FROM placed LEFT JOIN gone ON gone.k = placed.k AND gone.no = placed.no)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (keep), '') AS text,
       coalesce(string_agg(CAST(pos AS BIGINT) || '-' || CAST(pos + length(line) AS BIGINT), ',' ORDER BY no) FILTER (keep), '') AS kept_spans,
       count(*) AS n_lines, count(*) FILTER (NOT keep) AS n_removed
FROM kept GROUP BY k, doc_id
"""


@query(OP7_SQL)
def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.array_join(F.transform("kept_spans", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return substring.substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", "text", spans.alias("kept_spans"), "n_lines", "n_removed")


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", langid.held_out())
    model = langid.train(docs.filter(~F.col("held_out") & F.col("doc_id").isNotNull()))
    return langid.identify(docs.select("doc_id", "held_out", "text"), model).select(
        "doc_id", "held_out", "lang_pred", F.col("lang_score").alias("score"))


@query()
def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embed_dedup.embedding_duplicates(table(spark, sf_dir, "embeddings"))


@query()
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary_file("piece_bpe_32k.model"))


@query()
def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.token_alignment(table(spark, sf_dir, "documents"), vocabulary_file("byte_bpe_50k.json"), vocabulary_file("piece_bpe_32k.model"))


OP13_SQL = r"""
WITH RECURSIVE bits AS (SELECT b, 0 AS n, CAST(b AS UBIGINT) AS c FROM range(256) AS t(b)
                        UNION ALL SELECT b, n + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS UBIGINT)) ELSE c >> 1 END FROM bits WHERE n < 8),
tab AS (SELECT list(c ORDER BY b) AS t FROM bits WHERE n = 8),
doc AS (SELECT *, list_reduce(list_prepend(CAST(4294967295 AS UBIGINT), list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS UBIGINT))),
                              lambda x, y: xor(x >> 8, t[CAST(xor(x, y) & 255 AS INTEGER) + 1])) AS crc FROM documents, tab),
enc AS (SELECT doc_id, source, text IS NOT NULL AND xor(crc, CAST(4294967295 AS UBIGINT)) % 5 = 0 AS tampered,
          coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
          || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
          coalesce(strlen(text) || ':' || text, '-') AS body,
          coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low FROM doc),
leaf AS (SELECT doc_id, source, sha256(head || body) AS leaf, sha256(head || CASE WHEN tampered THEN low ELSE body END) AS given FROM enc),
base AS (SELECT *, row_number() OVER () AS k, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r, count(*) OVER (PARTITION BY source) AS n FROM leaf),
node AS (SELECT source, 0 AS l, r AS i, leaf AS h, n FROM base
         UNION ALL SELECT source, l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM node WHERE n > 1 GROUP BY source, l, i // 16),
sub AS (SELECT source, h AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r, count(*) OVER () AS n FROM node WHERE n = 1),
up AS (SELECT 0 AS l, r AS i, subroot AS h, n FROM sub
       UNION ALL SELECT l + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 15) // 16 FROM up WHERE n > 1 GROUP BY l, i // 16),
way AS (SELECT k, source, 0 AS l, r AS i, n FROM base UNION ALL SELECT k, source, l + 1, i // 16, (n + 15) // 16 FROM way WHERE n > 1),
upway AS (SELECT source, 0 AS l, r AS i, n FROM sub UNION ALL SELECT source, l + 1, i // 16, (n + 15) // 16 FROM upway WHERE n > 1),
step AS (SELECT k, way.l, string_agg(h, '' ORDER BY node.i) FILTER (node.i < way.i) AS a, string_agg(h, '' ORDER BY node.i) FILTER (node.i > way.i) AS b
         FROM way JOIN node ON node.source IS NOT DISTINCT FROM way.source AND node.l = way.l AND node.i // 16 = way.i // 16 WHERE way.n > 1 GROUP BY k, way.l),
upstep AS (SELECT source, upway.l + 1000 AS l, string_agg(h, '' ORDER BY up.i) FILTER (up.i < upway.i) AS a, string_agg(h, '' ORDER BY up.i) FILTER (up.i > upway.i) AS b
           FROM upway JOIN up ON up.l = upway.l AND up.i // 16 = upway.i // 16 WHERE upway.n > 1 GROUP BY source, upway.l),
steps AS (SELECT k, row_number() OVER (PARTITION BY k ORDER BY l) AS s, coalesce(a, '') AS a, coalesce(b, '') AS b
          FROM (SELECT * FROM step UNION ALL SELECT k, l, a, b FROM base JOIN upstep ON base.source IS NOT DISTINCT FROM upstep.source)),
fold AS (SELECT k, 1 AS s, given AS h FROM base UNION ALL SELECT fold.k, fold.s + 1, sha256(a || h || b) FROM fold JOIN steps ON steps.k = fold.k AND steps.s = fold.s),
done AS (SELECT k, arg_max(h, s) AS folded_root FROM fold GROUP BY k),
proof AS (SELECT k, string_agg(a || b, '' ORDER BY s) AS p FROM steps GROUP BY k),
root AS (SELECT h AS root FROM up WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(p, '')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM base JOIN sub ON base.source IS NOT DISTINCT FROM sub.source CROSS JOIN root JOIN done USING (k) LEFT JOIN proof USING (k)
"""


@query(OP13_SQL)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    kept = ["doc_id", "source", "lang", "n_chars", "text"]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    low = F.when(tampered, F.translate("text", merkle.UPPER, merkle.LOWER)).otherwise(F.col("text"))
    given = merkle.leaf_digest([F.col(c) for c in kept[:-1]] + [low])
    rows = merkle.manifest(docs, "source", "doc_id", kept, {"given": given})
    rows = rows.withColumn("folded_root", merkle.folded(F.col("given"), F.col("path")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2(merkle.proof_text(F.col("path")), 256).alias("proof_sha256"),
                       "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


@query()
def op12_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = F.col("detections")
    base = F.filter(found, lambda d: d["kind"] == "base")
    labels = lambda held: F.array_join(F.array_sort(F.array_distinct(held["label"])), ",")
    return licenses.scan(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(base["first_word"]).alias("first_word"),
        F.array_max(base["first_word"]).alias("last_word"), labels(base).alias("base_labels"), labels(found).alias("labels"),
        F.coalesce(F.array_max(found["score"]), F.lit(0.0)).alias("score"), "n_suppressed")
