"""One query per operator over the whole tables, with check SQL where SQL can express it."""

from __future__ import annotations

import os
from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import (
    ann, decontamination, fill_middle, licences, neardup, packing, pieces, quality, token_counts, toxicity, training_order, vector_codes, warc,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def find_package(spark: SparkSession) -> None:
    """Python workers on this machine find the package wherever they are started. (On other
    machines it is installed, or shipped with --py-files.)"""
    env = spark.sparkContext.environment
    paths = [ROOT, *filter(None, env.get("PYTHONPATH", "").split(os.pathsep))]
    env["PYTHONPATH"] = os.pathsep.join(dict.fromkeys(paths))


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            find_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return register


OP1_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""


@query("op1_vantage_trees", OP1_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), every=20, k=20)


@query("op2_quality_rules")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(table(spark, sf_dir, "documents"))


@query("op3_token_counts")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECE_MODEL)


OP4_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\v\\f\\r]+') AS w FROM documents
), shingles AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM words
), single AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM shingles
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b
  FROM single a JOIN single b ON a.x = b.x AND a.doc_id < b.doc_id AND 100 * a.n >= 80 * b.n AND 100 * b.n >= 80 * a.n
  GROUP BY a.doc_id, b.doc_id, a.n, b.n
  HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), links AS (
  SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
), smallest AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a)
SELECT s.doc_id, coalesce(len(s.s), 0)::BIGINT AS n_shingles, m.component_id, s.doc_id = m.component_id AS kept
FROM shingles s JOIN smallest m ON m.a = s.doc_id
"""


@query("op4_minhash_neardup", OP4_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), words=2)


@query("op5_training_order")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_order.training_order(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query("op6_licences")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.summary(licences.scan(table(spark, sf_dir, "documents")))


@query("op7_packing")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query("op8_toxicity")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return made.select("doc_id", "held_out", "score", "predicted", F.size("offences").cast("long").alias("n_offences"))


OP9_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha256(coalesce(html, '')) AS payload_digest,
    octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


@query("op9_warc", OP9_SQL)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages")).drop("payload")


@query("op10_pieces")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = pieces.encode_decode(table(spark, sf_dir, "documents"), PIECE_MODEL)
    return made.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"),
    )


def _op11_sql() -> str:
    """The rounds written out one after another; distances are whole numbers in doubles."""
    ctes = [
        """v AS (
  SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
)""",
        "p AS (SELECT rid, vec_id, label, part, e[part * len(e) // 4 + 1 : (part + 1) * len(e) // 4] AS x FROM v, (SELECT unnest(range(4)) AS part))",
        "o AS (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id NULLS LAST, x) - 1 AS entry, x FROM p)",
        "b0 AS (SELECT * FROM o WHERE entry < 256)",
    ]
    for k in range(5):
        ctes.append(f"""a{k} AS MATERIALIZED (
  SELECT rid, part, min((list_inner_product(p.x, p.x) - 2 * list_inner_product(p.x, b.x) + list_inner_product(b.x, b.x))::BIGINT * 256 + entry) AS best
  FROM p JOIN b{k} b USING (part) GROUP BY rid, part)""")
        if k < 4:
            ctes.append(f"""m{k} AS (
  SELECT part, entry, list(c ORDER BY j) AS x FROM (
    SELECT part, entry, j, floor(sum(c) / count(*)) AS c FROM (
      SELECT part, best % 256 AS entry, unnest(x) AS c, generate_subscripts(x, 1) AS j FROM a{k} JOIN p USING (rid, part)) GROUP BY part, entry, j)
  GROUP BY part, entry)""")
            ctes.append(f"b{k + 1} AS MATERIALIZED (SELECT part, entry, coalesce(m.x, b.x) AS x FROM b{k} b LEFT JOIN m{k} m USING (part, entry))")
    ctes.append("""c AS (
  SELECT rid, string_agg(printf('%02x', best % 256), '' ORDER BY part) AS code, sum(best // 256)::BIGINT AS error FROM a4 GROUP BY rid)""")
    ctes.append("h AS (SELECT sha256(string_agg(array_to_string(x::BIGINT[], ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b4)")
    return "WITH " + ",\n".join(ctes) + """
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM v JOIN c USING (rid), h
"""


@query("op11_vector_codes", _op11_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    made, books = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    digest = F.lit(vector_codes.books_sha256(books)).alias("codebooks_sha256")
    return made.select("vec_id", vector_codes.code_text().alias("code"), "error", "label_error", digest)


OP12_SQL = """
WITH u AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS lines, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
), d AS (
  SELECT doc_id, t, lines, len(lines) AS n, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[25:32])::BIGINT AS h4 FROM u
), c AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS lo, greatest(h1 % (n + 1), h2 % (n + 1)) AS hi,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM d
), x AS (
  SELECT *, array_to_string(lines[1:lo], '') AS prefix, array_to_string(lines[lo + 1:hi], '') AS middle, array_to_string(lines[hi + 1:n], '') AS suffix FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
    ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256, sha256(t) AS restored_sha256
FROM x
"""


@query("op12_fill_middle", OP12_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    output = F.col("output")
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars",
        F.sha2(output, 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(output, F.col("form")), 256).alias("restored_sha256"),
    )


OP13_SQL = """
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), i AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), s AS (SELECT item, w, least(10, len(w)) AS size FROM i WHERE len(w) > 0
), windows AS (
  SELECT DISTINCT item, size, unnest(list_transform(range(1, len(w) - size + 2), lambda k: array_to_string(w[k:k + size - 1], ' '))) AS win FROM s
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size
), found AS (
  SELECT p.doc_id, p.k, p.size, x.item FROM (SELECT doc_id, k, size, array_to_string(w[k:k + size - 1], ' ') AS win FROM places) p JOIN windows x USING (size, win)
), hit AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS pos FROM found) GROUP BY doc_id
), items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op13_decontamination", OP13_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.summary(decontamination.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))
