"""The operators of this package as queries over whole driver tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rosterloom.llm import (
    conversations,
    decontamination,
    html_text,
    language,
    lines,
    nearest,
    pieces,
    pseudonyms,
    quality,
    simhash,
    token_files,
    toxicity,
    vector_codes,
)
from rosterloom.llm.storage import table

#: Where the public tokenizers are on every machine; their files are parameters of the operators.
TOKENIZER, PIECE_MODEL = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: A job passes its own secret.
PSEUDONYM_KEY = "a key for the driver tables"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_simple8b(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_files(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER), end_id=0)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_digest(table(spark, sf_dir, "documents"))


def op3_graph_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return nearest.nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0), k=20)


def op4_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.main_text(table(spark, sf_dir, "pages"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pseudonyms.with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), PSEUDONYM_KEY)
    return found.select("doc_id", "private.*")


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.with_contamination(docs, table(spark, sf_dir, "benchmark")).select("doc_id", "contamination.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identified(table(spark, sf_dir, "documents"))


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(table(spark, sf_dir, "documents"), tokenizer_path(PIECE_MODEL))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_after_damage(table(spark, sf_dir, "conversations"))


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.vector_codes(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simple8b, op2_line_dedup, op3_graph_nearest, op4_main_text, op5_quality, op6_pseudonyms,
        op7_decontamination, op8_simhash, op9_language, op10_pieces,
        op11_toxicity, op12_conversation_repair, op13_vector_codes,
    )
}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_LINE_DEDUP = f"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
line AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM docs),
keyed AS (
  SELECT *, {_LOWER.format("trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS key FROM line
),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
),
judged AS (
  SELECT k.*, s.key IS NOT NULL AND k.doc_id <> s.keeper AS dropped FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

_WORDS = r"regexp_extract_all({}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = f"""
WITH item AS (
  SELECT item_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
),
win AS (
  SELECT DISTINCT item_id, array_to_string(w[i + 1 : i + 13], ' ') AS words, least(len(w), 13) AS n
  FROM (SELECT item_id, w, unnest(range(greatest(1, len(w) - 12))) AS i FROM item WHERE len(w) > 0)
),
doc AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS w FROM documents),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i + 1 : i + n], ' ') AS words
  FROM (
    SELECT doc_id, w, n, unnest(range(greatest(0, len(w) - n + 1))) AS i
    FROM doc, (SELECT DISTINCT n FROM win)
  )
),
hit AS (SELECT p.doc_id, p.i, p.n, v.item_id FROM place p JOIN win v ON p.words = v.words AND p.n = v.n),
word AS (
  SELECT doc_id, count(DISTINCT spot) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS spot FROM hit) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM doc d LEFT JOIN word USING (doc_id) LEFT JOIN items USING (doc_id)
"""



def _vector_codes(rounds: int = 4) -> str:
    """One pair of table expressions for each round: what every part is nearest to, and where the entries move."""
    near = """near{0} AS MATERIALIZED (
  SELECT p, vec_id, any_value(x.v) AS v, min(d) AS d, arg_min(k, d * 256 + k) AS k
  FROM (
    SELECT x.p, x.vec_id, x.v, b.k,
      CAST(list_inner_product(x.v, x.v) - 2 * list_inner_product(x.v, b.v) + list_inner_product(b.v, b.v) AS BIGINT) AS d
    FROM part x JOIN book{0} b ON x.p = b.p
  ) x GROUP BY p, vec_id
)"""
    move = """cell{0} AS (
  SELECT p, k, i, CAST(sum(v[i]) AS BIGINT) AS s, count(*) AS c
  FROM near{0}, unnest(range(1, len(v) + 1)) AS t(i) GROUP BY p, k, i
),
book{1} AS MATERIALIZED (
  SELECT b.p, b.k, coalesce(m.v, b.v) AS v FROM book{0} b LEFT JOIN (
    SELECT p, k, list(CAST((s - (((s % c) + c) % c)) // c AS DOUBLE) ORDER BY i) AS v FROM cell{0} GROUP BY p, k
  ) m ON b.p = m.p AND b.k = m.k
)"""
    steps = ",\n".join(f"{near.format(r)},\n{move.format(r, r + 1)}" for r in range(rounds))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
part AS MATERIALIZED (
  SELECT vec_id, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] AS v FROM kept, unnest(range(4)) AS t(p)
),
book0 AS MATERIALIZED (
  SELECT * FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, v FROM part) WHERE k < 256
),
{steps},
{near.format(rounds)},
final AS (
  SELECT kept.vec_id, any_value(label) AS label, string_agg(lower(printf('%02x', k)), '' ORDER BY p) AS code,
    CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} n JOIN kept ON n.vec_id = kept.vec_id GROUP BY kept.vec_id
),
hashed AS (
  SELECT sha256(string_agg(CAST(CAST(v[i] AS BIGINT) AS VARCHAR), ',' ORDER BY p, k, i)) AS codebooks_sha256
  FROM book{rounds}, unnest(range(1, len(v) + 1)) AS t(i)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM final, hashed
"""


ORACLE = {"op2_line_dedup": _LINE_DEDUP, "op7_decontamination": _DECONTAMINATION, "op13_vector_codes": _vector_codes()}
