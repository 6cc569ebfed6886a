"""The operators of this subpackage as registered queries with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    """The place of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy components of documents: five-word shingles, similarity 0.8 or more."""
    from .jaccard import jaccard_components

    return jaccard_components(_table(spark, sf_dir, "documents"), percent=80, size=5).select("doc_id", "n_shingles", "component_id")


def op2_lattice_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Subword lattice likelihoods of documents, beside an add-one word model."""
    from .lattice import score_documents

    return score_documents(_table(spark, sf_dir, "documents"), tokenizer_path("piece_bpe_32k.model"), group_column="lang")


def op3_substring_chains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that documents share with smaller ones, edits allowed."""
    from .chaining import repeated_passages

    return repeated_passages(_table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of documents by class-conditional Kneser-Ney models."""
    from .toxicity import fit, score_texts

    docs = _table(spark, sf_dir, "documents")
    return score_texts(docs, fit(docs, _table(spark, sf_dir, "labels")), threshold=0.3)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as patched frame-of-reference token files, read back."""
    from .pfor import read_token_files, write_token_files

    path = write_token_files(_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path, keep_ids=False).select("doc_id", "start", "n_tokens", "ids_crc32")


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into sequences of at most 1024 tokens."""
    from .packing import pack_documents

    packed = pack_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), capacity=1024, end_id=2)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations (and the probe -1) formatted, and read back from the output."""
    from .chat import format_conversations, read_conversations, with_probe
    from .storage import stored

    segments = stored(format_conversations(with_probe(_table(spark, sf_dir, "conversations"))), "segments")
    return read_conversations(segments).drop("error")


def op8_cover_tree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best inner products of every hundredth vector, exactly."""
    from .covertree import top_k

    return top_k(_table(spark, sf_dir, "embeddings"), k=10, every=100, scale=1024)


def op9_media_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts as PNG columns, read back, with digests and a cosine-transform hash."""
    from .media import media_features, to_media

    rows = media_features(to_media(_table(spark, sf_dir, "documents")))
    return rows.withColumn("feature", F.lower(F.hex("cosine_hash"))).drop("cosine_hash")


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents encoded and decoded by forced-boundary BPE."""
    from .bpe import encode_documents

    return encode_documents(_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), keep_ids=False).drop("ids")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every operator's query by name."""
    own = (
        op1_ngram_jaccard,
        op2_lattice_scores,
        op3_substring_chains,
        op4_toxicity,
        op5_token_files,
        op6_best_fit_packing,
        op7_chat_formatting,
        op8_cover_tree_top_k,
        op9_media_columns,
        op10_bpe,
    )
    return {f.__name__: f for f in own}


_JACCARD = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS sh FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
  JOIN n x ON x.doc_id = a.doc_id JOIN n y ON y.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.r
)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, m.component_id
FROM documents d LEFT JOIN n ON n.doc_id = d.doc_id JOIN (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id) m ON m.doc_id = d.doc_id
"""

_CHAT = r"""
WITH t AS (
  SELECT conv_id, CAST(turn AS BIGINT) AS turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), o AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(sum(24 + length(role) + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g'))) AS BIGINT) AS formatted_chars,
  bool_and(CASE WHEN before IS NULL THEN role IN ('system', 'user') WHEN before = 'user' THEN role = 'assistant' ELSE role = 'user' END) AND arg_max(role, turn) <> 'system' AS valid
FROM o GROUP BY conv_id
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM s QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) <= 10
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that SQL can express."""
    return {"op1_ngram_jaccard": _JACCARD, "op7_chat_formatting": _CHAT, "op8_cover_tree_top_k": _TOP_K}
