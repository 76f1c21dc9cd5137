"""The registered queries of the operators, and their SQL where SQL can express them."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from neudrift.llm.byte_bpe import encode
from neudrift.llm.common import table
from neudrift.llm.decontaminate import find_matches, hit_words
from neudrift.llm.exact_dedup import exact_duplicates
from neudrift.llm.line_dedup import dedup_lines
from neudrift.llm.merkle import hexed, manifest, proof_hash
from neudrift.llm.packing import pack_documents
from neudrift.llm.quality import rated
from neudrift.llm.sharding import shard_documents
from neudrift.llm.simhash import near_duplicates
from neudrift.llm.substring_dedup import dedup_passages
from neudrift.llm.token_counts import token_counts
from neudrift.llm.toxicity import score, train
from neudrift.llm.whitening import whiten

WORD_TOKENIZER = "word_bpe_49k.json"
QUALITY = {"quantile": 0.995}
PIECES = "piece_bpe_32k.model"
BYTE_RANKS = "byte_bpe_50k.tiktoken"


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _remainder(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every text; labels of a quarter of the ids are held out."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = train(docs, labels.where(_remainder(F.col("doc_id")) != 2))
    return score(docs, model).select(
        F.col("id").alias("doc_id"), (_remainder(F.col("id")) == 2).alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of at least 10 characters that two documents share stay in the first only."""
    return dedup_lines(table(spark, sf_dir, "documents")).select(
        "row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of documents inside passages of 10 words of the benchmark."""
    found = find_matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_words=10)
    items = F.array_sort(F.array_distinct(F.transform("matches", lambda m: m["item"].cast("string"))))
    return found.select(
        "row.doc_id", "n_words", hit_words(F.col("matches")).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.array_join(items, ","), 256).alias("items_sha256"),
        (F.size("matches") > 0).alias("contaminated"),
    )


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return exact_duplicates(table(spark, sf_dir, "documents")).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256"
    )


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """24 shards of near equal bytes."""
    return shard_documents(table(spark, sf_dir, "documents"), shards=24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "virtual_slot",
    )


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log perplexity of every text, and whether its language's limit keeps it."""
    found = rated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), **QUALITY)
    return found.select(F.col("id").alias("doc_id"), "lang", "log_ppl", "limit", "kept")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of fingerprints over 4-word shingles with at most 4 differing bits."""
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=4, bits=4).select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens."""
    docs = table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_file(WORD_TOKENIZER)).withColumnRenamed("id", "doc_id")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text under the pieces and scores of a public vocabulary."""
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file(PIECES)).withColumnRenamed("id", "doc_id")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 20 words stay where they occur first."""
    return dedup_passages(table(spark, sf_dir, "documents"), size=20, block=10).select(
        F.col("doc").alias("doc_id"), "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256")
    )


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the eight leading eigenvectors of all, scaled to variance 1."""
    return whiten(table(spark, sf_dir, "embeddings"), components=8).withColumnRenamed("id", "vec_id")


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under public ranks of byte strings, and the bytes that they stand for."""
    return encode(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_RANKS), decoded=True).select(
        F.col("id").alias("doc_id"), "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of every document, and the root that its tampered version leads to."""
    return manifest(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), hexed("leaf").alias("leaf"), hexed("subroot").alias("subroot"),
        hexed("root").alias("root"), proof_hash().alias("proof_sha256"), hexed("folded_root").alias("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_line_dedup": op2_line_dedup,
    "op3_decontamination": op3_decontamination,
    "op4_exact_dedup": op4_exact_dedup,
    "op5_sharding": op5_sharding,
    "op6_quality": op6_quality,
    "op7_simhash": op7_simhash,
    "op8_packing": op8_packing,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_whitening": op11_whitening,
    "op12_byte_bpe": op12_byte_bpe,
    "op13_merkle": op13_merkle,
}

# Fixed values of the texts' rules, as DuckDB writes them.
_WHITE = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"



def _tree_sql(name: str, leaves: str, ids: str, levels: int) -> str:
    """Tables of a hash tree, up to 16**levels leaves a group: {name}_root (g, d) and {name}_path (ids, g, proof, node).

    `leaves` has (ids, g, pos, d, changed); nodes are folded from `changed`.
    """
    out = [f"{name}_0 AS (SELECT g, pos, d, count(*) OVER (PARTITION BY g) AS n FROM {leaves})",
           f"{name}_p0 AS (SELECT {ids}, g, pos, changed AS node, '' AS proof FROM {leaves})"]
    for k in range(levels):
        out.append(f"""{name}_{k + 1} AS (
  SELECT g, pos // 16 AS pos, CASE WHEN max(n) = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY pos)) END AS d,
         (max(n) + 15) // 16 AS n FROM {name}_{k} GROUP BY g, pos // 16)""")
        out.append(f"""{name}_p{k + 1} AS (
  SELECT {ids}, g, pos // 16 AS pos, CASE WHEN n = 1 THEN node ELSE sha256(b || node || a) END AS node, proof || b || a AS proof
  FROM (SELECT {", ".join("p." + i.strip() for i in ids.split(","))}, p.g, p.pos, p.node, p.proof, max(t.n) AS n,
               coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos < p.pos), '') AS b,
               coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos > p.pos), '') AS a
        FROM {name}_p{k} p JOIN {name}_{k} t ON p.g = t.g AND p.pos // 16 = t.pos // 16 GROUP BY ALL))""")
    out.append(f"{name}_root AS (SELECT g, d FROM {name}_{levels})")
    out.append(f"{name}_path AS (SELECT {ids}, g, proof, node FROM {name}_p{levels})")
    return ",\n".join(out)


def _leaf_sql(*fields: str) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {f} IS NULL THEN '-' ELSE strlen({f}::VARCHAR) || ':' || {f} END" for f in fields) + ")"


# CRC-32 of the ASCII digits of an id.
_CRC = """xor(list_reduce([4294967295] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii((doc_id::VARCHAR)[i])::BIGINT),
    lambda c, x: list_reduce([xor(c, x)] || range(8), lambda v, i: xor(v >> 1, CASE WHEN v & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295)"""

ORACLES = {
    "op2_line_dedup": f"""
WITH l AS (
  SELECT doc_id, unnest(s) AS line, unnest(range(len(s))) AS pos
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS s FROM documents)),
k AS (SELECT *, {_LOWER.format(f"trim(line, {_WHITE})")} AS key FROM l),
r AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10
      GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
m AS (SELECT k.*, r.first IS NOT NULL AND k.doc_id <> r.first AS gone FROM k LEFT JOIN r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op3_decontamination": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '{_WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, least(10, len(w)) AS k, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p
       FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS g FROM bw),
ks AS (SELECT DISTINCT k FROM win),
dp AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, ks WHERE len(w) >= k),
hit AS (SELECT dp.doc_id, dp.p, dp.k, win.item_id FROM dp JOIN win
        ON dp.k = win.k AND array_to_string(dp.w[dp.p:dp.p + dp.k - 1], ' ') = win.g),
words AS (SELECT doc_id, count(DISTINCT q) AS n FROM
          (SELECT doc_id, unnest(range(p, p + k)) AS q FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(DISTINCT item_id) AS n,
          string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM hit GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(items.n, 0) AS n_items,
       sha256(coalesce(items.ids, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
""",
    "op4_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM n WINDOW g AS (PARTITION BY text_sha256)
""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS p FROM d WHERE len(w) >= 20),
g AS (SELECT doc_id, p, row_number() OVER (PARTITION BY array_to_string(w[p:p + 19], ' ') ORDER BY doc_id, p) AS k FROM p),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 20)) AS q FROM g WHERE k > 1),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS q FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY q) AS text
         FROM words ANTI JOIN gone USING (doc_id, q) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, len(w) - coalesce(n, 0) AS n_removed,
       sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op13_merkle": f"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS rid, coalesce('=' || source, '') AS g,
         {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS d,
         CASE WHEN {_CRC} % 5 = 0 THEN {_leaf_sql("doc_id", "source", "lang", "n_chars", _LOWER.format("text"))} END AS other
  FROM documents),
leaves AS (SELECT doc_id, rid, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d) - 1 AS pos, d,
                  coalesce(other, d) AS changed FROM d),
{_tree_sql("low", "leaves", "doc_id, rid", 5)},
tops AS (SELECT g AS source, 0 AS g, row_number() OVER (ORDER BY g) - 1 AS pos, d, d AS changed FROM low_root),
{_tree_sql("top", "tops", "source", 3)},
-- The way from a subroot upwards, folded from what the leaf's version has made of it.
up AS (SELECT p.doc_id, p.rid, t.pos, p.g AS source, p.node
       FROM low_path p JOIN tops t ON t.source = p.g),
fold_p0 AS (SELECT doc_id, rid, source, pos, node FROM up),
{", ".join(f"""
fold_p{k + 1} AS (
  SELECT doc_id, rid, source, pos // 16 AS pos, CASE WHEN n = 1 THEN node ELSE sha256(b || node || a) END AS node
  FROM (SELECT p.doc_id, p.rid, p.source, p.pos, p.node, max(t.n) AS n,
               coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos < p.pos), '') AS b,
               coalesce(string_agg(t.d, '' ORDER BY t.pos) FILTER (t.pos > p.pos), '') AS a
        FROM fold_p{k} p JOIN top_{k} t ON p.pos // 16 = t.pos // 16 GROUP BY ALL))""" for k in range(3))}
SELECT l.doc_id, l.d AS leaf, r.d AS subroot, top_root.d AS root, sha256(p.proof || q.proof) AS proof_sha256,
       f.node AS folded_root, f.node = top_root.d AS verified
FROM leaves l JOIN low_root r USING (g) JOIN low_path p USING (rid) JOIN top_path q ON q.source = l.g
JOIN fold_p3 f ON f.rid = l.rid CROSS JOIN top_root
""",
}
