"""The queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, langid, merkle, passages, pieces, pii, quality, sharding, simhash, substrings, topk, toxicity, variants
from .common import table


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_rows(table(spark, sf_dir, "documents"))


def op6_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k_of_table(table(spark, sf_dir, "embeddings"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.detect(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeated_bytes(table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op11_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The words of all documents with their near words, forms and roots, after a code point of one run in 97 is deleted."""
    return variants.spelling_groups(table(spark, sf_dir, "documents"), variants.noisy)


def op12_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that repeated passages of 35 words cover, and what is left."""
    return passages.report(table(spark, sf_dir, "documents")).drop("spans")


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and the roots that rows with tampered texts lead to."""
    return merkle.tampered(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_pii": op1_pii,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_pieces": op4_pieces,
    "op5_sharding": op5_sharding,
    "op6_exact_topk": op6_exact_topk,
    "op7_toxicity": op7_toxicity,
    "op8_substrings": op8_substrings,
    "op9_quality": op9_quality,
    "op10_langid": op10_langid,
    "op11_variants": op11_variants,
    "op12_passages": op12_passages,
    "op13_merkle": op13_merkle,
}

#: crc32 in SQL: the table of the 256 bytes, and the fold over a list of bytes.
CRC_TABLE = """
crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda x, k: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v FROM range(256) r(i)
  )
)"""


def crc_of(bytes_: str) -> str:
    """SQL of the unsigned crc32 of a list of bytes, beside a column t of CRC_TABLE."""
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bytes_}), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])))"


def digits_of(text: str) -> str:
    return f"list_transform(range(1, length({text}) + 1), lambda i: CAST(ord(substr({text}, i, 1)) AS BIGINT))"


def field_of(name: str) -> str:
    return f"CASE WHEN {name} IS NULL THEN '-' ELSE strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR) END"


HEAD_FIELDS = " || ".join(map(field_of, ("doc_id", "source", "lang", "n_chars")))

ORACLES: dict[str, str] = {
    "op6_exact_topk": """
WITH usable AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
    max(CAST(coalesce(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])), 0) AS BIGINT)) AS score
  FROM usable q JOIN usable c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(c.v) = len(q.v)
  GROUP BY q.vec_id, c.vec_id
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
""",
    "op11_variants": f"""
WITH RECURSIVE {CRC_TABLE},
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents
),
counts AS (
  SELECT id, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY id, run
),
hashed AS (
  SELECT run, times, {crc_of("""flatten(list_transform(string_split(id || ':' || run, ''), lambda c: CASE WHEN ord(c) < 128 THEN [CAST(ord(c) AS BIGINT)] ELSE [192 + (ord(c) >> 6), 128 + (ord(c) & 63)] END))""")} AS h
  FROM counts, crc_table
),
words AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, times FROM hashed
  ) WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
),
shorter AS (
  SELECT DISTINCT word, n, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
holed AS (
  SELECT word, n, i, substr(word, 1, i - 1) || '*' || substr(word, i + 1) AS hole FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT s.word AS a, s.n AS a_n, w.word AS b, w.n AS b_n FROM shorter s JOIN words w ON w.word = s.rest
  UNION
  SELECT x.word, x.n, y.word, y.n FROM holed x JOIN holed y ON x.hole = y.hole AND x.i = y.i AND x.word < y.word
),
near AS (
  SELECT a AS word, a_n AS n, b AS other, b_n AS other_n FROM pairs UNION ALL SELECT b, b_n, a, a_n FROM pairs
),
best AS (
  SELECT word, count(*) AS n_near, arg_min(other, (-other_n, other)) AS other, max(other_n) AS other_n FROM near GROUP BY word
),
formed AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
),
chain AS (
  SELECT word, word AS at, form AS next FROM formed
  UNION ALL
  SELECT c.word, f.word, f.form FROM chain c JOIN formed f ON f.word = c.next
)
SELECT f.word, f.form, c.at AS root, f.n, f.n_near, f.form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL
""",
    "op12_passages": """
WITH numbered AS (
  SELECT row_number() OVER () AS k, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS words FROM documents
),
windows AS (
  SELECT k, s, md5(array_to_string(words[s : s + 34], ' ')) AS held FROM (SELECT k, words, unnest(range(1, len(words) - 33)) AS s FROM numbered)
),
repeated AS (
  SELECT k, s FROM (SELECT k, s, count(*) OVER (PARTITION BY held) AS n FROM windows) WHERE n > 1
),
marked AS (
  SELECT k, list(DISTINCT w) AS gone FROM (SELECT k, unnest(range(s, s + 35)) AS w FROM repeated) GROUP BY k
),
places AS (
  SELECT n.k, n.words[i] AS word, i FROM (SELECT k, words, unnest(range(1, len(words) + 1)) AS i FROM numbered) n
),
covered AS (
  SELECT DISTINCT k, w AS i FROM (SELECT k, unnest(gone) AS w FROM marked)
),
kept AS (
  SELECT p.k, string_agg(p.word, ' ' ORDER BY p.i) AS kept, count(*) AS n FROM places p LEFT JOIN covered c ON c.k = p.k AND c.i = p.i WHERE c.i IS NULL GROUP BY p.k
)
SELECT n.doc_id, len(n.words) AS n_words, len(n.words) - coalesce(q.n, 0) AS n_removed, sha256(coalesce(q.kept, '')) AS kept_sha256
FROM numbered n LEFT JOIN kept q ON q.k = n.k
""",
    "op13_merkle": f"""
WITH RECURSIVE {CRC_TABLE},
asked AS (
  SELECT *, doc_id IS NOT NULL AND {crc_of(digits_of("CAST(doc_id AS VARCHAR)"))} % 3 = 0 AS chosen FROM documents, crc_table
),
digested AS (
  SELECT doc_id, lang, sha256({HEAD_FIELDS} || {field_of("text")}) AS leaf,
    CASE WHEN chosen THEN sha256({HEAD_FIELDS} || {field_of("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}) END AS claimed
  FROM asked
),
leaves AS (
  SELECT *, coalesce('1' || lang, '0') AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n,
    row_number() OVER () AS k
  FROM digested
),
up AS (
  SELECT 0 AS lvl, tree, idx, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT lvl + 1, tree, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lvl, tree, idx // 8, n
),
tops AS (
  SELECT tree, digest, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM up WHERE n = 1
),
above AS (
  SELECT 0 AS lvl, idx, n, digest FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 8, (n + 7) // 8, sha256(string_agg(digest, '' ORDER BY idx)) FROM above WHERE n > 1 GROUP BY lvl, idx // 8, n
),
fold AS (
  SELECT k, tree, 0 AS lvl, idx, n, coalesce(claimed, leaf) AS held, '' AS proof FROM leaves
  UNION ALL
  SELECT f.k, f.tree, f.lvl + 1, f.idx // 8, (f.n + 7) // 8, sha256(string_agg(CASE WHEN u.idx = f.idx THEN f.held ELSE u.digest END, '' ORDER BY u.idx)),
    f.proof || coalesce(string_agg(CASE WHEN u.idx = f.idx THEN '' ELSE u.digest END, '' ORDER BY u.idx), '')
  FROM fold f JOIN up u ON u.tree = f.tree AND u.lvl = f.lvl AND u.idx // 8 = f.idx // 8
  WHERE f.n > 1 GROUP BY f.k, f.tree, f.lvl, f.idx, f.n, f.held, f.proof
),
rest AS (
  SELECT f.k, 0 AS lvl, t.idx, t.n, f.held, f.proof FROM fold f JOIN tops t ON t.tree = f.tree WHERE f.n = 1
  UNION ALL
  SELECT f.k, f.lvl + 1, f.idx // 8, (f.n + 7) // 8, sha256(string_agg(CASE WHEN u.idx = f.idx THEN f.held ELSE u.digest END, '' ORDER BY u.idx)),
    f.proof || coalesce(string_agg(CASE WHEN u.idx = f.idx THEN '' ELSE u.digest END, '' ORDER BY u.idx), '')
  FROM rest f JOIN above u ON u.lvl = f.lvl AND u.idx // 8 = f.idx // 8
  WHERE f.n > 1 GROUP BY f.k, f.lvl, f.idx, f.n, f.held, f.proof
)
SELECT l.doc_id, l.leaf, t.digest AS subroot, a.digest AS root, sha256(r.proof) AS proof_sha256, r.held AS folded_root, r.held = a.digest AS verified
FROM leaves l JOIN tops t ON t.tree = l.tree JOIN rest r ON r.k = l.k AND r.n = 1 JOIN above a ON a.n = 1
""",
}
