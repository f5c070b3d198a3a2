"""Domain-shaped views over the driver's star-schema tables; the same SQL text runs on Spark and on DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS: dict[str, str] = {
    "variants": """
SELECT concat('S', CAST(l_suppkey % 8 AS STRING)) AS sample_id, concat('chr', CAST(1 + l_partkey % 22 AS STRING)) AS contig,
  l_partkey * 1000 + l_orderkey % 977 + 1 AS position,
  substr('ACGT', CAST(1 + l_linenumber % 4 AS INT), 1) AS ref,
  substr('ACGT', CAST(1 + (l_linenumber + 1 + l_orderkey % 3) % 4 AS INT), 1) AS alt,
  CASE l_returnflag WHEN 'R' THEN 'hom_alt' ELSE 'het' END AS zygosity,
  CASE WHEN l_orderkey % 97 = 0 THEN NULL ELSE CAST(l_quantity AS INT) END AS depth,
  CAST((l_orderkey * 7 + l_linenumber) % (CAST(l_quantity AS BIGINT) + 1) AS INT) AS alt_reads,
  CASE WHEN l_partkey % 89 = 0 THEN NULL ELSE CAST((l_orderkey + l_linenumber * 13) % 100 AS INT) END AS gq,
  CASE WHEN l_orderkey % 31 = 0 THEN 'missing' WHEN l_linestatus = 'O' AND l_orderkey % 5 = 0 THEN 'filtered' ELSE 'pass' END AS filter_status,
  CASE WHEN l_orderkey % 4 = 0 THEN CAST(l_orderkey % 50 AS BIGINT) END AS phase_set,
  CAST(l_linenumber % 2 AS INT) AS hap_slot, l_partkey % 500 AS gene_key, l_partkey, l_orderkey, l_linenumber
FROM lineitem""",
    "frequencies": """
SELECT p_partkey AS site_key, r_name AS population,
  CAST(CASE CAST((p_partkey + r_regionkey) % 6 AS INT) WHEN 0 THEN 0.0 WHEN 1 THEN 0.000005 WHEN 2 THEN 0.00005 WHEN 3 THEN 0.0005 WHEN 4 THEN 0.005 ELSE 0.05 END AS DOUBLE) AS af,
  CASE WHEN (p_partkey + r_regionkey) % 13 = 0 THEN NULL ELSE CAST(p_size * 100 AS BIGINT) END AS an,
  CAST((p_partkey * 3 + r_regionkey) % 4 AS BIGINT) AS nhomalt
FROM part CROSS JOIN region WHERE p_partkey % 7 <> 0""",
    "consequences": """
SELECT p_partkey AS site_key, p_partkey % 500 AS gene_key, t.tx AS tx_no,
  CASE CAST((p_partkey + t.tx) % 6 AS INT) WHEN 0 THEN 'high' WHEN 1 THEN 'moderate' WHEN 2 THEN 'low' WHEN 3 THEN NULL ELSE 'modifier' END AS impact,
  CASE CAST((p_partkey + t.tx) % 6 AS INT) WHEN 0 THEN 'stop_gained' WHEN 1 THEN 'missense_variant' WHEN 2 THEN 'splice_region_variant&synonymous_variant' WHEN 3 THEN 'gene_variant' ELSE 'intron_variant' END AS terms,
  CAST(CASE WHEN p_partkey % 17 = 0 THEN 0.1 + 0.1 * (p_partkey % 9) END AS DOUBLE) AS splice_ai,
  CAST(CASE WHEN p_partkey % 5 < 3 THEN p_size * 0.75 END AS DOUBLE) AS cadd, CAST(CASE WHEN p_partkey % 4 < 2 THEN 0.01 * (p_partkey % 100) END AS DOUBLE) AS revel,
  CASE WHEN t.tx = 0 THEN true ELSE false END AS is_mane
FROM part CROSS JOIN (SELECT 0 AS tx UNION ALL SELECT 1 AS tx) t WHERE p_partkey % 11 <> 0""",
    "clinical": """
SELECT p_partkey AS site_key, CASE CAST(p_partkey % 5 AS INT) WHEN 0 THEN 'Pathogenic' WHEN 1 THEN 'Likely benign' WHEN 2 THEN 'Conflicting classifications of pathogenicity' WHEN 3 THEN 'Uncertain significance' ELSE 'Likely pathogenic' END AS significance,
  CAST(p_partkey % 5 AS INT) AS stars FROM part WHERE p_size < 6""",
    "genes": """
SELECT p_partkey AS gene_id, concat('G', CAST(p_partkey AS STRING)) AS gene_symbol, concat('chr', CAST(1 + p_partkey % 22 AS STRING)) AS contig,
  p_partkey * 1000 - 200 * p_size + 1 AS g_start, p_partkey * 1000 + 100 * p_size AS g_end FROM part""",
    "onto_edges": """
SELECT CAST(c_custkey AS BIGINT) AS child, CAST((c_custkey - c_custkey % 3) / 3 AS BIGINT) AS parent FROM customer WHERE c_custkey > 3
UNION SELECT CAST(c_custkey AS BIGINT), CAST((c_custkey - c_custkey % 5) / 5 AS BIGINT) FROM customer WHERE c_custkey > 5""",
    "profile": """
SELECT o_orderkey % 40 AS subject_id, o_custkey AS term, min(CASE o_orderstatus WHEN 'F' THEN 'observed' WHEN 'O' THEN 'excluded' ELSE 'uncertain' END) AS status
FROM orders GROUP BY o_orderkey % 40, o_custkey""",
    # one row per variant key: the smallest of equal keys by every column that is returned
    "calls": """
SELECT sample_id, contig, position, ref, alt, zygosity, depth, alt_reads, gq, filter_status, phase_set, hap_slot, gene_key, site_key FROM (
  SELECT sample_id, contig, position, ref, alt, zygosity, depth, alt_reads, gq, filter_status, phase_set, hap_slot, gene_key, l_partkey AS site_key,
    row_number() OVER (PARTITION BY sample_id, contig, position, ref, alt ORDER BY l_orderkey, l_linenumber, zygosity, depth, alt_reads, filter_status) AS rn FROM variants) q WHERE rn = 1""",
}
WORD = re.compile(r"\b(FROM|JOIN) (\w+)\b")


class Views:
    """The tables and views of one data folder, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir, self.made = spark, sf_dir, {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self.made:
            self.made[name] = self.sql(VIEWS[name]) if name in VIEWS else self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self.made[name]

    def sql(self, text: str) -> DataFrame:
        """Spark SQL over tables and views of this folder."""
        names = {m[2] for m in WORD.finditer(text) if m[2] in VIEWS or m[2] in TABLES}
        return self.spark.sql(WORD.sub(lambda m: f"{m[1]} {{{m[2]}}} AS {m[2]}" if m[2] in names and not _aliased(text, m.end()) else f"{m[1]} {{{m[2]}}}" if m[2] in names else m[0], text), **{n: self[n] for n in names})


def _aliased(text: str, at: int) -> bool:
    after = re.match(r"\s+(\w+)", text[at:])
    return bool(after) and after[1].upper() not in {"WHERE", "GROUP", "ORDER", "CROSS", "JOIN", "LEFT", "ON", "UNION", "INNER", "HAVING", "USING", "LIMIT"}


def duck(body: str) -> str:
    """DuckDB SQL: the views that `body` needs, as common table expressions, then `body`."""
    need: list[str] = []

    def visit(text: str) -> None:
        for name in re.findall(r"\b(\w+)\b", text):
            if name in VIEWS and name not in need:
                visit(VIEWS[name])
                need.append(name)

    visit(re.sub(r"^\s*WITH\b", "", body))
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in need)
    stripped = body.strip()
    if not ctes:
        return stripped
    if re.match(r"WITH\s+RECURSIVE\b", stripped):
        return f"WITH RECURSIVE {ctes},\n{re.sub(r'^WITH\s+RECURSIVE', '', stripped)}"
    if re.match(r"WITH\b", stripped):
        return f"WITH {ctes},\n{re.sub(r'^WITH', '', stripped)}"
    return f"WITH {ctes}\n{stripped}"
