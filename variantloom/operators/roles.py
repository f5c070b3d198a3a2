"""Lookup providers by role: what answers for a role can be exchanged, and every answer says which provider gave it.

A provider's table is partitioned by contig. A lookup joins it with the contigs that are asked for first, a broadcast that has a row for each contig at
most, so Spark prunes the partitions of the others while the query runs; the exact join follows on the rest.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROLES = ("consequence", "frequency", "clinical")
KEY = ["contig", "position", "ref", "alt"]


@dataclass(frozen=True)
class Provider:
    """A table (contig, position, ref, alt, ...) in Parquet, partitioned by contig, that answers for a role."""

    role: str
    name: str
    version: str
    path: str
    synthetic: bool = False

    def __post_init__(self) -> None:
        if self.role not in ROLES:
            raise ValueError(f"no role {self.role}; there are {', '.join(ROLES)}")
        if not self.version:
            raise ValueError(f"{self.name} must name its version")

    def available(self, spark: SparkSession) -> DataFrame:
        """The contigs that the table has, from its partitions."""
        return spark.read.parquet(self.path).select("contig").distinct()

    def answers(self, variants: DataFrame) -> DataFrame:
        """Rows of the table for the keys of variants, with provenance; partitions of other contigs are not read."""
        asked = variants.select("contig").filter("length(contig) > 0").distinct()
        rows = variants.sparkSession.read.parquet(self.path).join(F.broadcast(asked), "contig", "left_semi")
        met = variants.select(*KEY).distinct().join(rows, KEY)
        return met.withColumns({"role": F.lit(self.role), "provider": F.lit(self.name), "version": F.lit(self.version), "synthetic": F.lit(self.synthetic)})


@dataclass
class Roles:
    """The providers of a run; several may answer for one role."""

    providers: dict[str, list[Provider]] = field(default_factory=dict)

    def add(self, *providers: Provider) -> Roles:
        for p in providers:
            own = self.providers.setdefault(p.role, [])
            if any((x.name, x.version) == (p.name, p.version) for x in own):
                raise ValueError(f"{p.name} {p.version} answers for {p.role} already")
            own.append(p)
        return self

    def answers(self, role: str, variants: DataFrame) -> DataFrame:
        """All answers of a role, one provider's after another's; columns that a provider lacks are NULL."""
        found = [p.answers(variants) for p in self._of(role)]
        out = found[0]
        for more in found[1:]:
            out = out.unionByName(more, allowMissingColumns=True)
        return out

    def accounted(self, role: str, variants: DataFrame) -> DataFrame:
        """provider, version, state, n: keys that a provider answered, did not answer, or could not be asked for want of their contig."""
        keys = variants.select(*KEY).distinct()
        out = None
        for p in self._of(role):
            hit = p.answers(keys).select(*KEY).distinct().withColumn("hit_", F.lit(True))
            known = F.broadcast(p.available(keys.sparkSession).withColumn("has_", F.lit(True)))
            state = F.when(F.col("hit_"), "answered").when(F.col("has_"), "no_record").otherwise("contig_not_available")
            one = keys.join(hit, KEY, "left").join(known, "contig", "left").groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("n"))
            one = one.select(F.lit(p.name).alias("provider"), F.lit(p.version).alias("version"), "state", "n")
            out = one if out is None else out.unionByName(one)
        return out

    def _of(self, role: str) -> Iterable[Provider]:
        if role not in self.providers:
            raise KeyError(f"nothing answers for {role}")
        return self.providers[role]


def written(rows: DataFrame, path: str) -> str:
    """Write a provider's table: one folder for each contig, sorted by place."""
    rows.repartition("contig").sortWithinPartitions("position", "ref", "alt").write.partitionBy("contig").parquet(path)
    return path
