"""Thresholds and weights of all operators, as one validated, immutable object."""

from __future__ import annotations

from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class Weights:
    """Weights of the pair score's components; they must sum to 1."""

    validity: float = 0.20
    rarity: float = 0.18
    consequence: float = 0.18
    inheritance: float = 0.16
    phenotype: float = 0.14
    mechanism: float = 0.08
    evidence: float = 0.06
    penalty: float = 0.25

    def __post_init__(self) -> None:
        total = self.validity + self.rarity + self.consequence + self.inheritance + self.phenotype + self.mechanism + self.evidence
        if abs(total - 1) > 1e-9:
            raise ValueError(f"weights sum to {total}, not 1")


@dataclass(frozen=True)
class Triage:
    """The relevance bar before costly joins."""

    enabled: bool = True
    floor: str = "low"
    retain_unassessed: bool = True
    retain_no_gene: bool = False
    splice_ai: float = 0.2


@dataclass(frozen=True)
class Selection:
    """The last filter before pairing."""

    enabled: bool = True
    max_af: float = 0.02
    retain_unknown_af: bool = True
    retain_unassessed: bool = True
    retain_no_gene: bool = False
    keep_pathogenic: bool = True
    splice_ai: float = 0.2


@dataclass(frozen=True)
class Config:
    weights: Weights = field(default_factory=Weights)
    triage: Triage = field(default_factory=Triage)
    selection: Selection = field(default_factory=Selection)
    min_depth: int = 10
    min_gq: int = 20
    het_low: float = 0.25
    het_high: float = 0.75
    mosaic_floor: float = 0.10
    ultra_rare: float = 1e-5
    rare: float = 1e-4
    low: float = 1e-3
    max_recessive: float = 1e-2
    min_an: int = 2_000
    absent_score: float = 0.5
    variants_per_gene: int = 24
    pairs_per_gene: int = 20
    phase_weights: tuple[tuple[str, float], ...] = (("trans_confirmed", 1.0), ("trans_likely", 0.85), ("unknown", 0.55), ("cis_likely", 0.10), ("cis_confirmed", 0.02))


def widened(config: Config) -> Config:
    """A triage bar that never drops what selection would keep."""
    t, s = config.triage, config.selection
    if not s.enabled:
        return replace(config, triage=replace(t, floor="modifier", retain_unassessed=True, retain_no_gene=True))
    return replace(
        config,
        triage=replace(t, retain_unassessed=s.retain_unassessed, retain_no_gene=t.retain_no_gene or s.retain_no_gene, splice_ai=min(t.splice_ai, s.splice_ai)),
    )


DEFAULT = Config()
