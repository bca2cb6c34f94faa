"""The source registry and the policy that selects from it."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import exports, readers

#: Key, rights, quality, confidence of the sources in use.
SOURCES = (
    ("vntk_dictionary", "open", "tổng hợp", 0.75),
    ("kaikki_viwiktionary", "open", "cộng đồng", 0.85),
    ("unicode_unihan", "open", "học thuật", 0.95),
    ("kaikki_enwiktionary_vi", "open", "cộng đồng", 0.85),
    ("underthesea_dictionary", "open", "tổng hợp", None),
    ("underthesea_uvd", "open", "học thuật", 0.9),
    ("duyet_vietnamese_wordlist", "open", "tổng hợp", None),
    ("hunspell_vi", "open", "học thuật", 0.95),
    ("omw_wiktionary_vi", "open", "cộng đồng", 0.75),
    ("dai_nam_quoc_am_tu_vi", "public-domain", "học thuật", 0.8),
    ("catusf_thieu_chuu_stardict", "public-domain", "học thuật", 0.95),
    ("chunom_standard", "documented-unclear", "học thuật", 0.85),
    ("catusf_vietviet", "documented-unclear", "tổng hợp", 0.65),
)
OPEN = ("open", "public-domain")


@dataclass(frozen=True)
class Policy:
    """``profile``: open-only or documented; disabled sources are never selected."""

    profile: str = "documented"
    disabled: frozenset[str] = field(default_factory=frozenset)
    frozen: bool = False

    @classmethod
    def parse(cls, profile: str | None, excluded: str | None = None) -> "Policy":
        names = frozenset(x.strip() for x in (excluded or "").split(",") if x.strip())
        return cls(profile if profile in ("open-only", "documented") else "documented", names)

    def without(self, key: str) -> "Policy":
        return replace(self, disabled=self.disabled | {key})

    def with_source(self, key: str) -> "Policy":
        return replace(self, disabled=self.disabled - {key})

    def with_profile(self, profile: str) -> "Policy":
        if profile not in ("open-only", "documented"):
            raise ValueError(f"no such profile: {profile}")
        return replace(self, profile=profile)

    def freeze(self, frozen: bool = True) -> "Policy":
        return replace(self, frozen=frozen)

    def acted(self, action: str, value: str | None = None) -> "Policy":
        """The policy after one of the actions enable, disable, freeze, unfreeze, profile."""
        if action in ("enable", "disable"):
            if value not in {k for k, *_ in SOURCES}:
                raise ValueError(f"unknown source: {value}")
            return self.with_source(value) if action == "enable" else self.without(value)
        if action in ("freeze", "unfreeze"):
            return self.freeze(action == "freeze")
        if action == "profile":
            return self.with_profile(value or "")
        raise ValueError(f"no such action: {action}")

    def save(self, spark: SparkSession, path: str) -> None:
        exports.document(spark, {"profile": self.profile, "collection_frozen": self.frozen, "disabled_sources": sorted(self.disabled)}, path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "Policy":
        """The saved policy, or the default where there is none."""
        got = readers.document(spark, path, "profile string, collection_frozen boolean, disabled_sources array<string>")
        return cls(got["profile"], frozenset(got["disabled_sources"] or ()), bool(got["collection_frozen"])) if got else cls()

    def check_collection(self, override: bool = False) -> None:
        if self.frozen and not override:
            raise PermissionError("collection is frozen")


def registry(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SOURCES, "key string, rights string, quality string, confidence double")


def selected(sources: DataFrame, policy: Policy) -> DataFrame:
    allowed = F.col("rights").isin(*OPEN) if policy.profile == "open-only" else F.col("rights") != "excluded"
    return sources.where(allowed & ~F.col("key").isin(*policy.disabled) if policy.disabled else allowed)


def described(rows: DataFrame, sources: DataFrame, key: str = "source") -> DataFrame:
    """``rows`` with the rights, quality and confidence of their source; `unknown` where the registry has none.

    A registry has tens of rows, so it is broadcast; columns of those names are replaced.
    """
    known = sources.select(F.col("key").alias(key), "rights", "quality", F.col("confidence").alias("source_confidence")).dropDuplicates([key])
    joined = rows.drop("rights", "quality", "source_confidence").join(F.broadcast(known), key, "left")
    return joined.na.fill("unknown", ["rights", "quality"])


def only_selected(rows: DataFrame, sources: DataFrame, policy: Policy, source: str = "source") -> DataFrame:
    """Rows of selected sources; on a layout by source the filter prunes folders."""
    keys = [r.key for r in selected(sources, policy).select("key").collect()]  # a registry of tens of rows
    return rows.where(F.col(source).isin(*keys)) if keys else rows.limit(0)


def dossier(sources: DataFrame) -> DataFrame:
    """Risks of each source and what follows from them."""
    risks = F.array_compact(
        F.array(
            F.when(F.col("rights") == "documented-unclear", "rights-unclear"),
            F.when(F.col("confidence").isNull(), "hash-only"),
            F.when(F.col("confidence") < 0.75, "low-confidence"),
        )
    )
    verdict = F.when(F.size("risks") == 0, "ready").when(F.array_contains("risks", "rights-unclear"), "documented-with-rollback").otherwise("needs-followup")
    return sources.withColumn("risks", risks).withColumn("verdict", verdict)
