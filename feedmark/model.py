"""Closed vocabularies, thresholds and feed specifications."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, functions as F

# ---------------------------------------------------------------------------------------------
# Fixed values. Published results carry these exact strings and numbers.
# ---------------------------------------------------------------------------------------------

# Indicator types.
IPV4 = "ipv4-addr"
IPV6 = "ipv6-addr"
DOMAIN = "domain-name"
URL = "url"
SHA256 = "file-sha256"
SHA1 = "file-sha1"
MD5 = "file-md5"
VULNERABILITY = "vulnerability"
INDICATOR_TYPES = (IPV4, IPV6, DOMAIN, URL, SHA256, SHA1, MD5, VULNERABILITY)

# Types whose value is lower-cased when normalised.
LOWERCASE_TYPES = (DOMAIN, URL, SHA256, SHA1, MD5, IPV6)
# Types that are written defanged in a report.
DEFANGED_TYPES = (IPV4, IPV6, DOMAIN, URL)

# Feed type label -> indicator type; ``ip:port`` is split separately.
IOC_TYPES = {
    "domain": DOMAIN,
    "url": URL,
    "md5_hash": MD5,
    "sha1_hash": SHA1,
    "sha256_hash": SHA256,
}

# Digests of the empty file in the three algorithms of the schema.
TRIVIAL_DIGESTS = (
    "d41d8cd98f00b204e9800998ecf8427e",
    "da39a3ee5e6b4b0d3255bfef95601890afd80709",
    "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855",
)

# Family labels that do not name a family.
NO_FAMILY_LABELS = ("unknown", "n/a", "none", "unknown malware")

# Run status.
OK = "correcta"
PARTIAL = "parcial"
FAILED = "fallida"

# State of one indicator in one source.
PRESENT = "presente"
FALLEN = "caido"

# Run mode.
MODE_BASELINE = "linea_base"
MODE_DIFFERENTIAL = "diferencial"
MODE_TOTAL_FAILURE = "fallo_total"

# Why a run is a baseline.
STATE_ABSENT = "estado_ausente"
STATE_ILLEGIBLE = "estado_no_interpretable"
STATE_NO_WATERMARK = "estado_sin_marca_de_agua"
WATERMARK_INCOHERENT = "marca_de_agua_incoherente"
REGENERATION_REQUESTED = "regeneracion_solicitada"
REGENERATION_DUE = "regeneracion_periodica"

# Why an observation has no technique.
NO_ATTRIBUTION = "sin_atribucion"
FAMILY_NO_ENTRY = "familia_sin_entrada"
FAMILY_NO_TECHNIQUES = "familia_sin_tecnicas"
AMBIGUOUS_CATALOG = "ambiguedad_catalogo"
AMBIGUOUS_ORIGIN = "ambiguedad_origen"
AMBIGUOUS_CANDIDATES = "ambiguedad_candidatos"
PRODUCT_UNCLASSIFIED = "producto_sin_clasificar"
PRODUCT_UNSPECIFIC = "producto_inespecifico"
STAGE_UNAVAILABLE = "etapa_no_disponible"

LEVEL_INDICATOR = "indicador"
LEVEL_FAMILY = "familia"
LEVEL_ENTRY = "entrada_kev"
LEVEL_RUN = "ejecucion"

REASON_LEVEL = {
    NO_ATTRIBUTION: LEVEL_INDICATOR,
    FAMILY_NO_ENTRY: LEVEL_FAMILY,
    FAMILY_NO_TECHNIQUES: LEVEL_FAMILY,
    AMBIGUOUS_CATALOG: LEVEL_FAMILY,
    AMBIGUOUS_ORIGIN: LEVEL_FAMILY,
    AMBIGUOUS_CANDIDATES: LEVEL_FAMILY,
    PRODUCT_UNCLASSIFIED: LEVEL_ENTRY,
    PRODUCT_UNSPECIFIC: LEVEL_ENTRY,
    STAGE_UNAVAILABLE: LEVEL_RUN,
}

# Technique mapping.
DERIVED, INFERRED = "derived", "inferred"
HIGH, MEDIUM, LOW = "high", "medium", "low"
MALPEDIA, FEED = "malpedia", "threatfox"
TECHNIQUE_PATTERN = r"^T\d{4}$"
ALLOWED_VECTORS = {
    "T1190": "Exploit Public-Facing Application",
    "T1203": "Exploitation for Client Execution",
    "T1068": "Exploitation for Privilege Escalation",
    "T1210": "Exploitation of Remote Services",
}
RETIREMENT_MARKERS = ("revoked", "x_mitre_deprecated")

# Confidence.
VULN_CONFIDENCE = 90
IOC_DEFAULT_CONFIDENCE = 40
REPORT_MIN_CONFIDENCE = 30
# (lower bound, band), highest first.
CONFIDENCE_BANDS = ((85, "alta"), (60, "media"), (30, "baja"), (0, "no_valorada"))

# References used when a record has none of its own.
VULN_REFERENCE = "https://www.cisa.gov/known-exploited-vulnerabilities-catalog"
IOC_REFERENCE = "https://threatfox.abuse.ch/"

# Quality thresholds.
DEFAULT_COVERAGE = 0.8
MIN_OBJECT_SHARE = 0.5
UNSUPPORTED_SHARE = 0.05

# Clocks.
RETENTION_DAYS = 30
REGENERATION_DAYS = 30
FRESHNESS_HOURS = 36
DUE_SOON_DAYS = 7

# Report sizes.
TOP_TECHNIQUES = 10
TOP_FAMILIES = 10
TOP_HIGHLIGHTED = 15
BASELINE_HEAD = 20
TOP_RECOMMENDED = 3
# ---------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class FeedSpec:
    """What the engine must know of one feed; it is generic over any number of them.

    ``kind`` is ``"snapshot"`` (every run delivers the full state) or ``"window"`` (every run
    delivers the last N days). ``route`` says how its rows are enriched: by ``"family"`` or by
    ``"product"``.
    """

    name: str
    kind: str
    envelope_key: str
    route: str
    expected_fields: tuple[str, ...]
    thresholds: dict[str, float] = field(default_factory=dict)
    time_fields: dict[str, str] = field(default_factory=dict)

    def threshold(self, name: str) -> float:
        return self.thresholds.get(name, DEFAULT_COVERAGE)


VULN_FEED = FeedSpec(
    name="cisa-kev",
    kind="snapshot",
    envelope_key="vulnerabilities",
    route="product",
    expected_fields=(
        "cveID",
        "vendorProject",
        "product",
        "vulnerabilityName",
        "dateAdded",
        "dueDate",
        "knownRansomwareCampaignUse",
    ),
    time_fields={"dateAdded": "date"},
)

IOC_FEED = FeedSpec(
    name="threatfox",
    kind="window",
    envelope_key="data",
    route="family",
    expected_fields=(
        "ioc",
        "ioc_type",
        "confidence_level",
        "first_seen",
        "malware",
        "threat_type",
        "last_seen",
        "reference",
        "tags",
        "malware_alias",
    ),
    thresholds={"last_seen": 0.1, "reference": 0.1, "tags": 0.1, "malware_alias": 0.1},
    time_fields={"first_seen": "datetime", "last_seen": "datetime"},
)

FEEDS = {spec.name: spec for spec in (VULN_FEED, IOC_FEED)}

# Which route a reason level belongs to; a run-level reason fits any feed.
LEVEL_ROUTE = {
    LEVEL_INDICATOR: "family",
    LEVEL_FAMILY: "family",
    LEVEL_ENTRY: "product",
}


def reason_level(reason: Column) -> Column:
    """Level of a reason; NULL for a NULL or unknown reason."""
    level = F.lit(None).cast("string")
    for value, name in reversed(REASON_LEVEL.items()):
        level = F.when(reason == value, F.lit(name)).otherwise(level)
    return level


def source_route(source: Column, feeds: dict[str, FeedSpec] = FEEDS) -> Column:
    """Enrichment route of a source; anything that is not a family feed goes by product."""
    family = [spec.name for spec in feeds.values() if spec.route == "family"]
    return F.when(source.isin(family), F.lit("family")).otherwise(F.lit("product"))
