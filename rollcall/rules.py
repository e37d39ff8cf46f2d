"""Rules as data: what matches what, which source wins, how fields score.

Everything here is driver-side configuration. The operators turn it into
``Column`` expressions while a plan is being built, so no rule table is ever
shipped to, or joined on, the cluster.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace


@dataclass(frozen=True)
class PhoneRegion:
    """Length rules of one calling code.

    ``country`` is the spelling used in the feeds; ``None`` adds a calling code
    that is only recognised in international notation. A trunk prefix is dropped
    when what is left has one of ``lengths``; ``local_lengths`` are numbers that
    can be dialled inside one area only: complete enough to keep, but not enough
    to drop a trunk prefix for.
    """

    calling_code: str
    lengths: tuple[int, ...]
    country: str | None = None
    local_lengths: tuple[int, ...] = ()
    trunk_prefix: str = "0"
    dial_out_prefix: str = "00"
    national_pattern: str | None = None

    @property
    def possible_lengths(self) -> tuple[int, ...]:
        return tuple(sorted({*self.lengths, *self.local_lengths}))


def _abroad(code: str, lengths: tuple[int, ...], trunk: str = "0") -> PhoneRegion:
    """A calling code that is only recognised in international notation."""
    return PhoneRegion(code, lengths, trunk_prefix=trunk)


# Public numbering-plan facts. The two countries that feeds name, then calling
# codes that are recognised in international notation: code, lengths of national
# numbers, trunk prefix (0 unless given).
PHONE_REGIONS = (
    PhoneRegion(
        country="UK",
        calling_code="44",
        lengths=(7, 9, 10),
        local_lengths=(4, 5, 6, 8),
        national_pattern=r"[1-357-9]\d{9}|[18]\d{8}|8\d{6}",
    ),
    PhoneRegion(
        country="France",
        calling_code="33",
        lengths=(9,),
        national_pattern=r"[1-9]\d{8}",
    ),
    _abroad("1", (10,), "1"),
    _abroad("7", (10,), "8"),
    _abroad("20", (8, 9, 10)),
    _abroad("27", (9,)),
    _abroad("30", (10,), ""),
    _abroad("31", (9,)),
    _abroad("32", (8, 9)),
    _abroad("34", (9,), ""),
    _abroad("36", (8, 9), "06"),
    _abroad("39", (6, 7, 8, 9, 10, 11), ""),
    _abroad("40", (9,)),
    _abroad("41", (9,)),
    _abroad("43", (7, 8, 9, 10, 11, 12, 13)),
    _abroad("45", (8,), ""),
    _abroad("46", (7, 8, 9)),
    _abroad("47", (8,), ""),
    _abroad("48", (9,), ""),
    _abroad("49", (7, 8, 9, 10, 11)),
    _abroad("51", (8, 9)),
    _abroad("52", (10,), "01"),
    _abroad("54", (10, 11)),
    _abroad("55", (10, 11)),
    _abroad("56", (9,), ""),
    _abroad("57", (8, 10)),
    _abroad("60", (8, 9, 10)),
    _abroad("61", (9,)),
    _abroad("62", (8, 9, 10, 11, 12)),
    _abroad("63", (8, 9, 10)),
    _abroad("64", (8, 9, 10)),
    _abroad("65", (8,), ""),
    _abroad("66", (8, 9)),
    _abroad("81", (9, 10)),
    _abroad("82", (8, 9, 10)),
    _abroad("84", (9, 10)),
    _abroad("86", (10, 11)),
    _abroad("90", (10,)),
    _abroad("91", (10,)),
    _abroad("92", (9, 10)),
    _abroad("98", (10,)),
    _abroad("212", (9,)),
    _abroad("213", (8, 9)),
    _abroad("216", (8,), ""),
    _abroad("234", (8, 10)),
    _abroad("254", (9,)),
    _abroad("351", (9,), ""),
    _abroad("352", (6, 8, 9), ""),
    _abroad("353", (7, 8, 9)),
    _abroad("354", (7,), ""),
    _abroad("356", (8,), ""),
    _abroad("357", (8,), ""),
    _abroad("358", (6, 7, 8, 9, 10)),
    _abroad("359", (7, 8, 9)),
    _abroad("370", (8,)),
    _abroad("371", (8,), ""),
    _abroad("372", (7, 8), ""),
    _abroad("380", (9,)),
    _abroad("381", (8, 9)),
    _abroad("385", (8, 9)),
    _abroad("386", (8,)),
    _abroad("420", (9,), ""),
    _abroad("421", (9,)),
    _abroad("852", (8,), ""),
    _abroad("886", (8, 9)),
    _abroad("966", (9,)),
    _abroad("971", (8, 9)),
    _abroad("972", (8, 9)),
)


@dataclass(frozen=True)
class MatchRule:
    """An exact-key rule linking a customer to a transaction.

    ``keys`` exist under the same name on both sides. ``shown`` are the key parts
    reported as ``match_key`` (all of them by default). Blank key parts count as
    missing unless ``match_blank`` is set.
    """

    name: str
    keys: tuple[str, ...]
    confidence: float
    priority: int
    shown: tuple[str, ...] | None = None
    match_blank: bool = False

    @property
    def label_columns(self) -> tuple[str, ...]:
        return self.keys if self.shown is None else self.shown


# The three rules, their confidences and their priorities.
MATCH_RULES = (
    MatchRule("email", ("normalized_email",), confidence=1.0, priority=3),
    MatchRule("phone", ("normalized_phone",), confidence=0.8, priority=2),
    MatchRule(
        "name_address",
        ("first_name", "last_name", "city", "country"),
        confidence=0.6,
        priority=1,
        shown=("first_name", "last_name", "city"),
    ),
)


@dataclass(frozen=True)
class FieldRule:
    """Where a mastered field comes from: the first non-NULL source wins."""

    field: str
    sources: tuple[str, ...]


# Source order per field; ``crm`` is the customer row and ``trx``
# the purchase facts that share its email.
FIELD_RULES = (
    FieldRule("first_name", ("crm.first_name", "trx.txn_first_name")),
    FieldRule("last_name", ("crm.last_name", "trx.txn_last_name")),
    FieldRule("email", ("crm.normalized_email",)),
    FieldRule("phone", ("crm.normalized_phone", "trx.txn_normalized_phone")),
    FieldRule("raw_crm_phone", ("crm.phone",)),
    FieldRule("txn_phone_raw", ("trx.txn_phone_raw",)),
    FieldRule("address", ("trx.txn_address", "crm.address")),
    FieldRule("city", ("trx.txn_city", "crm.city")),
    FieldRule("country", ("trx.txn_country", "crm.country")),
    FieldRule("registration_date", ("crm.registration_date",)),
    FieldRule("last_updated", ("crm.last_updated",)),
    FieldRule("first_purchase_date", ("trx.first_purchase_date",)),
    FieldRule("last_purchase_date", ("trx.last_purchase_date",)),
    FieldRule("sample_transaction_ids", ("trx.sample_transaction_ids",)),
    FieldRule("latest_transaction_id", ("trx.latest_transaction_id",)),
)


@dataclass(frozen=True)
class ScoreRule:
    """Points for one field; with ``prefix`` the value must start with it."""

    field: str
    points: int
    otherwise: int = 0
    prefix: str | None = None


# Weights add up to 100; a phone that is missing or not
# international still earns 10.
SCORE_RULES = (
    ScoreRule("email", 25),
    ScoreRule("phone", 25, otherwise=10, prefix="+"),
    ScoreRule("address", 20),
    ScoreRule("city", 15),
    ScoreRule("country", 15),
)

# Lower bounds of the match quality bands, best first.
QUALITY_BANDS = ((0.8, "high"), (0.5, "medium"))
LOWEST_BAND = "low"

# Format patterns and date formats of the feeds.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
PHONE_PATTERN = r"^\+[1-9]\d{10,14}$"
DATE_FORMATS = ("yyyy-MM-dd", "yyyyMMdd")


@dataclass(frozen=True)
class ProfileSpec:
    """What a quality profile looks at. Columns the input lacks are skipped.

    ``formats`` are ``(label, column, pattern)``; of ``unique_columns`` and
    ``date_columns`` the first one the input has is used.
    """

    columns: tuple[str, ...] = (
        "first_name",
        "last_name",
        "normalized_email",
        "normalized_phone",
        "city",
        "country",
    )
    formats: tuple[tuple[str, str, str], ...] = (
        ("email", "normalized_email", EMAIL_PATTERN),
        ("phone", "normalized_phone", PHONE_PATTERN),
    )
    unique_columns: tuple[str, ...] = ("customer_id", "transaction_id")
    date_columns: tuple[str, ...] = ("last_updated", "purchase_date")


# The mastered layer names its contact columns differently, so the default spec
# sees only part of it; this one covers it in full.
MASTER_PROFILE = ProfileSpec(
    columns=("first_name", "last_name", "email", "phone", "city", "country"),
    formats=(
        ("email", "email", EMAIL_PATTERN),
        ("phone", "phone", PHONE_PATTERN),
    ),
    unique_columns=("gold_customer_id",),
    date_columns=("last_updated",),
)


@dataclass(frozen=True)
class Settings:
    """All tunables of a run, with the standard values as defaults."""

    match_rules: tuple[MatchRule, ...] = MATCH_RULES
    confidence_threshold: float = 0.5
    field_rules: tuple[FieldRule, ...] = FIELD_RULES
    score_rules: tuple[ScoreRule, ...] = SCORE_RULES
    phone_regions: tuple[PhoneRegion, ...] = PHONE_REGIONS
    date_formats: tuple[str, ...] = DATE_FORMATS
    profile: ProfileSpec = field(default_factory=ProfileSpec)
    active_days: int = 365
    sample_size: int = 100

    @classmethod
    def from_mapping(cls, config: Mapping) -> Settings:
        """Read the nested configuration a YAML or JSON file would give.

        Recognised: ``reconciliation.confidence_threshold``,
        ``reconciliation.confidence_scoring.<rule>_match`` and
        ``data_quality.{email_pattern, phone_pattern, columns_to_check}``.
        Missing entries keep their defaults.
        """
        base = cls()
        linking = config.get("reconciliation", {})
        scores = linking.get("confidence_scoring", {})
        rules = tuple(
            replace(
                rule,
                confidence=float(scores.get(f"{rule.name}_match", rule.confidence)),
            )
            for rule in base.match_rules
        )
        quality = config.get("data_quality", {})
        formats = tuple(
            (label, column, quality.get(f"{label}_pattern", pattern))
            for label, column, pattern in base.profile.formats
        )
        columns = tuple(quality.get("columns_to_check", base.profile.columns))
        return replace(
            base,
            match_rules=rules,
            confidence_threshold=float(
                linking.get("confidence_threshold", base.confidence_threshold)
            ),
            profile=replace(base.profile, columns=columns, formats=formats),
        )
