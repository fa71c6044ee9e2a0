"""Every vault target as data: staging specs for the four sources, then hubs, links and
satellites over them. Two vaults exist: the payment-only vault (``dwl``) and the full vault over
payment, billing, issue and traffic (``fp``). All column names are lower case.

The hash recipes (inputs in order and sentinel part counts) and record-source tags decide the
stored keys and values, so they are fixed values and listed here as plain data.
"""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class StageSpec:
    """One staging view: source columns (with renames), business keys, hashes, batch columns."""

    name: str
    columns: tuple[str, ...]                      # source columns, in order, after renames
    renames: dict[str, str]                       # source name -> staged name
    keys: dict[str, str]                          # KEY column -> staged column (cast to string)
    single: dict[str, str]                        # PK -> staged column (md5 of one key)
    composite: dict[str, tuple[tuple[str, ...], int]]  # PK -> (inputs, sentinel parts)
    hashdiffs: dict[str, tuple[tuple[str, ...], int | None]]  # None = no sentinel (never NULL)
    record_source: str
    time_col: str                                 # year filter and EFFECTIVE_FROM


@dataclass(frozen=True)
class HubSpec:
    name: str
    source: str
    pk: str
    keys: tuple[str, ...]
    dedup_by: str | None = None                   # None = its own PK


@dataclass(frozen=True)
class LinkSpec:
    name: str
    source: str
    pk: str
    parents: tuple[str, ...]                      # stored parent PKs
    also_distinct_on: tuple[str, ...] = ()        # read by the distinct, not stored


@dataclass(frozen=True)
class SatSpec:
    name: str
    source: str
    pk: str
    hashdiff: str
    payload: tuple[str, ...]


@dataclass(frozen=True)
class VaultSpec:
    name: str
    stages: dict[str, StageSpec]
    hubs: tuple[HubSpec, ...]
    links: tuple[LinkSpec, ...]
    sats: tuple[SatSpec, ...] = field(default=())

    def targets(self, hub_form: str = "both"):
        """All targets. Two hubs exist in two forms: ``literal`` (deduped by another key, as the statements
        do) and ``own_pk`` (deduped by their own pk); ``hub_form`` picks one, or ``both``."""
        if hub_form not in ("literal", "own_pk", "both"):
            raise ValueError(f"hub_form {hub_form!r}")
        literal = {h.pk for h in self.hubs if h.dedup_by}
        drop = {"literal": lambda h: h.pk in literal and not h.dedup_by, "own_pk": lambda h: bool(h.dedup_by),
                "both": lambda h: False}[hub_form]
        return (*(h for h in self.hubs if not drop(h)), *self.links, *self.sats)

    def target(self, name: str):
        for t in self.targets():
            if t.name == name:
                return t
        raise KeyError(name)


# ---------------------------------------------------------------------------------------------
# Record-source tags of each staging view.
RECORD_SOURCE_PAYMENT_LAKE = "PAYMENT - DATA LAKE"
RECORD_SOURCE_PAYMENT = "PAYMENT - GCS"
RECORD_SOURCE_BILLING = "BILLING - GCS"
RECORD_SOURCE_ISSUE = "issue - GCS"
RECORD_SOURCE_TRAFFIC = "traffic - GCS"


def _payment(sum_name: str, record_source: str) -> StageSpec:
    return StageSpec(
        name="payment",
        columns=("user_id", "pay_doc_type", "pay_doc_num", "account", "phone",
                 "billing_period", "pay_date", sum_name),
        renames={} if sum_name == "sum" else {"sum": sum_name},
        keys={"user_key": "user_id", "account_key": "account",
              "billing_period_key": "billing_period", "pay_doc_type_key": "pay_doc_type",
              "pay_doc_num_key": "pay_doc_num"},
        single={"user_pk": "user_id", "account_pk": "account",
                "billing_period_pk": "billing_period"},
        composite={
            "pay_doc_pk": (("pay_doc_type", "pay_doc_num"), 2),
            "user_account_pk": (("user_id", "account"), 2),
            "account_billing_pay_pk": (("account", "pay_doc_type", "pay_doc_num", "billing_period"), 4),
        },
        hashdiffs={
            "user_hashdiff": (("phone",), None),
            "pay_doc_hashdiff": (("pay_date", sum_name), None),
        },
        record_source=record_source,
        time_col="pay_date",
    )


BILLING = StageSpec(
    name="billing",
    columns=("user_id", "billing_period", "service", "tariff", "billing_sum", "created_at"),
    renames={"sum": "billing_sum"},
    keys={"user_key": "user_id", "billing_period_key": "billing_period",
          "service_key": "service", "tariff_key": "tariff"},
    single={"user_pk": "user_id", "billing_period_pk": "billing_period",
            "service_pk": "service", "tariff_pk": "tariff"},
    composite={
        "user_service_pk": (("user_id", "service"), 2),
        "user_service_billing_period_pk": (("user_id", "service", "billing_period"), 2),
        "service_tariff_pk": (("service", "tariff"), 2),
    },
    hashdiffs={
        "service_hashdiff": (("user_id", "service"), 4),
        "tariff_hashdiff": (("tariff", "service"), 4),
    },
    record_source=RECORD_SOURCE_BILLING,
    time_col="created_at",
)

ISSUE = StageSpec(
    name="issue",
    columns=("user_id", "start_time", "end_time", "title", "description", "service"),
    renames={},
    keys={"user_key": "user_id", "start_time_key": "start_time", "service_key": "service",
          "issue_key": "title"},
    single={"user_pk": "user_id", "start_time_pk": "start_time", "service_pk": "service"},
    composite={
        "issue_pk": (("title", "start_time"), 2),
        "user_issue_pk": (("user_id", "title", "start_time"), 4),
        "issue_service_pk": (("title", "start_time", "service"), 4),
    },
    hashdiffs={"issue_hashdiff": (("user_id", "start_time", "service"), 4)},
    record_source=RECORD_SOURCE_ISSUE,
    time_col="start_time",
)

TRAFFIC = StageSpec(
    name="traffic",
    columns=("user_id", "timerequest", "device_id", "device_ip_addr", "bytes_sent", "bytes_received"),
    renames={},
    keys={"user_key": "user_id", "timerequest_key": "timerequest", "device_key": "device_id"},
    single={"user_pk": "user_id", "timerequest_pk": "timerequest", "device_pk": "device_id"},
    composite={"user_device_pk": (("user_id", "device_id"), 2)},
    hashdiffs={"device_hashdiff": (("user_id", "device_id", "device_ip_addr"), 4)},
    record_source=RECORD_SOURCE_TRAFFIC,
    time_col="timerequest",
)


def _payment_targets(sum_name: str):
    hubs = (
        HubSpec("hub_user", "payment", "user_pk", ("user_key",)),
        HubSpec("hub_account", "payment", "account_pk", ("account_key",)),
        HubSpec("hub_billing_period", "payment", "billing_period_pk", ("billing_period_key",)),
        HubSpec("hub_billing_period_literal", "payment", "billing_period_pk",
                ("billing_period_key",), dedup_by="account_pk"),
        HubSpec("hub_pay_doc", "payment", "pay_doc_pk", ("pay_doc_type_key", "pay_doc_num_key")),
    )
    links = (
        LinkSpec("link_user_account", "payment", "user_account_pk", ("user_pk", "account_pk")),
        LinkSpec("link_account_billing_pay", "payment", "account_billing_pay_pk",
                 ("account_pk", "billing_period_pk", "pay_doc_pk")),
    )
    sats = (
        SatSpec("sat_user_details", "payment", "user_pk", "user_hashdiff", ("phone",)),
        SatSpec("sat_pay_doc_details", "payment", "pay_doc_pk", "pay_doc_hashdiff",
                ("pay_date", sum_name)),
    )
    return hubs, links, sats


_dwl_hubs, _dwl_links, _dwl_sats = _payment_targets("sum")

# Payment-only vault (source tag of the data lake, payment amount kept as ``sum``).
DWL = VaultSpec(
    name="dwl",
    stages={"payment": _payment("sum", RECORD_SOURCE_PAYMENT_LAKE)},
    hubs=_dwl_hubs,
    links=_dwl_links,
    sats=_dwl_sats,
)

_fp_hubs, _fp_links, _fp_sats = _payment_targets("payment_sum")

# Full vault over the four sources.
FP = VaultSpec(
    name="fp",
    stages={"payment": _payment("payment_sum", RECORD_SOURCE_PAYMENT), "billing": BILLING,
            "issue": ISSUE, "traffic": TRAFFIC},
    hubs=_fp_hubs + (
        HubSpec("hub_tariff", "billing", "tariff_pk", ("tariff_key",)),
        HubSpec("hub_issue", "issue", "issue_pk", ("issue_key",)),
        HubSpec("hub_device", "traffic", "device_pk", ("device_key",)),
        HubSpec("hub_service", "billing", "service_pk", ("service_key",)),
        HubSpec("hub_service_literal", "billing", "service_pk", ("service_key",), dedup_by="user_pk"),
    ),
    links=(
        # reads billing_period_pk in its distinct but does not store it
        LinkSpec("link_user_service_billing_period", "billing", "user_service_billing_period_pk",
                 ("user_pk", "service_pk"), also_distinct_on=("billing_period_pk",)),
        LinkSpec("link_user_issue", "issue", "user_issue_pk", ("user_pk", "issue_pk")),
        LinkSpec("link_user_service", "billing", "user_service_pk", ("user_pk", "service_pk")),
        LinkSpec("link_service_tariff", "billing", "service_tariff_pk", ("service_pk", "tariff_pk")),
        LinkSpec("link_user_device", "traffic", "user_device_pk", ("user_pk", "device_pk")),
    ) + _fp_links,
    sats=(
        SatSpec("sat_service_details", "billing", "service_pk", "service_hashdiff",
                ("created_at", "billing_sum")),
        SatSpec("sat_issue_details", "issue", "issue_pk", "issue_hashdiff",
                ("start_time", "title", "description")),
        SatSpec("sat_tariff_details", "billing", "tariff_pk", "tariff_hashdiff", ("created_at", "tariff")),
        SatSpec("sat_device_details", "traffic", "device_pk", "device_hashdiff",
                ("timerequest", "device_id", "device_ip_addr", "bytes_sent", "bytes_received")),
    ) + _fp_sats,
)
