"""Fixed schemas of the vendor feeds, the outbox, the poll cursor and the event log."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 6)
RATE = T.DecimalType(10, 6)
QUANTITY = T.DecimalType(24, 6)
TOTAL = T.DecimalType(26, 6)  # a sum of money that a rate can still multiply exactly

# Wire name, readable name and type of the 21 flat cost columns.
LINE_ITEM_FIELDS: list[tuple[str, str, T.DataType]] = [
    ("identity/LineItemId", "line_item_id", T.StringType()),
    ("identity/TimeInterval", "time_interval", T.StringType()),
    ("bill/PayerAccountId", "payer_account_id", T.StringType()),
    ("lineItem/UsageAccountId", "usage_account_id", T.StringType()),
    ("lineItem/LineItemType", "line_item_type", T.StringType()),
    ("lineItem/UsageStartDate", "usage_start", T.StringType()),
    ("lineItem/UsageEndDate", "usage_end", T.StringType()),
    ("lineItem/ProductCode", "product_code", T.StringType()),
    ("lineItem/UsageType", "usage_type", T.StringType()),
    ("lineItem/Operation", "operation", T.StringType()),
    ("lineItem/ResourceId", "resource_id", T.StringType()),
    ("lineItem/UsageAmount", "usage_amount", QUANTITY),
    ("lineItem/UnblendedCost", "unblended_cost", MONEY),
    ("product/instanceType", "instance_type", T.StringType()),
    ("product/region", "region", T.StringType()),
    ("pricing/term", "pricing_term", T.StringType()),
    ("pricing/publicOnDemandCost", "on_demand_cost", MONEY),
    ("reservation/EffectiveCost", "reservation_effective_cost", MONEY),
    ("reservation/ReservationARN", "reservation_arn", T.StringType()),
    ("resourceTags/user:Team", "tag_team", T.StringType()),
    ("resourceTags/user:CostCenter", "tag_cost_center", T.StringType()),
]

TO_READABLE = {wire: name for wire, name, _ in LINE_ITEM_FIELDS}
TO_WIRE = {name: wire for wire, name, _ in LINE_ITEM_FIELDS}

LINE_ITEM_WIRE = T.StructType([T.StructField(wire, kind) for wire, _, kind in LINE_ITEM_FIELDS])
LINE_ITEM = T.StructType([T.StructField(name, kind) for _, name, kind in LINE_ITEM_FIELDS])


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


LABEL = _struct(("key", T.StringType()), ("value", T.StringType()))
CREDIT = _struct(("name", T.StringType()), ("amount", MONEY), ("type", T.StringType()))
USAGE = _struct(
    ("amount", QUANTITY),
    ("unit", T.StringType()),
    ("amount_in_pricing_units", MONEY),
    ("pricing_unit", T.StringType()),
)

BILLING_ROW = _struct(
    ("billing_account_id", T.StringType()),
    ("service", _struct(("id", T.StringType()), ("description", T.StringType()))),
    ("sku", _struct(("id", T.StringType()), ("description", T.StringType()))),
    ("usage_start_time", T.StringType()),
    ("usage_end_time", T.StringType()),
    ("project", _struct(("id", T.StringType()), ("name", T.StringType()))),
    ("labels", T.ArrayType(LABEL)),
    ("cost", MONEY),
    ("currency", T.StringType()),
    ("currency_conversion_rate", RATE),
    ("usage", USAGE),
    ("credits", T.ArrayType(CREDIT)),
    ("cost_type", T.StringType()),
)

LINE_ITEM_PAGE = _struct(
    ("billingPeriod", T.StringType()),
    ("lineItems", T.ArrayType(LINE_ITEM_WIRE)),
    ("nextToken", T.StringType()),
)
BILLING_ROW_PAGE = _struct(("rows", T.ArrayType(BILLING_ROW)), ("nextPageToken", T.StringType()))

# Rows per served page of the two feeds.
LINE_ITEM_PAGE_SIZE = 5
BILLING_ROW_PAGE_SIZE = 4

OUTBOX = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("aggregate_type", T.StringType(), False),
    T.StructField("aggregate_id", T.StringType(), False),
    T.StructField("type", T.StringType(), False),
    T.StructField("payload", T.StringType(), False),
    T.StructField("created_at", T.TimestampType(), False),
])
OUTBOX_MAX_LENGTH = {"aggregate_type": 255, "aggregate_id": 255, "type": 255}

CURSOR = T.StructType([
    T.StructField("source", T.StringType(), False),
    T.StructField("last_token", T.StringType(), True),
    T.StructField("updated_at", T.TimestampType(), False),
])
CURSOR_MAX_LENGTH = {"source": 64, "last_token": 255}

MESSAGE = _struct(("id", T.StringType()), ("payload", T.StringType()), ("source", T.StringType()))

EVENT_LOG = _struct(
    ("topic", T.StringType()),
    ("key", T.StringType()),
    ("value", T.StringType()),
    ("headers", T.ArrayType(LABEL)),
    ("timestamp", T.TimestampType()),
)

# The providers and their display names.
PROVIDERS = {"AWS": "Amazon Web Services", "GCP": "Google Cloud Platform"}

DEFAULT_TOPIC_PREFIX = "billing"


def topics(prefix: str = DEFAULT_TOPIC_PREFIX) -> dict[str, str]:
    """Topic catalogue: event family to topic name, under a settable prefix."""
    return {
        "raw_aws": f"{prefix}.billing.raw.aws",
        "raw_gcp": f"{prefix}.billing.raw.gcp",
        "canonical_cost": f"{prefix}.cost.canonical",
        "smoke": f"{prefix}.smoke",
        "events": f"{prefix}.events",
    }
