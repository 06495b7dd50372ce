"""Declared tables: columns, keys, constraints, defaults and unknown members.

One :class:`Table` per staging, dimension and fact table.  Everything that
reads, writes or checks a table takes what it needs from here.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
LONG = T.LongType()
INT = T.IntegerType()
SMALL = T.ShortType()
TEXT = T.StringType()
MOMENT = T.TimestampNTZType()
FLAG = T.BooleanType()

UNKNOWN_KEY = 0


def _columns(**types: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in types.items()])


@dataclass(frozen=True)
class Table:
    """A table and the constraints its rows must keep.

    ``enforced`` is false for staging: a load there replaces the table with
    whatever the source holds, so its keys are checked by query only.
    """

    namespace: str
    name: str
    columns: T.StructType
    primary_key: str | None = None
    natural_key: str | None = None
    not_null: tuple[str, ...] = ()
    max_length: dict[str, int] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    unknown: dict[str, object] | None = None
    enforced: bool = True

    @property
    def required(self) -> tuple[str, ...]:
        """Columns that may not be NULL, the primary key included."""
        key = (self.primary_key,) if self.primary_key else ()
        return tuple(dict.fromkeys(key + self.not_null))


# Names, types, lengths, keys and references of the tables.
_STAGING = [
    Table(
        "staging", "stg_customers",
        _columns(customer_id=LONG, name=TEXT, email=TEXT, city=TEXT, signup_date=MOMENT),
        primary_key="customer_id",
        max_length={"name": 255, "email": 255, "city": 100},
        enforced=False,
    ),
    Table(
        "staging", "stg_products",
        _columns(product_id=LONG, product_name=TEXT, category=TEXT, price=MONEY),
        primary_key="product_id",
        max_length={"product_name": 255, "category": 100},
        enforced=False,
    ),
    Table(
        "staging", "stg_marketing_campaigns",
        _columns(campaign_id=LONG, campaign_name=TEXT, start_date=MOMENT, end_date=MOMENT, channel=TEXT),
        primary_key="campaign_id",
        max_length={"campaign_name": 255, "channel": 50},
        enforced=False,
    ),
    Table(
        "staging", "stg_transactions",
        _columns(transaction_id=LONG, customer_id=LONG, transaction_date=MOMENT, total_amount=MONEY),
        primary_key="transaction_id",
        enforced=False,
    ),
    Table(
        "staging", "stg_transaction_items",
        _columns(transaction_item_id=LONG, transaction_id=LONG, product_id=LONG, quantity=INT, price=MONEY),
        primary_key="transaction_item_id",
        enforced=False,
    ),
]

_DATE_COLUMNS = _columns(
    date_key=INT, full_date=T.DateType(), day_of_week=SMALL, day_name=TEXT, day_of_month=SMALL,
    day_of_year=SMALL, month_of_year=SMALL, month_name=TEXT, quarter_of_year=SMALL, year_num=SMALL,
    is_weekend=FLAG, is_holiday=FLAG,
)
_FACT_COLUMNS = _columns(
    date_key=INT, customer_key=LONG, product_key=LONG, campaign_key=LONG, transaction_id_natural=INT,
    quantity=INT, price_at_sale=MONEY, total_amount=MONEY,
)

_WAREHOUSE = [
    Table(
        "dwh", "dim_date", _DATE_COLUMNS,
        primary_key="date_key",
        not_null=tuple(_DATE_COLUMNS.names),
        max_length={"day_name": 10, "month_name": 10},
    ),
    Table(
        "dwh", "dim_customer",
        _columns(
            customer_key=LONG, customer_id_natural=INT, name=TEXT, email=TEXT, city=TEXT,
            signup_date=MOMENT, row_start_date=MOMENT, row_end_date=MOMENT, is_current=FLAG,
        ),
        primary_key="customer_key",
        natural_key="customer_id_natural",
        not_null=("customer_id_natural", "name"),
        max_length={"name": 255, "email": 255, "city": 100},
        unknown={"customer_key": UNKNOWN_KEY, "customer_id_natural": 0, "name": "Unknown"},
    ),
    Table(
        "dwh", "dim_product",
        _columns(product_key=LONG, product_id_natural=INT, product_name=TEXT, category=TEXT, master_price=MONEY),
        primary_key="product_key",
        natural_key="product_id_natural",
        not_null=("product_id_natural",),
        max_length={"product_name": 255, "category": 100},
        unknown={"product_key": UNKNOWN_KEY, "product_id_natural": 0, "product_name": "Unknown"},
    ),
    Table(
        "dwh", "dim_campaign",
        _columns(
            campaign_key=LONG, campaign_id_natural=INT, campaign_name=TEXT, start_date=MOMENT,
            end_date=MOMENT, channel=TEXT,
        ),
        primary_key="campaign_key",
        natural_key="campaign_id_natural",
        not_null=("campaign_id_natural",),
        max_length={"campaign_name": 255, "channel": 50},
        unknown={"campaign_key": UNKNOWN_KEY, "campaign_id_natural": 0, "campaign_name": "Unknown"},
    ),
    Table(
        "dwh", "fact_sales", _FACT_COLUMNS,
        not_null=tuple(_FACT_COLUMNS.names),
        references={
            "date_key": ("dim_date", "date_key"),
            "customer_key": ("dim_customer", "customer_key"),
            "product_key": ("dim_product", "product_key"),
            "campaign_key": ("dim_campaign", "campaign_key"),
        },
    ),
]

TABLES: dict[str, Table] = {table.name: table for table in _STAGING + _WAREHOUSE}

# Staging table -> file name in the source folder.
SOURCE_FILES: dict[str, str] = {
    "stg_customers": "customers.csv",
    "stg_products": "products.csv",
    "stg_marketing_campaigns": "marketing_campaigns.csv",
    "stg_transactions": "transactions.csv",
    "stg_transaction_items": "transaction_items.csv",
}

# Fields of a sensor message.
SENSOR_READING = _columns(
    date_time=TEXT, city_id=INT, city_name=TEXT, device_name=TEXT, P_watt=INT, V_volt=INT,
    I_amphere=T.FloatType(),
)
