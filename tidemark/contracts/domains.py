"""The twenty built-in table contracts.

Each line states only what is particular to a table. What all tables share is filled in by
rule: the change-record columns, clustering by the merge key, rejecting rows without a key,
and warning when the table's clock column lies in the future.
"""

from __future__ import annotations

from tidemark.contracts.model import INGESTED_AT, OP, SEQUENCE, Contract, Field, Rule


def _fields(columns: str) -> tuple[Field, ...]:
    """``"id string!, note string"`` -> fields; ``!`` marks a column that may not be null."""
    own = []
    for column in columns.split(","):
        name, kind = column.split()
        own.append(Field(name, kind.rstrip("!"), not kind.endswith("!")))
    return (*own, Field(OP, "string"), Field(SEQUENCE, "long"), Field(INGESTED_AT, "timestamp", False))


def _contract(
    name: str,
    source: str,
    key: str,
    columns: str,
    *,
    silver: bool = False,
    clock: str = "dt_current_timestamp",
    quarantine: tuple[str, ...] = (),
    warn: tuple[str, ...] = (),
    allowed: dict[str, tuple] | None = None,
    unique: tuple[str, ...] = (),
) -> Contract:
    layers = ("bronze", "silver") if silver else ("bronze",)
    last = layers[-1:]
    rules = [Rule(key, "not_null", "reject", ("bronze",), "critical")]
    rules += [Rule(f, "not_null", "quarantine", ("silver",), "critical") for f in quarantine]
    rules += [Rule(f, "unique", "quarantine", ("silver",), "critical") for f in unique]
    rules += [Rule(f, "not_null", "warn", last) for f in warn]
    rules += [Rule(f, "allowed_values", "warn", last, values=v) for f, v in (allowed or {}).items()]
    rules += [Rule(clock, "not_future", "warn", layers)]
    return Contract(
        name=name,
        layers=layers,
        source=source,
        topic=f"pg.public.{name}",
        keys=(key,),
        fields=_fields(columns),
        rules=tuple(rules),
        cluster_by=(key,),
        properties={"delta.enableChangeDataFeed": silver, "delta.autoOptimize.optimizeWrite": True},
    )


# Names, columns, keys and quality rules of the source tables.
_ALL = (
    _contract(
        "driver_shifts", "kafka_shift", "shift_id",
        "shift_id string!, driver_id string!, shift_type string, login_method string, device_os string, "
        "start_time timestamp, end_time timestamp, shift_duration_min integer, num_orders integer, "
        "earnings_brl double, distance_covered_km double, shift_rating double, issues_reported string, "
        "city string, region string, available boolean, dt_current_timestamp timestamp",
        silver=True, quarantine=("driver_id",),
        allowed={"shift_type": ("Morning", "Afternoon", "Evening", "Overnight")},
    ),
    _contract(
        "drivers", "postgres_drivers", "uuid",
        "uuid string!, driver_id string!, first_name string, last_name string, license_number string, "
        "phone_number string, vehicle_type string, vehicle_make string, vehicle_model string, "
        "vehicle_year integer, city string, country string, date_birth date, dt_current_timestamp timestamp",
        silver=True, quarantine=("driver_id",), unique=("driver_id",),
    ),
    _contract(
        "gps_events", "kafka_gps", "gps_id",
        "gps_id string!, order_id string!, lat double!, lon double!, altitude double, speed_kph double, "
        "accuracy_m double, direction_deg double, duration_ms double, timestamp timestamp!, "
        "dt_current_timestamp timestamp",
        warn=("order_id", "lat", "lon"),
    ),
    _contract(
        "inventory", "postgres_inventory", "stock_id",
        "stock_id string!, restaurant_id integer!, product_id string!, quantity_available integer, "
        "last_updated timestamp!",
        warn=("product_id",), clock="last_updated",
    ),
    _contract(
        "menu_sections", "mysql_menu", "menu_section_id",
        "menu_section_id string!, restaurant_id integer!, name string!, description string, active boolean, "
        "dt_current_timestamp timestamp",
        warn=("restaurant_id",),
    ),
    _contract(
        "order_items", "mongodb_items", "order_item_id",
        "order_item_id string!, order_id string!, product_id string!, product_name string, "
        "product_type string, cuisine_type string, restaurant_id integer!, quantity integer, "
        "unit_price double, discount_applied double, subtotal double, is_combo boolean, "
        "is_vegetarian boolean, modifiers string, dt_current_timestamp timestamp",
        silver=True, quarantine=("order_id", "product_id", "unit_price"),
    ),
    _contract(
        "order_status", "kafka_status", "status_id",
        "status_id integer!, order_identifier string!, status string, dt_current_timestamp timestamp",
        silver=True, quarantine=("order_identifier",), warn=("status",),
    ),
    _contract(
        "orders", "kafka_orders", "order_id",
        "order_id string!, user_key string!, restaurant_key string!, driver_key string, payment_key string, "
        "rating_key string, order_date timestamp, total_amount double, dt_current_timestamp timestamp",
        silver=True, quarantine=("user_key", "restaurant_key", "total_amount"),
    ),
    _contract(
        "payment_events", "kafka_events", "event_id",
        "event_id string!, payment_id string!, event string, dt_current_timestamp timestamp",
        silver=True, quarantine=("payment_id",), warn=("event",),
    ),
    _contract(
        "payments", "kafka_payments", "payment_id",
        "payment_id string!, order_key string!, status string!, method string, provider string, "
        "amount double, net_amount double, platform_fee double, provider_fee double, tax_amount double, "
        "refund_amount double, currency string, captured boolean, refunded boolean, card_brand string, "
        "card_last4 string, card_exp_month integer, card_exp_year integer, invoice_id string, "
        "receipt_url string, wallet_provider string, failure_reason string, country string, "
        "ip_address string, user_agent string, timestamp timestamp, capture_timestamp timestamp, "
        "dt_current_timestamp timestamp",
        silver=True, quarantine=("order_key", "status", "amount"),
        allowed={"status": ("succeeded", "failed", "pending", "refunded", "cancelled"), "currency": ("BRL",)},
    ),
    _contract(
        "products", "mysql_products", "product_id",
        "product_id string!, restaurant_id integer!, name string, product_type string, cuisine_type string, "
        "flavor_profile string, tags string, price double, unit_cost double, calories integer, "
        "prep_time_min integer, is_vegetarian boolean, is_gluten_free boolean, created_at timestamp, "
        "updated_at timestamp, dt_current_timestamp timestamp",
        warn=("restaurant_id",),
    ),
    _contract(
        "ratings", "mysql_ratings", "uuid",
        "uuid string!, rating_id integer!, restaurant_identifier string!, rating double!, "
        "timestamp timestamp!, dt_current_timestamp timestamp",
        warn=("rating_id",), allowed={"rating": (1, 2, 3, 4, 5)},
    ),
    _contract(
        "receipts", "kafka_receipts", "receipt_id",
        "receipt_id string!, order_id string!, payment_id string!, total_amount double, item_count integer, "
        "receipt_generated_at timestamp!",
        warn=("order_id", "payment_id"), clock="receipt_generated_at",
    ),
    _contract(
        "recommendations", "mongodb_recommendations", "event_id",
        "event_id string!, user_id integer!, event_type string!, product_id string!, timestamp timestamp!, "
        "dt_current_timestamp timestamp",
        silver=True, quarantine=("user_id",),
        allowed={"event_type": ("view", "add_to_cart", "purchase", "click", "impression")},
    ),
    _contract(
        "restaurants", "mysql_restaurants", "uuid",
        "uuid string!, restaurant_id integer!, cnpj string!, name string, cuisine_type string, "
        "address string, city string, country string, phone_number string, opening_time string, "
        "closing_time string, average_rating double, num_reviews integer, dt_current_timestamp timestamp",
        silver=True, quarantine=("cnpj",), unique=("cnpj",),
    ),
    _contract(
        "routes", "kafka_route", "route_id",
        "route_id string!, order_id string!, driver_id string!, start_lat double, start_lon double, "
        "end_lat double, end_lon double, distance_km double, estimated_duration_min double, "
        "start_time timestamp, end_time timestamp, dt_current_timestamp timestamp",
        warn=("order_id", "driver_id"),
    ),
    _contract(
        "search_events", "kafka_search", "search_id",
        "search_id string!, user_id integer!, query_text string, filters string, result_count integer, "
        "clicked_product_id string, timestamp timestamp!",
        silver=True, quarantine=("user_id",), clock="timestamp",
    ),
    _contract(
        "support_tickets", "mongodb_support", "ticket_id",
        "ticket_id string!, user_id integer!, order_id string, category string, description string, "
        "status string, opened_at timestamp!, dt_current_timestamp timestamp",
        warn=("user_id",),
    ),
    _contract(
        "users_mongo", "mongodb_users", "uuid",
        "uuid string!, user_id integer, cpf string!, email string, phone_number string, city string, "
        "country string, delivery_address string, dt_current_timestamp timestamp",
        silver=True, quarantine=("cpf",),
    ),
    _contract(
        "users_mssql", "mssql_users", "uuid",
        "uuid string!, user_id integer, cpf string!, first_name string, last_name string, "
        "phone_number string, birthday date, job string, company_name string, country string, "
        "dt_current_timestamp timestamp",
        silver=True, quarantine=("cpf",),
    ),
)

CONTRACTS: dict[str, Contract] = {c.name: c for c in _ALL}


def contract(name: str) -> Contract:
    if name not in CONTRACTS:
        raise KeyError(f"no contract named '{name}'; there are {sorted(CONTRACTS)}")
    return CONTRACTS[name]
