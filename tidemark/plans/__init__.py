from tidemark.plans.gold import (
    driver_performance,
    payment_funnel,
    payment_lifecycle,
    payments_by_status,
    revenue_per_restaurant,
    user_behavior,
)
from tidemark.plans.medallion import bronze, silver, stamp
from tidemark.plans.users import candidates, fused_users, missing_users, prepare_users, split_users, tag_users, unify_users

__all__ = [
    "bronze",
    "candidates",
    "driver_performance",
    "fused_users",
    "missing_users",
    "payment_funnel",
    "payment_lifecycle",
    "payments_by_status",
    "prepare_users",
    "revenue_per_restaurant",
    "silver",
    "split_users",
    "stamp",
    "tag_users",
    "user_behavior",
    "unify_users",
]
