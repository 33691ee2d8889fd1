"""The declared tests, stated a second time for the oracle: a test that the
engine's own lists (``plans.quality``) lose or change shows as a difference."""

# not_null columns per model; a star marks a test of warn severity.
NOT_NULL = """
stg_ga_events: event_key event_date event_timestamp event_name user_pseudo_id source_table_suffix
stg_ga_sessions: session_key user_pseudo_id ga_session_id session_start_at session_end_at event_count
stg_ga_purchases: event_key event_date event_timestamp user_pseudo_id session_key* transaction_id* purchase_revenue*
stg_ga_items: event_key event_date event_timestamp event_name user_pseudo_id item_index item_id* item_name*
stg_orders: shop_domain order_id created_at updated_at currency total_price ingested_at
stg_order_line_items: shop_domain order_id order_item_id product_id* quantity unit_price
stg_customers: shop_domain customer_id ingested_at
stg_products: shop_domain product_id product_title ingested_at
stg_product_variants: shop_domain product_id variant_id ingested_at
purchase_reconciliation: ga4_event_key ga4_event_timestamp ga4_purchase_revenue* user_pseudo_id match_status
order_attribution: order_id order_created_date total_price attribution_model is_attributed attributed_source attributed_medium attributed_campaign
fct_attributed_orders: order_id order_created_date total_price is_attributed attributed_source attributed_medium attributed_campaign
fct_channel_revenue: revenue_date currency attributed_source attributed_medium attributed_campaign orders total_revenue
fct_funnel: event_date source medium campaign sessions
"""

# Unique columns per model.
UNIQUE = """
stg_ga_events: event_key*
stg_ga_sessions: session_key
stg_ga_purchases: event_key
stg_orders: order_id
stg_order_line_items: order_item_id
stg_customers: customer_id
stg_products: product_id
stg_product_variants: variant_id
purchase_reconciliation: ga4_event_key
order_attribution: order_id
fct_attributed_orders: order_id
"""

# Model, column, severity, condition on the rows, values.
ACCEPTED_VALUES = [
    ("stg_products", "status", "warn", "true", "'active', 'archived', 'draft'"),
    ("purchase_reconciliation", "match_status", "error", "true",
     "'matched', 'missing_transaction_id', 'not_set_transaction_id', 'unmatched_transaction_id'"),
    ("purchase_reconciliation", "match_type", "error", "match_type IS NOT NULL", "'order_id'"),
    ("order_attribution", "attribution_model", "error", "true", "'purchase_session'"),
]

# Model, severity, key.
UNIQUE_COMBINATION = [
    ("fct_channel_revenue", "error", ["revenue_date", "currency", "attributed_source", "attributed_medium", "attributed_campaign"]),
]


def columns(listed: str):
    """(model, column, severity) per test of a list above."""
    for line in listed.strip().splitlines():
        model, names = line.split(":")
        for name in names.split():
            yield model, name.rstrip("*"), "warn" if name.endswith("*") else "error"
