"""Explicit schemas of the master, control and notice tables."""

from __future__ import annotations

STORES = (
    "store_id string, store_name string, address_line string, city string, state string, "
    "region string, floor_area_sqft int, opened_on date"
)
CATEGORIES = "category_id string, category_name string, department string, gst_rate decimal(4,3)"
PRODUCTS = (
    "product_sk bigint, product_code string, product_name string, category_id string, brand string, "
    "pack_size string, uom string, valid_from date, valid_to date, is_current boolean"
)
PRICE_REVISIONS = (
    "revision_id bigint, product_sk bigint, mrp decimal(12,2), selling_price decimal(12,2), "
    "effective_from date, effective_to date"
)
FINANCE = "month string, revenue_inr decimal(18,2)"
NOTICES = "notice_id string, body string"
LABELLED_PAIRS = "notice_id_a string, notice_id_b string, label string"

MASTERS = {
    "stores": STORES,
    "product_categories": CATEGORIES,
    "products": PRODUCTS,
    "price_revisions": PRICE_REVISIONS,
}
