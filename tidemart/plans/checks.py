"""Declared checks of the conformed tables and the star schema."""

from __future__ import annotations

from tidemart.operators.report import (
    accepted_range_check,
    accepted_values_check,
    not_null_checks,
    present_check,
    relationships_check,
    row_check,
    unique_check,
    unique_combination_check,
)

# Accepted codes.
ORDER_STATUSES = [
    "delivered",
    "shipped",
    "canceled",
    "unavailable",
    "invoiced",
    "processing",
    "created",
    "approved",
]
PAYMENT_TYPES = ["credit_card", "boleto", "voucher", "debit_card", "not_defined"]
INSTALLMENT_LEVELS = ["LOW", "MEDIUM", "HIGH"]
REVIEW_SCORES = [1, 2, 3, 4, 5]

SILVER_CHECKS = [
    unique_check("orders_silver", "order_id"),
    *not_null_checks("orders_silver", "order_id", "customer_id"),
    accepted_values_check("orders_silver", "order_status", ORDER_STATUSES),
    *not_null_checks(
        "orders_items_silver", "order_id", "order_item_id", "product_id", "seller_id"
    ),
    accepted_range_check("orders_items_silver", "price", 0),
    accepted_range_check("orders_items_silver", "freight_value", 0),
    unique_combination_check("orders_items_silver", "order_id", "order_item_id"),
    *not_null_checks("order_payments_silver", "order_id"),
    accepted_values_check("order_payments_silver", "payment_type", PAYMENT_TYPES),
    accepted_values_check(
        "order_payments_silver", "level_of_installment", INSTALLMENT_LEVELS
    ),
    accepted_range_check("order_payments_silver", "payment_value", 0),
    unique_combination_check("order_payments_silver", "order_id", "payment_sequential"),
    unique_check("order_reviews_silver", "review_id"),
    *not_null_checks("order_reviews_silver", "review_id", "order_id"),
    accepted_values_check("order_reviews_silver", "review_score", REVIEW_SCORES),
    unique_check("product_silver", "product_id"),
    *not_null_checks("product_silver", "product_id"),
    *not_null_checks(
        "geolocation_silver", "geolocation_zip_code_prefix", "standardized_state_code"
    ),
    unique_combination_check(
        "geolocation_silver",
        "geolocation_zip_code_prefix",
        "standardized_city",
        "standardized_state_code",
    ),
    row_check(
        "orders_silver",
        "delivery_after_purchase",
        "order_delivered_customer_date < order_purchase_timestamp",
    ),
    row_check(
        "order_reviews_silver",
        "answer_after_creation",
        "review_answer_timestamp < review_creation_date",
    ),
]

GOLD_CHECKS = [
    unique_check("dim_customer", "customer_key"),
    *not_null_checks("dim_customer", "customer_key", "customer_id"),
    *not_null_checks("dim_seller", "seller_id"),
    unique_check("dim_product", "product_id"),
    *not_null_checks("dim_product", "product_id"),
    unique_check("dim_date", "date_actual"),
    unique_check("dim_date", "date_id"),
    *not_null_checks("dim_date", "date_actual", "date_id"),
    unique_check("dim_order_attribute", "attribute_id"),
    *not_null_checks("dim_order_attribute", "attribute_id"),
    unique_check("dim_feedback_profile", "feedback_id"),
    *not_null_checks("dim_feedback_profile", "feedback_id"),
    *not_null_checks("dim_geolocation", "geolocation_zip_code_prefix"),
    *not_null_checks(
        "fact_sales", "order_id", "order_item_id", "product_id", "seller_id"
    ),
    relationships_check("fact_sales", "product_id", "dim_product", "product_id"),
    accepted_range_check("fact_sales", "price", 0),
    unique_combination_check("fact_sales", "order_id", "order_item_id"),
    present_check("fact_sales", "orders_exist", "order_id", "orders_silver", "order_id"),
    *not_null_checks("fact_payment", "order_id", "attribute_id"),
    relationships_check(
        "fact_payment", "attribute_id", "dim_order_attribute", "attribute_id"
    ),
    accepted_range_check("fact_payment", "payment_value", 0),
    unique_combination_check("fact_payment", "order_id", "payment_sequential"),
    unique_check("fact_reviews", "review_id"),
    *not_null_checks("fact_reviews", "review_id", "order_id"),
    accepted_values_check("fact_reviews", "review_score", REVIEW_SCORES),
]
