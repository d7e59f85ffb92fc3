"""Business expressions over single rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The 27 federal units by code, and the country they belong to.
STATE_NAMES = {
    "AC": "Acre",
    "AL": "Alagoas",
    "AM": "Amazonas",
    "AP": "Amapá",
    "BA": "Bahia",
    "CE": "Ceará",
    "DF": "Distrito Federal",
    "ES": "Espírito Santo",
    "GO": "Goiás",
    "MA": "Maranhão",
    "MG": "Minas Gerais",
    "MS": "Mato Grosso do Sul",
    "MT": "Mato Grosso",
    "PA": "Pará",
    "PB": "Paraíba",
    "PE": "Pernambuco",
    "PI": "Piauí",
    "PR": "Paraná",
    "RJ": "Rio de Janeiro",
    "RN": "Rio Grande do Norte",
    "RO": "Rondônia",
    "RR": "Roraima",
    "RS": "Rio Grande do Sul",
    "SC": "Santa Catarina",
    "SE": "Sergipe",
    "SP": "São Paulo",
    "TO": "Tocantins",
}
COUNTRY = "Brazil"

PURCHASED = "order_purchase_timestamp"
DELIVERED = "order_delivered_customer_date"
PROMISED = "order_estimated_delivery_date"


def delivery_days() -> Column:
    """Calendar days from purchase to delivery; NULL until delivered."""
    return F.datediff(DELIVERED, PURCHASED)


def estimated_days() -> Column:
    """Calendar days from purchase to the promised day."""
    return F.datediff(PROMISED, PURCHASED)


def delivery_delta_days() -> Column:
    """Days late (positive) or early (negative) against the promise."""
    return delivery_days() - estimated_days()


def is_on_time() -> Column:
    """Delivered no later than the promised moment; NULL while either is unknown."""
    return F.col(DELIVERED) <= F.col(PROMISED)


def is_late() -> Column:
    return F.col(DELIVERED) > F.col(PROMISED)


def is_delivered() -> Column:
    return F.col("order_status") == "delivered"


def delivery_metrics() -> dict[str, Column]:
    return {
        "delivery_days": delivery_days(),
        "estimated_days": estimated_days(),
        "delivery_delta_days": delivery_delta_days(),
        "is_on_time": is_on_time(),
        "is_delivered": is_delivered(),
    }


def gmv_item() -> Column:
    return F.col("price") + F.col("freight_value")


def monthly_instalment_value() -> Column:
    """Payment divided by its instalments; NULL where there are none."""
    n = F.col("payment_installments")
    return F.when(n > 0, F.try_divide(F.col("payment_value"), n))


def comment_flags() -> dict[str, Column]:
    return {
        "has_comment_title": F.col("review_comment_title").isNotNull(),
        "has_comment_message": F.col("review_comment_message").isNotNull(),
    }


def category_english() -> Column:
    return F.coalesce("product_category_name_english", "product_category_name")


def review_response_hours() -> Column:
    """Hours from the day a review was opened to its answer."""
    created = F.col("review_creation_date").cast("timestamp_ntz")
    return F.timestamp_diff("HOUR", created, F.col("review_answer_timestamp"))


def geo_enrich(df: DataFrame, state: str = "customer_state") -> DataFrame:
    """Add country and full state name; an unknown code stands for itself."""
    names = F.create_map(*[F.lit(x) for pair in STATE_NAMES.items() for x in pair])
    return df.withColumns(
        {"country": F.lit(COUNTRY), "state_full": F.coalesce(F.try_element_at(names, F.col(state)), F.col(state))}
    )
