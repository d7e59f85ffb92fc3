from datetime import datetime

from tidemark.entities import ENTITIES


def ts(text):
    return datetime.fromisoformat(text)


def rows(spark, entity, *dicts, received="2018-08-09 12:00:00"):
    """Change rows of an entity from dicts; columns left out are NULL."""
    schema = ENTITIES[entity].change_schema
    data = [tuple(d.get(c) for c in schema.fieldNames()) for d in dicts]
    df = spark.createDataFrame(data, schema)
    return df.selectExpr("*", f"timestamp_ntz'{received}' as _ingested_at")


def order(order_id, op="I", at="2018-08-05 10:00:00", status="shipped", bought="2018-08-01 09:00:00", **more):
    return {
        "order_id": order_id,
        "customer_id": f"c-{order_id}",
        "order_status": status,
        "order_purchase_timestamp": bought and ts(bought),
        "order_estimated_delivery_date": ts("2018-08-20 00:00:00"),
        "OP": op,
        "AR_H_COMMIT_TIMESTAMP": at and ts(at),
        **more,
    }


def item(order_id, n=1, price=10.0, freight=2.5, op="I", at="2018-08-05 10:00:00", **more):
    return {
        "order_id": order_id,
        "order_item_id": n,
        "product_id": "p1",
        "seller_id": "s1",
        "price": price,
        "freight_value": freight,
        "OP": op,
        "AR_H_COMMIT_TIMESTAMP": ts(at),
        **more,
    }


def as_set(df, *columns):
    return {tuple(r) for r in df.select(*columns).collect()}
