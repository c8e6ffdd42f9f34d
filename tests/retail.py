"""A retail source of our own in four batches, made by a rule: updates, new rows, a change of an order
alone, a customer without orders, padded text. Expected results are derived from these rows by SQL."""

from __future__ import annotations

import random
from datetime import datetime, timedelta, timezone
from decimal import Decimal
from pathlib import Path

import pyarrow.parquet as pq
from pyspark.sql import SparkSession

from tidemill.contracts import CUSTOMER, ORDER_LINE, ORDERS, PRODUCT, Entity

YEAR, MONTH = 2031, 3
TOWNS = ["Porto", "Gdynia", "Turku", "Cork"]


def at(day: int, hour: int = 0, minute: int = 0, month: int = MONTH, year: int = YEAR) -> datetime:
    return datetime(year, month, day, hour, minute, tzinfo=timezone.utc)


BEFORE = at(1, month=1)


def customer(number, changed, city="Porto", status="active", email=None, created=BEFORE):
    email = email or f"Buyer{number}@Shop.Test"
    return (number, f"  Given{number}", f"Family{number} ", email, city, status, created, changed)


def product(number, price, changed, created=BEFORE):
    return (number, f" Ware {number}", "Goods  ", Decimal(price), True, created, changed)


def line(number, order, item, quantity, price, discount, changed):
    return (number, order, item, quantity, Decimal(price), Decimal(discount), changed)


class Source:
    """The rows as they stand, and what each batch delivers of them."""

    def __init__(self, seed: int = 11):
        self.random = random.Random(seed)
        self.price = {900 + 3 * n: Decimal(self.random.randrange(150, 90000)) / 100 for n in range(14)}
        self.customers, self.orders, self.lines = 40, 0, 0
        self.placed: dict[int, tuple] = {}
        self.loner = 7000 + self.customers  # never buys

    def new_orders(self, many: int, day: int):
        orders, lines = [], []
        for _ in range(many):
            self.orders += 1
            when = at(day, 6, self.orders % 60)
            buyer = 7000 + self.random.randrange(1, self.customers)
            row = (4000 + self.orders, buyer, when.date(), " Paid", "eur ", when)
            self.placed[row[0]] = row
            orders.append(row)
            for _ in range(self.random.randrange(1, 4)):
                self.lines += 1
                lines.append(self.line_of(60 + self.lines, row[0], when))
        return orders, lines

    def line_of(self, number: int, order: int, when: datetime):
        item = self.random.choice(sorted(self.price))
        discount = self.random.choice(["0", "0", "2.5", "12"])
        quantity = self.random.randrange(1, 9)
        return line(number, order, item, quantity, self.price[item], discount, when)


def _batches() -> dict[str, list[tuple[Entity, list[tuple]]]]:
    source = Source()
    out = {}
    orders, lines = source.new_orders(60, 2)
    out["20310303_full"] = [
        (CUSTOMER, [customer(7000 + n, at(3), TOWNS[n % 4]) for n in range(1, source.customers + 1)]),
        (PRODUCT, [product(n, p, at(3)) for n, p in source.price.items()]),
        (ORDERS, orders),
        (ORDER_LINE, lines),
    ]
    # prices change, customers move, orders come in
    orders, lines = source.new_orders(12, 10)
    changed = sorted(source.price)[:3]
    source.price.update({n: source.price[n] + 1 for n in changed})
    out["20310310_incremental"] = [
        (CUSTOMER, [customer(7000 + n, at(10), "Bergen", email=f"NEW{n}@shop.test") for n in (3, 8)]),
        (PRODUCT, [product(n, source.price[n], at(10)) for n in changed]),
        (ORDERS, orders),
        (ORDER_LINE, lines),
    ]
    # an order alone changes its status; no product file
    orders, lines = source.new_orders(5, 17)
    alone = source.placed[4004]
    out["20310317_incremental"] = [
        (CUSTOMER, [customer(7003, at(17), "Bergen", status="closed")]),
        (ORDERS, [*orders, (*alone[:3], "Returned", "EUR", at(17, 5))]),
        (ORDER_LINE, lines),
    ]
    # a line is corrected with its order, a new product is sold
    orders, lines = source.new_orders(5, 24)
    source.price[990] = Decimal("19.99")
    fixed = source.placed[4009]
    out["20310324_incremental"] = [
        (CUSTOMER, [customer(7100, at(24), created=at(24))]),
        (PRODUCT, [product(990, source.price[990], at(24), created=at(24))]),
        (ORDERS, [*orders, (*fixed[:3], "Corrected", "EUR", at(24, 5))]),
        (ORDER_LINE, [*lines, line(CORRECTED, 4009, 990, 7, "19.99", "5", at(24, 5))]),
    ]
    return out


CORRECTED = 61
BATCHES = _batches()


def land_file(spark: SparkSession, landing, entity: Entity, name: str, rows, schema=None) -> Path:
    """One Parquet file of exactly this name, as a source system would deliver it."""
    folder = Path(landing) / entity.source / entity.table
    folder.mkdir(parents=True, exist_ok=True)
    frame = spark.createDataFrame(list(rows), schema or entity.schema)
    pq.write_table(frame.toArrow(), folder / name)
    return folder / name


def land(spark: SparkSession, landing, batch: str) -> None:
    for entity, rows in BATCHES[batch]:
        land_file(spark, landing, entity, f"{entity.table}_{batch}.parquet", rows)


def ticking(start: datetime):
    """A clock that is a second later each time it is asked."""
    now = [start]

    def clock() -> datetime:
        now[0] += timedelta(seconds=1)
        return now[0]

    return clock
