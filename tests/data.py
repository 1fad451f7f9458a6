"""Hand-written rows, and the reports over them worked out by plain loops."""

import math
from collections import Counter, defaultdict
from datetime import date
from decimal import Decimal

from pyspark.sql import functions as F

from ledgerloom.schema import CLEAN

GRAIN_NAMES = ("day", "month", "year")

# (user, hour, usd, merchant, city, state, errors, fraud, date); the rate is 25,000.
ROWS = [
    (1, "09", "10.00", "Cafe", "Hue", "TT", "", "No", date(2023, 12, 30)),
    (1, "09", "20.00", "Cafe", "Hue", "TT", "", "Yes", date(2023, 12, 30)),
    (1, "09", "5.00", "Bar", "Hue", "TT", "Bad PIN", "No", date(2023, 12, 30)),
    (2, "23", "999.00", None, "ONLINE", "", "", "Yes", date(2023, 12, 31)),
    (1, "10", "10.00", "Cafe", "Hue", "TT", "", "No", date(2024, 1, 5)),
    (1, "10", "11.00", "Bar", "Hue", "TT", "Bad CVV", "Yes", date(2024, 1, 5)),
    (2, "10", "12.00", "Cafe", "Hanoi", "HN", "", "No", date(2024, 1, 5)),
    (2, "00", "13.00", "Cafe", "Hanoi", "HN", None, "No", date(2024, 1, 6)),
    (3, "00", "-7.00", "Shop", "Hanoi", "HN", "", "No", date(2024, 1, 6)),
    (3, "01", "99999.99", "Jewels", "Hanoi", "HN", "", "No", date(2024, 1, 7)),
    (3, "01", "99999.99", "Jewels", "Hanoi", "HN", "", "No", date(2024, 1, 7)),
    (4, "12", "1.00", "Shop", "Hue", "TT", "Bad PIN", "No", date(2024, 2, 1)),
    (4, "12", "2.00", "Shop", "Hue", "TT", "", "No", date(2024, 2, 1)),
    (4, "13", "3.00", "Shop", "Hue", "TH", "", "Yes", date(2024, 2, 1)),
    (5, "13", "4.00", None, None, None, "", "Yes", date(2024, 2, 1)),
    (5, "14", None, "Cafe", "Hue", "TT", "Bad PIN", "No", date(2024, 2, 2)),
    (None, "14", "6.00", "Cafe", "Hue", "TT", "", None, date(2024, 2, 2)),
    (None, "15", "7.00", "Bar", "Hue", "TT", "Glitch", "Yes", date(2024, 2, 2)),
    (1, "15", "8.00", "Bar", "Hue", "TT", "", "No", date(2024, 2, 3)),
    (1, "15", "8.00", "Bar", "Hue", "TT", "", "No", date(2024, 2, 3)),
    (1, "16", "9.00", None, "ONLINE", "", "Bad PIN", "Yes", date(2024, 2, 3)),
    (2, "16", "5000.00", "Jewels", "Hanoi", "HN", "", "No", date(2024, 2, 3)),
    (6, "bad", "1.50", "Cafe", "Hue", "TT", "", "No", date(2024, 2, 3)),
    (6, None, "2.50", "Cafe", "Hue", "TT", "Bad PIN", "Yes", date(2024, 2, 3)),
]


def records(rows=ROWS) -> list[dict]:
    out = []
    for user, hour, usd, merchant, city, state, errors, fraud, day in rows:
        out.append(
            {
                "user_id": user,
                "time": None if hour is None else f"{hour}:15:00",
                "hour": int(hour) if hour and hour.isdigit() else None,
                "amount_usd": None if usd is None else Decimal(usd),
                "amount_vnd": None if usd is None else int(Decimal(usd) * 25000),
                "merchant_name": merchant,
                "merchant_city": city,
                "merchant_state": state,
                "has_errors": errors,
                "is_fraud": fraud,
                "transaction_date": day,
                "ds": day,
            }
        )
    return out


def frame(spark, rows=ROWS):
    full = [
        tuple(r.get(name) for name in CLEAN.fieldNames()) for r in records(rows)
    ]
    return spark.createDataFrame(full, CLEAN).withColumn("use_chip", F.lit("Online"))


def in_grain(row, latest, grain):
    if grain == "day":
        return row["ds"] == latest
    if grain == "month":
        return (row["ds"].year, row["ds"].month) == (latest.year, latest.month)
    return row["ds"].year == latest.year


def total(rows):
    values = [r["amount_vnd"] for r in rows if r["amount_vnd"] is not None]
    return sum(values) if values else None


def average(rows):
    values = [r["amount_vnd"] for r in rows if r["amount_vnd"] is not None]
    return sum(values) / len(values) if values else None


def extreme(rows, pick):
    values = [r["amount_vnd"] for r in rows if r["amount_vnd"] is not None]
    return pick(values) if values else None


def distinct(rows, name):
    return len({r[name] for r in rows if r[name] is not None})


def error(row):
    return row["has_errors"] not in (None, "")


def fraud(row):
    return row["is_fraud"] == "Yes"


def grouped(rows, keys):
    groups = defaultdict(list)
    for row in rows:
        groups[tuple(row[k] for k in keys)].append(row)
    return groups


def p95(rows):
    values = sorted(r["amount_vnd"] for r in rows if r["amount_vnd"] is not None)
    return values[math.ceil(0.95 * len(values)) - 1] if values else None


def expected(rows, name, grain=None):
    """Rows of a report as tuples in column order, in no particular order."""
    everything = rows
    if grain:
        latest = max((r["ds"] for r in rows), default=None)
        rows = [r for r in rows if in_grain(r, latest, grain)]
    errors, frauds = [r for r in rows if error(r)], [r for r in rows if fraud(r)]

    def count(of, *keys):
        return [(*k, len(g)) for k, g in grouped(of, keys).items()]

    if name == "hourly_analysis":
        return count(rows, "hour")
    if name == "hourly_unusual_analysis":
        return count(errors, "hour")
    if name == "city_analysis":
        return [
            (*k, len(g), total(g), average(g))
            for k, g in grouped(rows, ("merchant_city", "merchant_state")).items()
        ]
    if name == "merchant_analysis":
        keys = ("merchant_name", "merchant_city", "merchant_state")
        return [
            (*k, len(g), total(g), average(g), extreme(g, max), distinct(g, "user_id"))
            for k, g in grouped(rows, keys).items()
        ]
    if name == "user_analysis":
        return [
            (*k, len(g), total(g), average(g), distinct(g, "merchant_name"),
             distinct(g, "merchant_city"), sum(map(error, g)))
            for k, g in grouped(rows, ("ds", "user_id")).items()
        ]
    if name == "user_frequent":
        hours = Counter((r["ds"], r["hour"], r["user_id"]) for r in rows)
        users = defaultdict(list)
        for (_, _, user), n in hours.items():
            if n > 1:
                users[user].append(n)
        return [(u, len(ns), sum(ns), sum(ns) / len(ns)) for u, ns in users.items()]
    if name == "high_value_analysis":
        limit = p95(everything)
        high = [r for r in rows if r["amount_vnd"] is not None and r["amount_vnd"] >= limit]
        return [
            (*k, len(g), extreme(g, max))
            for k, g in grouped(high, ("hour", "merchant_city", "merchant_name")).items()
        ]
    if name == "weekday_vs_weekend":
        kind = lambda r: "Weekend" if r["transaction_date"].isoweekday() > 5 else "Weekday"
        out = []
        for k in {kind(r) for r in rows}:
            g = [r for r in rows if kind(r) == k]
            out.append((k, len(g), total(g), average(g), distinct(g, "ds"), len(g) / distinct(g, "ds")))
        return out
    if name == "user_error_analysis":
        return [(*k, len(g), total(g)) for k, g in grouped(errors, ("user_id",)).items()]
    if name == "user_fraud_analysis":
        return count(frauds, "user_id")
    if name == "fraud_by_hour":
        return count(frauds, "hour")
    if name == "fraud_by_merchant":
        return count(frauds, "merchant_name", "merchant_city")
    if name == "fraud_by_city":
        return count(frauds, "merchant_city", "merchant_state")
    if name == "fraud_rate_by_merchant":
        return [
            (*k, len(g), sum(map(fraud, g)), round(sum(map(fraud, g)) / len(g) * 100, 2))
            for k, g in grouped(rows, ("ds", "merchant_name")).items()
        ]
    if name == "daily_summary":
        return [
            (*k, len(g), total(g), average(g), distinct(g, "user_id"), distinct(g, "merchant_name"),
             distinct(g, "merchant_city"), sum(map(error, g)), sum(map(fraud, g)),
             extreme(g, max), extreme(g, min))
            for k, g in grouped(rows, ("ds",)).items()
        ]
    raise ValueError(name)


def as_set(rows):
    return Counter(tuple(r) for r in rows)
