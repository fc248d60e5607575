"""Hand-built warehouse in the reference's CSV shapes, with planted anomalies.

Six distributors, two SKUs, 181 days (2023-01-01 .. 2023-06-30), one
promotion on SKU001 (2023-04-10 .. 2023-04-25):

D01 honest       buys 600 units a day and sells them in drops of 50
D02 stuffer      as honest, plus 6000 units on six month-ends
D03 mild         as honest, plus exactly 4 x its mean (2400) on 2023-03-31
D04 falsifier    as honest, plus ten single drops of 150 units
D05 hoarder      sells nothing of SKU001 during the promotion, then 3 x
D06 idle         no movement at all
"""

from __future__ import annotations

import datetime as dt
import os

START, END = dt.date(2023, 1, 1), dt.date(2023, 6, 30)
PROMO_START, PROMO_END = dt.date(2023, 4, 10), dt.date(2023, 4, 25)
DISTS = ["D01", "D02", "D03", "D04", "D05", "D06"]
UPC = {"SKU001": 40, "SKU002": 100}
STUFF_DAYS = [dt.date(2023, m, d) for m, d in
              [(1, 31), (2, 28), (3, 31), (4, 30), (5, 31), (6, 30)]]
MILD_DAY = dt.date(2023, 3, 31)
BULK_DAYS = [dt.date(2023, 2, d) for d in range(1, 11)]


def days():
    d = START
    while d <= END:
        yield d
        d += dt.timedelta(days=1)


def did(d: dt.date) -> int:
    return d.year * 10000 + d.month * 100 + d.day


def _w(path, header, rows):
    with open(path, "w", newline="") as f:
        f.write(",".join(header) + "\r\n")
        for r in rows:
            f.write(",".join(str(x) for x in r) + "\r\n")


def write_planted_csvs(folder: str) -> None:
    cal = []
    for d in days():
        nxt = d + dt.timedelta(days=1)
        cal.append((d.isoformat(), did(d), d.year, d.month, d.day,
                    "True" if nxt.month != d.month else "False"))
    _w(os.path.join(folder, "dim_date.csv"),
       ["date", "date_id", "year", "month", "day", "is_month_end"], cal)
    _w(os.path.join(folder, "dim_product.csv"),
       ["sku_id", "brand", "category", "mrp", "units_per_case"],
       [("SKU001", "Brand A", "Soap", "35.00", 40), ("SKU002", "Brand B", "Tea", "120.50", 100)])
    _w(os.path.join(folder, "dim_distributor.csv"),
       ["distributor_id", "distributor_name", "rep_id", "region"],
       [(d, f"Distributor {d}", "R1", "Urban" if i % 2 else "Rural") for i, d in enumerate(DISTS)])
    _w(os.path.join(folder, "dim_kirana.csv"),
       ["kirana_id", "kirana_name", "distributor_id", "pin_code"],
       [(f"K{d}{k:02d}", f"Store {k}", d, 560000 + k) for d in DISTS for k in range(12)])
    _w(os.path.join(folder, "dim_promotion.csv"),
       ["promotion_id", "promo_name", "sku_id", "promo_start", "promo_end", "discount_pct"],
       [("PROMO001", "Spring sale", "SKU001", PROMO_START.isoformat(), PROMO_END.isoformat(), 20)])

    prim, sec = [], []
    oid = [0, 0]

    def ship(d, dist, sku, cases):
        oid[0] += 1
        prim.append((oid[0], did(d), dist, sku, "R1", cases))

    def drop(d, dist, sku, units, store):
        oid[1] += 1
        sec.append((oid[1], did(d), f"K{dist}{store:02d}", dist, sku, units))

    for d in days():
        for dist in DISTS[:5]:
            ship(d, dist, "SKU001", 5)          # 200 units
            ship(d, dist, "SKU002", 4)          # 400 units
            hoarding = dist == "D05" and PROMO_START <= d <= PROMO_END
            dumping = dist == "D05" and PROMO_END < d <= PROMO_END + dt.timedelta(days=15)
            if not hoarding:
                for k in range(12 if dumping else 4):   # 4 x 50 = 200 (dump: 600)
                    drop(d, dist, "SKU001", 50, k)
            for k in range(8):                  # 8 x 50 = 400
                drop(d, dist, "SKU002", 50, k + 4 if k + 4 < 12 else k)
        if d in STUFF_DAYS:
            ship(d, "D02", "SKU002", 54)        # +5400 -> 6000 that day
        if d == MILD_DAY:
            ship(d, "D03", "SKU002", 18)        # +1800 -> 2400 = 4 x 600
        if d in BULK_DAYS:
            drop(d, "D04", "SKU002", 150, 0)
    _w(os.path.join(folder, "fact_primary_sales.csv"),
       ["primary_order_id", "date_id", "distributor_id", "sku_id", "rep_id", "qty_cases"], prim)
    _w(os.path.join(folder, "fact_secondary_sales.csv"),
       ["secondary_order_id", "date_id", "kirana_id", "distributor_id", "sku_id", "qty_units"], sec)
