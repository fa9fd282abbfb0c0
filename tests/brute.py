"""Row-by-row restatement of the series in plain Python, as an opinion independent of SQL."""

import calendar
import datetime as dt
from decimal import Decimal


def month_end(day):
    return dt.date(day.year, day.month, calendar.monthrange(day.year, day.month)[1])


def labelled(rows, months=8, mean_rows=3, ratio=0.3):
    """rows: (customer, product, amount, datetime, type); returns one dict per kept month."""
    cells = {}
    for customer, product, amount, when, kind in rows:
        if when is None or kind not in ("C", "D"):
            continue
        key = (customer or "None", product or "None", month_end(when.date()))
        cell = cells.setdefault(key, {"C": Decimal(0), "D": Decimal(0)})
        cell[kind] += amount or 0

    by_customer = {}
    for key in sorted(cells, key=lambda k: (k[0].encode(), k[1].encode(), k[2])):
        by_customer.setdefault(key[0], []).append(key)

    out = []
    for customer, keys in by_customer.items():
        balance, series = Decimal(0), {}
        for key in keys:
            balance += cells[key]["C"] - cells[key]["D"]
            series.setdefault(key[1], []).append((key[2], cells[key], balance))
        if not any(sum(b >= 0 for _, _, b in s) == months for s in series.values()):
            continue
        for product, entries in series.items():
            flags = []
            for i, (date, cell, balance) in enumerate(entries):
                before = [b for _, _, b in entries[max(0, i - mean_rows) : i]]
                mean = float(sum(before)) / mean_rows if len(before) == mean_rows else None
                flag = int(mean is not None and float(balance) < mean - ratio * mean)
                flags.append((date, cell, balance, mean or 0.0, flag))
            for i, (date, cell, balance, mean, flag) in enumerate(flags):
                following = flags[i + 1][4] if i + 1 < len(flags) else 0
                out.append((customer, product, date, cell["C"], cell["D"], balance, mean, flag, following))
    return sorted(out)
