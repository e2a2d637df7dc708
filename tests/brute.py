"""The priority index in plain Python over lists of dicts, for small fixtures."""

from __future__ import annotations

import math
import re
from collections import defaultdict
from decimal import Decimal

CENTRES = {
    "3900": (9.0747526, -79.4278550), "3903": (8.4394907, -82.4650681),
    "3905": (8.1231047, -80.6981549), "3904": (9.4686099, -82.5180536),
}
CHAIN_COLUMNS = ["cod_cliente", "cod_cadena", "grupo_economico"]


def degrees(text):
    try:
        return float(re.sub(r"[^\d.\-]", "", text.strip(" ")))
    except (AttributeError, ValueError):
        return None


def kilometres(customer):
    lat, lon, to = degrees(customer["latitud"]), degrees(customer["longitud"]), CENTRES.get(customer["id_centro"])
    if lat is None or lon is None or to is None:
        return None
    p1, p2, dl = math.radians(lat), math.radians(to[0]), math.radians(to[1] - lon)
    h = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(dl / 2) ** 2
    return 2 * 6371 * math.asin(min(1.0, math.sqrt(h)))


def ratio(margin, sales):
    if margin is None or sales is None or sales == 0 or (margin < 0 and sales < 0):
        return None
    return float(margin) / float(sales)


def add(a, b):
    return b if a is None else a if b is None else a + b


def total(values):
    out = None
    for value in values:
        out = add(out, value)
    return out


def largest(values):
    known = [v for v in values if v is not None]
    return max(known) if known else None


def mean(values):
    known = [v for v in values if v is not None]
    return sum(known) / len(known) if known else None


def months_back(day, n):
    month = day.year * 12 + day.month - 1 - n
    year, month = divmod(month, 12)
    for last in (day.day, 30, 29, 28):
        try:
            return day.replace(year=year, month=month + 1, day=last)
        except ValueError:
            continue


def level(rows, key, distances):
    """Measures per key from monthly rows that may repeat a date."""
    by_date = defaultdict(lambda: [None, None])
    for row in rows:
        cell = by_date[row[key], row["fecha"]]
        cell[0], cell[1] = add(cell[0], row["m"]), add(cell[1], row["v"])
    grouped = defaultdict(list)
    for (k, _), cell in by_date.items():
        grouped[k].append(cell)
    out = {}
    for k, cells in grouped.items():
        m, v = total(c[0] for c in cells), total(c[1] for c in cells)
        # A NULL key matches nothing in a join.
        d = None if k is None else largest(distances[k])
        out[k] = {"m": m, "pct": ratio(m, v), "prom": mean(ratio(*c) for c in cells), "d": d}
    return out


def rank(frame, weights):
    known = [row["d"] for row in frame.values() if row["d"] is not None]
    low, span = (min(known), max(max(known) - min(known), 1e-9)) if known else (None, None)
    for row in frame.values():
        norm = None if row["d"] is None else 1 - (row["d"] - low) / span
        terms = [row["pct"], row["prom"], norm]
        row["score"] = None if None in terms else round(sum(w * t for w, t in zip(weights, terms)), 9)
    floor = min((row["score"] for row in frame.values() if row["score"] is not None), default=None)
    for row in frame.values():
        row["score"] = floor if row["score"] is None else row["score"]
    order = sorted(frame, key=lambda k: (-(frame[k]["score"] or 0), k is not None, k or ""))
    return {k: place for place, k in enumerate(order, 1)}


def priority_index(fact, customers, cutoff, months=12):
    """[(cod_cliente, prioridad, margen_porcentual)] in order."""
    previous = {(c["cod_cliente"], c["lprio"]) for c in customers if c["lprio"] is not None}
    served = [c for c in customers if c["id_centro"] in CENTRES]
    listings = {tuple(c[name] for name in CHAIN_COLUMNS) for c in served}
    attributes = {tuple(sorted((k, v) for k, v in c.items() if k not in ("cod_cadena", "lprio")), ) for c in served}
    attributes = [dict(a) for a in attributes]

    start = months_back(cutoff, months - 1)
    monthly = defaultdict(lambda: [None, None])
    for row in fact:
        if row["fecha"] is not None and start <= row["fecha"] <= cutoff:
            cell = monthly[row["cod_cliente"], row["fecha"]]
            cell[0], cell[1] = add(cell[0], row["cc_utilidad_bruta"]), add(cell[1], row["valor_neto"])
    linked = []
    for (customer, day), (m, v) in monthly.items():
        found = [l for l in listings if customer is not None and l[0] == customer] or [(customer, None, None)]
        for _, chain, _ in found:
            key = chain if chain is not None and chain.strip(" ") else customer
            linked.append({"cod_cliente": customer, "fecha": day, "m": m, "v": v, "cod_cadena": chain, "key": key})

    per_customer, per_key = defaultdict(list), defaultdict(list)
    for customer, key in {(r["cod_cliente"], r["key"]) for r in linked}:
        km = [kilometres(a) for a in attributes if customer is not None and a["cod_cliente"] == customer]
        per_customer[customer] += km
        per_key[key] += km
    chains = {k: v for k, v in level(linked, "key", per_key).items() if v["m"] is not None}
    clients = level(linked, "cod_cliente", per_customer)
    chain_rank, client_rank = rank(chains, (0.33, 0.55, 0.17)), rank(clients, (0.33, 0.5, 0.17))

    rows = []
    catalogue = {(r["cod_cliente"], r["cod_cadena"], r["key"]) for r in linked}
    for key in chains:
        members = [c for c in catalogue if key is not None and c[2] == key] or [(None, None, None)]
        for customer, _, _ in members:
            copies = sum(1 for a in attributes if customer is not None and a["cod_cliente"] == customer) or 1
            for priority in [p for c, p in previous if customer is not None and c == customer] or [None]:
                place = client_rank.get(customer) if customer is not None else None
                row = (priority is None, priority or 0, chain_rank[key], place is None, place or 0, customer or "")
                rows += [(row, customer, chains[key]["pct"])] * copies
    rows.sort(key=lambda r: r[0])
    return [(customer, place, pct) for place, (_, customer, pct) in enumerate(rows, 1)]


def money(value):
    return None if value is None else Decimal(value).quantize(Decimal("0.0001"))
