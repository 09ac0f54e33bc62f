"""Small input worlds and a slow, plain computation of the report over them."""

from __future__ import annotations

import math
import random
from collections import defaultdict
from datetime import date, datetime, time, timedelta

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_type

from sitecharge.sources.schemas import input_schema
from sitecharge.sources.tables import load_tables

JAN = (date(2000, 1, 1), date(2000, 1, 31))
FEB = (date(2000, 2, 1), date(2000, 2, 29))

COLUMNS = {
    "companies": "company_id",
    "accounts": "account_id company_id enable_order_value_pricing_model",
    "sites": "site_id account_id active",
    "unit_of_measures": "unit_of_measure_id label",
    "uom_ratios": "uom_ratio_id account_id unit_of_measure_id ratio_to_reference_uom",
    "uom_contexts": "item_id default_uom_ratio_id case_uom_ratio_id full_pallet_uom_ratio_id",
    "work_orders": "work_order_id item_id scenario_id final_charge_per_unit",
    "jobs": "job_id site_id work_order_id created_at actual_start_at"
    " produced_quantity_value_in_reference_uom",
    "scenarios": "scenario_id unit_of_measure_id",
    "scenario_charges": "scenario_charge_id scenario_id effective_date_at labour_charge_per_unit"
    " materials_charge_per_unit overhead_charge_per_unit overridden_charge_per_unit",
    "custom_per_unit_charges": "scenario_charge_id cost_per_unit charge_per_unit markup_per_unit"
    " markup_percentage percentage",
}


def base_world() -> dict[str, list[tuple]]:
    """One company, account, site, item and scenario; no jobs."""
    return {
        "companies": [(1,)],
        "accounts": [(10, 1, True)],
        "sites": [(100, 10, True)],
        "unit_of_measures": [(1, "each"), (2, "case")],
        "uom_ratios": [(501, 10, 1, 1.0), (502, 10, 2, 4.0)],
        "uom_contexts": [(7, 501, 502, 502)],
        "work_orders": [(1000, 7, 70, None)],
        "jobs": [],
        "scenarios": [(70, 2)],
        "scenario_charges": [(900, 70, datetime(1999, 1, 1), 1.0, 2.0, 0.5, None)],
        "custom_per_unit_charges": [(900, 0.0, 0.25, 0.0, 0.0, 0.0)],
    }


def job(job_id, site=100, order=1000, start=datetime(2000, 1, 10, 5), quantity=8.0):
    return (job_id, site, order, start - timedelta(days=1), start, quantity)


def spark_tables(spark, world):
    def read(name):
        schema = input_schema(name)
        names = COLUMNS[name].split()
        columns = {n: [row[i] for row in world[name]] for i, n in enumerate(names)}
        arrays = [pa.array(columns[f.name], to_arrow_type(f.dataType)) for f in schema.fields]
        rows = pa.Table.from_arrays(arrays, names=schema.names)
        return spark.createDataFrame(rows, schema).coalesce(2)

    return load_tables(read)


def random_world(seed: int) -> dict[str, list[tuple]]:
    """A few hundred jobs with unknown owners, several contexts per item, and tied charges."""
    r = random.Random(seed)
    maybe = lambda value, share=0.15: None if r.random() < share else value
    world = base_world()
    world["companies"] = [(1,), (2,)]
    world["accounts"] = [(10, 1, True), (11, 2, False), (12, None, True), (13, 9, True)]
    world["sites"] = [
        (100 + i, r.choice([10, 11, 11, 12, 13, 99, None]), maybe(r.random() < 0.85, 0.05))
        for i in range(12)
    ]
    world["unit_of_measures"] = [(u, f"u{u}") for u in range(3)]
    world["uom_ratios"] = [
        (a * 10 + u, a, u, [0.5, 2.0, 4.0][u]) for a in (10, 11, 12) for u in range(3)
    ]
    ratio_ids = [row[0] for row in world["uom_ratios"]]
    world["uom_contexts"] = [
        (r.randrange(8), maybe(r.choice(ratio_ids)), maybe(r.choice(ratio_ids)), None)
        for _ in range(12)
    ]
    world["uom_contexts"] += world["uom_contexts"][:2]
    world["work_orders"] = [
        (1000 + i, maybe(r.randrange(9)), maybe(r.randrange(7)), maybe(r.choice([0.0, 5.5, 80.0]), 0.6))
        for i in range(60)
    ]
    world["scenarios"] = [(s, r.choice([0, 1, 2, None])) for s in range(6)]
    world["scenario_charges"] = [
        (900 + i, maybe(r.randrange(8), 0.05), maybe(datetime(1998 + r.randrange(3), 1, 1), 0.1),
         maybe(r.randrange(5) * 0.5), maybe(r.randrange(5) * 0.75), r.randrange(4) * 0.25,
         maybe(r.randrange(3) * 2.0, 0.7))
        for i in range(40)
    ]
    world["custom_per_unit_charges"] = [
        (maybe(900 + r.randrange(30)), 1.0, maybe(r.randrange(-2, 5) * 0.5), 1.0, 0.1, 0.2)
        for _ in range(50)
    ]
    first = datetime(2000, 1, 1)
    world["jobs"] = [
        (i, maybe(100 + min(r.randrange(13), r.randrange(13)), 0.03),
         maybe(1000 + min(r.randrange(64), r.randrange(64)), 0.05),
         first + timedelta(hours=r.randrange(1400)),
         maybe(first + timedelta(hours=r.randrange(1500)), 0.03),
         maybe(r.choice([0.5, 0.99, 1.0, 2.0, 16.0, 48.0]), 0.03))
        for i in range(400)
    ]
    return world


def _index(rows, key=0):
    found = defaultdict(list)
    for row in rows:
        if row[key] is not None:
            found[row[key]].append(row)
    return found


def _divide(a, b):
    if a is None or b is None:
        return None
    if b == 0:
        return None if a == 0 else math.copysign(math.inf, a)
    out = a / b
    return None if math.isnan(out) else out


def _quantile(values, p):
    ordered = sorted(values)
    at = (len(ordered) - 1) * p
    low, high = ordered[math.floor(at)], ordered[math.ceil(at)]
    return low if low == high else (math.ceil(at) - at) * low + (at - math.floor(at)) * high


def job_rows(world, period, ties="keep"):
    """(site owner, job, charge) rows of a period, every copy written out."""
    start = datetime.combine(period[0], time())
    end = datetime.combine(period[1], time())
    orders, items = _index(world["work_orders"]), _index(world["uom_contexts"])
    ratios, scenarios = _index(world["uom_ratios"]), _index(world["scenarios"])
    charges, sites = _index(world["scenario_charges"], 1), _index(world["sites"])
    accounts, companies = _index(world["accounts"]), _index(world["companies"])
    custom = _index(world["custom_per_unit_charges"])
    out = []
    for job_id, site_id, order_id, created, at, amount in world["jobs"]:
        if at is None or not start <= at <= end or amount is None or not amount > 0.99:
            continue
        if not sites[site_id] or not sites[site_id][0][2]:
            continue
        owner = sites[site_id][0][1]
        account = accounts[owner][0] if accounts[owner] else None
        if owner is not None and account is None:
            continue
        company = companies[account[1]][0][0] if account and companies[account[1]] else None
        order = orders[order_id][0] if orders[order_id] else (None, None, None, None)
        picks = [None]
        if scenarios[order[2]] and job_id is not None:
            dated = [c for c in charges[order[2]] if c[2] is not None]
            if dated:
                latest = [c for c in dated if c[2] == max(c[2] for c in dated)]
                copies = sum(c[2] == min(c[2] for c in dated) for c in dated)
                picks = latest * (copies if ties == "keep" else 1)
        for context in items[order[1]] or [None]:
            default = ratios[context[1]][0] if context and ratios[context[1]] else None
            quantity = _divide(amount, default[3]) if default and default[3] else None
            case = ratios[context[2]][0] if context and ratios[context[2]] else None
            case_ratio = case[3] if case and case[1] == owner else None
            for pick in picks:
                unit = scenarios[order[2]][0][1] if pick else None
                produced = default[2] if default else None
                moved = quantity
                if unit is not None and produced != unit:
                    moved = _divide(quantity, case_ratio)
                parts = list(pick[3:7]) if pick else [None] * 4
                extra = [c[2] for c in custom[pick[0]] if c[2] is not None] if pick else []
                parts.append(sum(extra) if extra else None)
                out.append(
                    {"owner": (company, owner, site_id), "job": job_id, "order": order[0],
                     "quantity": moved, "final": order[3], "parts": parts, "created": created}
                )
    for row in out:
        labour, materials, overhead, overridden, extra = row["parts"]
        three = None if None in (labour, materials, overhead) else labour + materials + overhead
        four = None if three is None or extra is None else three + extra
        ladder = [("fcpu", row["final"]), ("overridden", overridden), ("sum_scenario", four),
                  ("sum_scenario_wo_custom", three), ("no_charge", math.inf)]
        row["fill"], row["charge"] = next((k, c) for k, c in ladder if c is not None and c > 0)
        if row["fill"] == "no_charge":
            row["charge"] = 0.0
    return out


def _product(a, b):
    out = None if a is None or b is None else a * b
    return None if out is None or math.isnan(out) else out


def brute_report(world, period, ties="keep"):
    """{site: report numbers} of a period, rounded as formatted text rounds."""
    by_site, report = defaultdict(list), {}
    for row in job_rows(world, period, ties):
        by_site[row["owner"]].append(row)
    for owner, rows in by_site.items():
        if None in owner:
            continue
        charges = [row["charge"] for row in rows]
        middle = _quantile(charges, 0.5)
        spread = _quantile([abs(c - middle) for c in charges], 0.5) * 1.4826
        bound = _quantile(charges, 0.95) + spread / 5 + 1

        def add(of, rows=rows):
            return sum(x for x in map(of, rows) if x is not None)

        out_of_line = [c > bound or c < 0.001 for c in charges]
        n = sum(row["job"] is not None for row in rows)
        total = add(lambda row: _product(row["charge"], row["quantity"]))
        inside = [row for row, odd in zip(rows, out_of_line) if not odd]
        kept = add(lambda row: _product(row["charge"], row["quantity"]), inside)
        materials = add(lambda row: _product(row["parts"][1], row["quantity"]))
        value = _divide(total, sum(c > 0 for c in charges) / n)
        clean = _divide(kept, sum(r["charge"] > 0 for r in inside) / n)
        share = _divide(materials, clean)
        adjusted = clean
        if share is not None and 0.1 <= share < 1:
            adjusted = clean * (1 - share) + clean * 0.1 + clean * (share - 0.1) * 0.05
        cents = lambda x: x if math.isinf(x) else float(f"{x:.2f}")
        percent = lambda count: cents(count / n * 100)
        fills = [row["fill"] for row in rows]
        report[owner] = {
            "TOTAL_NUMBER_OF_PROJECTS": len({row["order"] for row in rows} - {None}),
            "TOTAL_NUM_JOBS": n,
            "PERCENT_FCPU": percent(fills.count("fcpu")),
            "TOTAL_FCPU": cents(add(lambda row: _product(row["final"], row["quantity"]))),
            "PERCENT_OVERRIDDEN": percent(fills.count("overridden")),
            "PERCENT_SUM_SCENARIO": percent(fills.count("sum_scenario")),
            "PERCENT_SUM_SCENARIO_WO_CUSTOM": percent(fills.count("sum_scenario_wo_custom")),
            "PERCENT_NO_CHARGES": percent(fills.count("no_charge")),
            "PERCENT_FILL_RATE": percent(sum(c > 0 for c in charges)),
            "PERCENT_OV_MATERIALS": cents((share or 0.0) * 100),
            "OV_W_OUTLIERS": cents(value or 0.0),
            "PERCENT_OUTLIERS": percent(sum(out_of_line)),
            "OV_WO_OUTLIERS": cents(clean or 0.0),
            "ADJUSTED_OV_WO_OUTLIERS": cents(adjusted or 0.0),
        }
    return report
