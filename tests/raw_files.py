"""Small CSV extracts for tests."""

import csv
import os

from callscope.schemas import ENTITIES

COLUMNS = {name: " ".join(entity.columns) for name, entity in ENTITIES.items()}
FX = '{"result": "success", "conversion_rates": {"KES": 100.0, "UGX": 1, "TZS": 1, "NGN": 1, "USD": 1}}'


def local(path):
    return path.removeprefix("file:")


def write(raw_dir, day, entity, rows, columns=None, part=None):
    columns = columns or COLUMNS[entity].split()
    path = f"{local(raw_dir)}/{day}/{entity}.csv"
    if part:
        path = f"{path}/{part}"
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(columns)
        out.writerows(rows)
    return path


def write_text(path, text):
    os.makedirs(os.path.dirname(local(path)), exist_ok=True)
    with open(local(path), "w") as f:
        f.write(text)
    return path


def disposition(call, contract, at, tenant=1001, call_type="Inbound Team", level_one="Enquiry"):
    return [call, tenant, f"c{call}", contract, at, "agent", call_type, level_one, "", ""]


def payment(contract, at, amount, tenant=1001):
    return [at, tenant, contract, "MPESA", "p", amount]


def call(key, at, note, user="u1", centre=1):
    return [key, at, centre, "done", "out", 1000, user, "camp", note]


def write_day(raw_dir, day, calls=(), dispositions=(), payments=(), mapping=(("Kenya", "u1", "T", "ann"),)):
    write(raw_dir, day, "ameyo_outbound_calls", calls)
    write(raw_dir, day, "atlas_calls_dispositions", dispositions)
    write(raw_dir, day, "atlas_payments", payments)
    write(raw_dir, day, "atlas_ameyo_mapping", mapping)
