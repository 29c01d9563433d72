"""Landed pages for the tests."""

import json
from pathlib import Path


def record(id, archived=False, associations=None, **properties):
    out = {"id": id, "properties": properties, "archived": archived}
    if associations is not None:
        out["associations"] = associations
    return out


def linked(*items):
    return {"results": [dict(zip(("id", "type", "category"), item)) for item in items]}


PEOPLE = [
    record("811", associations={"companies": linked(("4411", "1", "HUBSPOT_DEFINED")), "deals": linked(("6602", "3"))},
           firstname="Ilse", lastname="Ødegård", hs_lastmodifieddate="2024-05-21T08:30:00Z"),
    record("824", associations={"companies": linked(("4425", "1"))},
           firstname="Noor", lastname="van der Berg", hs_lastmodifieddate="2024-05-23T17:05:00Z"),
    record("839", associations={}, firstname="Tariq", lastname="Aziz", hs_lastmodifieddate="2024-05-26T00:00:00Z"),
    record("852", associations={"companies": linked(("4411", "1"), ("4438", "1"))},
           firstname="Wren", lastname="Ó Briain", hs_lastmodifieddate="2024-05-29T23:59:59Z"),
    record("867", archived=True, associations={"deals": linked(("6617", "3"))},
           firstname="Sol", lastname="Nguyễn", hs_lastmodifieddate="2024-06-02T12:00:00Z"),
    record("878", archived=True, firstname="", lastname=None, hs_lastmodifieddate="not a date"),
]

CATALOG = [
    {"name": "firstname", "type": "string"},
    {"name": "lastname"},
    {"name": "hs_lastmodifieddate", "type": "datetime"},
    {"name": "num_employees", "type": "number"},
    {"name": "Es Activo", "type": "bool"},
]


def pages(*batches):
    return [{"results": list(batch)} for batch in batches]


def land(folder, *documents):
    folder = Path(folder)
    folder.mkdir(parents=True, exist_ok=True)
    name = f"{len(list(folder.iterdir())):04d}.json"
    (folder / name).write_text(
        "\n".join(d if isinstance(d, str) else json.dumps(d, ensure_ascii=False) for d in documents)
    )
    return str(folder)
