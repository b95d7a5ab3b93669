"""Small raw snapshots and events."""

from __future__ import annotations

import json
import os
import uuid
from datetime import date, datetime, timedelta

from sluice.model import ENTITIES

ODATE = date(2026, 8, 5)
NEXT = date(2026, 8, 6)
AS_OF = datetime(2026, 8, 10, 12, 0, 0)

GOOD = {
    "patients": [
        "1,Ana Lima,111.222.333-44,Ana@Mail.org,+55 (11) 98765-4321,f,a+,1990-02-03, Recife ,pe,2026-01-01 10:00:00",
        "2,Bo,22233344455,bo@x.com,12,M,O-,2000-12-31,Natal,RN,2026-01-01 10:00:00",
    ],
    "hospitals": [
        "1,North ,Public,pe,Recife,1.0,2026-01-01",
        "2,South,Private,RN,Natal,2000,2026-01-01",
    ],
    "doctors": ["1,Dr A,100.0,Cardio,1,2026-01-01", "2,Dr B,200,Derma,2.0,2026-01-01"],
    "diseases": ["1,Flu,Viral,1,2026-01-01", "2,Cold,Viral,5.0,2026-01-01"],
    "attendance": [
        "1,1,1,1,1,2026-03-01 08:00:00,10.0,100.50,1.0,1.0,2026-03-01 08:00:00",
        "2,2,2,1,2,2026-03-01 09:00:00,,50.25,2,,2026-03-01 09:00:00",
        "3,2,2,9,2,2026-03-02 09:00:00,300,0,5,0,2026-03-02 09:00:00",
    ],
}


def write_raw(root: str, odate: date, lines: dict[str, list[str]]) -> None:
    for name, rows in lines.items():
        folder = f"{root}/{name}/odate={odate.isoformat()}"
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{name}.csv", "w", encoding="utf-8") as out:
            out.write("\n".join([",".join(ENTITIES[name].raw), *rows]) + "\n")


def raw_frame(spark, entity: str, rows: list[dict]):
    """Raw snapshot rows from dicts of text; lineage has defaults."""
    names = [*ENTITIES[entity].raw, "_corrupt_record", "_source_file"]
    ddl = ", ".join(f"{n} STRING" for n in names) + ", _ingested_at TIMESTAMP, odate DATE"
    filled = [
        tuple(row.get(n, f"s3/raw/{entity}.csv" if n == "_source_file" else None) for n in names)
        + (row.get("_ingested_at", datetime(2026, 8, 5, 6)), row.get("odate", ODATE))
        for row in rows
    ]
    return spark.createDataFrame(filled, ddl)


START = datetime(2026, 1, 1)


def event(number: int, **changes) -> dict:
    seen = (START + timedelta(minutes=number)).isoformat() + "Z"
    base = {
        "schema_version": 1,
        "event_id": str(uuid.UUID(int=number, version=4)),
        "event_type": "patient_vital_signs",
        "patient_id": number % 3 + 1,
        "heart_rate_bpm": 70,
        "oxygen_saturation_pct": 97,
        "temperature_c": 36.5,
        "blood_pressure_systolic_mmhg": 120,
        "blood_pressure_diastolic_mmhg": 80,
        "event_time": seen,
        "produced_at": seen,
        "producer_run_id": str(uuid.UUID(int=5, version=4)),
        "source": "monitor",
    }
    base.update(changes)
    return base


def record(payload, offset: int, queued: datetime) -> tuple:
    text = payload if isinstance(payload, str) else json.dumps(payload)
    return (b"k", text.encode(), "vitals", 0, offset, queued)
