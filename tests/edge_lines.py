"""Landing lines of one folder, each with the reason it is rejected for (None: accepted)."""

import json

MALFORMED = "malformed"
INGESTED = "2026-07-12T07:44:07+00:00"


def _line(observed_at, city, *measures, ingested_at=INGESTED, **more):
    record = {"observed_at": observed_at, "ingested_at": ingested_at, "city": city}
    record.update(zip(("temperature_c", "humidity_pct", "wind_speed_kmh"), measures))
    record.update(more)
    return json.dumps(record)


RIGA = _line("2026-07-12T07:30", "Riga", 23.3, 71, 5.0, ingested_at="2026-07-12T07:44:07.123456+00:00")
RIGA_AGAIN = _line("2026-07-12T07:30", "Riga", 23.3, 71, 5.0, ingested_at="2026-07-12T08:44:07+00:00")

LINES = [
    (RIGA, None),
    (_line("2026-07-12T07:30:15", "Vilnius", 21.0, 60, 3.5), None),
    (_line("2026-07-12T07:30:15Z", "Tallinn", 19.5, 80, 0), None),
    (_line("", "Riga", 20.0, 50, 1.0), "missing:observed_at"),
    (_line(None, "Riga", 20.0, 50, 1.0), "missing:observed_at"),
    (json.dumps({"observed_at": "2026-07-12T07:30", "ingested_at": INGESTED}), "missing:city"),
    (_line("2026-07-12T07:31", " ", 20.0, 50, 1.0), None),
    ("not json", MALFORMED),
    ('{"observed_at": "2026-07-12T07:30", "city": "Ri', MALFORMED),
    ("[1,2]", MALFORMED),
    ("", "blank"),
    (_line("2026-07-12T07:32", "Riga", 20.0, 71.5, 1.0), "invalid:humidity_pct"),
    (_line("2026-07-12T07:33", "Riga", "n/a", 71, 1.0), "invalid:temperature_c"),
    (_line("2026-07-12T07:30+02:00", "Riga", 20.0, 50, 1.0), "invalid:observed_at"),
    (_line("2026-07-12T07:34", "Riga", pressure=1013), None),
    (RIGA_AGAIN, None),
    (_line("2026-07-11T23:45", "Warsaw", 18.0, 55, 2.0), None),
    (_line("2026-07-12T07:45", "Warsaw", 75.0, 101, -1.0), None),
    (_line("2026-07-12T07:46", 0), None),
    (_line("2026-07-12T0730Z", "Riga", 20.0, 50, 1.0), "invalid:observed_at"),
    (_line("2026-07-12T07:47", "Riga", 20.0, 50, 1.0, ingested_at="yesterday"), "invalid:ingested_at"),
    (_line(5, "Riga", 20.0, 50, 1.0), "invalid:observed_at"),
]

# Text behind a complete record, and other lines that are not exactly one object.
NOT_ONE_OBJECT = [
    RIGA + " trailing",
    RIGA + RIGA_AGAIN,
    RIGA + "," + RIGA_AGAIN,
    RIGA + "]",
    RIGA + "} x",
    "[" + RIGA + "]",
    RIGA.replace('"', "'"),
    '"text"',
    "5",
    "null",
]


def write_folder(root, day, lines, name="part.json"):
    folder = root / f"load_date={day}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text("\n".join(lines) + "\n")
