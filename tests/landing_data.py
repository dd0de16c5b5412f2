"""Hand-made landing batches with the awkward rows every dataset must survive."""

from __future__ import annotations

import json
from pathlib import Path

CIRCUITS_HEADER = "circuitId,url,circuitName,lat,long,locality,country\n"
RACES_HEADER = "season,round,url,raceName,date,circuitId\n"

CIRCUITS = """monza,u,AUTODROMO NAZIONALE DI MONZA,45.6156,9.2811,monza,Italy
spa,u,circuit de spa-francorchamps,50.4372,5.9713,SPA,Belgium
spa,u,circuit de spa-francorchamps,50.4372,5.9713,SPA,Belgium
,u,nowhere,0,0,none,None
interlagos,u,autódromo josé carlos pace,-23.7036,-46.6997,são paulo,Brazil
"""

RACES = """2024,1,u,ITALIAN GRAND PRIX,2024-09-01,monza
2024,2,u,belgian grand prix,2024-07-28,spa
2024,2,u,belgian grand prix,2024-07-28,spa
2024,3,u,lost race,2024-10-01,unknown
2024,4,u,no circuit,2024-11-01,
2024,,u,no round,2024-12-01,spa
"""

CONSTRUCTORS = [
    {"constructorId": "ferrari", "name": "Ferrari", "nationality": "ITALIAN", "url": "u"},
    {"constructorId": "ferrari", "name": "Ferrari", "nationality": "ITALIAN", "url": "u"},
    {"constructorId": "mclaren", "name": "McLaren", "nationality": "british"},
    {"constructorId": "mars", "name": "Mars", "nationality": "martian"},
    {"name": "no id", "nationality": None},
    {"name": "no id either"},
]

DRIVERS = [
    {"driverId": "leclerc", "name": {"givenName": "CHARLES", "familyName": "LECLERC"},
     "dateOfBirth": "1997-10-16", "nationality": "MONEGASQUE", "url": "u"},
    {"driverId": "norris", "name": {"givenName": "lando", "familyName": "norris"},
     "dateOfBirth": "1999-11-13", "nationality": "british"},
    {"driverId": "mixed", "name": {"familyName": "o'brien"}, "nationality": "ARGENTINE-ITALIAN"},
    {"driverId": "empty", "name": {}, "nationality": None},
    {"driverId": "none"},
    {"name": {"givenName": "no", "familyName": "id"}},
]


def session(season, round_, constructor, driver, position, points, **more):
    row = {
        "date": "2024-09-01", "raceName": "ITALIAN GRAND PRIX", "round": round_, "season": season,
        "url": "u", "constructorId": constructor, "driverId": driver, "grid": 1, "laps": 53,
        "number": 16, "points": points, "position": position,
        "positionText": str(position or "R"), "status": "Finished",
    }
    return {**row, **more}


RESULTS = [
    session(2024, 1, "ferrari", "leclerc", 1, 25),
    session(2024, 1, "ferrari", "leclerc", 1, 25),
    session(2024, 1, "mclaren", "norris", 3, 15),
    session(2024, 2, "mclaren", "norris", 1, 25),
    session(2024, 2, "ferrari", "leclerc", 3, 12.5),
    session(2024, 2, "mars", "mixed", None, 0, status="Retired"),
    session(2024, 1, "mars", "mixed", 4, None),
    session(2024, 2, "mclaren", "mixed", 4, 2.5),
    session(2024, None, "mclaren", "norris", 1, 99),
    session(2024, 1, None, "norris", 1, 99),
    session(2024, 1, "mclaren", None, 1, 99),
    session(None, 1, "mclaren", "norris", 1, 99),
]

SPRINTS = [
    session(2024, 1, "ferrari", "leclerc", 2, 7),
    session(2024, 1, "mclaren", "norris", 1, 8),
]


def write_landing(
    folder: Path, *, circuits=CIRCUITS, races=RACES, constructors=CONSTRUCTORS, drivers=DRIVERS,
    results=RESULTS, sprints=SPRINTS,
) -> None:
    (folder / "results").mkdir(parents=True)
    (folder / "sprints").mkdir()
    (folder / "circuits.csv").write_text(CIRCUITS_HEADER + circuits)
    (folder / "races.csv").write_text(RACES_HEADER + races)
    for name, data in (("constructors.json", constructors), ("drivers.json", drivers)):
        (folder / name).write_text("".join(json.dumps(row) + "\n" for row in data))
    half = len(results) // 2
    for name, data in (("1.json", results[:half]), ("2.json", results[half:])):
        (folder / "results" / name).write_text("".join(json.dumps(row) + "\n" for row in data))
    (folder / "sprints" / "all.json").write_text(json.dumps(sprints, indent=2))
    (folder / "sprints" / "one.json").write_text(json.dumps(sprints[0], indent=2))
