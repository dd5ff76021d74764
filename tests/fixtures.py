"""Small inline inputs of the shapes in FIXTURES.md, written to a scratch folder."""

from __future__ import annotations

import json
import os


def listing(code, municipality, district, neighborhood, price, distance="415", **extra):
    row = {
        "propertyCode": code,
        "price": price,
        "propertyType": "flat",
        "operation": "sale",
        "size": 80.0,
        "rooms": 3,
        "bathrooms": 1,
        "municipality": municipality,
        "latitude": 41.37,
        "longitude": 2.16,
        "distance": distance,
        "status": "good",
        "newDevelopment": False,
        "priceByArea": 3500.0,
        "detailedType": {"typology": "flat"},
    }
    if district is not None:
        row["district"] = district
    if neighborhood is not None:
        row["neighborhood"] = neighborhood
    row.update(extra)
    return row


SNAPSHOTS = {
    "2020_01_02_listings.json": [
        listing("p1", "Barcelona", "Alta-Marçà", "El Camp Gran", 280000.0),
        listing("p2", "Barcelona", "Quadrat", "Pont Gris", 300000.0),
        listing("p5", "Barcelona", "Vall-Serradó", "Serra", 200000.0),
    ],
    "2020_06_01_listings.json": [
        listing("p1", "Barcelona", "Alta-Marçà", "El Camp Gran", 290000.0),
        listing("p3", "Barcelona", "Quadrat", None, 1.0),  # no neighbourhood
        listing("p4", "Badalona", "Centre", "Centre", 2.0),  # other municipality
        listing("p6", "Barcelona", "Quadrat", "Pont Gris", 100000.0, distance="bad"),
    ],
    "2020_11_11_listings.json": [],  # empty snapshot
    "2021_01_01_listings.json": [listing("p7", "Barcelona", None, "Pont Gris", 5.0)],  # no district key at all
}


def write_snapshots(root: str) -> str:
    d = os.path.join(root, "snapshots")
    os.makedirs(d, exist_ok=True)
    for name, rows in SNAPSHOTS.items():
        with open(os.path.join(d, name), "w") as fp:
            json.dump(rows, fp, indent=1, ensure_ascii=False)
    with open(os.path.join(d, "notes.txt"), "w") as fp:
        fp.write("not a snapshot")
    return d


INCOME_HEADER = '"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Població","Índex RFD Barcelona = 100"\n'


def write_income_csv(root: str) -> str:
    d = os.path.join(root, "income")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "2015_income.csv"), "w", encoding="utf-8") as fp:
        fp.write(INCOME_HEADER)
        fp.write('2015,3,"Alta-Marçà",11,"el Camp-gran",40000,"70.0"\n')
        fp.write('2015,2,"Quadrat",5,"Pont Gris",30000,"100.0"\n')
    with open(os.path.join(d, "2016_income.csv"), "w", encoding="utf-8") as fp:
        fp.write(INCOME_HEADER)
        fp.write('2016,3,"Alta-Marçà",11,"el Camp-gran",40000,"71.5"\n')
        fp.write('2016,2,"Quadrat",5,"Pont Gris",30000,"106.5"\n')
        fp.write('2016,1,"Vila Fosca",4,"Santa Font, Santa Pedra i la Llera",20000,"61.25"\n')
        fp.write('2016,2,"Quadrat",5,"Pont Gris",30001,"107.0"\n')  # repeated key: last wins
    return d


def write_occupancy_csv(root: str) -> str:
    d = os.path.join(root, "inhabitants")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "inhabitants.csv"), "w", encoding="utf-8-sig") as fp:  # with BOM
        fp.write('"Any","Codi_Districte","Nom_Districte","Codi_Barri","Nom_Barri","Poblacio","Domicilis","Ocupacio_mitjana_(persones_ per_domicili)"\n')
        fp.write('2020,3,"Alta-Marçà",11,"el Camp-gran",40000,18518,"2.16"\n')
        fp.write('2020,2,"Quadrat",5,"Pont Gris",30000,11538,"2.75"\n')
        fp.write('2020,1,"Vila Fosca",4,"Santa Font, Santa Pedra i la Llera",20000,8000,"2.50"\n')
    return os.path.join(d, "inhabitants.csv")


PAIR_HEADER = "district,neighborhood,district_n_reconciled,district_n,district_id,neighborhood_n_reconciled,neighborhood_n,neighborhood_id\n"


def write_pair_lookups(root: str) -> tuple[str, str]:
    d = os.path.join(root, "pair_lookups")
    os.makedirs(d, exist_ok=True)
    a = os.path.join(d, "listing_extended.csv")
    b = os.path.join(d, "income_extended.csv")
    with open(a, "w") as fp:
        fp.write(PAIR_HEADER)
        fp.write("Alta-Marçà,El Camp Gran,Alta-Marçà,alta marca,Q1,el Camp-gran,el camp gran,Q10\n")
        fp.write("Quadrat,Pont Gris,Quadrat,quadrat,Q2,Pont Gris,pont gris,Q20\n")
        fp.write("Vall-Serradó,Serra,Vall-Serradó,vall serrado,Q3,Serra,serra,Q30\n")
    with open(b, "w") as fp:
        fp.write(PAIR_HEADER)
        fp.write("Alta-Marçà,el Camp-gran,Alta-Marçà,alta marca,Q1,el Camp-gran,el camp gran,Q10\n")
        fp.write("Quadrat,Pont Gris,Quadrat,quadrat,Q2,Pont Gris,pont gris,Q20\n")
        fp.write('Vila Fosca,"Santa Font, Santa Pedra i la Llera",Vila Fosca,vila fosca,Q4,Santa Font,santa font,Q40\n')
    return a, b


RENT_LOOKUP = [
    {"_id": "Q10", "ne": "El Camp Gran", "ne_n": "el camp gran", "ne_re": "el Camp Gran"},
    {"_id": "Q20", "ne": "Pont Gris", "ne_n": "pont gris", "ne_re": "Pont Gris"},
    {"_id": "Q30", "ne": "Serra", "ne_n": "serra", "ne_re": '"Serra, Barcelona"'},
]
INCOME_LOOKUP = [
    {"_id": "Q10", "neighborhood": "el Camp-gran", "neighborhood_name": "el camp gran", "neighborhood_reconciled": "el Camp Gran"},
    {"_id": "Q20", "neighborhood": "Pont Gris", "neighborhood_name": "pont gris", "neighborhood_reconciled": "Pont Gris"},
    {"_id": "Q30", "neighborhood": "Serra", "neighborhood_name": "serra", "neighborhood_reconciled": '"Serra, Barcelona"'},
    # the raw name itself carries literal quotes, so it never matches the CSV name
    {"_id": "Q40", "neighborhood": '"Santa Font, Santa Pedra i la Llera"', "neighborhood_name": "santa font", "neighborhood_reconciled": '"Santa Font, Santa Pedra i la Llera"'},
]
INCOME_DISTRICT_LOOKUP = [
    {"_id": "Q2", "district": "Quadrat", "district_name": "quadrat", "district_reconciled": "Quadrat", "neighborhood_id": ["Q20"]},
]
INCOME_DOCS = [
    {"neigh_name": "el Camp-gran", "info": [{"year": 2016, "RFD": 71.5}, {"year": 2017, "RFD": 78.0}]},
    {"neigh_name": "Pont Gris", "info": [{"year": 2017, "RFD": 106.5}, {"year": 2015, "RFD": 100.0}]},
    {"neigh_name": "Serra", "info": [{"year": 2016, "RFD": 90.0}, {"year": 2016, "RFD": 95.0}]},  # tie
    {"neigh_name": "Vallombra", "info": []},
    {"neigh_name": "Les Eres", "info": None},
]


def _json_lines(path: str, rows) -> str:
    with open(path, "w") as fp:
        for r in rows:
            fp.write(json.dumps(r, ensure_ascii=False) + "\n")
    return path


def write_name_lookups(root: str) -> dict[str, str]:
    d = os.path.join(root, "lookup_tables")
    os.makedirs(d, exist_ok=True)
    return {
        "dir": d,
        "rent": _json_lines(os.path.join(d, "rent_lookup_neighborhood.json"), RENT_LOOKUP),
        "income": _json_lines(os.path.join(d, "income_lookup_neighborhood.json"), INCOME_LOOKUP),
        "district": _json_lines(os.path.join(d, "income_lookup_district.json"), INCOME_DISTRICT_LOOKUP),
    }


def write_income_docs(root: str) -> str:
    d = os.path.join(root, "income_docs")
    os.makedirs(d, exist_ok=True)
    return _json_lines(os.path.join(d, "income_neighborhood.json"), INCOME_DOCS)
