"""A small lake: raw files and dimensions shaped like the real inputs."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F

from casebook.plans import pipeline
from casebook.sources import reference_files

INCIDENTS = """ID,EventDate,Employer,City,State,Nature,Hospitalized,Amputation,Final Narrative
41,03/02/2024,Bluefern Mills LLC,Ridgemont,Oregon,Sprains,3,0,"Slipped on wet floor, knee twisted."
42,03/05/2024,Kestrel Foods #771,Larkspur,Kentucky,Cuts,0,2,Glove pulled into a slicer.
43,03/09/2024,Quarry Nine Co,Sandpoint,New Mexico,Heat,1,0,"Fainted at noon
after a double shift."

44,03/11/2024,Tallgrass Freight,Windmere,Kansas,Strain,2,0,Lifted a crate.
45,03/20/2024,Bluefern Outlet,Ridgemont,Oregon,Bruises,1,1,Shelf gave way.
"""
SURVEY = """SURVEYSTATUS,ESTAB_NAME,STREET,CITY,STATE,ZIP,Year,SIC,NAICS,PHONE,EMP_Q1,HOURS_Q2,OREASON_DESC,INJ_M1
3,HALYARD,9 QUAY ROW,COLDWATER,ME,04999,2023,1111,222200,2075550101,90,210000,,4
3,MARLOW,77 DEPOT LANE,SANDPOINT,NM,87999,2023,1112,333300,5055550102,35,80000,,1
"""
# Same dataset, another header order and fewer columns.
SURVEY_OLD = """ESTAB_NAME2,ESTAB_NAME,CITY,STATE,Year,EMP_Q1
SPARE NAME,,SANDPOINT,NM,2003,8
"""
UNMAPPED = """Company_Name,CITY,State,Extra
Pinyon - 9 ,Sandpoint,NM,x
"""
GAZETTEER = """2031 places
made by hand
USPS\tGEOID\tANSICODE\tNAME\tALAND\tAWATER\tALAND_SQMI\tAWATER_SQMI\tINTPTLAT\tINTPTLONG
OR\t9100001\t09100001\tRidgemont city\t1\t2\t3\t4\t44.1\t-121.3
KY\t9200002\t09200002\tLarkspur-Dover metropolitan government (balance)\t1\t2\t3\t4\t37.2\t-85.5
NM\t9300003\t09300003\tSandpoint city\t1\t2\t3\t4\t34.4\t-106.2
NM\t9300004\t09300004\tSandpoint town\t9\t9\t9\t9\t35.5\t-105.1
ME\t9400005\t09400005\tColdwater city\t1\t \t3\t4\t45.6\t-69.9
"""
LISTINGS = """﻿Symbol,Name,Last Sale,Net Change,% Change,Market Cap,Country,IPO Year,Volume,Sector,Industry
HLYD,"Halyard.com, Inc. Common Stock",$18,1,1%,1900,Iceland,2011,5,Consumer,Ropes
NMBSA,Nimbus Inc. Class A Common Stock,$15,1,1%,,Iceland,2014,5,,Weather
NMBS,Nimbus Inc. Class A Common Stock,$16,1,1%,1800,Iceland,2014,6,Technology,Weather
MRLW,Marlow Corporation Common Stock,$14,1,1%,70,Iceland, ,5,Consumer,Depots
,No Symbol Inc.,1,1,1,1,x,x,x,x,x
"""
CURATED = [("Kestrel Foods Inc", " Kestrel-Foods ", ["kestrel foods", "KESTREL"])]


def build(spark, root: Path) -> pipeline.Paths:
    paths = pipeline.Paths(f"file:{root}/lake")
    raw = root / "lake" / "landing"
    files = {
        "estuary/OSHA/severe-incident/small.csv": INCIDENTS,
        "estuary/OSHA/odi-02-11/new.csv": SURVEY,
        "estuary/OSHA/odi-02-11/old.csv": SURVEY_OLD,
        "estuary/fda/recalls/a file.csv": UNMAPPED,
        "estuary/OSHA/ita/out.json": "{}",
        "reef/OSHA/x.csv": INCIDENTS,
    }
    for name, text in files.items():
        (raw / name).parent.mkdir(parents=True, exist_ok=True)
        (raw / name).write_text(text)
    (root / "gazetteer.txt").write_text(GAZETTEER)
    (root / "listings.csv").write_text(LISTINGS)
    pipeline.build_dimensions(
        spark, paths,
        reference_files.read_gazetteer(spark, f"file:{root}/gazetteer.txt"),
        reference_files.read_listings(spark, f"file:{root}/listings.csv"),
        CURATED,
    )
    return paths


def stamp(text: str):
    return F.lit(text).cast("timestamp")
