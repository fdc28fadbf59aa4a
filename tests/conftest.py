from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from popscope import ship_package

    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoint")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    ship_package(session)
    return session


@pytest.fixture(scope="session")
def people(spark):
    """Two hundred made-up persons, with NULL and empty fields among them."""
    from popscope.person import EDUCATION_LEVEL, HOUSING_TYPE, MARITAL_STATUS, PERSON_SCHEMA, SEX

    provinces = ["서울", "부산", "대구", "인천", "광주"]
    rows = []
    for i in range(200):
        row = {name: f"{name} {i}" for name in PERSON_SCHEMA.names}
        row |= {
            "uuid": f"{i * 7919 % 200:032x}",
            "sex": SEX[i % 2],
            "age": 19 + i % 81,
            "province": provinces[i % 5],
            "district": f"{provinces[i % 5]}-{i % 3}구",
            "marital_status": MARITAL_STATUS[i % 4],
            "education_level": EDUCATION_LEVEL[i % 7],
            "housing_type": HOUSING_TYPE[i % 6],
            "family_type": f"가구 {i % 39}",
            "occupation": ["Data engineer", "nurse", "50% baker", "a_b \\ clerk"][i % 4],
        }
        rows.append(row)
    rows[0] |= {"province": None, "age": None, "occupation": None}
    rows[1] |= {"province": "", "occupation": "", "persona": "", "hobbies_and_interests": None}
    values = [tuple(row[name] for name in PERSON_SCHEMA.names) for row in rows]
    return spark.createDataFrame(values, PERSON_SCHEMA).repartition(5)
