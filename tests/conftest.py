import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from wardlight.schema import CLINICAL_TABLES  # noqa: E402
from wardlight.session import build_session, release_scratch  # noqa: E402
from wardlight.sources.clinical import ClinicalTables  # noqa: E402
from wardlight.sources.fixtures import load_fixture  # noqa: E402

SMALL = "/root/testdata/sf0.001"
TODAY = dt.datetime(2024, 6, 30)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "local[4]", 4, spark__ui__enabled="false", spark__driver__memory="4g",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    release_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    return load_fixture(spark, SMALL)


@pytest.fixture
def clinic(spark):
    """Builds clinical tables from dictionaries; a column left out is null."""
    def build(as_of=TODAY.date(), **rows) -> ClinicalTables:
        def frame(name):
            schema = CLINICAL_TABLES[name]
            data = [tuple(r.get(f.name) for f in schema) for r in rows.get(name, [])]
            return spark.createDataFrame(data, schema)

        return ClinicalTables(spark, {n: (lambda n=n: frame(n)) for n in CLINICAL_TABLES}, as_of)

    return build


@pytest.fixture
def stay():
    """An encounter dictionary: days count from the reference day."""
    def build(number, patient, start, length, **more):
        admitted = TODAY + dt.timedelta(days=start)
        return {"encounter_id": f"e{number}", "patient_id": patient, "admission_date": admitted,
                "discharge_date": admitted + dt.timedelta(days=length),
                "length_of_stay": length, "encounter_type": "Inpatient",
                "facility": "North", **more}

    return build


@pytest.fixture
def person():
    def build(patient):
        return {"patient_id": patient, "mrn": f"M-{patient}", "first_name": "A", "last_name": patient,
                "age": 50}

    return build


@pytest.fixture
def coordinator():
    def build(cid, capacity, specialties='["CHF"]', years=5, active=True):
        return {"coordinator_id": cid, "name": f"N-{cid}", "title": "Care Coordinator",
                "current_caseload": 30 - capacity, "max_caseload": 30,
                "available_capacity": capacity, "specialties": specialties,
                "years_experience": years, "active": active}

    return build
