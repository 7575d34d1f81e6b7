"""Every registered query against SQL on another engine, all cells."""

import subprocess
import sys
from pathlib import Path

import pytest

import __spark_entry__ as registry
import oracle
from conftest import SF_DIR


@pytest.fixture(scope="module")
def engine():
    return oracle.connect(SF_DIR)


# Queries of the optional package have tests of their own.
EXTRA = set(registry.llm_queries.queries()) | {"pipeline"} if registry.llm_queries else set()
NAMES = sorted(set(registry.queries()) - EXTRA)


def test_every_query_has_sql():
    assert set(NAMES) == set(registry.oracle_sql()) - EXTRA


@pytest.mark.parametrize("name", NAMES)
def test_matches_sql(spark, engine, name):
    result = registry.queries()[name](spark, SF_DIR)
    assert oracle.differences(result, engine, registry.oracle_sql()[name]) == []


# Row counts stated by the fixture description for this scale.
COUNTS = {
    "claims_source": 6000,
    "silver_valid": 5404,
    "quarantine_rows": 509,
    "validation_lost_rows": 87,
    "silver_job": 4231,
    "bronze_job": 4616,
    "medallion_end_to_end": 4086,
    "gold_dim_date": 1965,
    "gold_dim_member": 154,
    "gold_dim_provider": 10,
    "gold_dim_diagnosis": 7,
}


@pytest.mark.parametrize("name", sorted(COUNTS))
def test_sql_gives_the_known_counts(engine, name):
    sql = registry.oracle_sql()[name]
    assert engine.execute(f"SELECT count(*) FROM ({sql})").fetchone() == (COUNTS[name],)


def test_entry_is_the_flagship(spark):
    assert registry.entry(spark).count() == COUNTS["silver_job"]


ABSENT = """
import sys
class Hide:
    def find_spec(self, name, path=None, target=None):
        if name.split(".")[0] == "ahocorasick":
            raise ModuleNotFoundError(f"No module named {name!r}", name=name)
sys.meta_path.insert(0, Hide())
import __spark_entry__ as registry
print(len([n for n in registry.queries() if not n.startswith("op")]), len([n for n in registry.queries() if n.startswith("op")]))
"""


def test_a_library_of_the_optional_part_may_be_absent():
    root = Path(registry.__file__).parent
    done = subprocess.run([sys.executable, "-c", ABSENT], cwd=root, capture_output=True, text=True, check=True)
    assert done.stdout.split() == [str(len(NAMES)), "0"]
    if registry.llm_queries:
        assert "ahocorasick" in done.stderr
