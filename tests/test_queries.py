"""Every core query against its SQL, the driver's contract, and the shared folder."""

import os
import subprocess
import sys
from types import SimpleNamespace

import pytest
from oracle import SF_DIR, both

from curlew import acquisition_queries as acquisition
from curlew import queries as core
from curlew.session import materialize, release, shared_dir

QUERIES, ORACLES = core.QUERIES | acquisition.QUERIES, core.ORACLES | acquisition.ORACLES
needs_data = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables here")


@needs_data
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    found, expected = both(spark, QUERIES[name], ORACLES[name])
    assert found == expected


@needs_data
@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


@needs_data
def test_migrated_file_counts_are_those_of_the_migration(spark):
    from pyspark.sql import functions as F

    from curlew.plans import delivery
    from curlew.queries import _ledger

    expanded = delivery.migrate_ledger(_ledger(spark, SF_DIR))["files"].groupBy("file_type", "status").agg(F.count(F.lit(1)).alias("files"))
    found = QUERIES["l_migrated_files"](spark, SF_DIR)
    assert sorted(map(tuple, found.select("file_type", "status", "files").collect()), key=repr) == sorted(map(tuple, expanded.collect()), key=repr)


def test_entry_without_the_llm_subpackage():
    broken = "import sys; sys.modules['regex'] = None\nimport __spark_entry__ as e\ntry:\n    e.queries()\nexcept ModuleNotFoundError as x:\n    assert x.name == 'regex'\nelse:\n    raise SystemExit('a missing library must not pass for a missing subpackage')"
    here = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if os.path.isdir(os.path.join(here, "curlew", "llm")):
        subprocess.run([sys.executable, "-c", broken], cwd=here, check=True)
    code = "import sys; sys.modules['curlew.llm'] = None\nimport __spark_entry__ as e\nassert not any(k.startswith('p1_') for k in e.queries()) and set(e.oracle_sql()) <= set(e.queries())"
    subprocess.run([sys.executable, "-c", code], cwd=os.path.dirname(os.path.dirname(os.path.abspath(__file__))), check=True)


def test_shared_folder(spark):
    df = materialize(spark.range(10), "numbers")
    assert df.count() == 10 and shared_dir(spark).removeprefix("file://") in df.inputFiles()[0]
    release(spark)
    fake = SimpleNamespace(conf=SimpleNamespace(get=lambda *a: None), sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError):
        shared_dir(fake)
