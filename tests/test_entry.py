import subprocess
import sys
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from strider.plans import registry

DATA = Path("/root/testdata/sf0.001")
CHECKED = ("session_segments", "dedup_winner", "value_nulling", "phase_labels", "turn_window", "run_collapse_event_type", "movements_nearest", "asof_phase", "topn_folded_other", "quality_violations", "legacy_rolling_phase", "uniqueness_surplus")


def test_every_query_of_the_engine_has_sql():
    assert set(registry.oracle_sql()) == set(registry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())


def test_import_needs_no_session_and_no_optional_part():
    code = "import sys; sys.modules['strider.llm'] = None; sys.modules['corpus_pipeline'] = None; import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).resolve().parent.parent, check=True)
    assert out.stdout.split() == [str(len(registry.queries()))] * 2


def plain(v):
    return float(f"{v:.9g}") if isinstance(v, float) else v


@pytest.mark.parametrize("name", CHECKED)
@pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")
def test_rows_equal_the_sqls(spark, name):
    df = registry.queries()[name](spark, str(DATA))
    con = duckdb.connect()
    for p in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    cur = con.execute(registry.oracle_sql()[name])
    names = [c[0] for c in cur.description]
    assert sorted(names) == sorted(df.columns)
    key = lambda r: tuple(str(plain(r[c])) for c in sorted(names))
    assert sorted(map(key, [r.asDict() for r in df.collect()])) == sorted(map(key, [dict(zip(names, r)) for r in cur.fetchall()]))


@pytest.mark.skipif(not DATA.exists(), reason="the test tables are not here")
def test_flagship(spark):
    assert entry.entry(spark).limit(1).count() == 1
