import re
import shutil
import subprocess
import sys

import duckdb
import pytest
from tests.conftest import ROOT

DATA = "/root/testdata/sf0.001"
TABLES = "documents part"


def test_names_and_sql_go_together():
    sys.path.insert(0, ROOT)
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_has_rows(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["s1", "cand", "overlap", "rank"]
    assert e.entry(spark).limit(1).count() == 1


@pytest.mark.parametrize("name", ["blocking_topk", "blocking_topk_ties", "feature_frame_sql", "rule_score_no_seq", "candidates_all_s1", "first5_examples", "recall_ceiling", "holdout_split", "source_profile", "normalize_text"])
def test_against_duckdb(spark, name):
    from kinlink.plans.queries import ORACLE_SQL, QUERIES

    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view {t} as select * from '{DATA}/{t}.parquet'")
    df = QUERIES[name](spark, DATA)
    r = con.execute(ORACLE_SQL[name])
    names = [x[0] for x in r.description]
    assert sorted(names) == sorted(df.columns)
    own, other = (sorted((tuple(x) for x in rows), key=str) for rows in (df.select(*sorted(names)).collect(), [[x[names.index(c)] for c in sorted(names)] for x in r.fetchall()]))
    assert own == other


def test_works_without_the_training_data_package(tmp_path):
    copy = tmp_path / "copy"
    shutil.copytree(ROOT, copy, ignore=lambda d, names: [n for n in names if n in ("llm", "corpus_pipeline.py", ".git", "__pycache__")])
    code = "import __spark_entry__ as e; q = e.queries(); assert 'blocking_topk' in q and not [x for x in q if x.startswith('op') or x == 'pipeline']; assert set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={"PATH": "/usr/bin:/bin"})


def test_nothing_else_imports_the_training_data_package():
    found = subprocess.run(["grep", "-rlE", r"^\s*(from|import) .*\bllm\b", f"{ROOT}/kinlink", "--include=*.py"], capture_output=True, text=True).stdout.split()
    assert [f for f in found if not re.search(r"/kinlink/llm/", f)] == []
