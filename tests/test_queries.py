"""Every registered query against its check text (SF_DIR selects the table folder)."""

import pytest
from compare import compare, database

from sparkdeck.plans import CHECKS, QUERIES

@pytest.fixture(scope="module")
def db(sf_dir):
    return database(sf_dir)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, db, name):
    df = QUERIES[name](spark, sf_dir)
    if name in CHECKS:
        assert compare(df, db, CHECKS[name]) == ""
    else:
        assert df.count() > 0


def test_every_entry_has_a_check():
    """Stems come from a small word function and have none."""
    assert set(QUERIES) - set(CHECKS) == {"j02_stem_counts"}


def test_names():
    assert set(CHECKS) <= set(QUERIES)
    assert len(QUERIES) > 240
