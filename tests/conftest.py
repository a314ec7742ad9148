import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from tabflow.session import local_session
    s = local_session("*", app="tabflow-tests")
    yield s
    s.stop()


@pytest.fixture(autouse=True)
def no_views_left(request):
    """Temporary views end with the test that made them: the session is shared."""
    yield
    if "spark" in request.fixturenames:
        session = request.getfixturevalue("spark")
        for t in session.catalog.listTables():
            if t.isTemporary:
                session.catalog.dropTempView(t.name)
