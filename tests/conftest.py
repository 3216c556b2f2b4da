from __future__ import annotations

import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [HERE, os.path.dirname(HERE)]

from shared import SF_SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    from postline.session import local_session
    session = local_session(cores="*", shuffle_partitions=8, app="postline-tests")
    yield session


@pytest.fixture(scope="session")
def small_landing(spark):
    """Landing rows from the smallest driver tables, written once per session."""
    import tempfile

    from postline.plans.models import landing_from_tables
    path = tempfile.mkdtemp(prefix="postline-test-landing-") + "/raw"
    landing_from_tables(spark, SF_SMALL).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def small_models(spark, small_landing):
    import tempfile

    from postline.plans.models import materialise_models
    root = tempfile.mkdtemp(prefix="postline-test-models-")
    return materialise_models(small_landing, root)
