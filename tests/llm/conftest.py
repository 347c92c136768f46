from __future__ import annotations

import pytest


@pytest.fixture(autouse=True, scope="package")
def interpreted(spark):
    """Tiny tables: compiling each plan would take most of the time."""
    names = {"spark.sql.codegen.wholeStage": "false", "spark.sql.codegen.factoryMode": "NO_CODEGEN", "spark.sql.shuffle.partitions": "2"}
    before = {n: spark.conf.get(n) for n in names}
    for n, v in names.items():
        spark.conf.set(n, v)
    yield
    for n, v in before.items():
        spark.conf.set(n, v)
