"""Every fixture adapter produces the declared bronze types; conform fills the rest."""

import pytest

from pitboss.sources import schemas
from pitboss.sources.sinks import conform


@pytest.mark.parametrize("adapter", sorted(schemas.ADAPTER_TABLE))
def test_adapter_matches_bronze_schema(bronze, adapter):
    df = getattr(bronze, adapter)
    declared = schemas.schema(schemas.ADAPTER_TABLE[adapter])
    types = {f.name: f.dataType for f in declared.fields}
    for f in df.schema.fields:
        if f.name in types:
            assert f.dataType == types[f.name], (adapter, f.name, f.dataType, types[f.name])
    conformed = conform(df, declared)
    assert [f.name for f in conformed.schema.fields] == [f.name for f in declared.fields]
    assert conformed.limit(5).count() >= 0


def test_plans_run_on_conformed_bronze(spark, bronze):
    """The README quick start: plans on conformed bronze shapes give the same fact."""
    import datetime as dt
    from types import SimpleNamespace
    from pitboss.plans import silver
    b = SimpleNamespace(**{n: conform(getattr(bronze, n), schemas.schema(t))
                           for n, t in schemas.ADAPTER_TABLE.items()})
    f, t = dt.date(2024, 1, 5), dt.date(2024, 1, 20)
    a = silver.membership_day(b, f, t)
    e = silver.membership_day(bronze, f, t)
    assert a.exceptAll(e).count() == 0 and e.exceptAll(a).count() == 0
