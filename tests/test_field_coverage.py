import pytest
from pyspark.sql import functions as F

from reviewlens import config as cfg
from reviewlens.plans import conform_queries as cq
from reviewlens.plans import registry

SF = "/root/testdata/sf0.01"


def test_every_unified_field_is_profiled(spark):
    table = cq.unified(spark, SF)
    rows = table.select(*cfg.UNIFIED_FIELDS).collect()
    got = {r.column_name: r for r in registry.QUERIES["agg_field_coverage"](spark, SF).collect()}
    assert [r.column_name for r in sorted(got.values(), key=lambda r: r.position)] == list(cfg.UNIFIED_FIELDS) and len(got) == 27
    least = table.agg(*[F.min(c).cast("string").alias(c) for c in cfg.UNIFIED_FIELDS]).first()
    for c in cfg.UNIFIED_FIELDS:
        filled = sum(r[c] is not None for r in rows)
        assert got[c].n_filled == filled and got[c].coverage_pct == pytest.approx(100 * filled / len(rows), abs=0.051)
        assert got[c].example == (least[c][:40] if least[c] is not None else None)
