"""The whole chain on the 28-row fixture, through the sinks."""

import tempfile

from salescope.operators import profile as PR
from salescope.plans.pipeline import run
from tests.test_validate import FIXTURE


def test_pipeline_on_fixture(spark):
    d = tempfile.mkdtemp(prefix="salescope-pipe-")
    with open(f"{d}/in.csv", "w", encoding="utf-8") as f:
        f.write(FIXTURE)
    res = run(spark, f"{d}/in.csv", f"{d}/out")
    t = res.totals.first()
    assert (t["read"], t["valid"], t["discarded"]) == (28, 12, 16)
    assert res.clean.count() == 12
    valid = spark.read.parquet(f"{d}/out/valid.parquet")
    assert valid.count() == 12 and "MONTO APLICADO" in valid.columns
    q = spark.read.text(f"{d}/out/quarantine")
    assert q.count() == 18
    assert spark.read.json(f"{d}/out/reports/estadisticas_descriptivas").count() == 6
    assert set(res.reports) >= {"kpis", "normalidad", "correlaciones_spearman", "asociaciones", "analisis_temporal",
                                "pruebas_hipotesis", "diagnostico_regresion_lineal", "metricas_modelo"}
    counts = {k: v.count() for k, v in res.reports.items()}
    assert counts["pruebas_hipotesis"] == 9 and counts["normalidad"] == 6 and counts["correlaciones_spearman"] == 15
    assert counts["asociaciones"] == 9 and counts["diagnostico_regresion_lineal"] > 1
    assert res.reports["kpis"].first()["discarded"] == 16
    plan = PR.period(res.clean, "2024-05-01", "2024-05-31")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(sale_month" in plan
    s = res.clean_summary.first()
    assert s["rows"] == 12
