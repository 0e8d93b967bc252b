"""The whole chain as one function: raw file → validation → cleaning → reports.

Same stages as the original runner, without its process orchestration:
each stage is a lazy plan; the sinks are the only actions.  The validation
result is written once (valid rows, quarantine and totals read it), the clean
table is written once (every report reads it).
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import DataFrame, SparkSession

from salescope.operators import clean as C
from salescope.operators import hypothesis as H
from salescope.operators import missing as MI
from salescope.operators import model as M
from salescope.operators import profile as PR
from salescope.operators import timeseries as TS
from salescope.operators import validate as V
from salescope.plans import reports as RP
from salescope.schema import NUMERIC
from salescope.sources import sinks
from salescope.sources.text import head_n, read_delimited


@dataclass
class PipelineResult:
    totals: DataFrame
    discard_reasons: DataFrame
    missing_report: DataFrame
    clean: DataFrame
    clean_summary: DataFrame
    zscore_params: DataFrame
    descriptive: DataFrame
    reports: dict[str, DataFrame]


def run(spark: SparkSession, input_path: str, out_dir: str, sample: int | None = None) -> PipelineResult:
    """Validate ``input_path`` (``;`` CSV with header), write outputs under ``out_dir``, return reports.

    ``sample`` keeps the first N records (record number <= N), like the
    original's test option.  Outputs: ``valid.parquet``, ``quarantine`` (text),
    ``checked`` (validation result), ``clean.parquet`` (by month) and the JSON
    reports.
    """
    out = out_dir.rstrip("/")
    header, records = read_delimited(spark, input_path)
    if sample:
        records = head_n(records, sample)
    V.first_failure(records, header).write.mode("overwrite").parquet(f"{out}/checked")
    checked = spark.read.parquet(f"{out}/checked")
    valid = V.valid_rows(checked)
    sinks.write_rows(valid, f"{out}/valid.parquet", order_by="record_no")
    sinks.write_quarantine(V.quarantine_lines(checked), f"{out}/quarantine")
    totals = V.validation_totals(checked)
    reasons = V.discard_reasons(checked)

    typed = C.coerce_types(valid)
    missing = PR.missing_report(typed.drop("record_no"))
    gaps = {"resumen_faltantes": MI.missing_summary(typed.drop("record_no")),
            "pruebas_patron_faltantes": MI.missing_patterns(typed.drop("record_no"))}
    extra = [c for c in ("product", "first_names", "last_names") if c in typed.columns]
    cleaned = C.clean(typed.drop(*extra), cut_lineage=True)
    sinks.write_rows(PR.with_month(cleaned), f"{out}/clean.parquet", public_names=False, partition_by=PR.MONTH)
    by_month = spark.read.parquet(f"{out}/clean.parquet")  # PR.period on this reads the months it needs
    cl = by_month.drop(PR.MONTH)
    summary = PR.clean_summary(cl)
    zparams = C.zscore_params(cl)
    desc = PR.descriptive_stats(cl, NUMERIC)
    written = {"resumen_validacion": totals, "razones_descarte": reasons, "reporte_faltantes": missing, **gaps,
               "resumen_preprocesamiento": summary, "parametros_normalizacion": zparams,
               "estadisticas_descriptivas": desc, **analyses(spark, by_month, V.quarantine(checked))}
    for name, df in written.items():
        sinks.write_json_report(df, f"{out}/reports/{name}")
    reports = {name: spark.read.schema(df.schema).json(f"{out}/reports/{name}") for name, df in written.items()}
    return PipelineResult(totals, reasons, missing, by_month, summary, zparams, desc, reports)


def analyses(spark: SparkSession, clean: DataFrame, discards: DataFrame,
             start: str | None = None, end: str | None = None) -> dict[str, DataFrame]:
    """The exploratory and inferential reports of the clean table, or of a period of it."""
    cl = PR.period(clean, start, end).drop(PR.MONTH)
    pairs = list(combinations(NUMERIC, 2))
    daily = PR.daily_sales(cl)
    return {
        "kpis": PR.period_kpis(cl, discards),
        "normalidad": RP.normality(cl),
        "correlaciones_spearman": H.with_spearman_pvalues(H.spearman_pairs(cl, pairs)),
        "asociaciones": RP.association_suite(cl),
        "analisis_temporal": TS.temporal_status(daily),
        "pruebas_hipotesis": RP.hypothesis_suite(cl),
        "diagnostico_regresion_lineal": RP.linear_report(spark, RP.linear_diagnostics(cl)),
        "metricas_modelo": RP.boosted_metrics(cl, minimum=M.MIN_BOOSTED_ROWS),
    }
