"""Validation rules on the 28-row fixture and on edge values."""

import tempfile

from pyspark.sql import functions as F

from salescope.functions import parse as P
from salescope.operators import validate as V
from salescope.sources.text import read_delimited, volume_profile

HEADER = ("FECHA;CANAL;SKU;PRODUCTO;UNIDADES;PORCENTAJE DESCUENTO;MONTO APLICADO;BOLETA;LOCAL;"
          "CODIGO CLIENTE;RUN CLIENTE;NOMBRES;APELLIDOS;FECHA NACIMIENTO;GENERO")
COLUMNS = HEADER.split(";")
UUID = "0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f50"
GOOD = {"FECHA": "2024-05-02T09:00:00", "CANAL": "POS", "SKU": "17", "PRODUCTO": "CUADERNO AZUL", "UNIDADES": "2",
        "PORCENTAJE DESCUENTO": "0.0500", "MONTO APLICADO": "4200", "BOLETA": "900001", "LOCAL": "12",
        "CODIGO CLIENTE": UUID, "RUN CLIENTE": "9.876.543-3", "NOMBRES": "INES", "APELLIDOS": "PRUEBA",
        "FECHA NACIMIENTO": "1990-04-30", "GENERO": "1"}


def _record(**changes) -> str:
    return ";".join({**GOOD, **{k.replace("_", " "): v for k, v in changes.items()}}[c] for c in COLUMNS)


# 28 records, 12 of them valid; each of the others breaks one rule.
RECORDS = [
    _record(),
    _record(RUN_CLIENTE="9.876.543-4"),
    _record(CANAL="online", UNIDADES="+7"),
    _record(BOLETA=""),
    _record(SKU=" 18 ", PRODUCTO="LÁPIZ"),
    _record(CODIGO_CLIENTE="no-es-uuid"),
    _record(UNIDADES="0"),
    _record(PORCENTAJE_DESCUENTO="0"),
    _record(PORCENTAJE_DESCUENTO="1.2500"),
    _record(MONTO_APLICADO="0"),
    _record(PORCENTAJE_DESCUENTO="1"),
    _record().split(";", 1)[1],
    _record(CODIGO_CLIENTE=UUID.replace("-", "")),
    _record() + ";sobra",
    _record(FECHA="2024-x5-02T09:00:00"),
    _record(FECHA="2024-05-02"),
    _record(GENERO="3"),
    _record(GENERO="2"),
    _record(FECHA_NACIMIENTO="1990-02-31"),
    _record(FECHA_NACIMIENTO="1990-4-3"),
    _record(FECHA_NACIMIENTO="1900-01-01"),
    _record(RUN_CLIENTE="98765433"),
    _record(SKU="17.5"),
    _record(PORCENTAJE_DESCUENTO="0,05"),
    _record(MONTO_APLICADO="1e3"),
    _record(RUN_CLIENTE="ABC-1"),
    _record(NOMBRES="ÓSCAR", APELLIDOS="NIÑO DE PRUEBA"),
    _record(CODIGO_CLIENTE="{}"),
]
FIXTURE = "\n".join([HEADER, *RECORDS])


def _checked(spark, text=FIXTURE):
    d = tempfile.mkdtemp(prefix="salescope-test-")
    with open(f"{d}/in.csv", "w", encoding="utf-8") as f:
        f.write("﻿" + text)
    header, records = read_delimited(spark, f"{d}/in.csv")
    return header, V.first_failure(records, header)


def test_fixture_counts(spark):
    header, checked = _checked(spark)
    assert header[0] == "FECHA" and len(header) == 15
    tot = V.validation_totals(checked).first()
    assert (tot["read"], tot["valid"], tot["discarded"]) == (28, 12, 16)
    valid = sorted(r[0] for r in V.valid_rows(checked).select("record_no").collect())
    assert valid == [1, 3, 5, 8, 11, 13, 16, 18, 20, 22, 25, 27]


def test_fixture_reasons(spark):
    _, checked = _checked(spark)
    by = {r["field"]: r["n"] for r in V.discard_reasons(checked).collect()}
    assert by == {"RUN CLIENTE": 2, "CODIGO CLIENTE": 2, "columna": 2, "BOLETA": 1, "FECHA": 1, "GENERO": 1,
                  "FECHA NACIMIENTO": 1, "EDAD": 1, "PORCENTAJE DESCUENTO o MONTO APLICADO": 3,
                  "UNIDADES o BOLETA o LOCAL": 1, "SKU o UNIDADES o BOLETA o LOCAL": 1}
    lines = {r["record_no"]: r["line"] for r in V.quarantine_lines(checked).collect()}
    assert lines[4] == "4:BOLETA:campo_vacio:"
    assert lines[7] == "7:UNIDADES o BOLETA o LOCAL:valor_numerico_no_positivo:0/900001/12"
    assert lines[9] == "9:PORCENTAJE DESCUENTO o MONTO APLICADO:descuento_o_monto_invalido:1.2500/4200"
    assert lines[12] == "12:columna:cantidad_de_columnas_incorrecta:sin_valor"
    assert lines[15] == "15:FECHA:formato_fecha_invalido:2024-x5-02T09:00:00"
    s = {r["reason"]: r["n"] for r in V.discard_summary(V.quarantine_lines(checked)).collect()}
    assert s["total"] == 16 and s["RUN CLIENTE"] == 2


def test_quotes_as_a_csv_reader_takes_them(spark):
    """A quote opens a field only at its start; elsewhere it is a character like any other."""
    lines = [_record(PRODUCTO='TUBO 5" X 10'), _record(PRODUCTO='"CAJA; GRANDE"'), _record(PRODUCTO='"DICE ""SI"""'),
             _record(PRODUCTO='A"B"C'), _record(PRODUCTO='""'), _record(PRODUCTO='"SIN CIERRE')]
    _, checked = _checked(spark, "\n".join([HEADER, *lines]))
    rows = {r["record_no"]: (r["product"], r["fail_field"]) for r in checked.collect()}
    assert rows[1] == ('TUBO 5" X 10', None) and rows[2] == ("CAJA; GRANDE", None)
    assert rows[3] == ('DICE "SI"', None) and rows[4] == ('A"B"C', None)
    assert rows[5] == ("", "PRODUCTO") and rows[6][1] == "columna"


def test_header_of_another_length(spark):
    header = HEADER + ";EXTRA"
    _, checked = _checked(spark, "\n".join([header, _record() + ";x", _record()]))
    rows = {r["record_no"]: r["fail_field"] for r in checked.collect()}
    assert rows == {1: None, 2: "columna"} and "EXTRA" in checked.columns


def test_blank_line_is_a_record(spark):
    _, checked = _checked(spark, HEADER + "\n\n" + FIXTURE.split("\n")[1])
    rows = {r["record_no"]: r["fail_field"] for r in checked.collect()}
    assert rows == {1: "columna", 2: None}


def test_volume_profile(spark):
    _, checked = _checked(spark)
    prof = {r["chunk_index"]: r["rows"] for r in volume_profile(checked, 10).collect()}
    assert prof == {0: 10, 1: 10, 2: 8}


def _eval(spark, col, values, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"x {dtype}")
    return [r[0] for r in df.select(col(F.col("x"))).collect()]


def test_check_digit_edges(spark):
    vals = ["11.111.111-1", "12.345.678-5", "12345678-5", "123456785", "20.000.000-4", "1-9", "5",
            "12.345.678-0", "ab.345.678-5", "6-K", "6-k", "11-0"]
    got = _eval(spark, P.national_id_ok, vals)
    # 6 → weights 2 → 12 → 11-1 = 10 → K ; 11 → 1·2+1·3 = 5 → 6 (so 11-0 fails)
    assert got == [True, True, True, True, False, True, False, False, False, True, True, False]


def test_uuid_edges(spark):
    vals = ["0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f50", "0d9f6a5241c74e0b9a3e5b1c2d3e4f50",
            "{0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f50}", "urn:uuid:0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f50",
            "0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f5", "bad-uuid"]
    assert _eval(spark, P.uuid_ok, vals) == [True, True, True, True, False, False]


def test_number_edges(spark):
    ints = _eval(spark, lambda c: P.parse_int(c).cast("bigint"), [" 5 ", "+5", "5.0", "1_000", "1e3", "-0", "_1"])
    assert ints == [5, 5, None, 1000, None, 0, None]
    fl = _eval(spark, P.parse_float, ["5.0", "1e3", "1_000.5", ".5", "5.", "inf", "-inf", "1.5d", "0x10", "12,5"])
    assert fl == [5.0, 1000.0, 1000.5, 0.5, 5.0, float("inf"), float("-inf"), None, None, None]
    nan = _eval(spark, P.parse_float, ["nan"])[0]
    assert nan != nan


def test_date_edges(spark):
    ts = _eval(spark, lambda c: P.parse_iso_timestamp(c).cast("string"),
               ["2023", "20231109", "2023-1-9", "2023-02-30", "2023-11-09T13:16:36Z", "2023-11-09",
                "2023-11-09T13:16", "20231109T131636", "2023-11-09 13:16:36.1234567"])
    assert ts == [None, "2023-11-09 00:00:00", None, None, None, "2023-11-09 00:00:00",
                  "2023-11-09 13:16:00", "2023-11-09 13:16:36", "2023-11-09 13:16:36.123456"]
    ds = _eval(spark, lambda c: P.parse_ymd_date(c).cast("string"), ["2023-1-9", "2023-02-30", "2023", "1971-03-08"])
    assert ds == ["2023-01-09", None, None, "1971-03-08"]


def test_age_rule(spark):
    rows = [("2023-11-09T10:00:00", "2023-11-09", False), ("2023-11-09T10:00:00", "2023-11-10", True),
            ("2023-11-09T00:00:00", "1913-11-07", True), ("2023-11-09T00:00:00", "1913-11-09", False)]
    line = lambda ts, b: (f"{ts};POS;1;P;1;0.1;10;1;1;0d9f6a52-41c7-4e0b-9a3e-5b1c2d3e4f50;"  # noqa: E731
                          f"11.111.111-1;A;B;{b};1")
    df = spark.createDataFrame([(i, line(t, b)) for i, (t, b, _) in enumerate(rows)], "record_no long, line string")
    got = {r["record_no"]: r["fail_field"] == "EDAD" for r in V.first_failure(df).collect()}
    assert got == {i: exp for i, (_, _, exp) in enumerate(rows)}


def _check_digit_brute(body: str) -> str:
    total, weight = 0, 2
    for ch in reversed(body):
        total += int(ch) * weight
        weight = 2 if weight == 7 else weight + 1
    r = 11 - total % 11
    return "0" if r == 11 else "K" if r == 10 else str(r)


def test_check_digit_any_length(spark):
    import random
    rnd = random.Random(7)
    bodies = ["1", "6", "11", "9" * 59, "9" * 60, "9" * 61, "7" * 120] + [
        "".join(rnd.choice("0123456789") for _ in range(rnd.randint(1, 90))) for _ in range(500)]
    got = _eval(spark, P.check_digit, bodies)
    assert got == [_check_digit_brute(b) for b in bodies]


def test_rule_filters_split_a_line_once(spark):
    """The filter on a rule holds no copy of the split for each field it looks at."""
    lines = spark.createDataFrame([(1, FIXTURE.strip("\n").split("\n")[1])], "record_no long, line string")
    rules = V.rule_columns(V.split_fields(lines))
    found = rules.filter(~F.col("fails_arity") & F.col("empty_field").isNotNull()).select("record_no", "empty_field")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(") <= 1 and found.collect() == []


def test_long_ids_and_other_text_have_the_digit_of_the_rule(spark):
    bodies = ["", "7", "123456789012", "1234567890123", "9" * 30]
    assert _eval(spark, P.check_digit, [*bodies, "12a", "12\n"]) == [*map(_check_digit_brute, bodies), None, None]


def test_ordered_lines_are_rendered_behind_the_exchange(spark, tmp_path):
    from salescope.sources.sinks import write_ordered_lines
    rows = spark.createDataFrame([(k, k % 3) for k in range(50, 0, -1)], "at long, x long")
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def text(x):
        made.add(1)
        return f"line {x}"

    write_ordered_lines(rows, f"{tmp_path}/t", "at", ["head"], compression="gzip",
                        render=lambda df, keep: df.select(*keep, text("at").alias("line")))
    got = [r.value for r in spark.read.text(f"{tmp_path}/t").select("value", "_metadata.file_name").orderBy("file_name").collect()]
    assert sorted(got) == sorted(["head", *(f"line {k}" for k in range(1, 51))]) and got[0] == "head"
    assert made.value <= 51  # the exchange's sample and its rows do not make the text


def test_failing_rows_make_only_the_fields_in_question(spark):
    lines = [line for line in FIXTURE.strip("\n").split("\n")[1:]]
    df = spark.createDataFrame([*enumerate(lines, 1)], "record_no long, line string")
    for flag in ("fails_age",):
        bad = ~F.col("fails_arity") & F.col(flag)
        got = V.failing(V.split_fields(df), bad, ["record_no", "gender"])
        assert sorted(got.collect()) == sorted(V.rule_columns(V.split_fields(df)).filter(bad).select("record_no", "gender").collect())
    plan = V.failing(V.split_fields(df), ~F.col("fails_arity") & F.col("fails_gender"), ["record_no"])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("split(") == 1 and text.count("trim(") == 1  # the gender's


def test_text_of_amounts_is_that_of_format_string(spark):
    import random
    from salescope.sources.sales import _fixed_point
    rnd = random.Random(3)
    odd = [0.0, -0.0, None, float("nan"), float("inf"), -1.005, 1.005, 2.675, 0.00005, 0.99995, 1e12, 9.99999999999e11, 1e15, 5e-324]
    df = spark.createDataFrame([(x,) for x in odd + [rnd.random() * 10 ** rnd.randint(-6, 11) for _ in range(3000)]]
                               + [(k / 1000,) for k in range(3000)], "x double")
    for places in (2, 4):
        rows = df.select("x", _fixed_point("x", places).alias("a"), F.format_string(f"%.{places}f", "x").alias("b")).collect()
        assert [r for r in rows if r["a"] != r["b"]] == []


def test_check_digit_of_integers(spark):
    numbers = [0, 7, 1000000, 1014999, 999999999999, 10 ** 12, 10 ** 17 + 3, -5, None, *range(1000100, 1000300)]
    df = spark.createDataFrame([(n,) for n in numbers], "n long")
    got = [r[0] for r in df.select(P.check_digit_of_int(F.col("n"))).collect()]
    assert got == [None if n is None or n < 0 else _check_digit_brute(str(n)) for n in numbers]


def test_shuffles_begin_with_partitions_by_input_size(spark):
    from salescope.session import SHUFFLE_BYTES, shuffle_by_size
    name = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    shuffle_by_size(spark, 100 * SHUFFLE_BYTES + 1)
    assert spark.conf.get(name) == "101"
    shuffle_by_size(spark, 0)
    assert spark.conf.get(name, None) is None


def test_discarded_lines_are_those_of_the_first_failure(spark):
    """Only the rows that fail are given, with the rules run once."""
    lines = FIXTURE.strip("\n").split("\n")[1:]
    records = spark.createDataFrame(list(enumerate(lines, 1)), "record_no long, line string")
    want = V.first_failure(records).where("fail_field IS NOT NULL").select("record_no", "fail_field", "fail_rule", "fail_value")
    got = V.discarded(records)
    assert got.columns == want.columns and sorted(got.collect()) == sorted(want.collect()) and got.count() == 16
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" not in plan and plan.count("edad_fuera_de_rango") == 1
