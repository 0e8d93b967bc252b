"""Row validation: ordered rules, first failure wins, valid rows vs quarantine.

All rules are Column expressions evaluated in one projection; the first
failing rule is chosen by a single ``CASE WHEN`` chain, so every row is read
once and no Python runs per row.  Casts in later branches are ``try_*``
because Spark may evaluate shared subexpressions before the branch is taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salescope.functions import parse as P
from salescope.schema import MAX_VALID_AGE, RAW_FIELDS, SNAKE

# Reason texts of the quarantine file, as the original writes them.
R_ARITY = ("columna", "cantidad_de_columnas_incorrecta", "sin_valor")
R_EMPTY = "campo_vacio"
R_INT = ("SKU o UNIDADES o BOLETA o LOCAL", "entero_invalido", "valor_no_entero")
R_POS = ("UNIDADES o BOLETA o LOCAL", "valor_numerico_no_positivo")
R_DEC = ("PORCENTAJE DESCUENTO o MONTO APLICADO", "decimal_invalido")
R_RANGE = ("PORCENTAJE DESCUENTO o MONTO APLICADO", "descuento_o_monto_invalido")
R_RUT = ("RUN CLIENTE", "rut_invalido")
R_UUID = ("CODIGO CLIENTE", "uuid_invalido")
R_TS = ("FECHA", "formato_fecha_invalido")
R_BIRTH = ("FECHA NACIMIENTO", "formato_fecha_invalido")
R_AGE = ("EDAD", "edad_fuera_de_rango")
R_GENDER = ("GENERO", "valor_invalido")

def _unquote(c: Column) -> Column:
    """The value of a quoted field; others are literal."""
    inner = F.regexp_extract(c, '^"([^"]*+(?:""[^"]*+)*+)', 1)
    after = F.regexp_extract(c, r'(?s)^"[^"]*+(?:""[^"]*+)*+"(.+)\z', 1)
    return F.when(F.startswith(c, F.lit('"')), F.concat(F.replace(inner, F.lit('""'), F.lit('"')), after)).otherwise(c)


def split_fields(records: DataFrame, header: list[str] | None = None, line_col: str = "line",
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """``(record_no, line)`` → ``record_no, n_fields`` + one raw string column per field (snake_case).

    Columns named in ``keep`` go along.

    Lines in which no field starts with a quote use a plain split, as a quote
    inside a field is a character like any other.  The others are cut field by
    field from left to right, in linear time.  A quoted field does not go on in
    the next line.
    """
    header = header or RAW_FIELDS
    line = F.col(line_col)
    quoted = line.contains('"') & line.rlike('(^|;)"')
    # Every match ends with its separator; one more is added, so the last field has one as well.
    fields = F.regexp_extract_all(F.concat(line, F.lit(";")), F.lit(
        r'("[^"]*+(?:""[^"]*+)*+"(?:[^;"][^;]*+)?+;|"[^"]*+(?:""[^"]*+)*+\z|[^;]*+;)'), F.lit(1))
    parts = F.when(quoted, fields).otherwise(F.split(line, ";", -1))
    df = records.select("record_no", *keep, parts.alias("_parts"), quoted.alias("_quoted"))
    n = F.size("_parts")
    ok = n == len(header)

    def field(i: int) -> Column:
        v = F.element_at("_parts", i + 1)
        return F.when(ok, F.when(F.col("_quoted"), _unquote(F.left(v, F.char_length(v) - 1))).otherwise(v))

    cols = [field(i).alias(SNAKE.get(h, h)) for i, h in enumerate(header)]
    return df.select("record_no", *keep, n.alias("n_fields"), *cols)


def _stripped(fields: DataFrame, filtered: bool) -> DataFrame:
    """Adds ``_<field>``, every field without blanks around it.

    Split and strip are done once a row.  Where rows are to be ``filtered`` by rules,
    ``inline`` of one struct keeps the filters above them: a filter pushed further down
    would hold a copy of both for every field it looks at.
    """
    own = ["n_fields", *SNAKE.values()]
    rest = [c for c in fields.columns if c not in own]
    df = fields.select(*rest, *own, *[P.py_strip(c).alias(f"_{c}") for c in SNAKE.values()])
    if filtered:
        df = df.select(*rest, F.inline(F.array(F.struct(*own, *[f"_{c}" for c in SNAKE.values()]))))
    return df.select(*fields.columns, *[f"_{c}" for c in SNAKE.values()])


def rule_columns(fields: DataFrame, n_expected: int = len(RAW_FIELDS), keep_stripped: bool = False,
                 filtered: bool | None = None) -> DataFrame:
    """Adds one boolean ``fails_<rule>`` per rule, each evaluated on its own; with ``keep_stripped`` also the stripped fields.

    Without ``filtered`` the fields that nobody asks for are not made, see ``failing``.
    """
    df = _stripped(fields, filtered=not keep_stripped if filtered is None else filtered)
    s = {c: F.col(f"_{c}") for c in SNAKE.values()}
    arity = F.col("n_fields") != n_expected
    empty = [(f, (s[SNAKE[f]] == "")) for f in RAW_FIELDS]
    ints = [P.is_int(s[c], True) for c in ("sku", "units", "receipt", "store")]
    u, b, l_ = (P.parse_int(s[c], True) for c in ("units", "receipt", "store"))
    d, m = P.parse_float(s["discount"], True), P.parse_float(s["amount"], True)
    ts, birth = P.parse_iso_timestamp(s["ts"], True), P.parse_ymd_date(s["birth_date"], True)
    age = F.datediff(F.to_date(ts), birth) / 365.25
    return df.select(
        *(df.columns if keep_stripped else fields.columns),
        arity.alias("fails_arity"),
        F.coalesce(*[F.when(e, F.lit(f)) for f, e in empty]).alias("empty_field"),
        (~(ints[0] & ints[1] & ints[2] & ints[3])).alias("fails_integer"),
        ((u <= 0) | (b <= 0) | (l_ <= 0)).alias("fails_positive"),
        (d.isNull() | m.isNull()).alias("fails_decimal"),
        (~((d >= 0) & (d <= 1)) | (m <= 0)).alias("fails_range"),
        (~P.national_id_ok(s["national_id"], True)).alias("fails_check_digit"),
        (~P.uuid_ok(s["customer_id"], True)).alias("fails_uuid"),
        ts.isNull().alias("fails_timestamp"),
        birth.isNull().alias("fails_birth_date"),
        ((age < 0) | (age > MAX_VALID_AGE)).alias("fails_age"),
        age.alias("age_at_sale"),
        (~s["gender"].isin("1", "2")).alias("fails_gender"),
    )


def failing(fields: DataFrame, fails: Column, columns: list, n_expected: int = len(RAW_FIELDS)) -> DataFrame:
    """``columns`` of the rows of ``rule_columns`` where ``fails`` holds.

    The rows come out of ``inline`` of no or one struct: nothing is pushed below the rules
    as a filter would be (with a copy of them), and only the fields in question are made.
    """
    rules = rule_columns(fields, n_expected, filtered=False)
    return rules.select(F.inline(F.when(fails, F.array(F.struct(*columns)))))


def _reasons(records: DataFrame, header: list[str], keep: tuple[str, ...] = ()) -> DataFrame:
    """``record_no, <keep>, <raw fields>, _reason``: the first rule that a row fails (NULL = valid)."""
    r = rule_columns(split_fields(records, header, keep=keep), len(header), keep_stripped=True)
    s = {c: F.col(f"_{c}") for c in SNAKE.values()}

    def reason(field, rule, value) -> Column:
        return F.struct(F.lit(field).alias("field"), F.lit(rule).alias("rule"),
                        (value if isinstance(value, Column) else F.lit(value)).alias("value"))

    slash = lambda *cs: F.concat_ws("/", *cs)
    chain = (
        F.when(F.col("fails_arity"), reason(*R_ARITY))
        .when(F.col("empty_field").isNotNull(),
              F.struct(F.col("empty_field").alias("field"), F.lit(R_EMPTY).alias("rule"),
                       F.lit("").alias("value")))
        .when(F.col("fails_integer"), reason(*R_INT))
        .when(F.col("fails_positive"), reason(*R_POS, slash(s["units"], s["receipt"], s["store"])))
        .when(F.col("fails_decimal"), reason(*R_DEC, slash(s["discount"], s["amount"])))
        .when(F.col("fails_range"), reason(*R_RANGE, slash(s["discount"], s["amount"])))
        .when(F.col("fails_check_digit"), reason(*R_RUT, s["national_id"]))
        .when(F.col("fails_uuid"), reason(*R_UUID, s["customer_id"]))
        .when(F.col("fails_timestamp"), reason(*R_TS, s["ts"]))
        .when(F.col("fails_birth_date"), reason(*R_BIRTH, s["birth_date"]))
        .when(F.col("fails_age"), reason(*R_AGE, F.format_string("%.2f", F.col("age_at_sale"))))
        .when(F.col("fails_gender"), reason(*R_GENDER, s["gender"]))
    )
    return r.select("record_no", *keep, *(SNAKE.get(h, h) for h in header), chain.alias("_reason"))


def _fail_columns() -> list[Column]:
    return [F.col(f"_reason.{part}").alias(f"fail_{part}") for part in ("field", "rule", "value")]


def first_failure(records: DataFrame, header: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``record_no, <keep>, <raw fields>, fail_field, fail_rule, fail_value`` (NULL reason = valid)."""
    header = header or RAW_FIELDS
    rows = _reasons(records, header, keep)
    return rows.select(*(c for c in rows.columns if c != "_reason"), *_fail_columns())


def discarded(records: DataFrame, header: list[str] | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """``record_no, <keep>, fail_field, fail_rule, fail_value`` of the rows of ``first_failure`` that fail.

    As in ``failing``, ``inline`` of no or one struct stands for a filter, which would run the rules twice.
    """
    rows = _reasons(records, header or RAW_FIELDS, keep)
    return rows.select(F.inline(F.when(F.col("_reason").isNotNull(), F.array(F.struct("record_no", *keep, *_fail_columns())))))


def valid_rows(checked: DataFrame) -> DataFrame:
    """Rows that passed every rule, all columns still text (unchanged)."""
    return checked.filter(F.col("fail_field").isNull()).drop("fail_field", "fail_rule", "fail_value")


def quarantine(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """``record_no, field, rule, value`` for discarded rows."""
    return checked.filter(F.col("fail_field").isNotNull()).select(
        "record_no", *keep, F.col("fail_field").alias("field"), F.col("fail_rule").alias("rule"),
        F.col("fail_value").alias("value"))


def quarantine_lines(checked: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Text lines ``<record>:<field>:<rule>:<value>`` of the quarantine file."""
    q = quarantine(checked, keep)
    return q.select("record_no", *keep, F.concat_ws(":", F.col("record_no").cast("string"), "field", "rule",
                                             "value").alias("line"))


def validation_totals(checked: DataFrame) -> DataFrame:
    """One row: read, valid, discarded, discarded by age."""
    bad = F.col("fail_field").isNotNull()
    return checked.agg(F.count(F.lit(1)).alias("read"),
                       F.count_if(~bad).alias("valid"),
                       F.count_if(bad).alias("discarded"),
                       F.count_if(F.col("fail_field") == "EDAD").alias("discarded_age"))


def chunk_totals(checked: DataFrame, chunk_size: int = 100_000) -> DataFrame:
    """The same totals per chunk of ``chunk_size`` consecutive record numbers."""
    bad = F.col("fail_field").isNotNull()
    chunk = F.floor((F.col("record_no") - 1) / F.lit(chunk_size)).cast("bigint")
    return checked.groupBy(chunk.alias("chunk_index")).agg(
        F.count(F.lit(1)).alias("read"), F.count_if(~bad).alias("valid"),
        F.count_if(bad).alias("discarded"),
        F.count_if(F.col("fail_field") == "EDAD").alias("discarded_age"))


def discard_reasons(checked: DataFrame) -> DataFrame:
    """Discards per leading field of the reason."""
    return (checked.filter(F.col("fail_field").isNotNull())
            .groupBy(F.col("fail_field").alias("field")).agg(F.count(F.lit(1)).alias("n")))


def discard_summary(lines: DataFrame, line_col: str = "line") -> DataFrame:
    """From stored quarantine lines: count per reason field plus a ``total`` row.

    Heading lines (``=`` rules, the title, lines without ``:``) are skipped.
    """
    line = F.col(line_col)
    keep = line.contains(":") & ~line.startswith("=") & ~line.startswith("REGISTRO")
    reason = F.coalesce(F.element_at(F.split(F.trim(line), ":"), 2), F.lit("SIN_MOTIVO"))
    return (lines.filter(keep).select(reason.alias("reason"))
            .rollup("reason").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("reason", F.lit("total")).alias("reason"), "n"))
