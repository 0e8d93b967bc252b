"""Sales views over the driver tables.

``sales_view``  typed sales rows: ``lineitem ⋈ orders`` (one row per line item).
``raw_lines``   the same rows rendered as ``;``-separated text, with a known
                share of rows broken on purpose (one break per rule), so the
                validation job has real work at every scale.

Customer attributes (id text, national id, birth date, gender) are derived from
``o_custkey``; under the foreign key it equals ``c_custkey``, so the join to
``customer`` would add a shuffle without changing a row.

Record numbers: ``record_no = l_orderkey * 8 + l_linenumber`` (line numbers are
1..7).  It is deterministic in any engine and needs no global ordering.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salescope.functions.parse import check_digit_of_int
from salescope.schema import RAW_FIELDS
from salescope.sources.tables import table

# Rates at which synthetic gaps are made, by key residue.
DISCOUNT_GAP = (61, 7)    # pmod(record_no, 61) = 7  → discount missing
BIRTH_GAP = (37, 5)       # pmod(o_custkey, 37) = 5  → birth date missing
BREAK_MOD = 101           # raw_lines: pmod(record_no, 101) selects the break

_LINE_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
              "l_extendedprice", "l_discount", "l_shipdate"]


def sales_rows(spark: SparkSession, data_dir: str) -> DataFrame:
    """``lineitem ⋈ orders`` with the record number, as read: what ``sales_view`` and the text lines are made from."""
    li = table(spark, data_dir, "lineitem", _LINE_COLS)
    o = table(spark, data_dir, "orders", ["o_orderkey", "o_custkey", "o_orderpriority"])
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    k = F.col("l_orderkey") * 8 + F.col("l_linenumber")
    return j.select(k.alias("record_no"), "l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                    "l_discount", "l_shipdate", "o_custkey", "o_orderpriority")


def sales_view(spark: SparkSession, data_dir: str) -> DataFrame:
    return sales_of(sales_rows(spark, data_dir))


def sales_of(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The sales view of ``sales_rows``; columns named in ``keep`` go along."""
    k = F.col("record_no")
    cust = F.col("o_custkey")
    body = F.lit(1000000) + cust
    birth = F.date_add(F.lit("1940-01-01").cast("date"), (cust * 7919 % 20000).cast("int"))
    return rows.select(
        *keep,
        k,
        F.col("l_shipdate").alias("ts"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_partkey").alias("sku"),
        F.concat(F.lit("PRODUCTO "), F.col("l_partkey").cast("string")).alias("product"),
        F.col("l_quantity").cast("bigint").alias("units"),
        F.when(F.pmod(k, F.lit(DISCOUNT_GAP[0])) != DISCOUNT_GAP[1], F.col("l_discount")).alias("discount"),
        F.col("l_extendedprice").alias("amount"),
        F.col("l_orderkey").alias("receipt"),
        F.col("l_suppkey").alias("store"),
        F.lower(F.lpad(F.hex(cust), 32, "0")).alias("customer_id"),
        F.concat(body.cast("string"), F.lit("-"), check_digit_of_int(body)).alias("national_id"),
        F.concat(F.lit("NOMBRE "), (cust % 97).cast("string")).alias("first_names"),
        F.concat(F.lit("APELLIDO "), (cust % 89).cast("string")).alias("last_names"),
        F.when(F.pmod(cust, F.lit(BIRTH_GAP[0])) != BIRTH_GAP[1], birth).alias("birth_date"),
        (cust % 2 + 1).cast("int").alias("gender"),
    )


def _fixed_point(c: str, places: int) -> Column:
    """``%.<places>f``; common values by a decimal, which takes a fraction of the time and rounds alike."""
    x = F.col(c)
    return (F.when((x > 0) & (x < 1e12), x.cast(f"decimal(20,{places})").cast("string"))
            .otherwise(F.format_string(f"%.{places}f", c)))


def _text_fields(s: DataFrame) -> dict[str, Column]:
    """Clean text rendering of each raw field."""
    return {
        "FECHA": F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        "CANAL": F.col("channel"),
        "SKU": F.col("sku").cast("string"),
        "PRODUCTO": F.col("product"),
        "UNIDADES": F.col("units").cast("string"),
        "PORCENTAJE DESCUENTO": F.when(F.col("discount").isNotNull(), _fixed_point("discount", 4))
                                .otherwise(F.lit("")),
        "MONTO APLICADO": _fixed_point("amount", 2),
        "BOLETA": F.col("receipt").cast("string"),
        "LOCAL": F.col("store").cast("string"),
        "CODIGO CLIENTE": F.col("customer_id"),
        "RUN CLIENTE": F.col("national_id"),
        "NOMBRES": F.col("first_names"),
        "APELLIDOS": F.col("last_names"),
        "FECHA NACIMIENTO": F.coalesce(F.date_format("birth_date", "yyyy-MM-dd"), F.lit("")),
        "GENERO": F.col("gender").cast("string"),
    }


def _breaks(f: dict[str, Column]) -> dict[int, tuple[str, Column]]:
    """Residue of pmod(record_no, 101) → (field, replacement text).

    Residues 1 and 2 change the field count (handled in ``raw_lines``).
    Residues 17-25 are unusual but valid spellings; 21 (``nan``) passes
    validation and is dropped later by the cleaning stage.
    """
    nid = f["RUN CLIENTE"]
    fecha = f["FECHA"]
    return {
        3: ("BOLETA", F.lit("")),
        4: ("SKU", F.lit("12a")),
        5: ("UNIDADES", F.lit("0")),
        6: ("LOCAL", F.lit("-3")),
        7: ("MONTO APLICADO", F.lit("12,50")),
        8: ("PORCENTAJE DESCUENTO", F.lit("1.5000")),
        9: ("MONTO APLICADO", F.lit("0")),
        10: ("RUN CLIENTE", F.concat(nid.substr(F.lit(1), F.length(nid) - 1), F.lit("X"))),
        11: ("CODIGO CLIENTE", F.lit("bad-uuid")),
        12: ("FECHA", F.concat(fecha.substr(1, 5), F.lit("l"), fecha.substr(F.lit(6), F.lit(100)))),
        13: ("FECHA NACIMIENTO", F.lit("1970-02-30")),
        14: ("FECHA NACIMIENTO", F.lit("1850-06-15")),
        15: ("GENERO", F.lit("3")),
        16: ("FECHA NACIMIENTO", F.lit("2005-01-01")),
        17: ("UNIDADES", F.concat(F.lit(" "), f["UNIDADES"], F.lit(" "))),
        18: ("RUN CLIENTE", F.lower(nid)),
        19: ("FECHA", F.date_format("ts", "yyyyMMdd'T'HHmmss")),
        20: ("UNIDADES", F.concat(F.lit("+"), f["UNIDADES"])),
        21: ("MONTO APLICADO", F.lit("nan")),
        22: ("SKU", F.concat(F.lit("1_"), f["SKU"])),
        23: ("PORCENTAJE DESCUENTO", F.lit("1e-1")),
        24: ("FECHA", F.date_format("ts", "yyyy-MM-dd HH:mm")),
        25: ("FECHA NACIMIENTO", F.coalesce(F.date_format("birth_date", "yyyy-M-d"), F.lit(""))),
        26: ("PORCENTAJE DESCUENTO", F.lit("inf")),
    }


def raw_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """``(record_no long, line string)``: the sales view as raw delimited text."""
    return raw_text_of(sales_rows(spark, data_dir))


def raw_text_of(rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The same from ``sales_rows``; columns named in ``keep`` go along."""
    s = sales_of(rows, keep)
    f = _text_fields(s)
    r = F.pmod(F.col("record_no"), F.lit(BREAK_MOD))
    fields = dict(f)
    for res, (name, repl) in _breaks(f).items():
        fields[name] = F.when(r == res, repl).otherwise(fields[name])
    # concat_ws leaves NULL out: residue 1 loses the last field, residue 2 has one more.
    *ordered, last = [fields[n] for n in RAW_FIELDS]
    line = F.concat_ws(";", *ordered, F.when(r == 1, F.lit(None)).otherwise(last), F.when(r == 2, F.lit("EXTRA")))
    return s.select(*keep, "record_no", line.alias("line"))


def quoted_lines(spark: SparkSession, data_dir: str) -> DataFrame:
    """``(record_no long, line string)``: key, channel, product and units, the product's text with separators,
    quotes and line ends inside for two records in seven."""
    s = sales_view(spark, data_dir).select("record_no", "channel", "product", "units")
    r = F.pmod(F.col("record_no"), F.lit(7))
    product = (F.when(r == 3, F.concat(F.lit('"CAJA ""A""; '), "product", F.lit('\n;fin"')))
               .when(r == 5, F.concat(F.lit('"'), "product", F.lit('\n\n"" otra linea"')))
               .otherwise(F.concat("product", F.lit(' 5"'))))
    return s.select("record_no", F.concat_ws(";", F.col("record_no").cast("string"), "channel", product,
                                             F.col("units").cast("string")).alias("line"))
