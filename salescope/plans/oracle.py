"""DuckDB SQL used as the correctness oracle of the registered queries.

The SQL is written independently from the Spark code (different engine,
different function set) over the same tables.  Shared building blocks are CTE
strings: the sales view, the cleaning stage and the raw-line view.
"""

from __future__ import annotations

from salescope.sources.sales import BIRTH_GAP, BREAK_MOD, DISCOUNT_GAP


def sig(expr: str, digits: int = 11) -> str:
    """Round to ``digits`` significant digits (same arithmetic as ``functions.numeric.sig``)."""
    e = f"CAST(({expr}) AS DOUBLE)"
    scale = f"({digits - 1} - floor(log10(abs({e}))))"
    return (f"(CASE WHEN {e} IS NULL OR isnan({e}) OR {e} = 0 OR isinf({e}) THEN {e} "
            f"ELSE round({e} * pow(10.0, {scale})) / pow(10.0, {scale}) END)")


def pmod(a: str, m: int) -> str:
    return f"((({a}) % {m} + {m}) % {m})"


def _check_digit_num(body: str, ndigits: int = 14) -> str:
    terms = " + ".join(f"((({body}) // {10 ** i}) % 10) * {2 + i % 6}" for i in range(ndigits))
    r = f"(11 - ({terms}) % 11)"
    return f"(CASE {r} WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST({r} AS VARCHAR) END)"


_K = "(l_orderkey * 8 + l_linenumber)"

SALES = f"""sv AS (
  SELECT {_K} AS record_no,
         l_shipdate AS ts,
         o_orderpriority AS channel,
         l_partkey AS sku,
         'PRODUCTO ' || CAST(l_partkey AS VARCHAR) AS product,
         CAST(l_quantity AS BIGINT) AS units,
         CASE WHEN {pmod(_K, DISCOUNT_GAP[0])} <> {DISCOUNT_GAP[1]} THEN l_discount END AS discount,
         l_extendedprice AS amount,
         l_orderkey AS receipt,
         l_suppkey AS store,
         lower(lpad(hex(o_custkey), 32, '0')) AS customer_id,
         CAST(1000000 + o_custkey AS VARCHAR) || '-' || {_check_digit_num('1000000 + o_custkey')} AS national_id,
         'NOMBRE ' || CAST(o_custkey % 97 AS VARCHAR) AS first_names,
         'APELLIDO ' || CAST(o_custkey % 89 AS VARCHAR) AS last_names,
         CASE WHEN {pmod('o_custkey', BIRTH_GAP[0])} <> {BIRTH_GAP[1]}
              THEN DATE '1940-01-01' + CAST((o_custkey * 7919) % 20000 AS INTEGER) END AS birth_date,
         CAST(o_custkey % 2 + 1 AS INTEGER) AS gender
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

CLEAN = SALES + """,
c0 AS (SELECT * FROM sv WHERE ts IS NOT NULL AND channel IS NOT NULL AND units IS NOT NULL
       AND amount IS NOT NULL AND store IS NOT NULL AND customer_id IS NOT NULL AND national_id IS NOT NULL),
cmed AS (SELECT quantile_cont(discount, 0.5) AS m FROM c0),
c1 AS (SELECT c0.* REPLACE (coalesce(discount, cmed.m) AS discount,
                            coalesce(birth_date, DATE '2000-01-01') AS birth_date),
              amount / nullif(units, 0) AS amount_per_unit,
              greatest(datediff('day', coalesce(birth_date, DATE '2000-01-01'), CAST(ts AS DATE)) / 365.25, 0.0) AS age
       FROM c0, cmed),
c2 AS (SELECT * FROM c1 WHERE age <= 110),
cpf AS (SELECT customer_id, count(*) AS purchase_frequency FROM c2 GROUP BY customer_id),
c3 AS (SELECT c2.*, cpf.purchase_frequency FROM c2 JOIN cpf USING (customer_id)),
cq AS (SELECT quantile_cont(amount, 0.25) AS qa1, quantile_cont(amount, 0.75) AS qa3,
              quantile_cont(units, 0.25) AS qu1, quantile_cont(units, 0.75) AS qu3 FROM c3),
cl AS MATERIALIZED (SELECT c3.*,
         coalesce(CAST((amount < qa1 - 1.5 * (qa3 - qa1) OR amount > qa3 + 1.5 * (qa3 - qa1)) AS INTEGER), 0) AS outlier_amount,
         coalesce(CAST((units < qu1 - 1.5 * (qu3 - qu1) OR units > qu3 + 1.5 * (qu3 - qu1)) AS INTEGER), 0) AS outlier_units
       FROM c3, cq)"""


def _join(ctes: str, body: str) -> str:
    b = body.lstrip()
    if b[:4].upper() == "WITH":
        return f"WITH {ctes},\n{b[4:]}"
    return f"WITH {ctes}\n{body}"


def with_clean(body: str) -> str:
    return _join(CLEAN, body)


def with_sales(body: str) -> str:
    return _join(SALES, body)




# --------------------------------------------------------------------------- raw lines + validation

from salescope.schema import RAW_FIELDS as _RAW, SNAKE as _SNAKE  # noqa: E402

_WS = "(' ' || chr(9) || chr(10) || chr(13) || chr(11) || chr(12))"


def _strip(x: str) -> str:
    return f"trim({x}, {_WS})"


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_TEXT = {
    "FECHA": "strftime(ts, '%Y-%m-%dT%H:%M:%S')",
    "CANAL": "channel",
    "SKU": "CAST(sku AS VARCHAR)",
    "PRODUCTO": "product",
    "UNIDADES": "CAST(units AS VARCHAR)",
    "PORCENTAJE DESCUENTO": "coalesce(printf('%.4f', discount), '')",
    "MONTO APLICADO": "printf('%.2f', amount)",
    "BOLETA": "CAST(receipt AS VARCHAR)",
    "LOCAL": "CAST(store AS VARCHAR)",
    "CODIGO CLIENTE": "customer_id",
    "RUN CLIENTE": "national_id",
    "NOMBRES": "first_names",
    "APELLIDOS": "last_names",
    "FECHA NACIMIENTO": "coalesce(strftime(birth_date, '%Y-%m-%d'), '')",
    "GENERO": "CAST(gender AS VARCHAR)",
}


def _breaks() -> dict[int, tuple[str, str]]:
    t = _TEXT
    return {
        3: ("BOLETA", "''"), 4: ("SKU", "'12a'"), 5: ("UNIDADES", "'0'"), 6: ("LOCAL", "'-3'"),
        7: ("MONTO APLICADO", "'12,50'"), 8: ("PORCENTAJE DESCUENTO", "'1.5000'"), 9: ("MONTO APLICADO", "'0'"),
        10: ("RUN CLIENTE", "substr(national_id, 1, length(national_id) - 1) || 'X'"),
        11: ("CODIGO CLIENTE", "'bad-uuid'"),
        12: ("FECHA", f"substr({t['FECHA']}, 1, 5) || 'l' || substr({t['FECHA']}, 6)"),
        13: ("FECHA NACIMIENTO", "'1970-02-30'"), 14: ("FECHA NACIMIENTO", "'1850-06-15'"),
        15: ("GENERO", "'3'"), 16: ("FECHA NACIMIENTO", "'2005-01-01'"),
        17: ("UNIDADES", f"' ' || {t['UNIDADES']} || ' '"), 18: ("RUN CLIENTE", "lower(national_id)"),
        19: ("FECHA", "strftime(ts, '%Y%m%dT%H%M%S')"), 20: ("UNIDADES", f"'+' || {t['UNIDADES']}"),
        21: ("MONTO APLICADO", "'nan'"), 22: ("SKU", f"'1_' || {t['SKU']}"),
        23: ("PORCENTAJE DESCUENTO", "'1e-1'"), 24: ("FECHA", "strftime(ts, '%Y-%m-%d %H:%M')"),
        25: ("FECHA NACIMIENTO", "coalesce(strftime(birth_date, '%Y-%-m-%-d'), '')"),
        26: ("PORCENTAJE DESCUENTO", "'inf'"),
    }


def _raw_cte() -> str:
    r = pmod("record_no", BREAK_MOD)
    fields = {}
    for name in _RAW:
        cases = [(res, repl) for res, (fname, repl) in _breaks().items() if fname == name]
        if cases:
            whens = " ".join(f"WHEN {r} = {res} THEN {repl}" for res, repl in cases)
            fields[name] = f"(CASE {whens} ELSE {_TEXT[name]} END)"
        else:
            fields[name] = _TEXT[name]
    ordered = [fields[n] for n in _RAW]
    line = (f"CASE WHEN {r} = 1 THEN concat_ws(';', {', '.join(ordered[:-1])}) "
            f"WHEN {r} = 2 THEN concat_ws(';', {', '.join(ordered)}, 'EXTRA') "
            f"ELSE concat_ws(';', {', '.join(ordered)}) END")
    return (f"raw AS MATERIALIZED (SELECT row_number() OVER (ORDER BY record_no, line) AS record_no, line "
            f"FROM (SELECT record_no, {line} AS line FROM sv))")


# The patterns below are DuckDB's own (full matches in RE2 syntax), written from
# the rules and not shared with the Spark side.
_DIGITS = r"\d+(?:_\d+)*"
_INTEGER = rf"[+-]?{_DIGITS}"
_DECIMAL = rf"[+-]?(?:{_DIGITS}\.?|{_DIGITS}\.{_DIGITS}|\.{_DIGITS})(?:[Ee][+-]?{_DIGITS})?"


def _is_int(x):
    return f"regexp_full_match({x}, {_q(_INTEGER)})"


def _parse_int(x):
    return f"(CASE WHEN {_is_int(x)} THEN TRY_CAST(replace({x}, '_', '') AS DECIMAL(38,0)) END)"


def _parse_float(x):
    bare = f"ltrim(lower({x}), '+-')"
    one_sign = f"length({x}) - length({bare}) <= 1"
    return (f"(CASE WHEN {one_sign} AND {bare} = 'nan' THEN 'nan'::DOUBLE "
            f"WHEN {one_sign} AND {bare} IN ('inf', 'infinity') THEN "
            f"(CASE WHEN starts_with({x}, '-') THEN '-inf'::DOUBLE ELSE 'inf'::DOUBLE END) "
            f"WHEN regexp_full_match({x}, {_q(_DECIMAL)}) THEN TRY_CAST(replace({x}, '_', '') AS DOUBLE) END)")


def _parse_ts(x):
    """Date and time read as two pieces, each in its extended or its basic form."""
    dash = f"(substr({x}, 5, 1) = '-')"
    day = f"(CASE WHEN {dash} THEN substr({x}, 1, 10) ELSE substr({x}, 1, 8) END)"
    rest = f"(CASE WHEN {dash} THEN substr({x}, 11) ELSE substr({x}, 9) END)"
    day_ok = rf"regexp_full_match({day}, '\d{{4}}-\d\d-\d\d|\d{{8}}')"
    time_ok = (rf"({rest} = '' OR regexp_full_match({rest}, "
               rf"'\D(?:|\d\d|\d\d:\d\d|\d\d:\d\d:\d\d(?:[.,]\d+)?|\d{{4}}|\d{{6}}(?:[.,]\d+)?)'))")
    clock = f"rpad(replace(split_part(replace(substr({rest}, 2), ',', '.'), '.', 1), ':', ''), 6, '0')"
    fraction = f"rpad(left(split_part(replace(substr({rest}, 2), ',', '.'), '.', 2), 6), 6, '0')"
    stamp = f"replace({day}, '-', '') || {clock} || {fraction}"
    return f"(CASE WHEN {day_ok} AND {time_ok} THEN try_strptime({stamp}, '%Y%m%d%H%M%S%f') END)"


def _parse_date(x):
    fields = f"string_split({x}, '-')"
    ok = (rf"len({fields}) = 3 AND regexp_full_match({fields}[1], '\d{{4}}') "
          rf"AND regexp_full_match({fields}[2], '0?[1-9]|1[0-2]') "
          rf"AND regexp_full_match({fields}[3], '[0 ]?[1-9]|[12]\d|3[01]')")
    return (f"(CASE WHEN {ok} THEN TRY_CAST({fields}[1] || '-' || lpad({fields}[2], 2, '0') || '-' || "
            f"lpad(trim({fields}[3]), 2, '0') AS DATE) END)")


def _uuid_ok(x):
    s = f"replace(trim(replace(replace({x}, 'urn:', ''), 'uuid:', ''), '{{}}'), '-', '')"
    return rf"(length({s}) = 32 AND regexp_full_match({s}, '\+?[\da-fA-F]+(?:_[\da-fA-F]+)*'))"


def _rut_ok(x):
    t = f"replace(replace(upper({x}), '.', ''), '-', '')"
    body = f"substr({t}, 1, length({t}) - 1)"
    dv = f"substr({t}, length({t}), 1)"
    total = (f"list_sum(list_transform(range(length({body})), "
             f"lambda i: TRY_CAST(substr({body}, length({body}) - CAST(i AS INTEGER), 1) AS INTEGER) * (2 + i % 6)))")
    r = f"(11 - ({total}) % 11)"
    expected = f"(CASE {r} WHEN 11 THEN '0' WHEN 10 THEN 'K' ELSE CAST({r} AS VARCHAR) END)"
    return f"coalesce(length({t}) >= 2 AND regexp_matches({body}, '^[0-9]+$') AND {dv} = {expected}, false)"


def _checked_ctes() -> str:
    cols = ",\n         ".join(
        f"CASE WHEN len(p) = {len(_RAW)} THEN p[{i + 1}] END AS {_SNAKE[f]}" for i, f in enumerate(_RAW))
    strip = ",\n         ".join(f"{_strip(_SNAKE[f])} AS s_{_SNAKE[f]}" for f in _RAW)
    empty = " ".join(f"WHEN s_{_SNAKE[f]} = '' THEN {_q(f)}" for f in _RAW)
    ints = " AND ".join(_is_int(f"s_{c}") for c in ("sku", "units", "receipt", "store"))
    return f"""{_raw_cte()},
sp AS (SELECT record_no, string_split(line, ';') AS p FROM raw),
fl AS (SELECT record_no, len(p) AS n_fields,
         {cols}
       FROM sp),
st AS (SELECT *,
         {strip}
       FROM fl),
pr AS (SELECT *,
         n_fields <> {len(_RAW)} AS fails_arity,
         CASE {empty} END AS empty_field,
         NOT ({ints}) AS fails_integer,
         {_parse_int('s_units')} AS u, {_parse_int('s_receipt')} AS b, {_parse_int('s_store')} AS l,
         {_parse_float('s_discount')} AS d, {_parse_float('s_amount')} AS m,
         NOT {_rut_ok('s_national_id')} AS fails_check_digit,
         NOT {_uuid_ok('s_customer_id')} AS fails_uuid,
         {_parse_ts('s_ts')} AS pts, {_parse_date('s_birth_date')} AS pbirth,
         NOT (s_gender IN ('1', '2')) AS fails_gender
       FROM st),
rc AS (SELECT *,
         (u <= 0 OR b <= 0 OR l <= 0) AS fails_positive,
         (d IS NULL OR m IS NULL) AS fails_decimal,
         (NOT (d >= 0 AND d <= 1) OR m <= 0) AS fails_range,
         pts IS NULL AS fails_timestamp, pbirth IS NULL AS fails_birth_date,
         datediff('day', pbirth, CAST(pts AS DATE)) / 365.25 AS age_at_sale
       FROM pr),
rc2 AS MATERIALIZED (SELECT *, (age_at_sale < 0 OR age_at_sale > 110) AS fails_age FROM rc),
chk AS MATERIALIZED (SELECT record_no, {', '.join(_SNAKE[f] for f in _RAW)},
   CASE WHEN fails_arity THEN 'columna' WHEN empty_field IS NOT NULL THEN empty_field
        WHEN fails_integer THEN 'SKU o UNIDADES o BOLETA o LOCAL'
        WHEN fails_positive THEN 'UNIDADES o BOLETA o LOCAL'
        WHEN fails_decimal OR fails_range THEN 'PORCENTAJE DESCUENTO o MONTO APLICADO'
        WHEN fails_check_digit THEN 'RUN CLIENTE' WHEN fails_uuid THEN 'CODIGO CLIENTE'
        WHEN fails_timestamp THEN 'FECHA' WHEN fails_birth_date THEN 'FECHA NACIMIENTO'
        WHEN fails_age THEN 'EDAD' WHEN fails_gender THEN 'GENERO' END AS fail_field,
   CASE WHEN fails_arity THEN 'cantidad_de_columnas_incorrecta' WHEN empty_field IS NOT NULL THEN 'campo_vacio'
        WHEN fails_integer THEN 'entero_invalido' WHEN fails_positive THEN 'valor_numerico_no_positivo'
        WHEN fails_decimal THEN 'decimal_invalido' WHEN fails_range THEN 'descuento_o_monto_invalido'
        WHEN fails_check_digit THEN 'rut_invalido' WHEN fails_uuid THEN 'uuid_invalido'
        WHEN fails_timestamp OR fails_birth_date THEN 'formato_fecha_invalido'
        WHEN fails_age THEN 'edad_fuera_de_rango' WHEN fails_gender THEN 'valor_invalido' END AS fail_rule,
   CASE WHEN fails_arity THEN 'sin_valor' WHEN empty_field IS NOT NULL THEN ''
        WHEN fails_integer THEN 'valor_no_entero'
        WHEN fails_positive THEN s_units || '/' || s_receipt || '/' || s_store
        WHEN fails_decimal OR fails_range THEN s_discount || '/' || s_amount
        WHEN fails_check_digit THEN s_national_id WHEN fails_uuid THEN s_customer_id
        WHEN fails_timestamp THEN s_ts WHEN fails_birth_date THEN s_birth_date
        WHEN fails_age THEN printf('%.2f', age_at_sale) WHEN fails_gender THEN s_gender END AS fail_value
  FROM rc2)"""


def with_checked(body: str) -> str:
    """``raw`` (record_no, line), ``rc2`` (rule flags) and ``chk`` (first failure) CTEs."""
    return _join(f"{SALES},\n{_checked_ctes()}", body)


def with_raw(body: str) -> str:
    return _join(f"{SALES},\n{_raw_cte()}", body)


def with_checked_and_clean(body: str) -> str:
    return _join(f"{CLEAN},\n{_checked_ctes()}", body)
