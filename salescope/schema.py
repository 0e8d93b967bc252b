"""Field names of the sales table.

Raw files carry the public (Spanish) header; inside the library columns are
snake_case.  The mapping is the only place both spellings meet.
"""

# The raw header, in file order, as it must appear in input files.
RAW_FIELDS = [
    "FECHA",
    "CANAL",
    "SKU",
    "PRODUCTO",
    "UNIDADES",
    "PORCENTAJE DESCUENTO",
    "MONTO APLICADO",
    "BOLETA",
    "LOCAL",
    "CODIGO CLIENTE",
    "RUN CLIENTE",
    "NOMBRES",
    "APELLIDOS",
    "FECHA NACIMIENTO",
    "GENERO",
]

# Internal snake_case name for each raw field (same order as RAW_FIELDS).
SNAKE = {
    "FECHA": "ts",
    "CANAL": "channel",
    "SKU": "sku",
    "PRODUCTO": "product",
    "UNIDADES": "units",
    "PORCENTAJE DESCUENTO": "discount",
    "MONTO APLICADO": "amount",
    "BOLETA": "receipt",
    "LOCAL": "store",
    "CODIGO CLIENTE": "customer_id",
    "RUN CLIENTE": "national_id",
    "NOMBRES": "first_names",
    "APELLIDOS": "last_names",
    "FECHA NACIMIENTO": "birth_date",
    "GENERO": "gender",
}
RAW_OF = {v: k for k, v in SNAKE.items()}

# Columns the cleaning stage requires (checked before any job runs).
CLEAN_REQUIRED = ["ts", "channel", "sku", "units", "discount", "amount", "receipt", "store",
                  "customer_id", "national_id", "birth_date", "gender"]

# Rows missing any of these are dropped by the cleaning stage.
ESSENTIAL = ["ts", "channel", "units", "amount", "store", "customer_id", "national_id"]

# The six numeric variables of the exploratory reports, in report order.
NUMERIC = ["units", "discount", "amount", "amount_per_unit", "age", "purchase_frequency"]

MAX_VALID_AGE = 110
