"""Layouts of the incoming files and of the tables.

File layouts are declared, never inferred: numbers and dates that need cleaning
stay text until a job casts them.
"""

from __future__ import annotations

from pyspark.sql import types as T

S, I, L, D = T.StringType(), T.IntegerType(), T.LongType(), T.DateType()
MONEY = T.DecimalType(18, 2)


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# ---- files ----
PAYMENT_FILE = _struct(("id_pago", L), ("fecha", S), ("cvu", S), ("valor", S))
PERSON_FILE = _struct(
    ("nombre", S), ("apellido", S), ("dni", L), ("email", S), ("telefono", L), ("cvu", S), ("inquilino", I)
)
BUILDING_FILE = _struct(
    ("consorcio", S), ("nombre", S), ("direccion", S), ("unidades", I), ("m2_total", MONEY)
)
SUPPLIER_FILE = _struct(("tipo_gasto", S), ("empresa_detalle", S), ("detalle_adicional", S), ("consorcio", S))
UNIT_HOLDER_FILE = _struct(("cvu", S), ("consorcio", S), ("numero", I), ("piso", S), ("departamento", S))
UNIT_SIZE_FILE = _struct(
    ("consorcio", S), ("numero", S), ("piso", S), ("departamento", S), ("coeficiente", S), ("m2", S),
    ("baulera", S), ("cochera", S), ("m2_baulera", S), ("m2_cochera", S),
)
# Keys of the monthly cost document, blanks and dashes included.
COST_DOCUMENT = T.StructType([
    T.StructField("_id", _struct(("$oid", S))),
    T.StructField("Nombre del consorcio", S),
    T.StructField("Mes", S),
    T.StructField("BANCARIOS", S),
    T.StructField("LIMPIEZA", S),
    T.StructField("ADMINISTRACION", S),
    T.StructField("SEGUROS", S),
    T.StructField("GASTOS GENERALES", S),
    T.StructField("SERVICIOS PUBLICOS-Agua", S),
    T.StructField("SERVICIOS PUBLICOS-Luz", S),
])

# ---- tables; *_cents columns hold BIGINT cents, *_bp basis points ----
TABLES = {
    "tipo_rol": _struct(("id", I), ("nombre", S), ("descripcion", S)),
    "cuenta_bancaria": _struct(("cvu", S), ("titular", S), ("saldo_cents", L)),
    "forma_de_pago": _struct(("id", I), ("descripcion", S), ("confirmacion", S)),
    "persona": _struct(
        ("id", L), ("nombre", S), ("apellido", S), ("dni", S), ("email", S), ("cvu", S), ("telefono", S),
        ("rol_id", I),
    ),
    "consorcio": _struct(
        ("id", L), ("nombre", S), ("cvu", S), ("direccion", S), ("m2_total", MONEY), ("saldo_cents", L)
    ),
    "pago": _struct(("id_pago", L), ("forma_pago_id", I), ("cvu", S), ("fecha", D), ("importe_cents", L)),
    "unidad": _struct(
        ("uf_id", L), ("cvu", S), ("consorcio_id", L), ("departamento", S), ("piso", S), ("numero", I),
        ("m2", MONEY), ("pct_bp", L), ("tipo", S),
    ),
    "expensa": _struct(
        ("consorcio_id", L), ("periodo", D), ("saldo_anterior_cents", L), ("ingresos_cents", L),
        ("adeudados_cents", L), ("adelantados_cents", L), ("egresos_cents", L), ("saldo_cierre_cents", L),
    ),
    "cochera": _struct(("uf_id", L), ("numero", L), ("pct_bp", L), ("share_num", L), ("share_den", L)),
    "baulera": _struct(("uf_id", L), ("numero", L), ("pct_bp", L), ("share_num", L), ("share_den", L)),
    "gasto_ordinario": _struct(
        ("consorcio_id", L), ("empresa", S), ("nro_factura", S), ("fecha", D), ("importe_cents", L),
        ("detalle", S), ("tipo_servicio", S), ("periodo_expensa", D),
    ),
    "gasto_extraordinario": _struct(
        ("consorcio_id", L), ("empresa", S), ("nro_factura", S), ("fecha", D), ("importe_cents", L),
        ("detalle", S), ("es_pago_total", T.BooleanType()), ("nro_cuota", I), ("total_cuota_cents", L),
        ("periodo_expensa", D),
    ),
    "detalle_expensa": _struct(
        ("consorcio_id", L), ("uf_id", L), ("periodo", D), ("ord_cents", L), ("ext_cents", L),
        ("deuda_cents", L), ("interes_cents", L), ("total_cents", L), ("pagado_cents", L), ("primera_fecha", D),
        ("pagado_anterior_cents", L), ("vencimiento_1", D), ("vencimiento_2", D), ("mora_cents", L),
    ),
    "rechazo": _struct(("origen", S), ("motivo", S), ("detalle", S)),
    "pago_aplicado": _struct(
        ("id_pago", L), ("uf_id", L), ("consorcio_id", L), ("periodo", D), ("fecha", D), ("importe_cents", L)
    ),
}

# Facts and the date by whose month they are partitioned.  Costs go by the statement that charges them, which is
# where a run looks for them; costs not charged yet have none.
PARTITION_BY = {
    "pago": "fecha", "pago_aplicado": "periodo", "expensa": "periodo", "detalle_expensa": "periodo",
    "gasto_ordinario": "periodo_expensa", "gasto_extraordinario": "periodo_expensa",
}

# Seed rows every installation starts with.
ROLE_SEEDS = (
    ("Inquilino", "Persona que alquila una unidad funcional dentro del consorcio."),
    ("Propietario", "Dueño de una o más unidades funcionales dentro del consorcio."),
)
PAYMENT_METHOD_SEEDS = (
    ("Transferencia Bancaria", "Comprobante"),
    ("Efectivo en Oficina", "Recibo Manual"),
    ("Mercado Pago/Billetera", "ID de Transaccion"),
)
DEFAULT_PAYMENT_METHOD = 1
UNKNOWN_ADDRESS = "Dirección desconocida"

# Unit types and the vendors and details for general costs without one.
UNIT_TYPES = ("local", "departamento", "duplex")
GENERAL_VENDORS = (
    "Fumigadora La Rápida",
    "Iluminación LED S.A.",
    "Llaves Express",
    "Servicios de Mantenimiento Integral",
    "Piscinas del Sur",
)
GENERAL_DETAILS = (
    "Reposición de lámparas LED",
    "Duplicado de llaves",
    "Fumigación mensual",
    "Mantenimiento de extinguidores",
    "Limpieza de tanque de agua",
    "Mantenimiento de jardines",
)
