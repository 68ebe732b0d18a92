"""One mail payload per statement line, ready for an HTTP mail API."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import money

# Texts of the message.
SUBJECT = "Expensa Mensual"
SENDER_NAME = "Sistema de Expensas"


CONTACT = ("email", "nombre", "apellido", "departamento", "consorcio")


def with_contacts(units: DataFrame, buildings: DataFrame, persons: DataFrame) -> DataFrame:
    """Units with holder and building, as ``CONTACT`` names them: joined once per unit, for ``statement_detail`` to carry to its lines."""
    names = buildings.select(F.col("id").alias("consorcio_id"), F.col("nombre").alias("consorcio"))
    return units.join(persons.select("cvu", "email", "nombre", "apellido"), "cvu").join(names, "consorcio_id")


def recipients(lines: DataFrame, units: DataFrame | None = None, buildings: DataFrame | None = None, persons: DataFrame | None = None) -> DataFrame:
    """Statement lines with holder, unit and building: lines that carry them, or lines to be joined with them by unit."""
    if units is not None:
        contacts = with_contacts(units.select("uf_id", "cvu", "consorcio_id", "departamento"), buildings, persons)
        lines = lines.join(contacts.select("uf_id", *CONTACT), "uf_id")
    return lines.select(
        "uf_id", "periodo", *CONTACT,
        "vencimiento_1", "vencimiento_2", "total_cents", "mora_cents", "pagado_anterior_cents", "pagado_cents",
    )


def _html(text: Column) -> Column:
    """Text safe inside HTML."""
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return F.coalesce(text, F.lit(""))


def _json(text: Column) -> Column:
    """Text as it stands between the quotes of a JSON string."""
    quoted = F.to_json(F.struct(text.alias("v")))  # {"v":"..."}
    return F.substring(quoted, F.lit(7), F.length(quoted) - 8)


def _day(date: Column) -> Column:
    """Date as dd/MM/yyyy."""
    text = date.cast("string")
    return F.concat(F.substring(text, 9, 2), F.lit("/"), F.substring(text, 6, 2), F.lit("/"), F.substring(text, 1, 4))


def _amount(cents: Column) -> Column:
    """Cents as plain text with two decimals, ``-1234.50``."""
    return F.concat(F.when(cents < 0, "-").otherwise(""), money.plain_text(F.abs(cents)))


def letters(contacts: DataFrame, sender: str) -> DataFrame:
    """Rows with ``CONTACT``, with the parts of a payload that their lines share: ``inicio`` up to the month, ``unidad`` up to the amounts.

    Made once per unit, so that names and mail are quoted once and not for each line.
    """
    name, subject, sender_name = (_json(F.lit(x)) for x in (sender, SUBJECT, SENDER_NAME))
    return contacts.withColumns({
        "inicio": F.concat(
            F.lit('{"personalizations":[{"to":[{"email":"'), _json(F.col("email")), F.lit('"}],"subject":"'), subject,
            F.lit('"}],"from":{"email":"'), name, F.lit('","name":"'), sender_name,
            F.lit('"},"content":[{"type":"text/html","value":"<h1>'), _json(_html(F.col("apellido"))), F.lit(" "), _json(_html(F.col("nombre"))),
            F.lit("</h1><p>Detalle de su expensa de "),
        ),
        "unidad": F.concat(
            F.lit(", unidad "), _json(_html(F.col("departamento"))), F.lit(" del consorcio "), _json(_html(F.col("consorcio"))),
            F.lit('.</p><ul class=\\"importes\\"><li>Total a pagar: $'),
        ),
    })


LETTER = ("email", "inicio", "unidad")


def payloads(rows: DataFrame, sender: str) -> DataFrame:
    """(uf_id, periodo, email, payload) of statement lines with ``CONTACT``, or with ``LETTER`` of the same sender."""
    if not set(LETTER) <= set(rows.columns):
        rows = letters(rows, sender)

    def shown(text: Column) -> Column:
        return F.coalesce(text, F.lit("null"))

    payload = F.concat(
        "inicio", shown(F.substring(_day(F.col("periodo")), 4, 7)), "unidad",
        shown(_amount(F.col("total_cents"))), F.lit("</li><li>Saldo anterior abonado: $"), shown(_amount(F.col("pagado_anterior_cents"))),
        F.lit("</li><li>Pagos recibidos: $"), shown(_amount(F.col("pagado_cents"))),
        F.lit("</li><li>Interés por mora: $"), shown(_amount(F.col("mora_cents"))),
        F.lit('</li></ul><ul class=\\"vencimientos\\"><li>'), shown(_day(F.col("vencimiento_1"))),
        F.lit(": sin recargo</li><li>"), shown(_day(F.col("vencimiento_2"))),
        F.lit(': con 2% de recargo</li><li>Después: con 5% de recargo</li></ul>"}]}'),
    )
    return rows.filter(F.col("email").isNotNull()).select("uf_id", "periodo", "email", payload.alias("payload"))
