"""Classification settings of the jobs.

Lists whose exact text decides a classification are fixed values; everything
that names people, queues, campaigns or files is a job input (defaults are
empty or neutral).
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- fixed values -----------------------------------------------------------
# Literal prefixes/suffixes removed from a call conclusion, in this order.
CONCLUSION_LITERALS = (
    "ININ-OUTBOUND-CAMPAIGN-FORCED-OFF; ",
    "ININ-OUTBOUND-TRANSFERRED-TO-QUEUE; ",
    "ININ-OUTBOUND-",
    "ININ-",
    " - SOP",
)
# Dispositions counted as "not applicable" (C2).
NOT_APPLICABLE = (
    "MIGRACION YA GENERADA POR OTRA CAMPAÑA",
    "CLIENTE INFACTIBLE",
    "SIN FACTIBILIDAD",
)
# Dispositions counted as a migration.
MIGRATION = (
    "ACEPTA REINGRESO MIGRACION",
    "ACEPTA AGENDA - MIGRACION",
)
# Dispositions that mean the customer was reached (C4).
CONTACT = (
    "ACEPTA AGENDA - MIGRACION", "ACEPTA REINGRESO MIGRACION", "CLIENTE INFACTIBLE",
    "NO ACEPTA MIGRACION", "NO ACEPTA - DARÁ DE BAJA EL SERVICIO", "CLIENTE MOLESTO",
    "MIGRACION YA GENERADA POR OTRA CAMPAÑA", "VOLVER A LLAMAR", "NO VOLVER A LLAMAR",
    "MENOR DE EDAD", "Error de ingreso", "WRAP-UP-TIMEOUT", "NUMERO EQUIVOCADO",
    "SIN FACTIBILIDAD", "CORTA LLAMADO", "CLIENTE FALLECIDO", "CLIENTE RECLAMO SUBTEL -SOP",
)
ERROR_DISPOSITION = "Error de ingreso"
UNTYPED_DISPOSITION = "WRAP-UP-TIMEOUT"
# Accumulated job: dispositions kept (F3, case-insensitive regex).
ACCEPTED_PATTERN = "ACEPTA AGENDA - MIGRACION|ACEPTA REINGRESO MIGRACION"
# Form report.
FORM_MIGRATION = ("ACEPTA AGENDA - MIGRACION - SOP", "ACEPTA REINGRESO MIGRACION - SOP")
FORM_NOT_ACCEPTED = "NO ACEPTA"
FORM_CONTACT_YES = "SI"
# Labels written by the jobs.
DIALLER = "Discador"
MANUAL = "Manual"
MANUAL_DIRECTIONS = ("Entrante", "Saliente")
CONTACT_YES, CONTACT_NO = "Contacto", "No Contacto"
NOT_FOUND = "No Encontrado"
LOOKUP_FAILED = "Error de Cruce"
NO_QUEUE = "-"
# Text repairs of damaged (UTF-8 read as Latin-1) letters.
REPAIR_TO_ASCII = {
    "\xc3\xa1": "a", "\xc3\xa9": "e", "\xc3\xad": "i", "\xc3\xb3": "o", "\xc3\xba": "u",
    "\xc3\xb1": "n", "\xc3\x91": "N", "\xc3\xa3": "a", "\xc3\xa3S": "es", "\xc3\xa3N": "n",
    "\xc2\x94": "",
}
REPAIR_TO_ACCENTS = {
    "\xc3\xa1": "á", "\xc3\xa9": "é", "\xc3\xad": "í", "\xc3\xb3": "ó", "\xc3\xba": "ú",
    "\xc3\xb1": "ñ", "\xc3\x91": "Ñ", "\xc2\xb0": "°", "\xc2\x94": "",
}
# Form report: columns removed from the output when present.
FORM_DROP_COLUMNS = (
    "FECHA DE LA BASE", "FECHA", "Unnamed: 18", "platform_user",
    "OBSERVACIÓN", "NUMERO DE PEDIDO", "NUMERO TICKET", "start_date",
    "Login Time", "Ready Time", "Out", "Not Ready Time", "ACW Time",
    "Break Time", "Lunch Time", "Offline Time", "Ringing Time",
    "Dialing Time", "Handle Time", "In Time", "Out Time", "Internal Time",
    "Calls Dropped", "Internal", "Held", "Transfers Made", "Consult Made",
    "AHT", "Avg ACW Time", "Avg Hold Time", "Avg In Time", "Avg Out Time",
    "Avg Ring Time", "Name", "Hold Time", "Consult Time", "form_base",
)
# Campaign activity: output order and renames.
CAMPAIGN_RENAMES_BEFORE = {"Answers": "Contacto (Answer)", "Records Completed": "Gestiones Completas"}
CAMPAIGN_ORDER = (
    "Name", "Hit Ratio", "Estimated Time", "Gestiones Completas", "Contacto (Answer)",
    "Dialed Abandoned", "Dialed Answering Machine", "Attempt Busies", "Attempts Cancelled",
    "Attempts made", "DoNotCall Results", "Dropped Results", "Fax Modem Results",
    "No Answer Result", "Wrong Party Result", "SIT Detected",
)
CAMPAIGN_RENAMES_AFTER = {"No Answer Result": "No Contacto (No Answer Result)"}


@dataclass
class JobInputs:
    """Business inputs of a run (everything specific to one operation)."""
    queue_map: dict = field(default_factory=dict)        # C1: queue code -> base label
    name_fixes: dict = field(default_factory=dict)       # X4: agent spelling -> canonical
    excluded_campaigns: tuple = ()                       # F2
    campaign_names: tuple = ()                           # F1 (L6)
    file_rules: tuple = ()                               # F9: ((substrings...), label) in order
    bucket_columns: dict = field(default_factory=dict)   # A2: output column -> label
    default_site: str | None = None                      # J9
    dialler: str = DIALLER
