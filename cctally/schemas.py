"""Internal column names and the raw export headers they come from.

Jobs work on snake_case names; raw headers are mapped once, at the reader
(``rename``), and can be mapped back at the sink.
"""

from __future__ import annotations

# raw export header -> internal name (FIXTURES §1.1)
INTERACTION_HEADERS = {
    "Usuarios": "user",
    "Fecha": "date_text",
    "Hora": "time_text",
    "Fono": "phone_in",
    "Dirección": "direction",
    "DNIS": "dnis",
    "Cola": "queue",
    "Conclusión": "conclusion",
    "Identificación de contacto": "contact_id",
    "Nombre de campaña": "campaign",
}

# FIXTURES §1.2
CONTACT_LIST_HEADERS = {
    "inin-outbound-id": "contact_id",
    "vCampaignEffectiveDate": "effective_date",
    "RUT_PERSONA": "person_id",
    "FONO_CONTACTO": "phone_1",
    "Fono1": "phone_2",
    "Segment_of_Origin": "segment",
}

# FIXTURES §1.4, §1.5
STAFFING_HEADERS = {
    "NOMBRE COMPLETO": "full_name",
    "SUPERVISOR": "supervisor",
    "ANDES": "andes",
    "SEDE": "site",
    "FECHA INGRESO": "start_date",
    "DNI": "dni",
}
QUARTILE_HEADERS = {"DNI": "dni", "Cuartil": "quartile"}
SHIFT_HEADERS = {"DNI": "dni", "Turno": "shift"}


def mojibake(text: str) -> str:
    """UTF-8 bytes read as Latin-1 (how a damaged export spells a header)."""
    return text.encode("utf-8").decode("latin-1")


def header_repairs(headers) -> dict[str, str]:
    """Damaged spelling -> internal name, built by rule from the headers."""
    out = {}
    for raw, name in headers.items():
        out[raw] = name
        bad = mojibake(raw)
        if bad != raw:
            out[bad] = name
    return out


# internal output column order of the jobs
ACCUMULATED_COLUMNS = (
    "date", "time", "queue", "agent", "phone", "disposition", "contact_id",
    "base_cloud", "source_file", "supervisor",
)
CONTACT_BASE_COLUMNS = ("base_date", "person_id", "contact_id", "phone_1", "phone_2", "segment")
CONSOLIDATED_COLUMNS = (
    "date", "time", "queue", "campaign", "agent", "phone", "disposition", "contact_id",
    "source_file", "call_type", "handled", "not_applicable", "migration", "contact",
    "errors", "untyped", "base_cloud", "bucket", "andes", "dni", "supervisor",
    "tenure", "quartile", "shift", "site",
)


# internal name -> report header of the written tables (the order is that of the column lists above)
ACCUMULATED_REPORT = {
    "date": "Fecha", "time": "Hora", "queue": "Cola", "agent": "Usuarios", "phone": "Fono",
    "disposition": "Tipificacion", "contact_id": "Identificación de contacto", "base_cloud": "Base Cloud",
    "source_file": "Origen_Archivo", "supervisor": "SUPERVISOR",
}
CONSOLIDATED_REPORT = {
    "date": "Fecha.", "time": "Hora", "queue": "Cola", "campaign": "Nombre de campaña", "agent": "Usuarios",
    "phone": "Fono", "disposition": "Tipificacion", "contact_id": "Identificación de contacto",
    "source_file": "Origen_Archivo", "call_type": "Tipo de llamada", "handled": "Gestión",
    "not_applicable": "No aplica", "migration": "Migracion", "contact": "Contacto.", "errors": "Errores",
    "untyped": "Sin tipificar", "base_cloud": "Base Cloud", "bucket": "Bucket", "andes": "ANDES", "dni": "DNI",
    "supervisor": "SUPERVISOR", "tenure": "Antiguedad", "quartile": "Cuartil", "shift": "Turno", "site": "SEDE",
}


def report_headers(df, headers):
    """The columns of a written report under their headers."""
    return df.withColumnsRenamed({k: v for k, v in headers.items() if k in df.columns})
