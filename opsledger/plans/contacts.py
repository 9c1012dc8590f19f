"""Patient contact preferences: typed, cleaned contact table from a text export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from opsledger.functions import scalars as X
from opsledger.operators.schema import conform_schema, rename_map
from opsledger.sources.writers import read_table, replace_table

# Fixed value: date format of the export.
DATE_FORMAT = "yyyy-MM-dd"

# Columns of the export, in order, and their types in the contact table.
EXPORT_COLUMNS = {
    "Patient ID": "bigint",
    "Patient Name": "string",
    "Patient First Name": "string",
    "Patient Last Name": "string",
    "Patient Cell Phone": "string",
    "Patient Home Phone": "string",
    "Patient Work Phone": "string",
    "Patient DOB": "date",
    "Patient Age": "int",
    "Patient E-mail": "string",
    "Patient Registration Date": "date",
    "Patient Registry Enabled": "string",
    "Patient Communication Notes": "string",
    "Patient Enable Letters": "string",
    "Patient Imm Registry Notification": "decimal(18,2)",
    "Patient opts out of all practice communication flag": "string",
    "Patient Text Contact Type": "string",
    "Patient Text Enabled": "string",
    "Patient Text Enabled Language": "string",
    "Patient Voice Enabled": "string",
    "Patient Voice Enabled Contact Type": "string",
    "Patient Voice Enabled Language": "string",
    "Patient Voice Enabled Time22": "string",
    "Patient Voice Enabled Time23": "string",
    "Patient Web Enabled": "string",
}

# Names that do not follow from the export's name.
SPECIAL_NAMES = {
    "Patient Voice Enabled Time22": "patient_voice_enabled_time",
    "Patient Voice Enabled Time23": "patient_voice_enabled_time_1",
}

YES_NO_COLUMNS = ["patient_web_enabled", "patient_text_enabled", "patient_voice_enabled"]

# Fixed value: the one text column that is not cleaned.
UNCLEANED = {"patient_opts_out_of_all_practice_communication_flag"}


def column_name(export_name: str) -> str:
    """Lower case with underscores, or the special name."""
    return SPECIAL_NAMES.get(export_name, export_name.lower().replace(" ", "_").replace("-", "_"))


NAMES = {name: column_name(name) for name in EXPORT_COLUMNS}


_TYPES = {"bigint": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "date": T.DateType(),
          "decimal(18,2)": T.DecimalType(18, 2)}


def contact_schema() -> T.StructType:
    return T.StructType([T.StructField(NAMES[n], _TYPES[t]) for n, t in EXPORT_COLUMNS.items()])


def contact_feed(raw: DataFrame, schema: T.StructType | None = None, date_format: str = DATE_FORMAT) -> DataFrame:
    """Typed, cleaned contacts. Values are cleaned before the cast, so an invisible character costs no value."""
    schema = schema or contact_schema()
    cleaned = [f.name for f in schema.fields if f.name not in UNCLEANED]
    df = conform_schema(rename_map(raw, NAMES), schema, date_format, clean=cleaned)
    return df.withColumns({c: X.yes_no(c) for c in YES_NO_COLUMNS if c in df.columns})


def store_contacts(raw: DataFrame, paths: list[str], refuse_empty: bool = True) -> None:
    """The contact table in each of the given places: the export is read once, further places copy the first table."""
    contacts = contact_feed(raw)
    for path in paths:
        replace_table(contacts, path, refuse_empty)
        contacts = read_table(raw.sparkSession, paths[0])
