"""Column contracts, class lists and fixed values shared by every operator."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# --- names -----------------------------------------------------------------

# Administrative column names and the name used here.
SOURCE_NAMES = {
    "id_ine_id_trabajador": "worker_id",
    "id_ine_id_empresa": "firm_id",
    "anno_devengamiento_remuneracion": "anno",
    "mes_devengamiento_remuneracion": "mes",
    "monto_remuneracion": "monto",
    "n_dias_trabajados": "dias",
    "id_ine": "person_id",
    "seccion_ciiu4cl": "seccion",
    "seccion_ciiu_4cl": "seccion",
    "division_ciiu_4cl": "division",
}

JOB = ["worker_id", "firm_id"]
PERIOD = ["anno", "mes"]

# Classification variables of the turnover statistics.
CLASSES = [
    "sexo",
    "nacionalidad_final",
    "region_final",
    "seccion",
    "tamano_empresa_movil",
    "tramo_edad",
]
RECLASS_VARS = ["tamano_empresa_movil", "tramo_edad"]

# The 16 breakdowns of stocks and flows (name -> class columns). The
# last two are published by the older generation of the statistics only.
BREAKDOWNS = {
    "total": [],
    "sx": ["sexo"],
    "nc": ["nacionalidad_final"],
    "re": ["region_final"],
    "sector": ["seccion"],
    "tamano": ["tamano_empresa_movil"],
    "te": ["tramo_edad"],
    "sx_sector": ["sexo", "seccion"],
    "sx_tamano": ["sexo", "tamano_empresa_movil"],
    "sx_re": ["sexo", "region_final"],
    "sx_te": ["sexo", "tramo_edad"],
    "nc_sector": ["nacionalidad_final", "seccion"],
    "re_sector": ["region_final", "seccion"],
    "re_tamano": ["region_final", "tamano_empresa_movil"],
    "tamano_sector": ["tamano_empresa_movil", "seccion"],
    "sx_tamano_sector": ["sexo", "tamano_empresa_movil", "seccion"],
}

# The 15 breakdowns of public employment.
PUBLIC_CLASSES = [
    "sexo",
    "nacionalidad",
    "tramo_edad",
    "sector_institucional",
    "subsector_institucional",
    "seccion_ciiu4cl_prin",
    "razon_social_unidad_legal",
]
PUBLIC_BREAKDOWNS = {
    "total": [],
    "sx": ["sexo"],
    "nc": ["nacionalidad"],
    "te": ["tramo_edad"],
    "si": ["sector_institucional"],
    "ssi": ["subsector_institucional"],
    "rue": ["seccion_ciiu4cl_prin"],
    "sx_nc": ["sexo", "nacionalidad"],
    "sx_te": ["sexo", "tramo_edad"],
    "sx_si": ["sexo", "sector_institucional"],
    "sx_ssi": ["sexo", "subsector_institucional"],
    "ssi_rue": ["subsector_institucional", "seccion_ciiu4cl_prin"],
    "rs": ["razon_social_unidad_legal"],
    "rs_rue": ["razon_social_unidad_legal", "seccion_ciiu4cl_prin"],
    "rs_ssi": ["razon_social_unidad_legal", "subsector_institucional"],
}

# The 10 class combinations of the migration rates.
MIGRATION_COMBOS = [
    ["sexo"],
    ["nacionalidad_final"],
    ["region_final"],
    ["tramo_edad_2"],
    ["tramo_edad_2", "sexo"],
    ["tramo_edad_2", "nacionalidad_final"],
    ["tramo_edad_2", "region_final"],
    ["tramo_edad_2", "sexo", "nacionalidad_final"],
    ["tramo_edad_2", "sexo", "region_final"],
    ["tramo_edad_2", "sexo", "nacionalidad_final", "region_final"],
]

# --- codes and cuts ----------------------------------------------------------

EXCLUDED_SECTIONS = ["T", "U"]
SINGLE_PERSON = "unipersonal"
NATIONALITY_UNKNOWN = [88, 99]
REGION_UNKNOWN = [17, 88, 99]
REGION_DONOR_UNKNOWN = [88, 99]

# Upper bounds of the firm size bands, in workers.
SIZE_BANDS = [(5, "micro"), (50, "pequena"), (200, "mediana")]
SIZE_TOP = "grande"

# Upper bounds of the age bands, in months of age.
AGE_CUTS_7 = [180, 300, 420, 540, 660, 780]
AGE_CUTS_13 = list(range(180, 841, 60))

START_PERIOD = (2016, 11)

# --- tables ------------------------------------------------------------------

CONTRIBUTIONS = T.StructType(
    [
        T.StructField("worker_id", T.LongType()),
        T.StructField("firm_id", T.LongType()),
        T.StructField("anno", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("tipo_trabajador", T.IntegerType()),
        T.StructField("tipo_pago", T.IntegerType()),
        T.StructField("tipo_declaracion", T.IntegerType()),
        T.StructField("monto", T.DoubleType()),
        T.StructField("dias", T.IntegerType()),
        T.StructField("codigo_mutual", T.StringType()),
    ]
)

PANEL = T.StructType(
    [
        T.StructField("worker_id", T.LongType()),
        T.StructField("firm_id", T.LongType()),
        T.StructField("anno", T.IntegerType()),
        T.StructField("mes", T.IntegerType()),
        T.StructField("tipo_trabajador", T.IntegerType()),
        T.StructField("monto", T.DoubleType()),
        T.StructField("dias", T.IntegerType()),
    ]
)

PERSONS = T.StructType(
    [
        T.StructField("person_id", T.LongType()),
        T.StructField("fecha_nac", T.DateType()),
        T.StructField("fecha_def_cor_rc", T.DateType()),
        T.StructField("sexo", T.IntegerType()),
        T.StructField("nacionalidad", T.IntegerType()),
        T.StructField("codigo_region", T.StringType()),
        T.StructField("codigo_comuna", T.StringType()),
    ]
)

PARAMETERS = T.StructType(
    [
        T.StructField("fecha", T.DateType()),
        T.StructField("utm", T.DoubleType()),
        T.StructField("usd", T.DoubleType()),
    ]
)

PRICE_INDEX = T.StructType(
    [T.StructField("fecha", T.DateType()), T.StructField("ipc", T.DoubleType())]
)


def canonical(df: DataFrame) -> DataFrame:
    """Rename administrative columns to the names used by the operators."""
    return df.withColumnsRenamed({k: v for k, v in SOURCE_NAMES.items() if k in df.columns})


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project and cast to a declared schema (stage boundary)."""
    return df.select([df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])
