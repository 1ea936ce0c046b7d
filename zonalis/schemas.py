"""Column names of the source files. Codes are strings; counts are cast where they are used."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


TEXT, COUNT = T.StringType(), T.LongType()

# File layouts of the 2019 election (lower-cased headers).
PARTIES_2019 = _schema(codigo_categoria=TEXT, codigo_agrupacion=TEXT, nombre_agrupacion=TEXT)
REGIONS_2019 = _schema(codigo_region=TEXT, nombre_region=TEXT)
BOX_TOTALS_2019 = _schema(codigo_categoria=TEXT, codigo_mesa=TEXT, contador=TEXT, valor=COUNT)
BOX_VOTES_2019 = _schema(
    codigo_categoria=TEXT,
    codigo_distrito=TEXT,
    codigo_seccion=TEXT,
    codigo_circuito=TEXT,
    codigo_mesa=TEXT,
    codigo_agrupacion=TEXT,
    votos_agrupacion=COUNT,
)

# File layouts of the 2015 elections.
PARTIES_2015 = _schema(codigo_partido=TEXT, denominacion=TEXT)
ZONE_2015 = ["codigo provincia", "codigo departamento", "codigo circuito"]
VOTES_2015 = _schema(**{name: TEXT for name in [*ZONE_2015, "codigo votos", "votos"]})

# The dictionary of final columns, polling places and polygon attributes.
DICTIONARY = _schema(vars=TEXT, in_file=T.IntegerType(), new_name=TEXT)
POLLING_PLACE = {"ID_DISTRITO": T.IntegerType(), "ID_SECCION": T.IntegerType()}
