"""A small set of all relations, with the sendings of the report tests."""

import datetime as dt
from decimal import Decimal as D

import pyarrow as pa
from pyspark.sql.pandas.types import to_arrow_schema

from mesada.sources.readers import Relations
from mesada.sources.schemas import schema_of


def ts(text):
    return dt.datetime.fromisoformat(text)


# solicitud, fechaenvio, type, bank, amount
SENDINGS = [
    (101, "2024-01-02 08:15", 1, 1, "30000000"),
    (102, "2024-01-02 12:00", 1, 1, "45000000.50"),
    (103, "2024-01-15 14:30", 6, 1, "-1200000"),
    (104, "2024-01-02 10:30", 1, 1, "1"),
    (105, "2024-01-02 07:00", 2, 1, "500000"),
    (106, "2023-12-29 08:00", 1, 1, "1"),
    (107, "2024-01-01 08:00", 1, 1, "1"),
    (108, "2024-01-31 16:00", 1, 1, "1"),
    (109, "2024-01-02 09:59", 7, 99, "700000"),
    (110, "2024-01-03 13:59", 2, 1, "900000"),
]


def rows(extra_sendings=(), missing_insurance=(), duplicate_lines=(), children=(), plan=None,
         no_motor=(), lines=None):
    """Rows per relation; every request n uses lookups with id n."""
    sendings = SENDINGS + list(extra_sendings)
    ids = sorted({s[0] for s in sendings})
    first = {}
    for s in sendings:
        first.setdefault(s[0], s)
    plan = plan or {}
    dsm = [
        (i, f"NC{i}", "CC", f"900{i}", D(first[i][4]), first[i][2]) for i in ids
    ] + [(i, f"NC{i}", "CC", f"900{i}", D(first[i][4]), first[i][2]) for i in duplicate_lines]
    return {
        "desembolso": dsm if lines is None else lines,
        "desembolsorelacion": [
            (s, ts(t), kind, f"RAZON {s}", f"800{s}", bank, f"CTA{s}", "AHORROS", D(amount))
            for s, t, kind, bank, amount in sendings
        ],
        "originacion_solicitudes": [(i, f"NOMBRE {i}", "MS", "LS", "2020", "F-SOR") for i in ids],
        "originacion": [(i, i, i, i, i, 1, i, i) for i in ids],
        "datosfactura": [
            (i, D("50000000.00"), D("250000"), "MF", "LF", "2024", f"PLA{i}", f"CHA{i}",
             None if i in no_motor else f"MOT{1000 - i}")
            for i in ids
        ],
        "seguros": [
            (i, D("1234567.5"), D("100.50"), None, D("7"), None, None, None, 1,
             1 if i == 103 else 0)
            for i in ids if i not in missing_insurance
        ],
        "informacionestudio": [(i, None, 2, 1) for i in ids],
        "operaciones": [
            (i, D("29000000"), D("0.50"), 5, 9, plan.get(i, (0,))[0],
             *(plan[i][1] if i in plan else (None,) * 6))
            for i in ids
        ],
        "planfinanciacion": [(1, "M", 48)],
        "tasas_ek": [(1, 77)],
        "tasas": [(77, D("0.185000"))],
        "diadepago": [(5, 15)],
        "modalidadpagosegurovida": [(1, "Financiado")],
        "cliente": [(i, None, "RUIZ", None, "ana", "maria") for i in ids],
        "vehiculo": [(i, 3) for i in ids],
        "fasecolda_ref3_ek": [(3, 30)],
        "fasecolda_ref3": [(30, "F-REF")],
        "registrogarantiamobiliar": [(9, D("12"))],
        "informacionpm": list(children),
        "banco": [(1, "BANCO UNO")],
        "diasfestivos": [],
    }


def relations(spark, data):
    def frame(name):
        schema = schema_of(name)
        # Through Arrow these become local relations of known size.
        columns = list(zip(*data[name], strict=True)) or [[] for _ in schema]
        table = pa.table([list(col) for col in columns], schema=to_arrow_schema(schema))
        return spark.createDataFrame(table, schema)

    return Relations(frame, names=tuple(data))
