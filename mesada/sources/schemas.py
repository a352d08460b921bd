"""The input relations. Types are inferred from how the reports use the columns."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Relation and column names of the input.
_DDL = {
    "desembolso": (
        "Solicitud bigint, numeroCredito string, tipoIdentificacion string, "
        "numeroIdentificacion string, montoDesembolsar decimal(18,2), IdDesembolsodetalle int"
    ),
    "desembolsorelacion": (
        "solicitud bigint, fechaenvio timestamp_ntz, IdDesembolsoDetalle int, razonSocial string, "
        "numeroIdentificacion string, idBanco int, numeroCuenta string, tipoCuenta string, "
        "montoDesembolsar decimal(18,2)"
    ),
    "originacion_solicitudes": (
        "solicitud bigint, Nombres string, Marca string, LineaVeh string, Modelo string, "
        "fasecolda string"
    ),
    "originacion": (
        "caso bigint, DatosFactura bigint, Seguros bigint, InformaciondeEstudio bigint, "
        "Operaciones bigint, PlanFinanciacion bigint, Cliente bigint, Vehiculo bigint"
    ),
    "datosfactura": (
        "idDatosFactura bigint, ValorVehiculoFactura decimal(18,2), "
        "ValorAccesoriosFactura decimal(18,2), MarcaFactura string, LineaFactura string, "
        "ModeloFactura string, Placa string, ChasisFactura string, MotorFactura string"
    ),
    "seguros": (
        "idSeguros bigint, iValorMantenimiento decimal(18,2), PrimaSegurodeVida decimal(18,2), "
        "PrimaSegurodeDesempleo decimal(18,2), ValorProteccionFinancieraM decimal(18,2), "
        "PrimaSegurodeAutomovil decimal(18,2), BonoAstara decimal(18,2), "
        "valorPolizaTR decimal(18,2), ModalidadPagoseguroVida int, bMantenimientoPrepagado int"
    ),
    "informacionestudio": (
        "idInformacionestudio bigint, ValorSubvecionado decimal(18,2), tipodeGarantia int, "
        "Tasa bigint"
    ),
    "operaciones": (
        "idOperaciones bigint, MontoaFinanciarSinSeguros decimal(18,2), GMF decimal(18,2), "
        "DiadePago int, rgm bigint, planmayor int, OperacionCancelarPM string, "
        "OperacionaCancelarPM2 string, OperacionaCancelarPM3 string, valorcruce1 decimal(18,2), "
        "valorcruce2 decimal(18,2), valorcruce3 decimal(18,2)"
    ),
    "planfinanciacion": "idPlanFinanciacion bigint, unidadTiempo string, Cuotas int",
    "tasas_ek": "idTasas bigint, id1 bigint",
    "tasas": "id1 bigint, Efectiva decimal(18,6)",
    "diadepago": "idDiadePago int, DiadePagoCuota int",
    "modalidadpagosegurovida": "idModalidadPagoSegurovida int, Valor string",
    "cliente": (
        "idCliente bigint, NombreConcatenado string, Apellido1 string, Apellido2 string, "
        "Nombre1 string, Nombre2 string"
    ),
    "vehiculo": "idVehiculo bigint, FASECOLDA bigint",
    "fasecolda_ref3_ek": "idFASECOLDA_REF3 bigint, id1 bigint",
    "fasecolda_ref3": "id1 bigint, fasecolda string",
    "registrogarantiamobiliar": "idRegistroGarantiaMobiliar bigint, RGM decimal(18,2)",
    "informacionpm": (
        "idInformacionPM bigint, DatosFactura bigint, Operacionacancelar string, "
        "valorcruce decimal(18,2)"
    ),
    "banco": "Id int, Nombre string",
    "diasfestivos": "fecha date",
}

RELATIONS = tuple(_DDL)


def ddl_of(name: str) -> str:
    return _DDL[name]


def text_columns(name: str) -> list[str]:
    """Names of a relation's string columns."""
    columns = (c.split(" ") for c in _DDL[name].split(", "))
    return [column for column, kind in columns if kind == "string"]


def schema_of(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])
