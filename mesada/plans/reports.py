"""The reports, for one reporting date or for many in one job.

Shape shared by all of them: cut the facts down to the reported months and batches first,
drop or count equal rows before they are joined, join each request's lookups once, and
attach them to the facts. Each result carries `as_of` unless `with_as_of` is False.

No job runs before the result is asked for. Reports on few months leave most of each lookup
table unread if the tables are stored by key (`sources.writers.write_by_key`): then only the
sent requests are shuffled, whatever their number.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mesada.functions.dates import ddmmyyyy
from mesada.functions.labels import (
    account_type,
    channel,
    display_name,
    guarantee_fee,
    is_prepaid,
    protection_mode,
    protection_value,
    remarks,
    transfer_value,
)
from mesada.functions.text import (
    dollar,
    empty_to_null,
    money,
    money_text,
    num_text,
    nvl,
    term_code,
)
from mesada.operators.calendar import ReportCalendar, end_dates, start_dates
from mesada.operators.distinct import distinct_rows
from mesada.operators.gate import month_gate, type_filter
from mesada.operators.lookups import SPREAD, bridge_lookup, lookup, with_spread
from mesada.operators.ordering import order_by_ordinal
from mesada.operators.ranked import account_number, fold_fixed, ranked_fold
from mesada.operators.totals import positional, totals_per_date, weighted_sum
from mesada.profiles import Profile, get_profile

Tables = Mapping[str, DataFrame]

# Output columns by position.
DISBURSEMENT_COLUMNS = (
    "OP", "FECHA", "NUMEROCREDITO", "NOMBRE", "TIPO CC/CE", "CC/CE", "PLAZOMESES", "INTERES",
    "VLRVEHICULOFACTURA", "VLRFINANCIARVEHICULO", "VLRSUBVENCION", "MANTENIMIENTO_PREPAGADO",
    "VLRACCESORIOS", "VLRVIDA", "VLRPROTECCIONFINANCIERA", "VLRSEGUROVEHICULO", "BONO POLIZA",
    "VLR TR A FINANCIAR", "GMF", "RGM", "TOTALDESEMBOLSO", "FECHAPAGO", "MARCA", "LINEA",
    "MODELO", "FASECOLDA", "PLACA", "CHASIS", "MOTOR", "MODALIDADPAGOSEGUROVIDA",
    "MODALIDADPROTECCIONFINANCIERA", "CORTE DISPERSION",
)
TRANSFER_COLUMNS = (
    "SOLICITUD", "BENEFICIARIO", "CC/NIT/CE", "BANCO", "NUMEROCUENTA", "TIPOCUENTA", "VLRGIRAR",
    "CANAL GIRO", "OBSERVACIONES", "CORTE DISPERSION",
)
# Totals: position -> column, all other positions are placeholders.
DISBURSEMENT_TOTALS = {
    10: "VLRFINANCIARVEHICULO", 11: "VLRSUBVENCION", 12: "MANTENIMIENTO_PREPAGADO",
    13: "VLRACCESORIOS", 17: "BONO_POLIZA", 20: "TOTALDESEMBOLSO",
}
DISBURSEMENT_TOTALS_WIDTH, DISBURSEMENT_TOTALS_LABEL = 31, "Totales"
TRANSFER_TOTALS = {7: "VLRGIRAR"}
TRANSFER_TOTALS_WIDTH, TRANSFER_TOTALS_LABEL = 7, "TOTAL"


def _layout(slots: dict[int, str], width: int) -> list[str | None]:
    return [slots.get(i) for i in range(1, width + 1)]


def _finish(
    df: DataFrame, profile: Profile, with_as_of: bool, order: int | None = None
) -> DataFrame:
    if not with_as_of:
        df = df.drop("as_of")
    if profile.empty_as_null:
        df = empty_to_null(df)
    return df if order is None else order_by_ordinal(df, order, skip=1 if with_as_of else 0)


def _case_keys(t: Tables, *extra: str) -> DataFrame:
    ori = t["originacion"]
    return ori.select("caso", *[F.col(c).alias(f"ori_{c}") for c in extra])


def disbursement_detail(
    t: Tables, cal: ReportCalendar, profile: Profile | str = "v1", with_as_of: bool = True,
    ordered: bool = True, month_col: str | None = None,
) -> DataFrame:
    """One row per distinct disbursement line of the reported batches.

    A sending contributes only its date and batch, so equal ones are dropped right after
    the gate; what is left per request is bounded by the days and batches of a month.
    Lookups are joined at that grain. The disbursement rows, the only side that may pile
    up on one request, come last, in a join of two shuffled sides that Spark can split.
    """
    p = get_profile(profile)
    nc = p.null_concat
    c = F.col

    envios = t["desembolsorelacion"].select("solicitud", "fechaenvio", *_opt(month_col))
    sent = (
        month_gate(
            envios, cal, "fechaenvio", guard=True, cutoff_op=p.cutoff_op, month_col=month_col
        )
        .select("as_of", "solicitud", ddmmyyyy(F.to_date("fechaenvio")).alias("fecha"), "corte")
        .distinct()
    )
    cases = _case_keys(
        t, "DatosFactura", "Seguros", "InformaciondeEstudio", "Operaciones", "PlanFinanciacion",
        "Cliente", "Vehiculo",
    )
    sor = t["originacion_solicitudes"].select(
        c("solicitud").alias("sor_id"),
        c("Nombres").alias("sor_nombres"),
        c("Marca").alias("sor_marca"),
        c("LineaVeh").alias("sor_linea"),
        c("Modelo").alias("sor_modelo"),
        c("fasecolda").alias("sor_fasecolda"),
    )
    # J2, J3 share the request key.
    df = lookup(sent, cases, "solicitud", "caso")
    df = lookup(df, sor, "solicitud", "sor_id", "left")
    # J4-J8
    df = lookup(df, t["datosfactura"], "ori_DatosFactura", "idDatosFactura")
    df = lookup(df, t["seguros"], "ori_Seguros", "idSeguros")
    df = lookup(df, t["informacionestudio"], "ori_InformaciondeEstudio", "idInformacionestudio")
    ope = t["operaciones"].select(
        "idOperaciones", "MontoaFinanciarSinSeguros", "GMF", "DiadePago", c("rgm").alias("ope_rgm")
    )
    df = lookup(df, ope, "ori_Operaciones", "idOperaciones")
    df = lookup(df, t["planfinanciacion"], "ori_PlanFinanciacion", "idPlanFinanciacion")
    # J9, J10
    rates = t["tasas"].select(c("id1").alias("tas_id"), "Efectiva")
    df = bridge_lookup(df, t["tasas_ek"], rates, "Tasa", "idTasas", "id1", "tas_id")
    # J11-J14, J17
    df = lookup(df, t["diadepago"], "DiadePago", "idDiadePago", "left")
    df = lookup(
        df, t["modalidadpagosegurovida"], "ModalidadPagoseguroVida", "idModalidadPagoSegurovida",
        "left",
    )
    df = lookup(df, t["cliente"], "ori_Cliente", "idCliente", "left")
    vehicles = t["vehiculo"].select("idVehiculo", c("FASECOLDA").alias("veh_fasecolda"))
    df = lookup(df, vehicles, "ori_Vehiculo", "idVehiculo", "left")
    # J15, J16
    codes = t["fasecolda_ref3"].select(
        c("id1").alias("fas_id"), c("fasecolda").alias("fas_fasecolda")
    )
    df = bridge_lookup(
        df, t["fasecolda_ref3_ek"], codes, "veh_fasecolda", "idFASECOLDA_REF3", "id1", "fas_id",
        "left",
    )
    fees = t["registrogarantiamobiliar"].select(
        c("idRegistroGarantiaMobiliar").alias("rgm_id"), c("RGM").alias("rgm_valor")
    )
    df = lookup(df, fees, "ope_rgm", "rgm_id", "left")

    # The type of the disbursement row decides here (Q7).
    lines = (
        t["desembolso"]
        .filter(type_filter(c("IdDesembolsodetalle"), p.disbursement_types))
        .drop("IdDesembolsodetalle")
        .withColumnRenamed("Solicitud", "op")
    )
    df = lines.join(df, c("op") == c("solicitud"))

    def dollars(x):
        return dollar(num_text(x), nc)

    def dollars0(x):
        return dollars(nvl(x, 0))

    values = {
        "OP": c("op"),
        "FECHA": c("fecha"),
        "NUMEROCREDITO": c("numeroCredito"),
        "NOMBRE": display_name(
            c("sor_nombres"), c("NombreConcatenado"), c("Apellido1"), c("Apellido2"),
            c("Nombre1"), c("Nombre2"), nc,
        ),
        "TIPO CC/CE": c("tipoIdentificacion"),
        "CC/CE": c("numeroIdentificacion"),
        "PLAZOMESES": term_code(c("unidadTiempo"), c("Cuotas"), p.money_style, nc),
        "INTERES": c("Efectiva"),
        "VLRVEHICULOFACTURA": dollars(c("ValorVehiculoFactura")),
        "VLRFINANCIARVEHICULO": dollars(c("MontoaFinanciarSinSeguros")),
        "VLRSUBVENCION": dollars0(c("ValorSubvecionado")),
        "MANTENIMIENTO_PREPAGADO": dollar(
            money(nvl(c("iValorMantenimiento"), 0), p.money_style), nc
        ),
        "VLRACCESORIOS": dollars0(c("ValorAccesoriosFactura")),
        "VLRVIDA": dollars0(c("PrimaSegurodeVida")),
        "VLRPROTECCIONFINANCIERA": dollars(
            protection_value(c("PrimaSegurodeDesempleo"), c("ValorProteccionFinancieraM"))
        ),
        "VLRSEGUROVEHICULO": dollars0(c("PrimaSegurodeAutomovil")),
        "BONO POLIZA": nvl(c("BonoAstara"), 0),
        "VLR TR A FINANCIAR": nvl(c("valorPolizaTR"), 0),
        "GMF": dollars0(c("GMF")),
        "RGM": dollars(guarantee_fee(c("tipodeGarantia"), c("rgm_valor"))),
        "TOTALDESEMBOLSO": dollars(c("montoDesembolsar")),
        "FECHAPAGO": c("DiadePagoCuota"),
        "MARCA": F.coalesce("MarcaFactura", "sor_marca"),
        "LINEA": F.coalesce("LineaFactura", "sor_linea"),
        "MODELO": F.coalesce("ModeloFactura", "sor_modelo"),
        "FASECOLDA": F.coalesce("sor_fasecolda", "fas_fasecolda"),
        "PLACA": c("Placa"),
        "CHASIS": c("ChasisFactura"),
        "MOTOR": c("MotorFactura"),
        "MODALIDADPAGOSEGUROVIDA": c("Valor"),
        "MODALIDADPROTECCIONFINANCIERA": protection_mode(
            c("PrimaSegurodeDesempleo"), c("ValorProteccionFinancieraM")
        ),
        "CORTE DISPERSION": c("corte"),
    }
    out = distinct_rows(
        df.select("as_of", *[values[n].alias(n) for n in DISBURSEMENT_COLUMNS])
    )
    return _finish(out, p, with_as_of, p.disbursement_order if ordered else None)


def transfer_detail(
    t: Tables, cal: ReportCalendar, profile: Profile | str = "v1", with_as_of: bool = True,
    ordered: bool = True, month_col: str | None = None,
) -> DataFrame:
    """One row per distinct money transfer of the reported batches.

    Lookups and ranked children are joined once per request that was sent, and the result
    is attached to the sendings in one left join. Requests are found by a semi join on the
    distinct sent keys, so lookups never see a request's repeated sendings.
    """
    p = get_profile(profile)
    nc = p.null_concat
    c = F.col

    envios = t["desembolsorelacion"].filter(
        type_filter(c("IdDesembolsoDetalle"), p.transfer_types)
    )

    def gated(cols):
        return month_gate(
            envios.select(*cols, *_opt(month_col)), cal, "fechaenvio", guard=True,
            cutoff_op=p.cutoff_op, month_col=month_col,
        )

    sent = gated([f for f in envios.columns if f != month_col]).drop("fechaenvio", *_opt(month_col))
    banks = t["banco"].select(c("Id").alias("ban_id"), c("Nombre").alias("ban_nombre"))
    sent = lookup(sent, banks, "idBanco", "ban_id")  # J18

    keys = gated(["solicitud", "fechaenvio"]).select(c("solicitud").alias("key")).distinct()
    cases = _case_keys(t, "DatosFactura", "Seguros", "InformaciondeEstudio", "Operaciones")
    req = cases.join(keys, c("caso") == c("key"), "left_semi")
    ope = t["operaciones"].drop("MontoaFinanciarSinSeguros", "GMF", "DiadePago", "rgm")
    invoice = t["datosfactura"].select("idDatosFactura", "ValorAccesoriosFactura")
    study = t["informacionestudio"].select("idInformacionestudio", "ValorSubvecionado")
    insurance = t["seguros"].select("idSeguros", "BonoAstara", "bMantenimientoPrepagado")
    # Children hang on the invoice row, so a request without one has none.
    children = ranked_fold(
        t["informacionpm"], ["DatosFactura"], ["idInformacionPM"], "Operacionacancelar",
        "valorcruce", p.money_style, nc, first=["idInformacionPM", "Operacionacancelar"],
        out="ranked",
    )
    children = children.select(
        c("DatosFactura").alias("pm_factura"), c("idInformacionPM").alias("pm1_id"),
        c("Operacionacancelar").alias("pm1_op"), "ranked",
    )
    invoice = lookup(invoice, children, "idDatosFactura", "pm_factura", "left")

    req = lookup(req, ope, "ori_Operaciones", "idOperaciones", "left")
    # Folded here, so that one text travels on instead of six columns.
    fixed = fold_fixed(
        [c("OperacionCancelarPM"), c("OperacionaCancelarPM2"), c("OperacionaCancelarPM3")],
        [c("valorcruce1"), c("valorcruce2"), c("valorcruce3")],
        p.money_style, nc,
    )
    req = req.select(*cases.columns, "planmayor", fixed.alias("fixed"))
    req = lookup(req, study, "ori_InformaciondeEstudio", "idInformacionestudio", "left")
    req = lookup(req, insurance, "ori_Seguros", "idSeguros", "left")
    # The invoice rows are already laid out by their number, and a join on that alone could
    # not be split. The second key scatters requests without an invoice and gives the join
    # two shuffled sides, so that many requests on one invoice can be split as well.
    req = with_spread(req, "ori_DatosFactura", "caso")
    invoice = with_spread(invoice, "idDatosFactura").withColumnRenamed(SPREAD, "fac_spread")
    req = req.join(
        invoice,
        (c("ori_DatosFactura") == c("idDatosFactura")) & (c(SPREAD) == c("fac_spread")),
        "left",
    )
    req = req.select(
        "caso", "planmayor", "fixed", "ValorAccesoriosFactura", "ValorSubvecionado", "BonoAstara",
        "bMantenimientoPrepagado", "pm1_id", "pm1_op", "ranked",
    )

    df = sent.join(req, c("solicitud") == c("caso"), "left")  # J19
    prepaid = is_prepaid(c("bMantenimientoPrepagado"), c("IdDesembolsoDetalle"))
    values = {
        "SOLICITUD": c("solicitud"),
        "BENEFICIARIO": c("razonSocial"),
        "CC/NIT/CE": c("numeroIdentificacion"),
        "BANCO": c("ban_nombre"),
        "NUMEROCUENTA": account_number(
            c("planmayor"), c("IdDesembolsoDetalle"), c("pm1_id"), c("ranked"), c("fixed"),
            c("numeroCuenta"),
        ),
        "TIPOCUENTA": account_type(c("planmayor"), c("tipoCuenta")),
        "VLRGIRAR": transfer_value(
            c("montoDesembolsar"), c("ValorAccesoriosFactura"), prepaid, p.money_style, nc
        ),
        "CANAL GIRO": channel(c("planmayor"), c("pm1_op"), prepaid, p.prepaid_is_ach),
        "OBSERVACIONES": remarks(
            prepaid, c("ValorSubvecionado"), c("BonoAstara"), c("ValorAccesoriosFactura")
        ),
        "CORTE DISPERSION": c("corte"),
    }
    out = distinct_rows(df.select("as_of", *[values[n].alias(n) for n in TRANSFER_COLUMNS]))
    return _finish(out, p, with_as_of, p.transfer_order if ordered else None)


def _opt(name: str | None) -> list[str]:
    return [name] if name else []


def _lines_per_request(lines: DataFrame, sent: DataFrame, measure: str) -> DataFrame:
    """Disbursement rows of sent requests, counted: totals need no row-by-row join (Q8).

    The requests are taken from the very rows that ``measure`` was summed into: a test on it,
    which all of them pass, keeps it in the plan, so that both uses share one exchange and the
    sendings are read once.

    The semi join is on the key of the grouping, so one shuffle of the lines serves both, and
    lines of requests that were not sent are neither grouped nor moved on. A hot request's
    lines are counted before that shuffle only by a join that Spark broadcasts; else Spark
    splits the join.
    """
    asked = sent.where(F.col(measure).isNotNull())
    asked = asked.select(F.col("solicitud").alias("asked")).distinct()
    lines = lines.join(asked, F.col("Solicitud") == F.col("asked"), "left_semi")
    return lines.groupBy(F.col("Solicitud").alias("dsm_id")).agg(
        F.count("*").alias("dsm_n"), F.sum("montoDesembolsar").alias("dsm_monto")
    )


def disbursement_totals(
    t: Tables, cal: ReportCalendar, profile: Profile | str = "v1", with_as_of: bool = True,
    month_col: str | None = None,
) -> DataFrame:
    """Sums over every pairing of disbursement, sending and request.

    The pairings are not built. Both many-sides are counted per request before the join,
    with map-side combining, and each amount is multiplied by its number of pairings.
    """
    p = get_profile(profile)
    c = F.col
    envios = (
        t["desembolsorelacion"]
        .filter(type_filter(c("IdDesembolsoDetalle"), p.disbursement_types))
        .select("solicitud", "fechaenvio", *_opt(month_col))
    )
    sent = (
        month_gate(
            envios, cal, "fechaenvio", p.totals_lag_days, cutoff_op=p.cutoff_op,
            month_col=month_col,
        )
        .groupBy("as_of", "solicitud")
        .agg(F.count("*").alias("dre_n"))
    )
    df = _disbursement_amounts(t, sent, p)
    return _disbursement_row(
        totals_per_date(df, cal.frame, *_disbursement_sums()), p, with_as_of
    )


def _disbursement_amounts(t: Tables, sent: DataFrame, p: Profile) -> DataFrame:
    """`sent` (keys, solicitud, dre_n) with the amounts of each request and its line count."""
    c = F.col
    cases = _case_keys(t, "DatosFactura", "Seguros", "InformaciondeEstudio", "Operaciones")
    df = lookup(sent, cases, "solicitud", "caso")
    lines = _lines_per_request(t["desembolso"], sent, "dre_n")
    df = lookup(df, lines, "solicitud", "dsm_id")
    invoice = t["datosfactura"].select("idDatosFactura", "ValorAccesoriosFactura")
    study = t["informacionestudio"].select("idInformacionestudio", "ValorSubvecionado")
    ope = t["operaciones"].select("idOperaciones", "MontoaFinanciarSinSeguros")
    insurance = t["seguros"].select("idSeguros", "iValorMantenimiento", "BonoAstara")
    for table, case_column, key, how in (
        (invoice, "ori_DatosFactura", "idDatosFactura", "inner"),
        (study, "ori_InformaciondeEstudio", "idInformacionestudio", "inner"),
        (ope, "ori_Operaciones", "idOperaciones", "inner"),
        (insurance, "ori_Seguros", "idSeguros", p.totals_insurance_join),
    ):
        df = lookup(df, table, case_column, key, how)
    return df


def _disbursement_sums() -> tuple[dict[str, Column], dict[str, Column]]:
    """Guarded and unguarded sums over the rows of `_disbursement_amounts`."""
    c = F.col
    pairs = c("dre_n") * c("dsm_n")
    guarded = {
        "financed": weighted_sum(c("MontoaFinanciarSinSeguros"), pairs),
        "subsidy": weighted_sum(c("ValorSubvecionado"), pairs),
        "maintenance": weighted_sum(c("iValorMantenimiento"), pairs),
        "accessories": weighted_sum(c("ValorAccesoriosFactura"), pairs),
        "bonus": weighted_sum(c("BonoAstara"), pairs),
    }
    return guarded, {"total": weighted_sum(c("dsm_monto"), c("dre_n"), guard=False)}


def _disbursement_row(sums: DataFrame, p: Profile, with_as_of: bool) -> DataFrame:
    c = F.col
    out = sums.select(
        "as_of",
        dollar(num_text(c("financed"))).alias("VLRFINANCIARVEHICULO"),
        dollar(num_text(c("subsidy"))).alias("VLRSUBVENCION"),
        money_text(c("maintenance")).alias("MANTENIMIENTO_PREPAGADO"),
        dollar(num_text(c("accessories"))).alias("VLRACCESORIOS"),
        dollar(money_text(c("bonus"))).alias("BONO_POLIZA"),
        dollar(num_text(c("total")), p.null_concat).alias("TOTALDESEMBOLSO"),
    )
    layout = _layout(DISBURSEMENT_TOTALS, DISBURSEMENT_TOTALS_WIDTH)
    return _finish(positional(out, layout, DISBURSEMENT_TOTALS_LABEL, ""), p, with_as_of)


def transfer_totals(
    t: Tables, cal: ReportCalendar, profile: Profile | str = "v1", with_as_of: bool = True,
    month_col: str | None = None,
) -> DataFrame:
    """Sum of sent amounts, once per disbursement row of the same request."""
    p = get_profile(profile)
    c = F.col
    envios = (
        t["desembolsorelacion"]
        .filter(type_filter(c("IdDesembolsoDetalle"), p.transfer_total_types))
        .select("solicitud", "fechaenvio", "montoDesembolsar", *_opt(month_col))
    )
    sent = (
        month_gate(envios, cal, "fechaenvio", cutoff_op=p.cutoff_op, month_col=month_col)
        .groupBy("as_of", "solicitud")
        .agg(weighted_sum(F.abs(c("montoDesembolsar"))).alias("sent"))
    )
    df = _transfer_amounts(t, sent)
    return _transfer_row(totals_per_date(df, cal.frame, *_transfer_sums()), p, with_as_of)


def _transfer_amounts(t: Tables, sent: DataFrame) -> DataFrame:
    """`sent` (keys, solicitud, sent) with the line count of each request."""
    lines = _lines_per_request(t["desembolso"], sent, "sent")
    return lookup(sent, lines, "solicitud", "dsm_id")


def _transfer_sums() -> tuple[dict[str, Column], dict[str, Column]]:
    return {"total": weighted_sum(F.col("sent"), F.col("dsm_n"))}, {}


def _transfer_row(sums: DataFrame, p: Profile, with_as_of: bool) -> DataFrame:
    out = sums.select("as_of", dollar(num_text(F.col("total"))).alias("VLRGIRAR"))
    layout = _layout(TRANSFER_TOTALS, TRANSFER_TOTALS_WIDTH)
    return _finish(positional(out, layout, TRANSFER_TOTALS_LABEL, ""), p, with_as_of)


def start_date_report(
    dates: DataFrame, holidays: DataFrame, rule: str = "today", with_as_of: bool = True
) -> DataFrame:
    """R9 (rule "today"), R13 (rule "two_step")."""
    df = start_dates(dates, holidays, rule)
    return df if with_as_of else df.drop("as_of")


def end_date_report(
    dates: DataFrame, holidays: DataFrame, rule: str = "today", with_as_of: bool = True,
    pad: bool = False,
) -> DataFrame:
    """R10 (rule "today"), R14 (rule "two_step")."""
    df = end_dates(dates, holidays, rule, pad)
    return df if with_as_of else df.drop("as_of")
