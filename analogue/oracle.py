"""DuckDB SQL that states the expected results.

Written rule by rule with SQL text, joins and branches; it shares only the derivation of
the input relations with the Spark side.
"""

from __future__ import annotations

from analogue.relations import DATES, HOLIDAYS, LIVE, SQL, duck
from mesada.sources.schemas import text_columns


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def rel(*names: str, profile: str = "v1", empty_as_null: bool = True) -> str:
    """The input relations; '' is NULL in them unless said otherwise, and v2 reads live ones."""

    def one(name: str) -> str:
        text = duck(LIVE[name] if profile == "v2" and name in LIVE else SQL[name])
        columns = text_columns(name)
        if empty_as_null and columns:
            nulls = ", ".join(f"nullif({c}, '') AS {c}" for c in columns)
            text = f"SELECT * REPLACE ({nulls}) FROM ({text}) q"
        return f"{name} AS ({text})"

    return ",\n".join(map(one, names))


def dates(sql: str = DATES) -> str:
    return f"dates AS (SELECT DISTINCT as_of FROM ({duck(sql)}) q)"


HOL = f"diasfestivos AS ({HOLIDAYS})"


# -- text ---------------------------------------------------------------------------------


def num(x: str) -> str:
    s = f"CAST({x} AS VARCHAR)"
    s = f"regexp_replace({s}, '(\\.[0-9]*?)0+$', '\\1')"
    s = f"regexp_replace({s}, '\\.$', '')"
    return f"regexp_replace({s}, '^(-?)0\\.', '\\1.')"


def money(x: str) -> str:
    return f"replace(CAST(CAST(round(coalesce({x}, 0), 2) AS DECIMAL(38,2)) AS VARCHAR), '.', ',')"


def grouped(x: str) -> str:
    return f"format('{{:,}}', CAST(round({x}, 0) AS BIGINT))"


def pad3(x: str) -> str:
    return f"lpad(CAST(CAST(trunc(coalesce({x}, 0)) AS BIGINT) AS VARCHAR), 3, '0')"


def months3(x: str) -> str:
    return f"CASE WHEN abs({x}) >= 1000 THEN '###' ELSE lpad(CAST({x} AS VARCHAR), 3, '0') END"


def ymd(d: str) -> str:
    return f"strftime({d}, '%y%m%d')"


def label(ts: str) -> str:
    h = f"hour({ts})"
    return (
        f"CASE WHEN {h} IN (7, 8, 9) THEN {ymd(ts)} || '.0900' "
        f"WHEN {h} IN (11, 12, 13) THEN {ymd(ts)} || '.1300' "
        f"WHEN {h} IN (14, 15) THEN {ymd(ts)} || '.1500' END"
    )


# -- calendar -----------------------------------------------------------------------------

PREV = "CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE)"
CURR = "CAST(date_trunc('month', as_of) AS DATE)"
PREV_END = "CAST(date_trunc('month', as_of) AS DATE) - 1"
PREV2_END = "CAST(date_trunc('month', as_of) - INTERVAL 1 MONTH AS DATE) - 1"


def _is_hol(a: str, n: int, rule: str) -> str:
    base = a if rule == "anchor" else "as_of"
    return f"({a} + ({n}) = {base} + ({n}) AND {base} + ({n}) IN (SELECT fecha FROM diasfestivos))"


def first_day(a: str, rule: str) -> str:
    h = f"{a} IN (SELECT fecha FROM diasfestivos)"
    return (
        f"CASE isodow({a}) "
        f"WHEN 6 THEN {a} + CASE WHEN {_is_hol(a, 2, rule)} THEN 3 ELSE 2 END "
        f"WHEN 7 THEN {a} + CASE WHEN {_is_hol(a, 1, rule)} THEN 2 ELSE 1 END "
        f"WHEN 5 THEN {a} + CASE WHEN {h} THEN 3 ELSE 0 END "
        f"ELSE {a} + CASE WHEN {h} THEN 1 ELSE 0 END END"
    )


def last_day(a: str, rule: str) -> str:
    h = f"{a} IN (SELECT fecha FROM diasfestivos)"
    return (
        f"CASE isodow({a}) "
        f"WHEN 6 THEN {a} - CASE WHEN {_is_hol(a, -1, rule)} THEN 2 ELSE 1 END "
        f"WHEN 7 THEN {a} - CASE WHEN {_is_hol(a, -2, rule)} THEN 3 ELSE 2 END "
        f"WHEN 1 THEN {a} - CASE WHEN {h} THEN 3 ELSE 0 END "
        f"ELSE {a} - CASE WHEN {h} THEN 1 ELSE 0 END END"
    )


def calendar(rule: str) -> str:
    """CTEs anchors and cal over `dates` and `diasfestivos`."""
    return f"""anchors AS (SELECT as_of, {PREV} AS ini, {CURR} AS fin FROM dates),
cal AS (SELECT as_of, dayofweek(as_of) + 1 AS dow_hoy, ini, fin,
  {first_day("ini", rule)} AS habil, {first_day("fin", rule)} AS abre FROM anchors)"""


def gate(lag: int = 0, guard: bool = False) -> str:
    """CTE `abiertos`: open dates with the reported month and the first batch label."""
    extra = " AND dow_hoy NOT IN (1, 7)" if guard else ""
    return f"""abiertos AS (SELECT as_of, strftime(abre - INTERVAL 1 MONTH, '%Y%m') AS mes,
  {ymd("habil")} || '.0900' AS base FROM cal WHERE as_of - {lag} = abre{extra})"""


def sent(op: str, types: tuple[int, ...] | None = None) -> str:
    """CTE `envio`: sendings of the reported months and batches."""
    kinds = f"WHERE IdDesembolsoDetalle IN ({', '.join(map(str, types))})" if types else ""
    return f"""envio AS (SELECT x.*, a.as_of FROM
  (SELECT *, strftime(fechaenvio, '%Y%m') AS mes, {label("fechaenvio")} AS corte
   FROM desembolsorelacion {kinds}) x
  JOIN abiertos a ON a.mes = x.mes AND x.corte {op} a.base)"""


# -- ranked children ----------------------------------------------------------------------


def folded(style: str = "plain") -> str:
    """CTEs `hijos` and `plegado`: one text per invoice from its first ten children."""
    amount = money("abs(coalesce(v, 0))") if style == "plain" else grouped("abs(coalesce(v, 0))")
    zero = "0,00" if style == "plain" else "0"
    # The first amount is only empty when the value is NULL and the style has no default.
    first = f"CASE WHEN v IS NULL AND op2 IS NOT NULL THEN '' ELSE {amount} END"
    first = amount if style == "plain" else first
    return f"""hijos AS (SELECT DatosFactura AS k, Operacionacancelar AS op, valorcruce AS v,
  row_number() OVER w AS rk, lead(Operacionacancelar) OVER w AS op2
  FROM informacionpm WHERE DatosFactura IS NOT NULL
  WINDOW w AS (PARTITION BY DatosFactura ORDER BY idInformacionPM)),
textos AS (SELECT k, rk, op,
  CASE WHEN rk = 1 THEN concat(op, ' - $', {first}, CASE WHEN op2 IS NULL THEN '  ' ELSE ' // ' END)
       ELSE concat(op, CASE WHEN {amount} = '{zero}' THEN '' ELSE ' - $' || {amount} END,
                   CASE WHEN rk < 10 AND op2 IS NOT NULL THEN '//' ELSE '' END) END AS t
  FROM hijos WHERE rk <= 10),
plegado AS (SELECT k, string_agg(t, '' ORDER BY rk) AS ranked,
  max(CASE WHEN rk = 1 THEN op END) AS op1, max(rk) AS n FROM textos GROUP BY k)"""


# -- reports ------------------------------------------------------------------------------


def _plain_d(x: str) -> str:
    return f"concat('$', {num(x)})"


def _older_d(x: str) -> str:
    return f"('$' || {num(x)})"


def _d0(x: str) -> str:
    return _plain_d(f"coalesce({x}, 0)")


def disbursement_detail(profile: str, days: str = DATES, older: bool = False) -> str:
    """`older`: '' stays, and a NULL part makes a whole text NULL."""
    _d = _older_d if older else _plain_d
    second = "coalesce(cl.Apellido2, '')", "coalesce(cl.Nombre2, '')"
    parts = "cl.Apellido1", "' '", second[0], "', '", "cl.Nombre1", "' '", second[1]
    name = " || ".join(parts) if older else f"concat({', '.join(parts)})"
    none = " ELSE ''" if older else ""
    op = ">" if profile == "v2" else "="
    rule = "anchor" if profile == "draft" else "today"
    if profile == "draft":
        maint = f"'$' || {grouped('coalesce(g.iValorMantenimiento, 0)')}"
        term = f"concat({_unit()}, {months3('pl.Cuotas')})"
    else:
        maint = f"'$' || {money('g.iValorMantenimiento')}"
        term = f"{_unit()} || {pad3('pl.Cuotas')}"
    names = (
        "desembolso", "desembolsorelacion", "originacion_solicitudes", "originacion",
        "datosfactura", "seguros", "informacionestudio", "operaciones", "planfinanciacion",
        "tasas_ek", "tasas", "diadepago", "modalidadpagosegurovida", "cliente", "vehiculo",
        "fasecolda_ref3_ek", "fasecolda_ref3", "registrogarantiamobiliar",
    )
    # Output columns, key pairs and branch texts of the report.
    return (
        ctes(rel(*names, profile=profile, empty_as_null=not older), HOL, dates(days),
             calendar(rule), gate(guard=True), sent(op))
        + f"""SELECT DISTINCT strftime(e.as_of, '%Y-%m-%d') AS as_of, d.Solicitud AS "OP",
  strftime(e.fechaenvio, '%d/%m/%Y') AS "FECHA", d.numeroCredito AS "NUMEROCREDITO",
  coalesce(s.Nombres, replace(substr(cl.NombreConcatenado, 1, 100), 'Cliente : ', ''),
    upper({name})) AS "NOMBRE",
  d.tipoIdentificacion AS "TIPO CC/CE", d.numeroIdentificacion AS "CC/CE",
  {term} AS "PLAZOMESES", CAST(ta.Efectiva AS DOUBLE) AS "INTERES",
  {_d("f.ValorVehiculoFactura")} AS "VLRVEHICULOFACTURA",
  {_d("o.MontoaFinanciarSinSeguros")} AS "VLRFINANCIARVEHICULO",
  {_d0("i.ValorSubvecionado")} AS "VLRSUBVENCION", {maint} AS "MANTENIMIENTO_PREPAGADO",
  {_d0("f.ValorAccesoriosFactura")} AS "VLRACCESORIOS", {_d0("g.PrimaSegurodeVida")} AS "VLRVIDA",
  {_d0("coalesce(g.PrimaSegurodeDesempleo, g.ValorProteccionFinancieraM)")}
    AS "VLRPROTECCIONFINANCIERA",
  {_d0("g.PrimaSegurodeAutomovil")} AS "VLRSEGUROVEHICULO",
  CAST(coalesce(g.BonoAstara, 0) AS DOUBLE) AS "BONO POLIZA",
  CAST(coalesce(g.valorPolizaTR, 0) AS DOUBLE) AS "VLR TR A FINANCIAR", {_d0("o.GMF")} AS "GMF",
  CASE WHEN i.tipodeGarantia = 2 THEN '$0' ELSE {_d0("r.RGM")} END AS "RGM",
  {_d("d.montoDesembolsar")} AS "TOTALDESEMBOLSO", dp.DiadePagoCuota AS "FECHAPAGO",
  coalesce(f.MarcaFactura, s.Marca) AS "MARCA", coalesce(f.LineaFactura, s.LineaVeh) AS "LINEA",
  coalesce(f.ModeloFactura, s.Modelo) AS "MODELO", coalesce(s.fasecolda, fr.fasecolda) AS "FASECOLDA",
  f.Placa AS "PLACA", f.ChasisFactura AS "CHASIS", f.MotorFactura AS "MOTOR",
  m.Valor AS "MODALIDADPAGOSEGUROVIDA",
  CASE WHEN g.PrimaSegurodeDesempleo > 0 THEN 'Anual' WHEN g.ValorProteccionFinancieraM > 0
    THEN 'Mensual'{none} END AS "MODALIDADPROTECCIONFINANCIERA", e.corte AS "CORTE DISPERSION"
FROM envio e JOIN desembolso d ON d.Solicitud = e.solicitud AND d.IdDesembolsodetalle = 1
JOIN originacion og ON og.caso = e.solicitud
LEFT JOIN originacion_solicitudes s ON s.solicitud = e.solicitud
JOIN datosfactura f ON f.idDatosFactura = og.DatosFactura
JOIN seguros g ON g.idSeguros = og.Seguros
JOIN informacionestudio i ON i.idInformacionestudio = og.InformaciondeEstudio
JOIN operaciones o ON o.idOperaciones = og.Operaciones
JOIN planfinanciacion pl ON pl.idPlanFinanciacion = og.PlanFinanciacion
JOIN tasas_ek te ON te.idTasas = i.Tasa JOIN tasas ta ON ta.id1 = te.id1
LEFT JOIN diadepago dp ON dp.idDiadePago = o.DiadePago
LEFT JOIN modalidadpagosegurovida m ON m.idModalidadPagoSegurovida = g.ModalidadPagoseguroVida
LEFT JOIN cliente cl ON cl.idCliente = og.Cliente
LEFT JOIN vehiculo ve ON ve.idVehiculo = og.Vehiculo
LEFT JOIN fasecolda_ref3_ek fe ON fe.idFASECOLDA_REF3 = ve.FASECOLDA
LEFT JOIN fasecolda_ref3 fr ON fr.id1 = fe.id1
LEFT JOIN registrogarantiamobiliar r ON r.idRegistroGarantiaMobiliar = o.rgm"""
    )


def _unit() -> str:
    return (
        "CASE WHEN pl.unidadTiempo = 'M' THEN '2' WHEN pl.unidadTiempo = 'A' THEN '3' ELSE '0' END"
    )


def transfer_detail(profile: str, days: str = DATES) -> str:
    op = ">" if profile == "v2" else "="
    rule = "anchor" if profile == "draft" else "today"
    style = "grouped" if profile == "draft" else "plain"
    txt = grouped if profile == "draft" else money
    types = (1, 6, 7) if profile == "v2" else (1, 2, 6, 7)
    prepaid = "coalesce(g.bMantenimientoPrepagado, 0) = 1 AND e.IdDesembolsoDetalle = 6"
    ach = f"WHEN {prepaid} THEN 'GIRO ACH' " if profile == "v2" else ""

    def fixed(n: int, col: str) -> str:
        return f"concat(o.{col}, ' - $', {txt(f'abs(o.valorcruce{n})')})"

    one = fixed(1, "OperacionCancelarPM")
    two = fixed(2, "OperacionaCancelarPM2")
    three = fixed(3, "OperacionaCancelarPM3")
    bono = f"concat('DESCUENTO BONO POLIZA $', {num('abs(g.BonoAstara)')})"
    names = (
        "desembolsorelacion", "originacion", "datosfactura", "seguros", "informacionestudio",
        "operaciones", "informacionpm", "banco",
    )
    # Output columns, key pairs and branch texts of the report.
    return (
        ctes(rel(*names, profile=profile), HOL, dates(days), calendar(rule), gate(guard=True),
             sent(op, types), folded(style))
        + f"""SELECT DISTINCT strftime(e.as_of, '%Y-%m-%d') AS as_of, e.solicitud AS "SOLICITUD",
  e.razonSocial AS "BENEFICIARIO", e.numeroIdentificacion AS "CC/NIT/CE", b.Nombre AS "BANCO",
  CASE WHEN o.planmayor = 1 AND pm.n IS NOT NULL THEN pm.ranked
       WHEN o.planmayor = 1 AND e.IdDesembolsoDetalle = 1 THEN concat({one},
         CASE WHEN o.OperacionaCancelarPM2 IS NOT NULL THEN concat(' // ', {two},
           CASE WHEN o.OperacionaCancelarPM3 IS NOT NULL THEN concat(' // ', {three}) END) END)
       ELSE e.numeroCuenta END AS "NUMEROCUENTA",
  CASE WHEN o.planmayor = 1 THEN NULL ELSE e.tipoCuenta END AS "TIPOCUENTA",
  concat('$', {txt(f"abs(e.montoDesembolsar + CASE WHEN {prepaid} THEN 0 ELSE coalesce(f.ValorAccesoriosFactura, 0) END)")}) AS "VLRGIRAR",
  CASE {ach}WHEN o.planmayor = 1 AND (starts_with(pm.op1, '81') OR starts_with(pm.op1, '75'))
         THEN 'PAGO ALTAIR'
       WHEN o.planmayor = 1 AND starts_with(pm.op1, '98') THEN 'PAGO BOT'
       ELSE 'GIRO ACH' END AS "CANAL GIRO",
  CASE WHEN {prepaid} THEN 'MANTENIMIENTO PREPAGADO'
       WHEN i.ValorSubvecionado > 0 AND g.BonoAstara > 0 THEN concat(
         CASE WHEN f.ValorAccesoriosFactura > 0 THEN 'CON ACCESORIOS ' END, 'SUBVENCIONADO-', {bono})
       WHEN i.ValorSubvecionado > 0 THEN 'SUBVENCIONADO'
       WHEN g.BonoAstara > 0 THEN {bono}
       WHEN f.ValorAccesoriosFactura > 0 THEN 'ACCESORIOS' END AS "OBSERVACIONES",
  e.corte AS "CORTE DISPERSION"
FROM envio e JOIN banco b ON b.Id = e.idBanco
LEFT JOIN originacion og ON og.caso = e.solicitud
LEFT JOIN operaciones o ON o.idOperaciones = og.Operaciones
LEFT JOIN datosfactura f ON f.idDatosFactura = og.DatosFactura
LEFT JOIN informacionestudio i ON i.idInformacionestudio = og.InformaciondeEstudio
LEFT JOIN seguros g ON g.idSeguros = og.Seguros
LEFT JOIN plegado pm ON pm.k = f.idDatosFactura"""
    )


def disbursement_totals(profile: str, days: str = DATES, older: bool = False) -> str:
    _d = _older_d if older else _plain_d
    blank = "''" if older else "CAST(NULL AS VARCHAR)"
    op, lag, how = (">", 0, "JOIN") if profile == "v2" else ("=", 17, "LEFT JOIN")
    names = (
        "desembolso", "desembolsorelacion", "originacion", "datosfactura", "seguros",
        "informacionestudio", "operaciones",
    )
    slots = {
        10: (_d("coalesce(t.a, 0)"), "VLRFINANCIARVEHICULO"),
        11: (_d("coalesce(t.b, 0)"), "VLRSUBVENCION"),
        12: (money("t.c"), "MANTENIMIENTO_PREPAGADO"),
        13: (_d("coalesce(t.d, 0)"), "VLRACCESORIOS"),
        17: (f"concat('$', {money('t.e')})", "BONO_POLIZA"),
        20: (_d("t.f"), "TOTALDESEMBOLSO"),
    }
    cols = ["'Totales' AS c01"]
    for i in range(2, 32):
        expr, name = slots.get(i, (blank, f"c{i:02d}"))
        cols.append(f"{expr} AS {name}")
    return (
        ctes(rel(*names, empty_as_null=not older), HOL, dates(days), calendar("today"),
             gate(lag), sent(op, (1,)),
             f"""t AS (SELECT e.as_of, sum(o.MontoaFinanciarSinSeguros) AS a,
  sum(i.ValorSubvecionado) AS b, sum(g.iValorMantenimiento) AS c,
  sum(f.ValorAccesoriosFactura) AS d, sum(g.BonoAstara) AS e, sum(d.montoDesembolsar) AS f
FROM desembolso d JOIN envio e ON e.solicitud = d.Solicitud
JOIN originacion og ON og.caso = d.Solicitud
JOIN datosfactura f ON f.idDatosFactura = og.DatosFactura
JOIN informacionestudio i ON i.idInformacionestudio = og.InformaciondeEstudio
JOIN operaciones o ON o.idOperaciones = og.Operaciones
{how} seguros g ON g.idSeguros = og.Seguros GROUP BY e.as_of)""")
        + "SELECT strftime(q.as_of, '%Y-%m-%d') AS as_of, " + ",\n  ".join(cols)
        + "\nFROM dates q LEFT JOIN t ON t.as_of = q.as_of"
    )


def transfer_totals(profile: str, days: str = DATES) -> str:
    op = ">" if profile == "v2" else "="
    blanks = ", ".join(f"CAST(NULL AS VARCHAR) AS c{i:02d}" for i in range(2, 7))
    return (
        ctes(rel("desembolso", "desembolsorelacion"), HOL, dates(days), calendar("today"), gate(),
             sent(op, (1, 2, 6, 7)),
             """t AS (SELECT e.as_of, sum(abs(e.montoDesembolsar)) AS v
FROM desembolso d JOIN envio e ON e.solicitud = d.Solicitud GROUP BY e.as_of)""")
        + f"""SELECT strftime(q.as_of, '%Y-%m-%d') AS as_of, 'TOTAL' AS c01, {blanks},
  {_d0("t.v")} AS "VLRGIRAR" FROM dates q LEFT JOIN t ON t.as_of = q.as_of"""
    )
