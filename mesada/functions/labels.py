"""Business columns of the detail reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from mesada.functions.text import concat_text, cut, dollar, money, num_text, nvl, without

# Fixed values used in the output.
CLIENT_PREFIX = "Cliente : "
ANNUAL, MONTHLY = "Anual", "Mensual"
CHANNEL_PREFIXES = (("81", "PAGO ALTAIR"), ("98", "PAGO BOT"), ("75", "PAGO ALTAIR"))
DEFAULT_CHANNEL = "GIRO ACH"
PREPAID = "Mantenimiento Prepagado"
SUBSIDISED = "Subvencionado"
BONUS = "Descuento Bono poliza $"
ACCESSORIES = "Accesorios"
WITH_ACCESSORIES = "Con Accesorios "
PREPAID_TYPE = 6
GUARANTEE_WITHOUT_FEE = 2


def display_name(
    request_name: Column,
    client_name: Column,
    last1: Column,
    last2: Column,
    first1: Column,
    first2: Column,
    null_concat: bool = False,
) -> Column:
    """B2: name on the request, else the client's full name, else its parts in capitals."""
    space = F.lit(" ")
    parts = concat_text(
        last1, space, nvl(last2, ""), F.lit(", "), first1, space, nvl(first2, ""),
        null_concat=null_concat,
    )
    return F.coalesce(request_name, without(cut(client_name, 100), CLIENT_PREFIX), F.upper(parts))


def positive(x: Column) -> Column:
    """Greater than zero, NULL counts as zero."""
    return nvl(x, 0) > 0


def protection_value(unemployment: Column, protection: Column) -> Column:
    """B6."""
    return F.coalesce(unemployment, protection, F.lit(0))


def protection_mode(unemployment: Column, protection: Column) -> Column:
    """B7."""
    return F.when(unemployment > 0, ANNUAL).when(protection > 0, MONTHLY).otherwise("")


def guarantee_fee(guarantee_type: Column, fee: Column) -> Column:
    """B8."""
    return F.when(guarantee_type == GUARANTEE_WITHOUT_FEE, F.lit(0)).otherwise(nvl(fee, 0))


def is_prepaid(prepaid_flag: Column, detail_type: Column) -> Column:
    return (prepaid_flag == 1) & (detail_type == PREPAID_TYPE)


def account_type(plan: Column, account: Column) -> Column:
    """B14."""
    return F.when(plan == 1, "").otherwise(account)


def transfer_value(
    amount: Column, accessories: Column, prepaid: Column, style: str, null_concat: bool = False
) -> Column:
    """Accessories are added unless the row is prepaid maintenance."""
    value = F.when(prepaid, F.abs(amount)).otherwise(F.abs(amount + nvl(accessories, 0)))
    return dollar(money(value, style), null_concat)


def channel(plan: Column, first_op: Column, prepaid: Column, prepaid_is_ach: bool) -> Column:
    """Payment channel from the first child's operation prefix."""
    out = F.when(prepaid, DEFAULT_CHANNEL) if prepaid_is_ach else F
    for prefix, name in CHANNEL_PREFIXES:
        out = out.when((plan == 1) & first_op.startswith(prefix), name)
    return out.otherwise(DEFAULT_CHANNEL)


def remarks(prepaid: Column, subsidy: Column, bonus: Column, accessories: Column) -> Column:
    """Upper-case remark: prepaid alone, else the parts that apply.

    Accessories are named before subsidy with bonus, or alone, but not next to one of them.
    """
    subsidised, has_bonus, has_accessories = map(positive, (subsidy, bonus, accessories))
    parts = concat_text(
        F.when(subsidised & has_bonus & has_accessories, WITH_ACCESSORIES),
        F.when(subsidised, SUBSIDISED),
        F.when(subsidised & has_bonus, "-"),
        F.when(has_bonus, concat_text(F.lit(BONUS), num_text(F.abs(nvl(bonus, 0))))),
        F.when(~subsidised & ~has_bonus & has_accessories, ACCESSORIES),
    )
    return F.upper(F.when(prepaid, PREPAID).otherwise(parts))
