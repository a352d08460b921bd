"""The three rule sets. Every difference between report versions is a field here."""

from __future__ import annotations

from dataclasses import dataclass, field

# Detail types that count as a transfer.
TRANSFER_TYPES = (1, 2, 6, 7)
# Fixed value: detail type of a disbursement.
DISBURSEMENT_TYPES = (1,)


@dataclass(frozen=True)
class Profile:
    name: str
    # Batch comparison against the first business day's 09:00 label.
    cutoff_op: str = "="
    # Detail types of the transfer detail; the transfer totals keep all four.
    transfer_types: tuple[int, ...] = TRANSFER_TYPES
    transfer_total_types: tuple[int, ...] = TRANSFER_TYPES
    disbursement_types: tuple[int, ...] = DISBURSEMENT_TYPES
    # Days subtracted from as_of in the gate of the disbursement totals (L2, Q6).
    totals_lag_days: int = 0
    # Join of the insurance row in the disbursement totals.
    totals_insurance_join: str = "inner"
    # Column ordinals the details are sorted by (O1, Q10).
    disbursement_order: int = 32
    transfer_order: int = 10
    # Prepaid maintenance of type 6 goes out as ACH before any prefix test.
    prepaid_is_ach: bool = False
    # Holiday test of the business-day rule: "today" (Q2) or "anchor" (C6).
    holiday_rule: str = "today"
    # Money text: "plain" = two decimals with a comma (F17), "grouped" = whole units.
    money_style: str = "plain"
    # Report '' as NULL. False keeps the empty string.
    empty_as_null: bool = True
    # NULL parts count as empty. True lets a NULL part make the whole text NULL.
    null_concat: bool = False
    # S3: relations read from another source than the snapshot.
    sources: dict[str, str] = field(default_factory=dict, hash=False)


V1 = Profile(
    name="v1",
    totals_lag_days=17,
    totals_insurance_join="left",
    disbursement_order=29,
)

V2 = Profile(
    name="v2",
    cutoff_op=">",
    transfer_types=(1, 6, 7),
    prepaid_is_ach=True,
    sources={"informacionpm": "live"},
)

DRAFT = Profile(
    name="draft",
    disbursement_order=29,
    holiday_rule="anchor",
    money_style="grouped",
)

PROFILES = {p.name: p for p in (V1, V2, DRAFT)}


def get_profile(profile: Profile | str) -> Profile:
    return profile if isinstance(profile, Profile) else PROFILES[profile]
