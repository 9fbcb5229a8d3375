"""What a table looks like and which limits apply to it.

Nothing in the operators knows a column name: they ask a ``TableProfile`` for
the role a column plays.  ``MEDICAL`` and ``PHARMACY`` are ready-made profiles
for the two claim-event tables.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

# Names, allow-lists and limits that results depend on.
PROCEDURE_CODE_TYPES = ("CPT", "HCPCS", "ICD-10-PCS", "ICD-9-PCS", "NDC", "LOINC", "OTHER")
UNIT_TYPES = ("ML", "UN", "GR", "F2", "ME", "Other")


@dataclass(frozen=True)
class Thresholds:
    """Limits used by the checks; every comparison states if it is inclusive."""

    null_percent: float = 5.0            # warn above
    extreme_quantity: float = 9999       # warn above
    old_year: int = 1900                 # warn below
    code_length: int = 11                # drug code without hyphens
    id_length: int = 10                  # provider id, digits only
    record_change: float = 0.5           # pass up to and including
    count_change: float = 0.3            # pass up to and including
    death_grace_days: int = 60           # fail after
    overlap_percent: float = 50.0        # warn below
    new_percent: float = 50.0            # warn above
    retention_percent: float = 50.0      # warn below
    code_shift_percent: float = 50.0     # reported above
    code_shift_minimum: int = 10         # current entities needed
    cohort_shift_percent: float = 20.0   # reported from, inclusive
    cohort_list_warn: int = 2            # warn above, variant only
    age_group_percent: float = 5.0       # warn below
    age_unknown_percent: float = 10.0    # warn above
    top_region_percent: float = 50.0     # warn above
    top_provider_percent: float = 20.0   # warn above
    top_cohort_percent: float = 50.0     # warn above
    top_shares: int = 10                 # rows of a share report
    top_ids: int = 100                   # rows of an id report


@dataclass(frozen=True)
class TableProfile:
    """Roles of the columns of one event table.

    ``quantities`` maps a numeric column to ``(check prefix, metric stem)``;
    ``allowed`` maps a column to ``(check, metric, values)``.
    ``roles`` are the volume roles: role name to column.
    """

    name: str
    event_id: str
    entity: str
    event_date: str
    refresh_date: str
    required: tuple[str, ...]
    optional: tuple[str, ...]
    duplicate_key: tuple[str, ...]
    id_columns: tuple[str, ...]
    roles: Mapping[str, str]
    end_date: str | None = None
    written_date: str | None = None
    code_with_type: tuple[str, str] | None = None
    drug_code: str | None = None
    quantities: Mapping[str, tuple[str, str]] = field(default_factory=dict)
    capped: tuple[str, ...] = ()
    allowed: Mapping[str, tuple[str, str, tuple[str, ...]]] = field(default_factory=dict)
    cohort_label: str | None = None


@dataclass(frozen=True)
class DimensionColumns:
    """Column names of the snapshot dimensions."""

    entity: str = "patient_id"
    refresh_date: str = "kh_refresh_date"
    gender: str = "patient_gender"
    birth: str = "patient_yob"
    enroll_start: str = "start_date"
    enroll_end: str = "end_date"
    region: str = "patient_state"
    region_from: str = "valid_from_date"
    region_to: str = "valid_to_date"
    death_date: str = "patient_death_date"
    provider: str = "npi"


MEDICAL = TableProfile(
    name="mx_events",
    event_id="medical_event_id",
    entity="patient_id",
    event_date="service_date",
    end_date="service_to_date",
    refresh_date="kh_refresh_date",
    required=("medical_event_id", "patient_id", "service_date", "procedure_code", "billing_npi"),
    optional=("service_to_date", "units", "unit_type", "rendering_npi", "referring_npi", "ndc11"),
    duplicate_key=("patient_id", "service_date", "procedure_code"),
    id_columns=("billing_npi", "rendering_npi", "referring_npi"),
    roles={
        "code": "procedure_code",
        "provider": "rendering_npi",
        "organization": "billing_npi",
        "payer": "kh_plan_id",
        "cohort": "cohort_id",
    },
    code_with_type=("procedure_code", "procedure_code_type"),
    drug_code="ndc11",
    quantities={"units": ("units", "units")},
    capped=("units",),
    allowed={
        "procedure_code_type": (
            "procedure_code_type", "invalid_proc_type_percent", PROCEDURE_CODE_TYPES),
        "unit_type": ("unit_type", "invalid_unit_type_percent", UNIT_TYPES),
    },
    cohort_label="mx_cohort",
)

PHARMACY = TableProfile(
    name="rx_events",
    event_id="pharmacy_event_id",
    entity="patient_id",
    event_date="fill_date",
    written_date="date_prescription_written",
    refresh_date="kh_refresh_date",
    required=("pharmacy_event_id", "patient_id", "fill_date", "diagnosis_code", "pharmacy_npi"),
    optional=(
        "ndc11", "days_supply", "quantity", "prescriber_npi", "brand_name", "generic_name",
        "route", "transaction_result", "reject_codes", "transaction_number",
        "transaction_status", "fill_number", "number_of_refills_authorized", "daw_code",
        "date_prescription_written", "primary_kh_plan_id", "secondary_kh_plan_id",
        "patient_responsibility", "patient_oop",
    ),
    duplicate_key=("patient_id", "fill_date", "ndc11"),
    id_columns=("pharmacy_npi", "prescriber_npi"),
    roles={
        "code": "ndc11",
        "provider": "prescriber_npi",
        "organization": "pharmacy_npi",
        "cohort": "cohort_id",
    },
    drug_code="ndc11",
    quantities={"quantity": ("quantity", "quantity"), "days_supply": ("days_supply", "days")},
    capped=("quantity",),
    cohort_label="rx_cohort",
)
