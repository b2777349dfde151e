"""OMOP CDM v5.4 tables written here: column order is contractual, types follow from the names."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = T.DecimalType(38, 10)

# Column order of the CDM tables.
CDM_COLUMNS: dict[str, str] = {
    "person": "person_id gender_concept_id year_of_birth month_of_birth day_of_birth birth_datetime "
    "race_concept_id ethnicity_concept_id location_id provider_id care_site_id person_source_value "
    "gender_source_value gender_source_concept_id race_source_value race_source_concept_id "
    "ethnicity_source_value ethnicity_source_concept_id",
    "location": "location_id address_1 address_2 city state zip county location_source_value "
    "country_concept_id country_source_value latitude longitude",
    "care_site": "care_site_id care_site_name place_of_service_concept_id location_id "
    "care_site_source_value place_of_service_source_value",
    "provider": "provider_id provider_name npi dea specialty_concept_id care_site_id year_of_birth "
    "gender_concept_id provider_source_value specialty_source_value specialty_source_concept_id "
    "gender_source_value gender_source_concept_id",
    "visit_occurrence": "visit_occurrence_id person_id visit_concept_id visit_start_date visit_start_datetime "
    "visit_end_date visit_end_datetime visit_type_concept_id provider_id care_site_id visit_source_value "
    "visit_source_concept_id admitted_from_concept_id admitted_from_source_value discharged_to_concept_id "
    "discharged_to_source_value preceding_visit_occurrence_id",
    "visit_detail": "visit_detail_id person_id visit_detail_concept_id visit_detail_start_date "
    "visit_detail_start_datetime visit_detail_end_date visit_detail_end_datetime visit_detail_type_concept_id "
    "provider_id care_site_id visit_detail_source_value visit_detail_source_concept_id admitted_from_concept_id "
    "admitted_from_source_value discharged_to_source_value discharged_to_concept_id preceding_visit_detail_id "
    "parent_visit_detail_id visit_occurrence_id",
    "condition_occurrence": "condition_occurrence_id person_id condition_concept_id condition_start_date "
    "condition_start_datetime condition_end_date condition_end_datetime condition_type_concept_id "
    "condition_status_concept_id stop_reason provider_id visit_occurrence_id visit_detail_id "
    "condition_source_value condition_source_concept_id condition_status_source_value",
    "procedure_occurrence": "procedure_occurrence_id person_id procedure_concept_id procedure_date "
    "procedure_datetime procedure_end_date procedure_end_datetime procedure_type_concept_id "
    "modifier_concept_id quantity provider_id visit_occurrence_id visit_detail_id procedure_source_value "
    "procedure_source_concept_id modifier_source_value",
    "measurement": "measurement_id person_id measurement_concept_id measurement_date measurement_datetime "
    "measurement_time measurement_type_concept_id operator_concept_id value_as_number value_as_concept_id "
    "unit_concept_id range_low range_high provider_id visit_occurrence_id visit_detail_id "
    "measurement_source_value measurement_source_concept_id unit_source_value unit_source_concept_id "
    "value_source_value measurement_event_id meas_event_field_concept_id",
    "observation": "observation_id person_id observation_concept_id observation_date observation_datetime "
    "observation_type_concept_id value_as_number value_as_string value_as_concept_id qualifier_concept_id "
    "unit_concept_id provider_id visit_occurrence_id visit_detail_id observation_source_value "
    "observation_source_concept_id unit_source_value qualifier_source_value value_source_value "
    "observation_event_id obs_event_field_concept_id",
    "drug_exposure": "drug_exposure_id person_id drug_concept_id drug_exposure_start_date "
    "drug_exposure_start_datetime drug_exposure_end_date drug_exposure_end_datetime verbatim_end_date "
    "drug_type_concept_id stop_reason refills quantity days_supply sig route_concept_id lot_number provider_id "
    "visit_occurrence_id visit_detail_id drug_source_value drug_source_concept_id route_source_value "
    "dose_unit_source_value",
    "device_exposure": "device_exposure_id person_id device_concept_id device_exposure_start_date "
    "device_exposure_start_datetime device_exposure_end_date device_exposure_end_datetime "
    "device_type_concept_id unique_device_id production_id quantity provider_id visit_occurrence_id "
    "visit_detail_id device_source_value device_source_concept_id unit_concept_id unit_source_value "
    "unit_source_concept_id",
    "note": "note_id person_id note_date note_datetime note_type_concept_id note_class_concept_id note_title "
    "note_text encoding_concept_id language_concept_id provider_id visit_occurrence_id visit_detail_id "
    "note_source_value note_event_id note_event_field_concept_id",
    "specimen": "specimen_id person_id specimen_concept_id specimen_type_concept_id specimen_date "
    "specimen_datetime quantity unit_concept_id anatomic_site_concept_id disease_status_concept_id "
    "specimen_source_id specimen_source_value unit_source_value anatomic_site_source_value "
    "disease_status_source_value",
    "death": "person_id death_date death_datetime death_type_concept_id cause_concept_id cause_source_value "
    "cause_source_concept_id",
    "observation_period": "observation_period_id person_id observation_period_start_date "
    "observation_period_end_date period_type_concept_id",
    "payer_plan_period": "payer_plan_period_id person_id payer_plan_period_start_date "
    "payer_plan_period_end_date payer_concept_id payer_source_value payer_source_concept_id plan_concept_id "
    "plan_source_value plan_source_concept_id sponsor_concept_id sponsor_source_value "
    "sponsor_source_concept_id family_source_value stop_reason_concept_id stop_reason_source_value "
    "stop_reason_source_concept_id",
    "condition_era": "condition_era_id person_id condition_concept_id condition_era_start_date "
    "condition_era_end_date condition_occurrence_count",
    "drug_era": "drug_era_id person_id drug_concept_id drug_era_start_date drug_era_end_date "
    "drug_exposure_count gap_days",
    "cost": "cost_id cost_event_id cost_domain_id cost_type_concept_id currency_concept_id total_charge "
    "total_cost total_paid paid_by_payer paid_by_patient paid_patient_copay paid_patient_coinsurance "
    "paid_patient_deductible paid_by_primary paid_ingredient_cost paid_dispensing_fee payer_plan_period_id "
    "amount_allowed revenue_code_concept_id revenue_code_source_value drg_concept_id drg_source_value",
    "cdm_source": "cdm_source_name cdm_source_abbreviation cdm_holder source_description "
    "source_documentation_reference cdm_etl_reference source_release_date cdm_release_date cdm_version "
    "cdm_version_concept_id vocabulary_version",
}

# Names whose type the suffix rule below does not give.
_BY_NAME: dict[str, T.DataType] = {
    **dict.fromkeys(
        "year_of_birth month_of_birth day_of_birth refills days_supply condition_occurrence_count "
        "drug_exposure_count gap_days".split(),
        T.IntegerType(),
    ),
    **dict.fromkeys(
        "value_as_number range_low range_high latitude longitude total_charge total_cost total_paid "
        "paid_by_payer paid_by_patient paid_patient_copay paid_patient_coinsurance paid_patient_deductible "
        "paid_by_primary paid_ingredient_cost paid_dispensing_fee amount_allowed".split(),
        NUMERIC,
    ),
    **dict.fromkeys("unique_device_id production_id specimen_source_id cost_domain_id".split(), T.StringType()),
}

# Columns that the CDM declares NOT NULL beyond the table key.
REQUIRED: dict[str, list[str]] = {
    "person": ["gender_concept_id", "year_of_birth", "race_concept_id", "ethnicity_concept_id"],
    "visit_occurrence": ["person_id", "visit_start_date", "visit_end_date"],
    "condition_occurrence": ["person_id", "condition_concept_id", "condition_start_date"],
    "procedure_occurrence": ["person_id", "procedure_concept_id", "procedure_date"],
    "measurement": ["person_id", "measurement_concept_id", "measurement_date"],
    "observation": ["person_id", "observation_concept_id", "observation_date"],
    "drug_exposure": ["person_id", "drug_concept_id", "drug_exposure_start_date", "drug_exposure_end_date"],
    "device_exposure": ["person_id", "device_concept_id", "device_exposure_start_date"],
    "note": ["person_id", "note_date", "note_text"],
    "specimen": ["person_id", "specimen_concept_id", "specimen_date"],
    "death": ["death_date"],
    "observation_period": ["person_id", "observation_period_start_date", "observation_period_end_date"],
    "payer_plan_period": ["person_id", "payer_plan_period_start_date", "payer_plan_period_end_date"],
}


def column_type(table: str, column: str) -> T.DataType:
    if column == "quantity":
        return NUMERIC if table in ("drug_exposure", "specimen") else T.IntegerType()
    if column in _BY_NAME:
        return _BY_NAME[column]
    if column.endswith("concept_id"):
        return T.IntegerType()
    if column.endswith("_id"):
        return T.LongType()
    if column.endswith("_datetime"):
        return T.TimestampNTZType()
    if column.endswith("_date"):
        return T.DateType()
    return T.StringType()


def columns(table: str) -> list[str]:
    return CDM_COLUMNS[table].split()


def primary_key(table: str) -> str:
    return "person_id" if table == "death" else columns(table)[0]


def schema(table: str) -> T.StructType:
    return T.StructType([T.StructField(c, column_type(table, c)) for c in columns(table)])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Put the columns in CDM order with CDM types; a column that ``df`` lacks becomes NULL."""
    unknown = set(df.columns) - set(columns(table))
    if unknown:
        raise ValueError(f"not columns of {table}: {sorted(unknown)}")
    have = set(df.columns)
    return df.select(
        *[(F.col(c) if c in have else F.lit(None)).cast(column_type(table, c)).alias(c) for c in columns(table)]
    )
